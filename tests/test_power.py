"""Powers of all features against trees grown over the rows themselves."""

import hashlib
import math
import random

import numpy as np
import pytest

from fieldmill.learn import power as W


def plain_gini(rows):
    n = len(rows)
    return n - sum(sum(c == k for _, c in rows) ** 2 for k in {c for _, c in rows}) / n if n else 0.0


def plain_tree(rows, low, high, depth, out, kinds):
    """Guesses of the bins low to high from (bin, class) rows."""
    mine = [r for r in rows if low <= r[0] < high]
    sizes = [sum(c == k for _, c in mine) for k in kinds]
    for b in range(low, high):
        out[b] = kinds[sizes.index(max(sizes))]
    best, at = 1e-9, None
    for cut in range(low + 1, high) if depth else ():
        left, right = [r for r in mine if r[0] < cut], [r for r in mine if r[0] >= cut]
        fall = plain_gini(mine) - plain_gini(left) - plain_gini(right)
        if fall > best + (1e-9 if at else 0):
            best, at = fall, cut
    if at is not None:
        plain_tree(rows, low, at, depth - 1, out, kinds)
        plain_tree(rows, at, high, depth - 1, out, kinds)


def plain_f1(pairs):
    total, out = len(pairs), 0.0
    for k in {a for a, _ in pairs}:
        hit = sum(a == k and g == k for a, g in pairs)
        out += sum(a == k for a, _ in pairs) / total * 2 * hit / (sum(a == k for a, _ in pairs) + sum(g == k for _, g in pairs))
    return out


def plain_power(rows, bins, depth):
    """(model F1, naive F1) from (fold, value, class) rows."""
    values = sorted(v for _, v, _ in rows)
    edges = sorted({values[max(math.ceil(k / bins * len(values)) - 1, 0)] for k in range(1, bins)})
    kinds = sorted({c for *_, c in rows})
    binned = [(f, sum(e < v for e in edges), c) for f, v, c in rows]
    count = max(b for _, b, _ in binned) + 1
    pairs = []
    for fold in range(W.FOLDS):
        guess = {}
        plain_tree([(b, c) for f, b, c in binned if f != fold], 0, count, depth, guess, kinds)
        pairs += [(c, guess[b]) for f, b, c in binned if f == fold]
    sizes = [sum(c == k for *_, c in rows) for k in kinds]
    top = kinds[sizes.index(max(sizes))]
    return plain_f1(pairs), plain_f1([(c, top) for *_, c in rows])


def fold_of(key):
    return int(hashlib.md5(str(key).encode()).hexdigest()[:8], 16) % W.FOLDS


def test_powers_equal_trees_over_rows(spark):
    draw = random.Random(6)
    rows = []
    for k in range(700):
        c = draw.choice(["a", "b", "b", "c", None])
        clear = {"a": 1.0, "b": 2.0, "c": 3.0}.get(c, 0.0) + draw.gauss(0, 0.4)
        rows.append((k, clear, draw.choice([0.0, 1.0, None]), draw.gauss(0, 1), 5.0, None, c))
    names = ["clear", "few", "noise", "same", "none"]
    fields = ", ".join(f"{n} double" for n in names)
    df = spark.createDataFrame(rows, f"k long, {fields}, y string")
    got = {r.feature: r for r in W.predictive_powers(df, names, "y", "k").collect()}
    assert set(got) == {"clear", "few", "noise", "same"}
    for place, name in enumerate(names[:4], 1):
        own = [(fold_of(r[0]), r[place], r[6]) for r in rows if r[6] is not None and r[place] is not None]
        model, naive = plain_power(own, W.BINS, W.DEPTH)
        assert got[name].rows == len(own)
        assert (got[name].model_f1, got[name].naive_f1) == pytest.approx((model, naive))
    assert got["clear"].power > 0.6 and got["same"].power == 0 and got["noise"].power < 0.15
    assert W.predictive_powers(df.limit(0), names, "y", "k").count() == 0


def test_cuts_equal_a_plain_search():
    draw = np.random.Generator(np.random.PCG64(4))
    for _ in range(60):
        bins, kinds = int(draw.integers(1, 12)), int(draw.integers(1, 4))
        counts = draw.integers(0, 5, (bins, kinds))
        rows = [(b, k) for b in range(bins) for k in range(kinds) for _ in range(counts[b, k])]
        want: dict = {}
        plain_tree(rows, 0, bins, 3, want, list(range(kinds)))
        assert W.predicted_bins(counts, 3).tolist() == [want[b] for b in range(bins)]
