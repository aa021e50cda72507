"""The n-gram join against a comparison of all pairs."""

import random

import numpy as np
import pytest
from test_neardup import brute, corpus

from fieldmill.llm import ngramjoin as J


def grouped(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = J.ngram_join(docs.repartition(3), **options).collect()
    assert len(got) == len(rows)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in got}


def near_group(seed, count, words=60):
    """Copies of one text, each with its own small change, and texts half way to another."""
    draw = random.Random(seed)
    base = [f"b{seed}x{k}" for k in range(words)]
    out = []
    for k in range(count):
        own = list(base)
        for _ in range(draw.choice([1, 1, 2, 3])):
            own[draw.randrange(words)] = f"c{draw.randrange(10**6)}"
        out.append(" ".join(own[draw.randrange(4) :]))
    return out


def test_components_equal_brute_force(spark):
    rows = corpus(11, 220)
    rows += [(1000 + k, t) for s in (1, 2) for k, t in enumerate(near_group(s, 40), 100 * s)]
    want = brute(rows, 5, 80)
    assert grouped(spark, rows, block=300) == want  # parts of heads and many pairs of blocks


def test_short_and_long_chains(spark, monkeypatch):
    rows = corpus(21, 200) + [(1000 + k, t) for k, t in enumerate(near_group(8, 50, 30))]
    want = brute(rows, 5, 80)
    monkeypatch.setattr(J, "SMALL", 2)
    assert grouped(spark, rows, block=1500) == want


@pytest.mark.parametrize("width, share", [(2, 65)])
def test_other_widths_and_shares(spark, width, share):
    rows = corpus(5, 150)
    assert grouped(spark, rows, width=width, share=share) == brute(rows, width, share)


def test_split_groups(spark, monkeypatch):
    monkeypatch.setattr(J, "SALT_ROWS", 3)  # nearly every shared shingle is split
    rows = list(enumerate(near_group(3, 90) + near_group(4, 30, 25))) + [
        (500 + k, t) for k, t in corpus(3, 120)
    ]
    assert grouped(spark, rows, block=2000) == brute(rows, 5, 80)


def test_pairs_in_a_task_equal_all_pairs():
    draw = np.random.Generator(np.random.PCG64(9))
    for trial in range(60):
        share = int(draw.choice([50, 70, 80, 95]))
        sets = []
        for _ in range(40):
            if sets and draw.random() < 0.7:
                old = sets[draw.integers(len(sets))]
                kept = old[draw.random(len(old)) < draw.choice([0.75, 0.9, 1.0])]
                new = draw.integers(0, 400, int(draw.integers(0, 6))).astype(np.uint64)
                own = np.union1d(kept, new)
            else:
                own = np.unique(draw.integers(0, 400, int(draw.integers(1, 60))).astype(np.uint64))
            sets.append(own if len(own) else np.array([7], np.uint64))
        side = draw.integers(0, 1 + trial % 2, len(sets))
        top = list(range(len(sets)))

        def find(x, top):
            while top[x] != x:
                x = top[x]
            return x

        both = len(set(side.tolist())) > 1
        for a in range(len(sets)):
            for b in range(a):
                met = len(np.intersect1d(sets[a], sets[b]))
                if 100 * met >= share * (len(sets[a]) + len(sets[b]) - met) and not (
                    both and side[a] == side[b]
                ):
                    top[find(a, top)] = find(b, top)
        got = list(range(len(sets)))
        for a, b in J.joined_pairs(sets, side, np.arange(len(sets)), share):
            met = len(np.intersect1d(sets[a], sets[b]))
            assert 100 * met >= share * (len(sets[a]) + len(sets[b]) - met)
            assert find(a, got) != find(b, got)  # every link connects something
            got[find(a, got)] = find(b, got)
        want = [find(x, top) for x in range(len(sets))]
        have = [find(x, got) for x in range(len(sets))]
        assert len(set(zip(want, have))) == len(set(want)) == len(set(have))


def test_odd_rows(spark, odd, empty):
    got = J.ngram_join(odd).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got}
    assert [by[k].n_shingles for k in (1, 2, 3)] == [0, 0, 0] and by[5].n_shingles == 1
    assert [by[k].component_id for k in (1, 2, 3, 4, 5, 6, 7, 8, 9)] == [1, 2, 3, 4, 5, 6, 6, 8, 9]
    assert by[None].component_id is None
    assert J.ngram_join(empty).count() == 0


def test_many_rows_of_one_id(spark):
    texts = near_group(6, 60) + [f"own words {k} of this text here {k}" for k in range(60)]
    rows = [(7, t) for t in texts] + [(None, t) for t in texts] + [(k + 100, t) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = J.ngram_join(docs).collect()
    assert len(got) == len(rows) and {r.component_id for r in got} == {7}
