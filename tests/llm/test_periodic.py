"""Periodic runs against a plain search over all starts and periods."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from fieldmill.llm import periodic


def brute(words):
    """Maximal runs by comparing every word with the one q before, for every q."""
    found = {}
    for q in range(1, len(words) // periodic.LEAST_PERIODS + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(periodic.LEAST_WORDS, periodic.LEAST_PERIODS * q):
                found.setdefault((i, j + q - i), q)  # smaller periods come first
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def dropped(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts(seed, count):
    draw = random.Random(seed)
    out = []
    for _ in range(count):
        words = []
        while len(words) < draw.choice([0, 3, 8, 30, 120, 400]):
            root = [f"w{draw.randrange(draw.choice([1, 2, 3, 50]))}" for _ in range(draw.choice([1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 33]))]
            if draw.random() < 0.4:  # a root that itself repeats
                root = root * draw.randint(2, 5) + root[: draw.randrange(len(root) + 1)]
            words += root * draw.choice([1, 1, 2, 3, 4, 5, 9]) + root[: draw.randrange(len(root) + 1)]
        out.append(words)
    return out


def runs_of(rows):
    data = [np.array([hash(w) & (2**64 - 1) for w in r], np.uint64) for r in rows]
    first = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    got = periodic.find_runs(np.concatenate([np.zeros(0, np.uint64), *data]), first)
    return [[tuple(int(x) for x in r[1:]) for r in got if r[0] == k] for k in range(len(rows))]


def test_runs_equal_plain_search():
    for seed in range(40):
        rows = texts(seed, 25)
        assert runs_of(rows) == [brute(r) for r in rows]


def test_words_of_few_kinds():
    draw = random.Random(5)
    fib = ["a", "b"]
    while len(fib) < 700:
        fib = fib + fib[: int(len(fib) / 1.618)]
    rows = [["x"] * 1000, ["x", "y"] * 500, fib, [draw.choice("ab") for _ in range(3000)]]
    rows += [[draw.choice("ab") for _ in range(n)] * 6 for n in (13, 64, 100)]
    rows.append((["p"] * 40 + ["q"]) * 9)  # highly periodic parts within a long period
    rows.append([["a", "b"][bin(k).count("1") % 2] for k in range(2048)])
    assert runs_of(rows) == [brute(r) for r in rows]


def test_operator(spark):
    rows = [(k, " \n".join(w)) for k, w in enumerate(texts(99, 120))]
    got = periodic.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    for r in got:
        words = rows[r.doc_id][1].split()
        assert [tuple(x) for x in r.runs] == brute(words) and r.n_words == len(words)
        assert r.collapsed == dropped(words, brute(words))


def test_strongest_and_planted_period(spark):
    runs = [(3, 12, 3), (9, 8, 2), (30, 12, 3), (50, 9, 2)]
    df = spark.createDataFrame([(runs,), ([],)], f"runs {periodic.RUN_TYPE}")
    got = [r.best for r in df.select(periodic.strongest("runs").alias("best")).collect()]
    assert tuple(got[0]) == (50, 9, 2) and got[1] is None
    tied = spark.createDataFrame([(runs[:3],)], f"runs {periodic.RUN_TYPE}")
    assert tuple(tied.select(periodic.strongest("runs").alias("b")).first().b) == (3, 12, 3)
    rows = [(k, " ".join(f"w{j}" for j in range(k % 41))) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    edited = periodic.with_planted_period(F.col("text"), F.col("doc_id")).alias("t")
    changed = 0
    for r in df.select("doc_id", edited).collect():
        words = rows[r.doc_id][1].split()
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            changed += 1
        assert r.t == " ".join(words)
    assert changed > 10


def test_odd_rows(spark, odd, empty):
    rows = periodic.periodic_runs(odd).collect()
    assert len(rows) == odd.count()
    assert [(r.n_words, r.runs, r.collapsed) for r in rows if r.doc_id in (1, 2, 3)] == [(0, [], "")] * 3
    assert {r.n_words for r in rows if r.doc_id == 8} == {30_000}
    assert [r.collapsed for r in rows if r.doc_id is None] == ["no id here"]
    assert [r.collapsed for r in rows if r.doc_id == 9] == ["aé中\U0001f600 z\x00"]
    assert periodic.periodic_runs(empty).count() == 0
    planted = odd.select(periodic.with_planted_period(F.col("text"), F.col("doc_id")).alias("t"))
    assert planted.where("t is null").count() == 0
