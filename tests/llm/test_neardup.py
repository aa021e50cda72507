import random
import re

import numpy as np
from pyspark.sql import functions as F

from fieldmill.llm import neardup
from fieldmill.llm.common import components


def brute(rows, width, share):
    sets, parent = {}, {}
    for key, text in rows:
        words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        runs = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}
        sets[key] = runs or ({tuple(words)} if words else set())
        parent[key] = key

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for a in keys:
        for b in keys:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= share * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), top(k)) for k in keys}


def corpus(seed, count=160):
    draw = random.Random(seed)
    texts = []
    for _ in range(count):
        if texts and draw.random() < 0.7:
            words = draw.choice(texts).split(" ")
            for _ in range(draw.choice([0, 0, 1, 1, 2, 4])):
                words[draw.randrange(len(words))] = f"n{draw.randrange(99)}"
        else:
            words = [f"w{draw.randrange(400)}" for _ in range(draw.choice([1, 3, 5, 12, 60, 150]))]
        texts.append(" ".join(words))
    return list(enumerate(texts))


def test_components_equal_brute_force(spark):
    for block in (neardup.BLOCK_SHINGLES, 400):  # one block, then many pairs of blocks
        rows = corpus(block)
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = neardup.near_duplicates(docs, width=4, block=block).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, 4, 80)


def test_odd_rows(spark, odd, empty):
    got = neardup.near_duplicates(odd, width=4).collect()
    assert len(got) == odd.count()
    by = {(r.doc_id): r for r in got}
    assert [by[k].n_shingles for k in (1, 2, 3)] == [0, 0, 0]
    assert all(by[k].kept for k in (1, 2, 3, 4, 5, 6, 8, 9))
    assert by[7].component_id == 6 and not by[7].kept and by[5].n_shingles == 1
    assert by[None].component_id is None and by[None].kept
    assert neardup.near_duplicates(empty).count() == 0
    kept = neardup.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted("1 2 3 4 5 6 8 9 None".split())


def test_small_sets_share_bands():
    draw = np.random.Generator(np.random.PCG64(1))
    missed = 0
    for size in (5, 9, 30, 200):
        for _ in range(100):
            base = draw.integers(0, 2**64, size, dtype=np.uint64)
            other = np.concatenate([base, draw.integers(0, 2**64, size // 5, dtype=np.uint64)])
            both = [np.unique(base), np.unique(other)]
            at = np.array([0, len(both[0]), len(both[0]) + len(both[1])])
            keys = neardup.band_keys(np.concatenate(both), at)
            missed += not (keys[0] == keys[1]).any()
    assert missed <= 1


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 60)] + [(7, 7)]
    got = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert {r.node: r.root for r in got} == {k: 0 for k in range(41)} | {100 + k: 100 for k in range(60)}
    none = spark.createDataFrame([], "a long, b long")
    assert components(none, "a", "b").select(F.count("node")).first()[0] == 0


def test_rows_of_one_id_keep_their_own_classes(spark):
    words = [[f"w{k}x{i}" for i in range(60)] for k in range(40)]
    texts = [" ".join(w) for w in words] + [" ".join([*w[:-1], "end"]) for w in words]
    rows = [(None if k % 2 else 5, t) for k, t in enumerate(texts)] + [(900, texts[0])] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = neardup.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    # texts 2k and 2k + 40 are near copies under id 5, the odd ones have no id
    assert {r.component_id for r in got if r.doc_id is not None} == {5}
    assert {r.component_id for r in got if r.doc_id is None} == {None}
    mixed = spark.createDataFrame(
        [(7, texts[0]), (7, texts[1]), (3, texts[40]), (2, texts[41])], "doc_id long, text string"
    )
    found = {(r.doc_id, r.component_id) for r in neardup.near_duplicates(mixed).collect()}
    assert found == {(7, 3), (7, 2), (3, 3), (2, 2)}
