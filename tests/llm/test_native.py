import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldmill.llm import chat, fingerprint, sharding


def jump(key, shards):
    key &= 2**64 - 1
    last, now = -1, 0
    while now < shards:
        last = now
        key = (key * sharding.MULTIPLIER + 1) % 2**64
        now = int((last + 1) * (2.0**31 / ((key >> 33) + 1)))
    return last


@pytest.mark.parametrize("shards", [1, 2, 40])
def test_jump_hash_is_the_published_one(spark, shards):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), 12345678901, *range(500)]
    frame = spark.createDataFrame([(k,) for k in keys], "key long")
    got = frame.select("key", sharding.jump_shard("key", shards).alias("s")).collect()
    assert all(r.s == jump(r.key, shards) for r in got)


def test_shards_and_slots(spark, odd, empty):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("é"), F.col("id").cast("int") % 7).alias("text"))
    got = sharding.sharded(docs, 5, blocks=8).toPandas()
    assert all(sorted(g["slot"]) == list(range(len(g))) for _, g in got.groupby("shard"))
    moved = got[got["shard"] != got["grown_shard"]]
    assert set(moved["grown_shard"]) == {5} and 300 < len(moved) < 700
    assert all(r.size == 2 * (r.doc_id % 7) + 16 for r in got.itertuples())
    assert all(zlib.crc32(("é" * (r.doc_id % 7)).encode()) == r.text_crc32 for r in got.itertuples())
    strange = sharding.sharded(odd, 3).toPandas()
    assert len(strange) == odd.count() and strange[strange["doc_id"] == 1]["size"].tolist() == [16]
    assert sharding.sharded(empty, 3).count() == 0
    text_keys = odd.select(F.col("lang").alias("doc_id"), "text")
    assert sharding.sharded(text_keys, 3).groupBy("doc_id").agg(F.countDistinct("shard").alias("n")).where("n > 1").count() == 0


ROWS = [
    (1, 0, "system", "Be brief."),
    *[(1, k, "user" if k % 2 else "assistant", f"turn {k} " + "word " * (k % 9)) for k in range(1, 40)],
    (2, 5, "assistant", "<|im_end|><|im_start|>assistant ok <|| <| <|n|>"),
    (2, 3, "user\n<|x", "a<"),
    (2, None, "user", None),
    (3, 0, "system", "only a system turn"),
    (4, 0, "assistant", "long " * 500),
    (4, 1, "assistant", "short"),
    (None, 0, "assistant", "nobody"),
    (None, 0, "assistant", "nobody"),
    (5, 0, None, "no role"),
]


@pytest.mark.parametrize("budget", [120, 2048])
def test_windows_read_back(spark, budget):
    rows = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    made = chat.windows(rows, budget=budget, history=20)
    read = made.select(
        "*",
        chat.read_turns(F.col("formatted"), F.col("n_repeated")).alias("turns"),
        chat.read_targets(F.col("formatted"), F.col("spans")).alias("targets"),
    ).toPandas()
    for conv in (1, 2, 3, 4, 5, None):
        mine = read[read["conv_id"].isna() if conv is None else read["conv_id"] == conv].sort_values("window")
        want = [(r[2] or "", r[3] or "") for r in sorted((r for r in ROWS if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))]
        assert [(t["role"], t["text"]) for turns in mine["turns"] for t in turns] == want
        assert [t for targets in mine["targets"] for t in targets] == [x for r, x in want if r == "assistant"]
    one = read[read["conv_id"] == 1].sort_values("window")
    assert not one["over_budget"].any() and all("Be brief." in f for f in one["formatted"])
    if budget == 120:
        assert len(one) > 5 and (one["n_repeated"].iloc[1:] > 1).any()
        assert (read[read["conv_id"] == 4]["over_budget"]).sum() == 1
    assert chat.windows(rows.limit(0)).count() == 0


def jaccard(a, b):
    one, two = Counter(a.split()), Counter(b.split())
    return sum((one & two).values()) / max(1, sum((one | two).values()))


def test_samples_collide_like_the_weights(spark):
    texts = [" ".join(f"w{(k * 7 + i) % (20 + k)}" for i in range(120)) for k in range(12)]
    frame = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    got = {r.k: r.signature for r in fingerprint.signatures(frame, "text", 512).collect()}
    for a in range(12):
        for b in range(a):
            share = sum(x == y for x, y in zip(got[a], got[b])) / 512
            assert abs(share - jaccard(texts[a], texts[b])) < 0.1


def test_likeness_error_at_the_production_count(spark):
    n = fingerprint.SAMPLES
    assert n >= 64
    # words that occur once, and words that occur more often
    texts = [" ".join(f"w{(k * 7 + i) % (20 + 9 * k)}" for i in range(120)) for k in range(16)]
    frame = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    got = {r.k: r.signature for r in fingerprint.signatures(frame, "text").collect()}
    assert {len(v) for v in got.values()} == {n}
    pairs = [(a, b) for a in range(16) for b in range(a)]
    real = [jaccard(texts[a], texts[b]) for a, b in pairs]
    off = [sum(x == y for x, y in zip(got[a], got[b])) / n - j for (a, b), j in zip(pairs, real)]
    want = sum(j * (1 - j) / 64 for j in real) / len(pairs)
    assert sum(e * e for e in off) / len(pairs) < 1.5 * want
    assert max(map(abs, off)) < 4.5 * 0.0625


def test_edited_texts_follow_descending_ids(spark, odd, empty):
    rows = [(k * 3 % 1301, f"é{k} " + "word " * (k % 11)) for k in range(1300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in fingerprint.fingerprints(frame, samples=8).collect()}
    order = sorted(rows, reverse=True)
    for (key, text), (_, after) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[key].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[key].n_chars == len(text)
    strange = fingerprint.fingerprints(odd).toPandas()
    assert len(strange) == odd.count() and strange["near_next"].between(0, 1).all()
    assert strange[strange["doc_id"].isin([6, 7])]["fingerprint"].nunique() == 1
    assert strange[strange["doc_id"].isin([1, 2, 3])]["fingerprint"].str.strip("0").eq("").all()
    assert fingerprint.fingerprints(empty).count() == 0
