"""The filter audit against a plain walk over documents and orders."""

import re
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from fieldmill.llm import arrays as A
from fieldmill.llm import audit

LABELS = "doc_id long, quality int, toxic int, lang string"


def failing(text, repeat):
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    return {
        letter
        for letter, fails in zip(
            "ABCDE",
            [
                len(words) < 200,
                100 * len(set(words)) < 50 * len(words),
                100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
                re.search(r"[#$%&*|]", text) is not None,
                repeat,
            ],
        )
        if fails
    }


def brute(docs, labels):
    least = {}
    for key, text, _ in docs:
        if key is not None:
            least[text or ""] = min(key, least.get(text or "", key))
    good = {k for k, q, _ in labels if q == 1}
    toxic = {k for k, _, t in labels if t == 1}
    out = {}
    for part in {p or "" for _, _, p in docs}:
        rows = [
            (k, failing(t or "", k is not None and k > least[t or ""]))
            for k, t, p in docs
            if (p or "") == part
        ]
        removed = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order):
                hit = [(k, x) for k, x in left if f in x]
                left = [(k, x) for k, x in left if f not in x]
                removed[f] += len(hit)
                out[part, "".join(order), step + 1] = [
                    len(left),
                    len(hit),
                    sum(f in x for _, x in rows) - len(hit),
                    sum(x == {f} for _, x in rows),
                    sum(k in good for k, _ in hit),
                    sum(k in toxic for k, _ in hit),
                    f,
                ]
        for key, value in out.items():
            if key[0] == part:
                value[6] = removed[value[6]]
    return out


def audited(spark, docs, labels):
    rows = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    rows = rows.withColumn("mask", F.lit("x")).withColumn("part", F.lit(1)).withColumn("key", F.lit(2))
    known = spark.createDataFrame([(*r, "zz") for r in labels], LABELS)
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    got = audit.filter_audit(rows, known).collect()
    assert len(got) == len({(r.part, r.filter_order, r.step) for r in got})
    return {(r.part, r.filter_order, r.step): [r[n] for n in names] for r in got}


def test_equals_plain_walk(spark):
    draw = np.random.Generator(np.random.PCG64(3))
    docs = []
    for k in range(300):
        words = [f"w{draw.integers(0, 150 if k % 3 else 400)}" for _ in range(draw.integers(150, 420))]
        if k % 4 == 0:
            words = [w.upper() for w in words]
        if k % 5 == 0:
            words[0] += "$"
        docs.append((k, " \t".join(words), ["en", "de", None, ""][k % 4]))
    docs += [(1000 - k, docs[k * 7 % 300][1], "fr") for k in range(120)]  # repeats across parts
    docs += [(2000 + k, "same " * 250, "en") for k in range(200)]  # a third of the rows
    docs += [(5, docs[9][1], "en"), (5, docs[9][1], "en"), (None, docs[9][1], "en"), (None, None, None)]
    labels = [(k, int(k % 3 == 0), int(k % 7 == 0)) for k in range(0, 2100, 2)] + [(4, 1, 1), (4, 0, None)]
    assert audited(spark, docs, labels) == brute(docs, labels)


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([], LABELS)
    rows = [(r.doc_id, r.text, r.lang) for r in odd.collect()]
    assert audited(spark, rows, []) == brute(rows, [])
    assert audit.filter_audit(empty, labels).count() == 0
    total = audit.filter_audit(odd, labels).where("step = 5 and filter_order = 'ABCDE'")
    assert total.agg(F.sum("kept")).first()[0] == 1  # the long text


def test_sketch_clears_only_unique_keys(spark):
    keys = A.mixed(np.arange(60_000, dtype=np.uint64)).view(np.int64)
    repeated = keys[:5000]
    rows = np.concatenate([keys, repeated, np.full(30_000, keys[7])]).tolist()
    df = spark.createDataFrame([(k,) for k in rows], "key long").repartition(7)
    probe = audit.possible_repeat(audit.repeat_sketch(df, len(rows)), spark)
    found = {r.key for r in df.where(probe("key")).distinct().collect()}
    assert set(repeated.tolist()) <= found
    assert len(found) - len(repeated) < 0.01 * len(keys)


def test_full_sketch_changes_no_result(spark, monkeypatch):
    monkeypatch.setattr(audit, "MOST_COUNTERS", 1 << 16)
    docs = [(k, f"text {k % 20000}", "en") for k in range(30_000)]
    rows = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    got = audit.document_masks(rows).where(F.col("mask").bitwiseAND(audit.REPEAT) != 0)
    assert sorted(r.doc_id for r in got.collect()) == list(range(20_000, 30_000))
