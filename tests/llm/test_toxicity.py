import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldmill.llm import toxicity as X

DOCS, LABELS = "doc_id long, text string", "doc_id long, toxic int"


def planted(spark, expression, texts=3000, copies=0):
    """Texts of 80 of 500 words; every tenth is toxic and holds ``expression(draw)``."""
    draw = random.Random(3)
    rows, labels = [], []
    for k in range(texts):
        words = [f"w{draw.randrange(500)}" for _ in range(80)]
        toxic = int(k % 10 == 0)
        if toxic:
            own = expression(draw)
            at = draw.randrange(80 - len(own))
            words[at : at + len(own)] = own
        rows.append((k, " ".join(words)))
        labels.append((k, toxic))
    for k in range(copies):  # one toxic text again and again, each time with another last word
        rows.append((texts + 3 * k + 1, rows[0][1] + f" x{k}"))
        labels.append((texts + 3 * k + 1, 1))
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    return docs, spark.createDataFrame(labels, LABELS)


def taken(docs, labels, model):
    got = X.score(docs.where("doc_id % 3 = 0"), model).join(labels, "doc_id")
    right = got.groupBy("toxic").agg(F.count("*"), F.sum((F.col("score") >= 0.5).cast("int")))
    return {r[0]: (r[1], r[2]) for r in right.collect()}


@pytest.mark.parametrize(
    "expression, copies",
    [
        (lambda draw: ["w1", "w2", "w3", "w4"], 0),  # ordinary words, only together toxic
        (lambda draw: ["w9", "zorg"], 0),  # a coined word behind always the same word
        (lambda draw: ["w1", "w2", "w3", "w4"], 1000),  # near copies move nothing else
    ],
)
def test_fixed_expressions_are_found_and_others_left(spark, expression, copies):
    docs, labels = planted(spark, expression, copies=copies)
    model = X.train(docs, labels, F.col("doc_id") % 3 != 0)
    found = taken(docs, labels, model)
    assert found[1][0] == 100 and found[1][1] >= 97
    assert found[0][0] == 900 and found[0][1] <= 5
    again = X.train(docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 300_000)), labels.unionByName(
        labels.withColumn("doc_id", F.col("doc_id") + 300_000)), F.col("doc_id") % 3 != 0)
    assert np.array_equal(again.words.keys, model.words.keys) and np.allclose(again.words.gain, model.words.gain)
    assert np.array_equal(again.pairs.keys, model.pairs.keys) and np.allclose(again.pairs.gain, model.pairs.gain)


def plain_factors(ordinary, toxic, share):
    both, out = ordinary + toxic, []
    for own, x in ((ordinary, both * (1 - share)), (toxic, both * share)):
        rest = max(abs(own - x) - 3 * math.sqrt(both * share * (1 - share) + 1) - x / 2, 0)
        out.append(math.log((x + math.copysign(rest, own - x) + 1) / (x + 1)))
    return out


def test_counts_and_evidence_equal_a_plain_model(spark):
    draw = random.Random(8)
    texts = []
    for k in range(400):
        words = [f"v{draw.randrange(40)}" for _ in range(draw.randint(1, 30))]
        if k % 5 == 0:
            words[draw.randrange(len(words)) : 1] = ["v1", "v2", "v3"] if k % 2 else ["bad"]
        texts.append((k, " ".join(words), int(k % 5 == 0)))
    texts += [(500, texts[3][1], 0), (501, texts[5][1], 1), (502, None, 1), (503, "?!", 0)]
    docs = spark.createDataFrame([t[:2] for t in texts], DOCS).repartition(3)
    labels = spark.createDataFrame([(t[0], t[2]) for t in texts], LABELS)
    model = X.train(docs, labels)

    held, befores = defaultdict(lambda: [0, 0]), defaultdict(lambda: [set(), set()])
    around = defaultdict(lambda: [set(), set()])

    def grams(text):
        words = ["", *(text or "").replace("?!", "").split(), ""]
        return [(words[i - 2] if i > 1 else "", words[i - 1], words[i], words[i + 1]) for i in range(1, len(words) - 1)]

    for text, label in {t[1:] for t in texts}:
        for far, before, word, after in grams(text):
            befores[word][label].add(before)
            around[before, word][label].add((far, after))
        for pair in {g[1:3] for g in grams(text)}:
            held[pair][label] += 1
    sums = [sum(len(b[c]) for b in befores.values()) for c in (0, 1)]
    share = sums[1] / sum(sums)
    word_gain = {}
    for word, b in befores.items():
        low, high = plain_factors(len(b[0]), len(b[1]), share)
        word_gain[word] = high - low
    part = sum(h[1] for h in held.values()) / sum(map(sum, held.values()))
    pair_gain = {}
    for pair, (ordinary, toxic) in held.items():
        both = ordinary + toxic
        chance = 3 * math.sqrt(both * part * (1 - part) + 1)
        if abs(toxic - both * part) > chance + both * min(part, 1 - part) / 2:
            odds = part / (1 - part) * math.exp(word_gain[pair[1]])
            low, high = plain_factors(*map(len, around[pair]), odds / (1 + odds))
            pair_gain[pair] = high - low
    assert len(model.pairs.keys) == len(pair_gain) > 1
    assert np.allclose(sorted(model.pairs.gain), sorted(pair_gain.values()))
    assert any(pair_gain.values()) and any(word_gain.values())
    got = {r.doc_id: r.evidence for r in X.score(docs, model).collect()}
    for key, text, _ in texts:
        pairs = {g[1:3] for g in grams(text)}
        want = sum(word_gain[w] + pair_gain.get((v, w), 0) for v, w in pairs) / max(len(pairs), 1)
        assert abs(got[key] - want) < 1e-5

    other = X.train(docs, labels, broadcast_rows=0)
    assert np.array_equal(other.pairs.keys, model.pairs.keys) and np.allclose(other.pairs.gain, model.pairs.gain)


def test_tasks_hand_over_in_pieces(monkeypatch):
    import pyarrow as pa

    draw = random.Random(1)
    rows = [" ".join(f"w{draw.randrange(30)}" for _ in range(40)) for _ in range(50)]
    batch = pa.RecordBatch.from_pydict({"text": rows, "label": [k % 2 for k in range(50)]})

    def sums():
        out = defaultdict(lambda: np.zeros(2, int))
        pieces = 0
        for got in X._pairs(iter([batch.slice(k, 5) for k in range(0, 50, 5)])):
            pieces += 1
            for pair, a, b in zip(*(c.to_pylist() for c in got.columns)):
                out[pair] += (a, b)
        return pieces, {k: tuple(v) for k, v in out.items()}

    one, whole = sums()
    monkeypatch.setattr(X, "FLUSH_PAIRS", 300)
    many, parts = sums()
    assert one == 1 and many > 1 and parts == whole
