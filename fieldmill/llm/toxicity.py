"""Toxicity from class-conditional Kneser-Ney word models.

Each class, toxic and ordinary, has a bigram model that backs off to its unigram model,
which backs off to counts shared by both classes. As in Kneser-Ney smoothing an expression
weighs by the different contexts it occurs in, not by how often it occurs: a word by the
words it follows, a bigram by the pairs of words around it. A text that is copied, or a
long passage, therefore adds little, while a fixed phrase in many texts shows in the
bigrams at its ends. With x(e) what class c would have of an expression e if the next lower
order said all, and n_c(e) what it has, each order multiplies the probability by

    (x(e) + d(n_c(e) - x(e)) + S) / (x(e) + S)

where d takes a discount off the difference, down to nothing: three deviations of the
count and half of x. For a word, x is the class's share of the shared count; for a bigram
it is that share moved by the factors of its word. The usual constant discount leaves small
chance differences of very many words; here a rare or neutral expression comes out alike in
both classes. The score is a calibrated sigmoid of the difference of the two log-likelihoods
over a text's different bigrams, divided by their number.

Words are hashed to 2**22 cells; bigrams have 63-bit keys, and only those that more or fewer
different texts of a class hold than the discount allows get contexts counted and a place in
the model. Equal texts count once for each label.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A
from .common import discard, ship_package, stage
from .labelled import labels_of, sigmoid

CELLS = 22
PAIR_BITS = 41
CHANCE = 3.0  # deviations of a count that are taken off a difference
BLUR = 0.5  # part of the expected count that is taken off a difference
SHARED = 1.0  # shared continuation counts that stand in for an expression's own
FLUSH_PAIRS = 1 << 21
CALIBRATION_ROWS = 20_000
BROADCAST_ROWS = 4_000_000
KEYED = "pair long, ordinary long, toxic long"
WORD = A.byte_flags(r"[0-9A-Za-z]")
WORD[128:] = True


def hashed_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words (runs of letters, digits, non-ASCII) of all rows."""
    data, offsets = A.text_bytes(column)
    starts, ends, first = A.word_spans(data, offsets, WORD)
    return A.span_hashes(A.LOWER[data], starts, ends), first


def cells(words: np.ndarray) -> np.ndarray:
    return (words >> A.U(64 - CELLS)).astype(np.int64)


def pair_keys(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One key per word: its cell, and a hash of it with the word before it."""
    before = np.zeros(len(words), np.uint64)
    before[1:] = words[:-1]
    before[first[:-1][np.diff(first) > 0]] = 0
    pair = A.mixed(before * A.U(0x9E3779B97F4A7C15) + words) >> A.U(64 - PAIR_BITS)
    return (cells(words) << PAIR_BITS) | pair.astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        _, offsets = A.text_bytes(whole.column("text"))
        for a, b in A.row_blocks(offsets, A.CHUNK):
            yield whole.slice(a, b - a)


def context_keys(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of the words around each word's bigram: two before it and one after it."""
    far, after = np.zeros(len(words), np.uint64), np.zeros(len(words), np.uint64)
    far[2:], after[:-1] = words[:-2], words[1:]
    full = np.diff(first) > 0
    far[first[:-1][full]] = 0
    far[first[:-1][np.diff(first) > 1] + 1] = 0
    after[first[1:][full] - 1] = 0
    return A.mixed(far * A.U(0x9E3779B97F4A7C15) + after)


def places_in(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``keys`` in the sorted array ``known`` and whether they are there."""
    if not len(known):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return at, known[at] == keys


Counted = tuple[np.ndarray, np.ndarray]  # keys, and a row (ordinary, toxic) for each


def _merged(parts: list[Counted], join: np.ufunc) -> Counted:
    keys = np.concatenate([k for k, _ in parts])
    order = np.argsort(keys, kind="stable")
    lead = np.flatnonzero(np.diff(keys[order], prepend=-1))
    if not len(lead):
        return keys, np.zeros((0, 2), np.int32)
    values = np.concatenate([v for _, v in parts])[order]
    return keys[order][lead], join.reduceat(values, lead, axis=0)


def _gathered(batches: Iterator[pa.RecordBatch], part, join: np.ufunc) -> Iterator[pa.RecordBatch]:
    """Keys of ``part(batch)`` with their two numbers, joined over a task in bounded memory."""

    def out(held: Counted) -> pa.RecordBatch:
        columns = [held[0], held[1][:, 0].astype(np.int64), held[1][:, 1].astype(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["pair", "ordinary", "toxic"])

    held, size = [], 0
    for batch in _blocks(batches):
        held.append(_merged([part(batch)], join))
        size += len(held[-1][0])
        if size > FLUSH_PAIRS:
            held = [_merged(held, join)]
            size = len(held[0][0])
            if size > FLUSH_PAIRS // 2:
                yield out(held[0])
                held, size = [], 0
    if held:
        yield out(_merged(held, join))


def _class_marks(batch: pa.RecordBatch, row: np.ndarray) -> np.ndarray:
    toxic = np.array(batch.column("label").to_pylist(), np.int32)[row]
    return np.stack([1 - toxic, toxic], axis=1)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bigrams of a task and how many of its texts of each class hold them."""

    def part(batch: pa.RecordBatch) -> Counted:
        row, pair, _, _ = _expressions(batch)
        return pair, _class_marks(batch, row)

    return _gathered(batches, part, np.add)


def _contexts(shared, bits: int):
    """Different contexts of the wanted bigrams: place and context in one key, classes as marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def part(batch: pa.RecordBatch) -> Counted:
            words, first = hashed_words(batch.column("text"))
            at, known = places_in(shared.value, pair_keys(words, first))
            context = (context_keys(words, first)[known] >> A.U(64 - bits)).astype(np.int64)
            row = np.repeat(np.arange(len(first) - 1), np.diff(first))[known]
            return at[known] << bits | context, _class_marks(batch, row)

        return _gathered(batches, part, np.maximum)

    return run


@dataclass(frozen=True)
class Order:
    """Counts of one order of the two models, and each expression's gain from them."""

    keys: np.ndarray  # sorted
    counts: tuple[np.ndarray, np.ndarray]  # contexts in the ordinary and the toxic class
    share: np.ndarray | float  # the part of a count that the lower order gives the toxic class
    gain: np.ndarray  # ln of the toxic over the ordinary factor

    def without(self, keys: np.ndarray, toxic: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Gains of ``keys`` as if ``own`` contexts in their text's class had not been counted."""
        at, known = places_in(self.keys, keys)
        if not known.any():
            return np.zeros(len(keys))
        less = [np.maximum(c[at] - own * (toxic == k), 0) for k, c in enumerate(self.counts)]
        share = self.share[at] if isinstance(self.share, np.ndarray) else self.share
        ordinary, hostile = class_factors(*less, share)
        return np.where(known, hostile - ordinary, 0.0)


NO_ORDER = Order(np.zeros(0, np.int64), (np.zeros(0), np.zeros(0)), 0.5, np.zeros(0))


@dataclass
class ToxicityModel:
    """Difference of the classes' log-probabilities per word and bigram, and calibration."""

    words: Order = NO_ORDER
    pairs: Order = NO_ORDER
    weight: float = 0.0
    bias: float = 0.0

    @cached_property
    def word_table(self) -> np.ndarray:
        """Gain of every cell; built once where texts are scored, and gone with the model."""
        out = np.zeros(1 << CELLS, np.float32)
        out[self.words.keys] = self.words.gain
        return out

    def scores(self, evidence: np.ndarray) -> np.ndarray:
        return sigmoid(self.weight * evidence + self.bias)


def class_factors(ordinary: np.ndarray, toxic: np.ndarray, share) -> tuple[np.ndarray, np.ndarray]:
    """ln of the factors (ordinary, toxic) by which counts move the lower order's probability.

    ``share`` is the part of the counts that the lower order gives the toxic class.
    """
    both = ordinary + toxic
    out = []
    for own, expected in ((ordinary, both * (1 - share)), (toxic, both * share)):
        discount = CHANCE * np.sqrt(both * share * (1 - share) + 1) + BLUR * expected
        rest = np.maximum(np.abs(own - expected) - discount, 0)
        own = expected + np.sign(own - expected) * rest
        out.append(np.log((own + SHARED) / (expected + SHARED)))
    return out[0], out[1]


def _expressions(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Row, key and number of contexts of every different bigram of every text, and the rows."""
    words, first = hashed_words(batch.column("text"))
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    pair = pair_keys(words, first)
    own = pair.astype(np.uint64) + row.astype(np.uint64) * A.odd_numbers(1, 47)
    _, lead, times = np.unique(own, return_index=True, return_counts=True)
    return row[lead], pair[lead], times, len(first) - 1


def _mean(row: np.ndarray, gain: np.ndarray, rows: int) -> np.ndarray:
    return np.bincount(row, gain, rows) / np.maximum(np.bincount(row, minlength=rows), 1)


def _evidence(shared, batch: pa.RecordBatch) -> np.ndarray:
    model: ToxicityModel = shared.value
    row, pair, _, rows = _expressions(batch)
    gain = model.word_table[pair >> PAIR_BITS].astype(np.float64)
    at, known = places_in(model.pairs.keys, pair)
    gain[known] += model.pairs.gain[at[known]]
    return _mean(row, gain, rows)


def _evidence_without_own(model: ToxicityModel, batch: pa.RecordBatch) -> np.ndarray:
    """Evidence of counted texts as if their own words and bigrams had not been counted."""
    row, pair, times, rows = _expressions(batch)
    toxic = np.array(batch.column("label").to_pylist(), np.int64)
    keys, which, own = np.unique(row << CELLS | pair >> PAIR_BITS, return_inverse=True, return_counts=True)
    gain = model.words.without(keys & ((1 << CELLS) - 1), toxic[keys >> CELLS], own)[which]
    return _mean(row, gain + model.pairs.without(pair, toxic[row], times), rows)


def _measured(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            found = pa.array(_evidence_without_own(shared.value, batch))
            yield pa.RecordBatch.from_arrays([batch.column("label"), found], ["label", "evidence"])

    return run


def _scores(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            evidence = _evidence(shared, batch)
            columns = [batch.column("carried"), pa.array(shared.value.scores(evidence)), pa.array(evidence)]
            yield pa.RecordBatch.from_arrays(columns, ["carried", "score", "evidence"])

    return run


def fit_sigmoid(evidence: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Weight and bias of a logistic curve, Newton steps."""
    scale = evidence.std() + 1e-9
    x = np.stack([evidence / scale, np.ones(len(evidence))], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = sigmoid(x @ beta)
        grad = x.T @ (label - p) - 1e-3 * beta
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, grad)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(beta[0] / scale), float(beta[1])


def different_texts(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, label) of the smallest id of each different labelled text and label."""
    hashed = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("text_hash"))
    firsts = hashed.join(known, "doc_id").groupBy("text_hash", "label").agg(F.min("doc_id").alias("doc_id"))
    return firsts.select("doc_id", "label")


def word_order(pairs: DataFrame) -> Order:
    """Unigram order: the different words that each word cell follows in each class."""
    counts = pairs.groupBy(F.shiftright("pair", PAIR_BITS).alias("cell")).agg(
        F.count_if(F.col("ordinary") > 0).alias("ordinary"), F.count_if(F.col("toxic") > 0).alias("toxic")
    )
    counts = counts.toArrow()
    key = counts.column("cell").to_numpy()
    order = np.argsort(key)
    ordinary, toxic = (counts.column(c).to_numpy()[order].astype(float) for c in ("ordinary", "toxic"))
    share = float(toxic.sum() / max(ordinary.sum() + toxic.sum(), 1))
    low, high = class_factors(ordinary, toxic, share)
    return Order(key[order], (ordinary, toxic), share, high - low)


def wanted_pairs(pairs: DataFrame, share: float) -> np.ndarray:
    """Sorted keys of the bigrams that a class holds in more or fewer texts than chance."""
    both = F.col("ordinary") + F.col("toxic")
    away = F.abs(F.col("toxic") - both * share)
    chance = F.sqrt(both * (share * (1 - share)) + 1) * CHANCE
    least = both * (BLUR * min(share, 1 - share))
    return np.sort(pairs.where(away > chance + least).select("pair").toArrow().column(0).to_numpy())


def pair_order(texts: DataFrame, wanted: np.ndarray, share: float, words: Order) -> Order:
    """Bigram order: the different contexts of each wanted bigram in each class."""
    if not len(wanted):
        return NO_ORDER
    bits = 63 - len(wanted).bit_length()
    shared = texts.sparkSession.sparkContext.broadcast(wanted)
    found = texts.select("text", "label").mapInArrow(_contexts(shared, bits), KEYED)
    once = found.groupBy("pair").agg(F.max("ordinary").alias("ordinary"), F.max("toxic").alias("toxic"))
    counts = (
        once.groupBy(F.shiftright("pair", bits).alias("place"))
        .agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))
        .toArrow()
    )
    ordinary, toxic = np.zeros(len(wanted)), np.zeros(len(wanted))
    place = counts.column("place").to_numpy()
    ordinary[place] = counts.column("ordinary").to_numpy()
    toxic[place] = counts.column("toxic").to_numpy()
    at, known = places_in(words.keys, wanted >> PAIR_BITS)
    odds = share / (1 - share) * np.exp(np.where(known, words.gain[at], 0.0))
    lower = odds / (1 + odds)
    low, high = class_factors(ordinary, toxic, lower)
    return Order(wanted, (ordinary, toxic), lower, high - low)


def train(
    docs: DataFrame, labels: DataFrame, learnable: Column | None = None, label: str = "toxic",
    calibration_rows: int = CALIBRATION_ROWS, broadcast_rows: int = BROADCAST_ROWS,
) -> ToxicityModel:
    """Models of both classes from every different labelled text that satisfies ``learnable``.

    Counts cover all labelled texts; only the two numbers of the final curve are fitted on
    about ``calibration_rows`` of them. Up to ``broadcast_rows`` labels (12 bytes each) are
    broadcast to the texts; more of them are joined by a shuffle. Without both classes the score is the share of
    label 1 (0.5 without labels).
    """
    spark = docs.sparkSession
    ship_package(spark)
    known = labels_of(labels, label)
    known = known.where(learnable) if learnable is not None else known
    known, known_path = stage(different_texts(docs, known))
    rows, share = known.agg(F.count("label"), F.avg("label")).first()
    if not rows or share in (0.0, 1.0):
        discard(spark, known_path)
        odds = np.clip(0.5 if not rows else share, 0.01, 0.99)
        return ToxicityModel(bias=float(np.log(odds / (1 - odds))))
    side = F.broadcast(known) if rows <= broadcast_rows else known.hint("shuffle_hash")
    texts = docs.select("doc_id", "text").join(side, "doc_id")
    pairs = texts.select("text", "label").mapInArrow(_pairs, KEYED)
    pairs = pairs.groupBy("pair").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))
    pairs, pairs_path = stage(pairs)
    model = ToxicityModel(word_order(pairs))
    ordinary, toxic = pairs.agg(F.sum("ordinary"), F.sum("toxic")).first()
    if ordinary and toxic:
        part = toxic / (ordinary + toxic)
        model.pairs = pair_order(texts, wanted_pairs(pairs, part), part, model.words)
    discard(spark, pairs_path)
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * min(1, calibration_rows / rows))
    sample = docs.select("doc_id", "text").join(F.broadcast(known.where(part)), "doc_id")
    shared = spark.sparkContext.broadcast(model)
    got = sample.select("text", "label").mapInArrow(_measured(shared), "label int, evidence double").toPandas()
    discard(spark, known_path)
    got = got.sort_values(["label", "evidence"], kind="stable")
    if got["label"].nunique() == 2:
        model.weight, model.bias = fit_sigmoid(got["evidence"].to_numpy(), got["label"].to_numpy())
    return model


def score(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, evidence) for every row of ``docs``.

    ``evidence`` is the mean difference of log-probabilities per word, 0 for null texts and
    texts without words. Repeated rows give a row each; other columns are ignored.
    """
    ship_package(docs.sparkSession)
    own = docs.select(F.col(doc_id).alias("carried"), F.col(text).alias("text"))
    kind = T.StructType(
        [own.schema["carried"], T.StructField("score", T.DoubleType()), T.StructField("evidence", T.DoubleType())]
    )
    none = (np.zeros(0), np.zeros(0))
    lean = [replace(o, counts=none, share=0.5, gain=o.gain.astype(np.float32)) for o in (model.words, model.pairs)]
    shared = docs.sparkSession.sparkContext.broadcast(replace(model, words=lean[0], pairs=lean[1]))
    return own.mapInArrow(_scores(shared), kind).withColumnRenamed("carried", "doc_id")
