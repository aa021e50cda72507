"""Quality of texts: random-indexing word vectors, pooled, and a two-layer network.

Random indexing: every hashed word has a sparse random index vector (+1 and -1 in a few
places); its context vector is the sum of the index vectors of its neighbours in the
whole corpus. 2**15 hashed words of 64 numbers are 8 MB, however large the corpus. A text
is pooled from its words' unit context vectors. The network is fitted on a
bounded sample of labelled texts; a temperature is fitted on a part it has not seen.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A
from .common import ship_package
from .labelled import labels_of, log_loss, sigmoid

WORDS = 1 << 15
DIMS = 64
MARKS = 4  # places of an index vector
REACH = 2  # neighbours on either side
SLICES = 32
SAMPLE_ROWS = 20_000
HIDDEN = 32
EPOCHS = 30
POOL_CHUNK = 1 << 16
INPUTS = 3 * DIMS + 1
KINDS = A.word_and_symbol_kinds()


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of every word's index vector."""
    draw = np.random.Generator(np.random.PCG64(5))
    places = np.argsort(draw.random((WORDS, DIMS), np.float32), axis=1)[:, :MARKS].astype(np.int64)
    return places, np.tile(np.array([1, -1], np.int32), MARKS // 2)


def hashed_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words (runs of letters and digits, runs of symbols) of all rows."""
    data, offsets = A.text_bytes(column)
    starts, ends, first = A.word_spans(data, offsets, KINDS)
    return (A.span_hashes(data, starts, ends) >> A.U(49)).astype(np.int64), first


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        _, offsets = A.text_bytes(whole.column("text"))
        for a, b in A.row_blocks(offsets, A.CHUNK):
            yield whole.slice(a, b - a)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    places, signs = index_vectors()
    table = np.zeros((WORDS, DIMS), np.int64)
    flat, any_row = table.reshape(-1), False
    for batch in _blocks(batches):
        any_row = True
        words, first = hashed_words(batch.column("text"))
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        for back in range(1, REACH + 1):
            same = row[back:] == row[:-back]
            left, right = words[:-back][same], words[back:][same]
            for mark in range(MARKS):
                sign = int(signs[mark])
                np.add.at(flat, left * DIMS + places[right, mark], sign)
                np.add.at(flat, right * DIMS + places[left, mark], sign)
    if any_row:
        for number, part in enumerate(np.split(table, SLICES)):
            if part.any():
                small = part.astype(np.int32) if np.abs(part).max() < 2**31 else part
                kind = b"i" if small.dtype == np.int32 else b"l"
                cells = kind + zlib.compress(small.tobytes(), 1)
                yield pa.RecordBatch.from_pydict({"slice": [number], "cells": [cells]})


def _unit_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for number, cells in zip(batch.column("slice").to_pylist(), batch.column("cells").to_pylist()):
            kind = np.int32 if cells[:1] == b"i" else np.int64
            part = np.frombuffer(zlib.decompress(cells[1:]), kind)
            if number in sums:
                sums[number] += part
            else:
                sums[number] = part.astype(np.int64)
    for number, part in sums.items():
        part = part.reshape(-1, DIMS).astype(np.float64)
        unit = part / np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1.0)
        yield pa.RecordBatch.from_pydict({"slice": [number], "cells": [unit.astype(np.float32).tobytes()]})


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Unit context vectors of all hashed words, from every row of ``docs``.

    A slice of the words meets in one task, so the driver gets its vectors as they stay,
    in Arrow batches: pickled rows of 64-bit sums took many times their size in its heap.
    """
    ship_package(docs.sparkSession)
    kind = "slice long, cells binary"
    parts = docs.select(F.col(text).alias("text")).mapInArrow(_contexts, kind)
    out = np.zeros((WORDS, DIMS), np.float32)
    size = WORDS // SLICES
    for batch in parts.repartition("slice").mapInArrow(_unit_vectors, kind).toArrow().to_batches():
        for number, cells in zip(batch.column("slice").to_pylist(), batch.column("cells")):
            at = number * size
            out[at : at + size] = np.frombuffer(cells.as_buffer(), np.float32).reshape(size, DIMS)
    return out


def pooled(words: np.ndarray, first: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """What a text's word vectors add up to; a text without words gives zeros.

    Mean and standard deviation of each dimension, mean product with the next word's
    vector (large where words repeat), and the logarithm of the number of words.
    """
    rows = len(first) - 1
    sums, squares, pairs = (np.zeros((rows, DIMS)) for _ in range(3))
    last = np.zeros(len(words) + 1, bool)
    last[first[1:] - 1] = True
    for at in range(0, len(words), POOL_CHUNK):
        end = min(at + POOL_CHUNK, len(words))
        got = vectors[words[at : end + 1]]
        beside = np.zeros((end - at, DIMS), np.float32)
        both = min(end + 1, len(words)) - 1 - at
        beside[:both] = got[:both] * got[1 : both + 1]
        beside[last[at:end]] = 0
        got = got[: end - at]
        a = int(np.searchsorted(first, at, "right")) - 1
        b = int(np.searchsorted(first, end, "left"))
        cuts = np.clip(first[a : b + 1], at, end) - at
        sums[a:b] += A.row_sums(got, cuts)
        squares[a:b] += A.row_sums(got * got, cuts)
        pairs[a:b] += A.row_sums(beside, cuts)
    size = np.diff(first)[:, None]
    count = np.maximum(size, 1)
    mean = sums / count
    spread = np.sqrt(np.maximum(squares / count - mean * mean, 0))
    return np.hstack([mean, spread, pairs / np.maximum(size - 1, 1), np.log1p(size)])


@dataclass
class Network:
    """Standardised inputs, one hidden layer, one logit, a temperature."""

    centre: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    heat: float = 1.0

    def logits(self, inputs: np.ndarray) -> np.ndarray:
        hidden = np.tanh((inputs - self.centre) / self.scale @ self.first + self.first_bias)
        return hidden @ self.second + self.second_bias

    def scores(self, inputs: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(inputs) / self.heat)


def fit_network(inputs: np.ndarray, target: np.ndarray, held: np.ndarray, seed: int = 3) -> Network:
    """Adam on the rows not ``held``; temperature on the ``held`` ones.

    Without rows of both labels the score is the share of label 1 (0.5 without rows).
    """
    width = INPUTS
    if len(target) == 0 or target.min() == target.max():
        share = np.clip(target.mean() if len(target) else 0.5, 0.01, 0.99)
        zero = np.zeros((width, 1))
        bias = float(np.log(share / (1 - share)))
        return Network(np.zeros(width), np.ones(width), zero, np.zeros(1), np.zeros(1), bias)
    draw = np.random.Generator(np.random.PCG64(seed))
    train = ~held if (~held).any() else np.ones(len(target), bool)
    x, y = inputs[train], target[train].astype(float)
    net = Network(
        x.mean(axis=0), x.std(axis=0) + 1e-6,
        draw.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN),
        draw.normal(0, HIDDEN**-0.5, HIDDEN), 0.0,
    )
    x = (x - net.centre) / net.scale
    bias = np.zeros(1)
    weights = [net.first, net.first_bias, net.second, bias]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    step = 0
    for epoch in range(EPOCHS):
        order = draw.permutation(len(x))
        rate = 0.003 * (1 - epoch / EPOCHS) + 0.0002
        for at in range(0, len(x), 256):
            some = order[at : at + 256]
            hidden = np.tanh(x[some] @ net.first + net.first_bias)
            error = (sigmoid(hidden @ net.second + bias[0]) - y[some]) / len(some)
            inner = np.outer(error, net.second) * (1 - hidden * hidden)
            grads = [x[some].T @ inner, inner.sum(axis=0), hidden.T @ error, np.array([error.sum()])]
            step += 1
            for weight, grad, (one, two) in zip(weights, grads, moments):
                grad = grad + 1e-5 * weight
                one += 0.1 * (grad - one)
                two += 0.001 * (grad * grad - two)
                weight -= rate * (one / (1 - 0.9**step)) / (np.sqrt(two / (1 - 0.999**step)) + 1e-8)
    net.second_bias = float(bias[0])
    if held.any():
        logits = net.logits(inputs[held])
        heats = np.geomspace(0.2, 20, 80)
        net.heat = float(heats[int(np.argmin([log_loss(logits / h, target[held]) for h in heats]))])
    return net


def _features(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            words, first = hashed_words(batch.column("text"))
            inputs = pooled(words, first, shared.value).astype(np.float32)
            packed = pa.array([row.tobytes() for row in inputs], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("held"), packed], ["label", "held", "inputs"]
            )

    return run


def _scores(shared, place: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, net = shared.value
        for batch in _blocks(A.with_text(batches, place)):
            words, first = hashed_words(batch.column("text"))
            score = net.scores(pooled(words, first, vectors))
            yield pa.RecordBatch.from_arrays([batch.column("carried"), pa.array(score)], ["carried", "score"])

    return run


@dataclass
class QualityModel:
    vectors: np.ndarray
    net: Network


def train(
    docs: DataFrame, labels: DataFrame, learnable: Column | None = None, label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> QualityModel:
    """Word vectors from all ``docs``; the network from about ``sample_rows`` labelled ones.

    The sample is drawn by a hash of the id among labels that satisfy ``learnable`` (a
    condition on doc_id); all labelled rows are taken while there are fewer.
    """
    spark = docs.sparkSession
    vectors = word_vectors(docs)
    known = labels_of(labels, label)
    known = known.where(learnable) if learnable is not None else known
    rows = known.count()
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    limit = (1 << 30) if rows <= sample_rows else int((1 << 30) * sample_rows / rows)
    # about sample_rows ids, so the broadcast side is bounded
    chosen = F.broadcast(known.where(part < limit))
    texts = docs.select("doc_id", "text").join(chosen, "doc_id")
    held = (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held")
    shared = spark.sparkContext.broadcast(vectors)
    got = texts.select("text", "label", held).mapInArrow(
        _features(shared), "label int, held boolean, inputs binary"
    ).toArrow()
    shared.destroy()
    # bytes in one block: about sample_rows times INPUTS floats; the order of rows is not fixed
    packed = sorted(zip(got.column("inputs").to_pylist(), got.column("label").to_pylist(), got.column("held").to_pylist()))
    inputs = np.frombuffer(b"".join(p for p, _, _ in packed), np.float32).reshape(len(packed), INPUTS)
    target, held = (np.array([p[k] for p in packed], kind) for k, kind in ((1, np.int64), (2, bool)))
    del got, packed
    net = fit_network(inputs, target, held)
    return QualityModel(vectors, net)


def _judged(docs: DataFrame, model: QualityModel, doc_id: str | None, text: str) -> DataFrame:
    """Scores beside the id, or beside whole rows, whose text is then not sent twice."""
    ship_package(docs.sparkSession)
    if doc_id is None:
        own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("carried"))
        place = docs.columns.index(text)
    else:
        own, place = docs.select(F.col(doc_id).alias("carried"), F.col(text).alias("text")), None
    kind = T.StructType([own.schema["carried"], T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast((model.vectors, model.net))
    return own.mapInArrow(_scores(shared, place), kind)


def score(docs: DataFrame, model: QualityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) for every row of ``docs``; 1 is the label 1 for sure.

    Null, empty and blank texts have no words and get the score of pooled zeros. Repeated
    rows give a row each; other columns are ignored.
    """
    return _judged(docs, model, doc_id, text).withColumnRenamed("carried", "doc_id")


def keep_good(docs: DataFrame, model: QualityModel, least: float, text: str = "text") -> DataFrame:
    """``docs``, all columns, without the rows that score below ``least``."""
    found = _judged(docs, model, None, text)
    return found.where(F.col("score") >= least).select("carried.*")
