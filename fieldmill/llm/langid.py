"""Language identification with interpolated Kneser-Ney character models.

Characters are folded to 64 classes (a-z, one for everything that is no letter, 37 for
all other letters), so a model of order 4 has at most 2**24 keys for each language,
however large the corpus. Counts come from all training texts. The highest order is kept
as sorted keys with one log-probability per language; a bit mask and a first place for
each context find a key in two reads. Lower orders are small full tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A
from .common import ship_package
from ..operators.ordered import quantiles, scalar_quantile
from ..session import staged

BITS = 6
CLASSES = 1 << BITS
CONTEXTS = CLASSES**3
UNDETERMINED = "und"
CALIBRATION = ["lang", "loss", "sizes", "costs"]
HEATS = np.geomspace(0.5, 500, 60)
FLUSH_KEYS = 1 << 21
_TABLE: list[np.ndarray] = []


def letter_classes() -> np.ndarray:
    """Class of each code point: 1-26 for a-z in either case, 27-63 other letters."""
    if not _TABLE:
        out = np.zeros(0x110000, np.uint8)
        for point in range(0x110000):
            sign = chr(point)
            if sign.isalpha():
                low = ord(sign.lower()[0])
                out[point] = low - 96 if 97 <= low <= 122 else 27 + low % 37
        _TABLE.append(out)
    return _TABLE[0]


def char_keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """4-gram keys of all texts, where each text's keys begin, letters per text.

    A text is read as blank, folded characters with runs of non-letters as one blank,
    blank; a text without letters has one key.
    """
    points = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    codes = letter_classes()[points]
    letters = A.row_sums((codes > 0).astype(np.int64), offsets)
    keep = codes > 0
    keep[1:] |= codes[:-1] > 0
    lead = offsets[:-1][np.diff(offsets) > 0]
    keep[lead] = codes[lead] > 0  # the padding is the blank before the first letter
    tail = offsets[1:][np.diff(offsets) > 0] - 1
    keep[tail] = codes[tail] > 0  # and after the last one
    kept = np.concatenate([[0], np.cumsum(keep)])[offsets]
    sizes = np.diff(kept) + 4  # three blanks before, one behind
    ends = np.cumsum(sizes)
    flat = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint32)
    row = np.repeat(np.arange(len(texts)), np.diff(kept))
    flat[np.arange(len(row)) + 4 * row + 3] = codes[keep]
    keys = flat.copy()
    for back in (1, 2, 3):
        keys[back:] |= flat[:-back] << np.uint32(BITS * back)
    inside = np.ones(len(flat), bool)
    for pad in range(3):
        inside[ends - sizes + pad] = False
    first = np.concatenate([[0], np.cumsum(sizes - 3)]).astype(np.int64)
    return keys[inside] & np.uint32((1 << 4 * BITS) - 1), first, letters


def _text_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        _, offsets = A.text_bytes(whole.column("text"))
        for a, b in A.row_blocks(offsets, A.CHUNK):
            yield whole.slice(a, b - a)


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column("text").to_pylist()]


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, inverse = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
    counts = np.concatenate([c for _, c in held])
    return keys, np.bincount(inverse, counts, len(keys)).astype(np.int64)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            keys, counts = _merged(parts)
            columns = [pa.array([lang] * len(keys)), pa.array(keys.astype(np.int32)), pa.array(counts)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "key", "n"])
        held.clear()

    for batch in _text_blocks(batches):
        keys, first, _ = char_keys(_texts(batch))
        langs = np.array(batch.column("lang").to_pylist(), object)
        for lang in set(langs.tolist()):
            mine = np.repeat(langs == lang, np.diff(first))
            held.setdefault(lang, []).append(np.unique(keys[mine], return_counts=True))
            if len(held[lang]) > 16:
                held[lang] = [_merged(held[lang])]
        if sum(len(k) for parts in held.values() for k, _ in parts) > FLUSH_KEYS:
            yield from flush()
    yield from flush()


@dataclass
class Models:
    """Log-probabilities of all languages and what was calibrated."""

    langs: list[str]
    mask: np.ndarray  # bit per next class, for each context of three
    place: np.ndarray  # first key of each context
    known: np.ndarray  # (languages, keys) log-probability
    back: np.ndarray  # (languages, contexts) log of the weight of the lower order
    lower: np.ndarray  # (languages, contexts) log-probability of order 3
    heat: float = 1.0
    centre: np.ndarray | None = None
    inner: np.ndarray | None = None
    outer: np.ndarray | None = None
    limit: float = np.inf

    def losses(self, keys: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character of each text in each language, and characters."""
        context = (keys >> np.uint32(BITS)).astype(np.int64)
        step = (keys & np.uint32(CLASSES - 1)).astype(np.uint64)
        mask = self.mask[context]
        seen = (mask >> step & np.uint64(1)).astype(bool)
        below = np.bitwise_count(mask & ((np.uint64(1) << step) - np.uint64(1)))
        at = (self.place[context] + below)[seen]
        short = (keys & np.uint32(CONTEXTS - 1)).astype(np.int64)[~seen]
        context = context[~seen]
        sizes = np.diff(first)
        out = np.empty((len(sizes), len(self.langs)))
        loss = np.empty(len(keys), np.float32)
        for n in range(len(self.langs)):
            loss[seen] = self.known[n][at]
            loss[~seen] = self.back[n][context] + self.lower[n][short]
            out[:, n] = -A.row_sums(loss.astype(np.float64), first) / np.maximum(sizes, 1)
        return out, sizes

    def judged(self, loss: np.ndarray, sizes: np.ndarray):
        """Best language, its probability, and whether its loss is out of range."""
        best = loss.argmin(axis=1)
        logits = -(loss - loss.min(axis=1, keepdims=True)) * sizes[:, None] / self.heat
        share = 1 / np.exp(logits).sum(axis=1)
        far = np.zeros(len(best), bool)
        if self.centre is not None:
            spread = np.sqrt(self.inner[best] / np.maximum(sizes, 1) + self.outer[best])
            far = (loss[np.arange(len(best)), best] - self.centre[best]) / spread > self.limit
        return best, share, far


def _discount(counts: np.ndarray) -> float:
    one, two = float((counts == 1).sum()), float((counts == 2).sum())
    return one / (one + 2 * two) if one and two else 0.5


def _order(keys: np.ndarray, counts: np.ndarray, width: int, lower: np.ndarray) -> np.ndarray:
    """Full table of one continuation order, interpolated with the order below it."""
    size = CLASSES**width
    full = np.bincount(keys, counts, size)
    by_context = full.reshape(-1, CLASSES)
    total = by_context.sum(axis=1, keepdims=True)
    cut = _discount(counts)
    kinds = (by_context > 0).sum(axis=1, keepdims=True)
    weight = np.where(total > 0, cut * kinds / np.maximum(total, 1), 1.0)
    below = np.tile(lower.reshape(-1, CLASSES), (max(len(by_context) // max(lower.size // CLASSES, 1), 1), 1))
    return (np.maximum(by_context - cut, 0) / np.maximum(total, 1) + weight * below).ravel()


def build_models(langs: list[str], keys: list[np.ndarray], counts: list[np.ndarray]) -> Models:
    """Interpolated Kneser-Ney tables from the 4-gram counts of each language."""
    union = np.unique(np.concatenate([np.zeros(0, np.int64), *keys]))
    context, step = union >> BITS, union & (CLASSES - 1)
    mask = np.zeros(CONTEXTS, np.uint64)
    np.bitwise_or.at(mask, context, np.uint64(1) << step.astype(np.uint64))
    place = np.searchsorted(context, np.arange(CONTEXTS)).astype(np.int32)
    known, backs, lowers = [], [], []
    for own, count in zip(keys, counts):
        three, n3 = np.unique(own & (CONTEXTS - 1), return_counts=True)
        two, n2 = np.unique(three & (CLASSES**2 - 1), return_counts=True)
        one, n1 = np.unique(two & (CLASSES - 1), return_counts=True)
        p1 = _order(one, n1, 1, np.full(CLASSES, 1 / CLASSES))
        p3 = _order(three, n3, 3, _order(two, n2, 2, p1))
        cut = _discount(count)
        total = np.bincount(own >> BITS, count, CONTEXTS)
        kinds = np.bincount(own >> BITS, minlength=CONTEXTS)
        back = np.where(total > 0, cut * kinds / np.maximum(total, 1), 1.0)
        full = np.zeros(len(union))
        full[np.searchsorted(union, own)] = np.maximum(count - cut, 0)
        p4 = full / np.maximum(total[context], 1) + back[context] * p3[union & (CONTEXTS - 1)]
        known.append(np.log(p4).astype(np.float32))
        backs.append(np.log(back).astype(np.float32))
        lowers.append(np.log(p3).astype(np.float32))
    return Models(langs, mask, place, np.array(known), np.array(backs), np.array(lowers))


def _scored(shared, calibrating: bool, place: int | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models: Models = shared.value
        costs = np.zeros(len(HEATS))
        for batch in _text_blocks(A.with_text(batches, place)):
            keys, first, letters = char_keys(_texts(batch))
            loss, sizes = models.losses(keys, first)
            if calibrating:
                own = np.array([models.langs.index(x) for x in batch.column("lang").to_pylist()], np.int64)
                nothing = pa.nulls(len(own), pa.list_(pa.float64()))
                columns = [batch.column("lang"), pa.array(loss[np.arange(len(own)), own]), pa.array(sizes), nothing]
                yield pa.RecordBatch.from_arrays(columns, CALIBRATION)
                costs += _heat_costs(loss, sizes, own)
                continue
            best, share, far = models.judged(loss, sizes)
            told = letters > 0
            names = [models.langs[b] if t else UNDETERMINED for b, t in zip(best, told)]
            columns = [
                batch.column("carried"),
                pa.array(names),
                pa.array(np.where(told, share, 0.0)),
                pa.array(np.where(told, loss[np.arange(len(best)), best], np.nan)),
                pa.array(far | ~told),
            ]
            yield pa.RecordBatch.from_arrays(
                columns, ["carried", "lang_pred", "score", "loss", "rejected"]
            )
        if calibrating:
            last = [None], [None], [None], [costs.tolist()]
            kinds = pa.string(), pa.float64(), pa.int64(), pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(last, kinds)], CALIBRATION)

    return run


def _heat_costs(loss: np.ndarray, sizes: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Sum over the rows of the log loss at each temperature."""
    gap = -(loss - loss.min(axis=1, keepdims=True)) * sizes[:, None]
    mine = gap[np.arange(len(own)), own]
    return np.array([(np.log(np.exp(gap / h).sum(axis=1)) - mine / h).sum() for h in HEATS])


def calibrate(models: Models, own: DataFrame, slack: float) -> None:
    """Temperature of the probabilities, and the range of a language's own loss.

    All rows of ``own`` (lang, text) count. Their texts are scored once, with the costs of
    all temperatures added up in each task; what is written is a language and two numbers
    a row. Medians and the last quantile are exact and come from slices of the sort order.
    """
    shared = own.sparkSession.sparkContext.broadcast(models)
    kinds = "lang string, loss double, sizes long, costs array<double>"
    told = staged(own.mapInArrow(_scored(shared, True), kinds))
    shared.destroy()
    costs = told.select(F.posexplode("costs").alias("at", "cost")).groupBy("at").agg(F.sum("cost").alias("cost"))
    models.heat = float(HEATS[min((r["cost"], r["at"]) for r in costs.collect())[1]])
    count = len(models.langs)
    models.centre, models.inner, models.outer = np.zeros(count), np.ones(count), np.zeros(count)

    def medians(rows: DataFrame, column: str) -> np.ndarray:
        found = {r["lang"]: r["q"] for r in quantiles(rows, column, {"q": 0.5}, ["lang"]).collect()}
        return np.array([found[x] for x in models.langs])

    def by_lang(values: np.ndarray) -> Column:
        # no join, which would deal the rows by language
        pairs = [F.lit(v) for n, x in enumerate(models.langs) for v in (x, float(values[n]))]
        return F.create_map(*pairs)[F.col("lang")]

    rows = told.where("lang is not null").select("lang", "loss", "sizes")
    models.centre = medians(rows, "loss")
    away = F.col("loss") - by_lang(models.centre)
    square = F.pow(away, 2)
    rows = rows.withColumns({"square": square, "scaled": square * F.col("sizes")})
    # a short text varies with its length, a long one with its topic
    models.inner = medians(rows, "scaled") / 0.455 + 1e-6
    models.outer = medians(rows, "square") / 0.455 + 1e-9
    spread = F.sqrt(by_lang(models.inner) / F.col("sizes") + by_lang(models.outer))
    far = rows.select((away / spread).alias("far"))
    models.limit = float(scalar_quantile(far, "far", 0.999, "linear") * slack)


def train(
    docs: DataFrame, lang: str = "lang", text: str = "text", slack: float = 2.0,
) -> Models:
    """Models of all languages from every row with text and language.

    Counts, temperature and rejection range cover all rows; a text is rejected when its
    standardised loss exceeds ``slack`` times the 99.9 % point of theirs.
    """
    spark = docs.sparkSession
    ship_package(spark)
    own = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    own = own.where("lang is not null and text is not null")
    grams = own.mapInArrow(_counts, "lang string, key int, n long")
    counted = grams.groupBy("lang", "key").agg(F.sum("n").alias("n")).toArrow()
    names = np.array(counted.column("lang").to_pylist(), object)
    keys, n = counted.column("key").to_numpy().astype(np.int64), counted.column("n").to_numpy()
    order = np.argsort(keys, kind="stable")
    names, keys, n = names[order], keys[order], n[order]
    langs = sorted(set(names.tolist()))
    models = build_models(langs, [keys[names == x] for x in langs], [n[names == x] for x in langs])
    if langs:
        calibrate(models, own, slack)
    return models


def _judged(docs: DataFrame, models: Models, doc_id: str | None, text: str) -> DataFrame:
    """Verdicts beside the id, or beside whole rows, whose text is then not sent twice."""
    if doc_id is None:
        own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("carried"))
        place = docs.columns.index(text)
    else:
        own, place = docs.select(F.col(doc_id).alias("carried"), F.col(text).alias("text")), None
    added = {"lang_pred": T.StringType(), "score": T.DoubleType(), "loss": T.DoubleType(), "rejected": T.BooleanType()}
    if not models.langs:
        nothing = (UNDETERMINED, 0.0, float("nan"), True)
        return own.select("carried", *(F.lit(v).alias(c) for c, v in zip(added, nothing)))
    kind = T.StructType(
        [own.schema["carried"], *(T.StructField(c, t) for c, t in added.items())]
    )
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(models)
    return own.mapInArrow(_scored(shared, False, place), kind)


def identify(docs: DataFrame, models: Models, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, loss, rejected) for every row of ``docs``.

    ``lang_pred`` is ``und``, score 0 and rejected if the text is null or has no letter, or
    if no language was learned. A text that lies out of the range of its best language is
    rejected, but keeps the prediction. Repeated rows give a row each; other columns are
    ignored.
    """
    return _judged(docs, models, doc_id, text).withColumnRenamed("carried", "doc_id")


def keep_identified(docs: DataFrame, models: Models, text: str = "text") -> DataFrame:
    """``docs``, all columns, without the rows that identification rejects."""
    found = _judged(docs, models, None, text)
    return found.where("not rejected").select("carried.*")
