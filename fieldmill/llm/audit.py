"""How filters interact: what every order of five document filters removes.

1. Every task counts its texts in a sparse counting Bloom sketch: PROBES counters for
   the hash of each text. The sketches are added up by segment; only one bit of each
   counter, "two or more", is broadcast.
2. A text with a counter below two occurs once and is cleared inside the scan. Only the
   others, the possible repeats, are shuffled as whole texts for their exact smallest id.
3. Flags of all documents are one small mask; counts by (part, mask) are additive and
   give every figure of every order.

The sketch grows with the rows up to MOST_COUNTERS bits (128 MB); beyond that it clears a
smaller share of the texts, which costs shuffle but changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from .common import ship_package, stage

PROBES = 4
COUNTERS_PER_ROW = 16
SEGMENT = 1 << 22
MOST_COUNTERS = 1 << 30
FILTERS = "ABCDE"
REPEAT = 1 << FILTERS.index("E")


def positions(keys: np.ndarray, counters: int) -> np.ndarray:
    """Counters of every key, one column for each probe; ``counters`` is a power of two."""
    seeds = A.odd_numbers(PROBES, 41)
    mixed = A.mixed(keys.view(np.uint64)[:, None] * seeds)
    return (mixed & A.U(counters - 1)).astype(np.int64)


def _sketch(counters: int):
    """Per task the counters touched once and more often, by segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = more = np.zeros(0, np.int64)
        for batch in batches:
            at = np.sort(positions(batch.column(0).to_numpy(), counters), axis=1)
            fresh = np.ones(at.shape, bool)  # a key counts once in each of its counters
            fresh[:, 1:] = at[:, 1:] != at[:, :-1]
            cells, times = np.unique(np.concatenate([at[fresh], once]), return_counts=True)
            more = np.union1d(more, cells[times > 1])
            once = cells
        segment = once // SEGMENT
        first = np.flatnonzero(np.diff(segment, prepend=-1))
        for a, b in zip(first, np.append(first[1:], len(once))):
            twice = np.isin(once[a:b], more, assume_unique=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(segment[a])], pa.int64()),
                    pa.array([(once[a:b] % SEGMENT).astype(np.int32).tobytes()], pa.binary()),
                    pa.array([np.packbits(twice).tobytes()], pa.binary()),
                ],
                ["segment", "cells", "twice"],
            )

    return run


def _merge(size: int):
    """Counters of one segment from all tasks, as one bit each: two or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, bits, segment = np.zeros(size, bool), np.zeros(size, bool), None
        for batch in batches:
            segment = batch.column("segment")[:1]
            for cells, twice in zip(batch.column("cells"), batch.column("twice")):
                at = np.frombuffer(cells.as_py(), np.int32)
                own = np.unpackbits(np.frombuffer(twice.as_py(), np.uint8), count=len(at))
                bits[at[seen[at] | (own > 0)]] = True
                seen[at] = True
        yield pa.RecordBatch.from_arrays(
            [segment, pa.array([np.packbits(bits).tobytes()])],
            ["segment", "bits"],
        )

    return run


def repeat_sketch(keys: DataFrame, rows: int) -> np.ndarray:
    """Bits of the merged sketch of one column of 64-bit keys."""
    counters = 1 << 16
    while counters < min(COUNTERS_PER_ROW * rows, MOST_COUNTERS):
        counters *= 2
    size = min(SEGMENT, counters)
    parts = keys.mapInArrow(_sketch(counters), "segment long, cells binary, twice binary")
    merged = parts.groupBy("segment").applyInArrow(_merge(size), "segment long, bits binary")
    out = np.zeros((counters // size, size // 8), np.uint8)
    for row in merged.collect():  # at most MOST_COUNTERS bits
        out[row["segment"]] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


def possible_repeat(bits: np.ndarray, spark):
    """Column function: whether a key may occur more than once."""
    shared = spark.sparkContext.broadcast(bits)

    @F.arrow_udf("boolean")
    def probe(keys: pa.Array) -> pa.Array:
        held = shared.value
        at = positions(keys.to_numpy(zero_copy_only=False), len(held) * 8)
        hit = held[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1
        return pa.array(hit.all(axis=1))

    return probe


def text_flags(text: Column) -> Column:
    """Mask of the filters that look at one text alone: A, B, C and D."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n_words, distinct = F.size(words), F.size(F.array_distinct(words))
    failures = [
        n_words < 200,
        100 * distinct < 50 * n_words,
        100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 3 * F.char_length(text),
        text.rlike(r"[#$%&*|]"),
    ]
    bits = [F.when(fails, F.lit(1 << k)).otherwise(F.lit(0)) for k, fails in enumerate(failures)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def document_masks(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """(doc_id, part, mask, n): documents by id and failing filters, E included.

    Null text is empty, null part is the empty string. E: the text is that of a smaller
    id; rows that share an id and a text are no repeats of each other, and a row without
    an id neither is nor makes a repeat. Other columns are ignored.
    """
    spark = docs.sparkSession
    ship_package(spark)
    own = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("key", F.xxhash64("text"))
    probe = possible_repeat(repeat_sketch(own.select("key"), docs.count()), spark)
    repeated = (
        own.where("doc_id is not null")
        .select("doc_id", "key", "text")
        .where(probe("key"))
        .groupBy("text")
        .agg(F.min("doc_id").alias("doc_id"), F.min("key").alias("key"))
        .select("doc_id", "key", F.lit(True).alias("first"))
        .distinct()
    )
    flagged = own.select(
        "doc_id", "part", "key", text_flags(F.col("text")).alias("mask"), probe("key").alias("maybe")
    )
    flagged = flagged.groupBy("doc_id", "part", "key", "mask", "maybe").agg(
        F.count(F.lit(1)).alias("n")
    )
    late = F.col("maybe") & F.col("doc_id").isNotNull() & F.col("first").isNull()
    return flagged.join(repeated, ["doc_id", "key"], "left").select(
        "doc_id", "part", (F.col("mask") + F.when(late, REPEAT).otherwise(0)).alias("mask"), "n"
    )


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic). A document is good or toxic if any label row says 1."""
    known = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("is_good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("is_toxic"),
    )
    return (
        masks.join(known, "doc_id", "left")
        .groupBy("part", "mask")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.coalesce("is_good", F.lit(0))).alias("good"),
            F.sum(F.col("n") * F.coalesce("is_toxic", F.lit(0))).alias("toxic"),
        )
    )


def order_effects(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Every step of every order of the filters, for each part, from its mask counts.

    A document that fails m filters is removed by each of them in 1/m of all orders;
    ``shapley`` adds up these shares over all orders.
    """
    orders = ["".join(order) for order in permutations(filters)]
    failing = F.concat(
        *(F.when(F.col("mask").bitwiseAND(1 << k) != 0, f).otherwise("") for k, f in enumerate(filters))
    )
    every = (
        counts.withColumn("failing", failing)
        .withColumn("filter_order", F.explode(F.split(F.lit(" ".join(orders)), " ")))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))))
        .withColumn("own", F.substring("filter_order", F.col("step"), F.lit(1)))
        .withColumn("before", F.substring("filter_order", F.lit(1), F.col("step") - 1))
    )
    fails = F.contains("failing", "own")
    gone = F.expr("translate(failing, before, '')") != F.col("failing")
    share = F.col("n") * F.lit(len(orders)) / F.greatest(F.char_length("failing"), F.lit(1))
    values = {
        "kept": (~fails & ~gone, F.col("n")),
        "removed": (fails & ~gone, F.col("n")),
        "redundant": (fails & gone, F.col("n")),
        "unique_fails": (F.col("failing") == F.col("own"), F.col("n")),
        "good_lost": (fails & ~gone, F.col("good")),
        "toxic_lost": (fails & ~gone, F.col("toxic")),
        "shapley": (fails, share.cast("long")),
    }
    return every.groupBy("part", "filter_order", "step").agg(
        *(F.sum(F.when(c, v).otherwise(0)).cast("long").alias(m) for m, (c, v) in values.items())
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of ``docs`` by language; one row per part, order and step, zeros included.

    Without documents there are no parts and no rows. Masks are written once, below the
    shared folder, so that the 600 rows of a part do not repeat the scans.
    """
    counts, _ = stage(mask_counts(document_masks(docs), labels))
    return order_effects(counts)
