"""Shards by jump consistent hashing, with gapless places in every shard.

The jump hash needs no ring table: a linear congruential generator seeded by the key
says at which shard counts the key jumps, and the last jump below the number of shards
is its shard. With one shard more, a key either stays or moves into the new shard. All of
it is SQL arithmetic on 32-bit halves, since 64-bit products would overflow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MULTIPLIER = 2862933555777941757  # fixed value of the published algorithm
BLOCKS = 1024
ROW_BYTES = 16
_LOW, _HIGH, _MASK = MULTIPLIER & 0xFFFFFFFF, MULTIPLIER >> 32, 0xFFFFFFFF


def _low_product(x: str, y: str) -> str:
    """SQL for x * y modulo 2**32."""
    return f"((({x} & 65535L) * {y} + shiftleft((shiftright({x}, 16) * {y}) & 65535L, 16)) & {_MASK}L)"


def _next(hi: str, lo: str) -> tuple[str, str]:
    """SQL for both halves of key * MULTIPLIER + 1 modulo 2**64."""
    top = f"(shiftright({lo}, 16) * {_LOW}L)"
    low = f"(({lo} & 65535L) * {_LOW}L + shiftleft({top} & 65535L, 16) + 1L)"
    high = (
        f"((shiftright({low}, 32) + shiftright({top}, 16) + {_low_product(hi, f'{_LOW}L')}"
        f" + {_low_product(lo, f'{_HIGH}L')}) & {_MASK}L)"
    )
    return high, f"({low} & {_MASK}L)"


def jump_key(df: DataFrame, key: str) -> Column:
    """Whole numbers are their own keys, other values are hashed; null is one key."""
    whole = isinstance(df.schema[key].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    hashed = F.xxhash64(F.col(key))
    return F.coalesce(F.col(key).cast("long"), hashed) if whole else hashed


def jump_shard(key: str, shards: int) -> Column:
    """Shard of a bigint column, 0 to ``shards`` - 1."""
    hi, lo = _next("s.hi", "s.lo")
    jump = f"CAST((s.j + 1) * (2147483648D / (shiftright({hi}, 1) + 1)) AS BIGINT)"
    start = (
        f"named_struct('hi', shiftrightunsigned({key}, 32), 'lo', {key} & {_MASK}L,"
        " 'b', -1L, 'j', 0L)"
    )
    step = f"named_struct('hi', {hi}, 'lo', {lo}, 'b', s.j, 'j', {jump})"
    return F.expr(
        f"CAST(aggregate(sequence(1, {shards}), {start},"
        f" (s, i) -> IF(s.j >= {shards}, s, {step}), s -> s.b) AS INT)"
    )


def sharded(
    docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text", blocks: int = BLOCKS
) -> DataFrame:
    """Shard, shard with one more shard, and place in the shard of every row.

    Returns (doc_id, size, text_crc32, law, shard, grown_shard, slot). The id and the
    number of shards alone decide (law ``key``); all null ids share a shard. Size is the
    text's UTF-8 bytes plus 16, null text has none. Slots run from 0 without gaps, in the
    order of a hash block of the id, then id, checksum and size; so no task has to hold
    a whole shard. Repeated rows get a slot each. Other columns are ignored.
    """
    plain = F.coalesce(F.col(text), F.lit(""))
    keys = docs.select(
        F.col(doc_id).alias("doc_id"),
        jump_key(docs, doc_id).alias("key"),
        (F.octet_length(plain) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(plain).alias("text_crc32"),
    )
    hi, _ = _next("shiftrightunsigned(key, 32)", f"(key & {_MASK}L)")
    block = F.expr(f"CAST(shiftright({hi}, 1) % {blocks} AS INT)").alias("block")
    rows = keys.select(
        "doc_id", "size", "text_crc32", jump_shard("key", shards).alias("shard"),
        jump_shard("key", shards + 1).alias("grown_shard"), block,
    )
    # reads ids only
    counts = keys.select(jump_shard("key", shards).alias("shard"), block)
    counts = counts.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(
        Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = counts.select("shard", "block", F.coalesce(before, F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "block").orderBy("doc_id", "text_crc32", "size")
    placed = rows.withColumn("at", F.row_number().over(within)).join(starts, ["shard", "block"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "grown_shard",
        (F.col("start") + F.col("at") - 1).alias("slot"),
    )


def write_shards(docs: DataFrame, path: str, shards: int, doc_id: str = "doc_id") -> None:
    """Write ``docs`` as Parquet with one folder for each shard."""
    keyed = docs.withColumn("_key", jump_key(docs, doc_id))
    keyed = keyed.withColumn("shard", jump_shard("_key", shards)).drop("_key")
    keyed.write.partitionBy("shard").parquet(path)
