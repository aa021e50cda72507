"""Shared small helpers of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package  # noqa: F401


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % F.lit(parts)


def stage(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` written below the shared folder and read back, and its path."""
    path = scratch_path(df.sparkSession, "llm")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged table that no frame needs any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) for every node of an edge table; root is the smallest node.

    Alternating stars: every node hands its larger neighbours, then its smaller
    ones, to the smallest node it knows, until nothing changes. Each round is one
    table in the shared folder, so lost executors cost a read. No node or edge
    reaches the driver, only the row count and a checksum of a round.
    """
    spark = edges.sparkSession
    now = edges.select(
        F.greatest(left, right).alias("a"), F.least(left, right).alias("b")
    ).where("a <> b")
    now, path = stage(now.distinct())
    seen = None
    while True:
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        low = low.select("a", F.least("a", "m").alias("m"))
        large = (
            both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e")
        )
        small = small.select(F.col("e.a").alias("a"), F.col("e.m").alias("b")).where("a <> b")
        new, new_path = stage(small.distinct())
        state = new.agg(F.count("a"), F.bit_xor(F.xxhash64("a", "b"))).first()
        discard(spark, path)
        now, path = new, new_path
        if state == seen or not state[0]:
            break
        seen = state
    roots = now.select(F.col("b").alias("a"), "b").distinct()
    return now.unionByName(roots).select(F.col("a").alias("node"), F.col("b").alias("root"))
