"""Mergeable sketches of columns: distinct counts and quantiles of written parts.

One row of sketches for each part (a day, a source); any set of parts is united without
reading the rows again. Sketches have a fixed size, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DISTINCT_BITS = 14  # 2^14 registers: a relative standard error of about 0.8 %
QUANTILE_K = 400
RANK_ERROR = 0.01  # of the rows, for QUANTILE_K, also after any number of unions


def _long(df: DataFrame, keys: Sequence[str], columns: Sequence[str], kind: str) -> DataFrame:
    """(keys, column, value): one row for each value, so that any column meets one aggregate."""
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("value")) for c in columns))
    return df.select(*keys, F.explode(pairs).alias("p")).select(*keys, "p.column", "p.value")


def distinct_sketches(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), bits: int = DISTINCT_BITS
) -> DataFrame:
    """(by, column, rows, sketch): distinct values of every column in each part, in one pass.

    Nulls are no value; a part whose values are all null has an empty sketch.
    """
    return (
        _long(df, by, columns, "string")
        .groupBy(*by, "column")
        .agg(F.count("*").alias("rows"), F.hll_sketch_agg("value", bits).alias("sketch"))
    )


def united_distincts(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, column, rows, distinct_estimate) of written sketches, united over all other parts."""
    return sketches.groupBy(*by, "column").agg(
        F.sum("rows").alias("rows"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"),
    )


def quantile_sketches(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), k: int = QUANTILE_K
) -> DataFrame:
    """(by, column, n, sketch): quantile sketches of numeric columns in each part.

    Nulls and values that are not numbers are left out; a part without any has no row.
    """
    rows = _long(df, by, columns, "double").where("value is not null and not isnan(value)")
    return rows.groupBy(*by, "column").agg(
        F.count("*").alias("n"), F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch")
    )


def united_quantiles(
    sketches: DataFrame, shares: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """(by, column, n, share, estimate): quantiles of written sketches, united over all other parts."""
    merged = sketches.groupBy(*by, "column").agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch")
    )
    wanted = F.array(*(F.lit(float(share)) for share in shares))
    found = F.kll_sketch_get_quantile_double("sketch", wanted)
    pairs = F.arrays_zip(wanted.alias("share"), found.alias("estimate"))
    return merged.select(*by, "column", "n", F.explode(pairs).alias("q")).select(*by, "column", "n", "q.*")
