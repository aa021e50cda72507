"""Equi-joins on tables and lookups.

No broadcast hints: a side is broadcast by Spark itself when its measured size
is below the session threshold, otherwise the join shuffles and adaptive
execution splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_overlap(
    left: DataFrame, left_col: str, right: DataFrame, right_col: str
) -> DataFrame:
    """Distinct keys on each side and on both, in one row.

    One aggregation over both sides replaces two distincts and a join.
    """
    sides = left.select(
        F.col(left_col).alias("key"), F.lit(1).alias("in_left"), F.lit(0).alias("in_right")
    ).unionAll(
        right.select(
            F.col(right_col).alias("key"), F.lit(0).alias("in_left"), F.lit(1).alias("in_right")
        )
    )
    flags = sides.groupBy("key").agg(
        F.max("in_left").alias("in_left"), F.max("in_right").alias("in_right")
    )
    both = F.when(F.col("key").isNotNull(), F.col("in_left") * F.col("in_right"))
    return flags.agg(
        F.coalesce(F.sum("in_left"), F.lit(0)).alias("left_count"),
        F.coalesce(F.sum("in_right"), F.lit(0)).alias("right_count"),
        F.coalesce(F.sum(both), F.lit(0)).alias("both_count"),
    )


def one_row_per_key(
    df: DataFrame, keys: Sequence[str], prefer: Sequence[str]
) -> DataFrame:
    """First row of each key by the columns ``prefer`` (ascending).

    A partial ``min_by`` runs before the shuffle, so a frequent key sends one
    row per task instead of all of them.
    """
    keys, prefer = list(keys), list(prefer)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    first = F.min_by(F.struct(*rest), F.struct(*prefer)).alias("__row")
    return df.groupBy(*keys).agg(first).select(*keys, "__row.*").select(*df.columns)


def join_original_features(
    main: DataFrame,
    original: DataFrame,
    main_cols: Sequence[str],
    original_cols: Sequence[str],
    other_cols: Sequence[str],
    prefer: Sequence[str] | None = None,
) -> DataFrame:
    """Left join of ``other_cols`` on differently named keys, one row per key."""
    renamed = {o: f"__k{i}" for i, o in enumerate(original_cols)}
    features = one_row_per_key(
        original.select(*dict.fromkeys([*original_cols, *other_cols])),
        original_cols,
        prefer or [c for c in other_cols if c not in original_cols] or list(original_cols),
    )
    right = features.select(
        *(F.col(o).alias(k) for o, k in renamed.items()),
        *(c for c in other_cols if c not in main_cols),
    )
    on = [main[m] == right[k] for m, k in zip(main_cols, renamed.values())]
    return main.join(right, on, "left").drop(*renamed.values())


def mapped(
    df: DataFrame, column: str, lookup: DataFrame, key: str, value: str, name: str | None = None
) -> DataFrame:
    """Replace ``column`` (or add ``name``) by its lookup; unmatched becomes null.

    ``lookup`` must hold each key once.
    """
    target = name or column
    right = lookup.select(F.col(key).alias("__key"), F.col(value).alias("__value"))
    joined = df.join(right, df[column] == right["__key"], "left")
    columns = [
        F.col("__value").alias(c) if c == target else df[c] for c in df.columns
    ]
    if target not in df.columns:
        columns.append(F.col("__value").alias(target))
    return joined.select(*columns)


def mapped_from_dict(df: DataFrame, column: str, mapping: Mapping) -> DataFrame:
    """As :func:`mapped` for a small Python mapping, without a join."""
    if not mapping:
        return df.withColumn(column, F.lit(None).cast("string"))
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return df.withColumn(column, F.try_element_at(F.create_map(*pairs), F.col(column)))


def attach(df: DataFrame, aggregates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join of aggregates back onto rows by equal key names."""
    return df.join(aggregates, list(keys))


def coordinates(
    df: DataFrame, zip_col: str, places: DataFrame, code: str, longitude: str, latitude: str
) -> DataFrame:
    """Add ``longitude`` and ``latitude`` of five-character postal codes."""
    from ..functions.numbers import five_digits

    right = places.select(
        F.lpad(F.col(code).cast("string"), 5, "0").alias("__zip"),
        F.col(longitude).alias("longitude"),
        F.col(latitude).alias("latitude"),
    )
    return (
        df.withColumn("__own_zip", five_digits(zip_col))
        .join(right, F.col("__own_zip") == F.col("__zip"), "left")
        .drop("__own_zip", "__zip")
    )


def members(df: DataFrame, column: str, values: DataFrame, value_col: str | None = None) -> DataFrame:
    """Rows whose ``column`` occurs in a data-derived list (semi-join)."""
    right = values.select(F.col(value_col or column).alias("__value")).distinct()
    return df.join(right, df[column] == right["__value"], "left_semi")


def non_members(
    df: DataFrame, column: str, values: DataFrame, value_col: str | None = None
) -> DataFrame:
    """Rows whose ``column`` does not occur in a data-derived list (anti-join)."""
    right = values.select(F.col(value_col or column).alias("__value")).distinct()
    return df.join(right, df[column] == right["__value"], "left_anti")
