"""Profiling and grouped summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import numeric_columns
from .ordered import quantiles

FIVE = {"minimum": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "maximum": 1.0}


def long_form(
    row: DataFrame, columns: Sequence[str], variable: str = "variable", value: str = "value",
    ids: Sequence[str] = (),
) -> DataFrame:
    """Wide statistics to (variable, value) rows."""
    return row.unpivot(list(ids), list(columns), variable, value)


def time_span(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("min_date"), F.max(column).alias("max_date"))


def distinct_counts(
    df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False
) -> DataFrame:
    """Distinct non-null values of every column, in one row.

    The exact form expands each row once per column before it reduces them; the
    approximate form keeps one small sketch per column and task.
    """
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*(count(F.col(f"`{c}`")).alias(c) for c in columns or df.columns))


def _missing(df: DataFrame, column: str) -> Column:
    c = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls (and NaN in float columns) per column as ``{col}_missing``."""
    return df.agg(
        *(
            F.coalesce(F.sum(_missing(df, c).cast("long")), F.lit(0)).alias(f"{c}_missing")
            for c in columns or df.columns
        )
    )


def missing_shares(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.agg(
        *(F.avg(_missing(df, c).cast("int")).alias(c) for c in columns or df.columns)
    )


def static_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns with exactly one distinct non-null value.

    Smallest and largest value agree then, which needs no distinct count.
    """
    return [r["variable"] for r in static_table(df, columns).collect()]


def static_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same as a table ``(variable)``: at most one row per column."""
    if not columns:
        return df.sparkSession.createDataFrame([], "variable string")
    same = df.agg(
        *(
            F.coalesce(F.min(F.col(f"`{c}`")) == F.max(F.col(f"`{c}`")), F.lit(False)).alias(c)
            for c in columns
        )
    )
    return long_form(same, columns).where("value").select("variable")


def spreads(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Sample standard deviation of every numeric column, in one row."""
    return df.agg(
        *(F.stddev_samp(F.col(f"`{c}`")).alias(c) for c in columns or numeric_columns(df))
    )


def value_counts(df: DataFrame, *columns: str, name: str = "count") -> DataFrame:
    """Group sizes, largest first, ties by value."""
    return (
        df.groupBy(*columns)
        .agg(F.count("*").alias(name))
        .orderBy(F.desc(name), *columns)
    )


def counts_with_share(df: DataFrame, column: str, digits: int = 4) -> DataFrame:
    """Group sizes with their share of all rows."""
    grouped = df.groupBy(column).agg(F.count("*").alias("count"))
    total = grouped.agg(F.sum("count")).scalar()
    return grouped.withColumn("percent", F.round(F.col("count") / total, digits)).orderBy(
        F.desc("count"), column
    )


def proportions(df: DataFrame, column: str, target: str) -> DataFrame:
    """Share of each target value within each category.

    The window runs over the grouped rows, one per (category, target).
    """
    counted = df.groupBy(column, target).agg(F.count("*").alias("count"))
    total = F.sum("count").over(Window.partitionBy(column))
    return (
        counted.withColumn("total", total)
        .withColumn("proportion", F.col("count") / F.col("total"))
        .orderBy(column, target)
    )


def target_rate(df: DataFrame, column: str, target: str) -> DataFrame:
    return df.groupBy(column).agg(F.avg(F.col(target).cast("double")).alias(target))


def popularity(
    df: DataFrame, by: str, title: str, metrics: Sequence[str]
) -> DataFrame:
    """Rows, distinct titles, and total and average of each known metric.

    With a single distinct column Spark first reduces per (group, title) and
    carries the sums along, so no group has to fit into one task. The struct
    makes a null title count as one value.
    """
    known = [m for m in metrics if m in df.columns]
    return (
        df.groupBy(by)
        .agg(
            F.count("*").alias("trending_count"),
            F.count_distinct(F.struct(title)).alias("number_of_trending_videos"),
            *(F.sum(m).alias(f"total_{m}") for m in known),
            *(F.avg(m).alias(f"average_{m}") for m in known),
        )
        .orderBy(F.desc("trending_count"), by)
    )


def frequent_means(
    df: DataFrame, by: str, threshold: int, metric: str
) -> DataFrame:
    """Mean metric of groups with at least ``threshold`` rows, smallest first."""
    return (
        df.groupBy(by)
        .agg(F.count("*").alias("__rows"), F.avg(metric).alias(metric))
        .where(F.col("__rows") >= threshold)
        .drop("__rows")
        .orderBy(metric, by)
    )


def lifecycle(
    df: DataFrame,
    id_col: str,
    day: str,
    lag: str,
    max_lag: int,
    features: Sequence[str] = (),
    prefer: Sequence[str] = (),
) -> DataFrame:
    """First and last day, days between, and smallest lag of every entity.

    Entities whose lag exceeds ``max_lag`` are left out. ``features`` are taken
    from the entity's row on the first day; of several rows the first by
    ``prefer`` counts. All of it is one aggregation, with no join back.
    """
    date = F.to_date(day)
    aggregates = [
        F.min(lag).alias(lag),
        F.min(date).alias("first_day_in_trending"),
        F.max(date).alias("last_day_in_trending"),
        F.datediff(F.max(date), F.min(date)).alias("days_in_trending"),
    ]
    if features:
        order = F.when(
            date.isNotNull(), F.struct(date.alias("__day"), *(prefer or features))
        )
        # without preferences the smallest order holds the features already
        first = F.min_by(F.struct(*features), order) if prefer else F.min(order)
        aggregates.append(first.alias("__first"))
    out = df.groupBy(id_col).agg(*aggregates).where(F.col(lag) <= max_lag)
    if not features:
        return out
    taken = [c for c in features if c not in (id_col, lag)]
    return out.select(
        *(c for c in out.columns if c != "__first"),
        *(F.col("__first")[c].alias(c) for c in taken),
    )


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, nulls, mean, std, min, quartiles and max, one row per column."""
    columns = list(columns or numeric_columns(df))
    stacked = long_form(df.select(*(F.col(c).cast("double").alias(c) for c in columns)), columns)
    moments = stacked.groupBy("variable").agg(
        F.count("value").alias("count"),
        F.sum(F.col("value").isNull().cast("long")).alias("null_count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quarters = quantiles(
        stacked, "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, ["variable"]
    )
    return moments.join(quarters, "variable", "left")


def five_numbers(df: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """Minimum, quartiles and maximum of ``column`` per group."""
    return quantiles(df, column, FIVE, by)


def quantile_edges(df: DataFrame, column: str, bins: int) -> list[float]:
    """Inner edges of equally filled bins, repeated edges collapsed."""
    names = {f"e{i}": i / bins for i in range(1, bins)}
    row = quantiles(df, column, names).first()
    return sorted({row[n] for n in names}) if row is not None else []


def bin_number(column: str, edges: Sequence[float]) -> Column:
    """Index of the right-closed bin of each value; null stays null."""
    c = F.col(column)
    number = F.lit(0)
    for edge in edges:
        number = number + (c > F.lit(float(edge))).cast("int")
    return number


def five_numbers_by_bin(
    df: DataFrame, bin_col: str, column: str, target: str, bins: int = 10
) -> DataFrame:
    """Box-plot numbers of ``column`` per quantile bin of ``bin_col`` and target."""
    edges = quantile_edges(df, bin_col, bins)
    binned = df.withColumn("bin", bin_number(bin_col, edges))
    return five_numbers(binned, column, ["bin", target])


def histogram(
    df: DataFrame, column: str | Column, low: float, high: float, bins: int,
    by: str | None = None,
) -> DataFrame:
    """Counts in equally wide bins (the top bin is closed), with shares per class.

    Bin 0 holds what lies below ``low`` and bin ``bins + 1`` what lies above ``high``, so
    shares are of all rows with a value.
    """
    value = F.col(column) if isinstance(column, str) else column
    number = F.width_bucket(value, F.lit(low), F.lit(high), F.lit(bins))
    number = F.when(value == high, F.lit(bins)).otherwise(number)
    inside = df.where(value.isNotNull()).withColumn("bin", number.cast("int"))
    keys = [by] if by else []
    counted = inside.groupBy(*keys, "bin").agg(F.count("*").alias("count"))
    share = F.col("count") / F.sum("count").over(Window.partitionBy(*keys))
    return counted.withColumn("share", share)


def timed_counts(
    df: DataFrame, time_col: str, units: Sequence[str], label: str
) -> DataFrame:
    """Events per label and time bucket for several units, in time order."""
    buckets = F.array(
        *(
            F.struct(F.lit(u).alias("unit"), F.date_trunc(u, F.col(time_col)).alias("bucket"))
            for u in units
        )
    )
    return (
        df.select(label, F.explode(buckets).alias("b"))
        .groupBy("b.unit", "b.bucket", label)
        .agg(F.count("*").alias("counts"))
        .orderBy("unit", "bucket", label)
    )


def top_groups(
    df: DataFrame, key: str, aggregate: Column, name: str, k: int, largest: bool = True
) -> DataFrame:
    """The k groups with the largest (or smallest) aggregate, ties by key."""
    grouped = df.groupBy(key).agg(aggregate.alias(name))
    order = F.desc(name) if largest else F.asc(name)
    return grouped.orderBy(order, key).limit(k)


def best_row(df: DataFrame, metric: str, ties: Sequence[str] = ()) -> DataFrame:
    """Row with the largest metric; ties by the smallest ``ties``."""
    return df.orderBy(F.desc(metric), *ties).limit(1)


def latency_summary(df: DataFrame, column: str) -> DataFrame:
    """Median, 95th percentile and maximum."""
    return quantiles(df, column, {"median": 0.5, "p95": 0.95, "max": 1.0})


def most_frequent(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent non-null value per column as text; the smallest on ties.

    All columns are counted in one pass and reduced by a partial ``min_by``.
    """
    stacked = long_form(
        df.select(*(F.col(c).cast("string").alias(c) for c in columns)), columns
    ).where("value is not null")
    counted = stacked.groupBy("variable", "value").agg(F.count("*").alias("n"))
    return counted.groupBy("variable").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("value")
    )
