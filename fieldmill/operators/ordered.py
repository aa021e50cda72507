"""Cumulative totals and exact quantiles over data of any size.

A running total over a whole table, or over one group that holds most of it,
cannot be a plain window: one task would sort everything. Here the table is
first reduced to one row per distinct value, range-partitioned by (group,
value) and staged, so each partition is a slice of the sort order. A running
total is then the sum of all earlier slices (a window over a few rows per
group) plus a running total inside the slice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged

_GROUP, _SLICE = "__group", "__slice"


def _group(keys: Sequence[str]) -> Column:
    # A struct never is null itself, so null keys meet in an ordinary equi-join.
    return F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))


def _sliced(cells: DataFrame, keys: Sequence[str], sort: Column) -> DataFrame:
    """Cells in range partitions, with their partition number made permanent."""
    return staged(
        cells.withColumn(_GROUP, _group(keys))
        .repartitionByRange(_GROUP, sort)
        .withColumn(_SLICE, F.spark_partition_id())
    )


def _offsets(sliced: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Totals of earlier slices and of the whole group, per (group, slice)."""
    earlier = Window.partitionBy(_GROUP).orderBy(_SLICE).rowsBetween(
        Window.unboundedPreceding, -1
    )
    whole = Window.partitionBy(_GROUP)
    totals = sliced.groupBy(_GROUP, _SLICE).agg(
        *(F.sum(m).alias(f"__{m}_slice") for m in measures)
    )
    return totals.withColumns(
        {
            **{
                f"__{m}_before": F.coalesce(F.sum(f"__{m}_slice").over(earlier), F.lit(0))
                for m in measures
            },
            **{f"{m}_all": F.sum(f"__{m}_slice").over(whole) for m in measures},
        }
    )


def _running(
    cells: DataFrame,
    keys: Sequence[str],
    order: str,
    measures: Sequence[str],
    descending: bool,
    wanted: Column | None = None,
) -> DataFrame:
    """Running totals over cells; ``wanted`` may select slices by their offsets."""
    sort = F.col(order).desc() if descending else F.col(order).asc()
    sliced = _sliced(cells, keys, sort)
    offsets = _offsets(sliced, measures)
    if wanted is not None:
        offsets = offsets.where(wanted)
    inside = Window.partitionBy(_GROUP, _SLICE).orderBy(sort).rowsBetween(
        Window.unboundedPreceding, 0
    )
    local = sliced.join(offsets, [_GROUP, _SLICE]).withColumns(
        {f"__{m}_in": F.sum(m).over(inside) for m in measures}
    )
    return local.select(
        *keys,
        order,
        *measures,
        *(
            (F.col(f"__{m}_before") + F.col(f"__{m}_in")).alias(f"{m}_upto")
            for m in measures
        ),
        *(f"{m}_all" for m in measures),
    )


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    measures: Mapping[str, Column],
    descending: bool = False,
) -> DataFrame:
    """One row per (keys, order) with totals so far and overall.

    ``measures`` maps a name to an aggregate such as ``F.count("*")`` or
    ``F.sum("label")``. For each measure ``m`` the result holds ``m`` (this
    row), ``m_upto`` (this and all earlier rows of the group) and ``m_all``.
    """
    aggregates = [expr.alias(name) for name, expr in measures.items()]
    cells = df.groupBy(*keys, order).agg(*aggregates)
    return _running(cells, list(keys), order, list(measures), descending)


def _rank_pair(p: float, n: Column, mode: str) -> tuple[Column, Column, Column]:
    """Zero-based ranks around quantile ``p`` of ``n`` values and their weight."""
    last = n - 1
    if mode == "linear":
        place = F.lit(float(p)) * last
        low = F.floor(place)
        return low, F.least(low + 1, last), place - low
    if mode == "discrete":
        # first value whose cumulative share reaches p
        rank = F.greatest(n - F.floor(n - F.lit(float(p)) * n) - 1, F.lit(0))
    elif mode == "nearest":
        rank = F.floor(F.lit(float(p)) * last + 0.5)
    else:
        raise ValueError(f"unknown quantile mode {mode!r}")
    return rank, rank, F.lit(0.0)


def quantiles(
    df: DataFrame,
    column: str,
    probabilities: Mapping[str, float],
    keys: Sequence[str] = (),
    mode: str = "linear",
) -> DataFrame:
    """Exact quantiles per group; ``probabilities`` maps output name to p.

    Nulls are ignored. Modes: ``linear`` interpolates between neighbours,
    ``discrete`` takes the first value with cumulative share >= p, ``nearest``
    the value at the closest rank.
    """
    keys = list(keys)
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(
        F.count("*").alias("n")
    )
    ranks = [_rank_pair(p, F.col("n_all"), mode) for p in probabilities.values()]
    # Only slices that hold a wanted rank are sorted.
    first, end = F.col("__n_before"), F.col("__n_before") + F.col("__n_slice")
    wanted = F.lit(False)
    for low, high, _ in ranks:
        wanted = wanted | ((low >= first) & (low < end)) | ((high >= first) & (high < end))
    cells = _running(counts, keys, column, ["n"], False, wanted)
    before = F.col("n_upto") - F.col("n")

    def value_at(rank: Column, name: str) -> Column:
        here = (before <= rank) & (rank < F.col("n_upto"))
        return F.max(F.when(here, F.col(column))).alias(name)

    picked, final = [F.max("n_all").alias("__n_all")], []
    for i, (name, p) in enumerate(probabilities.items()):
        low, high, _ = ranks[i]
        picked.append(value_at(low, f"__lo{i}"))
        result = F.col(f"__lo{i}")
        if mode == "linear":
            picked.append(value_at(high, f"__hi{i}"))
            weight = _rank_pair(p, F.col("__n_all"), mode)[2]
            result = result + (F.col(f"__hi{i}") - result) * weight
        final.append(result.alias(name))
    return cells.groupBy(*keys).agg(*picked).select(*keys, *final)


def nested_quantiles(
    df: DataFrame, column: str, outer: float, inner: float, mode: str, closed: bool
) -> tuple:
    """A quantile of the whole column, and one of the values before it.

    Values equal to the first limit belong to the part before it when
    ``closed``. The column is counted once for both.
    """
    counts = staged(
        df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("__rows"))
    )

    def limit(part: DataFrame, p: float):
        return _weighted_quantile(part, column, "__rows", p, mode)

    first = limit(counts, outer)
    if first is None:
        return None, None
    earlier = F.col(column) <= F.lit(first) if closed else F.col(column) < F.lit(first)
    return first, limit(counts.where(earlier), inner)


def _weighted_quantile(counts: DataFrame, column: str, rows: str, p: float, mode: str):
    """Quantile of values given with their number of rows."""
    cells = running_totals(counts, [], column, {"n": F.sum(rows)})
    low, high, weight = _rank_pair(p, F.col("n_all"), mode)
    before = F.col("n_upto") - F.col("n")
    row = cells.agg(
        F.max(F.when((before <= low) & (low < F.col("n_upto")), F.col(column))).alias("lo"),
        F.max(F.when((before <= high) & (high < F.col("n_upto")), F.col(column))).alias("hi"),
        F.max(weight).alias("w"),
    ).first()
    if row["lo"] is None or mode != "linear":
        return row["lo"]
    return row["lo"] + (row["hi"] - row["lo"]) * row["w"]


def approximate_quantiles(
    df: DataFrame,
    column: str,
    probabilities: Mapping[str, float],
    keys: Sequence[str] = (),
    accuracy: int = 10_000,
) -> DataFrame:
    """Single-pass variant with rank error 1/accuracy, for interactive use."""
    return df.groupBy(*keys).agg(
        *(
            F.percentile_approx(column, F.lit(float(p)), F.lit(accuracy)).alias(name)
            for name, p in probabilities.items()
        )
    )


def scalar_quantile(df: DataFrame, column: str, p: float, mode: str = "discrete"):
    """One quantile of the whole column as a Python value (None if empty)."""
    return quantiles(df, column, {"q": p}, mode=mode).first()["q"]


def alphabetical_codes(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of ``column`` numbered from 0 in ascending order."""
    levels = df.where(F.col(column).isNotNull()).select(column).distinct()
    return running_totals(levels, [], column, {"__one": F.count("*")}).select(
        column, (F.col("__one_upto") - 1).alias("code")
    )
