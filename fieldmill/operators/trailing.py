"""Trailing-day features: distinct count, maximum and mean over [day - N, day).

Distinct counts use no set per window. Sightings of an id that lie less than N days
apart are one presence: it starts at a sighting without another in the N - 1 days before
and ends at one without another in the N - 1 days after. A window holds the ids whose
presence started before its end and had its last sighting not before its start. So each
sighting says, for every N, whether it starts and whether it ends a presence; these are
added up by day, and running sums give every window from one narrow row per active day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_DAY = "__day"


def trailing_table(
    df: DataFrame,
    day: str,
    periods: Sequence[int],
    id_col: str,
    metric: str,
    names: dict[str, str],
    key: str | None = None,
) -> DataFrame:
    """One row per active (key, day) with features of the preceding days.

    ``names`` holds templates for ``distinct``, ``max`` and ``mean``, each with
    a ``{n}`` for the period. Empty windows give 0.
    """
    keys = [key] if key else []
    dated = df.where(F.col(day).isNotNull()).withColumn(
        _DAY, F.unix_date(F.to_date(day))
    )
    sightings = dated.groupBy(*keys, id_col, _DAY).agg(
        F.count(metric).alias("__n"),
        F.sum(metric).alias("__sum"),
        F.max(metric).alias("__max"),
    )
    own = Window.partitionBy(*keys, id_col).orderBy(_DAY)
    since, until = F.col(_DAY) - F.lag(_DAY).over(own), F.lead(_DAY).over(own) - F.col(_DAY)
    gaps = sightings.withColumns({"__since": since, "__until": until})
    days = gaps.groupBy(*keys, _DAY).agg(
        F.sum("__n").alias("__n"),
        F.sum("__sum").alias("__sum"),
        F.max("__max").alias("__max"),
        *(
            F.count(F.when(F.col(gap).isNull() | (F.col(gap) >= p), 1)).alias(f"{gap}{p}")
            for p in periods
            for gap in ("__since", "__until")
        ),
    )
    # One row per active day and key: the windows stay small. All share partitions
    # and order, so there is one shuffle and one sort.
    ordered = Window.partitionBy(*keys).orderBy(_DAY)
    earliest = Window.unboundedPreceding
    present = {}
    for p in periods:
        started = F.coalesce(F.sum(f"__since{p}").over(ordered.rangeBetween(earliest, -1)), F.lit(0))
        ended = F.coalesce(F.sum(f"__until{p}").over(ordered.rangeBetween(earliest, -p - 1)), F.lit(0))
        present[names["distinct"].format(n=p)] = started - ended
    moving = {}
    for p in periods:
        frame = ordered.rangeBetween(-p, -1)
        moving[names["max"].format(n=p)] = F.coalesce(F.max("__max").over(frame), F.lit(0))
        moving[names["mean"].format(n=p)] = F.coalesce(
            F.try_divide(F.sum("__sum").over(frame), F.sum("__n").over(frame)),
            F.lit(0.0),
        )
    features = [names[k].format(n=p) for p in periods for k in ("distinct", "max", "mean")]
    return days.withColumns({**present, **moving}).select(
        *keys, F.date_from_unix_date(_DAY).alias(day), *features
    )


CHANNEL_NAMES = {
    "distinct": "channel_num_trending_videos_last_{n}_days",
    "max": "channel_max_days_in_trending_{n}_days",
    "mean": "channel_avg_days_in_trending_{n}_days",
}
GENERAL_NAMES = {
    "distinct": "general_num_trending_videos_last_{n}_days",
    "max": "general_max_days_in_trending_{n}_days",
    "mean": "general_avg_days_in_trending_{n}_days",
}


def add_trailing(
    df: DataFrame,
    day: str,
    periods: Sequence[int],
    id_col: str,
    metric: str,
    names: dict[str, str],
    key: str | None = None,
    source: DataFrame | None = None,
) -> DataFrame:
    """Attach :func:`trailing_table` to every row; the row count never changes.

    ``source`` names the frame to compute the features from when ``df`` is that
    frame with further columns joined on, so that those joins are not repeated.
    """
    table = trailing_table(
        source if source is not None else df, day, periods, id_col, metric, names, key
    )
    keys = [key] if key else []
    slot = F.struct(*keys, F.to_date(day).alias("day"))
    features = [c for c in table.columns if c not in (*keys, day)]
    right = table.select(slot.alias("__slot"), *features)
    return (
        df.withColumn("__slot", slot)
        .join(right, "__slot", "left")
        .select(*df.columns, *features)
    )


def trailing_mean_inclusive(
    df: DataFrame, key: str, day: str, metric: str, days: int, name: str
) -> DataFrame:
    """Mean of daily sums over (day - days, day], per key and active day."""
    daily = df.groupBy(key, F.to_date(day).alias(day)).agg(F.sum(metric).alias(metric))
    frame = (
        Window.partitionBy(key)
        .orderBy(F.unix_date(day))
        .rangeBetween(-(days - 1), 0)
    )
    return daily.withColumn(name, F.avg(metric).over(frame))


def shifted_by_rows(df: DataFrame, day: str, columns: Sequence[str], rows: int) -> DataFrame:
    """Values of ``rows`` rows earlier, for a table with one row per day."""
    ordered = Window.orderBy(day)
    return df.withColumns(
        {c: F.coalesce(F.lag(c, rows).over(ordered), F.lit(0)) for c in columns}
    )
