"""Look-back features over a time axis in whole seconds.

A frame covers the ``minutes`` before the current second and leaves that second
out. Rows are first added up per (key, second), which is exact because frames
start and end on whole seconds. The time axis of every key is then cut into
blocks as long as the frame. A frame is the end of one block and the start of
the next: the first is read from a running sum taken backwards, the second from
one taken forwards. So the work grows with the rows, whatever the frame's
length, nothing is subtracted, and a key that holds most of the table is spread
over as many tasks as it has blocks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

OPERATIONS = ("count", "sum", "avg")


@dataclass(frozen=True)
class Rolling:
    """One output column: ``operation`` of ``column`` within ``key``."""

    name: str
    column: str
    minutes: int
    operation: str = "count"
    key: str | None = None

    def __post_init__(self) -> None:
        if self.operation not in OPERATIONS:
            raise ValueError(f"operation must be one of {OPERATIONS}: {self.operation!r}")

    @property
    def partition_key(self) -> str:
        return self.key or self.column


def lookback_window(minutes: int, key: str, time_col: str) -> WindowSpec:
    """Frame from ``minutes`` ago up to the second before the current one."""
    return (
        Window.partitionBy(key)
        .orderBy(epoch_seconds(time_col))
        .rangeBetween(-60 * minutes, -1)
    )


def lookback(
    column: str, minutes: int, operation: str = "count", key: str | None = None,
    time_col: str = "dt",
) -> Column:
    """Window expression, for tables with one row per key and second.

    On raw rows use :func:`add_rolling`, which copes with keys of any size.
    """
    spec = Rolling("_", column, minutes, operation, key)
    aggregate = {"count": F.count, "sum": F.sum, "avg": F.avg}[spec.operation]
    return aggregate(column).over(lookback_window(minutes, spec.partition_key, time_col))


def epoch_seconds(time_col: str) -> Column:
    return F.unix_seconds(F.col(time_col).cast("timestamp"))


def add_rolling(
    df: DataFrame,
    specs: Sequence[Rolling],
    time_col: str = "dt",
    row_id: str | None = None,
) -> DataFrame:
    """Add every look-back column of ``specs``, one pass per distinct key.

    Each key shuffles the rows once. For wide rows name a unique ``row_id``:
    then only that column and the keys travel, and the rest of the row moves
    once, in the final join.
    """
    names = [s.name for s in specs]
    if row_id is not None:
        keys = dict.fromkeys([s.partition_key for s in specs] + [s.column for s in specs])
        narrow = df.select(*dict.fromkeys([row_id, *keys, time_col]))
        features = add_rolling(narrow, specs, time_col).select(row_id, *names)
        return df.join(features, row_id).select(*df.columns, *names)
    by_key: dict[str, list[Rolling]] = {}
    for spec in specs:
        by_key.setdefault(spec.partition_key, []).append(spec)
    second = "__second"
    timed = df.withColumn(second, epoch_seconds(time_col))
    out = timed
    for key, group in by_key.items():
        # from the plain rows, not from rows that already carry other features
        features = _per_second_features(timed, key, second, group)
        slot = F.struct(F.col(key), F.col(second))
        out = (
            out.withColumn("__slot", slot)
            .join(features, "__slot", "left")
            .drop("__slot")
        )
    return out.select(*df.columns, *names)


def _per_second_features(
    df: DataFrame, key: str, second: str, specs: Sequence[Rolling]
) -> DataFrame:
    columns = sorted({s.column for s in specs})
    number = {c: i for i, c in enumerate(columns)}
    summed = {s.column for s in specs if s.operation != "count"}
    partials = [F.count(c).alias(f"__n{number[c]}") for c in columns]
    partials += [F.sum(c).alias(f"__s{number[c]}") for c in columns if c in summed]
    cells = df.groupBy(key, second).agg(*partials)

    widths = sorted({60 * s.minutes for s in specs})
    wide = cells.withColumn("__w", F.explode(F.array(*(F.lit(w) for w in widths))))
    block = F.floor(F.col(second) / F.col("__w"))
    own = F.struct(block.alias("block"), F.col(second).alias("at"), F.lit(True).alias("own"))
    probe = F.struct(
        (block - 1).alias("block"), (F.col(second) - F.col("__w")).alias("at"), F.lit(False).alias("own")
    )
    places = F.when(F.col(second).isNull(), F.array(own)).otherwise(F.array(own, probe))
    rows = wide.withColumn("__p", F.explode(places)).select("*", "__p.block", "__p.at", "__p.own")
    measures = [c for c in cells.columns if c not in (key, second)]
    within = Window.partitionBy(key, "__w", "block")
    before = within.orderBy("at", "own").rowsBetween(Window.unboundedPreceding, -1)
    since = within.orderBy(F.desc("at"), F.desc("own")).rowsBetween(Window.unboundedPreceding, 0)
    found = {}
    for m in measures:
        value = F.when(F.col("own"), F.col(m))
        found[m] = (
            F.when(F.col(second).isNull(), F.col(m))  # unknown times see each other
            .when(F.col("own"), F.sum(value).over(before))
            .otherwise(F.sum(value).over(since))
        )
    parts = rows.select(key, second, "__w", *(found[m].alias(m) for m in measures))
    features = []
    for spec in specs:
        i, mine = number[spec.column], F.col("__w") == 60 * spec.minutes
        count = F.coalesce(F.sum(F.when(mine, F.col(f"__n{i}"))), F.lit(0))
        if spec.operation == "count":
            value = count
        else:
            value = F.sum(F.when(mine, F.col(f"__s{i}")))
            if spec.operation == "avg":
                value = F.try_divide(value, count)
        features.append(value.alias(spec.name))
    return parts.groupBy(F.struct(F.col(key), F.col(second)).alias("__slot")).agg(*features)
