"""Train, validation and test splits.

Splits come as an added ``split`` column, assigned in one pass; ``parts`` turns
it into separate frames.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import portable_hash
from .joins import members, non_members
from .ordered import nested_quantiles, running_totals, scalar_quantile

BUCKETS = 10_000


def parts(df: DataFrame, *names: str, column: str = "split") -> tuple[DataFrame, ...]:
    return tuple(df.where(F.col(column) == n).drop(column) for n in names)


def random_parts(
    df: DataFrame, test_size: float = 0.2, val_size: float | None = None, seed: int = 200
) -> tuple[DataFrame, ...]:
    """Seeded random split; the validation part is cut from the training part."""
    train, test = df.randomSplit([1 - test_size, test_size], seed=seed)
    if val_size is None:
        return train, test
    train, val = train.randomSplit([1 - val_size, val_size], seed=seed)
    return train, val, test


def hash_bucket(column: str) -> Column:
    return F.pmod(portable_hash(column), F.lit(BUCKETS))


def hash_split(
    df: DataFrame, column: str, test_size: float = 0.2, mode: str = "bucket"
) -> DataFrame:
    """Split by the hash of ``column``; equal values always share a side.

    ``bucket`` fixes the side of every value for good, also when the table
    grows. ``quantile`` puts the limit at the ``test_size`` quantile of the
    hashes over all rows, which hits the wanted size also with few values.
    """
    if mode == "bucket":
        in_test = hash_bucket(column) < F.lit(round(test_size * BUCKETS))
    elif mode == "quantile":
        hashed = df.select(portable_hash(column).alias("__hash"))
        limit = scalar_quantile(hashed, "__hash", test_size)
        in_test = portable_hash(column) < F.lit(limit)
    else:
        raise ValueError(f"unknown split mode {mode!r}")
    return df.withColumn("split", F.when(in_test, "test").otherwise("train"))


def entity_sides(
    df: DataFrame, entity: str, label: str, test_size: float = 0.2, bad_rate: float = 0.2
) -> DataFrame:
    """One row per entity with its stratum and split.

    Entities whose mean label exceeds ``bad_rate`` form a stratum of their own.
    Within a stratum an entity is tested when its hash lies below the value at
    which the rows of entities in hash order reach ``test_size``.
    """
    rated = df.groupBy(entity).agg(
        F.count("*").alias("__rows"), F.avg(label).alias("__rate")
    ).select(
        entity,
        "__rows",
        F.coalesce(F.col("__rate") > bad_rate, F.lit(False)).alias("is_bad_entity"),
        portable_hash(entity).alias("__hash"),
    )
    along = running_totals(rated, ["is_bad_entity"], "__hash", {"__r": F.sum("__rows")})
    limits = (
        along.where(F.col("__r_upto") >= F.lit(test_size) * F.col("__r_all"))
        .groupBy("is_bad_entity")
        .agg(F.min("__hash").alias("__limit"))
    )
    return rated.join(limits, "is_bad_entity").select(
        entity,
        "is_bad_entity",
        F.when(F.col("__hash") < F.col("__limit"), "test").otherwise("train").alias("split"),
    )


def entity_split(
    df: DataFrame, entity: str, label: str, test_size: float = 0.2, bad_rate: float = 0.2
) -> DataFrame:
    """Split rows so that no entity is on both sides and both strata are."""
    sides = entity_sides(df, entity, label, test_size, bad_rate).select(
        F.struct(entity).alias("__entity"), "split"
    )
    return (
        df.withColumn("__entity", F.struct(entity))
        .join(sides, "__entity")
        .select(*df.columns, "split")
    )


def pinned_entity_split(
    df: DataFrame,
    entity: str,
    train_pins: Sequence,
    test_pins: Sequence,
    train_share: float = 0.8,
    seed: int = 200,
) -> tuple[DataFrame, DataFrame]:
    """Entities sampled for training, with given entities pinned to a side.

    Everything neither sampled nor pinned to training is tested. Membership in
    the sample is decided by a seeded hash, so it is the same in every re-run.
    """
    pins = [*train_pins, *test_pins]
    draw = F.pmod(portable_hash(entity, f"{seed}:"), F.lit(BUCKETS))
    sampled = (
        df.where(~F.col(entity).isin(*pins) if pins else F.lit(True))
        .select(entity)
        .distinct()
        .where(draw < F.lit(round(train_share * BUCKETS)))
    )
    if train_pins:
        pinned = df.where(F.col(entity).isin(*train_pins)).select(entity).distinct()
        sampled = sampled.unionByName(pinned)
    return members(df, entity, sampled), non_members(df, entity, sampled)


def time_split(
    df: DataFrame,
    column: str,
    test_size: float = 0.2,
    val_size: float = 0.2,
    mode: str = "discrete",
    boundary_in_test: bool = True,
) -> DataFrame:
    """Nested split along an ordered column at its quantiles.

    With ``boundary_in_test`` rows equal to a limit go to the later part (``<``
    and ``>=``), otherwise to the earlier one (``<=`` and ``>``). Rows without a
    time are left out.
    """
    time = F.col(column)

    def later(limit) -> Column:
        return time >= F.lit(limit) if boundary_in_test else time > F.lit(limit)

    test_limit, val_limit = nested_quantiles(
        df, column, 1 - test_size, 1 - val_size, mode, closed=not boundary_in_test
    )
    if test_limit is None:
        return df.where(time.isNotNull()).withColumn("split", F.lit("train"))
    name = F.when(later(test_limit), "test")
    if val_limit is not None:
        name = name.when(later(val_limit), "val")
    return df.where(time.isNotNull()).withColumn("split", name.otherwise("train"))


def period_split(df: DataFrame, column: str, periods: Mapping[str, Sequence]) -> DataFrame:
    """Split by explicit value lists; rows in no list are left out."""
    name = None
    for split, values in periods.items():
        hit = F.col(column).isin(*values)
        name = F.when(hit, split) if name is None else name.when(hit, split)
    return df.withColumn("split", name).where(F.col("split").isNotNull())


def split_sizes(df: DataFrame, label: str, column: str = "split") -> DataFrame:
    """Rows and positives of every part, in one job."""
    return df.groupBy(column).agg(
        F.count("*").alias("rows"), F.sum(label).alias("positives")
    )


def draw(key: str, seed: int) -> Column:
    """0 to BUCKETS - 1 from a seeded hash of ``key``, the same in every re-run."""
    return F.pmod(portable_hash(key, f"{seed}:"), F.lit(BUCKETS))


def sampled(df: DataFrame, share: float, seed: int = 7, key: str | None = None) -> DataFrame:
    """Rows drawn by a hash of ``key``, or freely without one."""
    if key is None:
        return df.sample(False, share, seed)
    return df.where(draw(key, seed) < F.lit(round(share * BUCKETS)))


def sampled_rows(df: DataFrame, n: int, key: str, seed: int = 7) -> DataFrame:
    """Sample of ``n`` rows: each task keeps the n smallest hashes of ``key``."""
    return df.orderBy(portable_hash(key, f"{seed}:"), key).limit(n)


def seeded_split(
    df: DataFrame, key: str, test_size: float = 0.2, val_size: float = 0.0, seed: int = 200
) -> DataFrame:
    """``split`` by hashes of ``key`` in one pass; validation is cut from the rest.

    Unlike :func:`random_parts` it does not depend on how the rows are partitioned.
    """
    name = F.when(draw(key, seed) < F.lit(round(test_size * BUCKETS)), "test")
    name = name.when(draw(key, seed + 1) < F.lit(round(val_size * BUCKETS)), "val")
    return df.withColumn("split", name.otherwise("train"))
