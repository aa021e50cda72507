"""Null policy, static columns and rare levels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import numeric_columns
from ..session import staged
from .ordered import quantiles
from .profile import long_form, missing_shares, most_frequent, spreads, static_columns

# Level tables up to this size become literals in the plan; larger ones are joined.


def sentinel_to_null(df: DataFrame, sentinel: str = "-") -> DataFrame:
    """Replace a text sentinel by null in every text column."""
    return df.replace(sentinel, None)


def filled(
    df: DataFrame, fills: Mapping[str, object], required: Sequence[str] = ()
) -> DataFrame:
    """Fill nulls per column; every ``required`` feature must have a fill value.

    A feature without one would later lose whole rows silently.
    """
    bare = sorted(set(required) - set(fills))
    if bare:
        raise ValueError(f"no fill value for features: {bare}")
    return df.fillna(dict(fills))


def without_static(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Drop columns with one distinct value; also return the columns that stay."""
    static = set(static_columns(df, columns))
    return df.drop(*static), [c for c in columns if c not in static]


def zero_variance_columns(df: DataFrame) -> list[str]:
    columns = numeric_columns(df)
    if not columns:
        return []
    row = spreads(df, columns).first()
    return [c for c in columns if row[c] == 0]


def without_zero_variance(df: DataFrame) -> DataFrame:
    return df.drop(*zero_variance_columns(df))


class NullPolicy:
    """Drop columns that are mostly null, fill the others.

    ``fit`` decides on one table (the training part); ``transform`` applies the
    decision to any table. Numeric columns take the median, others the most
    frequent value.
    """

    def __init__(self, drop_share: float = 0.95):
        self.drop_share = drop_share
        self.dropped: list[str] = []
        self.fills: dict[str, object] = {}

    def fit(self, df: DataFrame) -> NullPolicy:
        shares = missing_shares(df).first().asDict()
        self.dropped = [c for c, s in shares.items() if s is not None and s >= self.drop_share]
        partly = [c for c, s in shares.items() if s and s < self.drop_share]
        numbers = [c for c in partly if c in set(numeric_columns(df))]
        others = [c for c in partly if c not in numbers]
        self.fills = {}
        if numbers:
            stacked = long_form(
                df.select(*(F.col(c).cast("double").alias(c) for c in numbers)), numbers
            ).where(~F.isnan("value"))
            for r in quantiles(stacked, "value", {"q": 0.5}, ["variable"]).collect():
                self.fills[r["variable"]] = r["q"]
        if others:
            for r in most_frequent(df, others).collect():
                self.fills[r["variable"]] = r["value"]
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        kinds = dict(df.dtypes)
        changed = {}
        for c, v in self.fills.items():
            if kinds[c] in ("double", "float"):
                changed[c] = F.coalesce(F.nanvl(F.col(c), F.lit(None)), F.lit(v))
            elif kinds[c] in ("tinyint", "smallint", "int", "bigint"):
                # the median of integers may lie between two of them; the type of the
                # result must not depend on the data
                changed[c] = F.coalesce(F.col(c).cast("double"), F.lit(v))
            else:
                changed[c] = F.coalesce(F.col(c), F.lit(v).cast(kinds[c]))
        return df.withColumns(changed).drop(*self.dropped)


def level_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts of every non-null level of all columns, one pass over the table."""
    stacked = long_form(
        df.select(*(F.col(c).cast("string").alias(c) for c in columns)), columns
    ).where("value is not null")
    return stacked.groupBy("variable", "value").agg(F.count("*").alias("n"))


class LevelFilter:
    """Keep frequent levels and turn the rest, null included, into ``other``.

    A level stays when its count exceeds ``min_count``, or when its share of the
    column's non-null rows reaches ``min_share``.
    """

    def __init__(
        self,
        columns: Sequence[str],
        min_count: int | None = None,
        min_share: float | None = None,
        other: str = "Other",
    ):
        if (min_count is None) == (min_share is None):
            raise ValueError("give either min_count or min_share")
        self.columns, self.other = list(columns), other
        self.min_count, self.min_share = min_count, min_share
        self.levels: DataFrame | None = None

    def fit(self, df: DataFrame) -> LevelFilter:
        counts = level_counts(df, self.columns)
        if self.min_count is not None:
            frequent = counts.where(F.col("n") > self.min_count)
        else:
            filled_rows = df.agg(*(F.count(c).alias(c) for c in self.columns)).first()
            total = F.lit(None)
            for c in self.columns:
                total = F.when(F.col("variable") == c, F.lit(filled_rows[c])).otherwise(total)
            frequent = counts.where(F.col("n") / total >= self.min_share)
        self.levels = staged(frequent.select("variable", "value"))
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for c in self.columns:
            known = self.levels.where(F.col("variable") == c).select(
                F.col("value").alias("__level")
            )
            out = (
                out.join(known, out[c].cast("string") == known["__level"], "left")
                .withColumn(c, F.coalesce("__level", F.lit(self.other)))
                .drop("__level")
            )
        return out.select(*df.columns)


def rare_to_other(df: DataFrame, columns: Sequence[str], min_count: int = 100) -> DataFrame:
    return LevelFilter(columns, min_count=min_count).fit(df).transform(df)


def infrequent_to_other(df: DataFrame, columns: Sequence[str], share: float = 0.005) -> DataFrame:
    return LevelFilter(columns, min_share=share).fit(df).transform(df)
