"""Ratios, differences, casts, fills, flags and hashes."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ratios(pairs: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    """Numerator over denominator; null where the denominator is 0."""
    return {
        name: F.try_divide(F.col(num).cast("double"), F.col(den).cast("double"))
        for name, (num, den) in pairs.items()
    }


def differences(pairs: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    return {name: F.col(a) - F.col(b) for name, (a, b) in pairs.items()}


def basic_features(
    df: DataFrame,
    ratio_pairs: Mapping[str, Sequence[str]],
    day_pairs: Mapping[str, Sequence[str]],
    parts: Mapping[str, Sequence[str]],
) -> DataFrame:
    """Ratios, day differences and date parts in one projection."""
    from .dates import date_parts, day_differences

    return df.withColumns(
        {**ratios(ratio_pairs), **day_differences(day_pairs), **date_parts(parts)}
    )


def casts(columns: Iterable[str], to: str = "double") -> dict[str, Column]:
    """Tolerant casts: text that is no number becomes null."""
    return {c: F.col(f"`{c}`").try_cast(to) for c in columns}


def safe_log(column: str) -> Column:
    """Natural logarithm, null for values that have none."""
    return F.when(F.col(column) > 0, F.ln(F.col(column)))


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0, also when it is unknown."""
    return F.when(condition, 1).otherwise(0)


def is_true(condition: Column) -> Column:
    """Boolean form of :func:`flag`."""
    return F.coalesce(condition, F.lit(False))


def allowed_levels(column: str, levels: Sequence[str], other: str = "Other") -> Column:
    """Keep the given levels; everything else, null included, becomes ``other``."""
    return F.when(F.col(column).isin(*levels), F.col(column)).otherwise(F.lit(other))


def money(column: str) -> Column:
    """``$60,000.00`` to a number. The point goes too, so the result is in cents."""
    return F.regexp_replace(F.col(column), r"[$.,]", "").try_cast("double")


def five_digits(column: str) -> Column:
    """Postal code as five characters, with leading zeros restored."""
    return F.lpad(F.col(column).cast("string"), 5, "0")


def stable_hash(*columns: str) -> Column:
    """64-bit hash computed in the JVM; equal values give equal hashes everywhere."""
    return F.xxhash64(*[F.col(c).cast("string") for c in columns])


def portable_hash(column: str, salt: str = "") -> Column:
    """32-bit hash (first 8 hex digits of MD5) that any SQL engine can repeat."""
    text = F.concat(F.lit(salt), F.col(column).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def other_columns(df: DataFrame) -> list[str]:
    """Everything that is not numeric."""
    numeric = set(numeric_columns(df))
    return [c for c in df.columns if c not in numeric]
