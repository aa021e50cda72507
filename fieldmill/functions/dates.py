"""Dates: parsing, truncation, calendar parts and differences."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTS = ("weekday", "month", "year")


def from_epoch(seconds: str, keep_fraction: bool = False) -> Column:
    """Epoch seconds to timestamp, dropping fractions unless asked to keep them."""
    value = F.col(seconds).try_cast("double")
    if keep_fraction:
        return F.timestamp_seconds(value)
    return F.timestamp_seconds(F.floor(value))


def truncated(time_col: str, units: Sequence[str]) -> dict[str, Column]:
    """Start of the day, hour, minute or second, one column per unit."""
    return {u: F.date_trunc(u, F.col(time_col)) for u in units}


def parsed_dates(formats: Mapping[str, str]) -> dict[str, Column]:
    """Text columns to dates by Spark datetime pattern; bad text becomes null.

    Two-digit years from 70 on belong to the 20th century.
    """
    return {c: _parsed(F.col(c), fmt) for c, fmt in formats.items()}


def _parsed(text: Column, pattern: str) -> Column:
    date = F.to_date(F.try_to_timestamp(text, F.lit(pattern)))
    if re.search(r"(?<!y)yy(?!y)", pattern):
        return F.when(F.year(date) >= 2070, F.add_months(date, -1200)).otherwise(date)
    return date


def parsed_timestamp(column: str, pattern: str | None = None) -> Column:
    """Text to timestamp, with automatic ISO detection when no pattern is given."""
    if pattern is None:
        return F.try_to_timestamp(F.col(column))
    return F.try_to_timestamp(F.col(column), F.lit(pattern))


def date_parts(wanted: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    """``{col}_weekday`` (Monday is 1), ``{col}_month`` and ``{col}_year``."""
    build = {
        "weekday": lambda c: F.weekday(c) + 1,
        "month": F.month,
        "year": F.year,
    }
    return {
        f"{c}_{part}": build[part](F.to_date(F.col(c)))
        for c, parts in wanted.items()
        for part in PARTS
        if part in parts
    }


def day_differences(pairs: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    """Days from the second date to the first of each named pair."""
    return {
        name: F.datediff(F.to_date(F.col(later)), F.to_date(F.col(earlier)))
        for name, (later, earlier) in pairs.items()
    }
