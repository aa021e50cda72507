"""Loan-table job: levels, flags, amounts, places and a time split."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import allowed_levels, is_true, money
from ..operators.clean import LevelFilter
from ..operators.joins import coordinates
from ..operators.split import time_split


@dataclass
class LendingSettings:
    rare_columns: Sequence[str] = ("City", "Bank", "FranchiseCode")
    flag_columns: Sequence[str] = ("RevLineCr", "LowDoc")
    money_columns: Sequence[str] = ("GrAppv", "SBA_Appv")
    charge_off: str = "ChgOffDate"
    zip_column: str = "Zip"
    state: str = "State"
    bank_state: str = "BankState"
    is_new_column: str = "NewExist"
    naics: str | None = "NAICS"
    year: str = "ApprovalFY"
    bad_years: Sequence[str] = ("1976A",)
    output: Sequence[str] = ()
    min_share: float = 0.005
    test_size: float = 0.1


def run(raw: DataFrame, places: DataFrame | None, s: LendingSettings) -> DataFrame:
    """Cleaned loans with a ``split`` column; loans without a year are ``unknown``."""
    year = F.col(s.year).cast("string")
    df = LevelFilter(list(s.rare_columns), min_share=s.min_share).fit(raw).transform(raw)
    df = df.withColumns(
        {
            "is_default": F.col(s.charge_off).isNotNull(),
            **{c: allowed_levels(c, ["Y", "N"]) for c in s.flag_columns},
            **{c: money(c) for c in s.money_columns},
            "is_new": is_true(F.col(s.is_new_column) == 2),
            "same_state": is_true(F.col(s.state) == F.col(s.bank_state)),
        }
    )
    if s.naics:
        df = df.withColumn("naics_first_two", F.substring(F.col(s.naics).cast("string"), 1, 2))
    if places is not None:
        df = coordinates(df, s.zip_column, places, "code", "longitude", "latitude")
    df = df.where(~F.coalesce(year.isin(*s.bad_years), F.lit(False))).withColumn(s.year, year.try_cast("int"))
    if s.output:
        df = df.select(*s.output)
    known = time_split(
        df.where(F.col(s.year).isNotNull()), s.year, s.test_size, s.test_size, mode="linear", boundary_in_test=False
    )
    unknown = df.where(F.col(s.year).isNull()).withColumn("split", F.lit("unknown"))
    return known.unionByName(unknown)
