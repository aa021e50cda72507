"""Calendar-month groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def monthly_distinct(
    df: DataFrame, key: str, day: str, id_col: str, name: str, closed: str = "left"
) -> DataFrame:
    """Distinct ids per key and calendar month with both month bounds.

    ``closed="left"`` is the ordinary month. With ``closed="both"`` a month also
    takes the rows of the first day after it, which then count twice.
    """
    if closed not in ("left", "both"):
        raise ValueError("closed must be 'left' or 'both'")
    date = F.to_date(day)
    month = F.trunc(date, "month")
    if closed == "both":
        months = F.when(
            F.dayofmonth(date) == 1, F.array(month, F.add_months(month, -1))
        ).otherwise(F.array(month))
        df = df.withColumn("__month", F.explode(months))
    else:
        df = df.withColumn("__month", month)
    return (
        df.groupBy(key, "__month")
        .agg(F.count_distinct(id_col).alias(name))
        .select(
            key,
            F.col("__month").alias("lower_boundary"),
            F.add_months("__month", 1).alias("upper_boundary"),
            name,
        )
    )
