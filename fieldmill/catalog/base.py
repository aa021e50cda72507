"""Table access and the query registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Tables:
    """The given parquet tables by name, with zoned timestamps in UTC."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        plain = [
            f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)
        ]
        return df.withColumns({c: F.col(c).cast("timestamp") for c in plain}) if plain else df


@dataclass(frozen=True)
class Entry:
    build: Callable[[Tables], DataFrame]
    sql: str | None = None


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the same query for any SQL engine."""

    def keep(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        REGISTRY[name] = Entry(build, sql)
        return build

    return keep


def day(column: str, name: str | None = None):
    """Date as text, so that results compare across engines."""
    return F.date_format(F.col(column), "yyyy-MM-dd").alias(name or column)


def moment(column: str, name: str | None = None):
    return F.date_format(F.col(column), "yyyy-MM-dd HH:mm:ss").alias(name or column)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


def as_long(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in columns})
