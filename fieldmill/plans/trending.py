"""Trending-video job: from daily rows to one feature row per video."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..functions.dates import parsed_dates
from ..functions.numbers import basic_features
from ..operators.joins import mapped
from ..operators.profile import lifecycle
from ..operators.trailing import CHANNEL_NAMES, GENERAL_NAMES, add_trailing
from ..session import staged
from ..sources.config import check_columns, load_settings


@dataclass
class TrendingSettings:
    ratio_features: Mapping[str, Sequence[str]]
    difference_features: Mapping[str, Sequence[str]]
    date_features: Mapping[str, Sequence[str]]
    base_columns: Sequence[str]
    max_time_to_trending: int = 60
    aggregate_windows: Sequence[int] = (7, 30, 180)
    date_column_format: Mapping[str, str] = field(default_factory=dict)


@dataclass
class TrendingTables:
    rows: str
    categories: str | None = None
    id_column: str = "id"
    title_column: str = "title"
    format: str = "parquet"


@dataclass
class TrendingJob:
    """A whole settings file: where the tables lie, and what to do with them."""

    tables: TrendingTables
    features: TrendingSettings


def check_settings(s: TrendingSettings, columns: Sequence[str]) -> None:
    """Fail before any job if a setting names a column that neither the table nor an
    earlier step has."""
    have = [*columns]
    needed = dict.fromkeys(s.date_column_format, "date_column_format")
    needed |= {c: "ratio_features" for pair in s.ratio_features.values() for c in pair}
    needed |= {c: "difference_features" for pair in s.difference_features.values() for c in pair}
    needed |= dict.fromkeys(s.date_features, "date_features")
    needed |= {"video_id": "the job", "trending_date": "the job", "channel_title": "the job"}
    check_columns(needed, have)
    made = [*s.ratio_features, *s.difference_features]
    made += [f"{c}_{part}" for c, parts in s.date_features.items() for part in parts]
    check_columns(
        dict.fromkeys(s.base_columns, "base_columns") | {"days_to_trending": "the job"}, [*have, *made]
    )
    odd = [w for w in s.aggregate_windows if not isinstance(w, int) or w < 1]
    if odd:
        raise ValueError(f"aggregate_windows: {odd} are no numbers of days")


def run_file(spark: SparkSession, path: str) -> DataFrame:
    """The job of a settings file, its names checked against the tables first."""
    job = load_settings(TrendingJob, path)
    read = spark.read.format(job.tables.format)
    if job.tables.format == "csv":
        read = read.options(header=True, multiLine=True, escape='"', inferSchema=True)
    rows, categories = read.load(job.tables.rows), None
    check_settings(job.features, rows.columns)
    if job.tables.categories is not None:
        named = spark.read.parquet(job.tables.categories)
        check_columns(
            {job.tables.id_column: "tables.id_column", job.tables.title_column: "tables.title_column"},
            named.columns,
        )
        categories = named.select(
            named[job.tables.id_column].alias("id"), named[job.tables.title_column].alias("title")
        )
    return run(rows, categories, job.features)


def run(rows: DataFrame, categories: DataFrame | None, s: TrendingSettings) -> DataFrame:
    """One row per video with trailing features per channel and overall.

    The lifecycle table is read three times, each time in other columns, so it is
    written once; everything after it is lazy.
    """
    df = rows
    if s.date_column_format:
        df = df.withColumns(parsed_dates(s.date_column_format))
    if categories is not None:
        df = mapped(df, "category_id", categories, "id", "title")
    videos = staged(
        df.transform(
            basic_features, s.ratio_features, s.difference_features, s.date_features
        ).transform(
            lifecycle, "video_id", "trending_date", "days_to_trending",
            s.max_time_to_trending, s.base_columns,
        )
    )
    trailing = ("first_day_in_trending", s.aggregate_windows, "video_id", "days_in_trending")
    return videos.transform(
        add_trailing, *trailing, CHANNEL_NAMES, "channel_title", source=videos
    ).transform(add_trailing, *trailing, GENERAL_NAMES, source=videos)
