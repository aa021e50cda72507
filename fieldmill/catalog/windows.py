"""Look-back, trailing, sliding and calendar windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.calendar import monthly_distinct
from ..operators.rolling import Rolling, add_rolling, lookback
from ..operators.trailing import (
    CHANNEL_NAMES,
    GENERAL_NAMES,
    add_trailing,
    shifted_by_rows,
    trailing_mean_inclusive,
    trailing_table,
)
from ..session import staged
from .base import Tables, day, register, rounded
from .standins import LIFE_SQL, LOG_SQL, TREND_SQL, life, log, trend

SEC_SQL = (
    "ev AS (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS sec, "
    "CAST(round(value * 100) AS BIGINT) AS cents FROM events)"
)


def _events(t: Tables) -> DataFrame:
    """Events with a whole-number value, whose sums do not depend on order."""
    return t.events.withColumn("cents", F.round(F.col("value") * 100).cast("long"))


def _over(key: str, minutes: int) -> str:
    return (
        f"OVER (PARTITION BY {key} ORDER BY sec RANGE BETWEEN {60 * minutes} PRECEDING AND 1 PRECEDING)"
    )


@register(
    "e1_window_frame",
    f"WITH {SEC_SQL}, c AS (SELECT user_id, sec, count(*) AS rows FROM ev GROUP BY 1, 2) "
    f"SELECT user_id, sec, rows, CAST(sum(rows) {_over('user_id', 720)} AS BIGINT) AS earlier FROM c",
)
def window_frame(t: Tables) -> DataFrame:
    """The window expression itself, over one row per key and second."""
    per_second = t.events.groupBy(
        "user_id", F.date_trunc("second", "ts").alias("dt")
    ).agg(F.count("*").alias("rows"))
    return per_second.select(
        "user_id",
        F.unix_seconds("dt").alias("sec"),
        "rows",
        lookback("rows", 720, "sum", key="user_id").alias("earlier"),
    )


@register(
    "e2_rolling_count",
    f"WITH {SEC_SQL} SELECT event_id, count(user_id) {_over('user_id', 30)} AS n_30, count(user_id) {_over('user_id', 1440)} AS n_1440 FROM ev",
)
def rolling_count(t: Tables) -> DataFrame:
    specs = [Rolling("n_30", "user_id", 30), Rolling("n_1440", "user_id", 1440)]
    return add_rolling(t.events, specs, "ts").select("event_id", "n_30", "n_1440")


@register(
    "e3_rolling_sum",
    f"WITH {SEC_SQL} SELECT event_id, CAST(sum(cents) {_over('event_type', 60)} AS BIGINT) AS total FROM ev",
)
def rolling_sum(t: Tables) -> DataFrame:
    specs = [Rolling("total", "cents", 60, "sum", "event_type")]
    return add_rolling(_events(t), specs, "ts").select("event_id", "total")


@register(
    "e4_rolling_avg",
    f"WITH {SEC_SQL} SELECT event_id, round(avg(cents) {_over('user_id', 1440)}, 6) AS mean FROM ev",
)
def rolling_avg(t: Tables) -> DataFrame:
    specs = [Rolling("mean", "cents", 1440, "avg", "user_id")]
    return rounded(add_rolling(_events(t), specs, "ts").select("event_id", "mean"), "mean")


BUNDLE = [
    Rolling(f"{name}_count_last_{text}", name, minutes)
    for name in ("source_ip", "source_port", "dest_ip", "dest_port")
    for minutes, text in ((1, "min"), (30, "30_mins"))
] + [
    Rolling(f"source_ip_avg_{what}_last_{text}", column, minutes, "avg", "source_ip")
    for what, column in (("pkts", "orig_pkts"), ("bytes", "orig_ip_bytes"))
    for minutes, text in ((1, "min"), (30, "30_mins"))
]


def _bundle_sql() -> str:
    parts = []
    for s in BUNDLE:
        call = f"{s.operation}({s.column}) {_over(s.partition_key, s.minutes)}"
        parts.append(f"round({call}, 6) AS {s.name}" if s.operation == "avg" else f"{call} AS {s.name}")
    return (
        f"WITH {LOG_SQL}, s AS (SELECT *, CAST(floor(ts) AS BIGINT) AS sec FROM log) SELECT uid, "
        + ", ".join(parts)
        + " FROM s"
    )


@register("e5_rolling_bundle", _bundle_sql())
def rolling_bundle(t: Tables) -> DataFrame:
    df = log(t).withColumn("dt", F.timestamp_seconds(F.floor("ts")))
    out = add_rolling(df, BUNDLE, "dt").select("uid", *(s.name for s in BUNDLE))
    return rounded(out, *(s.name for s in BUNDLE if s.operation == "avg"))


@register(
    "e6_share_of_total",
    "SELECT o_orderpriority, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 4) AS percent FROM orders GROUP BY 1",
)
def share_of_total(t: Tables) -> DataFrame:
    from ..operators.profile import counts_with_share

    return counts_with_share(t.orders, "o_orderpriority")


@register(
    "e7_group_size",
    """SELECT o_orderkey, o_custkey, n FROM (SELECT o_orderkey, o_custkey, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
    WHERE n >= 12""",
)
def group_size(t: Tables) -> DataFrame:
    """Rows of frequent groups: sizes are aggregated, then joined, so that a
    large group is never gathered for a window."""
    sizes = (
        t.orders.groupBy("o_custkey").agg(F.count("*").alias("n")).where(F.col("n") >= 12)
    )
    return t.orders.select("o_orderkey", "o_custkey").join(sizes, "o_custkey")


PERIODS = (7, 30, 180)


def _trailing_sql(rows: str, day_col: str, key: str | None, id_col: str, metric: str, names: dict, cast: str) -> str:
    """SQL over a CTE ``rows`` by joining each active day with its past days."""
    k = f"{key}, " if key else ""
    match = f"b.{key} = a.{key} AND " if key else ""
    cols = []
    for p in PERIODS:
        inside = f"FILTER (WHERE b.{day_col} >= a.{day_col} - {p})"
        cols.append(f"count(DISTINCT b.{id_col}) {inside} AS {names['distinct'].format(n=p)}")
        cols.append(f"CAST(coalesce(max(b.{metric}) {inside}, 0) AS {cast}) AS {names['max'].format(n=p)}")
        cols.append(f"round(coalesce(avg(b.{metric}) {inside}, 0), 4) AS {names['mean'].format(n=p)}")
    group = f"a.{key}, a.{day_col}" if key else f"a.{day_col}"
    shown = (f"a.{key}, " if key else "") + f"strftime(a.{day_col}, '%Y-%m-%d') AS {day_col}"
    return (
        f"days AS (SELECT DISTINCT {k}{day_col} FROM {rows}) SELECT {shown}, {', '.join(cols)} FROM days a "
        f"LEFT JOIN {rows} b ON {match}b.{day_col} < a.{day_col} AND b.{day_col} >= a.{day_col} - 180 GROUP BY {group}"
    )


_LINES_SQL = (
    "ln AS (SELECT l_partkey AS video_id, l_suppkey AS channel_title, CAST(l_shipdate AS DATE) AS d, "
    "l_quantity AS days_in_trending FROM lineitem)"
)


def _lines(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_partkey").alias("video_id"),
        F.col("l_suppkey").alias("channel_title"),
        F.to_date("l_shipdate").alias("d"),
        F.col("l_quantity").alias("days_in_trending"),
    )


def _rounded_means(df: DataFrame, names: dict) -> DataFrame:
    return rounded(df, *(names["mean"].format(n=p) for p in PERIODS), digits=4)


@register(
    "e8_trailing_by_channel",
    f"WITH {_LINES_SQL}, "
    + _trailing_sql("ln", "d", "channel_title", "video_id", "days_in_trending", CHANNEL_NAMES, "DOUBLE"),
)
def trailing_by_channel(t: Tables) -> DataFrame:
    out = trailing_table(
        _lines(t), "d", PERIODS, "video_id", "days_in_trending", CHANNEL_NAMES, "channel_title"
    )
    return _rounded_means(out, CHANNEL_NAMES).withColumn("d", day("d"))


def _stored_life(t: Tables) -> DataFrame:
    """What the trailing features need of the videos, read twice and so written once."""
    return staged(life(t).select("video_id", "channel_title", "first_day_in_trending", "days_in_trending"))


_ADDED_SQL = f"WITH {LIFE_SQL}, "


def _attached_sql(key: str | None, names: dict) -> str:
    table = _trailing_sql("life", "first_day_in_trending", key, "video_id", "days_in_trending", names, "INTEGER")
    head, body = table.split(") SELECT ", 1)
    cols = ", ".join(
        f"t.{names[kind].format(n=p)}" for p in PERIODS for kind in ("distinct", "max", "mean")
    )
    on = "l.channel_title = t.channel_title AND " if key else ""
    return (
        f"{_ADDED_SQL}{head}), t AS (SELECT {body}) SELECT l.video_id, {cols} FROM life l JOIN t "
        f"ON {on}strftime(l.first_day_in_trending, '%Y-%m-%d') = t.first_day_in_trending"
    )


@register("e9_add_rolling_features", _attached_sql("channel_title", CHANNEL_NAMES))
def add_rolling_features(t: Tables) -> DataFrame:
    out = add_trailing(
        _stored_life(t), "first_day_in_trending", PERIODS, "video_id", "days_in_trending",
        CHANNEL_NAMES, "channel_title",
    )
    names = [CHANNEL_NAMES[k].format(n=p) for p in PERIODS for k in ("distinct", "max", "mean")]
    return _rounded_means(out.select("video_id", *names), CHANNEL_NAMES)


@register(
    "e10_weekly_mean",
    f"""WITH {TREND_SQL}, v AS (SELECT category_id, trending_date, sum(views) AS views FROM trend GROUP BY 1, 2)
    SELECT category_id, strftime(trending_date, '%Y-%m-%d') AS trending_date, CAST(views AS BIGINT) AS views,
    round(avg(views) OVER (PARTITION BY category_id ORDER BY trending_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW), 6) AS rolling_weekly_average FROM v""",
)
def weekly_mean(t: Tables) -> DataFrame:
    out = trailing_mean_inclusive(
        trend(t), "category_id", "trending_date", "views", 7, "rolling_weekly_average"
    )
    return rounded(out, "rolling_weekly_average").withColumn(
        "trending_date", day("trending_date")
    )


@register(
    "e11_sliding_periods",
    f"WITH {_LINES_SQL}, "
    + _trailing_sql("ln", "d", None, "video_id", "days_in_trending", GENERAL_NAMES, "DOUBLE"),
)
def sliding_periods(t: Tables) -> DataFrame:
    out = trailing_table(_lines(t), "d", PERIODS, "video_id", "days_in_trending", GENERAL_NAMES)
    return _rounded_means(out, GENERAL_NAMES).withColumn("d", day("d"))


@register("e12_add_period_features", _attached_sql(None, GENERAL_NAMES))
def add_period_features(t: Tables) -> DataFrame:
    out = add_trailing(
        _stored_life(t), "first_day_in_trending", PERIODS, "video_id", "days_in_trending", GENERAL_NAMES
    )
    names = [GENERAL_NAMES[k].format(n=p) for p in PERIODS for k in ("distinct", "max", "mean")]
    return _rounded_means(out.select("video_id", *names), GENERAL_NAMES)


@register(
    "e13_row_shift",
    """WITH d AS (SELECT CAST(l_shipdate AS DATE) AS d, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT strftime(d, '%Y-%m-%d') AS d, coalesce(lag(n, 7) OVER (ORDER BY d), 0) AS n FROM d""",
)
def row_shift(t: Tables) -> DataFrame:
    daily = t.lineitem.groupBy(F.to_date("l_shipdate").alias("d")).agg(F.count("*").alias("n"))
    return shifted_by_rows(daily, "d", ["n"], 7).withColumn("d", day("d"))


@register(
    "e14_monthly",
    f"""WITH {TREND_SQL} SELECT category_id, strftime(date_trunc('month', trending_date), '%Y-%m-%d') AS lower_boundary,
    strftime(date_trunc('month', trending_date) + INTERVAL 1 MONTH, '%Y-%m-%d') AS upper_boundary,
    count(DISTINCT video_id) AS videos_number FROM trend GROUP BY 1, 2, 3""",
)
def monthly(t: Tables) -> DataFrame:
    out = monthly_distinct(trend(t), "category_id", "trending_date", "video_id", "videos_number")
    return out.withColumns({c: day(c) for c in ("lower_boundary", "upper_boundary")})


@register(
    "e15_monthly_closed_both",
    f"""WITH {TREND_SQL}, m AS (SELECT category_id, video_id, date_trunc('month', trending_date) AS lo FROM trend
      UNION ALL SELECT category_id, video_id, date_trunc('month', trending_date) - INTERVAL 1 MONTH FROM trend WHERE day(trending_date) = 1)
    SELECT category_id, strftime(lo, '%Y-%m-%d') AS lower_boundary, strftime(lo + INTERVAL 1 MONTH, '%Y-%m-%d') AS upper_boundary,
    count(DISTINCT video_id) AS videos_number FROM m GROUP BY 1, 2, 3""",
)
def monthly_both(t: Tables) -> DataFrame:
    out = monthly_distinct(
        trend(t), "category_id", "trending_date", "video_id", "videos_number", closed="both"
    )
    return out.withColumns({c: day(c) for c in ("lower_boundary", "upper_boundary")})
