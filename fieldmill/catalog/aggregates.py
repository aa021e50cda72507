"""Profiling, grouped summaries and graph features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import is_true, safe_log
from ..operators import profile as P
from ..operators.graph import degree_features, graph_sizes, node_statistics
from ..operators.ordered import approximate_quantiles, quantiles
from ..operators.sketch import RANK_ERROR, quantile_sketches, united_quantiles
from ..operators.split import split_sizes
from ..session import staged
from .base import Tables, as_long, day, moment, register, rounded
from .standins import (
    EDGES_SQL,
    EVENT_SCORES_SQL,
    GAPS,
    GAPS_SQL,
    STATIC_SQL,
    LIFE_FEATURES,
    LIFE_SQL,
    LOANS_SQL,
    TREND_SQL,
    edges,
    event_scores,
    gaps,
    life,
    loans,
    trend,
)


@register(
    "d1_time_span",
    "SELECT strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS min_date, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS max_date FROM events",
)
def time_span(t: Tables) -> DataFrame:
    return P.time_span(t.events, "ts").select(moment("min_date"), moment("max_date"))


@register("d2_row_count", "SELECT count(*) AS n FROM lineitem")
def row_count(t: Tables) -> DataFrame:
    return t.lineitem.agg(F.count("*").alias("n"))


@register(
    "d4_missing_counts",
    f"""WITH {GAPS_SQL} SELECT count(*) - count(event_id) AS event_id_missing, count(*) - count(value) AS value_missing,
    count(*) - count(event_type) AS event_type_missing, count(*) - count(user_id) AS user_id_missing,
    count(*) - count(whole) AS whole_missing, count(*) - count(fixed) AS fixed_missing FROM gaps""",
)
def missing_counts(t: Tables) -> DataFrame:
    return P.missing_counts(gaps(t))


@register(
    "d5_missing_shares",
    f"WITH {GAPS_SQL} SELECT " + ", ".join(f"round(1 - count({c}) / count(*), 6) AS {c}" for c in GAPS) + " FROM gaps",
)
def missing_shares(t: Tables) -> DataFrame:
    df = gaps(t)
    return rounded(P.missing_shares(df), *df.columns)


@register(
    "d6_static_columns",
    f"WITH {GAPS_SQL} " + STATIC_SQL,
)
def static_columns(t: Tables) -> DataFrame:
    df = gaps(t)
    return P.static_table(df, df.columns)


@register(
    "d7_value_counts",
    "SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY 1 ORDER BY 2 DESC, 1",
)
def value_counts(t: Tables) -> DataFrame:
    return P.value_counts(t.orders, "o_orderpriority")


@register(
    "d8_counts_with_share",
    "SELECT event_type, count(*) AS count, round(count(*) / (SELECT count(*) FROM events), 4) AS percent FROM events GROUP BY 1",
)
def counts_with_share(t: Tables) -> DataFrame:
    return P.counts_with_share(t.events, "event_type")


@register(
    "d9_group_sum",
    f"""WITH {TREND_SQL} SELECT category_id, strftime(trending_date, '%Y-%m-%d') AS trending_date, CAST(sum(views) AS BIGINT) AS views
    FROM trend GROUP BY 1, 2""",
)
def group_sum(t: Tables) -> DataFrame:
    out = trend(t).groupBy("category_id", "trending_date").agg(F.sum("views").alias("views"))
    return out.withColumn("trending_date", day("trending_date"))


@register(
    "d10_group_mean_having",
    """SELECT user_id, round(avg(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END), 6) AS bad_avg FROM events GROUP BY 1
    HAVING avg(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) > 0.2""",
)
def group_mean_having(t: Tables) -> DataFrame:
    bad = F.avg((F.col("event_type") == "error").cast("int"))
    out = t.events.groupBy("user_id").agg(bad.alias("bad_avg")).where("bad_avg > 0.2")
    return rounded(out, "bad_avg")


@register(
    "d11_group_median",
    f"WITH {TREND_SQL} SELECT category_id, round(median(views), 4) AS median_views FROM trend GROUP BY 1",
)
def group_median(t: Tables) -> DataFrame:
    out = quantiles(trend(t), "views", {"median_views": 0.5}, ["category_id"])
    return rounded(out, "median_views", digits=4)


@register(
    "d12_popularity",
    f"""WITH {TREND_SQL} SELECT channel_title, count(*) AS trending_count, count(DISTINCT title) AS number_of_trending_videos,
    CAST(sum(views) AS BIGINT) AS total_views, round(avg(views), 4) AS average_views,
    sum(likes) AS total_likes, round(avg(likes), 4) AS average_likes FROM trend GROUP BY 1""",
)
def popularity(t: Tables) -> DataFrame:
    out = P.popularity(trend(t), "channel_title", "title", ["views", "likes", "not_there"])
    return rounded(out, "average_views", "average_likes", digits=4)


@register(
    "d14_lifecycle",
    f"""WITH {LIFE_SQL} SELECT video_id, days_to_trending, strftime(first_day_in_trending, '%Y-%m-%d') AS first_day_in_trending,
    strftime(last_day_in_trending, '%Y-%m-%d') AS last_day_in_trending, days_in_trending,
    channel_title, category_id, views, likes, dislikes, comment_count FROM life""",
)
def lifecycle(t: Tables) -> DataFrame:
    return life(t).select(
        "video_id",
        "days_to_trending",
        day("first_day_in_trending"),
        day("last_day_in_trending"),
        "days_in_trending",
        *LIFE_FEATURES,
    )


@register(
    "d15_frequent_means",
    f"""WITH {LIFE_SQL} SELECT channel_title, round(avg(days_in_trending), 6) AS days_in_trending FROM life
    GROUP BY 1 HAVING count(*) >= 10""",
)
def frequent_means(t: Tables) -> DataFrame:
    return rounded(
        P.frequent_means(life(t), "channel_title", 10, "days_in_trending"), "days_in_trending"
    )


@register(
    "d15_slowest_channels",
    f"""WITH {LIFE_SQL} SELECT channel_title, round(avg(days_in_trending), 6) AS days_in_trending FROM life
    GROUP BY 1 HAVING count(*) >= 5 ORDER BY avg(days_in_trending) DESC, channel_title LIMIT 3""",
)
def slowest_channels(t: Tables) -> DataFrame:
    means = P.frequent_means(life(t), "channel_title", 5, "days_in_trending")
    last = means.orderBy(F.desc("days_in_trending"), "channel_title").limit(3)
    return rounded(last, "days_in_trending")


@register(
    "d16_mean_and_median",
    f"WITH {LIFE_SQL} SELECT round(avg(days_to_trending), 6) AS mean, round(median(days_to_trending), 6) AS median FROM life",
)
def mean_and_median(t: Tables) -> DataFrame:
    df = life(t)
    mid = quantiles(df, "days_to_trending", {"median": 0.5})
    return rounded(
        mid.select(df.agg(F.avg("days_to_trending")).scalar().alias("mean"), "median"),
        "mean",
        "median",
    )


def _describe_sql(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS variable, count({c}) AS count, count(*) - count({c}) AS null_count, round(avg({c}), 4) AS mean, "
        f"round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
        f"round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50, round(quantile_cont({c}, 0.75), 4) AS q75 FROM {table}"
        for c in cols
    )


@register("d17_describe", f"WITH {GAPS_SQL} " + _describe_sql("gaps", ["value", "whole", "user_id"]))
def describe(t: Tables) -> DataFrame:
    out = P.describe(gaps(t), ["value", "whole", "user_id"])
    return rounded(out, "mean", "std", "q25", "q50", "q75", digits=4)


@register(
    "d18_target_rate",
    f"WITH {LOANS_SQL} SELECT state, round(avg(CASE WHEN chg_off_date IS NOT NULL THEN 1 ELSE 0 END), 6) AS is_default FROM loans GROUP BY 1",
)
def target_rate(t: Tables) -> DataFrame:
    df = loans(t).withColumn("is_default", is_true(F.col("chg_off_date").isNotNull()).cast("int"))
    return rounded(P.target_rate(df, "state", "is_default"), "is_default")


@register(
    "d19_proportions",
    """SELECT o_orderpriority, o_orderstatus, count(*) AS count, CAST(sum(count(*)) OVER (PARTITION BY o_orderpriority) AS BIGINT) AS total,
    round(count(*) / sum(count(*)) OVER (PARTITION BY o_orderpriority), 6) AS proportion FROM orders GROUP BY 1, 2""",
)
def proportions(t: Tables) -> DataFrame:
    return rounded(P.proportions(t.orders, "o_orderpriority", "o_orderstatus"), "proportion")


@register(
    "d20_node_statistics",
    f"""WITH {EDGES_SQL} SELECT _id, round(avg(weight), 6) AS avg_weight, min(weight) AS min_weight, max(weight) AS max_weight,
    round(stddev_samp(weight), 6) AS std_weight FROM edges GROUP BY 1""",
)
def node_stats(t: Tables) -> DataFrame:
    return rounded(node_statistics(edges(t), ["weight"]), "avg_weight", "std_weight")


@register(
    "d21_graph_sizes",
    f"""WITH {EDGES_SQL}, ends AS (SELECT _id, "from" AS node FROM edges UNION ALL SELECT _id, "to" FROM edges)
    SELECT _id, count(*) // 2 AS n_connections, count(DISTINCT node) AS n_unique_nodes FROM ends GROUP BY 1""",
)
def sizes(t: Tables) -> DataFrame:
    return graph_sizes(edges(t))


_DEGREES_SQL = """
gs AS (SELECT "from" AS k, count(*) AS n FROM edges GROUP BY 1), gd AS (SELECT "to" AS k, count(*) AS n FROM edges GROUP BY 1),
ls AS (SELECT _id, "from" AS k, count(*) AS n FROM edges GROUP BY 1, 2), ld AS (SELECT _id, "to" AS k, count(*) AS n FROM edges GROUP BY 1, 2),
deg AS (SELECT e._id, e."from", e."to", gs.n AS global_source_degrees, gd.n AS global_dest_degrees, ls.n AS local_source_degrees, ld.n AS local_dest_degrees
  FROM edges e JOIN gs ON e."from" = gs.k JOIN gd ON e."to" = gd.k JOIN ls ON e._id = ls._id AND e."from" = ls.k JOIN ld ON e._id = ld._id AND e."to" = ld.k),
ends AS (SELECT _id, "from" AS node FROM edges UNION ALL SELECT _id, "to" FROM edges),
sizes AS (SELECT _id, count(*) // 2 AS n_connections, count(DISTINCT node) AS n_unique_nodes FROM ends GROUP BY 1)"""
_DEGREE_NAMES = ("global_source_degrees", "global_dest_degrees", "local_source_degrees", "local_dest_degrees")


@register(
    "d21_graph_features",
    f"WITH {EDGES_SQL}, {_DEGREES_SQL}, stats AS (SELECT _id, "
    + ", ".join(
        f"round(avg({f}), 6) AS avg_{f}, min({f}) AS min_{f}, max({f}) AS max_{f}, round(stddev_samp({f}), 6) AS std_{f}"
        for f in _DEGREE_NAMES
    )
    + " FROM deg GROUP BY 1) SELECT n_connections, n_unique_nodes, stats.* FROM sizes JOIN stats ON sizes._id = stats._id",
)
def full_graph_features(t: Tables) -> DataFrame:
    out = degree_features(edges(t))
    floats = [f"{k}_{f}" for f in _DEGREE_NAMES for k in ("avg", "std")]
    return rounded(out, *floats)


@register(
    "d22_spreads",
    """SELECT round(stddev_samp(l_quantity), 6) AS l_quantity, round(stddev_samp(l_discount), 6) AS l_discount,
    round(stddev_samp(l_tax), 6) AS l_tax FROM lineitem""",
)
def spreads(t: Tables) -> DataFrame:
    cols = ["l_quantity", "l_discount", "l_tax"]
    return rounded(P.spreads(t.lineitem, cols), *cols)


@register(
    "d23_quantiles_linear",
    """SELECT round(quantile_cont(value, 0.1), 6) AS p10, round(quantile_cont(value, 0.5), 6) AS p50,
    round(quantile_cont(value, 0.95), 6) AS p95 FROM events""",
)
def quantiles_linear(t: Tables) -> DataFrame:
    out = quantiles(t.events, "value", {"p10": 0.1, "p50": 0.5, "p95": 0.95})
    return rounded(out, "p10", "p50", "p95")


@register(
    "d23_quantiles_discrete",
    """SELECT event_type, quantile_disc(value, 0.1) AS p10, quantile_disc(value, 0.8) AS p80 FROM events GROUP BY 1""",
)
def quantiles_discrete(t: Tables) -> DataFrame:
    return quantiles(
        t.events, "value", {"p10": 0.1, "p80": 0.8}, ["event_type"], mode="discrete"
    )


@register(
    "d23_quantiles_nearest",
    """WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS rk,
      count(*) OVER (PARTITION BY event_type) AS n FROM events)
    SELECT event_type, max(CASE WHEN rk = CAST(floor(0.8::DOUBLE * (n - 1) + 0.5) AS BIGINT) THEN value END) AS p80 FROM r GROUP BY 1""",
)
def quantiles_nearest(t: Tables) -> DataFrame:
    return quantiles(t.events, "value", {"p80": 0.8}, ["event_type"], mode="nearest")


@register("d23_quantiles_approximate")
def quantiles_approximate(t: Tables) -> DataFrame:
    return approximate_quantiles(t.lineitem, "l_extendedprice", {"p50": 0.5, "p90": 0.9}, ["l_returnflag"])


@register(
    "d23_united_quantile_sketches",
    """SELECT c AS "column", count(*) AS n, CAST(s AS DOUBLE) AS share, true AS rank_within_error
    FROM lineitem, (SELECT unnest(['l_quantity', 'l_extendedprice']) AS c), (SELECT unnest([0.01, 0.25, 0.5, 0.9, 0.99]) AS s)
    GROUP BY c, s""",
)
def united_quantile_sketches(t: Tables) -> DataFrame:
    """Quantiles from sketches by month, written, read back and united; ranks from all rows."""
    columns, shares = ["l_quantity", "l_extendedprice"], [0.01, 0.25, 0.5, 0.9, 0.99]
    rows = t.lineitem.withColumn("month", F.date_trunc("month", "l_shipdate"))
    found = united_quantiles(staged(quantile_sketches(rows, columns, ["month"])), shares)
    estimates = [(r["column"], r["share"], r["estimate"]) for r in found.collect()]
    ranks = rows.agg(
        F.array(
            *(
                F.struct(
                    F.lit(c).alias("column"),
                    F.count(c).alias("n"),
                    F.lit(s).alias("share"),
                    F.sum((F.col(c) < e).cast("long")).alias("below"),
                    F.sum((F.col(c) <= e).cast("long")).alias("upto"),
                )
                for c, s, e in estimates
            )
        ).alias("all")
    ).select(F.explode("all").alias("r")).select("r.*")
    wanted, error = F.col("share") * F.col("n"), F.lit(RANK_ERROR) * F.col("n") + 1
    return ranks.select(
        "column",
        "n",
        "share",
        ((F.col("below") <= wanted + error) & (F.col("upto") >= wanted - error)).alias("rank_within_error"),
    )


@register(
    "d24_fill_values",
    f"""WITH {GAPS_SQL}, c AS (SELECT event_type AS value, count(*) AS n FROM gaps WHERE event_type IS NOT NULL GROUP BY 1),
    w AS (SELECT CAST(whole AS VARCHAR) AS value, count(*) AS n FROM gaps WHERE whole IS NOT NULL GROUP BY 1)
    SELECT 'event_type' AS variable, (SELECT value FROM c ORDER BY n DESC, value LIMIT 1) AS value
    UNION ALL SELECT 'whole', (SELECT value FROM w ORDER BY n DESC, value LIMIT 1)""",
)
def fill_values(t: Tables) -> DataFrame:
    return P.most_frequent(gaps(t), ["event_type", "whole"])


_FIVE_SQL = """round(min({c}), 4) AS minimum, round(quantile_cont({c}, 0.25), 4) AS q1, round(quantile_cont({c}, 0.5), 4) AS median,
round(quantile_cont({c}, 0.75), 4) AS q3, round(max({c}), 4) AS maximum"""


@register(
    "d27_five_numbers_by_bin",
    f"""WITH e AS (SELECT list_distinct(quantile_cont(o_totalprice, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS edges FROM orders),
    b AS (SELECT CAST(len(list_filter(edges, lambda x: o_totalprice > x)) AS INTEGER) AS bin, o_orderstatus,
      CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS age FROM orders, e)
    SELECT bin, o_orderstatus, {_FIVE_SQL.format(c='age')} FROM b GROUP BY 1, 2""",
)
def five_by_bin(t: Tables) -> DataFrame:
    df = t.orders.withColumn(
        "age", F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date")).cast("double")
    )
    out = P.five_numbers_by_bin(df, "o_totalprice", "age", "o_orderstatus")
    return rounded(out, *P.FIVE, digits=4)


@register(
    "d28_five_numbers",
    f"""WITH {TREND_SQL}, v AS (SELECT category_id, ln(views) AS x FROM trend WHERE views > 0)
    SELECT category_id, {_FIVE_SQL.format(c='x')} FROM v GROUP BY 1""",
)
def five(t: Tables) -> DataFrame:
    df = trend(t).withColumn("x", safe_log("views"))
    return rounded(P.five_numbers(df, "x", ["category_id"]), *P.FIVE, digits=4)


@register(
    "d29_histogram",
    """WITH b AS (SELECT event_type, CASE WHEN value < 0 THEN 0 WHEN value > 200 THEN 21 ELSE least(CAST(floor(value / 10) AS INTEGER) + 1, 20) END AS bin FROM events WHERE value IS NOT NULL)
    SELECT event_type, bin, count(*) AS count, round(count(*) / sum(count(*)) OVER (PARTITION BY event_type), 6) AS share FROM b GROUP BY 1, 2""",
)
def histogram(t: Tables) -> DataFrame:
    out = P.histogram(t.events, "value", 0.0, 200.0, 20, "event_type")
    return rounded(out, "share")


@register(
    "d29_log_histogram",
    """WITH p AS (SELECT ln(l_extendedprice) AS x FROM lineitem WHERE l_extendedprice > 0),
    b AS (SELECT CASE WHEN x < 0 THEN 0 WHEN x > 14 THEN 29 ELSE least(CAST(floor(x / 0.5) AS INTEGER) + 1, 28) END AS bin FROM p)
    SELECT bin, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM b GROUP BY 1""",
)
def log_histogram(t: Tables) -> DataFrame:
    out = P.histogram(t.lineitem, safe_log("l_extendedprice"), 0.0, 14.0, 28)
    return rounded(out, "share")


@register(
    "d30_latency_summary",
    "SELECT round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.95), 6) AS p95, max(value) AS max FROM events",
)
def latency(t: Tables) -> DataFrame:
    return rounded(P.latency_summary(t.events, "value"), "median", "p95")


@register(
    "d31_timed_counts",
    """SELECT unit, strftime(bucket, '%Y-%m-%d %H:%M:%S') AS bucket, event_type, count(*) AS counts FROM (
      SELECT 'day' AS unit, date_trunc('day', ts)::TIMESTAMP AS bucket, event_type FROM events
      UNION ALL SELECT 'hour', date_trunc('hour', ts), event_type FROM events
      UNION ALL SELECT 'minute', date_trunc('minute', ts), event_type FROM events) GROUP BY 1, 2, 3""",
)
def timed_counts(t: Tables) -> DataFrame:
    out = P.timed_counts(t.events, "ts", ["day", "hour", "minute"], "event_type")
    return out.withColumn("bucket", moment("bucket"))


@register(
    "d32_ranked_entities",
    """SELECT user_id, CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS bad_sum FROM events GROUP BY 1
    ORDER BY bad_sum DESC, user_id LIMIT 5""",
)
def ranked_entities(t: Tables) -> DataFrame:
    bad = F.sum((F.col("event_type") == "error").cast("long"))
    return P.top_groups(t.events, "user_id", bad, "bad_sum", 5)


@register(
    "d33_split_sizes",
    f"WITH {EVENT_SCORES_SQL} SELECT split, count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives FROM event_scores GROUP BY 1",
)
def sizes_of_splits(t: Tables) -> DataFrame:
    return as_long(split_sizes(event_scores(t), "label"), "positives")
