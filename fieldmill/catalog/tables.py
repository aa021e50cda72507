"""Projections, filters, joins, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import from_epoch
from ..functions.numbers import (
    allowed_levels,
    casts,
    flag,
    is_true,
    numeric_columns,
    other_columns,
    text_columns,
)
from ..operators.clean import filled, sentinel_to_null
from ..operators.joins import (
    attach,
    coordinates,
    join_original_features,
    key_overlap,
    mapped,
    mapped_from_dict,
    members,
    non_members,
    one_row_per_key,
)
from ..operators.profile import (
    best_row,
    distinct_counts,
    long_form,
    missing_counts,
    static_table,
    top_groups,
)
from ..operators.sketch import DISTINCT_BITS, distinct_sketches, united_distincts
from ..operators.split import pinned_entity_split, sampled, sampled_rows
from ..session import staged
from .base import Tables, as_long, day, moment, register, rounded
from .standins import GAPS_SQL, STATIC_SQL, LOANS_SQL, LOG_SQL, TREND_SQL, gaps, loans, log, trend


@register("b1_select", "SELECT o_orderkey, o_totalprice FROM orders")
def select(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice")


@register("b2_select_numeric", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def select_numeric(t: Tables) -> DataFrame:
    return t.orders.select(numeric_columns(t.orders))


@register("b2_select_text", "SELECT o_orderstatus, o_orderpriority FROM orders")
def select_text(t: Tables) -> DataFrame:
    return t.orders.select(text_columns(t.orders))


@register(
    "b2_select_other",
    "SELECT o_orderstatus, o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders",
)
def select_other(t: Tables) -> DataFrame:
    df = t.orders.select(other_columns(t.orders))
    return df.withColumn("o_orderdate", day("o_orderdate"))


@register(
    "b3_rename",
    "SELECT event_id AS uid, user_id AS source_ip, event_type AS dest_ip, value FROM events",
)
def rename(t: Tables) -> DataFrame:
    dotted = t.events.select("event_id", F.col("user_id").alias("id.orig_h"),
                             F.col("event_type").alias("id.resp_h"), "value")
    return dotted.withColumnsRenamed(
        {"event_id": "uid", "id.orig_h": "source_ip", "id.resp_h": "dest_ip"}
    )


@register("b4_drop", "SELECT event_id, user_id, event_type FROM events")
def drop(t: Tables) -> DataFrame:
    return t.events.drop("ts", "value", "props")


@register(
    "b5_many_columns",
    "SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net, "
    "l_quantity > 25 AS large, CAST(l_linenumber + 1 AS INTEGER) AS following FROM lineitem",
)
def many_columns(t: Tables) -> DataFrame:
    return t.lineitem.withColumns(
        {
            "net": F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4),
            "large": F.col("l_quantity") > 25,
            "following": (F.col("l_linenumber") + 1).cast("int"),
        }
    ).select("l_orderkey", "l_linenumber", "net", "large", "following")


@register(
    "b6_comparison",
    "SELECT l_orderkey, l_extendedprice FROM lineitem WHERE l_extendedprice < 1000 AND l_returnflag <> 'A'",
)
def comparison(t: Tables) -> DataFrame:
    return t.lineitem.where("l_extendedprice < 1000 and l_returnflag <> 'A'").select(
        "l_orderkey", "l_extendedprice"
    )


@register("b7_null_filter", f"WITH {GAPS_SQL} SELECT event_id, value FROM gaps WHERE value IS NULL")
def null_filter(t: Tables) -> DataFrame:
    return gaps(t).where(F.col("value").isNull()).select("event_id", "value")


@register(
    "b7_not_null_filter",
    f"WITH {GAPS_SQL} SELECT event_id, event_type FROM gaps WHERE event_type IS NOT NULL",
)
def not_null_filter(t: Tables) -> DataFrame:
    return gaps(t).where(F.col("event_type").isNotNull()).select("event_id", "event_type")


@register(
    "b8_constant_membership",
    "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('P')",
)
def constant_membership(t: Tables) -> DataFrame:
    df = t.orders.where(
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & ~F.col("o_orderstatus").isin("P")
    )
    return df.select("o_orderkey")


@register(
    "b8_data_membership",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN "
    "(SELECT c_custkey FROM customer WHERE c_acctbal < 0)",
)
def data_membership(t: Tables) -> DataFrame:
    poor = t.customer.where("c_acctbal < 0")
    return members(t.orders, "o_custkey", poor, "c_custkey").select("o_orderkey", "o_custkey")


@register(
    "b8_data_non_membership",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN "
    "(SELECT c_custkey FROM customer WHERE c_acctbal < 0)",
)
def data_non_membership(t: Tables) -> DataFrame:
    poor = t.customer.where("c_acctbal < 0")
    return non_members(t.orders, "o_custkey", poor, "c_custkey").select("o_orderkey", "o_custkey")


@register(
    "b9_flags",
    f"WITH {GAPS_SQL} SELECT event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_bad, "
    "coalesce(value > 50, false) AS is_large FROM gaps",
)
def flags(t: Tables) -> DataFrame:
    return gaps(t).select(
        "event_id",
        flag(F.col("event_type") == "error").alias("is_bad"),
        is_true(F.col("value") > 50).alias("is_large"),
    )


@register(
    "b10_allowed_levels",
    f"WITH {LOANS_SQL} SELECT loan_id, CASE WHEN rev_line IN ('Y', 'N') THEN rev_line ELSE 'Other' END AS rev_line FROM loans",
)
def allowed(t: Tables) -> DataFrame:
    return loans(t).select("loan_id", allowed_levels("rev_line", ["Y", "N"]).alias("rev_line"))


@register(
    "b11_bulk_cast",
    f"WITH {LOG_SQL} SELECT uid, TRY_CAST(duration AS DOUBLE) AS duration, TRY_CAST(orig_bytes AS DOUBLE) AS orig_bytes FROM log",
)
def bulk_cast(t: Tables) -> DataFrame:
    return log(t).withColumns(casts(["duration", "orig_bytes"])).select(
        "uid", "duration", "orig_bytes"
    )


@register(
    "b12_sentinel",
    f"WITH {LOG_SQL} SELECT uid, nullif(service, '-') AS service, nullif(duration, '-') AS duration FROM log",
)
def sentinel(t: Tables) -> DataFrame:
    return sentinel_to_null(log(t).select("uid", "service", "duration"))


@register(
    "b13_fill",
    f"WITH {LOG_SQL} SELECT uid, coalesce(nullif(service, '-'), 'missing') AS service, "
    "coalesce(TRY_CAST(duration AS DOUBLE), -999999) AS duration FROM log",
)
def fill(t: Tables) -> DataFrame:
    df = sentinel_to_null(log(t).select("uid", "service", "duration"))
    df = df.withColumns(casts(["duration"]))
    return filled(df, {"service": "missing", "duration": -999999}, ["service", "duration"])


@register(
    "b13_fill_zero",
    f"WITH {GAPS_SQL} SELECT event_id, coalesce(value, 0) AS value, coalesce(whole, 0) AS whole FROM gaps",
)
def fill_zero(t: Tables) -> DataFrame:
    return gaps(t).select("event_id", "value", "whole").fillna(0)


@register(
    "b14_unpivot_missing",
    f"""WITH {GAPS_SQL}, m AS (
      SELECT 'value' AS variable, count(*) - count(value) AS missing FROM gaps
      UNION ALL SELECT 'event_type', count(*) - count(event_type) FROM gaps
      UNION ALL SELECT 'user_id', count(*) - count(user_id) FROM gaps
      UNION ALL SELECT 'whole', count(*) - count(whole) FROM gaps
      UNION ALL SELECT 'event_id', count(*) - count(event_id) FROM gaps
      UNION ALL SELECT 'fixed', count(*) - count(fixed) FROM gaps)
    SELECT variable, missing FROM m WHERE missing > 0""",
)
def unpivot_missing(t: Tables) -> DataFrame:
    df = gaps(t)
    row = missing_counts(df).withColumnsRenamed({f"{c}_missing": c for c in df.columns})
    return long_form(row, df.columns, value="missing").where("missing > 0")


@register(
    "b14_unpivot_static",
    f"WITH {GAPS_SQL} " + STATIC_SQL,
)
def unpivot_static(t: Tables) -> DataFrame:
    df = gaps(t)
    return static_table(df, df.columns)


@register(
    "b15_sample_share",
    "SELECT event_id, value FROM events WHERE CAST('0x' || substr(md5('7:' || CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 10000 < 1000",
)
def sample_share(t: Tables) -> DataFrame:
    return sampled(t.events, 0.1, key="event_id").select("event_id", "value")


@register(
    "b15_sample_rows",
    "SELECT event_id, value FROM events ORDER BY CAST('0x' || substr(md5('7:' || CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT), event_id LIMIT 25",
)
def sample_rows(t: Tables) -> DataFrame:
    return sampled_rows(t.events, 25, "event_id").select("event_id", "value")


# --- joins --------------------------------------------------------------------


@register(
    "c1_key_overlap",
    """WITH a AS (SELECT DISTINCT l_suppkey AS k FROM lineitem), b AS (SELECT DISTINCT l_partkey AS k FROM lineitem)
    SELECT (SELECT count(*) FROM a) AS left_count, (SELECT count(*) FROM b) AS right_count,
           (SELECT count(*) FROM a JOIN b ON a.k = b.k) AS both_count""",
)
def overlap(t: Tables) -> DataFrame:
    return key_overlap(t.lineitem, "l_suppkey", t.lineitem, "l_partkey")


@register(
    "c2_original_features",
    f"""WITH {TREND_SQL}, main AS (SELECT video_id, min(trending_date) AS first_day FROM trend GROUP BY video_id),
    f AS (SELECT *, row_number() OVER (PARTITION BY video_id, trending_date ORDER BY views, likes) AS rn FROM trend)
    SELECT m.video_id, strftime(m.first_day, '%Y-%m-%d') AS first_day, f.views, f.likes
    FROM main m LEFT JOIN f ON m.video_id = f.video_id AND m.first_day = f.trending_date AND f.rn = 1""",
)
def original_features(t: Tables) -> DataFrame:
    rows = trend(t)
    main = rows.groupBy("video_id").agg(F.min("trending_date").alias("first_day"))
    out = join_original_features(
        main, rows, ["video_id", "first_day"], ["video_id", "trending_date"], ["views", "likes"]
    )
    return out.withColumn("first_day", day("first_day"))


@register(
    "c3_sampled_flag",
    """SELECT event_id, user_id, CASE WHEN CAST('0x' || substr(md5('7:' || CAST(user_id AS VARCHAR)), 1, 8) AS BIGINT) % 10000 < 8000
      THEN 1 END AS is_train FROM events""",
)
def sampled_flag(t: Tables) -> DataFrame:
    """Left join that marks the rows of sampled entities."""
    users = sampled(t.events.select("user_id").distinct(), 0.8, key="user_id").withColumn("is_train", F.lit(1))
    return t.events.join(users, "user_id", "left").select("event_id", "user_id", "is_train")


@register(
    "c4_attach_aggregates",
    """SELECT l_orderkey, l_linenumber, l_suppkey, n, round(mean_quantity, 6) AS mean_quantity FROM lineitem JOIN
    (SELECT l_suppkey AS s, l_linenumber AS ln, count(*) AS n, avg(l_quantity) AS mean_quantity FROM lineitem GROUP BY ALL)
    ON l_suppkey = s AND l_linenumber = ln""",
)
def attach_aggregates(t: Tables) -> DataFrame:
    keys = ["l_suppkey", "l_linenumber"]
    stats = t.lineitem.groupBy(*keys).agg(
        F.count("*").alias("n"), F.round(F.avg("l_quantity"), 6).alias("mean_quantity")
    )
    return attach(t.lineitem.select("l_orderkey", *keys), stats, keys)


@register(
    "c5_table_lookup",
    f"WITH {TREND_SQL} SELECT video_id, title, n_name AS category_id FROM trend LEFT JOIN nation ON category_id = n_nationkey",
)
def table_lookup(t: Tables) -> DataFrame:
    return mapped(
        trend(t).select("video_id", "title", "category_id"), "category_id", t.nation,
        "n_nationkey", "n_name",
    )


@register(
    "c5_dict_lookup",
    "SELECT event_id, CASE event_type WHEN 'click' THEN 'C' WHEN 'view' THEN 'V' END AS event_type FROM events",
)
def dict_lookup(t: Tables) -> DataFrame:
    return mapped_from_dict(
        t.events.select("event_id", "event_type"), "event_type", {"click": "C", "view": "V"}
    )


@register(
    "c6_coordinates",
    f"""WITH {LOANS_SQL} SELECT loan_id, n_nationkey * 1.5::DOUBLE - 20 AS longitude, n_regionkey * 10.25::DOUBLE AS latitude
    FROM loans LEFT JOIN nation ON zip = n_nationkey + 5""",
)
def zip_coordinates(t: Tables) -> DataFrame:
    # codes below 5 have no place
    places = t.nation.select(
        (F.col("n_nationkey") + 5).alias("code"),
        (F.col("n_nationkey") * F.lit(1.5) - 20).alias("lon"),
        (F.col("n_regionkey") * F.lit(10.25)).alias("lat"),
    )
    return coordinates(loans(t), "zip", places, "code", "lon", "lat").select(
        "loan_id", "longitude", "latitude"
    )


@register(
    "c3_pinned_split_sizes",
    """WITH d AS (SELECT user_id, CAST('0x' || substr(md5('200:' || CAST(user_id AS VARCHAR)), 1, 8) AS BIGINT) % 10000 AS draw FROM events)
    SELECT CASE WHEN user_id IN (1, 2) THEN 'train' WHEN user_id IN (3, 4) THEN 'test' WHEN draw < 8000 THEN 'train' ELSE 'test' END AS split,
    count(*) AS n, count(DISTINCT user_id) AS users FROM d GROUP BY 1""",
)
def pinned_split_sizes(t: Tables) -> DataFrame:
    train, test = pinned_entity_split(t.events, "user_id", [1, 2], [3, 4])
    return (
        train.select("user_id", F.lit("train").alias("split"))
        .unionAll(test.select("user_id", F.lit("test").alias("split")))
        .groupBy("split")
        .agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))
    )


# --- sorts and top-k ----------------------------------------------------------


@register(
    "f1_sorted",
    "SELECT o_orderstatus, o_orderkey, o_totalprice FROM orders ORDER BY o_orderstatus, o_totalprice DESC",
)
def sorted_rows(t: Tables) -> DataFrame:
    return t.orders.select("o_orderstatus", "o_orderkey", "o_totalprice").orderBy(
        "o_orderstatus", F.desc("o_totalprice")
    )


@register(
    "f2_top_groups",
    "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_suppkey LIMIT 5",
)
def top(t: Tables) -> DataFrame:
    return top_groups(t.lineitem, "l_suppkey", F.count("*"), "n", 5)


@register(
    "f3_bottom_groups",
    "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n, l_suppkey LIMIT 3",
)
def bottom(t: Tables) -> DataFrame:
    return top_groups(t.lineitem, "l_suppkey", F.count("*"), "n", 3, largest=False)


@register(
    "f4_top_levels_filter",
    """WITH top AS (SELECT l_suppkey FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, l_suppkey LIMIT 7)
    SELECT l_suppkey, CAST(sum(l_quantity) AS DOUBLE) AS quantity FROM lineitem WHERE l_suppkey IN (SELECT * FROM top) GROUP BY 1""",
)
def top_levels_filter(t: Tables) -> DataFrame:
    best = top_groups(t.lineitem, "l_suppkey", F.count("*"), "n", 7)
    return (
        members(t.lineitem, "l_suppkey", best)
        .groupBy("l_suppkey")
        .agg(F.sum("l_quantity").alias("quantity"))
    )


@register(
    "f5_best_row",
    """SELECT o_custkey, n, total FROM (SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total
    FROM orders GROUP BY 1) ORDER BY total DESC, o_custkey LIMIT 1""",
)
def best(t: Tables) -> DataFrame:
    spent = t.orders.groupBy("o_custkey").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )
    return best_row(spent, "total", ["o_custkey"])


# --- set operations -----------------------------------------------------------


@register(
    "g1_union",
    "SELECT o_orderkey AS id, o_totalprice AS amount FROM orders UNION ALL SELECT c_custkey, c_acctbal FROM customer",
)
def union(t: Tables) -> DataFrame:
    a = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"))
    b = t.customer.select(F.col("c_acctbal").alias("amount"), F.col("c_custkey").alias("id"))
    return a.unionByName(b)


@register(
    "g2_stack_metrics",
    """WITH m AS (SELECT o_orderpriority AS level, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders GROUP BY 1)
    SELECT level, 'lo' AS metric, lo AS score FROM m UNION ALL SELECT level, 'hi', hi FROM m""",
)
def stack_metrics(t: Tables) -> DataFrame:
    wide = t.orders.groupBy(F.col("o_orderpriority").alias("level")).agg(
        F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi")
    )
    return long_form(wide, ["lo", "hi"], "metric", "score", ["level"])


@register(
    "g3_intersection",
    "SELECT l_suppkey AS k FROM lineitem INTERSECT SELECT l_partkey FROM lineitem",
)
def intersection(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_suppkey").alias("k")).intersect(
        t.lineitem.select(F.col("l_partkey").alias("k"))
    )


@register("d25_distinct", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def distinct(t: Tables) -> DataFrame:
    return t.lineitem.select("l_returnflag", "l_linestatus").distinct()


@register(
    "d26_one_row_per_key",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
    ORDER BY o_totalprice, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def one_row(t: Tables) -> DataFrame:
    df = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return one_row_per_key(df, ["o_custkey"], ["o_totalprice", "o_orderkey"])


@register(
    "h1_from_epoch",
    f"WITH {LOG_SQL} SELECT uid, strftime(make_timestamp(CAST(floor(ts) AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS dt FROM log",
)
def epoch(t: Tables) -> DataFrame:
    return log(t).withColumn("dt", from_epoch("ts")).select("uid", moment("dt"))


@register(
    "d3_distinct_counts",
    """SELECT count(DISTINCT user_id) AS user_id, count(DISTINCT event_type) AS event_type,
    count(DISTINCT value) AS value, count(DISTINCT props) AS props FROM events""",
)
def distinct_values(t: Tables) -> DataFrame:
    return distinct_counts(t.events, ["user_id", "event_type", "value", "props"])


@register("d3_approximate_distinct_counts")
def approximate_distinct(t: Tables) -> DataFrame:
    return as_long(
        distinct_counts(t.events, ["user_id", "value"], approximate=True), "user_id", "value"
    )


@register(
    "d3_united_distinct_sketches",
    """WITH v AS (SELECT 'user_id' AS "column", CAST(user_id AS VARCHAR) AS value FROM events
    UNION ALL SELECT 'value', CAST(value AS VARCHAR) FROM events
    UNION ALL SELECT 'event_type', event_type FROM events)
    SELECT "column", count(*) AS rows, count(DISTINCT value) AS distinct_values, true AS within_error FROM v GROUP BY 1""",
)
def united_distinct_sketches(t: Tables) -> DataFrame:
    """Sketches of every column by day, written, read back and united; against exact counts."""
    columns = ["user_id", "value", "event_type"]
    daily = staged(distinct_sketches(t.events.withColumn("day", F.to_date("ts")), columns, ["day"]))
    exact = distinct_counts(t.events, columns).first()
    counted = F.create_map(*(x for c in columns for x in (F.lit(c), F.lit(exact[c]).cast("long"))))
    # three standard errors, and the spread of very few values
    allowed = 3 * F.lit(1.04 / 2 ** (DISTINCT_BITS / 2)) * F.col("distinct_values") + 1
    return (
        united_distincts(daily)
        .withColumn("distinct_values", counted[F.col("column")])
        .select(
            "column",
            "rows",
            "distinct_values",
            (F.abs(F.col("distinct_estimate") - F.col("distinct_values")) <= allowed).alias("within_error"),
        )
    )


@register(
    "d13_ratio_of_totals",
    f"""WITH {TREND_SQL} SELECT category_id, round(sum(comment_count) / sum(views), 9) AS comments_views_ratio
    FROM trend GROUP BY 1""",
)
def ratio_of_totals(t: Tables) -> DataFrame:
    totals = trend(t).groupBy("category_id").agg(
        F.try_divide(F.sum("comment_count"), F.sum("views")).alias("comments_views_ratio")
    )
    return rounded(totals, "comments_views_ratio", digits=9)
