"""The given tables seen as the kinds of input the operators are made for.

Each view exists twice: as a DataFrame and as a SQL common table expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Tables

# --- connection log -----------------------------------------------------------

LOG_SQL = """
log AS (
  SELECT epoch(ts) AS ts, event_id AS uid,
         'h' || CAST(user_id AS VARCHAR) AS source_ip,
         CAST(event_id % 97 AS INTEGER) AS source_port,
         'h' || CAST((user_id * 7 + event_id) % 53 AS VARCHAR) AS dest_ip,
         CAST(event_id % 11 AS INTEGER) AS dest_port,
         event_type AS proto,
         CASE WHEN event_id % 5 = 0 THEN '-' ELSE 's' || CAST(CAST(floor(value) AS BIGINT) % 12 AS VARCHAR) END AS service,
         'SF' AS conn_state,
         'k' || CAST(user_id % 40 AS VARCHAR) AS history,
         CASE WHEN event_id % 3 = 0 THEN '-' ELSE CAST(value AS VARCHAR) END AS duration,
         CASE WHEN event_id % 4 = 0 THEN '-' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS orig_bytes,
         CAST(floor(value) AS BIGINT) AS orig_pkts,
         CAST(round(value * 100) AS BIGINT) AS orig_ip_bytes,
         CASE WHEN event_type = 'error' THEN 'Malicious' ELSE 'Benign' END AS label
  FROM events
)"""


def log(t: Tables) -> DataFrame:
    """Connection log from ``events``, with ``-`` for missing values."""
    whole = F.floor("value")
    e = F.col("event_id")
    return t.events.select(
        (F.unix_micros("ts") / F.lit(1e6)).alias("ts"),
        e.alias("uid"),
        F.concat(F.lit("h"), F.col("user_id").cast("string")).alias("source_ip"),
        (e % 97).cast("int").alias("source_port"),
        F.concat(F.lit("h"), ((F.col("user_id") * 7 + e) % 53).cast("string")).alias("dest_ip"),
        (e % 11).cast("int").alias("dest_port"),
        F.col("event_type").alias("proto"),
        F.when(e % 5 == 0, "-")
        .otherwise(F.concat(F.lit("s"), (whole % 12).cast("string")))
        .alias("service"),
        F.lit("SF").alias("conn_state"),
        F.concat(F.lit("k"), (F.col("user_id") % 40).cast("string")).alias("history"),
        F.when(e % 3 == 0, "-").otherwise(F.col("value").cast("string")).alias("duration"),
        F.when(e % 4 == 0, "-").otherwise(whole.cast("string")).alias("orig_bytes"),
        whole.alias("orig_pkts"),
        F.round(F.col("value") * 100).cast("long").alias("orig_ip_bytes"),
        F.when(F.col("event_type") == "error", "Malicious").otherwise("Benign").alias("label"),
    )


# --- trending videos ----------------------------------------------------------

TREND_SQL = """
trend AS (
  SELECT l_partkey AS video_id, CAST(l_orderkey AS VARCHAR) AS title,
         CAST(l_shipdate AS DATE) AS trending_date, CAST(o_orderdate AS DATE) AS publish_time,
         l_suppkey AS channel_title, CAST(round(l_extendedprice * 100) AS BIGINT) AS views, l_quantity AS likes,
         CAST(round(l_discount * 100) AS BIGINT) AS dislikes,
         CAST(l_linenumber AS BIGINT) AS comment_count,
         CAST(l_suppkey % 30 AS INTEGER) AS category_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""


def trend(t: Tables) -> DataFrame:
    """Trending table: one row per part, ship day and order."""
    lines = t.lineitem.select(
        F.col("l_partkey").alias("video_id"),
        "l_orderkey",
        F.to_date("l_shipdate").alias("trending_date"),
        F.col("l_suppkey").alias("channel_title"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("views"),
        F.col("l_quantity").alias("likes"),
        F.round(F.col("l_discount") * 100).cast("long").alias("dislikes"),
        F.col("l_linenumber").cast("long").alias("comment_count"),
        (F.col("l_suppkey") % 30).cast("int").alias("category_id"),
    )
    dates = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("publish_time"))
    return lines.join(dates, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "video_id",
        F.col("l_orderkey").cast("string").alias("title"),
        "trending_date",
        "publish_time",
        "channel_title",
        "views",
        "likes",
        "dislikes",
        "comment_count",
        "category_id",
    )


LIFE_SQL = TREND_SQL + """,
lagged AS (SELECT *, date_diff('day', publish_time, trending_date) AS days_to_trending FROM trend),
life0 AS (
  SELECT video_id, CAST(min(days_to_trending) AS INTEGER) AS days_to_trending,
         min(trending_date) AS first_day_in_trending, max(trending_date) AS last_day_in_trending,
         CAST(date_diff('day', min(trending_date), max(trending_date)) AS INTEGER) AS days_in_trending
  FROM lagged GROUP BY video_id HAVING min(days_to_trending) <= 60
),
first_rows AS (
  SELECT *, row_number() OVER (PARTITION BY video_id
         ORDER BY trending_date, channel_title, category_id, views, likes, dislikes, comment_count) AS rn
  FROM lagged
),
life AS (
  SELECT a.*, f.channel_title, f.category_id, f.views, f.likes, f.dislikes, f.comment_count
  FROM life0 a JOIN first_rows f ON a.video_id = f.video_id AND f.rn = 1
)"""

LIFE_FEATURES = ("channel_title", "category_id", "views", "likes", "dislikes", "comment_count")


def life(t: Tables) -> DataFrame:
    """One row per video: first and last day, with its first row's columns."""
    from ..functions.dates import day_differences
    from ..operators.profile import lifecycle

    lagged = trend(t).withColumns(
        day_differences({"days_to_trending": ("trending_date", "publish_time")})
    )
    return lifecycle(lagged, "video_id", "trending_date", "days_to_trending", 60, LIFE_FEATURES)


# --- call graphs --------------------------------------------------------------

EDGES_SQL = """
edges AS (
  SELECT l_orderkey AS _id, l_suppkey AS "from", l_partkey AS "to", l_quantity AS weight
  FROM lineitem
)"""


def edges(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("_id"),
        F.col("l_suppkey").alias("from"),
        F.col("l_partkey").alias("to"),
        F.col("l_quantity").alias("weight"),
    )


# --- mails --------------------------------------------------------------------

MAILS_SQL = """
mails AS (
  SELECT conv_id, turn,
    CASE conv_id % 4
      WHEN 0 THEN 'From: "Mr. ' || role || '" <' || role || CAST(conv_id AS VARCHAR) || '@example.com>' || chr(10)
      WHEN 1 THEN 'From: ' || role || '@example.org' || chr(10)
      WHEN 2 THEN 'From: ' || role || ' <' || role || '@example.net>' || chr(10)
      ELSE '' END
    || 'Subject: turn ' || CAST(turn AS VARCHAR) || ' of ' || CAST(conv_id AS VARCHAR) || chr(10)
    || CASE turn % 3 WHEN 0 THEN 'Status: RO' WHEN 1 THEN 'Status: O' ELSE '' END
    || chr(10) || text AS emails
  FROM conversations
)"""


def mails(t: Tables) -> DataFrame:
    """Mail texts with headers from ``conversations``."""
    c, turn = F.col("conv_id"), F.col("turn")
    role = F.col("role")
    sender = (
        F.when(
            c % 4 == 0,
            F.concat(
                F.lit('From: "Mr. '), role, F.lit('" <'), role, c.cast("string"),
                F.lit("@example.com>\n"),
            ),
        )
        .when(c % 4 == 1, F.concat(F.lit("From: "), role, F.lit("@example.org\n")))
        .when(
            c % 4 == 2,
            F.concat(F.lit("From: "), role, F.lit(" <"), role, F.lit("@example.net>\n")),
        )
        .otherwise("")
    )
    status = F.when(turn % 3 == 0, "Status: RO").when(turn % 3 == 1, "Status: O").otherwise("")
    return t.conversations.select(
        "conv_id",
        "turn",
        F.concat(
            sender, F.lit("Subject: turn "), turn.cast("string"), F.lit(" of "),
            c.cast("string"), F.lit("\n"), status, F.lit("\n"), F.col("text"),
        ).alias("emails"),
    )


# --- loans --------------------------------------------------------------------

LOANS_SQL = """
loans AS (
  SELECT o_orderkey AS loan_id, c_mktsegment AS bank, n_name AS state,
         o_orderpriority AS city, c_custkey,
         CASE WHEN o_orderstatus = 'F' THEN 'charged' END AS chg_off_date,
         CASE o_orderkey % 4 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' WHEN 2 THEN '0' END AS rev_line,
         printf('$%d,%03d.%02d ', CAST(floor(o_totalprice / 1000) AS BIGINT),
                CAST(floor(o_totalprice) AS BIGINT) % 1000,
                CAST(o_orderkey % 100 AS BIGINT)) AS gr_appv,
         CAST(c_nationkey AS BIGINT) AS zip, CAST(extract(year FROM o_orderdate) AS INTEGER) AS approval_year,
         o_totalprice AS amount
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""


def loans(t: Tables) -> DataFrame:
    """Loan applications from ``orders``, ``customer`` and ``nation``."""
    k = F.col("o_orderkey")
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    price = F.col("o_totalprice")
    return joined.select(
        k.alias("loan_id"),
        F.col("c_mktsegment").alias("bank"),
        F.col("n_name").alias("state"),
        F.col("o_orderpriority").alias("city"),
        "c_custkey",
        F.when(F.col("o_orderstatus") == "F", "charged").alias("chg_off_date"),
        F.when(k % 4 == 0, "Y").when(k % 4 == 1, "N").when(k % 4 == 2, "0").alias("rev_line"),
        F.format_string(
            "$%d,%03d.%02d ", F.floor(price / 1000), F.floor(price) % 1000, k % 100
        ).alias("gr_appv"),
        F.col("c_nationkey").cast("long").alias("zip"),
        F.year("o_orderdate").alias("approval_year"),
        price.alias("amount"),
    )


# --- scores -------------------------------------------------------------------

SCORES_SQL = """
scores AS (
  SELECT l.doc_id, quality AS label, toxic, lang,
         n_chars / (n_chars + 2000.0::DOUBLE) AS score
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id
)"""


def scores(t: Tables) -> DataFrame:
    """Labelled scores between 0 and 1."""
    n = F.col("n_chars")
    docs = t.documents.select("doc_id", "lang", (n / (n + F.lit(2000.0))).alias("score"))
    return t.labels.join(docs, "doc_id").select(
        "doc_id", F.col("quality").alias("label"), "toxic", "lang", "score"
    )


EVENT_SCORES_SQL = """
event_scores AS (
  SELECT event_id, user_id, event_type, value AS score,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label,
         CASE WHEN event_id % 10 < 6 THEN 'train' WHEN event_id % 10 < 8 THEN 'val' ELSE 'test' END AS split
  FROM events
)"""


def event_scores(t: Tables) -> DataFrame:
    """All events as scored rows with a fixed split column."""
    e = F.col("event_id")
    return t.events.select(
        "event_id",
        "user_id",
        "event_type",
        F.col("value").alias("score"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("label"),
        F.when(e % 10 < 6, "train").when(e % 10 < 8, "val").otherwise("test").alias("split"),
    )


# --- nulls --------------------------------------------------------------------

GAPS_SQL = """
gaps AS (
  SELECT event_id,
         CASE WHEN event_id % 7 <> 0 THEN value END AS value,
         CASE WHEN event_id % 3 <> 0 THEN event_type END AS event_type,
         CASE WHEN event_id % 50 = 0 THEN user_id END AS user_id,
         CASE WHEN event_id % 2 = 0 THEN CAST(floor(value) AS BIGINT) END AS whole,
         5 AS fixed
  FROM events
)"""


GAPS = ("event_id", "value", "event_type", "user_id", "whole", "fixed")
# columns with one value, tested one by one
STATIC_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS variable FROM gaps HAVING count(DISTINCT {c}) = 1" for c in GAPS
)


def gaps(t: Tables) -> DataFrame:
    """Events with missing values; ``user_id`` is missing nearly everywhere."""
    e = F.col("event_id")
    return t.events.select(
        "event_id",
        F.when(e % 7 != 0, F.col("value")).alias("value"),
        F.when(e % 3 != 0, F.col("event_type")).alias("event_type"),
        F.when(e % 50 == 0, F.col("user_id")).alias("user_id"),
        F.when(e % 2 == 0, F.floor("value")).alias("whole"),
        F.lit(5).alias("fixed"),
    )
