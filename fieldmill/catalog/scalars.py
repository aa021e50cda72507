"""Scalar functions, text functions and the UDF surface."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_parts, day_differences, parsed_dates, parsed_timestamp, truncated
from ..functions.numbers import (
    allowed_levels,
    basic_features,
    flag,
    money,
    portable_hash,
    ratios,
    safe_log,
    stable_hash,
)
from ..functions.text import cleaned, header_fields, kept_tokens, text_measures, tokens
from .base import Tables, day, moment, register, rounded
from .standins import LOANS_SQL, MAILS_SQL, TREND_SQL, edges, loans, mails, trend, EDGES_SQL

# A short stop-word list for the queries below.
STOPWORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "from", "has", "have",
    "he", "her", "his", "in", "is", "it", "its", "not", "of", "on", "or", "our", "she",
    "that", "the", "their", "they", "this", "to", "was", "we", "were", "will", "with", "you",
)
_STOP_SQL = ", ".join(f"'{w}'" for w in STOPWORDS)


@register(
    "h2_truncate",
    """SELECT event_id, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS day,
    strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour,
    strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS minute,
    strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS second FROM events""",
)
def truncate(t: Tables) -> DataFrame:
    units = ["day", "hour", "minute", "second"]
    return t.events.withColumns(truncated("ts", units)).select(
        "event_id", *(moment(u) for u in units)
    )


@register(
    "h3_parse_dates",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS trending_date,
    CASE WHEN o_orderkey % 9 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS publish_time FROM orders""",
)
def parse_dates(t: Tables) -> DataFrame:
    stamp = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T08:15:00.000Z"))
    text = t.orders.select(
        "o_orderkey",
        F.date_format("o_orderdate", "yy.dd.MM").alias("trending_date"),
        F.when(F.col("o_orderkey") % 9 == 0, "unknown").otherwise(stamp).alias("publish_time"),
    )
    parsed = text.withColumns(
        parsed_dates(
            {"trending_date": "yy.dd.MM", "publish_time": "yyyy-MM-dd'T'HH:mm:ss[.SSS]X"}
        )
    )
    return parsed.select("o_orderkey", day("trending_date"), day("publish_time"))


@register(
    "h4_parse_timestamps",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS automatic, strftime(ts, '%Y-%m-%d %H:%M:%S') AS explicit FROM events""",
)
def parse_timestamps(t: Tables) -> DataFrame:
    text = t.events.select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("a"),
        F.date_format("ts", "dd/MM/yyyy HH:mm:ss").alias("b"),
    )
    return text.withColumns(
        {"automatic": parsed_timestamp("a"), "explicit": parsed_timestamp("b", "dd/MM/yyyy HH:mm:ss")}
    ).select("event_id", moment("automatic"), moment("explicit"))


@register(
    "h5_date_parts",
    """SELECT o_orderkey, CAST(isodow(o_orderdate) AS INTEGER) AS o_orderdate_weekday,
    CAST(month(o_orderdate) AS INTEGER) AS o_orderdate_month, CAST(year(o_orderdate) AS INTEGER) AS o_orderdate_year FROM orders""",
)
def parts(t: Tables) -> DataFrame:
    built = date_parts({"o_orderdate": ["weekday", "month", "year"]})
    return t.orders.withColumns(built).select("o_orderkey", *built)


@register(
    "h6_day_differences",
    f"""WITH {TREND_SQL} SELECT video_id, title, CAST(date_diff('day', publish_time, trending_date) AS INTEGER) AS days_to_trending FROM trend""",
)
def differences(t: Tables) -> DataFrame:
    built = day_differences({"days_to_trending": ("trending_date", "publish_time")})
    return trend(t).withColumns(built).select("video_id", "title", *built)


@register("h7_to_date", "SELECT event_id, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day FROM events")
def to_date(t: Tables) -> DataFrame:
    return t.events.withColumn("day", F.to_date("ts")).select("event_id", day("day"))


@register(
    "h8_ratios",
    f"""WITH {TREND_SQL} SELECT video_id, title, round(likes / nullif(dislikes, 0), 6) AS likes_to_dislikes,
    round(likes / nullif(views, 0), 9) AS likes_to_views, round(comment_count / nullif(views, 0), 9) AS comments_to_views FROM trend""",
)
def ratio(t: Tables) -> DataFrame:
    built = ratios(
        {
            "likes_to_dislikes": ("likes", "dislikes"),
            "likes_to_views": ("likes", "views"),
            "comments_to_views": ("comment_count", "views"),
        }
    )
    df = trend(t).withColumns(built).select("video_id", "title", *built)
    df = rounded(df, "likes_to_dislikes")
    return rounded(df, "likes_to_views", "comments_to_views", digits=9)


@register(
    "h9_basic_features",
    f"""WITH {TREND_SQL} SELECT video_id, title, round(likes / nullif(dislikes, 0), 6) AS likes_to_dislikes,
    CAST(date_diff('day', publish_time, trending_date) AS INTEGER) AS days_to_trending,
    CAST(isodow(trending_date) AS INTEGER) AS trending_date_weekday FROM trend""",
)
def basic(t: Tables) -> DataFrame:
    df = basic_features(
        trend(t),
        {"likes_to_dislikes": ("likes", "dislikes")},
        {"days_to_trending": ("trending_date", "publish_time")},
        {"trending_date": ["weekday"]},
    )
    return rounded(df, "likes_to_dislikes").select(
        "video_id", "title", "likes_to_dislikes", "days_to_trending", "trending_date_weekday"
    )


@register(
    "h10_log",
    "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN round(ln(c_acctbal), 6) END AS log_balance FROM customer",
)
def logarithm(t: Tables) -> DataFrame:
    df = t.customer.withColumn("log_balance", safe_log("c_acctbal"))
    return rounded(df, "log_balance").select("c_custkey", "log_balance")


@register("h11_round", "SELECT event_id, round(value, 1) AS value FROM events")
def rounding(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.round("value", 1).alias("value"))


_HEADER_SQL = f"""WITH {MAILS_SQL}, h AS (
  SELECT *, regexp_extract(emails, 'From:\\s*"?([^"<]+)"?\\s*<([^>]+)>', 1) AS n1,
    regexp_extract(emails, 'From:\\s*"?([^"<]+)"?\\s*<([^>]+)>', 2) AS e1,
    regexp_matches(emails, 'From:\\s*"?([^"<]+)"?\\s*<([^>]+)>') AS named,
    regexp_extract(emails, 'From:\\s*([^<\\n\\s]+)', 1) AS e2,
    regexp_matches(emails, 'From:\\s*([^<\\n\\s]+)') AS bare,
    CASE WHEN strpos(emails, 'Status: RO') > 0
      THEN left(emails, strpos(emails, 'Status: RO') - 1) || 'Status: O' || substr(emails, strpos(emails, 'Status: RO') + 10)
      ELSE emails END AS marked
  FROM mails)
"""


@register(
    "h12_header_fields",
    _HEADER_SQL
    + """SELECT conv_id, turn, CASE WHEN named THEN e1 WHEN bare THEN e2 END AS sender_email,
    CASE WHEN named THEN n1 END AS sender_name,
    CASE WHEN regexp_matches(emails, 'Subject:\\s*[^\\n]*') THEN regexp_extract(emails, 'Subject:\\s*([^\\n]*)', 1) END AS subject FROM h""",
)
def headers(t: Tables) -> DataFrame:
    built = header_fields("emails")
    return mails(t).withColumns(built).select(
        "conv_id", "turn", "sender_email", "sender_name", "subject"
    )


@register(
    "h13_body",
    _HEADER_SQL + "SELECT conv_id, turn, string_split(marked, 'Status: O')[2] AS email_text FROM h",
)
def mail_body(t: Tables) -> DataFrame:
    built = header_fields("emails")
    return mails(t).withColumns(built).select("conv_id", "turn", "email_text")


@register(
    "h14_text_measures",
    """SELECT doc_id, CAST(length(text) AS INTEGER) AS text_length,
    round(length(regexp_replace(text, '[^A-Z]', '', 'g')) / nullif(length(text), 0), 9) AS text_percent_capital,
    round(length(regexp_replace(text, '[A-Za-z ]', '', 'g')) / nullif(length(text), 0), 9) AS text_percent_digits FROM documents""",
)
def measures(t: Tables) -> DataFrame:
    built = text_measures("text")
    df = t.documents.withColumns(built).select("doc_id", *built)
    return rounded(df, "text_percent_capital", "text_percent_digits", digits=9)


_CLEAN_SQL = (
    "lower(regexp_replace(regexp_replace(regexp_replace({c}, '<[^\\n]*?>', ' ', 'g'), "
    "'[^a-zA-Z\\s]+', ' ', 'g'), '\\s+', ' ', 'g'))"
)


@register("h15_clean_pages", f"SELECT page_id, {_CLEAN_SQL.format(c='html')} AS clean FROM pages")
def clean_pages(t: Tables) -> DataFrame:
    return t.pages.select("page_id", cleaned("html").alias("clean"))


@register("h15_clean_documents", f"SELECT doc_id, {_CLEAN_SQL.format(c='text')} AS clean FROM documents")
def clean_documents(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", cleaned("text").alias("clean"))


@register(
    "h16_tokens",
    f"""WITH w AS (SELECT doc_id, string_split({_CLEAN_SQL.format(c='text')}, ' ') AS words FROM documents)
    SELECT doc_id, CAST(len(words) AS INTEGER) AS n_tokens, md5(array_to_string(words, '|')) AS digest FROM w""",
)
def tokenised(t: Tables) -> DataFrame:
    df = t.documents.select("doc_id", cleaned("text").alias("clean"))
    words = df.select("doc_id", tokens("clean").alias("words"))
    return words.select(
        "doc_id",
        F.size("words").alias("n_tokens"),
        F.md5(F.concat_ws("|", "words")).alias("digest"),
    )


@register(
    "h17_kept_tokens",
    f"""WITH w AS (SELECT doc_id, list_filter(string_split({_CLEAN_SQL.format(c='text')}, ' '),
      lambda x: length(x) > 2 AND NOT list_contains([{_STOP_SQL}], x)) AS words FROM documents)
    SELECT doc_id, CAST(len(words) AS INTEGER) AS n_tokens, md5(array_to_string(words, '|')) AS digest FROM w""",
)
def without_stop_words(t: Tables) -> DataFrame:
    df = t.documents.select("doc_id", tokens_of_clean("text").alias("words"))
    kept = df.withColumn("words", kept_tokens("words", STOPWORDS))
    return kept.select(
        "doc_id",
        F.size("words").alias("n_tokens"),
        F.md5(F.concat_ws("|", "words")).alias("digest"),
    )


def tokens_of_clean(column: str):
    return F.split(cleaned(column), " ")


@register(
    "h18_split_tags",
    """SELECT p_partkey, CAST(len(string_split(p_name || '|' || p_brand || '|' || p_type, '|')) AS INTEGER) AS n,
    string_split(p_name || '|' || p_brand || '|' || p_type, '|')[2] AS second FROM part""",
)
def split_tags(t: Tables) -> DataFrame:
    df = t.part.select("p_partkey", F.concat_ws("|", "p_name", "p_brand", "p_type").alias("tags"))
    return df.withColumn("tags", tokens("tags", "|")).select(
        "p_partkey", F.size("tags").alias("n"), F.get("tags", 1).alias("second")
    )


@register(
    "h19_money",
    f"""WITH {LOANS_SQL} SELECT loan_id, CAST(trim(regexp_replace(gr_appv, '[$.,]', '', 'g')) AS DOUBLE) AS cents FROM loans""",
)
def money_text(t: Tables) -> DataFrame:
    return loans(t).select("loan_id", money("gr_appv").alias("cents"))


@register(
    "h20_array_ends",
    f"""WITH {EDGES_SQL} SELECT _id, "from", "to", CASE WHEN "from" = "to" THEN 1 ELSE 2 END AS n_nodes FROM edges""",
)
def array_ends(t: Tables) -> DataFrame:
    """Both ends of each edge as one array without repeats."""
    ends = F.array_distinct(F.concat(F.array("from"), F.array("to")))
    return edges(t).select("_id", "from", "to", F.size(ends).alias("n_nodes"))


@register(
    "h21_portable_hash",
    "SELECT event_id, CAST('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8) AS BIGINT) AS h FROM events",
)
def hashes(t: Tables) -> DataFrame:
    return t.events.select("event_id", portable_hash("user_id").alias("h"))


@register("i1_native_hash")
def native_hash(t: Tables) -> DataFrame:
    """64-bit hash without a Python worker."""
    return t.events.select("event_id", stable_hash("user_id").alias("h"))


@register(
    "i2_row_rules",
    f"""WITH {LOANS_SQL} SELECT loan_id, CASE WHEN rev_line IN ('Y', 'N') THEN rev_line ELSE 'Other' END AS rev_line,
    CAST(trim(regexp_replace(gr_appv, '[$.,]', '', 'g')) AS DOUBLE) AS cents,
    CASE WHEN chg_off_date IS NOT NULL THEN 1 ELSE 0 END AS is_default FROM loans""",
)
def row_rules(t: Tables) -> DataFrame:
    """Row functions of the loan table as native expressions."""
    return loans(t).select(
        "loan_id",
        allowed_levels("rev_line", ["Y", "N"]).alias("rev_line"),
        money("gr_appv").alias("cents"),
        flag(F.col("chg_off_date").isNotNull()).alias("is_default"),
    )


@register(
    "i3_array_elements",
    """SELECT conv_id, turn, CAST(len(list_filter(string_split(text, ' '), lambda x: length(x) > 2)) AS INTEGER) AS n,
    CAST(coalesce(list_sum(list_transform(string_split(text, ' '), lambda x: length(x))), 0) AS INTEGER) AS chars FROM conversations""",
)
def array_elements(t: Tables) -> DataFrame:
    words = t.conversations.select("conv_id", "turn", F.split("text", " ").alias("w"))
    return words.select(
        "conv_id",
        "turn",
        F.size(kept_tokens("w", [])).alias("n"),
        F.aggregate(
            F.transform("w", F.length), F.lit(0), lambda total, x: total + x
        ).alias("chars"),
    )


@register(
    "i4_chained",
    """SELECT o_orderkey, round(o_totalprice / 1000, 6) AS thousands, CAST(year(o_orderdate) AS INTEGER) AS o_orderdate_year
    FROM orders WHERE o_orderstatus = 'O'""",
)
def chained(t: Tables) -> DataFrame:
    """Table functions chained with ``transform``."""

    def only(df: DataFrame, status: str) -> DataFrame:
        return df.where(F.col("o_orderstatus") == status)

    def in_thousands(df: DataFrame, column: str) -> DataFrame:
        return df.withColumn("thousands", F.round(F.col(column) / 1000, 6))

    return (
        t.orders.transform(only, "O")
        .transform(in_thousands, "o_totalprice")
        .withColumns(date_parts({"o_orderdate": ["year"]}))
        .select("o_orderkey", "thousands", "o_orderdate_year")
    )
