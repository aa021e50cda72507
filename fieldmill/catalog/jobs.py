"""Whole jobs on the given tables.

Feature tables of the jobs are compared with SQL; fitted results are not.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.config import save_settings
from ..sources.writers import write_columnar
from ..plans import behaviour, fraud, lending, mails, network, trending
from .base import Tables, day, register, rounded
from .scalars import STOPWORDS, _CLEAN_SQL, _HEADER_SQL, _STOP_SQL
from .aggregates import _DEGREE_NAMES, _DEGREES_SQL
from .models import ROUNDS
from .standins import EDGES_SQL, LIFE_SQL, LOANS_SQL, LOG_SQL, TREND_SQL, edges, loans, log, trend
from .standins import mails as mail_rows
from .windows import _trailing_sql, PERIODS
from ..operators.rolling import Rolling
from ..operators.trailing import CHANNEL_NAMES, GENERAL_NAMES

# --- network log --------------------------------------------------------------

TRIALS = 8
_NETWORK = network.NetworkSettings(
    numerical_features=["duration", "orig_bytes", "orig_pkts", "orig_ip_bytes"],
    categorical_features=["proto", "service", "conn_state", "history"],
    na_fill_vals={
        "duration": -999999, "orig_bytes": -999999, "orig_pkts": -999999,
        "orig_ip_bytes": -999999, "proto": "missing", "service": "missing",
        "conn_state": "missing", "history": "missing",
    },
    row_id="uid",
    windows=[
        Rolling("source_ip_count_last_30_mins", "source_ip", 30),
        Rolling("source_port_count_last_30_mins", "source_port", 30),
        Rolling("source_ip_avg_bytes_last_day", "orig_ip_bytes", 1440, "avg", "source_ip"),
    ],
)


@register(
    "q1_network_features",
    f"""WITH {LOG_SQL}, c AS (SELECT *, CAST(floor(ts) AS BIGINT) AS sec, coalesce(nullif(service, '-'), 'missing') AS svc FROM log)
    SELECT uid, CASE WHEN label <> 'Benign' THEN 1 ELSE 0 END AS is_bad, coalesce(TRY_CAST(duration AS DOUBLE), -999999) AS duration,
    coalesce(TRY_CAST(orig_bytes AS DOUBLE), -999999) AS orig_bytes,
    CASE WHEN svc IN (SELECT svc FROM c GROUP BY 1 HAVING count(*) > 100) THEN svc ELSE 'Other' END AS service,
    CASE WHEN history IN (SELECT history FROM c GROUP BY 1 HAVING count(*) > 100) THEN history ELSE 'Other' END AS history,
    count(source_ip) OVER (PARTITION BY source_ip ORDER BY sec RANGE BETWEEN 1800 PRECEDING AND 1 PRECEDING) AS source_ip_count_last_30_mins,
    count(source_port) OVER (PARTITION BY source_port ORDER BY sec RANGE BETWEEN 1800 PRECEDING AND 1 PRECEDING) AS source_port_count_last_30_mins,
    round(coalesce(avg(orig_ip_bytes) OVER (PARTITION BY source_ip ORDER BY sec RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING), -999999), 6) AS source_ip_avg_bytes_last_day
    FROM c""",
)
def network_features(t: Tables) -> DataFrame:
    df, numeric, categorical = network.feature_table(log(t), _NETWORK)
    wanted = ["duration", "orig_bytes", "service", "history", *(w.name for w in _NETWORK.rolling())]
    assert "conn_state" not in [*numeric, *categorical]
    return rounded(df.select("uid", "is_bad", *wanted), "source_ip_avg_bytes_last_day")


@register("q1_network_job")
def network_job(t: Tables) -> DataFrame:
    """The whole job with its search of TRIALS settings."""
    return network.run(log(t), dataclasses.replace(_NETWORK, tuning_rounds=TRIALS))[1]


# --- trending videos ----------------------------------------------------------

_TRENDING = trending.TrendingSettings(
    ratio_features={"likes_to_dislikes": ["likes", "dislikes"], "likes_to_views": ["likes", "views"]},
    difference_features={"days_to_trending": ["trending_date", "publish_time"]},
    date_features={"trending_date": ["weekday"]},
    base_columns=[
        "channel_title", "category_id", "views", "likes", "dislikes", "comment_count",
        "likes_to_dislikes", "trending_date_weekday",
    ],
)


def _job_sql() -> str:
    """Lifecycle rows joined with both trailing tables."""
    head = f"WITH {LIFE_SQL}, "
    pieces, joins, cols = [], [], []
    for alias, key, names in (("c", "channel_title", CHANNEL_NAMES), ("g", None, GENERAL_NAMES)):
        table = _trailing_sql("life", "first_day_in_trending", key, "video_id", "days_in_trending", names, "INTEGER")
        days, body = table.split(") SELECT ", 1)
        days = days.replace("days AS", f"days_{alias} AS", 1)
        body = body.replace("FROM days a", f"FROM days_{alias} a")
        pieces.append(f"{days}), t_{alias} AS (SELECT {body})")
        on = f"l.channel_title = t_{alias}.channel_title AND " if key else ""
        joins.append(
            f"JOIN t_{alias} ON {on}strftime(l.first_day_in_trending, '%Y-%m-%d') = t_{alias}.first_day_in_trending"
        )
        cols += [f"t_{alias}.{names[k].format(n=p)}" for p in PERIODS for k in ("distinct", "max", "mean")]
    return (
        head
        + ", ".join(pieces)
        + " SELECT l.video_id, l.days_to_trending, strftime(l.first_day_in_trending, '%Y-%m-%d') AS first_day_in_trending, l.days_in_trending, "
        "n.n_name AS category_id, CAST(isodow(l.first_day_in_trending) AS INTEGER) AS trending_date_weekday, "
        + "l.views, round(l.likes / nullif(l.dislikes, 0), 6) AS likes_to_dislikes, "
        + ", ".join(cols)
        + " FROM life l LEFT JOIN nation n ON l.category_id = n.n_nationkey "
        + " ".join(joins)
    )


def _trending_inputs(t: Tables) -> tuple[DataFrame, DataFrame, trending.TrendingSettings]:
    categories = t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("title"))
    # the first row of a video is chosen by the original number, so keep it apart
    s = trending.TrendingSettings(
        **{**_TRENDING.__dict__, "base_columns": ["channel_title", "category_code", *_TRENDING.base_columns[2:], "category_id"]}
    )
    return trend(t).withColumn("category_code", F.col("category_id")), categories, s


def _trending_result(out: DataFrame) -> DataFrame:
    names = [
        table[k].format(n=p)
        for table in (CHANNEL_NAMES, GENERAL_NAMES)
        for p in PERIODS
        for k in ("distinct", "max", "mean")
    ]
    out = out.select(
        "video_id", "days_to_trending", day("first_day_in_trending"), "days_in_trending",
        "category_id", "trending_date_weekday", "views", "likes_to_dislikes", *names,
    )
    out = rounded(out, "likes_to_dislikes")
    means = [table["mean"].format(n=p) for table in (CHANNEL_NAMES, GENERAL_NAMES) for p in PERIODS]
    return rounded(out, *means, digits=4)


@register("q2_trending_job", _job_sql())
def trending_job(t: Tables) -> DataFrame:
    """All steps of the trending table, from daily rows to the model table."""
    return _trending_result(trending.run(*_trending_inputs(t)))


@register("a11_job_from_settings", _job_sql())
def job_from_settings(t: Tables) -> DataFrame:
    """The trending job from a settings file, written to and read from the shared folder."""
    rows, categories, s = _trending_inputs(t)
    tables = trending.TrendingTables(scratch_path(t.spark, "rows"), scratch_path(t.spark, "categories"))
    write_columnar(rows, tables.rows)
    write_columnar(categories, tables.categories)
    path = scratch_path(t.spark, "settings") + ".json"
    save_settings(trending.TrendingJob(tables, s), path)
    return _trending_result(trending.run_file(t.spark, path))


# --- fraud table --------------------------------------------------------------

_FRAUD = fraud.FraudSettings(
    numerical_features=["value", "whole"],
    categorical_features=["kind"],
    label="label",
    time_column="month",
    booster={"maxIter": ROUNDS, "maxDepth": 3},
    tuning_rounds=TRIALS,
)


def _fraud_rows(t: Tables) -> DataFrame:
    e = F.col("event_id")
    return t.events.select(
        "event_id",
        F.hour("ts").alias("month"),
        F.when(e % 7 != 0, F.col("value")).alias("value"),
        F.when(e % 5 != 0, F.floor("value")).cast("double").alias("whole"),
        F.when(e % 3 != 0, F.concat(F.lit("u"), (F.col("user_id") % 6).cast("string"))).alias("kind"),
        F.when(e % 99 == 0, F.lit(1)).alias("nearly_empty"),
        F.lit(5).alias("fixed"),
        (F.col("event_type") == "error").cast("int").alias("label"),
    )


@register(
    "q3_fraud_table",
    """WITH f AS (SELECT event_id, CAST(hour(ts) AS INTEGER) AS month, CASE WHEN event_id % 7 <> 0 THEN value END AS value,
      CASE WHEN event_id % 5 <> 0 THEN floor(value) END AS whole, CASE WHEN event_id % 3 <> 0 THEN 'u' || CAST(user_id % 6 AS VARCHAR) END AS kind,
      CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label FROM events),
    a AS (SELECT quantile_disc(month, 0.8) AS q FROM f), b AS (SELECT quantile_disc(month, 0.8) AS q FROM f, a WHERE month < a.q)
    SELECT event_id, month, label, coalesce(value, (SELECT median(value) FROM f)) AS value, coalesce(whole, (SELECT median(whole) FROM f)) AS whole,
    coalesce(kind, (SELECT kind FROM f WHERE kind IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS kind,
    CASE WHEN month >= (SELECT q FROM a) THEN 'test' WHEN month >= (SELECT q FROM b) THEN 'val' ELSE 'train' END AS split FROM f""",
)
def fraud_table(t: Tables) -> DataFrame:
    return fraud.prepared(_fraud_rows(t), _FRAUD)


@register("q3_fraud_job")
def fraud_job(t: Tables) -> DataFrame:
    return fraud.run(_fraud_rows(t), _FRAUD)[1]


# --- mails --------------------------------------------------------------------


@register(
    "q4_mail_table",
    _HEADER_SQL
    + f""", b AS (SELECT conv_id, turn, CASE WHEN named THEN e1 WHEN bare THEN e2 END AS sender_email, string_split(marked, 'Status: O')[2] AS body FROM h),
    w AS (SELECT *, list_filter(string_split({_CLEAN_SQL.format(c='body')}, ' '), lambda x: length(x) > 2 AND NOT list_contains([{_STOP_SQL}], x)) AS words FROM b)
    SELECT conv_id, turn, sender_email, CAST(length(body) AS INTEGER) AS email_text_length,
    round(length(regexp_replace(body, '[^A-Z]', '', 'g')) / nullif(length(body), 0), 9) AS email_text_percent_capital,
    CASE WHEN body IS NOT NULL THEN CAST(len(words) AS INTEGER) END AS n_tokens, CASE WHEN body IS NOT NULL THEN md5(array_to_string(words, '|')) END AS digest FROM w""",
)
def mail_table(t: Tables) -> DataFrame:
    out = mails.prepared(mail_rows(t), STOPWORDS)
    return out.select(
        "conv_id", "turn", "sender_email", "email_text_length",
        F.round("email_text_percent_capital", 9).alias("email_text_percent_capital"),
        F.size("clean_text_tokenised").alias("n_tokens"),
        F.when(
            F.col("clean_text_tokenised").isNotNull(), F.md5(F.concat_ws("|", "clean_text_tokenised"))
        ).alias("digest"),
    )


@register("q4_mail_clusters")
def mail_clusters(t: Tables) -> DataFrame:
    return mails.clusters(mails.prepared(mail_rows(t), STOPWORDS), k=3)


# --- API behaviour ------------------------------------------------------------


def _calls(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("_id"),
        F.when(F.col("o_orderkey") % 50 != 0, F.col("o_totalprice")).alias("duration(sec)"),
        F.when(F.col("o_orderstatus") == "F", "outlier").otherwise("normal").alias("classification"),
    )


@register(
    "q5_behaviour_table",
    f"WITH {EDGES_SQL}, {_DEGREES_SQL}, stats AS (SELECT _id, "
    + ", ".join(f"round(avg({f}), 6) AS avg_{f}, max({f}) AS max_{f}" for f in _DEGREE_NAMES)
    + """ FROM deg GROUP BY 1) SELECT o_orderkey AS _id, o_orderstatus = 'F' AS is_anomaly, n_connections, n_unique_nodes, stats.* EXCLUDE (_id)
    FROM orders JOIN sizes ON o_orderkey = sizes._id JOIN stats ON o_orderkey = stats._id WHERE o_orderkey % 50 <> 0""",
)
def behaviour_table(t: Tables) -> DataFrame:
    calls = behaviour.cleaned_calls(_calls(t), "duration(sec)")
    out = behaviour.feature_table(calls, edges(t))
    names = [f"{k}_{f}" for f in _DEGREE_NAMES for k in ("avg", "max")]
    out = out.select("_id", "is_anomaly", "n_connections", "n_unique_nodes", *names)
    return rounded(out, *(n for n in names if n.startswith("avg")))


@register("q5_behaviour_job")
def behaviour_job(t: Tables) -> DataFrame:
    calls = behaviour.cleaned_calls(_calls(t), "duration(sec)")
    table = behaviour.feature_table(calls, edges(t))
    report = behaviour.run(
        table, ["n_connections", "n_unique_nodes", "avg_global_source_degrees", "max_global_dest_degrees"],
        0.29, maxIter=ROUNDS, maxDepth=3,
    )
    return report.thresholds


# --- loans --------------------------------------------------------------------

_LENDING = lending.LendingSettings(
    rare_columns=["state", "bank"],
    flag_columns=["rev_line"],
    money_columns=["gr_appv"],
    charge_off="chg_off_date",
    zip_column="zip",
    state="state",
    bank_state="city",
    is_new_column="zip",
    naics="c_custkey",
    year="approval_year",
    bad_years=["1996"],
    min_share=0.04,
    output=[
        "loan_id", "approval_year", "state", "bank", "rev_line", "gr_appv", "is_default", "is_new",
        "same_state", "naics_first_two", "longitude", "latitude",
    ],
)


@register(
    "q6_loan_job",
    f"""WITH {LOANS_SQL}, k AS (SELECT * FROM loans WHERE approval_year <> 1996),
    a AS (SELECT quantile_cont(approval_year, 0.9) AS q FROM k), b AS (SELECT quantile_cont(approval_year, 0.9) AS q FROM k, a WHERE approval_year <= a.q)
    SELECT loan_id, approval_year, CASE WHEN state IN (SELECT state FROM loans GROUP BY 1 HAVING count(*) / (SELECT count(*) FROM loans) >= 0.04) THEN state ELSE 'Other' END AS state,
    CASE WHEN bank IN (SELECT bank FROM loans GROUP BY 1 HAVING count(*) / (SELECT count(*) FROM loans) >= 0.04) THEN bank ELSE 'Other' END AS bank,
    CASE WHEN rev_line IN ('Y', 'N') THEN rev_line ELSE 'Other' END AS rev_line, CAST(trim(regexp_replace(gr_appv, '[$.,]', '', 'g')) AS DOUBLE) AS gr_appv,
    chg_off_date IS NOT NULL AS is_default, zip = 2 AS is_new, state = city AS same_state, left(CAST(c_custkey AS VARCHAR), 2) AS naics_first_two,
    n_nationkey * 1.5::DOUBLE AS longitude, n_regionkey * 2.5::DOUBLE AS latitude,
    CASE WHEN approval_year > (SELECT q FROM a) THEN 'test' WHEN approval_year > (SELECT q FROM b) THEN 'val' ELSE 'train' END AS split
    FROM k LEFT JOIN nation ON zip = n_nationkey""",
)
def loan_job(t: Tables) -> DataFrame:
    places = t.nation.select(
        F.col("n_nationkey").alias("code"),
        (F.col("n_nationkey") * F.lit(1.5)).alias("longitude"),
        (F.col("n_regionkey") * F.lit(2.5)).alias("latitude"),
    )
    return lending.run(loans(t), places, _LENDING)
