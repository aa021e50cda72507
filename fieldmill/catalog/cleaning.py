"""Static columns, rare levels, null policy and encoders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..learn.encode import (
    WoeEncoder,
    balanced_weights,
    evidence_table,
    ordinal_indexer,
    standardised,
    with_ordinal_codes,
)
from ..learn.model import feature_stages
from ..operators.clean import (
    NullPolicy,
    infrequent_to_other,
    rare_to_other,
    without_static,
    without_zero_variance,
)
from ..operators.profile import bin_number, quantile_edges
from .base import Tables, register, rounded
from .standins import EVENT_SCORES_SQL, GAPS_SQL, LOG_SQL, event_scores, gaps, log


@register(
    "j1_drop_static",
    f"WITH {LOG_SQL} SELECT uid, proto, service, history FROM log",
)
def drop_static(t: Tables) -> DataFrame:
    df = log(t).select("uid", "proto", "service", "conn_state", "history")
    out, _ = without_static(df, ["proto", "service", "conn_state", "history"])
    return out


def _rare(col: str, limit: str) -> str:
    return f"CASE WHEN {col} IN (SELECT {col} FROM log WHERE {col} IS NOT NULL GROUP BY {col} HAVING {limit}) THEN {col} ELSE 'Other' END AS {col}"


@register(
    "j2_rare_levels",
    f"WITH {LOG_SQL} SELECT uid, {_rare('source_ip', 'count(*) > 100')}, {_rare('service', 'count(*) > 100')}, "
    f"{_rare('dest_ip', 'count(*) > 100')} FROM log",
)
def rare_levels(t: Tables) -> DataFrame:
    df = log(t).select("uid", "source_ip", "service", "dest_ip")
    return rare_to_other(df, ["source_ip", "service", "dest_ip"], min_count=100)


@register(
    "j3_infrequent_levels",
    f"""WITH {GAPS_SQL}, e AS (SELECT event_id, event_type, CAST(whole AS VARCHAR) AS whole FROM gaps),
    f AS (SELECT whole FROM e WHERE whole IS NOT NULL GROUP BY 1 HAVING count(*) / (SELECT count(whole) FROM e) >= 0.02)
    SELECT event_id, CASE WHEN event_type IS NULL THEN 'Other' ELSE event_type END AS event_type,
    CASE WHEN whole IN (SELECT whole FROM f) THEN whole ELSE 'Other' END AS whole FROM e""",
)
def infrequent_levels(t: Tables) -> DataFrame:
    df = gaps(t).select("event_id", "event_type", F.col("whole").cast("string").alias("whole"))
    return infrequent_to_other(df, ["event_type", "whole"], share=0.02)


@register(
    "j4_vocabulary",
    f"WITH {LOG_SQL} SELECT uid, {_rare('proto', 'count(*) > 999')}, {_rare('service', 'count(*) > 999')} FROM log",
)
def vocabulary(t: Tables) -> DataFrame:
    """Categorical inputs cut to levels seen at least 1000 times."""
    df = log(t).select("uid", "proto", "service")
    return rare_to_other(df, ["proto", "service"], min_count=999)


@register(
    "j5_null_policy",
    f"""WITH {GAPS_SQL} SELECT event_id, coalesce(value, (SELECT median(value) FROM gaps)) AS value,
    coalesce(event_type, (SELECT event_type FROM gaps WHERE event_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS event_type,
    CAST(coalesce(whole, (SELECT median(whole) FROM gaps)) AS DOUBLE) AS whole, fixed FROM gaps""",
)
def null_policy(t: Tables) -> DataFrame:
    df = gaps(t)
    out = NullPolicy(0.95).fit(df).transform(df)
    return out.withColumn("whole", F.col("whole").cast("double"))


@register(
    "j6_zero_variance",
    f"WITH {GAPS_SQL} SELECT event_id, value, event_type, user_id, whole FROM gaps",
)
def zero_variance(t: Tables) -> DataFrame:
    return without_zero_variance(gaps(t))


@register(
    "j7_string_index",
    f"""WITH {LOG_SQL}, p AS (SELECT proto, row_number() OVER (ORDER BY count(*) DESC, proto) - 1 AS i FROM log GROUP BY 1),
    s AS (SELECT service, row_number() OVER (ORDER BY count(*) DESC, service) - 1 AS i FROM log GROUP BY 1)
    SELECT uid, CAST(p.i AS DOUBLE) AS proto_ind, CAST(s.i AS DOUBLE) AS service_ind FROM log
    JOIN p ON log.proto = p.proto JOIN s ON log.service = s.service""",
)
def string_index(t: Tables) -> DataFrame:
    df = log(t).select("uid", "proto", "service", "orig_ip_bytes")
    index = feature_stages(["orig_ip_bytes"], ["proto", "service"])[0]
    return index.fit(df).transform(df).select("uid", "proto_ind", "service_ind")


@register(
    "j8_ordinal_codes",
    """SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS BIGINT) AS brand_code FROM part""",
)
def ordinal_codes(t: Tables) -> DataFrame:
    df = t.part.select("p_partkey", "p_brand")
    return with_ordinal_codes(df, "p_brand", "brand_code").select("p_partkey", "brand_code")


@register(
    "j8_ordinal_indexer",
    """SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS DOUBLE) AS p_brand_code,
    CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS DOUBLE) AS p_type_code FROM part""",
)
def ordinal_stage(t: Tables) -> DataFrame:
    df = t.part.select("p_partkey", "p_brand", "p_type")
    stage = ordinal_indexer(["p_brand", "p_type"])
    return stage.fit(df).transform(df).select("p_partkey", "p_brand_code", "p_type_code")


@register(
    "j9_quantile_bins",
    """WITH e AS (SELECT list_distinct(quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS edges FROM events)
    SELECT event_id, CAST(len(list_filter(edges, lambda x: value > x)) AS INTEGER) AS bin FROM events, e""",
)
def quantile_bins(t: Tables) -> DataFrame:
    edges = quantile_edges(t.events, "value", 10)
    return t.events.select("event_id", bin_number("value", edges).alias("bin"))


_WOE_CTE = f"""{EVENT_SCORES_SQL}, src AS (
  SELECT event_id, split, label, 'u' || CAST(user_id % 31 AS VARCHAR) AS team, CAST(user_id AS VARCHAR) AS account,
         CASE WHEN event_id % 6 <> 0 THEN 'c' || CAST(event_id % 4 AS VARCHAR) END AS colour FROM event_scores),
tr AS (SELECT * FROM src WHERE split = 'train'),
tot AS (SELECT sum(label) AS p, count(*) AS n FROM tr)"""


def _woe_of(col: str) -> str:
    return (
        f"w_{col} AS (SELECT {col} AS value, CASE WHEN count(*) = 1 THEN 0 ELSE ln(((sum(label) + 1.0::DOUBLE) / ((SELECT p FROM tot) + 2)) / "
        f"((count(*) - sum(label) + 1.0::DOUBLE) / ((SELECT n - p FROM tot) + 2))) END AS woe FROM tr GROUP BY 1)"
    )


def _woe_source(t: Tables) -> DataFrame:
    return event_scores(t).select(
        "event_id",
        "split",
        "label",
        F.concat(F.lit("u"), (F.col("user_id") % 31).cast("string")).alias("team"),
        F.col("user_id").cast("string").alias("account"),
        F.when(
            F.col("event_id") % 6 != 0,
            F.concat(F.lit("c"), (F.col("event_id") % 4).cast("string")),
        ).alias("colour"),
    )


@register(
    "j10_evidence_table",
    f"WITH {_WOE_CTE}, {_woe_of('team')}, {_woe_of('colour')} SELECT 'team' AS variable, value, round(woe, 6) AS woe FROM w_team "
    "UNION ALL SELECT 'colour', value, round(woe, 6) FROM w_colour",
)
def evidence(t: Tables) -> DataFrame:
    train = _woe_source(t).where("split = 'train'")
    return rounded(evidence_table(train, ["team", "colour"], "label"), "woe")


@register(
    "j10_evidence_encoding",
    f"WITH {_WOE_CTE}, {_woe_of('team')}, {_woe_of('colour')}, {_woe_of('account')} SELECT s.event_id, round(coalesce(a.woe, 0), 6) AS team, "
    "round(coalesce(c.woe, 0), 6) AS account, round(coalesce(b.woe, 0), 6) AS colour FROM src s LEFT JOIN w_team a ON s.team = a.value "
    "LEFT JOIN w_colour b ON s.colour IS NOT DISTINCT FROM b.value LEFT JOIN w_account c ON s.account = c.value",
)
def evidence_encoding(t: Tables) -> DataFrame:
    df = _woe_source(t)
    columns = ["team", "account", "colour"]
    model = WoeEncoder(columns, "label").fit(df.where("split = 'train'"))
    return rounded(model.transform(df).select("event_id", *columns), *columns)


@register(
    "j11_standardised",
    """SELECT l_orderkey, l_linenumber, l_partkey, round((l_quantity - (SELECT avg(l_quantity) FROM lineitem)) / (SELECT stddev_pop(l_quantity) FROM lineitem), 6) AS l_quantity,
    round((l_extendedprice - (SELECT avg(l_extendedprice) FROM lineitem)) / (SELECT stddev_pop(l_extendedprice) FROM lineitem), 6) AS l_extendedprice FROM lineitem""",
)
def standard_scores(t: Tables) -> DataFrame:
    cols = ["l_quantity", "l_extendedprice"]
    out = standardised(t.lineitem, cols)
    return rounded(out.select("l_orderkey", "l_linenumber", "l_partkey", *cols), *cols)


@register(
    "j12_assembled_rows",
    f"WITH {GAPS_SQL} SELECT event_id, value + whole AS total FROM gaps WHERE value IS NOT NULL AND whole IS NOT NULL",
)
def assembled(t: Tables) -> DataFrame:
    """Rows that survive assembly; rows with nulls are skipped."""
    from pyspark.ml.functions import vector_to_array

    df = gaps(t).select("event_id", "value", "whole")
    vectors = feature_stages(["value", "whole"])[0].transform(df)
    return vectors.select(
        "event_id", F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x).alias("total")
    )


@register(
    "j13_class_weights",
    f"""WITH {EVENT_SCORES_SQL} SELECT event_id, round(CASE label WHEN 1 THEN (SELECT count(*) / (2.0 * sum(label)) FROM event_scores)
    ELSE (SELECT count(*) / (2.0 * (count(*) - sum(label))) FROM event_scores) END, 6) AS weight FROM event_scores""",
)
def class_weights(t: Tables) -> DataFrame:
    out = balanced_weights(event_scores(t), "label")
    return rounded(out.select("event_id", "weight"), "weight")
