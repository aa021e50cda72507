"""Dataset splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.split import (
    entity_sides,
    entity_split,
    hash_split,
    period_split,
    pinned_entity_split,
    seeded_split,
    split_sizes,
    time_split,
)
from .base import Tables, as_long, register
from .standins import EVENT_SCORES_SQL, LOANS_SQL, event_scores, loans

_HASH = "CAST('0x' || substr(md5(CAST({c} AS VARCHAR)), 1, 8) AS BIGINT)"


def _named(parts: tuple, names: tuple[str, ...], *cols: str) -> DataFrame:
    out = None
    for df, name in zip(parts, names):
        one = df.select(*cols, F.lit(name).alias("split"))
        out = one if out is None else out.unionAll(one)
    return out


@register(
    "l1_random_split",
    """WITH d AS (SELECT event_id, CAST('0x' || substr(md5('200:' || CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 10000 AS a,
      CAST('0x' || substr(md5('201:' || CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 10000 AS b FROM events)
    SELECT event_id, CASE WHEN a < 2000 THEN 'test' WHEN b < 2000 THEN 'val' ELSE 'train' END AS split FROM d""",
)
def random_split(t: Tables) -> DataFrame:
    return seeded_split(t.events, "event_id", 0.2, 0.2).select("event_id", "split")


@register(
    "l2_hash_split",
    f"SELECT event_id, CASE WHEN {_HASH.format(c='user_id')} % 10000 < 2000 THEN 'test' ELSE 'train' END AS split FROM events",
)
def by_hash(t: Tables) -> DataFrame:
    return hash_split(t.events, "user_id", 0.2).select("event_id", "split")


@register(
    "l2_hash_split_quantile",
    f"""WITH h AS (SELECT event_id, {_HASH.format(c='user_id')} AS h FROM events)
    SELECT event_id, CASE WHEN h < (SELECT quantile_disc(h, 0.2) FROM h) THEN 'test' ELSE 'train' END AS split FROM h""",
)
def by_hash_quantile(t: Tables) -> DataFrame:
    return hash_split(t.events, "user_id", 0.2, mode="quantile").select("event_id", "split")


_ENTITY_SQL = f"""WITH {EVENT_SCORES_SQL}, r AS (
  SELECT user_id, count(*) AS n, avg(label) > 0.2 AS is_bad_entity, {_HASH.format(c='user_id')} AS h FROM event_scores GROUP BY user_id),
c AS (SELECT *, sum(n) OVER (PARTITION BY is_bad_entity ORDER BY h) AS upto, sum(n) OVER (PARTITION BY is_bad_entity) AS total FROM r),
lim AS (SELECT is_bad_entity, min(h) AS lim FROM c WHERE upto >= 0.2::DOUBLE * total GROUP BY 1),
sides AS (SELECT user_id, r.is_bad_entity, CASE WHEN h < lim THEN 'test' ELSE 'train' END AS split
  FROM r JOIN lim ON r.is_bad_entity = lim.is_bad_entity)
"""


@register("l3_entity_sides", _ENTITY_SQL + "SELECT user_id, is_bad_entity, split FROM sides")
def sides(t: Tables) -> DataFrame:
    return entity_sides(event_scores(t), "user_id", "label")


@register(
    "l3_entity_split",
    _ENTITY_SQL + "SELECT event_id, split FROM event_scores e JOIN sides s ON e.user_id = s.user_id".replace("SELECT event_id, split", "SELECT event_id, s.split AS split"),
)
def by_entity(t: Tables) -> DataFrame:
    df = event_scores(t).drop("split")
    return entity_split(df, "user_id", "label").select("event_id", "split")


@register(
    "l4_pinned_split",
    """WITH d AS (SELECT event_id, user_id, CAST('0x' || substr(md5('200:' || CAST(user_id AS VARCHAR)), 1, 8) AS BIGINT) % 10000 AS draw FROM events)
    SELECT event_id, user_id, CASE WHEN user_id IN (1, 2) THEN 'train' WHEN user_id IN (3, 4) THEN 'test'
    WHEN draw < 8000 THEN 'train' ELSE 'test' END AS split FROM d""",
)
def pinned(t: Tables) -> DataFrame:
    parts = pinned_entity_split(t.events, "user_id", [1, 2], [3, 4])
    return _named(parts, ("train", "test"), "event_id", "user_id")


@register(
    "l5_time_split_discrete",
    """WITH m AS (SELECT o_orderkey, CAST(year(o_orderdate) * 12 + month(o_orderdate) AS INTEGER) AS month FROM orders),
    a AS (SELECT quantile_disc(month, 0.8) AS q FROM m), b AS (SELECT quantile_disc(month, 0.8) AS q FROM m, a WHERE month < a.q)
    SELECT o_orderkey, CASE WHEN month >= (SELECT q FROM a) THEN 'test' WHEN month >= (SELECT q FROM b) THEN 'val' ELSE 'train' END AS split FROM m""",
)
def by_time(t: Tables) -> DataFrame:
    df = t.orders.select(
        "o_orderkey", (F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("month")
    )
    return time_split(df, "month").select("o_orderkey", "split")


@register(
    "l6_time_split_linear",
    f"""WITH {LOANS_SQL}, a AS (SELECT quantile_cont(approval_year, 0.9) AS q FROM loans),
    b AS (SELECT quantile_cont(approval_year, 0.9) AS q FROM loans, a WHERE approval_year <= a.q)
    SELECT loan_id, CASE WHEN approval_year > (SELECT q FROM a) THEN 'test' WHEN approval_year > (SELECT q FROM b) THEN 'val' ELSE 'train' END AS split FROM loans""",
)
def by_time_linear(t: Tables) -> DataFrame:
    df = loans(t).select("loan_id", "approval_year")
    out = time_split(df, "approval_year", 0.1, 0.1, mode="linear", boundary_in_test=False)
    return out.select("loan_id", "split")


@register(
    "l7_period_split",
    """WITH o AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label FROM orders)
    SELECT CASE WHEN y IN (1995, 1996, 1997, 1998) THEN 'train' WHEN y = 1999 THEN 'val' ELSE 'test' END AS split,
    count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives FROM o WHERE y BETWEEN 1995 AND 2000 GROUP BY 1""",
)
def by_period(t: Tables) -> DataFrame:
    df = t.orders.select(
        F.year("o_orderdate").alias("year"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
    )
    periods = {"train": [1995, 1996, 1997, 1998], "val": [1999], "test": [2000]}
    return as_long(split_sizes(period_split(df, "year", periods), "label"), "positives")
