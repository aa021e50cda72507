"""Scans, sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.readers import (
    read_categories,
    read_columnar,
    read_corpus,
    read_piped,
    read_quoted,
)
from ..sources.writers import write_columnar, write_corpus, write_delimited
from .base import Tables, moment, register, rounded
from .standins import LOG_SQL, MAILS_SQL, log, mails


@register(
    "a1_piped_scan",
    f"WITH {LOG_SQL} SELECT uid, source_ip, source_port, service, duration, "
    "CAST(floor(ts) AS BIGINT) AS seconds, label FROM log",
)
def piped_scan(t: Tables) -> DataFrame:
    df = log(t).select(
        "uid", "source_ip", "source_port", "service", "duration",
        F.floor("ts").alias("seconds"), "label",
    )
    halves = [scratch_path(t.spark, "piped") for _ in range(2)]
    write_delimited(df.where("uid % 2 = 0"), halves[0], "|")
    write_delimited(df.where("uid % 2 = 1"), halves[1], "|")
    return read_piped(t.spark, halves, df.schema)


@register("a3_quoted_scan", "SELECT doc_id, text, lang FROM documents")
def quoted_scan(t: Tables) -> DataFrame:
    df = t.documents.select("doc_id", "text", "lang")
    path = scratch_path(t.spark, "quoted")
    write_delimited(df, path)
    return read_quoted(t.spark, path, df.schema)


@register(
    "a4_lazy_scan",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_totalprice > 250000",
)
def lazy_scan(t: Tables) -> DataFrame:
    df = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    path = scratch_path(t.spark, "lazy")
    write_delimited(df, path)
    rows = read_quoted(t.spark, path, df.schema, multi_line=False)
    return rows.where("o_totalprice > 250000").select("o_orderkey", "o_orderpriority")


@register(
    "a5_first_row",
    "SELECT o_orderkey, o_orderpriority FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1",
)
def first_row(t: Tables) -> DataFrame:
    return t.orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(1).select(
        "o_orderkey", "o_orderpriority"
    )


@register("a6_columnar_scan", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity >= 45")
def columnar_scan(t: Tables) -> DataFrame:
    return read_columnar(
        t.spark, f"{t.folder}/lineitem.parquet", ["l_orderkey", "l_quantity"]
    ).where("l_quantity >= 45")


@register(
    "a7_category_lookup",
    "SELECT CAST(p_partkey AS INTEGER) AS id, p_name || ' \"' || p_brand || '\"' AS title FROM part",
)
def category_lookup(t: Tables) -> DataFrame:
    """Parts as one nested JSON list per brand, read back as a lookup table."""
    item = F.struct(
        F.col("p_partkey").cast("string").alias("id"),
        F.struct(
            F.concat_ws("", "p_name", F.lit(' "'), "p_brand", F.lit('"')).alias("title")
        ).alias("snippet"),
    )
    lists = t.part.groupBy((F.col("p_partkey") / 500).cast("long").alias("page")).agg(
        F.collect_list(item).alias("items")
    )
    path = scratch_path(t.spark, "categories")
    lists.select("items").write.mode("overwrite").option("maxRecordsPerFile", 1).json(path)
    return read_categories(t.spark, path)


@register("a8_corpus_scan", f"WITH {MAILS_SQL} SELECT emails FROM mails")
def corpus_scan(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "corpus")
    write_corpus(mails(t), "emails", path)
    return read_corpus(t.spark, path)


@register(
    "a9_columnar_sink",
    "SELECT event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, value FROM events",
)
def columnar_sink(t: Tables) -> DataFrame:
    df = t.events.select("event_type", "ts", "value")
    back = write_columnar(df, scratch_path(t.spark, "events"))
    return back.select("event_type", moment("ts"), "value")


@register(
    "a12_shape",
    "SELECT 'events' AS name, count(*) AS n, 6 AS width FROM events UNION ALL "
    "SELECT 'lineitem', count(*), 11 FROM lineitem UNION ALL SELECT 'orders', count(*), 6 FROM orders",
)
def shape(t: Tables) -> DataFrame:
    """Rows and columns of tables."""
    out = None
    for name in ("events", "lineitem", "orders"):
        df = getattr(t, name)
        one = df.agg(F.count("*").alias("n")).select(
            F.lit(name).alias("name"), "n", F.lit(len(df.columns)).alias("width")
        )
        out = one if out is None else out.unionAll(one)
    return out


@register(
    "a12_tail",
    "SELECT event_id, round(value, 6) AS value FROM events ORDER BY ts DESC, event_id DESC LIMIT 5",
)
def tail(t: Tables) -> DataFrame:
    """Last rows by time, from a descending top-k instead of a full sort."""
    last = t.events.orderBy(F.desc("ts"), F.desc("event_id")).limit(5)
    return rounded(last.select("event_id", "value"), "value")
