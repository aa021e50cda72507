"""Queries with a SQL form against DuckDB, and the pipeline's promises."""

import pytest
from compare import difference, open_tables
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from fieldmill.llm.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_exact(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), open_tables(FOLDER), ORACLE_SQL[name]) is None


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    out = corpus_pipeline.run(spark, FOLDER)
    rows = out.toPandas()
    kept = docs.join(out.select("doc_id").distinct(), "doc_id").toPandas()
    assert 0 < len(kept) < docs.count() and kept["text"].nunique() == len(kept)
    full = rows.groupby("sequence_id")["length"].sum()
    assert full.max() <= 2048 and len(full) <= rows["length"].sum() / 2048 * 1.1 + 8
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    again = corpus_pipeline.decontam.contamination(docs.join(out.select("doc_id").distinct(), "doc_id"), bench)
    assert again.where("contaminated").count() == 0


def test_stages_keep_columns_and_survive_odd_rows(spark, odd, empty):
    shaped = odd.select("doc_id", "text", "lang", F.col("row").alias("source"), F.char_length("text").cast("long").alias("n_chars"))
    for name, apply in corpus_pipeline.STAGES[:-1]:
        assert apply(spark, shaped, FOLDER).columns == shaped.columns, name
        assert apply(spark, shaped.limit(0), FOLDER).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, shaped.limit(0), FOLDER).count() == 0
