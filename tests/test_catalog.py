"""Every query with a SQL form against DuckDB, on the smallest given tables."""

from pathlib import Path

import pytest
from compare import difference, open_tables

import __spark_entry__ as entry
from fieldmill.catalog import Tables, load_all

FOLDER = "/root/testdata/sf0.001"
ENTRIES = load_all()
# hundreds of boosting rounds; test_trees.py holds their parts against refits
SLOW = {"m3_patient_classifier", "m4_patient_regressor", "n1_adaptive_search", "n3_rate_sweep"}
EXACT = [n for n, e in ENTRIES.items() if e.sql is not None and n not in SLOW]
LOOSE = ["a8_corpus_scan", "i1_native_hash", "j7_string_index", "m5_text_clusters", "q3_fraud_job"]

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return open_tables(FOLDER)


@pytest.mark.parametrize("name", EXACT)
def test_exact(spark, con, name):
    e = ENTRIES[name]
    assert difference(e.build(Tables(spark, FOLDER)), con, e.sql) is None


@pytest.mark.parametrize("name", LOOSE)
def test_rows(spark, name):
    assert ENTRIES[name].build(Tables(spark, FOLDER)).count() > 0


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[0] == "uid"
