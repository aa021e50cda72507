import random

import pytest
from pyspark.sql import functions as F

from fieldmill.operators.split import (
    entity_split,
    hash_split,
    parts,
    period_split,
    pinned_entity_split,
    random_parts,
    split_sizes,
    time_split,
)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    data = []
    for i in range(600):
        entity = 0 if rng.random() < 0.3 else rng.randrange(1, 60)
        bad = entity % 4 == 1
        data.append((i, f"e{entity}", int(rng.random() < (0.8 if bad else 0.02)), i // 50))
    return spark.createDataFrame(data, "id int, ip string, is_bad int, month int")


def sides(df, column):
    return {
        r[column]: r["s"]
        for r in df.groupBy(column).agg(F.collect_set("split").alias("s")).collect()
    }


def test_random_parts(rows):
    train, val, test = random_parts(rows, 0.2, 0.2, seed=5)
    ids = [{r["id"] for r in p.collect()} for p in (train, val, test)]
    assert sum(map(len, ids)) == 600 and len(set.union(*ids)) == 600
    again = random_parts(rows, 0.2, 0.2, seed=5)
    assert {r["id"] for r in again[2].collect()} == ids[2]


@pytest.mark.parametrize("mode", ["bucket", "quantile"])
def test_hash_split(rows, mode):
    out = hash_split(rows, "ip", 0.3, mode)
    assert all(len(s) == 1 for s in sides(out, "ip").values())
    assert out.count() == 600 and "hash" not in out.columns
    with pytest.raises(ValueError):
        hash_split(rows, "ip", mode="odd")


def test_entity_split(rows):
    out = entity_split(rows, "ip", "is_bad", 0.3)
    assert out.columns == [*rows.columns, "split"]
    assert out.count() == 600
    assert all(len(s) == 1 for s in sides(out, "ip").values())
    rates = rows.groupBy("ip").agg((F.avg("is_bad") > 0.2).alias("bad"))
    spread = out.join(rates, "ip").groupBy("bad", "split").count().count()
    assert spread == 4  # both strata are on both sides


def test_entity_split_other_column(rows):
    """The label rate is taken per the named column."""
    renamed = rows.withColumnRenamed("ip", "account")
    assert entity_split(renamed, "account", "is_bad").count() == 600


def test_pinned_entities(rows):
    train, test = pinned_entity_split(rows, "ip", ["e1"], ["e2"], 0.7, seed=3)
    a = {r["ip"] for r in train.select("ip").distinct().collect()}
    b = {r["ip"] for r in test.select("ip").distinct().collect()}
    assert not a & b and "e1" in a and "e2" in b
    assert train.count() + test.count() == 600
    assert len(b) > 1  # unsampled entities are tested as well


@pytest.mark.parametrize("mode,boundary", [("discrete", True), ("linear", False)])
def test_time_split(rows, mode, boundary):
    out = time_split(rows, "month", 0.3, 0.25, mode, boundary)
    spans = {
        r["split"]: (r["lo"], r["hi"])
        for r in out.groupBy("split").agg(F.min("month").alias("lo"), F.max("month").alias("hi")).collect()
    }
    assert spans["train"][1] < spans["val"][0] <= spans["val"][1] < spans["test"][0]
    wide = time_split(rows, "month", 0.6, 0.25, mode, boundary)
    assert wide.where("split = 'test'").count() > out.where("split = 'test'").count()


def test_time_split_of_nothing(rows):
    assert time_split(rows.limit(0), "month").count() == 0


def test_period_split(rows):
    out = period_split(rows, "month", {"train": [0, 1], "test": [5]})
    sizes = {r["split"]: r["rows"] for r in split_sizes(out, "is_bad").collect()}
    assert sizes == {"train": 100, "test": 50}
    train, test = parts(out, "train", "test")
    assert train.columns == rows.columns and test.count() == 50
