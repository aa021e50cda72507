import pytest
from pyspark.sql import functions as F

from fieldmill.functions.numbers import casts
from fieldmill.operators.clean import (
    LevelFilter,
    NullPolicy,
    filled,
    infrequent_to_other,
    rare_to_other,
    sentinel_to_null,
    without_static,
    without_zero_variance,
)
from fieldmill.operators.profile import (
    bin_number,
    describe,
    lifecycle,
    missing_counts,
    most_frequent,
    quantile_edges,
    static_columns,
)


def levels(spark):
    rows = [("x",)] * 101 + [("y",)] * 100 + [(None,)] * 150
    return spark.createDataFrame(rows, "c string").withColumn("d", F.coalesce("c", F.lit("z")))


def test_rare_levels(spark):
    """100 is rare, 101 is not; every listed column is recoded; null is Other."""
    fitted = LevelFilter(["c", "d"], min_count=100).fit(levels(spark))
    out = fitted.transform(levels(spark))
    counts = {(r["c"], r["d"]): r["count"] for r in out.groupBy("c", "d").count().collect()}
    assert counts == {("x", "x"): 101, ("Other", "Other"): 100, ("Other", "z"): 150}


def test_rare_levels_without_any(spark):
    df = spark.createDataFrame([("a",), ("b",)], "c string")
    assert {r["c"] for r in rare_to_other(df, ["c"], 5).collect()} == {"Other"}


def test_shares_count_known_rows_only(spark):
    df = spark.createDataFrame([("a",)] * 9 + [("b",)] + [(None,)] * 90, "c string")
    out = infrequent_to_other(df, ["c"], 0.1)
    assert {r["c"]: r["count"] for r in out.groupBy("c").count().collect()} == {
        "a": 9, "b": 1, "Other": 90,
    }
    with pytest.raises(ValueError):
        LevelFilter(["c"], min_count=1, min_share=0.1)


def test_sentinel_before_cast(spark):
    df = spark.createDataFrame([("-", "1.5"), ("7", "-")], "a string, b string")
    out = sentinel_to_null(df).withColumns(casts(["a", "b"]))
    assert [tuple(r) for r in out.collect()] == [(None, 1.5), (7.0, None)]


def test_fill_needs_a_value_for_every_feature(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    with pytest.raises(ValueError, match="b"):
        filled(df, {"a": 0}, required=["a", "b"])
    assert filled(df, {"a": -999999}, ["a"]).first()["a"] == -999999


def test_static_and_zero_variance(spark):
    df = spark.createDataFrame([(1, "s", 2.0), (2, "s", 2.0), (None, None, 2.0)],
                               "a int, b string, c double")
    assert static_columns(df, ["a", "b", "c"]) == ["b", "c"]
    out, kept = without_static(df, ["a", "b", "c"])
    assert (out.columns, kept) == (["a"], ["a"])
    assert without_zero_variance(df).columns == ["a", "b"]


def test_null_policy(spark):
    rows = [(1.0, "x", None, 1), (None, "y", None, 2), (3.0, None, None, None), (8.0, "y", 1, 4)]
    df = spark.createDataFrame(rows, "v double, c string, e int, n int")
    policy = NullPolicy(0.75).fit(df)
    assert policy.dropped == ["e"]
    assert policy.fills == {"v": 3.0, "n": 2.0, "c": "y"}
    other = spark.createDataFrame([(None, None, 5, None)], df.schema)
    assert tuple(policy.transform(other).first()) == (3.0, "y", 2)


def test_null_policy_all_null_column(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "a double, b int")
    assert NullPolicy(0.95).fit(df).transform(df).columns == ["b"]


def test_missing_counts_and_nan(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (None, None), (1.0, "b")], "v double, c string")
    assert tuple(missing_counts(df).first()) == (2, 1)
    assert tuple(missing_counts(df.limit(0)).first()) == (0, 0)


def test_mode_takes_the_smallest_on_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert most_frequent(df, ["c"]).first()["value"] == "a"


def test_bins_collapse_repeated_edges(spark):
    df = spark.createDataFrame([(1,)] * 8 + [(2,), (3,)], "v int")
    edges = quantile_edges(df, "v", 4)
    assert edges == [1.0]
    got = [r["b"] for r in df.select(bin_number("v", edges).alias("b")).collect()]
    assert got == [0] * 8 + [1, 1]


def test_describe(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,)], "v double")
    row = describe(df).first()
    assert (row["count"], row["null_count"], row["min"], row["max"], row["q50"]) == (3, 1, 1, 4, 2)


def test_lifecycle_ties_and_threshold(spark):
    rows = [(1, "2020-01-02", 3, "b"), (1, "2020-01-02", 3, "a"), (1, "2020-01-09", 10, "c"),
            (2, "2020-01-01", 99, "z"), (3, None, 1, "n")]
    df = spark.createDataFrame(rows, "id int, d string, lag int, f string")
    out = {r["id"]: r for r in lifecycle(df, "id", "d", "lag", 60, ["f"]).collect()}
    assert set(out) == {1, 3}
    assert (out[1]["f"], out[1]["days_in_trending"], str(out[1]["first_day_in_trending"])) == (
        "a", 7, "2020-01-02",
    )
    assert (out[3]["f"], out[3]["days_in_trending"]) == (None, None)


def test_lifecycle_carries_its_features_once(spark):
    rows = [(1, "2020-01-02", 3, "b", 5), (1, "2020-01-02", 4, "a", 9), (1, "2020-01-09", 1, "a", 1), (2, None, 1, "z", 1)]
    df = spark.createDataFrame(rows, "id int, at string, lag int, d string, f int").withColumn("at", F.to_date("at"))
    made = lifecycle(df, "id", "at", "lag", 60, ["d", "f"])
    out = {r["id"]: r for r in made.collect()}
    assert (out[1]["d"], out[1]["f"], out[1]["lag"], out[1]["days_in_trending"]) == ("a", 9, 1, 7)
    assert (out[2]["d"], out[2]["f"]) == (None, None)
    assert "min_by" not in made._jdf.queryExecution().optimizedPlan().toString()
