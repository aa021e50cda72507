import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fieldmill.operators.calendar import monthly_distinct
from fieldmill.operators.trailing import (
    CHANNEL_NAMES,
    GENERAL_NAMES,
    add_trailing,
    trailing_table,
)

SCHEMA = "video_id int, channel string, d date, m int"
D0 = dt.date(2020, 1, 1)


def day(n):
    return D0 + dt.timedelta(days=n)


def brute(rows, channel, at, n):
    inside = [r for r in rows if (channel is None or r[1] == channel)
              and at - dt.timedelta(days=n) <= r[2] < at]
    metrics = [r[3] for r in inside if r[3] is not None]
    return (
        len({r[0] for r in inside}),
        max(metrics, default=0),
        sum(metrics) / len(metrics) if metrics else 0.0,
    )


@pytest.mark.parametrize("key", ["channel", None])
def test_random_against_definition(spark, key):
    rng = random.Random(11)
    rows = [
        (rng.randrange(12), "hot" if rng.random() < 0.5 else f"c{rng.randrange(3)}",
         day(rng.randrange(60)), None if rng.random() < 0.1 else rng.randrange(30))
        for _ in range(300)
    ]
    names = CHANNEL_NAMES if key else GENERAL_NAMES
    table = trailing_table(
        spark.createDataFrame(rows, SCHEMA), "d", (3, 7, 30), "video_id", "m", names, key
    ).collect()
    active = {(r[1] if key else None, r[2]) for r in rows}
    assert {(r[key] if key else None, r["d"]) for r in table} == active
    for r in table:
        for n in (3, 7, 30):
            want = brute(rows, r[key] if key else None, r["d"], n)
            got = (
                r[names["distinct"].format(n=n)],
                r[names["max"].format(n=n)],
                r[names["mean"].format(n=n)],
            )
            assert got == pytest.approx(want)


def test_no_fan_out_and_calendar_days(spark):
    """Two videos of a channel on one day stay two rows; gaps count as days."""
    rows = [(1, "a", day(0), 5), (2, "a", day(0), 7), (3, "a", day(20), 1), (4, "a", day(21), 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = add_trailing(df, "d", (7, 30), "video_id", "m", CHANNEL_NAMES, "channel")
    got = {r["video_id"]: r for r in out.collect()}
    assert len(got) == 4
    seven = CHANNEL_NAMES["distinct"].format(n=7)
    thirty = CHANNEL_NAMES["distinct"].format(n=30)
    assert [got[i][seven] for i in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert [got[i][thirty] for i in (1, 2, 3, 4)] == [0, 0, 2, 3]
    assert got[3][CHANNEL_NAMES["max"].format(n=30)] == 7


def test_month_bounds(spark):
    rows = [(1, "a", dt.date(2020, 1, 31), 0), (2, "a", dt.date(2020, 2, 1), 0),
            (2, "a", dt.date(2020, 2, 9), 0)]
    df = spark.createDataFrame(rows, SCHEMA)

    def table(closed):
        out = monthly_distinct(df, "channel", "d", "video_id", "n", closed)
        return {(str(r["lower_boundary"]), str(r["upper_boundary"])): r["n"] for r in out.collect()}

    assert table("left") == {("2020-01-01", "2020-02-01"): 1, ("2020-02-01", "2020-03-01"): 1}
    assert table("both") == {("2020-01-01", "2020-02-01"): 2, ("2020-02-01", "2020-03-01"): 1}
    with pytest.raises(ValueError):
        monthly_distinct(df, "channel", "d", "video_id", "n", "right")


def test_null_channel(spark):
    rows = [(1, None, day(0), 5), (2, None, day(2), 7)]
    out = add_trailing(
        spark.createDataFrame(rows, SCHEMA), "d", (7,), "video_id", "m", CHANNEL_NAMES, "channel"
    )
    got = {r["video_id"]: r[CHANNEL_NAMES["distinct"].format(n=7)] for r in out.collect()}
    assert got == {1: 0, 2: 1}
    assert out.where(F.col("channel").isNotNull()).count() == 0


def test_gaps_as_long_as_a_period(spark):
    days = [0, 6, 13, 21, 28]  # gaps of 6, 7, 8 and 7 days
    rows = [("v", "c", day(n), n) for n in days] + [("w", "c", day(n), n) for n in (20, 27, 28, 29)]
    df = spark.createDataFrame(rows, "video_id string, channel string, d date, m int")
    out = {r["d"]: r for r in trailing_table(df, "d", [7, 30], "video_id", "m", GENERAL_NAMES).collect()}
    assert set(out) == {r[2] for r in rows}
    for at, row in out.items():
        for n in (7, 30):
            want = brute(rows, None, at, n)
            assert row[GENERAL_NAMES["distinct"].format(n=n)] == want[0]
            assert row[GENERAL_NAMES["max"].format(n=n)] == want[1]


def test_sightings_are_not_multiplied(spark):
    df = spark.createDataFrame([(1, "c", day(0), 1)], SCHEMA)
    out = trailing_table(df, "d", [7, 30, 180], "video_id", "m", CHANNEL_NAMES, "channel")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Expand" not in plan


def test_added_features_read_the_tables_once(spark, tmp_path):
    from fieldmill.catalog.base import Tables
    from fieldmill.catalog.windows import add_period_features, add_rolling_features

    lines = [(1, 7, 3, day(0), 10.0, 5.0, 0.1, 1), (2, 7, 3, day(4), 20.0, 6.0, 0.2, 1)]
    spark.createDataFrame(
        lines,
        "l_orderkey long, l_partkey long, l_suppkey long, l_shipdate date, l_extendedprice double, "
        "l_quantity double, l_discount double, l_linenumber int",
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame(
        [(1, day(-2)), (2, day(-1))], "o_orderkey long, o_orderdate date"
    ).write.parquet(str(tmp_path / "orders.parquet"))
    for build in (add_rolling_features, add_period_features):
        out = build(Tables(spark, str(tmp_path)))
        assert [r["video_id"] for r in out.collect()] == [7]
        assert not any("lineitem" in f for f in out.inputFiles())
