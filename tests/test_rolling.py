import random

import pytest
from pyspark.sql import functions as F

from fieldmill.operators.rolling import Rolling, add_rolling, lookback

SCHEMA = "id int, k string, other string, sec long, v double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("dt", F.timestamp_seconds("sec"))


def brute(rows, key, minutes, op, column):
    """Straight from the definition: seconds t - 60m .. t - 1 of the same key."""
    names = ["id", "k", "other", "sec", "v"]
    at = {n: i for i, n in enumerate(names)}
    out = {}
    for r in rows:
        inside = [
            q[at[column]]
            for q in rows
            if q[at[key]] == r[at[key]]
            and r[3] - 60 * minutes <= q[3] <= r[3] - 1
            and q[at[column]] is not None
        ]
        if op == "count":
            out[r[0]] = len(inside)
        elif op == "sum":
            out[r[0]] = sum(inside) if inside else None
        else:
            out[r[0]] = sum(inside) / len(inside) if inside else None
    return out


def test_frame_edges(spark):
    rows = [
        (1, "a", "x", 1000, 1.0),
        (2, "a", "x", 1000, 2.0),  # same second: neither sees the other
        (3, "a", "y", 1060, 4.0),  # 60 s later: still inside a minute
        (4, "a", "y", 1121, 8.0),  # 61 s later: outside
        (5, "b", "y", 1061, 16.0),
    ]
    specs = [
        Rolling("n", "k", 1),
        Rolling("s", "v", 1, "sum", "k"),
        Rolling("m", "v", 1, "avg", "k"),
    ]
    got = {r["id"]: (r["n"], r["s"], r["m"]) for r in add_rolling(frame(spark, rows), specs).collect()}
    assert got == {
        1: (0, None, None),
        2: (0, None, None),
        3: (2, 3.0, 1.5),
        4: (0, None, None),
        5: (0, None, None),
    }


def test_partition_key_is_honoured(spark):
    """An average of v per k must not be partitioned by v."""
    rows = [(1, "a", "x", 10, 5.0), (2, "a", "x", 20, 7.0)]
    out = add_rolling(frame(spark, rows), [Rolling("m", "v", 1, "avg", "k")])
    assert {r["id"]: r["m"] for r in out.collect()} == {1: None, 2: 5.0}


def test_unknown_operation():
    with pytest.raises(ValueError):
        Rolling("x", "v", 1, "median")


@pytest.mark.parametrize("op", ["count", "sum", "avg"])
def test_random_against_definition(spark, op):
    """Most rows in one key, times across many block limits."""
    rng = random.Random(5)
    base = 6 * 3600 * 1000
    rows = [
        (
            i,
            "hot" if rng.random() < 0.6 else f"k{rng.randrange(4)}",
            rng.choice(["x", "y"]),
            base + rng.choice([-1, 1]) * rng.randrange(0, 3 * 3600),
            None if rng.random() < 0.1 else float(rng.randrange(50)),
        )
        for i in range(250)
    ]
    specs = [Rolling("w1", "v", 1, op, "k"), Rolling("w90", "v", 90, op, "k"),
             Rolling("o30", "v", 30, op, "other")]
    got = {r["id"]: r for r in add_rolling(frame(spark, rows), specs).collect()}
    assert len(got) == len(rows)
    for name, key, minutes in (("w1", "k", 1), ("w90", "k", 90), ("o30", "other", 30)):
        want = brute(rows, key, minutes, op, "v")
        for i, value in want.items():
            assert got[i][name] == pytest.approx(value), (name, i)


def test_null_key_and_null_time_keep_rows(spark):
    rows = [(1, None, "x", 10, 1.0), (2, None, "x", 20, 2.0), (3, "a", "x", None, 3.0)]
    df = frame(spark, rows)
    specs = [Rolling("n", "k", 1), Rolling("s", "v", 1, "sum", "k")]
    got = {r["id"]: (r["n"], r["s"]) for r in add_rolling(df, specs).collect()}
    plain = {
        r["id"]: (r["n"], r["s"])
        for r in df.select(
            "id", lookback("k", 1).alias("n"), lookback("v", 1, "sum", "k").alias("s")
        ).collect()
    }
    assert got == plain and len(got) == 3


def test_narrow_rows_give_the_same(spark):
    rows = [(i, f"k{i % 3}", "x", 1000 + 7 * i, float(i)) for i in range(60)]
    specs = [Rolling("n", "k", 1), Rolling("m", "v", 2, "avg", "other")]
    whole = add_rolling(frame(spark, rows), specs)
    narrow = add_rolling(frame(spark, rows), specs, row_id="id")
    assert narrow.columns == whole.columns
    assert sorted(whole.collect()) == sorted(narrow.collect())


def test_empty(spark):
    assert add_rolling(frame(spark, []), [Rolling("n", "k", 1)]).count() == 0


def test_work_grows_with_the_rows(spark):
    """Twice the seconds of one key give twice the rows at every step of the plan."""
    def made(seconds):
        rows = [(i, "hot", "x", 1_000_000 + i, 1.0) for i in range(seconds)]
        out = add_rolling(frame(spark, rows), [Rolling("n", "k", 24 * 60)])
        assert out.agg(F.sum("n")).first()[0] == seconds * (seconds - 1) // 2
        windows = out._jdf.queryExecution().executedPlan().toString()
        assert "RangeFrame" not in windows and "rangebetween" not in windows.lower()

    made(1000)
    made(2000)
