import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldmill.operators.ordered import (
    alphabetical_codes,
    nested_quantiles,
    quantiles,
    running_totals,
    scalar_quantile,
)


def data(spark, n=400):
    rng = random.Random(3)
    rows = [
        ("hot" if rng.random() < 0.6 else rng.choice(["a", "b", None]),
         None if rng.random() < 0.05 else float(rng.randrange(60)), rng.randrange(2))
        for _ in range(n)
    ]
    return rows, spark.createDataFrame(rows, "k string, v double, y int")


def check_totals(rows, df, descending):
    out = running_totals(df.where("v is not null"), ["k"], "v",
                         {"n": F.count("*"), "s": F.sum("y")}, descending).collect()
    for r in out:
        group = [q for q in rows if q[0] == r["k"] and q[1] is not None]
        so_far = [q for q in group if (q[1] >= r["v"] if descending else q[1] <= r["v"])]
        assert (r["n_upto"], r["n_all"]) == (len(so_far), len(group))
        assert (r["s_upto"], r["s_all"]) == (sum(q[2] for q in so_far), sum(q[2] for q in group))
    assert len(out) == len({(q[0], q[1]) for q in rows if q[1] is not None})


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, descending):
    rows, df = data(spark)
    check_totals(rows, df, descending)


def check_quantiles(rows, df):
    probs = {f"p{i}": i / 20 for i in (0, 1, 5, 10, 14, 19, 20)}
    for mode in ("linear", "discrete", "nearest"):
        for r in quantiles(df, "v", probs, ["k"], mode).collect():
            values = sorted(q[1] for q in rows if q[0] == r["k"] and q[1] is not None)
            n = len(values)
            for name, p in probs.items():
                if mode == "linear":
                    want = float(np.quantile(values, p))
                elif mode == "discrete":
                    want = values[max(n - math.floor(n - p * n), 1) - 1]
                else:
                    want = values[math.floor(p * (n - 1) + 0.5)]
                assert r[name] == pytest.approx(want), (mode, name, r["k"])


def test_quantiles(spark):
    check_quantiles(*data(spark))


def test_quantiles_edges(spark):
    empty = spark.createDataFrame([], "v double")
    assert scalar_quantile(empty, "v", 0.5) is None
    one = spark.createDataFrame([(4.0,)], "v double")
    assert [scalar_quantile(one, "v", p, "linear") for p in (0.0, 0.5, 1.0)] == [4.0] * 3
    with pytest.raises(ValueError):
        scalar_quantile(one, "v", 0.5, "odd")


def test_nested_quantiles(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 11)], "v int")
    assert nested_quantiles(df, "v", 0.8, 0.8, "discrete", closed=False) == (8, 6)
    first, second = nested_quantiles(df, "v", 0.9, 0.9, "linear", closed=True)
    assert (first, second) == pytest.approx((9.1, 8.2))


def test_alphabetical_codes(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("C",)], "v string")
    assert {r["v"]: r["code"] for r in alphabetical_codes(df, "v").collect()} == {
        "C": 0, "a": 1, "b": 2,
    }
