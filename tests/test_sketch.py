"""United sketches against exact counts and ranks."""

import random

from fieldmill.operators import sketch as S
from fieldmill.session import staged


def test_united_distincts(spark):
    draw = random.Random(1)
    rows = [(k % 9, draw.randrange(20_000), f"v{k % 5}", None) for k in range(60_000)]
    df = spark.createDataFrame(rows, "day int, a long, b string, c string")
    parts = staged(S.distinct_sketches(df, ["a", "b", "c"], ["day"]))
    assert parts.count() == 27
    got = {r.column: r for r in S.united_distincts(parts).collect()}
    exact = len({r[1] for r in rows})
    assert abs(got["a"].distinct_estimate - exact) <= 3 * 1.04 / 2**7 * exact
    assert got["b"].distinct_estimate == 5 and got["c"].distinct_estimate == 0
    assert {r.rows for r in got.values()} == {60_000}
    # united parts are what one sketch of their rows says
    some = parts.where("day < 4")
    whole = S.distinct_sketches(df.where("day < 4"), ["a"])
    a = {r.column: r.distinct_estimate for r in S.united_distincts(some).collect()}["a"]
    assert abs(a - S.united_distincts(whole).first().distinct_estimate) <= 0.02 * a
    by_day = S.united_distincts(parts, ["day"]).where("column = 'b'").collect()
    assert [r.distinct_estimate for r in by_day] == [5] * 9
    assert S.united_distincts(S.distinct_sketches(df.limit(0), ["a"], ["day"])).count() == 0


def test_united_quantiles_keep_the_rank_error(spark):
    draw = random.Random(2)
    # one part holds a third of the rows, values are skewed and tied
    rows = [(0 if draw.random() < 0.33 else draw.randrange(40), round(draw.paretovariate(0.7), 1)) for _ in range(80_000)]
    rows += [(1, None), (2, float("nan"))]
    df = spark.createDataFrame(rows, "part int, x double").repartition(6)
    shares = [0.0, 0.01, 0.1, 0.5, 0.9, 0.999, 1.0]
    found = S.united_quantiles(staged(S.quantile_sketches(df, ["x"], ["part"])), shares).collect()
    values = sorted(x for _, x in rows if x is not None and x == x)
    assert [r.n for r in found] == [len(values)] * len(shares)
    for r in found:
        below = sum(v < r.estimate for v in values)
        upto = sum(v <= r.estimate for v in values)
        slack = S.RANK_ERROR * len(values) + 1
        assert below <= r.share * len(values) + slack and upto >= r.share * len(values) - slack
    assert S.united_quantiles(S.quantile_sketches(df.limit(0), ["x"]), shares).count() == 0
