import math
import random

import pytest
from pyspark.sql import functions as F

from fieldmill.learn import evaluate as E
from fieldmill.learn import model as M
from fieldmill.learn import tune as N
from fieldmill.learn.encode import (
    WoeEncoder,
    WoeModel,
    balanced_weights,
    standardised,
    with_ordinal_codes,
)
from fieldmill.session import scratch_path


def scored_rows(n=300, seed=1):
    rng = random.Random(seed)
    return [(rng.choice(["a", "b"]), round(rng.random(), 2), rng.randrange(2)) for _ in range(n)]


def brute_auc(rows):
    pos = [s for _, s, y in rows if y]
    neg = [s for _, s, y in rows if not y]
    won = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    return won / (len(pos) * len(neg))


def brute_ap(rows):
    total, area, last = sum(y for *_, y in rows), 0.0, 0.0
    for t in sorted({s for _, s, _ in rows}, reverse=True):
        taken = [y for _, s, y in rows if s >= t]
        recall = sum(taken) / total
        area += (recall - last) * sum(taken) / len(taken)
        last = recall
    return area


def check_ranking(spark):
    rows = scored_rows()
    df = spark.createDataFrame(rows, "k string, score double, label int")
    assert E.roc_auc(df, "score", "label").first()[0] == pytest.approx(brute_auc(rows))
    assert E.average_precision(df, "score", "label").first()[0] == pytest.approx(brute_ap(rows))
    for r in E.ranking_metrics(df, "score", "label", ["k"]).collect():
        part = [q for q in rows if q[0] == r["k"]]
        assert r["roc_auc"] == pytest.approx(brute_auc(part))
        assert r["average_precision"] == pytest.approx(brute_ap(part))


def test_ranking(spark):
    check_ranking(spark)


def test_areas_agree_with_the_builtin_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.functions import array_to_vector

    rows = scored_rows(seed=4)
    df = spark.createDataFrame(rows, "k string, score double, label int").withColumn(
        "rawPrediction", array_to_vector(F.array(1 - F.col("score"), F.col("score")))
    )
    for name, fn in (("areaUnderROC", E.roc_auc), ("areaUnderPR", E.pr_auc)):
        builtin = BinaryClassificationEvaluator(metricName=name, numBins=0).evaluate(df)
        assert fn(df, "score", "label").first()[0] == pytest.approx(builtin)


def test_one_class_has_no_area(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "score double, label int")
    assert E.roc_auc(df, "score", "label").first()[0] is None


def test_thresholds(spark):
    rows = [(0.0, 0), (0.29, 1), (0.29, 0), (0.57, 1), (0.58, 0), (1.0, 1), (0.07, 1)]
    df = spark.createDataFrame(rows, "score double, label int")
    table = {round(r["threshold"], 2): r for r in E.threshold_table(df, "score", "label").collect()}
    assert len(table) == 101
    for i in range(101):
        t = i * 0.01
        taken = [y for s, y in rows if s >= t]
        hits, r = sum(taken), table[round(t, 2)]
        assert r["precision"] == pytest.approx(hits / len(taken) if taken else 0), t
        assert r["recall"] == pytest.approx(hits / 4), t
        assert r["f1"] == pytest.approx(2 * hits / (len(taken) + 4)), t
        assert r["alert_rate"] == pytest.approx(len(taken) / 7), t
    best = E.best_threshold(E.threshold_table(df, "score", "label")).first()
    top = max(r["f1"] for r in table.values())
    assert best["threshold"] == min(t for t, r in table.items() if r["f1"] == top)


def test_rule_uses_train_values_on_test_rows(spark):
    train = spark.createDataFrame([(1, 0), (3, 1), (9, 0)], "v int, y int")
    test = spark.createDataFrame([(0, 1), (2, 1), (3, 0), (5, 1), (None, 1)], "v int, y int")
    got = {r["threshold"]: r["f1"] for r in E.rule_f1(train, test, "v", "y").collect()}
    assert got == pytest.approx({1: 2 / 5, 3: 4 / 7, 9: 6 / 8})


def woe_frames(spark):
    rows = [("x", 1), ("x", 1), ("x", 0), ("y", 0), ("y", 0), ("once", 1), (None, 1), (None, 0)]
    train = spark.createDataFrame(rows, "c string, y int").withColumn("same", F.lit("s"))
    new = spark.createDataFrame([("x", "s"), ("new", "t"), ("once", "s"), (None, None)],
                                "c string, same string")
    return train, new


def test_weight_of_evidence(spark):
    train, new = woe_frames(spark)
    model = WoeEncoder(["c", "same"], "y").fit(train)
    assert model.invariant == ["same"]
    out = model.transform(new)
    assert out.columns == ["c"]
    x = math.log(((2 + 1) / (4 + 2)) / ((1 + 1) / (4 + 2)))
    missing = math.log(((1 + 1) / (4 + 2)) / ((1 + 1) / (4 + 2)))
    assert sorted(r["c"] for r in out.collect()) == pytest.approx(sorted([x, 0.0, 0.0, missing]))


def test_weight_of_evidence_saved(spark):
    train, new = woe_frames(spark)
    model = WoeEncoder(["c", "same"], "y").fit(train)
    path = scratch_path(spark, "woe")
    model.save_to(path)
    again = WoeModel.load_from(spark, path)
    assert sorted(model.transform(new).collect()) == sorted(again.transform(new).collect())


def test_small_encoders(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 3.0), ("b", 5.0)], "c string, v double")
    codes = with_ordinal_codes(df, "c", "code")
    assert {(r["c"], r["code"]) for r in codes.collect()} == {("a", 0), ("b", 1)}
    unseen = with_ordinal_codes(spark.createDataFrame([("z",)], "c string"), "c", "code", df)
    assert unseen.first()["code"] is None
    scaled = sorted(r["v"] for r in standardised(df, ["v"]).collect())
    assert scaled == pytest.approx([-math.sqrt(1.5), 0, math.sqrt(1.5)])
    flat = standardised(df.withColumn("v", F.lit(2.0)), ["v"])
    assert {r["v"] for r in flat.collect()} == {0.0}
    weights = {r["c"]: r["weight"] for r in balanced_weights(df, "c").collect()}
    assert weights == pytest.approx({"a": 1.5, "b": 0.75})


@pytest.fixture(scope="module")
def learning(spark):
    rng = random.Random(8)
    rows = []
    for i in range(400):
        x, c = rng.random(), rng.choice("uvw")
        rows.append((i, x, c, int(x + (c == "u") * 0.3 + rng.gauss(0, 0.1) > 0.7)))
    return spark.createDataFrame(rows, "id int, x double, c string, y int")


def test_pipeline_saved_and_scored(spark, learning):
    learner = M.forest_classifier("y", numTrees=5, maxDepth=3)
    fitted = M.fit_pipeline(learning, learner, ["x"], ["c"])
    scores = M.scored(fitted, learning)
    assert scores.columns == [*learning.columns, "default_proba"]
    assert E.roc_auc(scores, "default_proba", "y").first()[0] > 0.9
    path = scratch_path(spark, "pipeline")
    M.save_pipeline(fitted, path)
    again = M.score_with_saved(spark, path, learning)
    assert sorted(scores.collect()) == sorted(again.collect())
    table = M.importances(fitted, spark).collect()
    assert [r["feature"] for r in table] == ["x", "c_ind"]
    assert sum(r["importance"] for r in table) == pytest.approx(1)


def test_many_levels_widen_the_bins(spark, learning):
    df = learning.withColumn("c", F.concat(F.lit("l"), (F.col("id") % 50).cast("string")))
    M.fit_pipeline(df, M.forest_classifier("y", numTrees=2, maxDepth=2), ["x"], ["c"])


def test_search_sweep_and_validation(spark, learning):
    train, val = learning.where("id % 4 > 0"), learning.where("id % 4 = 0")
    space = {"numTrees": ("int", 2, 4), "maxDepth": ("choice", [2, 3])}
    best, trials = N.search(train, val, ["x"], ["c"], "y", space, rounds=3, seed=1)
    assert set(best) == {"numTrees", "maxDepth"} and trials.count() == 3
    top = N.leaderboard(trials, k=1).first()
    assert str(sorted(best.items())) == top["params"]
    again, _ = N.search(train, val, ["x"], ["c"], "y", space, rounds=3, seed=1)
    assert again == best
    swept = N.sweep(train, val, ["x"], ["c"], "y", "maxIter", [2, 3], M.boosted_classifier)
    assert [r["best_iter"] for r in swept.orderBy("value").collect()] == [2, 3]
    auc = N.cross_validated_auc(learning, ["x"], ["c"], "y", "id", folds=2, maxIter=2)
    assert 0.8 < auc <= 1
    power = N.predictive_power(learning, "x", "y", "id", folds=2).first()
    assert 0.3 < power["power"] <= 1
    with pytest.raises(ValueError):
        N.draw({"a": ("odd", 1)}, random.Random(1))


def test_rates_are_fitted_at_the_same_time(spark):
    import threading

    from fieldmill.learn.model import boosted_classifier
    from fieldmill.learn.tune import sweep_rounds

    met = threading.Barrier(2, timeout=60)

    def learner(label, **params):
        met.wait()  # passed only if another fit begins before this one has ended
        return boosted_classifier(label, **params)

    df = spark.createDataFrame([(float(n % 7), float(n % 2)) for n in range(40)], "x double, label double")
    out, _ = sweep_rounds(df, df, ["x"], [], "label", "stepSize", [0.1, 0.3], 2, learner=learner)
    assert sorted(r["value"] for r in out.collect()) == [0.1, 0.3]


def test_clusters_make_each_token_list_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def words(n):
        made.add(1)
        return (["road", "tree"] if n % 2 else ["bill", "loan"]) * (n % 5 + 1)

    rows = spark.range(0, 40, 1, 4).select("id", words("id").alias("w"))
    found = M.clustered_texts(rows, "w", k=2)
    assert found.columns == ["id", "w", "cluster"]
    got = {(r.id % 2, r.cluster) for r in found.collect()}
    assert len(got) == 2 and len({c for _, c in got}) == 2
    assert made.value == 40


def test_trees_are_fitted_on_few_partitions(spark, monkeypatch):
    most, seen, plain = 3 * spark.sparkContext.defaultParallelism, [], M.RandomForestClassifier.fit

    def fit(self, rows, params=None):
        seen.append((rows.rdd.getNumPartitions(), rows.count()))
        return plain(self, rows, params)

    monkeypatch.setattr(M.RandomForestClassifier, "fit", fit)
    x = F.col("id").cast("double")
    rows = spark.range(400).select(x.alias("x"), (x % 2).alias("y")).repartition(most + 9)
    M.fit_pipeline(rows, M.forest_classifier("y", numTrees=2), ["x"])
    N.search(rows, rows, ["x"], [], "y", {"numTrees": ("int", 2, 3)}, 1)
    assert seen == [(most, 400)] * 2
