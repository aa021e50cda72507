"""Tree tables, prefixes of boosters and the patience rule against plain walks and refits."""

import math
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fieldmill.learn import model as M
from fieldmill.learn import trees as R
from fieldmill.session import scratch_path

NUMERIC, CATEGORICAL = ["x", "z"], ["c"]


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(5)
    out = []
    for k in range(900):
        x, z, c = draw.gauss(0, 1), draw.gauss(0, 1), draw.choice("abcdefg")
        score = x + (2 if c in "bdf" else -1) + 0.7 * draw.gauss(0, 1)
        out.append((k, x, z, c, float(score > 0), score))
    df = spark.createDataFrame(out, "k long, x double, z double, c string, y double, s double")
    df = df.repartition(4, "k").sortWithinPartitions("k").persist()
    yield df
    df.unpersist()


def parts(rows):
    return rows.where("k % 3 <> 0"), rows.where("k % 3 = 0")


@pytest.mark.parametrize("label", ["y", "s"])
def test_curve_equals_losses_of_refits(spark, rows, label):
    train, val = parts(rows)
    make = M.boosted_classifier if label == "y" else M.boosted_regressor
    fitted = M.fit_pipeline(train, make(label, maxIter=12, maxDepth=3), NUMERIC, CATEGORICAL)
    encoded = PipelineModel(stages=fitted.stages[:-1]).transform(val)
    curve = {r["round"]: r for r in R.prefix_curve(fitted.stages[-1], encoded, label).collect()}
    assert sorted(curve) == list(range(1, 13)) and {r["n"] for r in curve.values()} == {300}
    extra = [] if label == "y" else ["squared"]
    own = fitted.stages[-1].evaluateEachIteration(encoded, *extra)
    assert [curve[k + 1]["loss"] for k in range(12)] == pytest.approx(own)
    for rounds in (1, 5, 12):
        refit = M.fit_pipeline(train, make(label, maxIter=rounds, maxDepth=3), NUMERIC, CATEGORICAL)
        cut = R.first_trees(fitted.stages[-1], rounds)
        assert cut.getNumTrees == rounds
        names = [f.name for f in cut.transform(encoded).schema]
        column = vector_to_array("probability")[1] if "probability" in names else F.col("prediction")
        got = [r[0] for r in cut.transform(encoded).orderBy("k").select(column).collect()]
        want = [r[0] for r in refit.stages[-1].transform(encoded).orderBy("k").select(column).collect()]
        assert got == pytest.approx(want)
    with pytest.raises(ValueError):
        R.first_trees(fitted.stages[-1], 13)


def plain_rule(losses, patience, gain):
    best, at = math.inf, 0
    for k, loss in enumerate(losses, 1):
        if not at or loss < best - gain:
            best, at = loss, k
        if k - at >= patience:
            return at, best, k
    return at, best, len(losses)


def test_patience(spark):
    draw = random.Random(2)
    curves = [[draw.choice([1.0, 0.9, 0.8, 0.7 - k / 99]) for k in range(30)] for _ in range(12)]
    curves += [[1.0], [1.0, 1.0, 1.0], [3.0, 2.0, 2.5, 2.4, 2.3, 1.0]]
    data = [(t, k + 1, loss) for t, c in enumerate(curves) for k, loss in enumerate(c)]
    df = spark.createDataFrame(data, "trial int, round int, loss double")
    for patience, gain in ((1, 0.0), (3, 0.0), (5, 0.05), (99, 0.0)):
        got = R.patient_best(df, patience, ["trial"], gain).collect()
        assert {r.trial: (r.best_round, r.loss, r.stopped_at) for r in got} == {
            t: plain_rule(c, patience, gain) for t, c in enumerate(curves)
        }


def test_patience_outlasts_a_plateau(spark):
    """A parity of two columns: the first rounds gain almost nothing, later ones do."""
    draw = random.Random(8)
    data = [(k, draw.random(), draw.random()) for k in range(1500)]
    rows = spark.createDataFrame(data, "k long, x double, z double").select(
        "*", (((F.col("x") > 0.5) != (F.col("z") > 0.5)) & (F.col("k") % 11 > 0)).cast("double").alias("y"),
        (F.col("k") % 3 == 0).alias("is_val"),
    ).repartition(4, "k").sortWithinPartitions("k").persist()
    train, val = rows.where("not is_val"), rows.where("is_val")
    settings = {"maxIter": 40, "maxDepth": 2, "stepSize": 0.3}
    model, curve = R.fit_patient(train, val, M.boosted_classifier("y", **settings), ["x", "z"], patience=15)
    hasty = M.fit_pipeline(rows, M.boosted_classifier("y", "is_val", **settings), ["x", "z"])
    losses = {r["round"]: r["loss"] for r in curve.collect()}
    best = model.stages[-1].getNumTrees
    assert best > hasty.stages[-1].getNumTrees
    assert losses[best] == min(losses[k] for k in losses if k <= best + 15)
    path = scratch_path(spark, "cut")
    M.save_pipeline(model, path)
    before = [r[0] for r in M.scored(model, val, "p").orderBy("k").select("p").collect()]
    again = [r[0] for r in M.score_with_saved(spark, path, val, "p").orderBy("k").select("p").collect()]
    assert before == again
    rows.unpersist()


def plain_importances(nodes, names):
    trees = {}
    for r in nodes:
        trees.setdefault(r.tree, {})[r.node] = r
    out = {n: [0, 0, 0.0, 0.0] for n in names}
    for tree in trees.values():
        least, deepest, todo = {}, 0, [(0, 0)]
        while todo:
            at, depth = todo.pop()
            node, deepest = tree[at], max(deepest, depth)
            if node.left >= 0:
                name = names[node.feature]
                least[name] = min(depth, least.get(name, depth))
                out[name][0] += depth == 0
                out[name][1] += 1
                out[name][3] += node.gain * node.n_rows
                todo += [(node.left, depth + 1), (node.right, depth + 1)]
        for name in names:
            out[name][2] += least.get(name, deepest) / len(trees)
    return out


def test_structural_importances_equal_a_plain_walk(spark, rows):
    names = ["x", "z", "c_ind"]
    for learner in (M.forest_classifier("y", numTrees=9, maxDepth=4), M.boosted_regressor("s", maxIter=3, maxDepth=2)):
        fitted = M.fit_pipeline(rows, learner, NUMERIC, CATEGORICAL)
        nodes = R.node_table(fitted.stages[-1], spark).collect()
        got = R.structural_importances(fitted, spark).collect()
        want = plain_importances(nodes, names)
        assert len(got) == 3
        for r in got:
            assert [r.as_root, r.uses, r.mean_least_depth, r.total_gain] == pytest.approx(want[r.feature])


def test_walk_equals_the_forest(spark, rows):
    fitted = M.fit_pipeline(rows, M.forest_regressor("s", numTrees=5, maxDepth=5), NUMERIC, CATEGORICAL)
    encoded = PipelineModel(stages=fitted.stages[:-1]).transform(rows)
    values = encoded.orderBy("k").select(vector_to_array("features")).toPandas().iloc[:, 0]
    out = R.walk_of(fitted.stages[-1], spark).outputs(np.stack(values.to_numpy()))
    want = [r[0] for r in fitted.stages[-1].transform(encoded).orderBy("k").select("prediction").collect()]
    assert out.mean(axis=1) == pytest.approx(want)
