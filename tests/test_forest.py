"""Forests that grow, against plain counts and Spark's own models."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from fieldmill.learn import forest as G
from fieldmill.learn import model as M
from fieldmill.learn import tune as N
from fieldmill.plans import network


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    made = []
    for n in range(900):
        x, z, c = rng.random(), float(rng.randrange(5)), rng.choice("abcde")
        bad = rng.random() < 0.1 + 0.4 * (x > 0.6) + 0.3 * (c in "bd") + 0.1 * (z == 2)
        made.append((n, x, z, rng.gauss(0, 1), c, int(bad)))
    return spark.createDataFrame(made, "id int, x double, z double, w double, c string, y int").repartition(3).cache()


@pytest.fixture(scope="module")
def ready(rows):
    return G.encoded(rows, ["x", "z", "w"], ["c"], "y", 7)


def shape(trees):
    return [(t.left, t.feature, t.counts, [None if r is None else r.tolist() for r in t.right]) for t in trees]


def test_bins_hold_every_row(rows, ready):
    b = ready.binning
    assert b.cuts[1].tolist() == [0.5, 1.5, 2.5, 3.5] and b.sizes.tolist() == [32, 5, 32, 5]
    got = []
    for r in ready.rows.collect():
        x = np.frombuffer(r["x"], np.uint8).reshape(4, r["rows"])
        got += zip(*x.tolist(), np.frombuffer(r["y"], np.uint8).tolist())
    coded = ready.encoder.transform(rows).select("x", "z", "w", "c_ind", "y").collect()
    put = lambda k, v: int((b.cuts[k] < v).sum())
    assert sorted(got) == sorted((put(0, r[0]), put(1, r[1]), put(2, r[2]), int(r[3]), r[4]) for r in coded)


def test_draws_are_poisson_and_repeat():
    draws = G.bootstrap(7, 3, 11, 60_001)
    assert (draws == G.bootstrap(7, 3, 11, 60_001)).all() and len(draws) == 60_001
    assert (draws != G.bootstrap(7, 4, 11, 60_001)).any()
    assert draws.mean() == pytest.approx(1, abs=0.02) and draws.var() == pytest.approx(1, abs=0.03)


@pytest.mark.parametrize("many", [False, True])
def test_blocks_are_cut_at_their_size(spark, monkeypatch, many):
    monkeypatch.setattr(G, "BLOCK", 64)
    levels = 300 if many else 3
    df = spark.range(0, 1000, 1, 2).select(
        F.col("id").cast("double").alias("x"), (F.col("id") % levels).cast("double").alias("k"), (F.col("id") % 2).alias("y")
    )
    b = G.binning(df, ["x"], ["k"], [levels], max(32, levels))
    held = G.blocks(df, b, "y").collect()
    assert len({r["block"] for r in held}) == len(held) and max(r["rows"] for r in held) == 64
    assert sum(r["rows"] for r in held) == 1000 and b.kind == (np.uint16 if many else np.uint8)
    codes = np.concatenate([np.frombuffer(r["x"], b.kind).reshape(2, -1)[1] for r in held])
    assert np.bincount(codes).tolist() == [len(range(k, 1000, levels)) for k in range(levels)]


def test_best_cuts_equal_a_plain_search():
    rng = np.random.default_rng(5)
    cells = rng.integers(0, 6, (40, 5, 2)) * (rng.random((40, 5, 1)) < 0.8)

    def fall(l, r):
        part = lambda c: 1 - (c[0] / max(c.sum(), 1)) ** 2 - (c[1] / max(c.sum(), 1)) ** 2
        n = max((l + r).sum(), 1)
        return part(l + r) - l.sum() / n * part(l) - r.sum() / n * part(r)

    for by_level in (False, True):
        gains, flags, lefts = G.best_cuts(cells, by_level)
        for table, gain, flag, left in zip(cells, gains, flags, lefts):
            options = []
            for mask in range(1, 31):  # every way to part the bins
                side = np.array([mask >> k & 1 for k in range(5)])
                if not by_level and (np.diff(side) < 0).any():
                    continue
                l, r = table[side == 0].sum(axis=0), table[side == 1].sum(axis=0)
                if l.sum() and r.sum():
                    options.append(fall(l, r))
            if not options:
                assert gain == -np.inf
                continue
            assert gain == pytest.approx(max(options))
            assert left.tolist() == table[flag == 0].sum(axis=0).tolist()


def test_nodes_hold_the_drawn_rows(ready):
    forest = G.Forest(ready.rows, ready.binning, 7)
    forest.grow([(4, 3)])
    held = [(r["block"], np.frombuffer(r["x"], np.uint8).reshape(4, -1), np.frombuffer(r["y"], np.uint8)) for r in ready.rows.collect()]
    for number, tree in enumerate(forest.trees):
        counts = np.zeros((len(tree.left), 2), np.int64)
        for block, x, y in held:
            for i, times in enumerate(G.bootstrap(7, number, block, len(y))):
                at = 0
                while True:
                    counts[at, y[i]] += times
                    if tree.left[at] < 0:
                        break
                    at = tree.left[at] + tree.right[at][x[tree.feature[at], i]]
        assert counts.tolist() == [list(c) for c in tree.counts]
        assert max(tree.level) == 3


def test_growing_further_equals_growing_at_once(ready):
    steps, once = G.Forest(ready.rows, ready.binning, 7), G.Forest(ready.rows, ready.binning, 7)
    steps.grow([(3, 2), (6, 1)])
    assert [t.depth for t in steps.trees] == [2] * 3 + [1] * 3
    before = shape(steps.cut(6, 1))
    steps.grow([(5, 4)])
    steps.grow([(9, 4)])
    once.grow([(9, 4)])
    assert shape(steps.cut(9, 4)) == shape(once.cut(9, 4)) and shape(steps.cut(6, 1)) == before
    assert steps.levels_grown == once.levels_grown == 9 * 4
    with pytest.raises(ValueError):
        once.cut(2, 5)


def test_models_score_like_their_trees(spark, rows, ready, tmp_path):
    fitted = G.fit_forest(rows, ["x", "z", "w"], ["c"], "y", 7, numTrees=6, maxDepth=5)
    forest = G.Forest(ready.rows, ready.binning, 7)
    forest.grow([(6, 5)])
    own = G.scores(ready.rows, forest.cut(6, 5), ready.binning, "y").collect()
    spark_scores = M.scored(fitted, rows, "score").select("score", "y").collect()
    assert sorted((round(r["score"], 9), r["y"]) for r in own) == sorted((round(r["score"], 9), r["y"]) for r in spark_scores)
    last = fitted.stages[-1]
    assert last.getNumTrees == 6 and last.getMaxDepth() == 5 and last.numClasses == 2
    assert sum(last.featureImportances.toArray()) == pytest.approx(1)
    M.save_pipeline(fitted, str(tmp_path / "m"))
    again = M.scored(M.load_pipeline(str(tmp_path / "m")), rows, "score").select("score", "y").collect()
    assert sorted(again) == sorted(spark_scores)


def test_as_good_as_sparks_forests(rows):
    train, test = rows.where("id % 3 > 0"), rows.where("id % 3 = 0")
    numeric, categorical = ["x", "z", "w"], ["c"]
    learner = M.forest_classifier("y", 7, numTrees=40, maxDepth=5)
    plain = M.fit_pipeline(train, learner, numeric, categorical)
    grown = G.fit_forest(train, numeric, categorical, "y", 7, numTrees=40, maxDepth=5)
    sizes = [np.mean([t.numNodes for t in m.stages[-1].trees]) for m in (plain, grown)]
    areas = [N.roc_auc(M.scored(m, test, "s"), "s", "y").first()["roc_auc"] for m in (plain, grown)]
    assert sizes[0] == pytest.approx(sizes[1], rel=0.15)
    assert areas[0] == pytest.approx(areas[1], abs=0.04) and areas[1] > 0.65


def test_subtrees_that_guess_alike_are_leaves(spark):
    # 10 % and 30 % of class 1: a split gains, but both sides guess 0
    df = spark.range(4000).selectExpr(
        "id % 7 * 1.0D AS x", "id % 3 * 1.0D AS z", "CAST(id % 10 < IF(id % 7 > 2, 3, 1) AS int) AS y"
    )
    grown = G.fit_forest(df, ["x", "z"], [], "y", 5, numTrees=3, maxDepth=3)
    plain = M.fit_pipeline(df, M.forest_classifier("y", 5, numTrees=3, maxDepth=3), ["x", "z"])
    assert [t.numNodes for m in (grown, plain) for t in m.stages[-1].trees] == [1] * 6


def test_search_grows_each_tree_once(rows, monkeypatch):
    made, plain = [], G.Forest.__init__

    def held(self, *args):
        plain(self, *args)
        made.append(self)

    monkeypatch.setattr(G.Forest, "__init__", held)
    train, val = rows.where("id % 4 > 0"), rows.where("id % 4 = 0")
    space = {"numTrees": ("int", 2, 9), "maxDepth": ("int", 1, 4)}
    best, trials = N.search_forest(train, val, ["x", "z", "w"], ["c"], "y", space, 6, seed=3, adaptive=True)
    settings = [dict(eval(r["params"])) for r in trials.orderBy("trial").collect()]
    need = [max((s["maxDepth"] for s in settings if t < s["numTrees"]), default=0) for t in range(9)]
    assert len(made) == 1 and len(settings) == 6 and made[0].levels_grown <= sum(need)
    walked = sum(s["numTrees"] * s["maxDepth"] for s in settings)
    assert sum(need) < walked
    # the score of a setting is that of its own forest
    for s, r in zip(settings, trials.orderBy("trial").collect()):
        alone = G.fit_forest(train, ["x", "z", "w"], ["c"], "y", 3, **s)
        area = N.roc_auc(M.scored(alone, val, "s"), "s", "y").first()["roc_auc"]
        assert r["score"] == pytest.approx(area)
    assert str(sorted(best.items())) == N.leaderboard(trials, k=1).first()["params"]
    with pytest.raises(ValueError):
        N.search_forest(train, val, ["x"], [], "y", {"numTrees": ("int", 2, 3)}, 1)


def test_tuned_network_job_holds_no_weight_per_row_and_tree(spark, rows, monkeypatch):
    fitted = []
    plain = RandomForestClassifier.fit

    def fit(self, df, params=None):
        fitted.append((df.count(), self.getNumTrees()))
        return plain(self, df, params)

    monkeypatch.setattr(RandomForestClassifier, "fit", fit)
    raw = rows.select(
        (F.col("id") * 60.0).alias("ts"), F.col("id").alias("uid"), F.concat(F.lit("h"), F.col("id") % 30).alias("source_ip"),
        F.col("x").cast("string").alias("duration"), F.col("c").alias("proto"), F.when(F.col("y") == 1, "Bad").otherwise("Benign").alias("label"),
    )
    s = network.NetworkSettings(
        ["duration"], ["proto"], {"duration": -1, "proto": "missing"}, row_id="uid", tuning_rounds=2,
        windows=[network.Rolling("n", "source_ip", 30)], min_level_count=10,
    )
    model, result = network.run(raw, s)
    assert 0.5 < result.first()["roc_auc"] <= 1
    assert 10 <= model.stages[-1].getNumTrees <= 500
    # Spark's learner, which keeps a number for every row and tree, meets no table
    assert all(n <= 4 and trees == 1 for n, trees in fitted)
