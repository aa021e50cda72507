"""Fitted trees as tables: prefixes of a booster, patient stopping, structural importances.

A model has a bounded number of nodes; rows are only read inside tasks. Scores of every
prefix of a booster come from one fit: each row's weighted tree outputs are summed up
round by round, and every task returns one partial sum of the loss for each round.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import kept, scratch_path, staged
from .model import FEATURES, _columns_of, bins_for, feature_stages

LEAF = -1


def node_table(model, spark: SparkSession) -> DataFrame:
    """One row per node of a tree, forest or booster, read from its saved form.

    (tree, weight, node, left, right, feature, cut, levels, n_rows, gain, prediction);
    leaves have feature LEAF. ``cut`` holds the threshold, or, with ``levels`` >= 0, the
    category codes that go left.
    """
    path = scratch_path(spark, "trees")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    if "treeID" in nodes.columns:
        weights = spark.read.parquet(f"{path}/treesMetadata").toDF("treeID", "_", "weight").drop("_")
        nodes = nodes.join(weights, "treeID").select("treeID", "weight", "nodeData.*")
    else:
        nodes = nodes.selectExpr("0 AS treeID", "1.0D AS weight", "*")
    return nodes.select(
        F.col("treeID").alias("tree"),
        "weight",
        F.col("id").alias("node"),
        F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"),
        F.when(F.col("leftChild") < 0, LEAF).otherwise(F.col("split.featureIndex")).alias("feature"),
        F.col("split.leftCategoriesOrThreshold").alias("cut"),
        F.col("split.numCategories").alias("levels"),
        F.col("rawCount").alias("n_rows"),
        "gain",
        "prediction",
    )


def with_depth(nodes: DataFrame) -> DataFrame:
    """``nodes`` with their depth, walked down level by level; roots have 0."""
    nodes = staged(nodes)
    level = nodes.where("node = 0").withColumn("depth", F.lit(0))
    out = level
    while True:
        children = staged(
            level.where(F.col("feature") != LEAF).select(
                "tree", F.explode(F.array("left", "right")).alias("node"), (F.col("depth") + 1).alias("depth")
            )
        )
        if children.isEmpty():
            return out
        level = nodes.join(children, ["tree", "node"]).select(out.columns)
        out = out.unionByName(level)


def importance_table(nodes: DataFrame, names: Sequence[str]) -> DataFrame:
    """How often and how high in the trees each feature decides.

    (feature, as_root, uses, mean_least_depth, total_gain) from a table ``with_depth``:
    trees with the feature at the root; splits on it; depth of its first split, in a tree
    without one the depth of the tree, averaged over the trees; gain times rows over its
    splits. Unused features have a row as well.
    """
    columns = F.create_map(*(x for k, n in enumerate(names) for x in (F.lit(k), F.lit(n))))
    trees = nodes.groupBy("tree").agg(F.max("depth").alias("tree_depth"))
    splits = (
        nodes.where(F.col("feature") != LEAF)
        .groupBy("tree", "feature")
        .agg(
            F.min("depth").alias("least"),
            F.count(F.lit(1)).alias("uses"),
            F.sum(F.col("gain") * F.col("n_rows")).alias("gain"),
        )
    )
    every = trees.withColumn("feature", F.explode(F.sequence(F.lit(0), F.lit(len(names) - 1))))
    return (
        every.join(splits, ["tree", "feature"], "left")
        .groupBy("feature")
        .agg(
            F.sum((F.col("least") == 0).cast("long")).alias("roots"),
            F.sum("uses").alias("uses"),
            F.avg(F.coalesce("least", "tree_depth")).alias("mean_least_depth"),
            F.sum("gain").alias("total_gain"),
        )
        .select(
            columns[F.col("feature")].alias("feature"),
            F.coalesce("roots", F.lit(0)).alias("as_root"),
            F.coalesce("uses", F.lit(0)).alias("uses"),
            "mean_least_depth",
            F.coalesce("total_gain", F.lit(0.0)).alias("total_gain"),
        )
    )


def structural_importances(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """``importance_table`` of the trees at the end of a fitted pipeline."""
    names = model.stages[-2].getInputCols()
    return importance_table(with_depth(node_table(model.stages[-1], spark)), names)


@dataclass
class Walk:
    """Nodes of all trees in arrays, one tree after the other."""

    roots: np.ndarray
    weights: np.ndarray
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    goes_left: np.ndarray  # (node, category code); empty rows for thresholds
    by_level: np.ndarray
    prediction: np.ndarray

    def outputs(self, rows: np.ndarray) -> np.ndarray:
        """Weighted output of every tree for every row of feature values."""
        out = np.empty((len(rows), len(self.roots)))
        index = np.arange(len(rows))
        for t, root in enumerate(self.roots):
            at = np.full(len(rows), root)
            while True:
                inner = self.feature[at] != LEAF
                if not inner.any():
                    break
                here = at[inner]
                value = rows[index[inner], self.feature[here]]
                code = np.clip(value, 0, self.goes_left.shape[1] - 1).astype(np.int64)
                go = np.where(
                    self.by_level[here], self.goes_left[here, code], value <= self.threshold[here]
                )
                at[inner] = np.where(go, self.left[here], self.right[here])
            out[:, t] = self.weights[t] * self.prediction[at]
        return out


def walk_of(model, spark: SparkSession) -> Walk:
    """Arrays of a fitted model; its size follows from its trees, not from any table."""
    nodes = node_table(model, spark).toPandas().sort_values(["tree", "node"])
    first = nodes.groupby("tree")["node"].size().cumsum().shift(fill_value=0)
    base = nodes["tree"].map(first).to_numpy()
    by_level = (nodes["levels"] >= 0).to_numpy()
    width = max(int(nodes["levels"].max()), 1)
    goes_left = np.zeros((len(nodes), width), bool)
    threshold = np.zeros(len(nodes))
    for k, (cut, level) in enumerate(zip(nodes["cut"], by_level)):
        if level:
            goes_left[k, np.asarray(cut, np.int64)] = True
        elif len(cut):
            threshold[k] = cut[0]
    return Walk(
        roots=first.to_numpy(),
        weights=nodes.groupby("tree")["weight"].first().to_numpy(),
        left=nodes["left"].to_numpy() + base,
        right=nodes["right"].to_numpy() + base,
        feature=nodes["feature"].to_numpy(),
        threshold=threshold,
        goes_left=goes_left,
        by_level=by_level,
        prediction=nodes["prediction"].to_numpy(),
    )


def prefix_curve(model, encoded: DataFrame, label: str) -> DataFrame:
    """(round, n, loss): mean loss on ``encoded`` of the first ``round`` trees of a booster.

    The losses are those that the learners minimise: log loss of the doubled margin for
    classes, squared error for numbers. Rows without a label are left out.
    """
    spark = encoded.sparkSession
    walk, is_class = walk_of(model, spark), isinstance(model, GBTClassificationModel)
    rounds = len(walk.roots)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(rounds), 0
        for batch in batches:
            margins = walk.outputs(np.stack(batch["x"].to_numpy())).cumsum(axis=1)
            y = batch["y"].to_numpy()[:, None]
            if is_class:
                total += (2.0 * np.logaddexp(0.0, -2.0 * (2.0 * y - 1.0) * margins)).sum(axis=0)
            else:
                total += ((y - margins) ** 2).sum(axis=0)
            n += len(batch)
        if n:
            yield pd.DataFrame({"round": np.arange(1, rounds + 1), "n": n, "loss": total})

    rows = encoded.where(F.col(label).isNotNull()).select(
        vector_to_array(FEATURES).alias("x"), F.col(label).cast("double").alias("y")
    )
    return (
        rows.mapInPandas(sums, "round int, n long, loss double")
        .groupBy("round")
        .agg(F.sum("n").alias("n"), F.sum("loss").alias("loss"))
        .withColumn("loss", F.col("loss") / F.col("n"))
    )


def patient_best(
    curve: DataFrame, patience: int, keys: Sequence[str] = (), least_gain: float = 0.0
) -> DataFrame:
    """(keys, best_round, loss, stopped_at) of each curve under a patience rule.

    A round is a new best if its loss is lower by more than ``least_gain`` than the best so
    far; training ends at the first round that lies ``patience`` rounds behind the best, or
    at the last round. A curve is gathered in one row: it has as many rounds as a model.
    """

    def step(state, at):
        better = (state.best_round == 0) | (at.loss < state.loss - F.lit(least_gain))
        best = F.when(better, at.round).otherwise(state.best_round)
        now = F.struct(
            best.alias("best_round"),
            F.when(better, at.loss).otherwise(state.loss).alias("loss"),
            at.round.alias("stopped_at"),
            (at.round - best >= patience).alias("ended"),
        )
        return F.when(state.ended, state).otherwise(now)

    start = F.struct(
        F.lit(0).alias("best_round"),
        F.lit(float("inf")).alias("loss"),
        F.lit(0).alias("stopped_at"),
        F.lit(False).alias("ended"),
    )
    rounds = F.array_sort(F.collect_list(F.struct("round", "loss")))
    walked = curve.groupBy(*keys).agg(rounds.alias("rounds")).where(F.size("rounds") > 0)
    end = walked.withColumn("end", F.reduce("rounds", start, step))
    return end.select(*keys, "end.best_round", "end.loss", "end.stopped_at")


def first_trees(model, rounds: int):
    """The booster that the first ``rounds`` rounds of ``model`` are."""
    own, context = model._java_obj, model._java_obj.getClass().getName()
    if not 0 < rounds <= model.getNumTrees:
        raise ValueError(f"{rounds} of {model.getNumTrees} rounds")
    spark = SparkSession.active()
    gateway, jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(jvm.double, rounds)
    for k in range(rounds):
        trees[k], weights[k] = own.trees()[k], float(model.treeWeights[k])
    if isinstance(model, GBTClassificationModel):
        kind, size = GBTClassificationModel, (model.numFeatures, model.numClasses)
    elif isinstance(model, GBTRegressionModel):
        kind, size = GBTRegressionModel, (model.numFeatures,)
    else:
        raise TypeError(f"{context} is not a booster")
    made = getattr(jvm, context)(f"{model.uid}_{rounds}", trees, weights, *size)
    cut = kind(made)
    for param in model.params:
        if model.isSet(param):
            cut._paramMap[cut.getParam(param.name)] = model.getOrDefault(param)
    cut._transfer_params_to_java()
    return cut


def fit_patient(
    train: DataFrame,
    val: DataFrame,
    learner,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    patience: int = 50,
    invalid: str = "skip",
) -> tuple[PipelineModel, DataFrame]:
    """Booster pipeline cut back to its best round on ``val``, and the written curve.

    Spark's own stopping rule ends at the first round with a small gain. Here all rounds
    of the learner are fitted, the losses of all prefixes come from one pass over ``val``,
    and the rounds behind the best one, as found by ``patient_best``, are cut off.
    """
    from pyspark.ml import Pipeline

    encoder = Pipeline(stages=feature_stages(numeric, categorical, invalid)).fit(train)
    encoded = kept(encoder.transform(train).select(*_columns_of(learner)))
    try:
        fitted = learner.fit(encoded, {learner.maxBins: bins_for(encoder, learner)})
    finally:
        encoded.unpersist()
    curve = staged(prefix_curve(fitted, encoder.transform(val), learner.getLabelCol()))
    best = patient_best(curve, patience).first()
    if best is None:
        raise ValueError("no labelled validation rows")
    return PipelineModel(stages=[*encoder.stages, first_trees(fitted, best["best_round"])]), curve
