"""Parameter search, sweeps, cross-validation and leaderboards.

Trials are fitted one after another or a few at a time from driver threads;
each fit is a distributed job. Only scores come back to the driver.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import portable_hash
from ..session import few_parts, kept, staged
from .evaluate import average_precision, roc_auc
from .forest import Forest, blocks, encoded, scores
from .model import (
    bins_for,
    boosted_classifier,
    feature_stages,
    fit_pipeline,
    forest_classifier,
)
from .parzen import draw, propose
from .trees import first_trees, patient_best, prefix_curve

Space = Mapping[str, tuple]


def _area(df: DataFrame, label: str) -> float:
    # numBins=0 keeps every distinct score instead of thinning the curve
    return BinaryClassificationEvaluator(
        labelCol=label, metricName="areaUnderROC", numBins=0
    ).evaluate(df)


def _precision(df: DataFrame, label: str) -> float:
    scores = df.select(vector_to_array("probability")[1].alias("score"), label)
    return average_precision(scores, "score", label).first()["average_precision"]


METRICS: dict[str, Callable[[DataFrame, str], float]] = {
    "roc_auc": _area,
    "average_precision": _precision,
}

# the same of plain scores
CURVES = {"roc_auc": roc_auc, "average_precision": average_precision}


def search(
    train: DataFrame,
    val: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    label: str,
    space: Space,
    rounds: int,
    learner: Callable = forest_classifier,
    metric: str = "roc_auc",
    seed: int = 200,
    parallelism: int = 2,
    fixed: Mapping | None = None,
    adaptive: bool = False,
    invalid: str = "skip",
) -> tuple[dict, DataFrame]:
    """Search on a validation part, by random draws or adaptive proposals.

    Features are encoded once and kept for all trials. Adaptive trials run in batches of
    ``parallelism``; each batch is proposed from the scores of all earlier ones. Returns
    the best parameters and a table of trials.
    """
    spark = train.sparkSession
    encoder = Pipeline(stages=feature_stages(numeric, categorical, invalid)).fit(train)
    columns = ["features", label]
    fit_rows = kept(encoder.transform(train).select(*columns))
    val_rows = kept(encoder.transform(val).select(*columns))

    def trial(params: dict) -> tuple[float, float]:
        started = time.perf_counter()
        estimator = learner(label, **{**(fixed or {}), **params})
        model = estimator.fit(few_parts(fit_rows), {estimator.maxBins: bins_for(encoder, estimator)})
        return METRICS[metric](model.transform(val_rows), label), time.perf_counter() - started

    try:
        fit_rows.count()  # held before several fits read them at once
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            run = lambda batch: pool.map(trial, batch)
            return _trials(spark, space, rounds, seed, parallelism, adaptive, run)
    finally:
        fit_rows.unpersist()
        val_rows.unpersist()


def _trials(
    spark: SparkSession,
    space: Space,
    rounds: int,
    seed: int,
    parallelism: int,
    adaptive: bool,
    run: Callable[[list[dict]], Iterable[tuple[float, float]]],
) -> tuple[dict, DataFrame]:
    """Best parameters and table of trials; ``run`` gives (score, seconds) of a batch."""
    rng = random.Random(seed)
    settings: list[dict] = []
    results: list[tuple[float, float]] = []
    while len(settings) < rounds:
        left = rounds - len(settings)
        if adaptive:
            scored = [(p, score) for p, (score, _) in zip(settings, results)]
            batch = propose(space, scored, rng, min(max(1, parallelism), left))
        else:
            batch = [draw(space, rng) for _ in range(left)]
        settings += batch
        results += run(batch)
    rows = [
        (i, str(sorted(p.items())), float(score), float(seconds))
        for i, (p, (score, seconds)) in enumerate(zip(settings, results))
    ]
    table = spark.createDataFrame(rows, "trial int, params string, score double, seconds double")
    best = max(rows, key=lambda r: (r[2], -r[0]))[0] if rows else None
    return (settings[best] if best is not None else {}), table


def search_forest(
    train: DataFrame,
    val: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    label: str,
    space: Space,
    rounds: int,
    metric: str = "roc_auc",
    seed: int = 200,
    parallelism: int = 2,
    adaptive: bool = False,
    invalid: str = "skip",
) -> tuple[dict, DataFrame]:
    """``search`` over ``numTrees`` and ``maxDepth`` of random forests, which share their trees.

    Every setting is scored on all rows of ``val`` with the forest of its own size; a tree
    is grown once, for the deepest setting that has it. A trial's seconds hold the growth
    for its batch.
    """
    if set(space) != {"numTrees", "maxDepth"}:
        raise ValueError("forests grow in numTrees and maxDepth only")
    fit = encoded(train, numeric, categorical, label, seed, invalid)
    val_rows = blocks(fit.encoder.transform(val), fit.binning, label)
    forest = Forest(fit.rows, fit.binning, seed)

    def trial(params: dict) -> float:
        trees = forest.cut(params["numTrees"], params["maxDepth"])
        rows = staged(scores(val_rows, trees, fit.binning, label))
        return CURVES[metric](rows, "score", label).first()[metric]

    def run(batch: list[dict]) -> list[tuple[float, float]]:
        started = time.perf_counter()
        forest.grow([(p["numTrees"], p["maxDepth"]) for p in batch])
        found = list(pool.map(trial, batch))
        return [(score, time.perf_counter() - started) for score in found]

    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            return _trials(train.sparkSession, space, rounds, seed, parallelism, adaptive, run)
    finally:
        fit.rows.unpersist()
        val_rows.unpersist()


def sweep(
    train: DataFrame,
    val: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    label: str,
    parameter: str,
    values: Sequence,
    learner: Callable = forest_classifier,
    metric: str = "average_precision",
    fixed: Mapping | None = None,
) -> DataFrame:
    """Score, seconds and number of trees for each value of one parameter."""
    spark = train.sparkSession
    encoder = Pipeline(stages=feature_stages(numeric, categorical)).fit(train)
    extra = [c for c in [(fixed or {}).get("validation")] if c]
    fit_rows = kept(encoder.transform(train).select("features", label, *extra))
    val_rows = kept(encoder.transform(val).select("features", label))
    rows = []
    try:
        for value in values:
            started = time.perf_counter()
            estimator = learner(label, **{**(fixed or {}), parameter: value})
            model = estimator.fit(fit_rows, {estimator.maxBins: bins_for(encoder, estimator)})
            seconds = time.perf_counter() - started
            score = METRICS[metric](model.transform(val_rows), label)
            rows.append((parameter, float(value), float(score), seconds, model.getNumTrees))
    finally:
        fit_rows.unpersist()
        val_rows.unpersist()
    return spark.createDataFrame(
        rows, "param string, value double, score double, seconds double, best_iter int"
    )


def sweep_rounds(
    train: DataFrame,
    val: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    label: str,
    parameter: str,
    values: Sequence,
    rounds: int,
    patience: int = 50,
    learner: Callable = boosted_classifier,
    metric: str = "average_precision",
    invalid: str = "skip",
    fixed: Mapping | None = None,
    parallelism: int = 3,
) -> tuple[DataFrame, DataFrame]:
    """Best iteration of a booster for each value of one parameter, such as ``stepSize``.

    One fit of all rounds for each value, ``parallelism`` of them at a time, as the many
    small jobs of a booster leave most cores idle; the losses of its prefixes on ``val`` come from
    one pass. Returns (param, value, best_iter, stopped_at, loss, score, seconds), the score
    being that of the model cut to its best iteration, and the written curves
    (value, round, n, loss).
    """
    spark = train.sparkSession
    encoder = Pipeline(stages=feature_stages(numeric, categorical, invalid)).fit(train)
    fit_rows = kept(encoder.transform(train).select("features", label))
    val_rows = kept(encoder.transform(val).select("features", label))
    curves = None

    def fit(value):
        started = time.perf_counter()
        estimator = learner(label, **{**(fixed or {}), parameter: value, "maxIter": rounds})
        model = estimator.fit(fit_rows, {estimator.maxBins: bins_for(encoder, estimator)})
        return model, time.perf_counter() - started

    try:
        fit_rows.count()  # held before several fits read them at once
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            fits = list(pool.map(fit, values))
        for value, (model, _) in zip(values, fits):
            curve = prefix_curve(model, val_rows, label).withColumn("value", F.lit(float(value)))
            curves = curve if curves is None else curves.unionByName(curve)
        curves = staged(curves)
        best = {r["value"]: r for r in patient_best(curves, patience, ["value"]).collect()}
        rows = []
        for value, (model, seconds) in zip(values, fits):
            at = best[float(value)]
            cut = first_trees(model, at["best_round"])
            score = METRICS[metric](cut.transform(val_rows), label)
            rows.append(
                (parameter, float(value), at["best_round"], at["stopped_at"], at["loss"], float(score), seconds)
            )
    finally:
        fit_rows.unpersist()
        val_rows.unpersist()
    fields = "param string, value double, best_iter int, stopped_at int, loss double, score double, seconds double"
    return spark.createDataFrame(rows, fields), curves


def cross_validated_auc(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    label: str,
    id_col: str,
    folds: int = 5,
    learner: Callable = boosted_classifier,
    parallelism: int = 2,
    **params,
) -> float:
    """Mean ROC AUC over folds given by a hash of ``id_col``."""
    rows = df.withColumn("__fold", F.pmod(portable_hash(id_col), F.lit(folds)).cast("int"))
    encoder = Pipeline(stages=feature_stages(numeric, categorical)).fit(rows)
    estimator = learner(label, **params)
    estimator.setMaxBins(bins_for(encoder, estimator))
    validator = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=ParamGridBuilder().build(),
        evaluator=BinaryClassificationEvaluator(labelCol=label, numBins=0),
        numFolds=folds,
        foldCol="__fold",
        parallelism=parallelism,
    )
    encoded = kept(encoder.transform(rows).select("features", label, "__fold"))
    try:
        return float(validator.fit(encoded).avgMetrics[0])
    finally:
        encoded.unpersist()


def leaderboard(trials: DataFrame, metric: str = "score", k: int = 10) -> DataFrame:
    """Best trials first, rounded to four digits; ties by trial number."""
    return (
        trials.withColumn(metric, F.round(metric, 4))
        .orderBy(F.desc(metric), "trial")
        .limit(k)
    )


def predictive_power(
    df: DataFrame, x: str, y: str, id_col: str, folds: int = 4, depth: int = 5
) -> DataFrame:
    """How well one feature alone predicts a class, from 0 to 1.

    Cross-fitted single-feature trees give a weighted F1, which is set against
    the weighted F1 of always guessing the most frequent class.
    """
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import StringIndexer, VectorAssembler

    clean = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        F.col(x).alias("x"),
        F.col(y).cast("string").alias("y"),
        F.pmod(portable_hash(id_col), F.lit(folds)).cast("int").alias("fold"),
    )
    prepare = [StringIndexer(inputCol="y", outputCol="label")]
    if dict(clean.dtypes)["x"] == "string":
        prepare.append(StringIndexer(inputCol="x", outputCol="x_num", handleInvalid="keep"))
    else:
        clean = clean.withColumn("x_num", F.col("x").cast("double"))
    prepare.append(VectorAssembler(inputCols=["x_num"], outputCol="features"))
    rows = kept(
        Pipeline(stages=prepare).fit(clean).transform(clean).select("features", "label", "fold")
    )
    counts = None
    for fold in range(folds):
        tree = DecisionTreeClassifier(maxDepth=depth).fit(rows.where(F.col("fold") != fold))
        part = (
            tree.transform(rows.where(F.col("fold") == fold))
            .groupBy("label", "prediction")
            .agg(F.count("*").alias("n"))
        )
        counts = part if counts is None else counts.unionByName(part)
    pairs = counts.groupBy("label", "prediction").agg(F.sum("n").alias("n"))
    model_f1 = _weighted_f1([tuple(r) for r in pairs.collect()])
    sizes = [tuple(r) for r in rows.groupBy("label").count().collect()]
    rows.unpersist()
    # index 0 is the most frequent class
    naive_f1 = _weighted_f1([(label, 0.0, n) for label, n in sizes])
    score = 0.0 if naive_f1 >= 1 else max(0.0, (model_f1 - naive_f1) / (1 - naive_f1))
    return df.sparkSession.createDataFrame(
        [(x, y, round(score, 4), model_f1, naive_f1)],
        "feature string, target string, power double, model_f1 double, naive_f1 double",
    )


def _weighted_f1(confusion: Sequence[tuple[float, float, int]]) -> float:
    """Weighted F1 from (actual, predicted, rows) triples of a few classes."""
    total = sum(n for _, _, n in confusion)
    if not total:
        return 0.0
    out = 0.0
    for label in {a for a, _, _ in confusion}:
        hit = sum(n for a, p, n in confusion if a == label and p == label)
        actual = sum(n for a, _, n in confusion if a == label)
        guessed = sum(n for _, p, n in confusion if p == label)
        out += actual / total * (2 * hit / (actual + guessed))
    return out


def refit(
    train: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    label: str,
    params: Mapping,
    learner: Callable = forest_classifier,
):
    """Pipeline fitted with the best parameters."""
    return fit_pipeline(train, learner(label, **params), numeric, categorical)
