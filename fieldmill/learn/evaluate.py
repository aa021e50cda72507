"""Exact ranking, threshold and regression metrics.

Curves are computed on one row per distinct score, with cumulative positives
and negatives from range-partitioned running totals, so neither the number of
rows nor the number of distinct scores has to fit into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import running_totals


def score_curve(
    df: DataFrame, score: str, label: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Positives and negatives per distinct score, highest first, with totals."""
    y = F.col(label).cast("int")
    return running_totals(
        df.where(F.col(score).isNotNull() & y.isNotNull()),
        keys,
        score,
        {"pos": F.sum(y), "neg": F.sum(1 - y)},
        descending=True,
    )


def _auc(curve: DataFrame, keys: Sequence[str]) -> DataFrame:
    # ties count half: pairs won within a score, plus pairs won against lower ones
    below = F.col("neg_all") - F.col("neg_upto")
    won = F.sum(F.col("pos") * (below + F.col("neg") / 2.0))
    pairs = F.max(F.col("pos_all").cast("double") * F.col("neg_all"))
    return curve.groupBy(*keys).agg(F.try_divide(won, pairs).alias("roc_auc"))


def _average_precision(curve: DataFrame, keys: Sequence[str]) -> DataFrame:
    precision = F.col("pos_upto") / (F.col("pos_upto") + F.col("neg_upto"))
    return curve.groupBy(*keys).agg(
        F.try_divide(F.sum(F.col("pos") * precision), F.max("pos_all")).alias(
            "average_precision"
        )
    )


def roc_auc(df: DataFrame, score: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    return _auc(score_curve(df, score, label, keys), keys)


def average_precision(
    df: DataFrame, score: str, label: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Step sum of precision over recall gains."""
    return _average_precision(score_curve(df, score, label, keys), keys)


def pr_auc(df: DataFrame, score: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """Trapezoid area under precision and recall.

    The curve starts at recall 0 with the precision of the highest score. The
    precision before a point follows from its own running totals, so no row has
    to look at its neighbour.
    """
    curve = score_curve(df, score, label, keys)
    tp, fp = F.col("pos_upto"), F.col("neg_upto")
    here = tp / (tp + fp)
    seen = tp - F.col("pos") + fp - F.col("neg")
    before = F.when(seen > 0, (tp - F.col("pos")) / seen).otherwise(here)
    area = F.sum(F.col("pos") * (here + before) / 2.0)
    return curve.groupBy(*keys).agg(
        F.try_divide(area, F.max("pos_all")).alias("pr_auc")
    )


def ranking_metrics(
    df: DataFrame, score: str, label: str, keys: Sequence[str] = ()
) -> DataFrame:
    """ROC AUC and average precision per group from one curve."""
    curve = score_curve(df, score, label, keys)
    below = F.col("neg_all") - F.col("neg_upto")
    precision = F.col("pos_upto") / (F.col("pos_upto") + F.col("neg_upto"))
    return curve.groupBy(*keys).agg(
        F.try_divide(
            F.sum(F.col("pos") * (below + F.col("neg") / 2.0)),
            F.max(F.col("pos_all").cast("double") * F.col("neg_all")),
        ).alias("roc_auc"),
        F.try_divide(F.sum(F.col("pos") * precision), F.max("pos_all")).alias(
            "average_precision"
        ),
    )


def rmse(df: DataFrame, actual: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    error = F.col(actual) - F.col(predicted)
    return df.groupBy(*keys).agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def threshold_table(
    df: DataFrame, score: str, label: str, steps: int = 100
) -> DataFrame:
    """Precision, recall, F1 and alert rate at thresholds 0, 1/steps, ..., 1.

    A row is flagged when its score is at least the threshold. Rows are first
    counted per grid cell, so everything after that has ``steps + 2`` rows.
    """
    p = F.col(score)
    width = F.lit(1.0 / steps)
    guess = F.floor(p * steps)
    # product and grid value may differ in the last bit: settle by comparison
    cell = (
        F.when(p < guess * width, guess - 1)
        .when(p >= (guess + 1) * width, guess + 1)
        .otherwise(guess)
    )
    y = F.col(label).cast("int")
    cells = (
        df.where(p.isNotNull() & y.isNotNull())
        .select(F.least(F.greatest(cell, F.lit(-1)), F.lit(steps)).alias("step"), y.alias("y"))
        .groupBy("step")
        .agg(F.sum("y").alias("pos"), F.count("*").alias("n"))
    )
    grid = df.sparkSession.range(-1, steps + 1).select(
        F.col("id").alias("step"), F.lit(0).alias("pos"), F.lit(0).alias("n")
    )
    counted = cells.unionByName(grid).groupBy("step").agg(
        F.sum("pos").alias("pos"), F.sum("n").alias("n")
    )
    above = Window.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy()
    flagged, hits = F.sum("n").over(above), F.sum("pos").over(above)
    totals = counted.select(
        "step",
        flagged.alias("flagged"),
        hits.alias("hits"),
        F.sum("n").over(everything).alias("rows"),
        F.sum("pos").over(everything).alias("positives"),
    ).where("step >= 0")

    def share(a: Column, b: Column):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    return totals.select(
        (F.col("step") * width).alias("threshold"),
        share(F.col("hits"), F.col("flagged")).alias("precision"),
        share(F.col("hits"), F.col("positives")).alias("recall"),
        share(2 * F.col("hits"), F.col("flagged") + F.col("positives")).alias("f1"),
        share(F.col("flagged"), F.col("rows")).alias("alert_rate"),
    )


def long_thresholds(table: DataFrame) -> DataFrame:
    """Threshold table as (threshold, metric, score) rows."""
    named = table.select(
        "threshold",
        F.col("f1").alias("F1"),
        F.col("recall").alias("Recall"),
        F.col("precision").alias("Precision"),
        F.col("alert_rate").alias("Alert rate"),
    )
    return named.unpivot(
        ["threshold"], ["F1", "Recall", "Precision", "Alert rate"], "metric", "score"
    )


def best_threshold(table: DataFrame) -> DataFrame:
    """Threshold with the largest F1, the lowest one on ties."""
    return table.orderBy(F.desc("f1"), "threshold").limit(1)


def rule_f1(
    train: DataFrame, test: DataFrame, column: str, label: str
) -> DataFrame:
    """F1 on ``test`` of the rule ``column <= v``, for each distinct v in ``train``."""
    y = F.col(label).cast("int")
    candidates = train.where(F.col(column).isNotNull()).select(
        column, F.lit(1).alias("is_candidate"), F.lit(0).alias("y"), F.lit(0).alias("n")
    )
    rows = test.where(y.isNotNull()).select(
        column, F.lit(0).alias("is_candidate"), y.alias("y"), F.lit(1).alias("n")
    )
    # a null never satisfies the rule but its label still counts as a positive
    both = candidates.unionByName(rows).withColumn("is_null", F.col(column).isNull())
    positives = rows.agg(F.coalesce(F.sum("y"), F.lit(0))).scalar()
    along = running_totals(
        both.where("not is_null"),
        [],
        column,
        {"hits": F.sum("y"), "flagged": F.sum("n"), "wanted": F.max("is_candidate")},
    )
    return along.where("wanted = 1").select(
        F.col(column).alias("threshold"),
        F.coalesce(
            F.try_divide(2 * F.col("hits_upto"), F.col("flagged_upto") + positives),
            F.lit(0.0),
        ).alias("f1"),
    )


def false_positives(df: DataFrame, score: str, label: str, threshold: float) -> DataFrame:
    return df.where((F.col(label).cast("int") == 0) & (F.col(score) >= threshold))


def false_negatives(df: DataFrame, score: str, label: str, threshold: float) -> DataFrame:
    return df.where((F.col(label).cast("int") == 1) & (F.col(score) < threshold))
