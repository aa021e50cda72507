"""API-behaviour job: call-graph features, a rule baseline and boosted trees."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import is_true, portable_hash
from ..learn.evaluate import (
    best_threshold,
    false_negatives,
    false_positives,
    rule_f1,
    threshold_table,
)
from ..learn.model import boosted_classifier, fit_pipeline, scored
from ..operators.graph import DEGREES, degree_features, degrees, graph_features
from ..operators.split import hash_split, parts
from ..session import scratch_path
from ..sources.writers import write_columnar


@dataclass
class BehaviourReport:
    model: PipelineModel
    thresholds: DataFrame
    best: DataFrame
    rule: DataFrame
    false_positives: DataFrame
    false_negatives: DataFrame


def cleaned_calls(calls: DataFrame, required: str, label: str = "classification") -> DataFrame:
    """Rows with the required measure; the class as a boolean."""
    return calls.where(F.col(f"`{required}`").isNotNull()).withColumn(
        "is_anomaly", is_true(F.col(label) == "outlier")
    )


def feature_table(calls: DataFrame, edges: DataFrame, features: Sequence[str] = DEGREES) -> DataFrame:
    """Behaviour rows joined with the features of their call graph."""
    if set(features) <= set(edges.columns):
        return calls.join(graph_features(edges, features), "_id")
    if tuple(features) == DEGREES:
        return calls.join(degree_features(edges), "_id")
    return calls.join(graph_features(edges, features, featured=degrees(edges)), "_id")


def run(
    table: DataFrame, numeric: Sequence[str], threshold: float, id_col: str = "_id",
    rule_column: str = "n_connections", **booster,
) -> BehaviourReport:
    """Fit on 80 % of the ids, judge on the rest at every threshold.

    A fifth of the ids to fit on stops the training early; fewer than two parts, and all
    rounds are fitted.
    """
    stored = write_columnar(
        hash_split(table, id_col, 0.2).withColumn("label", F.col("is_anomaly").cast("int")),
        scratch_path(table.sparkSession, "behaviour"),
    )
    train, test = parts(stored, "train", "test")
    drawn = F.pmod(portable_hash(id_col, "val:"), F.lit(5)) == 0
    learning = train.withColumn("is_val", F.coalesce(drawn, F.lit(False)))
    both = learning.select("is_val").distinct().count() == 2
    learner = boosted_classifier("label", "is_val" if both else None, **booster)
    model = fit_pipeline(learning, learner, numeric)
    judged = write_columnar(
        scored(model, test, "score"), scratch_path(table.sparkSession, "judged")
    )
    thresholds = threshold_table(judged, "score", "label")
    return BehaviourReport(
        model,
        thresholds,
        best_threshold(thresholds),
        rule_f1(train, test, rule_column, "label"),
        false_positives(judged, "score", "label", threshold),
        false_negatives(judged, "score", "label", threshold),
    )
