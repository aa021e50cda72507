"""Fraud-table job: null policy, time split, boosted trees and test metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..learn.evaluate import ranking_metrics
from ..learn.model import boosted_classifier, fit_pipeline, scored
from ..learn.tune import search
from ..operators.clean import NullPolicy, zero_variance_columns
from ..operators.split import parts, time_split
from ..session import scratch_path
from ..sources.writers import write_columnar


@dataclass
class FraudSettings:
    numerical_features: Sequence[str]
    categorical_features: Sequence[str]
    label: str = "fraud_bool"
    time_column: str = "month"
    missing_thr: float = 0.95
    test_size: float = 0.2
    val_size: float = 0.2
    booster: Mapping[str, object] = field(
        default_factory=lambda: {"maxIter": 20, "maxDepth": 4}
    )
    tuning_rounds: int = 0
    trial_trees: int = 20


def prepared(raw: DataFrame, s: FraudSettings) -> DataFrame:
    """Imputed rows without static columns, with a ``split`` column."""
    df = NullPolicy(s.missing_thr).fit(raw).transform(raw)
    protected = {s.label, s.time_column}
    df = df.drop(*(c for c in zero_variance_columns(df) if c not in protected))
    return time_split(df, s.time_column, s.test_size, s.val_size)


def run(raw: DataFrame, s: FraudSettings) -> tuple[PipelineModel, DataFrame]:
    """Search on the validation part, fit with early stopping there; metrics on the test part.

    Trials of the search have ``trial_trees`` trees; the settings found replace those of
    ``booster`` for the final fit.
    """
    table = write_columnar(
        prepared(raw, s), scratch_path(raw.sparkSession, "fraud"), partition_by=["split"]
    )
    numeric = [c for c in s.numerical_features if c in table.columns]
    categorical = [c for c in s.categorical_features if c in table.columns]
    learning = table.where(F.col("split") != "test").withColumn(
        "is_val", F.col("split") == "val"
    )
    params = dict(s.booster)
    if s.tuning_rounds:
        train, val = parts(table, "train", "val")
        space = {"maxDepth": ("int", 2, 6), "stepSize": ("log", 0.03, 0.5)}
        best, _ = search(
            train, val, numeric, categorical, s.label, space, s.tuning_rounds, boosted_classifier,
            "average_precision", adaptive=True, invalid="keep", fixed={"maxIter": s.trial_trees},
        )
        params |= best
    learner = boosted_classifier(s.label, "is_val", **params)
    model = fit_pipeline(learning, learner, numeric, categorical, invalid="keep")
    test = scored(model, table.where("split = 'test'"), "score")
    return model, ranking_metrics(test, "score", s.label)
