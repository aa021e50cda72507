"""Network-log job: from raw connection logs to a saved forest pipeline."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import from_epoch
from ..functions.numbers import casts, flag
from ..learn.evaluate import roc_auc
from ..learn.forest import fit_forest
from ..learn.model import fit_pipeline, forest_classifier, save_pipeline, scored
from ..learn.tune import search_forest
from ..operators.clean import LevelFilter, filled, sentinel_to_null, without_static
from ..operators.rolling import Rolling, add_rolling
from ..operators.split import entity_split, parts, random_parts
from ..session import scratch_path
from ..sources.writers import write_columnar

# Header names of the log format and their new names.
RENAMED = {
    "id.orig_h": "source_ip",
    "id.orig_p": "source_port",
    "id.resp_h": "dest_ip",
    "id.resp_p": "dest_port",
}


@dataclass
class NetworkSettings:
    numerical_features: Sequence[str]
    categorical_features: Sequence[str]
    na_fill_vals: Mapping[str, object]
    windows: Sequence[Rolling | Mapping] = ()
    filepaths: Sequence[str] = ()
    model_output_path: str | None = None
    row_id: str | None = None
    random_split: bool = False
    tuning_rounds: int = 0
    min_level_count: int = 100
    benign_label: str = "Benign"
    seed: int = 200
    forest: Mapping[str, object] = field(
        default_factory=lambda: {"numTrees": 10, "maxDepth": 4}
    )

    def rolling(self) -> list[Rolling]:
        return [w if isinstance(w, Rolling) else Rolling(**w) for w in self.windows]


def cleaned_log(raw: DataFrame, s: NetworkSettings) -> DataFrame:
    """Label, timestamp, names, types and fills, in one projection."""
    df = sentinel_to_null(raw.withColumnsRenamed(RENAMED)).withColumns(
        {
            "is_bad": flag(F.col("label") != s.benign_label),
            "dt": from_epoch("ts"),
            **casts(s.numerical_features),
        }
    )
    return filled(df, s.na_fill_vals, [*s.numerical_features, *s.categorical_features])


def feature_table(raw: DataFrame, s: NetworkSettings) -> tuple[DataFrame, list[str], list[str]]:
    """Cleaned rows with look-back features; also the names of the inputs left."""
    df = cleaned_log(raw, s)
    df, kept = without_static(df, [*s.numerical_features, *s.categorical_features])
    numeric = [c for c in s.numerical_features if c in kept]
    categorical = [c for c in s.categorical_features if c in kept]
    if categorical:
        df = LevelFilter(categorical, min_count=s.min_level_count).fit(df).transform(df)
    specs = s.rolling()
    df = add_rolling(df, specs, "dt", s.row_id)
    # No earlier traffic in the window: averages and sums take the same fill as
    # other missing numbers, so that no row is lost in assembly.
    open_ended = [w.name for w in specs if w.operation != "count"]
    df = df.fillna(-999999, open_ended) if open_ended else df
    return df, [*numeric, *(w.name for w in specs)], categorical


def run(raw: DataFrame, s: NetworkSettings) -> tuple[PipelineModel, DataFrame]:
    """Fit and score. Returns the pipeline and the test ROC AUC as a table.

    The feature table is written once and read back: split, search, fit and
    scoring all start from it.
    """
    features, numeric, categorical = feature_table(raw, s)
    table = write_columnar(features, scratch_path(raw.sparkSession, "network"))
    if s.random_split:
        train, test = random_parts(table, 0.2, seed=s.seed)
    else:
        train, test = parts(entity_split(table, "source_ip", "is_bad"), "train", "test")
    if s.tuning_rounds:
        fit_part, val_part = random_parts(train, 0.2, seed=s.seed)
        space = {"numTrees": ("int", 10, 500), "maxDepth": ("int", 2, 10)}
        params, _ = search_forest(
            fit_part, val_part, numeric, categorical, "is_bad", space, s.tuning_rounds,
            seed=s.seed, adaptive=True,
        )
        model = fit_forest(train, numeric, categorical, "is_bad", s.seed, **params)
    else:
        learner = forest_classifier("is_bad", s.seed, **s.forest)
        model = fit_pipeline(train, learner, numeric, categorical)
    result = roc_auc(scored(model, test, "score"), "score", "is_bad")
    if s.model_output_path:
        save_pipeline(model, s.model_output_path)
    return model, result
