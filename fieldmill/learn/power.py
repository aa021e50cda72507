"""Predictive power of every feature at once, from class counts.

One pass counts the rows of each class in every (feature, fold, bin); the cross-fitted
single-feature trees and their scores follow from these counts alone, one small group per
feature. Nothing that is gathered depends on the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import portable_hash
from ..operators.ordered import quantiles
from .tune import _weighted_f1

FOLDS, BINS, DEPTH = 4, 32, 5


def class_counts(
    df: DataFrame, features: Sequence[str], y: str, id_col: str, folds: int = FOLDS, bins: int = BINS
) -> DataFrame:
    """(feature, fold, bin, class, n) for numeric features.

    Bin k holds the values above exactly k of a feature's distinct inner quantiles, which
    are taken from all rows with a class. Rows without a class are left out, rows without a
    value only for that feature. A fold is a hash of ``id_col``.
    """
    pairs = F.array(
        *(F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features)
    )
    rows = (
        df.where(F.col(y).isNotNull())
        .select(
            F.pmod(portable_hash(id_col), F.lit(folds)).cast("int").alias("fold"),
            F.col(y).cast("string").alias("class"),
            F.explode(pairs).alias("p"),
        )
        .select("fold", "class", "p.*")
        .where("value is not null and not isnan(value)")
    )
    wanted = {f"q{k}": k / bins for k in range(1, bins)}
    edges = quantiles(rows, "value", wanted, ["feature"], mode="discrete").select(
        "feature", F.array_distinct(F.array(*wanted)).alias("edges")
    )
    below = F.size(F.filter("edges", lambda e: e < F.col("value")))
    return (
        rows.join(edges, "feature")
        .groupBy("feature", "fold", below.alias("bin"), "class")
        .agg(F.count("*").alias("n"))
    )


def _gini(counts: np.ndarray) -> np.ndarray:
    """Rows times Gini impurity along the last axis."""
    total = counts.sum(axis=-1)
    return total - (counts**2).sum(axis=-1) / np.maximum(total, 1)


def predicted_bins(counts: np.ndarray, depth: int) -> np.ndarray:
    """Class guessed in every bin by a tree over the (bin, class) counts.

    Each level cuts a range of bins where the impurity falls most, the lowest such cut if
    there are several; a leaf guesses its most frequent class, the first of equals.
    """
    out = np.zeros(len(counts), np.int64)
    todo = [(0, len(counts), depth)]
    while todo:
        low, high, left = todo.pop()
        part = counts[low:high].astype(np.float64)
        out[low:high] = part.sum(axis=0).argmax()
        if left == 0 or high - low < 2:
            continue
        upto = part.cumsum(axis=0)[:-1]
        above = part.sum(axis=0) - upto
        fall = _gini(part.sum(axis=0)) - _gini(upto) - _gini(above)
        cut = int(np.flatnonzero(fall >= fall.max() - 1e-9)[0])
        if fall[cut] > 1e-9:
            todo += [(low, low + cut + 1, left - 1), (low + cut + 1, high, left - 1)]
    return out


def power_of(counts: np.ndarray, depth: int) -> tuple[float, float]:
    """Weighted F1 of the cross-fitted trees and of always guessing the most frequent class.

    ``counts`` by (fold, bin, class); a fold is guessed by the tree of the other folds.
    """
    kinds = counts.shape[2]
    met = np.zeros((kinds, kinds), np.int64)  # class, guess
    for fold in range(len(counts)):
        guesses = predicted_bins(counts.sum(axis=0) - counts[fold], depth)
        for guess in range(kinds):
            met[:, guess] += counts[fold][guesses == guess].sum(axis=0)
    sizes = counts.sum(axis=(0, 1))
    model = _weighted_f1([(a, g, int(met[a, g])) for a in range(kinds) for g in range(kinds)])
    top = int(sizes.argmax())
    return model, _weighted_f1([(a, top, int(n)) for a, n in enumerate(sizes)])


def predictive_powers(
    df: DataFrame,
    features: Sequence[str],
    y: str,
    id_col: str,
    folds: int = FOLDS,
    bins: int = BINS,
    depth: int = DEPTH,
) -> DataFrame:
    """(feature, target, rows, power, model_f1, naive_f1) of every numeric feature.

    ``power`` is the share of the way from the naive F1 to 1 that the feature alone goes,
    0 if it goes backwards. A feature without a value has no row.
    """

    def powers(group: pd.DataFrame) -> pd.DataFrame:
        kinds, code = np.unique(group["class"].to_numpy(str), return_inverse=True)
        counts = np.zeros((folds, int(group["bin"].max()) + 1, len(kinds)), np.int64)
        np.add.at(counts, (group["fold"].to_numpy(), group["bin"].to_numpy(), code), group["n"].to_numpy())
        model, naive = power_of(counts, depth)
        power = 0.0 if naive >= 1 else max(0.0, (model - naive) / (1 - naive))
        return pd.DataFrame(
            [(group["feature"].iloc[0], y, int(counts.sum()), power, model, naive)],
            columns=["feature", "target", "rows", "power", "model_f1", "naive_f1"],
        )

    counts = class_counts(df, features, y, id_col, folds, bins)
    return counts.groupBy("feature").applyInPandas(
        powers, "feature string, target string, rows long, power double, model_f1 double, naive_f1 double"
    )
