"""Labelled rows and calibration, shared by the two text classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labels_of(labels: DataFrame, column: str, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, label) with one row per id; a repeated id is 1 only if every row says so."""
    own = labels.select(F.col(doc_id).alias("doc_id"), F.col(column).cast("int").alias("label"))
    return own.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.min("label").alias("label"))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def log_loss(logits: np.ndarray, target: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - target * logits))
