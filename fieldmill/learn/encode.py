"""Encoders fitted on training rows and applied to any rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordered import alphabetical_codes
from ..operators.profile import long_form
from ..session import staged

# Map lookups in a plan are linear, so only small tables become literals.

LEVELS = T.StructType(
    [
        T.StructField("variable", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("woe", T.DoubleType()),
    ]
)


def evidence_table(
    df: DataFrame, columns: Sequence[str], label: str, regularization: float = 1.0
) -> DataFrame:
    """Weight of evidence of every level of all columns.

    ``ln(((p + r) / (P + 2r)) / ((n + r) / (N + 2r)))`` with p and n the
    positives and negatives of a level and P and N those of the table. A level
    seen once gets 0. Null is a level of its own.
    """
    r = regularization
    y = F.col(label).cast("int")
    stacked = long_form(
        df.where(y.isNotNull()).select(
            y.alias("__y"), *(F.col(c).cast("string").alias(c) for c in columns)
        ),
        columns,
        ids=["__y"],
    )
    levels = stacked.groupBy("variable", "value").agg(
        F.sum("__y").alias("p"), F.count("*").alias("n")
    )
    labelled = df.where(y.isNotNull())
    positives = labelled.agg(F.sum(y)).scalar()
    rows = labelled.agg(F.count("*")).scalar()
    good = (F.col("p") + r) / (positives + 2 * r)
    bad = (F.col("n") - F.col("p") + r) / (rows - positives + 2 * r)
    woe = F.when(F.col("n") == 1, 0.0).otherwise(F.ln(good / bad))
    return levels.select("variable", "value", woe.alias("woe"))


class WoeEncoder(Estimator):
    """Weight-of-evidence encoding of categorical columns.

    Columns whose encoded training values do not vary are dropped when
    ``drop_invariant`` is set.
    """

    def __init__(
        self,
        columns: Sequence[str],
        label: str,
        regularization: float = 1.0,
        drop_invariant: bool = True,
    ):
        super().__init__()
        self.columns, self.label = list(columns), label
        self.regularization, self.drop_invariant = regularization, drop_invariant

    def _fit(self, dataset: DataFrame) -> WoeModel:
        levels = staged(
            evidence_table(dataset, self.columns, self.label, self.regularization)
        )
        invariant: list[str] = []
        if self.drop_invariant:
            spread = levels.groupBy("variable").agg(
                F.min("woe").alias("lo"), F.max("woe").alias("hi")
            )
            invariant = [r["variable"] for r in spread.where("lo = hi").collect()]
        return WoeModel(levels, self.columns, invariant)


class WoeModel(Model):
    """Applies an evidence table; levels not seen in training become 0."""

    def __init__(self, levels: DataFrame, columns: Sequence[str], invariant: Sequence[str]):
        super().__init__()
        self.levels, self.columns, self.invariant = levels, list(columns), list(invariant)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        varying = [c for c in self.columns if c not in self.invariant]
        out = dataset
        for c in varying:
            known = self.levels.where(F.col("variable") == c).select(
                F.struct("value").alias("__level"), F.col("woe").alias("__woe")
            )
            out = (
                out.withColumn("__level", F.struct(F.col(c).cast("string").alias("value")))
                .join(known, "__level", "left")
                .withColumn(c, F.coalesce("__woe", F.lit(0.0)))
                .drop("__level", "__woe")
            )
        return out.select(*(c for c in dataset.columns if c not in self.invariant))

    def save_to(self, path: str) -> None:
        """Write levels and column roles as one parquet table each."""
        self.levels.write.mode("overwrite").parquet(f"{path}/levels")
        roles = [(i, c, c in self.invariant) for i, c in enumerate(self.columns)]
        self.levels.sparkSession.createDataFrame(
            roles, "place int, variable string, invariant boolean"
        ).write.mode("overwrite").parquet(f"{path}/columns")

    @staticmethod
    def load_from(spark: SparkSession, path: str) -> WoeModel:
        roles = spark.read.parquet(f"{path}/columns").orderBy("place").collect()
        return WoeModel(
            spark.read.schema(LEVELS).parquet(f"{path}/levels"),
            [r["variable"] for r in roles],
            [r["variable"] for r in roles if r["invariant"]],
        )


def with_ordinal_codes(df: DataFrame, column: str, name: str, train: DataFrame | None = None) -> DataFrame:
    """Codes 0, 1, ... of levels in alphabetical order; unseen levels get null."""
    codes = alphabetical_codes(train if train is not None else df, column).select(
        F.col(column).alias("__level"), F.col("code").alias(name)
    )
    return df.join(codes, df[column] == codes["__level"], "left").drop("__level")


def ordinal_indexer(columns: Sequence[str], suffix: str = "_code") -> StringIndexer:
    """The same as a pipeline stage, for levels that fit into a fitted model."""
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[c + suffix for c in columns],
        stringOrderType="alphabetAsc",
        handleInvalid="keep",
    )


def standardised(
    df: DataFrame, columns: Sequence[str], train: DataFrame | None = None
) -> DataFrame:
    """Subtract the mean and divide by the population deviation of ``train``.

    A column that does not vary is only centred.
    """
    source = train if train is not None else df
    stats = source.agg(
        *(F.avg(c).alias(f"m_{c}") for c in columns),
        *(F.stddev_pop(c).alias(f"s_{c}") for c in columns),
    ).first()
    return df.withColumns(
        {
            c: (F.col(c) - F.lit(stats[f"m_{c}"])) / F.lit(stats[f"s_{c}"] or 1.0)
            for c in columns
        }
    )


def balanced_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Add ``rows / (classes * rows of the class)`` as a weight column."""
    counted = df.groupBy(label).agg(F.count("*").alias("__n"))
    rows, classes = counted.agg(F.coalesce(F.sum("__n"), F.lit(0)), F.count("*")).first()
    weights = counted.select(
        F.struct(label).alias("__class"), (F.lit(rows) / (classes * F.col("__n"))).alias(name)
    )
    keyed = df.withColumn("__class", F.struct(label))
    return keyed.join(weights, "__class").drop("__class")
