"""Tree-model pipelines, scoring and text clusters on ``pyspark.ml``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import (
    IDF,
    HashingTF,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import few_parts, kept, staged

INDEX_SUFFIX = "_ind"
FEATURES = "features"


def feature_stages(
    numeric: Sequence[str], categorical: Sequence[str] = (), invalid: str = "skip"
) -> list:
    """Index categorical columns and assemble one vector.

    With ``skip`` rows holding nulls or unseen levels are left out.
    """
    stages: list = []
    indexed = [c + INDEX_SUFFIX for c in categorical]
    if categorical:
        stages.append(
            StringIndexer(
                inputCols=list(categorical), outputCols=indexed, handleInvalid=invalid
            )
        )
    stages.append(
        VectorAssembler(
            inputCols=[*numeric, *indexed], outputCol=FEATURES, handleInvalid=invalid
        )
    )
    return stages


def forest_classifier(label: str, seed: int = 200, **params) -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol=FEATURES, labelCol=label, seed=seed, **params)


def forest_regressor(label: str, seed: int = 200, **params) -> RandomForestRegressor:
    return RandomForestRegressor(featuresCol=FEATURES, labelCol=label, seed=seed, **params)


def boosted_classifier(
    label: str, validation: str | None = None, seed: int = 200, **params
) -> GBTClassifier:
    """Boosted trees; rows flagged in ``validation`` stop the training early."""
    if validation:
        params["validationIndicatorCol"] = validation
    return GBTClassifier(featuresCol=FEATURES, labelCol=label, seed=seed, **params)


def boosted_regressor(
    label: str, validation: str | None = None, seed: int = 200, **params
) -> GBTRegressor:
    if validation:
        params["validationIndicatorCol"] = validation
    return GBTRegressor(featuresCol=FEATURES, labelCol=label, seed=seed, **params)


def fit_pipeline(
    train: DataFrame,
    learner,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    invalid: str = "skip",
) -> PipelineModel:
    """Fit the encoders, then the learner on the encoded rows."""
    encoder = Pipeline(stages=feature_stages(numeric, categorical, invalid)).fit(train)
    # Tree learners pass over their input several times before they cache a form
    # of their own, so the encoded rows are kept meanwhile.
    encoded = kept(encoder.transform(train).select(*_columns_of(learner)))
    try:
        encoded.count()
        fitted = learner.fit(few_parts(encoded), {learner.maxBins: bins_for(encoder, learner)})
    finally:
        encoded.unpersist()
    return PipelineModel(stages=[*encoder.stages, fitted])


def _columns_of(learner) -> list[str]:
    """Input columns of a learner: features, label and optional extras."""
    names = ("featuresCol", "labelCol", "weightCol", "validationIndicatorCol")
    present = [learner.getParam(n) for n in names if learner.hasParam(n)]
    return [learner.getOrDefault(p) for p in present if learner.isDefined(p)]


def bins_for(encoder: PipelineModel, learner) -> int:
    """Split candidates per column: at least one for each level of a category."""
    sizes = [
        len(labels) + 1
        for stage in encoder.stages
        if isinstance(stage, StringIndexerModel)
        for labels in stage.labelsArray
    ]
    return max([learner.getMaxBins(), *sizes])


def scored(model: PipelineModel, df: DataFrame, name: str = "default_proba") -> DataFrame:
    """Input columns plus the probability of class 1."""
    out = model.transform(df).withColumn(name, vector_to_array("probability")[1])
    return out.select(*df.columns, name)


def predicted(model: PipelineModel, df: DataFrame, name: str = "prediction") -> DataFrame:
    out = model.transform(df)
    return out.select(*df.columns, F.col("prediction").alias(name))


def save_pipeline(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_with_saved(spark: SparkSession, path: str, df: DataFrame, name: str = "default_proba") -> DataFrame:
    """Score a table with a pipeline stored at ``path``."""
    return scored(load_pipeline(path), df, name)


def importances(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """Feature importances of the last stage, largest first."""
    names = model.stages[-2].getInputCols()
    values = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame(
        [(n, float(v)) for n, v in zip(names, values)], "feature string, importance double"
    ).orderBy(F.desc("importance"), "feature")


def clustered_texts(
    df: DataFrame,
    tokens: str,
    k: int,
    hash_features: int = 1 << 12,
    max_iter: int = 10,
    seed: int = 7,
) -> DataFrame:
    """Add ``cluster`` by k-means on term weights of an array column.

    Weights, k-means and whoever reads the result each pass over the rows, so these are
    written once with their hashed counts; ``df`` should hold only columns that are wanted.
    K-means draws by partition and place, so it gets the counts as ``df`` dealt them.
    """
    hashing = HashingTF(inputCol=tokens, outputCol="__tf", numFeatures=hash_features)
    place = {"__part": F.spark_partition_id(), "__place": F.monotonically_increasing_id()}
    hashed = staged(hashing.transform(df).withColumns(place))
    parts = (hashed.agg(F.max("__part")).first()[0] or 0) + 1
    dealt = hashed.select("__tf", "__part", "__place").repartitionById(parts, F.col("__part"))
    # document frequencies are whole numbers, the same in any order
    weights = IDF(inputCol="__tf", outputCol="__weights").fit(hashed)
    means = KMeans(
        featuresCol="__weights", predictionCol="cluster", k=k, maxIter=max_iter, seed=seed
    ).fit(weights.transform(dealt.sortWithinPartitions("__place").select("__tf")))
    return means.transform(weights.transform(hashed)).drop("__tf", "__weights", *place)


def term_counts(df: DataFrame, tokens: str, by: str) -> DataFrame:
    # An outer explode is planned without a filter on the array, which would
    # compute an expensive token expression twice.
    return (
        df.select(by, F.explode_outer(tokens).alias("term"))
        .where("term is not null")
        .groupBy(by, "term")
        .agg(F.count("*").alias("n"))
    )


def top_terms(df: DataFrame, tokens: str, by: str, k: int = 100) -> DataFrame:
    """The k most frequent terms of each group, ties by term.

    Spark keeps only k rows per group and task before the shuffle.
    """
    ranked = Window.partitionBy(by).orderBy(F.desc("n"), "term")
    return (
        term_counts(df, tokens, by)
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
    )
