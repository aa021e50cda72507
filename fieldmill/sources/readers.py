"""Readers. All of them are lazy and take explicit schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_piped(
    spark: SparkSession, paths: Sequence[str] | str, schema: T.StructType, sep: str = "|"
) -> DataFrame:
    """Delimited files with a header; several paths form one table."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.schema(schema).option("sep", sep).csv(paths, header=True)


def read_quoted(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    multi_line: bool = True,
) -> DataFrame:
    """Comma files with quoted free text, doubled quotes and line breaks inside.

    Files with ``multi_line`` cannot be split between tasks; give such a source
    in many files, or turn it off when no field holds a line break.
    """
    return (
        spark.read.schema(schema)
        .option("multiLine", str(multi_line).lower())
        .option("quote", '"')
        .option("escape", '"')
        .csv(path, header=True)
    )


def read_columnar(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None
) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


ITEMS = T.StructType(
    [
        T.StructField(
            "items",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", T.StringType()),
                        T.StructField(
                            "snippet",
                            T.StructType([T.StructField("title", T.StringType())]),
                        ),
                    ]
                )
            ),
        )
    ]
)


def read_categories(spark: SparkSession, path: str) -> DataFrame:
    """Nested JSON list of categories as a table ``(id int, title string)``."""
    items = spark.read.schema(ITEMS).json(path, multiLine=True).select(
        F.explode("items").alias("item")
    )
    return items.select(
        F.col("item.id").try_cast("int").alias("id"), F.col("item.snippet.title").alias("title")
    )


def read_corpus(
    spark: SparkSession, path: str, separator: str = "From r  ", column: str = "emails"
) -> DataFrame:
    """One row per text between separators; Spark splits large files by itself."""
    return spark.read.text(path, lineSep=separator).withColumnRenamed("value", column)
