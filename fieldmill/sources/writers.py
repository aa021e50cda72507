"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_columnar(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Overwrite ``path`` with parquet and return the table read back from it.

    Reading back cuts the lineage, so later steps never repeat the work.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> None:
    """Overwrite ``path`` with header files whose quotes are doubled inside text."""
    (
        df.write.mode("overwrite")
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path, header=True)
    )


def write_corpus(df: DataFrame, column: str, path: str, separator: str = "From r  ") -> None:
    """Overwrite ``path`` with text files whose records end in ``separator``."""
    df.select(column).write.mode("overwrite").text(path, lineSep=separator)
