"""Job settings from YAML or JSON files on any file system that Spark reads."""

from __future__ import annotations

import dataclasses
import json
from collections.abc import Mapping
from typing import TypeVar, get_type_hints

from pyspark.sql import SparkSession

S = TypeVar("S")


def resolved(kind: type[S], raw: Mapping, at: str = "") -> S:
    """The dataclass ``kind`` from nested mappings; fields that are dataclasses as well.

    Unknown names, and missing ones without a default, fail with their full name.
    """
    if not isinstance(raw, Mapping):
        raise ValueError(f"{at or 'settings'}: expected names and values, found {type(raw).__name__}")
    fields = {f.name: f for f in dataclasses.fields(kind)}
    unknown = sorted(f"{at}{name}" for name in set(raw) - set(fields))
    if unknown:
        raise ValueError(f"unknown settings: {unknown}")
    needless = (dataclasses.MISSING, dataclasses.MISSING)
    missing = sorted(
        f"{at}{name}"
        for name, f in fields.items()
        if name not in raw and (f.default, f.default_factory) == needless
    )
    if missing:
        raise ValueError(f"missing settings: {missing}")
    hints = get_type_hints(kind)
    return kind(
        **{
            name: resolved(hints[name], value, f"{at}{name}.")
            if dataclasses.is_dataclass(hints[name])
            else value
            for name, value in raw.items()
        }
    )


def load_settings(kind: type[S], path: str) -> S:
    """Fill the dataclass ``kind`` from a file; unknown or missing names fail."""
    spark = SparkSession.builder.getOrCreate()
    text = spark.read.text(path, wholetext=True).first()["value"]
    if path.endswith(".json"):
        raw = json.loads(text)
    else:
        import yaml

        raw = yaml.safe_load(text)
    return resolved(kind, raw)


def save_settings(settings: object, path: str) -> None:
    """Write a dataclass as a JSON file to any file system that Spark reaches."""
    spark = SparkSession.builder.getOrCreate()
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where)
    try:
        out.write(bytearray(json.dumps(dataclasses.asdict(settings), indent=1).encode()))
    finally:
        out.close()


def check_columns(needed: Mapping[str, str], columns: list[str]) -> None:
    """Fail if a setting names a column that is not there; ``needed`` maps column to setting."""
    absent = sorted(f"{name} ({where})" for name, where in needed.items() if name not in columns)
    if absent:
        raise ValueError(f"settings name columns that are not there: {absent}")
