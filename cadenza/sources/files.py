"""Parquet and CSV scans and sinks.

Scans take an optional explicit schema so nothing is inferred on large inputs;
Parquet column pruning and filter push-down come from Catalyst as long as the
callers select/filter declaratively after the read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_MODES = {"errorifexists", "error", "overwrite", "append", "ignore"}


def read_parquet(spark: SparkSession, path: str | list[str],
                 schema: StructType | None = None) -> DataFrame:
    """Parquet scan. ``schema`` pins column types (and prunes to its columns)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    paths = [path] if isinstance(path, str) else list(path)
    return reader.parquet(*paths)


def read_csv(spark: SparkSession, path: str, schema: StructType,
             header: bool = True) -> DataFrame:
    """CSV scan with a header row and an explicit schema (no inference pass)."""
    return (spark.read.schema(schema)
            .option("header", header)
            .option("mode", "FAILFAST")
            .csv(path))


def _check_mode(mode: str) -> str:
    if mode not in _MODES:
        raise ValueError(f"unknown save mode {mode!r}; use one of {sorted(_MODES)}")
    return mode


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists",
                  partition_by: list[str] | None = None) -> None:
    """Parquet sink. Default mode fails when the target exists; ``overwrite`` replaces it."""
    writer = df.write.mode(_check_mode(mode))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists",
              header: bool = True) -> None:
    """CSV sink with a header row (the interchange format of the ratings tables)."""
    df.write.mode(_check_mode(mode)).option("header", header).csv(path)
