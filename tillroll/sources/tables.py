"""Parquet table access for the driver-generated data sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


_SCHEMAS: dict[str, object] = {}


def read_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """One driver table. Column pruning and filters reach the parquet scan.

    The files are read-only inputs, so a table's schema is inferred once per path
    and reused: later reads skip the footer-reading job.
    """
    path = f"{data_dir.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
        return df
    return spark.read.schema(_SCHEMAS[path]).parquet(path)
