"""Typed loaders for the driver's parquet tables.

Parquet ``timestamp[us]`` without a zone loads as ``timestamp_ntz``; the
loaders keep it and the bindings cast explicitly (``to_date``) where a date is
meant.  Only the columns a query selects are read (Catalyst prunes the scan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
