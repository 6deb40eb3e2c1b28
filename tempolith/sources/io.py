"""Scans and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempolith.operators.filters import align_to


# A1 -----------------------------------------------------------------------------
def load(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Parquet scan with a declared schema (no inference; pruning and pushdown apply)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


# A2 -----------------------------------------------------------------------------
def load_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Headered CSV whose optional columns may be missing and whose files may
    order them differently: files are read by groups with one header, columns
    are matched by name, absent ones become NULL, and all are cast to the
    declared types (a cell that cannot be cast becomes NULL)."""
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    # the first row of a file's first block is its header; one row per file comes back
    heads = lines.filter("file_block_start = 0").groupBy("file_path").agg(F.first("value").alias("head"))
    groups: dict[str, list[str]] = {}
    for r in heads.collect():
        groups.setdefault(r["head"], []).append(r["file_path"])
    names, types = [f.name for f in schema.fields], {f.name: f.dataType.simpleString() for f in schema.fields}
    parts = [align_to(spark.read.option("header", True).option("inferSchema", False).csv(files), names, types=types)
             for _, files in sorted(groups.items())]
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# A3 -----------------------------------------------------------------------------
def save(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


# A4 -----------------------------------------------------------------------------
def append_partition(df: DataFrame, path: str, by: Sequence[str] | str) -> None:
    """Write chunk(s) into a partitioned table, replacing only the partitions the
    chunk contains (dynamic overwrite) - reruns of a chunk are idempotent."""
    by = [by] if isinstance(by, str) else list(by)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(path))


# A9 -----------------------------------------------------------------------------
def save_dated(df: DataFrame, path: str, run_date, col: str = "run_date") -> None:
    """Run-dated sink: the run's partition is replaced, earlier runs are kept."""
    append_partition(df.withColumn(col, F.lit(run_date).cast("date")), path, col)


# A5 -----------------------------------------------------------------------------
def only_new(df: DataFrame, seen: DataFrame, key) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.join(seen.select(*keys).distinct(), keys, "left_anti")


# A6 -----------------------------------------------------------------------------
def detect_changes(src: DataFrame, out: DataFrame, key: str, date: str) -> DataFrame:
    """Ids needing a rebuild, with the reason: new id, later max date, more rows.

    Two partial aggregates and one join on the id; the first matching reason
    is reported."""
    s = src.groupBy(key).agg(F.max(date).alias("_smax"), F.count(F.lit(1)).alias("_sn"))
    o = out.groupBy(key).agg(F.max(date).alias("_omax"), F.count(F.lit(1)).alias("_on"))
    j = s.join(o, key, "left")
    reason = (F.when(F.col("_on").isNull(), F.lit("new_id"))
              .when(F.col("_smax") > F.col("_omax"), F.lit("later_date"))
              .when(F.col("_sn") > F.col("_on"), F.lit("more_rows")))
    return j.select(key, reason.alias("reason")).filter(F.col("reason").isNotNull())
