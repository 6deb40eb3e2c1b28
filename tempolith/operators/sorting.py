"""Sorts, top-n per group and paging."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempolith.operators.windows import _cols


# S1 ------------------------------------------------------------------------------
def sort_stable(df: DataFrame, order: Sequence[Column | str], tie: str) -> DataFrame:
    """Global sort with a unique tie-break (only at a sink; windows carry their own order)."""
    return df.orderBy(*order, F.col(tie))


# S2 ------------------------------------------------------------------------------
def top_n_per_group(df: DataFrame, keys, order: Sequence[Column | str], n: int, rank_col: str | None = None) -> DataFrame:
    """First ``n`` rows per group; plans as a window group limit (map-side top-n)."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*order)
    out = df.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= n)
    return out.withColumnRenamed("_rk", rank_col) if rank_col else out.drop("_rk")


# S3 ------------------------------------------------------------------------------
def page(df: DataFrame, order: Sequence[Column | str], page_no: int, size: int,
         total_rows: int | None = None, tie: str | None = None) -> DataFrame:
    """One page of a sorted result; the page is clamped to [1, ceil(n/size)].

    ``tie``, a unique column, makes the order total. Deep pages cost a sort of
    all rows before them: ``page_after`` goes on from a row instead.

    ``total_rows`` may be passed when known; otherwise it is one count job.
    """
    n = df.count() if total_rows is None else total_rows
    last = max(1, -(-n // size))
    p = min(max(1, page_no), last)
    ordered = sort_stable(df, order, tie) if tie else df.orderBy(*order)
    return ordered.offset((p - 1) * size).limit(size)


def page_after(df: DataFrame, order: Sequence[tuple[str, bool]], tie: str, size: int, last: Sequence | None = None) -> DataFrame:
    """The ``size`` rows after the one with the values ``last`` (one for each
    order column, then the tie), or the first ones: a filter and a top-n,
    however deep the page.  ``order`` gives (column, ascending); order columns
    are not NULL."""
    keys = [*order, (tie, True)]
    if last is not None:
        later = F.lit(False)
        for (c, up), v in reversed(list(zip(keys, last))):
            beyond = F.col(c) > F.lit(v) if up else F.col(c) < F.lit(v)
            later = beyond | ((F.col(c) == F.lit(v)) & later)
        df = df.filter(later)
    return df.orderBy(*[F.col(c).asc() if up else F.col(c).desc() for c, up in keys]).limit(size)


class PagedTable:
    """A sorted result that is read page by page: written once in order, with each row's position.

    Rows are dealt by range of the order, numbered inside each range and moved up by the rows of the ranges before
    (one narrow row per range), and kept in folders of ``block`` positions. A page, however deep, is a read of the one
    or two folders that hold its positions: no count, no sort of what lies before it.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def write(cls, df: DataFrame, order: Sequence[Column | str], tie: str, path: str, block: int = 1 << 16) -> PagedTable:
        """``tie``, a unique column, makes the order total."""
        from tempolith.session import cut_lineage
        keys = [*order, F.col(tie)]
        held = cut_lineage(df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()))
        counts = held.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
        ahead = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_ahead"))
        place = F.row_number().over(Window.partitionBy("_part").orderBy(*keys))
        rows = held.withColumn("_place", place).join(F.broadcast(ahead), "_part").withColumn("position", F.col("_place") + F.col("_ahead") - 1)
        rows = rows.drop("_part", "_place", "_ahead").withColumn("_block", F.floor(F.col("position") / block))
        out = cls(df.sparkSession, path)
        rows.sortWithinPartitions("position").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_block").parquet(f"{out.path}/rows")
        total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).withColumns({"block": F.lit(block), "schema": F.lit(df.schema.json())})
        total.coalesce(1).write.mode("overwrite").parquet(f"{out.path}/meta")
        return out

    def page(self, page_no: int, size: int) -> DataFrame:
        """Rows of a page, with their position from 0; the page is clamped to [1, ceil(n/size)]."""
        meta = self.spark.read.parquet(f"{self.path}/meta").first()
        schema = T.StructType.fromJson(json.loads(meta["schema"]))
        if not meta["n"]:
            return self.spark.createDataFrame([], schema.add("position", "long"))
        p = min(max(1, page_no), max(1, -(-meta["n"] // size)))
        first, last = (p - 1) * size, min(p * size, meta["n"]) - 1
        rows = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("position", T.LongType()), T.StructField("_block", T.LongType())])).parquet(f"{self.path}/rows")
        rows = rows.filter(F.col("_block").between(first // meta["block"], last // meta["block"]) & F.col("position").between(first, last))
        return rows.drop("_block").orderBy("position")
