"""Incremental ingest of newly arrived files.

``readStream`` over a landing folder with a declared schema and an
``availableNow`` trigger: every run processes exactly the files that arrived
since the last run (the checkpoint remembers them), then stops.  Each
micro-batch keeps the rows whose id the sink does not hold yet, however old
they are.  The sink is partitioned by a hash bucket of the id and by batch:
ids are looked up in the buckets that the batch touches only, and a repeated
batch overwrites what it wrote: exactly once.  The checkpoint lives in the
shared checkpoint folder so a restarted driver or lost executor resumes where
it stopped.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH, BUCKET = "ingest_batch", "ingest_bucket"


def ingest_new_files(spark: SparkSession, landing: str, schema: T.StructType, key: Sequence[str] | str,
                     event_time: str, sink: str, checkpoint: str, forget_before=None,
                     glob: str | None = None, buckets: int = 256) -> int:
    """Run one ``availableNow`` pass; returns the number of micro-batches run.

    Of rows with one id the earliest by ``event_time`` stays; a row whose id is
    NULL in any column cannot be told from others, so all such rows stay.  The
    sink is a table partitioned by ``ingest_bucket`` (of ``buckets``, which a
    sink keeps for good) and ``ingest_batch``.  ``forget_before``, a timestamp,
    bounds the ids that are looked up to sink rows from then on; by default
    all are."""
    keys = [key] if isinstance(key, str) else list(key)
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    names = schema.fieldNames()
    sink_schema = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType()), T.StructField(BATCH, T.LongType())])
    told = functools.reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    # rows without an id are dealt over all buckets
    bucket = F.pmod(F.when(told, F.xxhash64(*keys)).otherwise(F.xxhash64(*names)), F.lit(buckets)).cast("int")

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.withColumn(BUCKET, bucket).persist()
        try:
            touched = [r[BUCKET] for r in batch.filter(told).select(BUCKET).distinct().collect()]     # at most ``buckets``
            known = known_ids(batch.sparkSession, sink, sink_schema, keys, touched, number)
            if forget_before is not None:
                known = known.filter(F.col(event_time) >= F.lit(forget_before))
            order = F.struct(F.col(event_time), *[F.col(c) for c in names if c != event_time])
            first = batch.filter(told).groupBy(*keys, BUCKET).agg(F.min(order).alias("_row"))
            rows = first.select(*[F.col("_row")[c].alias(c) if c not in keys else F.col(c) for c in names], BUCKET)
            rows = rows.join(known.select(*keys), keys, "left_anti").select(*names, BUCKET)
            rows = rows.unionByName(batch.filter(~told)).withColumn(BATCH, F.lit(number).cast("long"))
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET, BATCH).parquet(sink)
        finally:
            batch.unpersist()

    # an empty table to look ids up in before the first batch
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{sink}/{BUCKET}=-1/{BATCH}=-1")
    query = (reader.parquet(landing).writeStream.foreachBatch(write)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return len(query.recentProgress)


def known_ids(spark: SparkSession, sink: str, sink_schema: T.StructType, keys: Sequence[str], touched: Sequence[int], number: int) -> DataFrame:
    """Rows of earlier batches in the touched buckets: partition filters, so other buckets' files are not listed for the scan."""
    known = spark.read.schema(sink_schema).parquet(sink)
    return known.filter(F.col(BUCKET).isin(list(touched)) & (F.col(BATCH) < number))
