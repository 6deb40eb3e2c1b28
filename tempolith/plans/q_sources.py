"""Source, sink, JSON and streaming queries.

Files written here are derived from the driver tables and live under the
session's shared checkpoint folder (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempolith.session import scratch_path
from tempolith.sources import io as IO
from tempolith.sources import json as J
from tempolith.sources.tables import table
from tempolith.streaming.ingest import ingest_new_files
from tempolith.plans.catalog import register
from tempolith.plans.bindings import ntz, round_doubles

ORDER_CSV_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_clerk", T.StringType())])


# A2 CSV with a missing optional column; A1/A3 parquet round trip -------------------------------
@register("csv_roundtrip", """
SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice,
       CASE WHEN o_orderstatus = 'P' THEN 'clerk ' || o_custkey END AS o_clerk FROM orders
""")
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "orders_csv")
    o = table(spark, sf, "orders")
    # two layouts in one folder: other order, another column, and prices that are no numbers
    (o.filter("o_orderstatus <> 'P'").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
     .write.mode("append").option("header", True).csv(path))
    (o.filter("o_orderstatus = 'P'").select("o_orderstatus", F.concat(F.lit("clerk "), "o_custkey").alias("o_clerk"), "o_custkey",
                                            F.lit("unknown").alias("o_totalprice"), "o_orderkey")
     .write.mode("append").option("header", True).csv(path))
    return IO.load_csv(spark, path, ORDER_CSV_SCHEMA)


@register("parquet_roundtrip", """
SELECT l_returnflag, l_linestatus, SNAP(sum(l_quantity)) AS sum_qty, count(*) AS n FROM lineitem GROUP BY ALL
""")
def parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "flag_totals")
    agg = table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), F.count(F.lit(1)).alias("n"))
    IO.save(agg, path)
    back = IO.load(spark, path, "l_returnflag string, l_linestatus string, sum_qty double, n long")
    return round_doubles(back)


# A4 per-season chunks with dynamic partition overwrite ------------------------------------------
@register("season_partitions", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS season, count(*) AS n, SNAP12(sum(o_totalprice)) AS total
FROM orders GROUP BY 1
""")
def season_partitions(spark, sf):
    path = scratch_path(spark, "orders_by_season")
    o = table(spark, sf, "orders").withColumn("season", F.year("o_orderdate"))
    IO.append_partition(o.filter("season <= 1997"), path, "season")
    IO.append_partition(o.filter("season >= 1997"), path, "season")       # 1997 rewritten, not doubled
    back = spark.read.parquet(path)
    out = back.groupBy("season").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))
    return round_doubles(out, bits=12)


# A9 run-dated sink: a same-day rerun replaces that day only ----------------------------------------
@register("dated_sink", """
SELECT DATE '2024-01-02' AS run_date, event_type, count(*) AS n FROM events GROUP BY event_type
UNION ALL
SELECT DATE '2024-01-01', event_type, count(*) FROM events GROUP BY event_type
""")
def dated_sink(spark, sf):
    path = scratch_path(spark, "dated")
    e = table(spark, sf, "events").select("event_id", "event_type")
    IO.save_dated(e, path, dt.date(2024, 1, 1))
    IO.save_dated(e.unionAll(e), path, dt.date(2024, 1, 2))
    IO.save_dated(e, path, dt.date(2024, 1, 2))             # rerun of the same day
    back = spark.read.parquet(path)
    return back.groupBy("run_date", "event_type").agg(F.count(F.lit(1)).alias("n"))


# A5 only unseen ids -----------------------------------------------------------------------------
@register("only_new_ids", """
SELECT event_id, user_id FROM events
WHERE user_id NOT IN (SELECT user_id FROM events WHERE ts < TIMESTAMP '2024-01-01 12:00:00')
""")
def only_new_ids(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "ts")
    seen = e.filter(F.col("ts") < ntz(dt.datetime(2024, 1, 1, 12)))
    return IO.only_new(e, seen, "user_id").select("event_id", "user_id")


# A6 change detection between a fresh source and a materialised output ---------------------------------
@register("detect_changes", """
WITH s AS (SELECT user_id, max(ts) AS smax, count(*) AS sn FROM events GROUP BY 1),
o AS (SELECT user_id, max(ts) AS omax, count(*) AS onn FROM events
      WHERE ts < TIMESTAMP '2024-01-21'
        AND user_id IN (SELECT user_id FROM events WHERE ts < TIMESTAMP '2024-01-02') GROUP BY 1)
SELECT user_id, CASE WHEN o.user_id IS NULL THEN 'new_id' WHEN smax > omax THEN 'later_date'
                     WHEN sn > onn THEN 'more_rows' END AS reason
FROM s LEFT JOIN o USING (user_id)
WHERE o.user_id IS NULL OR smax > omax OR sn > onn
""")
def detect_changes(spark, sf):
    e = table(spark, sf, "events")
    # the earlier materialised output: events up to Jan 20 of the users it already knew on Jan 1
    known = e.filter(F.col("ts") < ntz(dt.datetime(2024, 1, 2))).select("user_id")
    out = e.filter(F.col("ts") < ntz(dt.datetime(2024, 1, 21))).join(known, "user_id", "left_semi")
    return IO.detect_changes(e, out, "user_id", "ts")


# A7 nested JSON names (documents built from lineitem x part, then parsed back) ----------------------------
@register("json_names", r"""
SELECT DISTINCT trim(regexp_replace(lower(CASE WHEN l.l_linenumber % 2 = 1 THEN p.p_name ELSE 'desc ' || p.p_brand END), '[^\w]+', ' ', 'g')) AS name
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
""")
def json_names(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    pt = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    j = li.join(pt, li.l_partkey == pt.p_partkey)
    outcome = F.struct(F.when(F.col("l_linenumber") % 2 == 1, F.col("p_name")).otherwise("").alias("participant"),
                       F.concat(F.lit("desc "), F.col("p_brand")).alias("description"))
    per_order = j.groupBy("l_orderkey").agg(F.collect_list(outcome).alias("outcomes"))
    def category(name, outcomes):
        offers = F.array(F.array(F.struct(outcomes.alias("outcomes"))), F.array(F.struct(outcomes.alias("outcomes"))))
        return F.struct(F.lit(name).alias("name"), F.array(F.struct(F.struct(offers.alias("offers")).alias("offerSubcategory")))
                        .alias("offerSubcategoryDescriptors"))
    other = F.array(F.struct(F.lit(None).cast("string").alias("participant"), F.lit("other").alias("description")))
    blank = F.array(F.struct(F.lit("").alias("participant"), F.lit(" ").alias("description")))
    doc = F.to_json(F.array(category("Parts", F.col("outcomes")), category("other", other), category("PARTS", blank)))
    docs = per_order.select(doc.alias("doc"))
    return J.json_names(docs, "doc", "parts")


# A8 JSON:API side lookup ----------------------------------------------------------------------------------
@register("json_lookup", """
SELECT CAST(o.o_orderkey AS VARCHAR) AS id, CASE WHEN o.o_orderpriority <> '1-URGENT' THEN c.c_name END AS name
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
""")
def json_lookup(spark, sf):
    """One document per day: its orders as ``data``, their customers as ``included`` (urgent orders name one that is not there)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    j = o.join(c, o.o_custkey == c.c_custkey)
    ref = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("none")).otherwise(F.col("o_custkey").cast("string"))
    data = F.struct(F.col("o_orderkey").cast("string").alias("id"),
                    F.create_map(F.lit("customer"), F.struct(F.struct(ref.alias("id")).alias("data"))).alias("relationships"))
    included = F.struct(F.col("o_custkey").cast("string").alias("id"), F.create_map(F.lit("name"), F.col("c_name")).alias("attributes"))
    docs = j.groupBy("o_orderdate").agg(F.collect_list(data).alias("data"), F.collect_list(included).alias("included"))
    doc = F.to_json(F.struct("data", "included"))
    return J.json_lookup(docs.select(doc.alias("doc")), "doc", "customer", "name").select("id", "name")


# F18 JSON scalar access -----------------------------------------------------------------------------------
@register("props_json", """
SELECT event_type, count(DISTINCT CAST(props->>'k' AS INTEGER)) AS n_k, min(CAST(props->>'k' AS INTEGER)) AS min_k,
       max(CAST(props->>'k' AS INTEGER)) AS max_k
FROM events GROUP BY 1
""")
def props_json(spark, sf):
    e = table(spark, sf, "events").withColumn("k", J.json_scalar("props", "$.k", "int"))
    return e.groupBy("event_type").agg(F.countDistinct("k").alias("n_k"), F.min("k").alias("min_k"),
                                       F.max("k").alias("max_k"))


# T1 incremental ingest: two landings overlap, the second is late; ids are looked up in the sink -------------------------
@register("stream_ingest", """
SELECT event_id, user_id, event_type FROM events
""")
def stream_ingest(spark, sf):
    landing, sink, ckpt = (scratch_path(spark, n) for n in ("landing", "ingested", "ingest_ckpt"))
    e = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    # the newer half lands first, then all: late rows are kept, repeated ones are not
    e.filter(F.col("ts") >= ntz(dt.datetime(2024, 1, 16))).write.mode("append").parquet(landing)
    ingest_new_files(spark, landing, e.schema, "event_id", "ts", sink, ckpt)
    e.write.mode("append").parquet(landing)
    ingest_new_files(spark, landing, e.schema, "event_id", "ts", sink, ckpt)
    return spark.read.parquet(sink).select("event_id", "user_id", "event_type")


# T1 with rows that have no id: all stay, whatever lands twice of the others ----------------------------------------------
@register("stream_ingest_null_ids", """
SELECT CASE WHEN event_id % 10 <> 0 THEN event_id END AS event_id, user_id, event_type FROM events
UNION ALL SELECT NULL, user_id, event_type FROM events WHERE event_id % 10 = 0 AND ts >= TIMESTAMP '2024-01-16'
""")
def stream_ingest_null_ids(spark, sf):
    landing, sink, ckpt = (scratch_path(spark, n) for n in ("landing", "ingested", "ingest_ckpt"))
    e = table(spark, sf, "events").select(F.when(F.col("event_id") % 10 != 0, F.col("event_id")).alias("event_id"), "ts", "user_id", "event_type", "value")
    e.filter(F.col("ts") >= ntz(dt.datetime(2024, 1, 16))).write.mode("append").parquet(landing)
    ingest_new_files(spark, landing, e.schema, "event_id", "ts", sink, ckpt, buckets=16)
    e.write.mode("append").parquet(landing)
    ingest_new_files(spark, landing, e.schema, "event_id", "ts", sink, ckpt, buckets=16)
    return spark.read.parquet(sink).select("event_id", "user_id", "event_type")
