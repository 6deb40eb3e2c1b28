"""Entity frames over the driver tables (see FIXTURES.md part C).

EV  events: entity user_id, order (ts, event_id), metric value, context
    event_type, date = ts::date.
OR  orders + customer: entity o_custkey, order (o_orderdate, o_orderkey),
    season = year, opponent = o_orderpriority, team = c_mktsegment.
IV  lineitem as intervals: event l_orderkey % 200, team l_returnflag,
    interval l_orderkey, member l_suppkey % 12.
CH  events as change log: group user_id % 10, member user_id, clock
    date_trunc('hour', ts), in = signup/purchase, out = error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempolith.sources.tables import table

EV_ORDER = ["ts", "event_id"]
OR_ORDER = ["o_orderdate", "o_orderkey"]


def ev(spark: SparkSession, sf: str) -> DataFrame:
    return (table(spark, sf, "events")
            .select("event_id", "user_id", "ts", F.to_date("ts").alias("d"), "event_type", "value"))


def ev_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """EV with deterministic NULL gaps (every 7th event id)."""
    return ev(spark, sf).withColumn("value", F.when(F.col("event_id") % 7 != 0, F.col("value")))


def orders_frame(spark: SparkSession, sf: str, customer: bool = True) -> DataFrame:
    """Orders with their day and season; with ``customer`` also the customer's segment and nation."""
    o = table(spark, sf, "orders")
    if customer:
        c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
        o = o.join(c, o.o_custkey == c.c_custkey, "inner").drop("c_custkey")
    return (o.withColumn("o_orderdate", F.to_date("o_orderdate"))
            .withColumn("season", F.year("o_orderdate")))


def ntz(value) -> Column:
    """A zone-free timestamp literal (``timestamp_ntz``) from a datetime: built from
    its text, so comparisons with ``timestamp_ntz`` columns do not depend on the
    session time zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def snap(c, bits: int = 20):
    """Round to the nearest multiple of 2**-bits.

    Used only where results are compared across engines: scaling by a power of
    two, floor and the division are exact in IEEE arithmetic, and decimal input
    data never lands exactly on a dyadic half-way point, so both engines agree
    unless their inputs already differ.
    """
    scale = float(2 ** bits)
    col = F.col(c) if isinstance(c, str) else c
    return F.floor(col * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def round_doubles(df: DataFrame, bits: int = 20, skip=()) -> DataFrame:
    """Snap every double column (for engine-independent comparison only)."""
    exprs = [snap(f.name, bits).alias(f.name)
             if f.dataType.typeName() in ("double", "float") and f.name not in skip
             else F.col(f.name) for f in df.schema.fields]
    return df.select(*exprs)
