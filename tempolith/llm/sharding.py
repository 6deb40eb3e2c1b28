"""K-d tree sharding: split at weighted medians along the widest metadata dimension.

Rows are first summed to units, one per distinct text; a text whose copies weigh more than a small part of a
shard is cut into several units by a hash of the id, so one group never outweighs a cut. The tree then splits
the units: at each node the dimension with the largest range is taken, and the units are divided where the
running sum of their bytes crosses the node's share of leaves, found by range partitions over the whole level
at a time. Leaves are the shards; copies of a text stay together as far as the sizes allow. Units whose node is
a leaf take no part in further levels.

A null text has no bytes (size 1). Equal units are ordered by their hash, so ties do not unbalance a split.
Repeated rows are rows like any others. An empty table gives an empty result. ``sharded`` keeps the columns
of its input, whatever their names.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempolith.llm.common import Scratch, numbered, running_sum, table
from tempolith.llm.registry import query

#: A text's copies are cut into units of about this part of a shard.
UNIT_PART = 1 / 64
#: Dimensions, scaled to a similar width: fourth root of the size, share of multi-byte text, place of the content hash.
SCALE = 16.0
#: Tree nodes or shards (one narrow row each) that are broadcast at most; more of them make a join with as many keys.
FEW = 1 << 16


def _dimensions(size: Column, chars: Column, crc: Column) -> Column:
    return F.array(F.sqrt(F.sqrt(size.cast("double"))), F.lit(SCALE) * (size - 1 - chars) / size, F.lit(SCALE) * crc / float(1 << 32))


def _offsets(df: DataFrame, group: str, value: Column) -> DataFrame:
    """Per group, the sum over the groups before it; one row per node or shard."""
    totals = df.groupBy(group).agg(F.sum(value).alias("__sum"))
    return totals.select(F.col(group), (F.sum("__sum").over(Window.orderBy(group)) - F.col("__sum")).alias("__start"), "__sum")


def shard(docs: DataFrame, n_shards: int | None = None, target_bytes: int | None = None,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, __occ, size, text_crc32, shard, slot (gapless from 0 in each shard).

    Give the number of shards, or the bytes a shard should reach.
    """
    stage = Scratch(docs.sparkSession, "shard")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                       F.length(text).alias("__chars"), F.unhex(F.md5(text)).alias("__md5"))
    rows = stage.keep(numbered(rows, "doc_id", F.col("__md5")), "rows")
    total = rows.agg(F.sum("size")).first()[0] or 0
    leaves = n_shards or max(1, math.ceil(total / target_bytes))
    limit = max(1.0, total / leaves * UNIT_PART)

    groups = rows.groupBy("__md5").agg(F.sum("size").alias("__bytes")).withColumn("__cuts", F.ceil(F.col("__bytes") / F.lit(limit)))
    cut = F.when(F.col("__cuts") > 1, F.pmod(F.xxhash64("doc_id", "__occ"), F.col("__cuts"))).otherwise(0)
    # only texts that are cut need their number of cuts: few rows, however many copies they have
    heavy = groups.filter("__cuts > 1").select("__md5", "__cuts")
    rows = stage.keep(rows.join(heavy, "__md5", "left").withColumn("__unit", F.coalesce(cut, F.lit(0)).cast("long")).drop("__cuts"), "cut")
    units = rows.groupBy("__md5", "__unit").agg(F.sum("size").alias("__bytes"), F.min("size").alias("__size"), F.min("__chars").alias("__chars"),
                                                F.min("text_crc32").alias("__crc"))
    units = units.select("__md5", "__unit", "__bytes", _dimensions(F.col("__size"), F.col("__chars"), F.col("__crc")).alias("__dims"),
                         F.lit(0).alias("__lo"), F.lit(leaves).alias("__k"))
    units = stage.keep(units, "units")
    n_dims, level, leaves_of = 3, 0, [units.filter("__k = 1")]
    while not (open_ := units.filter("__k > 1")).isEmpty():
        # one row per node that is still split: its widest dimension, its bytes, and the bytes of the nodes before it
        ranges = [F.max(F.col("__dims")[i]) - F.min(F.col("__dims")[i]) for i in range(n_dims)]
        nodes = open_.groupBy("__lo").agg(F.array(*ranges).alias("__w"), F.sum("__bytes").alias("__sum"))
        nodes = nodes.select("__lo", F.array_position("__w", F.array_max("__w")).cast("int").alias("__axis"), "__sum",
                             (F.sum("__sum").over(Window.orderBy("__lo")) - F.col("__sum")).alias("__start"))
        split = open_.join(F.broadcast(nodes) if min(2 ** level, leaves) <= FEW else nodes, "__lo").withColumn("__value", F.element_at("__dims", F.col("__axis"))).drop("__axis")
        split = running_sum(split, ["__lo", "__value", "__md5", "__unit"], "__bytes", stage, f"level{level}")
        half = F.floor(F.col("__k") / 2).cast("int")
        left = F.col("__before") - F.col("__start") + F.col("__bytes") / 2 <= F.col("__sum") * half / F.col("__k")
        units = stage.keep(split.select("__md5", "__unit", "__bytes", "__dims", F.when(left, F.col("__lo")).otherwise(F.col("__lo") + half).alias("__lo"),
                                        F.when(left, half).otherwise(F.col("__k") - half).alias("__k")), f"units{level}")
        stage.drop(f"level{level}")
        leaves_of.append(units.filter("__k = 1"))
        level += 1
    where = functools.reduce(DataFrame.unionByName, leaves_of).select("__md5", "__unit", F.col("__lo").alias("shard"))
    placed = rows.join(where, ["__md5", "__unit"])
    placed = placed.select("doc_id", "__occ", "size", "text_crc32", "shard", F.lit(1).cast("long").alias("__one"))
    placed = running_sum(placed, ["shard", "doc_id", "__occ", "text_crc32"], "__one", stage, "slots")
    firsts = _offsets(placed.select("shard", "__one"), "shard", F.col("__one"))
    return placed.join(F.broadcast(firsts) if leaves <= FEW else firsts, "shard").select("doc_id", "__occ", "size", "text_crc32", "shard", (F.col("__before") - F.col("__start")).alias("slot"))


def sharded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with their shard and slot."""
    where = shard(docs, id_col=id_col, text_col=text_col, **options).select(F.col("doc_id").alias("__id"), F.col("__occ").alias("__o"), F.col("shard").alias("__shard"),
                                                                            F.col("slot").alias("__slot"))
    rows = numbered(docs, id_col, F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")))))
    rows = rows.join(where, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__occ") == F.col("__o")))
    own = [F.col(c) for c in docs.columns if c not in ("shard", "slot")]
    return rows.select(*own, F.col("__shard").alias("shard"), F.col("__slot").alias("slot"))


@query("op4_sharding")
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard(table(spark, sf_dir, "documents"), n_shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
