"""Mixing sources to target weights by Pareto order sampling.

Each source gets a number of words; a document's expected copies follow from its source's share and a mild
preference by weight; the whole part of the expectation is certain copies, the rest an inclusion chance. In
each source the documents are ranked by random odds over inclusion odds, and taken in that order until the
words that are left of the target are used: a fixed-size sample with unequal chances, in one order that a
rerun repeats, because the random numbers are hashes of the id.

A null text counts no words, a null source is a source of its own, ordered last, and a null id hashes like the
text "null". Documents without words take part with size 0. Rows with one id and one size share their random
number; ties are broken by id and size, and equal rows are interchangeable. An empty table gives an empty
result. Only id, text and source are read, so other columns may have any name; ``mixed`` keeps them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempolith.llm.common import WORD, Scratch, numbered, table
from tempolith.llm.registry import query

#: Parts into which each source's order is cut, so that a source's rows are ranked by many tasks.
BINS = 4096


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shorter_first(size: Column) -> Column:
    """A weight that falls with the number of binary digits of the size: long documents repeat less often."""
    return F.floor(F.lit(1_000_000) / F.length(F.bin(size)))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """Target of each source: its weight's share of ``share`` of all words, at most ``most`` times its own.

    What a source cannot hold goes to the others by weight, which ends where each has
    min(cap, level * weight) for one level. One row per source is all that meets here.
    """
    order = F.when(F.col("source").isNull(), 1).otherwise(0)
    place = F.row_number().over(Window.orderBy(order, "source")) - 1
    rows = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("double"))
    rows = rows.withColumn("cap", F.lit(most) * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("w"))
    up = Window.orderBy("ratio", order, "source")
    whole = up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = (rows.withColumn("__full", F.coalesce(F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
            .withColumn("__open", F.sum("w").over(up.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
            .withColumn("__want", F.lit(share) * F.sum("source_size").over(whole))
            .withColumn("__level", (F.col("__want") - F.col("__full")) / F.col("__open")))
    level = F.min(F.when(F.col("__level") <= F.col("ratio"), F.struct("ratio", "__level"))).over(whole)["__level"]
    return rows.withColumn("target", F.least("cap", F.coalesce(level * F.col("w"), F.col("cap")))).select("source", "source_size", "target")


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, tilt: float = 0.5,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row: doc_id, __occ, size, source_size, target, copies, taken (words, repeats counted).

    Expected copies are r + d * (v - 1): r is target over size of the source, v the document's weight over the
    source's mean weight (by words), and d the ``tilt`` part of the largest step that keeps all of them
    between 0 and ``most``. Their words add up to the target.
    """
    stage = Scratch(docs.sparkSession, "mix")
    rows = numbered(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size")),
                    "doc_id", F.col("source"), F.col("size"))
    rows = stage.keep(rows.withColumn("weight", shorter_first(F.col("size"))), "sizes")
    sums = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("weight")).alias("__sw"),
        F.min("weight").alias("__low"), F.max("weight").alias("__high"))
    targets = source_targets(sums.select("source", "source_size"), weights, share, most)
    plan = targets.join(sums.drop("source_size").withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    some = F.col("source_size") > 0
    plan = (plan.withColumn("__r", F.when(some, F.try_divide("target", "source_size")).otherwise(0.0))
            .withColumn("__mean", F.when(some, F.try_divide("__sw", "source_size")).otherwise(F.col("__high").cast("double"))))
    up = F.try_divide(F.lit(most) - F.col("__r"), F.col("__high") / F.col("__mean") - 1)
    down = F.try_divide(F.col("__r"), 1 - F.col("__low") / F.col("__mean"))
    plan = plan.withColumn("__d", F.when(F.col("__high") > F.col("__low"), F.lit(tilt) * F.least(up, down)).otherwise(0.0))
    plan = plan.select(F.col("source").alias("__s"), "source_size", "target", "__r", "__d", "__mean")

    want = F.col("__r") + F.col("__d") * (F.col("weight") / F.col("__mean") - 1)
    unit = (F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    rows = (rows.withColumn("__want", F.greatest(F.lit(0.0), F.least(F.lit(most), want))).withColumn("whole", F.floor("__want"))
            .withColumn("chance", F.col("__want") - F.col("whole")).withColumn("__u", unit))
    odds = F.try_divide(F.col("__u") * (1 - F.col("chance")), (1 - F.col("__u")) * F.col("chance"))
    rows = rows.withColumn("odds", odds)
    # rows without a chance (all of a source that stops at its cap) need no place in the order: they are dealt over as many more bins
    spread = BINS + F.pmod(F.xxhash64("doc_id", "__occ"), F.lit(BINS))
    rows = rows.withColumn("bin", F.when(F.col("odds").isNotNull(), F.floor(F.lit(BINS) * F.col("odds") / (1 + F.col("odds")))).otherwise(spread))

    bins = rows.groupBy("source", "bin").agg(F.sum("size").alias("__words"), F.sum(F.col("size") * F.col("whole")).alias("__sure"))
    by = Window.partitionBy("source")
    bins = (bins.withColumn("__sure", F.sum("__sure").over(by))
            .withColumn("__ahead", F.sum("__words").over(by.orderBy("bin")) - F.col("__words"))
            .select(F.col("source").alias("__s"), F.col("bin").alias("__b"), "__sure", "__ahead"))
    inside = Window.partitionBy("source", "bin").orderBy("odds", "doc_id", "size", "__occ").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(bins, F.col("source").eqNullSafe(F.col("__s")) & (F.col("bin") == F.col("__b")))
    room = F.col("target") - F.col("__sure")
    extra = (F.col("chance") > 0) & (F.col("__ahead") + F.col("__in") + F.col("size") / 2 <= room)
    copies = (F.col("whole") + F.when(extra, 1).otherwise(0)).cast("int")
    return rows.select("doc_id", "__occ", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as the mix takes it, with its own columns."""
    id_col, text_col, source_col = (options.get(k, d) for k, d in (("id_col", "doc_id"), ("text_col", "text"), ("source_col", "source")))
    copies = mix(docs, **options).select(F.col("doc_id").alias("__id"), F.col("__occ").alias("__o"), "copies").filter("copies > 0").withColumnRenamed("copies", "__copies")
    rows = numbered(docs, id_col, F.col(source_col), n_words(F.col(text_col)))
    rows = rows.join(copies, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__occ") == F.col("__o")))
    return rows.select(*[F.col(c) for c in docs.columns], F.explode(F.array_repeat(F.lit(0), F.col("__copies"))).alias("__again")).drop("__again")


@query("op3_mixing", """
    WITH d AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
    d2 AS (SELECT *, floor(1000000.0 / length(bin(size))) AS weight FROM d),
    s AS (SELECT source, sum(size)::DOUBLE AS source_size, sum(size * weight) AS sw, min(weight) AS low, max(weight) AS high FROM d2 GROUP BY source),
    s1 AS (SELECT *, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w, 2.0 * source_size AS cap FROM s),
    s2 AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_,
                  sum(w) OVER (ORDER BY cap / w, encode(source) NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_,
                  1.5 * sum(source_size) OVER () AS want FROM s1),
    s3 AS (SELECT *, (want - full_) / open_ AS lev FROM s2),
    lev AS (SELECT arg_min(lev, cap / w) AS l FROM s3 WHERE lev <= cap / w),
    s4 AS (SELECT s3.*, least(cap, coalesce(l * w, cap)) AS target FROM s3, lev),
    s5 AS (SELECT source, source_size, target, low, high, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS r,
                  CASE WHEN source_size > 0 THEN sw / source_size ELSE high END AS mean FROM s4),
    s6 AS (SELECT *, CASE WHEN high > low THEN 0.5 * least((2.0 - r) / (high / mean - 1), r / (1 - low / mean)) ELSE 0 END AS dd FROM s5),
    e AS (SELECT d2.*, source_size, target, greatest(0, least(2.0, r + dd * (weight / mean - 1))) AS want,
                 (('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5) / 4503599627370496.0 AS u
          FROM d2 JOIN s6 ON d2.source IS NOT DISTINCT FROM s6.source),
    f AS (SELECT *, floor(want) AS whole, want - floor(want) AS chance FROM e),
    g AS (SELECT *, CASE WHEN chance > 0 THEN (u * (1 - chance)) / ((1 - u) * chance) END AS odds,
                 sum(size * whole) OVER (PARTITION BY source) AS sure FROM f),
    h AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY odds NULLS LAST, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM g)
    SELECT doc_id, size, source_size::BIGINT AS source_size, target,
           ((whole + CASE WHEN chance > 0 AND ahead + size / 2.0 <= target - sure THEN 1 ELSE 0 END) * size)::BIGINT AS taken,
           (whole + CASE WHEN chance > 0 AND ahead + size / 2.0 <= target - sure THEN 1 ELSE 0 END)::INT AS copies
    FROM h""")
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")
