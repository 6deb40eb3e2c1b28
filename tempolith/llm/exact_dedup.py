"""Exact dedup: group by a 128-bit content hash, keep one stable id, compare bytes inside groups.

Texts are equal when they are identical after lower-casing A-Z; a null text counts as empty, and so
equals other null and empty texts. Repeated rows (same id, same text) are one group like any other
copies; a null id never wins while another id is there. Every input row gives one output row. Columns
of the input other than the id and the text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempolith.llm.common import Scratch, ascii_lower, table
from tempolith.llm.registry import query


def content_hash(text: Column) -> Column:
    """128 bits of MD5, as bytes."""
    return F.unhex(F.md5(text))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
                     hash_of: Callable[[Column], Column] = content_hash) -> DataFrame:
    """Per row: id, keep_id, group_size, kept, text_sha256.

    ``keep`` is "min" or "max": which id of a group stays. Grouping by hash and text together compares
    the bytes: copies shrink to one row in each map task before the shuffle, so a group that holds a
    third of all rows stays small, and each class of equal texts comes out as one narrow row. Rows find
    their class by the hash alone; only where two texts share a hash does the text decide.
    """
    best = F.min if keep == "min" else F.max
    stage = Scratch(docs.sparkSession, "exact")
    rows = (docs.select(F.col(id_col).alias("doc_id"), ascii_lower(F.col(text_col)).alias("norm"))
            .withColumn("h", hash_of(F.col("norm"))))
    classes = stage.keep(rows.groupBy("h", "norm").agg(best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
                         .select("h", "keep_id", "group_size", F.sha2("norm", 256).alias("text_sha256")), "classes")
    shared = classes.groupBy("h").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("h")
    hashed = rows.select("doc_id", "h")
    if shared.isEmpty():
        found = hashed.join(classes, "h")
    else:
        # two texts under one hash: their rows carry the SHA-256 and the length too, and the text settles it
        plain = hashed.join(shared, "h", "left_anti").join(classes, "h")
        texts = rows.join(shared, "h", "left_semi")
        sets = texts.groupBy("h", "norm").agg(best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        by_text = texts.join(sets, ["h", "norm"]).select("h", "doc_id", "keep_id", "group_size",
                                                         F.sha2("norm", 256).alias("text_sha256"))
        found = plain.unionByName(by_text)
    first = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return found.select("doc_id", "keep_id", "group_size", first.alias("kept"), "text_sha256")


@query("op9_exact_dedup", """
    WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
               FROM documents),
    g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
    SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.norm) AS text_sha256
    FROM n JOIN g ON n.norm = g.norm""")
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"), keep="max")
