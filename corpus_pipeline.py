"""From raw documents to training shards: five stages, each one of the operators in ``tempolith.llm``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's ``docs``. All but the last return the columns of ``docs``. Each stage works
on all rows that the one before kept: rejected languages go, one document of each near-duplicate component stays,
documents that hold test items go, sources are mixed to their weights (rows repeat as the mix takes them), and what
is left is dealt to shards. Columns other than doc_id, text, lang and source pass through unread. Nulls, empty
tables, ties and repeated rows are treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempolith.llm import decontaminate, language, minhash, mixing, sharding
from tempolith.llm.common import Scratch, table
from tempolith.llm.registry import ship

#: Bytes that a shard should reach.
SHARD_BYTES = 64 << 20


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is told clearly; dictionaries come from the labelled rows among them."""
    ship(spark)
    books = language.learn(docs.filter(~F.coalesce(language.held_out(), F.lit(False))).select("doc_id", "text", "lang"))
    return docs.filter(language.accepted(books, F.col("text")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return minhash.deduplicated(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def deal_to_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.sharded(docs, target_bytes=SHARD_BYTES)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("sharding", deal_to_shards),
]

#: Compression, minima, alignment and hashes of text are beyond SQL; tests/llm checks the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, stage = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for name, step in STAGES:
        done = list(stage.paths)
        docs = stage.keep(step(spark, docs, sf_dir), name)
        stage.drop(*done) if done else None
    return docs
