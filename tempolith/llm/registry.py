"""Queries of this subpackage and their DuckDB SQL, for ``__spark_entry__``."""

from __future__ import annotations

import atexit
import functools
import importlib
import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

MODULES = ["exact_dedup", "token_counts", "mixing", "sharding", "minhash", "language", "decontaminate", "html_main", "toxicity", "suffix_dedup",
           "licenses", "whitening", "ranked_search"]


PIPELINE = "corpus_pipeline"
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, as ``--py-files`` does, once for each application.

    Functions that run in tasks are found by their module's name there.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parent.parent
        folder = tempfile.mkdtemp(prefix="tempolith-ship-")  # Spark serves the file from here while the application lives
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        copy = Path(folder, "copy", root.name)
        shutil.copytree(root, copy, ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(str(Path(folder, f"{root.name}-package")), "zip", copy.parent, root.name))
        _shipped.add(context.applicationId)


def query(name: str, sql: str | None = None):
    """Register a ``(spark, sf_dir) -> DataFrame`` builder and, where SQL can say it, the same in SQL."""
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load(module: str) -> None:
    """Import one of ``MODULES``, or the pipeline, which registers its queries."""
    if module != PIPELINE:
        importlib.import_module(f"tempolith.llm.{module}")
        return
    pipeline = importlib.import_module(PIPELINE)
    if "pipeline" not in QUERIES:
        query("pipeline", pipeline.ORACLE_SQL)(pipeline.run)


def load_all() -> None:
    for module in [*MODULES, PIPELINE]:
        load(module)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLE)
