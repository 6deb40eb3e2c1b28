"""Registry of queries over the driver tables, each paired with oracle SQL.

``register(name, sql)`` stores a ``(spark, sf_dir) -> DataFrame`` builder and
the DuckDB SQL that computes the same result independently (or ``None`` when
the operator is not SQL-expressible, e.g. model fitting).  Doubles are
rounded to 6 decimals on both sides so the comparison does not depend on
summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _expand_snap(sql: str) -> str:
    """Expand ``SNAP(expr)`` / ``SNAP12(expr)`` into the dyadic rounding used on the Spark side."""
    for token, bits in (("SNAP12(", 12), ("SNAP(", 20)):
        while token in sql:
            i = sql.index(token)
            j, depth = i + len(token), 1
            while depth:
                depth += {"(": 1, ")": -1}.get(sql[j], 0)
                j += 1
            inner = sql[i + len(token):j - 1]
            scale = 2 ** bits
            sql = sql[:i] + f"(floor(({inner}) * {scale} + 0.5) / {scale})" + sql[j:]
    return sql


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = _expand_snap(sql.strip())
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from tempolith.plans import q_intervals, q_jobs, q_prep, q_relational, q_sources, q_windows  # noqa: F401
