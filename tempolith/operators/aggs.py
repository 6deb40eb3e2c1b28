"""Grouped aggregations.

All are single ``groupBy`` plans (partial aggregation on the map side, one
exchange on the keys) or key-partitioned windows; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempolith.operators.windows import _cols


# D1 -------------------------------------------------------------------------------
def rate_above(df: DataFrame, keys, flag: str, threshold: float = 0.5, out: str = "rate") -> DataFrame:
    """Keys whose mean of a boolean flag is above ``threshold``."""
    g = df.groupBy(*_cols(keys)).agg(F.avg(F.col(flag).cast("int")).alias(out))
    return g.filter(F.col(out) > threshold)


# D2 -------------------------------------------------------------------------------
def daily_sum(df: DataFrame, keys, cols: Sequence[str]) -> DataFrame:
    """Sums per key; an all-NULL group sums to 0 (pandas ``sum`` semantics)."""
    return df.groupBy(*_cols(keys)).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cols])


# D3 -------------------------------------------------------------------------------
def member_totals(df: DataFrame, members: str, keys, sum_cols: Sequence[str], count_distinct: str,
                  sep: str = "-", member_out: str = "member") -> DataFrame:
    """Explode a delimited member list, then sum and distinct-count per (member, keys)."""
    ex = df.withColumn(member_out, F.explode(F.split(F.col(members), sep)))
    ex = ex.withColumn(member_out, F.col(member_out).cast("long"))
    aggs = [F.sum(c).alias(f"{c}_total") for c in sum_cols]
    aggs.append(F.countDistinct(count_distinct).alias(f"n_{count_distinct}"))
    return ex.groupBy(member_out, *_cols(keys)).agg(*aggs)


# D4 -------------------------------------------------------------------------------
def weighted_mean(df: DataFrame, keys, v: str, w: str, out: str = "wmean") -> DataFrame:
    """sum(v*w)/sum(w) per key; NULL when the weights sum to 0 or any v/w is NULL."""
    has_null = F.sum((F.col(v).isNull() | F.col(w).isNull()).cast("int")) > 0
    val = F.try_divide(F.sum(F.col(v) * F.col(w)), F.sum(w))
    return df.groupBy(*_cols(keys)).agg(F.when(~has_null, val).alias(out))


# D8 -------------------------------------------------------------------------------
def count_where(df: DataFrame, keys, preds: dict[str, Column], sums: dict[str, Column] | None = None) -> DataFrame:
    """Conditional counters: ``count_if(pred)`` per key (NULL predicate not counted)."""
    aggs = [F.count_if(F.coalesce(p, F.lit(False))).alias(n) for n, p in preds.items()]
    aggs += [F.sum(e).alias(n) for n, e in (sums or {}).items()]
    return df.groupBy(*_cols(keys)).agg(*aggs)


# D9 -------------------------------------------------------------------------------
def members(df: DataFrame, keys, member: str, out: str = "members") -> DataFrame:
    return df.groupBy(*_cols(keys)).agg(F.array_sort(F.collect_set(member)).alias(out))


# D10 ------------------------------------------------------------------------------
def group_total(df: DataFrame, keys, c: str, out: str | None = None) -> DataFrame:
    """The group's total on each row: summed by partial aggregates and joined
    back, so the rows of a large group never meet in one task (AQE splits the join)."""
    return _with_group(df, keys, F.sum(c), out or f"{c}_group_total")


def _with_group(df: DataFrame, keys, agg: Column, out: str) -> DataFrame:
    k = _cols(keys)
    names = [f"_g{i}" for i in range(len(k))]
    totals = df.groupBy(*[F.col(c).alias(n) for c, n in zip(k, names)]).agg(agg.alias("_gv"))
    cond = None
    for c, n in zip(k, names):
        same = F.col(c).eqNullSafe(F.col(n))
        cond = same if cond is None else cond & same
    return df.join(totals, cond, "left").withColumn(out, F.col("_gv")).drop(*names, "_gv")


# D11 ------------------------------------------------------------------------------
def distinct(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropDuplicates(list(subset)) if subset else df.distinct()


# D12 ------------------------------------------------------------------------------
def first_per(df: DataFrame, keys, order: Sequence[Column | str]) -> DataFrame:
    """First row per key under a total order (plans as a window group limit)."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*order)
    return df.withColumn("_rk", F.row_number().over(w)).filter("_rk = 1").drop("_rk")


# D13 ------------------------------------------------------------------------------
def is_group_max(df: DataFrame, keys, c: str, out: str) -> DataFrame:
    """1 where ``c`` equals its group maximum (ties all 1, NULL 0)."""
    d = _with_group(df, keys, F.max(c), "_gmax")
    return d.withColumn(out, F.coalesce(F.col(c) == F.col("_gmax"), F.lit(False)).cast("int")).drop("_gmax")


# D14 ------------------------------------------------------------------------------
def id_summary(df: DataFrame, key: str, date: str) -> DataFrame:
    return df.groupBy(key).agg(F.min(date).alias("min_date"), F.max(date).alias("max_date"),
                               F.count(F.lit(1)).alias("n_rows"))


# D15 ------------------------------------------------------------------------------
def n_distinct(df: DataFrame, c: str, out: str | None = None) -> DataFrame:
    return df.agg(F.countDistinct(c).alias(out or f"n_distinct_{c}"))
