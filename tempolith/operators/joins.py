"""Joins and set operations.

Join strategy is left to Catalyst + AQE: sides that turn out small at run
time are broadcast (``spark.sql.adaptive.autoBroadcastJoinThreshold``
checks the real shuffle size), everything else is a sort-merge join on the
keys, with AQE splitting skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempolith.operators.windows import _cols


# C1 -----------------------------------------------------------------------------
def enrich(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right, _cols(on), "left")


# C2 -----------------------------------------------------------------------------
def enrich_on(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    cond = None
    for a, b in pairs:
        c = left[a] == right[b]
        cond = c if cond is None else cond & c
    return left.join(right, cond, "left")


# C3 -----------------------------------------------------------------------------
def flag_if_present(left: DataFrame, keys_df: DataFrame, keys, out: str) -> DataFrame:
    """Boolean column: does the key appear in ``keys_df``?  Distinct keys first
    so the left join can never fan out."""
    k = keys_df.select(*_cols(keys)).distinct().withColumn(out, F.lit(True))
    return left.join(k, _cols(keys), "left").withColumn(out, F.coalesce(F.col(out), F.lit(False)))


# C4, C14 ---------------------------------------------------------------------------
def keep_known(left: DataFrame, right: DataFrame, key) -> DataFrame:
    return left.join(right.select(*_cols(key)), _cols(key), "left_semi")


def only_unknown(left: DataFrame, right: DataFrame, key) -> DataFrame:
    return left.join(right.select(*_cols(key)), _cols(key), "left_anti")


# C6 -----------------------------------------------------------------------------
def full(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right, _cols(on), "full")


# C7 -----------------------------------------------------------------------------
def enrich_first(left: DataFrame, right: DataFrame, on, order: Sequence[Column | str]) -> DataFrame:
    """Left join to the right side reduced to its first row per key."""
    w = Window.partitionBy(*_cols(on)).orderBy(*order)
    r1 = right.withColumn("_rk", F.row_number().over(w)).filter("_rk = 1").drop("_rk")
    return left.join(r1, _cols(on), "left")


# C8 -----------------------------------------------------------------------------
def double_sides(df: DataFrame, a: str, b: str, side: str = "side", team: str = "team",
                 opponent: str = "opponent", labels=("home", "away")) -> DataFrame:
    """One row per participant of a pairing, roles swapped, in one scan."""
    rest = [c for c in df.columns if c not in (a, b)]
    pair = F.array(F.struct(F.col(a).alias(team), F.col(b).alias(opponent), F.lit(labels[0]).alias(side)),
                   F.struct(F.col(b).alias(team), F.col(a).alias(opponent), F.lit(labels[1]).alias(side)))
    return df.select(*rest, F.explode(pair).alias("_s")).select(*rest, "_s.*")


# C9 -----------------------------------------------------------------------------
def expand_roster(schedule: DataFrame, roster: DataFrame, on) -> DataFrame:
    """One row per rostered member of each scheduled side (unmatched sides kept)."""
    return schedule.join(roster, _cols(on), "left")


# C10 ----------------------------------------------------------------------------
def attach_latest(left: DataFrame, hist: DataFrame, left_key: Column, hist_key: Column,
                  order_desc: Sequence[str], suffix: str = "_latest", wanted: Sequence[str] | None = None) -> DataFrame:
    """Attach the latest history row per normalised key.

    Left columns win on name collisions; the history copies are suffixed.  With
    ``wanted`` the result has exactly these columns: a value that the left side
    lacks is filled from the suffixed copy, and a column that neither has is NULL."""
    h = hist.withColumn("_k", hist_key)
    w = Window.partitionBy("_k").orderBy(*[F.col(o).desc() for o in order_desc])
    h = h.withColumn("_rk", F.row_number().over(w)).filter("_rk = 1").drop("_rk")
    clash = set(left.columns)
    h = h.select("_k", *[F.col(c).alias(f"{c}{suffix}" if c in clash else c) for c in hist.columns])
    out = left.withColumn("_k", left_key).join(h, "_k", "left").drop("_k")
    if wanted is None:
        return out
    have = set(out.columns)

    def filled(c: str) -> Column:
        names = [n for n in (c, f"{c}{suffix}") if n in have]
        return (F.coalesce(*map(F.col, names)) if names else F.lit(None)).alias(c)

    return out.select(*map(filled, wanted))


# C12 ----------------------------------------------------------------------------
def with_roster(df: DataFrame, keys, member: str, out: str = "roster") -> DataFrame:
    """Attach the group's full (sorted, distinct) member set to each row."""
    r = df.groupBy(*_cols(keys)).agg(F.array_sort(F.collect_set(member)).alias(out))
    return df.join(r, _cols(keys), "left")


# C13 ----------------------------------------------------------------------------
def lookup(df: DataFrame, dim: DataFrame, on, order: Sequence[Column | str] | None = None) -> DataFrame:
    """Dimension lookup; the dimension is first reduced to one row per key so
    duplicates can never multiply rows: the first in ``order``, by default in
    the order of all its columns, so that reruns agree.  Whether it is broadcast is left to
    AQE, which measures its bytes."""
    if order is None:
        order = [F.col(c) for c in dim.columns if c not in _cols(on)] or [F.lit(1)]
    w = Window.partitionBy(*_cols(on)).orderBy(*order)
    d1 = dim.withColumn("_rk", F.row_number().over(w)).filter("_rk = 1").drop("_rk")
    return df.join(d1, _cols(on), "left")


# U1 -----------------------------------------------------------------------------
def union_aligned(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# U3 -----------------------------------------------------------------------------
def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    return union_aligned(frames).distinct()


# U4 -----------------------------------------------------------------------------
def array_sets(a: str, b: str) -> dict[str, Column]:
    return {"only_left": F.array_sort(F.array_except(a, b)),
            "both": F.array_sort(F.array_intersect(a, b)),
            "either": F.array_sort(F.array_union(a, b))}
