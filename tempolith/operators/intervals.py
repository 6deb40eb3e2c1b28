"""Active-set reconstruction and interval splits.

Time runs forward here (for a countdown clock pass its negation).  A group
(e.g. event x team) has boundaries = its change clocks plus its start and
end; interval ``k`` runs from boundary ``k`` to boundary ``k + 1``.

No sequential fold and no member x boundary grid: each member's changes are
reduced to "last change wins, *in* beats *out* at the same clock" per
boundary, the runs of *in* become index spans, and ``explode(sequence())``
emits exactly one row per (interval, active member) - the size of the
answer.  Events are placed into intervals by a forward fill over the union
of events and boundaries, partitioned by (group, time bucket) so a hot group
is still spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempolith.operators.windows import UNB, CUR, _cols


# W23 -----------------------------------------------------------------------------
def first_members(ev: DataFrame, group, member: str, seq: str, n: int = 5,
                  exclude: Column | None = None) -> DataFrame:
    """First ``n`` distinct members per group by first appearance (``min(seq)``),
    ignoring rows matching ``exclude`` (e.g. change events)."""
    group = _cols(group)
    src = ev if exclude is None else ev.filter(~F.coalesce(exclude, F.lit(False)))
    src = src.filter(F.col(member).isNotNull())
    first = src.groupBy(*group, member).agg(F.min(seq).alias("first_seq"))
    w = Window.partitionBy(*group).orderBy("first_seq", member)
    return first.withColumn("slot", F.row_number().over(w)).filter(F.col("slot") <= n)


# W24 -----------------------------------------------------------------------------
def boundaries(changes: DataFrame, spans: DataFrame, group, clock: str, skew_safe: bool = False,
               partitions: int | None = None, event=None) -> DataFrame:
    """Distinct boundary clocks per group, numbered ``k = 1..n_b`` in time order,
    with the next boundary and the group's boundary count.

    ``event``, a part of the group's columns, makes all groups of one event
    share their boundaries: with groups (event, team), a change of either team
    ends the interval of both.

    ``skew_safe=True`` numbers them on range segments of (group, clock) instead
    of one window per group, gets ``n_b`` from an aggregate and the next
    boundary from an equi-join on ``(group, k + 1)``: a group with very many
    boundaries is spread over many tasks."""
    group = _cols(group)
    b = (changes.select(*group, F.col(clock).alias("b"))
         .unionByName(spans.select(*group, F.col("start").alias("b")))
         .unionByName(spans.select(*group, F.col("end").alias("b")))
         .filter(F.col("b").isNotNull()).distinct())
    if event is not None:
        event = _cols(event)
        b = spans.select(*group).distinct().join(b.select(*event, "b").distinct(), event)
    if skew_safe:
        from tempolith.operators import segmented as SG
        pos = SG.global_positions(SG.segment(b, group, ["b"], partitions), group, ["b"])
        pos = pos.select(*group, "b", F.col("_rn").cast("int").alias("k"))
        nxt = pos.select(*group, (F.col("k") - 1).alias("k"), F.col("b").alias("b_next"))
        cnt = b.groupBy(*group).agg(F.count(F.lit(1)).cast("int").alias("n_b"))
        return pos.join(nxt, group + ["k"], "left").join(cnt, group)
    w = Window.partitionBy(*group).orderBy("b")
    b = b.withColumns({"k": F.row_number().over(w), "b_next": F.lead("b", 1).over(w),
                       "n_b": F.count(F.lit(1)).over(Window.partitionBy(*group))})
    return b


def active_sets(changes: DataFrame, starters: DataFrame, spans: DataFrame, group, member: str,
                clock: str, is_in: str, credit: str = "before",
                bnd: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Members active in each interval.

    ``changes``: (group, member, clock, is_in); ``starters``: (group, member),
    active from the group start; ``spans``: (group, start, end).
    ``credit="before"`` uses the state after every change at or before the
    interval start; ``credit="after"`` the state after the changes at the
    interval end, ignoring changes at the very first boundary.
    Returns (boundaries, rows of (group, k, member)).
    """
    group = _cols(group)
    bnd = boundaries(changes, spans, group, clock) if bnd is None else bnd
    seeds = (starters.join(spans.select(*group, "start"), group)
             .select(*group, member, F.col("start").alias(clock), F.lit(True).alias(is_in), F.lit(0).alias("prio")))
    chg = changes.select(*group, member, clock, is_in,
                         F.when(F.col(is_in), F.lit(2)).otherwise(F.lit(1)).alias("prio"))
    allc = seeds.unionByName(chg).join(bnd.select(*group, F.col("b").alias(clock), "k", "n_b"), group + [clock])
    if credit == "after":
        allc = allc.filter((F.col("k") > 1) | (F.col("prio") == 0))
    # state per (group, member, boundary): the highest-priority change wins
    st = allc.groupBy(*group, member, "k", "n_b").agg(F.max_by(is_in, "prio").alias("on"))
    wm = Window.partitionBy(*group, member).orderBy("k")
    # the last state holds through the final boundary (index n_b)
    st = st.withColumn("k_next", F.coalesce(F.lead("k", 1).over(wm), F.col("n_b") + 1))
    st = st.filter("on")
    if credit == "after":
        lo, hi = F.greatest(F.col("k") - 1, F.lit(1)), F.least(F.col("k_next") - 2, F.col("n_b") - 1)
    else:
        lo, hi = F.col("k"), F.least(F.col("k_next") - 1, F.col("n_b") - 1)
    st = st.filter(hi >= lo)
    rows = st.select(*group, member, F.explode(F.sequence(lo, hi)).alias("k"))
    return bnd, rows


def active_intervals(changes: DataFrame, starters: DataFrame, spans: DataFrame, group, member: str,
                     clock: str, is_in: str, size: int | None = 5, credit: str = "before",
                     min_duration: float | None = None, sep: str = "-",
                     bnd: DataFrame | None = None, exclude: dict | None = None) -> DataFrame:
    """Interval table: (group, k, start, end, duration, members, lineup, n_active).

    Only intervals whose active set has exactly ``size`` members (if given) and
    that last at least ``min_duration`` are kept; ``exclude`` maps a group
    column to values whose intervals are dropped (known-bad events)."""
    group = _cols(group)
    bnd, rows = active_sets(changes, starters, spans, group, member, clock, is_in, credit, bnd)
    sets = rows.groupBy(*group, "k").agg(F.array_sort(F.collect_list(member)).alias("members"))
    iv = (bnd.filter(F.col("k") < F.col("n_b"))
          .select(*group, "k", F.col("b").alias("start"), F.col("b_next").alias("end"))
          .join(sets, group + ["k"], "left")
          .withColumn("members", F.coalesce("members", F.array().cast("array<long>"))))
    iv = iv.withColumns({"n_active": F.size("members"),
                         "lineup": F.array_join(F.transform("members", lambda m: m.cast("string")), sep)})
    iv = iv.withColumn("duration", F.col("end") - F.col("start"))
    if size is not None:
        iv = iv.filter(F.col("n_active") == size)
    if min_duration is not None:
        iv = iv.filter(F.col("duration") >= min_duration)
    for col, values in (exclude or {}).items():
        iv = iv.filter(~F.col(col).isin(list(values)))
    return iv


# C11 -----------------------------------------------------------------------------
def assign_intervals(events: DataFrame, bnd: DataFrame, group, time: str, bucket_width: float,
                     closed: str = "right", out: str = "k") -> DataFrame:
    """Interval index for each event: ``b_k < t <= b_{k+1}`` (``closed="right"``,
    an event at a boundary counts for the interval that ends there) or
    ``b_k <= t < b_{k+1}`` (``"left"``).  Events before the first boundary get NULL.

    Scalable form of a range join: events and boundaries are unioned and the
    last boundary index is forward-filled inside (group, time bucket); the
    boundary carried into a bucket comes from a small table of distinct
    (group, bucket) pairs, joined back on equality.
    """
    group = _cols(group)
    ev_cols = events.columns
    ev = events.withColumn("_t", F.col(time).cast("double"))
    ev = ev.withColumns({"_bk": F.floor(F.col("_t") / bucket_width), "_kind": F.lit(0)})
    tie = 1 if closed == "right" else -1          # boundary sorts after / before an event at the same time
    b = bnd.select(*group, F.col("k").cast("int").alias("_k"), F.col("b").cast("double").alias("_t"))
    b = b.withColumns({"_bk": F.floor(F.col("_t") / bucket_width), "_kind": F.lit(tie)})
    u = ev.unionByName(b, allowMissingColumns=True)
    w = Window.partitionBy(*group, "_bk").orderBy("_t", "_kind").rowsBetween(UNB, CUR)
    u = u.withColumn("_in", F.last("_k", ignorenulls=True).over(w)).filter(F.col("_kind") == 0)
    # last boundary of all earlier buckets, for every bucket that holds events or boundaries
    buckets = (ev.select(*group, "_bk").distinct().withColumn("_kmax", F.lit(None).cast("int"))
               .unionByName(b.groupBy(*group, "_bk").agg(F.max("_k").alias("_kmax")))
               .groupBy(*group, "_bk").agg(F.max("_kmax").alias("_kmax")))
    buckets = buckets.withColumn("_carry", F.max("_kmax").over(
        Window.partitionBy(*group).orderBy("_bk").rowsBetween(UNB, -1))).select(*group, "_bk", "_carry")
    u = u.join(buckets, group + ["_bk"], "left")
    return u.select(*ev_cols, F.coalesce("_in", "_carry").alias(out))


# D5, D6, D7 ---------------------------------------------------------------------
def on_off(intervals: DataFrame, group, counters: Sequence[str], member_out: str = "member") -> DataFrame:
    """Per (group, member): counters summed over intervals where the member is
    active (on_*) and over the group's other intervals (off_*).  The off side
    is group total minus on total, emitted only when the member sat out at
    least one interval (no explode of the complement)."""
    group = _cols(group)
    ex = intervals.select(*group, *counters, F.explode("members").alias(member_out))
    on = ex.groupBy(*group, member_out).agg(F.count(F.lit(1)).alias("n_on"),
                                            *[F.sum(c).alias(f"on_{c}") for c in counters])
    tot = intervals.groupBy(*group).agg(F.count(F.lit(1)).alias("n_total"),
                                        *[F.sum(c).alias(f"_t_{c}") for c in counters])
    j = on.join(tot, group)
    off = {f"off_{c}": F.when(F.col("n_on") < F.col("n_total"), F.col(f"_t_{c}") - F.col(f"on_{c}"))
           for c in counters}
    return j.withColumns(off).drop("n_total", *[f"_t_{c}" for c in counters])
