"""Skew-safe execution of per-key ordered computations.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task: a
key holding a third of all rows then holds a third of the job.  Here rows are
range-partitioned on (key, order), so a hot key's ordered series is cut into
*segments* (one per partition it spans); each segment is processed by its
own task, and whatever a segment needs from earlier ones travels through
small per-segment tables:

* running aggregates: per-segment totals, prefix-combined over segments;
* lags / rolling frames: the last ``H`` rows before a segment ("halo"),
  routed with an equi-join on ``segment_start = rn + j`` (j = 1..H);
* EWM: the segment's affine map (total decay, end value) composed over
  segments with the same decay-block scan used inside a segment;
* per-key ranks: a key with many rows is cut at quantiles of its values into
  buckets; ties share a bucket, so a rank is the rows of the buckets before
  plus the local rank.

A range boundary cuts at most one key, so only few keys ever need something
from an earlier segment.  ``Segments`` keeps their rows apart: what is carried
is computed from them alone and meets all rows as a broadcast table of at most
two rows per partition.  All other work is one lazy chain of windows over one
hash shuffle on (key, segment); only the rows of cut keys are checkpointed on
the way.  Results equal the plain window plans (tests compare them).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempolith.operators.windows import UNB, CUR, _cols

SEG = "_seg"
TASK_ROWS = 100_000    # rows of a segment and of a task of the window chain, whose rows grow wide
GROUP_ROWS = 2_000_000   # values of a group ranked by one task


def segment(df: DataFrame, key, order, partitions: int | None = None) -> DataFrame:
    """Range-partition on (key, order) and tag rows with their segment id.

    The tagged frame is checkpointed (reliably, in the shared checkpoint
    folder): the partition id is physical, and every later branch (segment
    totals, halo, windows) must see the same assignment; the checkpoint is
    also the stage boundary a lost executor restarts from."""
    from tempolith.session import cut_lineage
    cols = _cols(key) + _cols(order)
    r = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    return cut_lineage(r.withColumn(SEG, F.spark_partition_id()))


def global_positions(seg: DataFrame, key, order) -> DataFrame:
    """Add ``_rn`` (1-based position of the row in its key's series) and
    ``_seg_start`` (position of the segment's first row) to a segmented frame."""
    key, order = _cols(key), _cols(order)
    ws = Window.partitionBy(*key, SEG).orderBy(*order)
    loc = seg.withColumn("_lrn", F.row_number().over(ws))
    cnt = seg.groupBy(*key, SEG).agg(F.count(F.lit(1)).alias("_n"))
    off = cnt.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.partitionBy(*key).orderBy(SEG).rowsBetween(UNB, -1)), F.lit(0)))
    loc = loc.join(off.select(*key, SEG, "_off", "_n"), key + [SEG])
    return loc.withColumns({"_rn": F.col("_off") + F.col("_lrn"), "_seg_start": F.col("_off") + 1}) \
        .drop("_lrn", "_off")


# -- ranks within a group (hot dates) -----------------------------------------------------
def pct_rank_within(df: DataFrame, by, cols: Sequence[str], suffix: str = "_prank",
                    partitions: int | None = None, together: bool = False) -> DataFrame:
    """Average-tie percentile rank of each column within ``by`` (as
    ``windows.pct_rank_within``) without sending a group to one task.

    ``together`` ranks all columns at once: the frame is written (checkpointed)
    with a generated row id, so it is computed once; the columns' values are
    dealt by (by, column, bucket) once, and the ranks join back to the frame
    once, by the row id.  NULLs take no part, so a group's missing values are
    not dealt at all."""
    by = _cols(by)
    if not together:
        for c in cols:
            df = _rank_one(df, by, c, f"{c}{suffix}", partitions)
        return df
    from tempolith.session import cut_lineage
    row = "_row_id"
    df = cut_lineage(df.withColumn(row, F.monotonically_increasing_id()))
    return df.join(ranks_by_row(df, row, by, cols, suffix, partitions), row, "left").drop(row)


N_CUTS = 64        # a group is cut into at most so many buckets


def ranks_by_row(df: DataFrame, row: str, by, cols: Sequence[str], suffix: str = "_prank", partitions: int | None = None) -> DataFrame:
    """Average-tie percentile ranks within ``by`` by the unique column ``row``; ``df`` is read several times.

    A group with more rows than two partitions' share, or ``GROUP_ROWS``, is cut at approximate quantiles of its values. A bucket is the number
    of cuts below the value, so buckets keep the values' order and ties share one whatever the cuts are; the rows of the
    buckets before are counted exactly. Only those groups are read for cuts and counts, and only they have rows in the
    broadcast tables. A NULL in ``by`` gives no rank."""
    from tempolith.session import cut_lineage
    by = _cols(by)
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    present = F.lit(True)
    for b in by:
        present = present & F.col(b).isNotNull()
    values = F.inline(F.array(*[F.struct(F.lit(i).alias("_c"), F.col(c).cast("double").alias("_v")) for i, c in enumerate(cols)]))
    long = df.filter(present).select(row, *by, values).filter(F.col("_v").isNotNull())
    group = [*by, "_c"]
    sizes = cut_lineage(long.groupBy(*group).agg(F.count(F.lit(1)).alias("_tot")))
    share = max(min(2 * (sizes.agg(F.sum("_tot")).first()[0] or 0) // parts, GROUP_ROWS), 1)
    large = cut_lineage(sizes.filter(F.col("_tot") > share))
    if large.isEmpty():
        r, off, tot = long.withColumn("_b", F.lit(0)), F.lit(0), None
    else:
        cuts = long.join(F.broadcast(large), group).groupBy(*group).agg(
            F.max("_tot").alias("_tot"), F.percentile_approx("_v", [i / N_CUTS for i in range(1, N_CUTS)], 1000).alias("_q"))
        n = F.least(F.ceil(F.col("_tot") / share), F.lit(N_CUTS)).cast("int")
        cuts = cut_lineage(cuts.select(*group, "_tot", F.array_distinct(F.transform(
            F.sequence(F.lit(1), n - 1), lambda i: F.get("_q", F.floor(i * N_CUTS / n).cast("int") - 1))).alias("_q")))
        bucket = F.coalesce(F.size(F.filter("_q", lambda q: q < F.col("_v"))), F.lit(0)).alias("_b")
        counts = long.join(F.broadcast(cuts), group).select(*group, "_tot", bucket).groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_n"), F.max("_tot").alias("_tot"))
        before = cut_lineage(counts.select(*group, "_b", "_tot", F.coalesce(F.sum("_n").over(
            Window.partitionBy(*group).orderBy("_b").rowsBetween(UNB, -1)), F.lit(0)).alias("_off")))
        r = long.join(F.broadcast(cuts.select(*group, "_q")), group, "left").select(row, *group, "_v", F.when(F.col("_q").isNull(), 0).otherwise(bucket).alias("_b"))
        off, tot = F.coalesce("_off", F.lit(0)), "_tot"
    w = Window.partitionBy(*group, "_b").orderBy("_v")
    r = r.withColumns({"_lt": F.rank().over(w) - 1, "_le": F.count("_v").over(w), "_n": F.count("_v").over(w.rowsBetween(UNB, Window.unboundedFollowing))})
    if tot:
        r = r.join(F.broadcast(before), [*group, "_b"], "left")
    rank = (off * 2 + F.col("_lt") + 1 + F.col("_le")) / F.lit(2.0) / (F.coalesce(tot, "_n") if tot else F.col("_n"))
    return r.select(row, "_c", rank.alias("_r")).groupBy(row).agg(*[F.max(F.when(F.col("_c") == i, F.col("_r"))).alias(f"{c}{suffix}") for i, c in enumerate(cols)])


def left_join_nulls(df: DataFrame, other: DataFrame, key: Sequence[str]) -> DataFrame:
    """Left join on the key's columns where NULL meets NULL."""
    renamed = other.withColumnsRenamed({k: f"_o_{k}" for k in key})
    match = F.lit(True)
    for k in key:
        match = match & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    return df.join(renamed, match, "left").drop(*[f"_o_{k}" for k in key])


def without_nulls(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with a pair of columns for each key column, a value (a fixed one for NULL) and whether it is NULL, for steps
    that join on the key; and their names."""
    added, names = {}, []
    for c in cols:
        kind = df.schema[c].dataType
        blank = "1970-01-01" if kind.typeName() in ("date", "timestamp", "timestamp_ntz") else "false" if kind.typeName() == "boolean" else "0"
        added |= {f"_v_{c}": F.coalesce(F.col(c), F.lit(blank).cast(kind)), f"_z_{c}": F.col(c).isNull()}
        names += [f"_v_{c}", f"_z_{c}"]
    return df.withColumns(added), names


def _rank_one(df: DataFrame, by: list[str], c: str, out: str, partitions: int | None) -> DataFrame:
    r = segment(df, by, [c], partitions)
    w = Window.partitionBy(*by, SEG).orderBy(F.col(c).asc_nulls_last())
    r = r.withColumns({"_lt": F.rank().over(w) - 1, "_le": F.count(c).over(w)})
    cnt = r.groupBy(*by, SEG).agg(F.count(c).alias("_n"))
    cnt = cnt.withColumns({
        "_off": F.coalesce(F.sum("_n").over(Window.partitionBy(*by).orderBy(SEG).rowsBetween(UNB, -1)), F.lit(0)),
        "_tot": F.sum("_n").over(Window.partitionBy(*by))})
    r = r.join(cnt.drop("_n"), by + [SEG])
    avg_rank = (F.col("_off") * 2 + F.col("_lt") + 1 + F.col("_le")) / F.lit(2.0)
    return r.withColumn(out, F.when(F.col(c).isNotNull(), avg_rank / F.col("_tot"))) \
        .drop(SEG, "_lt", "_le", "_off", "_tot")


# -- rows on segments, and the rows of cut keys apart -----------------------------------------
@dataclass
class Segments:
    """``rows``: all rows, lazily; ``cut``: the rows of the keys that a segment boundary cuts, with the same columns.
    A step computes what segments hand on from ``cut`` and adds it to both."""
    rows: DataFrame
    cut: DataFrame

    def then(self, step: Callable[[DataFrame], DataFrame]) -> Segments:
        return Segments(step(self.rows), step(self.cut))

    def carry(self, table: DataFrame, on: Sequence[str]) -> Segments:
        """Left join of what segments hand on: a row per segment of a cut key, at most two per partition."""
        from tempolith.session import cut_lineage
        table = F.broadcast(cut_lineage(table))
        return self.then(lambda d: d.join(table, list(on), "left"))

    def stage(self, whole: bool = False) -> Segments:
        """Checkpoint the rows of cut keys, which the next steps read again; with ``whole`` all rows, which keeps the plan
        of many metrics small."""
        from tempolith.session import cut_lineage
        return Segments(cut_lineage(self.rows) if whole else self.rows, cut_lineage(self.cut))


def _before(key) -> Window:
    """The earlier segments of a key, in a table with a row per segment."""
    return Window.partitionBy(*_cols(key)).orderBy(SEG).rowsBetween(UNB, -1)


def _cut_groups(rows: DataFrame, key, *aggs) -> DataFrame:
    """The groups with rows in several segments."""
    return rows.groupBy(*_cols(key)).agg(F.min(SEG).alias("_a"), F.max(SEG).alias("_z"), *aggs).filter("_a < _z").drop("_a", "_z")


# -- running aggregates, lags and rolling frames ---------------------------------------------
def running_features(df: DataFrame, key, order, cols: Sequence[str], lags=(1, 2), roll: int = 5,
                     partitions: int | None = None, join: Callable[[DataFrame], DataFrame] | None = None) -> Segments:
    """Lags, expanding mean/std/max/min of prior rows and rolling-``roll``
    statistics (same definitions as ``windows.lags/expanding/rolling``),
    computed per segment.  Adds ``_rn``, ``_seg_start``, the segment and each
    column's first value ``_{c}_x0`` for the steps after it (``HELPERS``).
    ``join`` adds columns that no later step hands on: it runs once, on the
    checkpointed narrow rows, where ``df`` itself is read for its row count,
    the range bounds and the shuffle."""
    from tempolith.session import cut_lineage
    key, order = _cols(key), _cols(order)
    h = max(max(lags) if lags else 0, roll, 1)
    if not partitions:       # by rows: sizes of narrow shuffled rows say little about the wide rows of the windows
        n = df.count()
        partitions = max(math.ceil(n / TASK_ROWS), min(df.sparkSession.sparkContext.defaultParallelism, math.ceil(n / 1000)), 1)
    base = segment(df, key, order, partitions)
    keys = cut_lineage(_cut_groups(base, key))
    cut = cut_lineage(base.join(F.broadcast(keys), key, "left_semi"))
    # -- positions and each key's first non-NULL value (the same shift the plain EWM uses, so values that are exactly
    #    equal there - e.g. the first EWM mean and its input - stay equal), then the halo: rows that lags and rolling
    #    frames need from before the segment's start, marked by their distance from it
    pos = cut_lineage(global_positions(cut, key, order))
    halo = cut_lineage(_halo_rows(pos, key, [*order, *cols], h).withColumn("_halo", F.col("_rn") - F.col("_seg_start")).drop("_rn", "_seg_start"))
    first = pos.groupBy(*key, SEG).agg(
        F.min("_seg_start").alias("_first"), *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_rn"))).alias(f"_{c}_k0") for c in cols])
    wk = Window.partitionBy(*key).orderBy(SEG).rowsBetween(UNB, Window.unboundedFollowing)
    first = first.withColumns({f"_{c}_k0": F.first(f"_{c}_k0", ignorenulls=True).over(wk) for c in cols})
    first = first.join(halo.groupBy(*key, SEG).agg(F.count(F.lit(1)).alias("_nh")), [*key, SEG], "left")
    seg = Segments(join(base) if join else base, cut).then(lambda d: d.withColumn("_halo", F.lit(0).cast("long")).unionByName(halo, allowMissingColumns=True)
                                   .repartition(partitions, *key, SEG))
    seg = seg.carry(first, [*key, SEG])
    ws = Window.partitionBy(*key, SEG).orderBy("_halo", *order)
    wa = ws.rowsBetween(UNB, Window.unboundedFollowing)
    seg = seg.then(lambda d: d.withColumns({
        "_rn": F.coalesce("_first", F.lit(1)) - 1 - F.coalesce("_nh", F.lit(0)) + F.row_number().over(ws), "_seg_start": F.coalesce("_first", F.lit(1)),
        **{f"_{c}_x0": F.coalesce(f"_{c}_k0", F.first(c, ignorenulls=True).over(wa)) for c in cols}}).drop("_first", "_nh", *[f"_{c}_k0" for c in cols])).stage()
    # -- expanding: prefix of per-segment totals of the shifted values
    own = seg.cut.filter("_halo = 0")
    seg_tot = own.groupBy(*key, SEG).agg(*[
        a for c in cols for a in (
            F.count(c).alias(f"_{c}_n"), F.sum(F.col(c) - F.col(f"_{c}_x0")).alias(f"_{c}_s"),
            F.sum(F.pow(F.col(c) - F.col(f"_{c}_x0"), 2)).alias(f"_{c}_q"),
            F.max(c).alias(f"_{c}_mx"), F.min(c).alias(f"_{c}_mn"))])
    wp = _before(key)
    seg = seg.carry(seg_tot.select(*key, SEG, *[
        F.coalesce(F.sum(f"_{c}_{s}").over(wp), F.lit(0)).alias(f"_{c}_p{s}") for c in cols for s in ("n", "s", "q")
    ], *[F.max(f"_{c}_mx").over(wp).alias(f"_{c}_pmx") for c in cols],
        *[F.min(f"_{c}_mn").over(wp).alias(f"_{c}_pmn") for c in cols]), [*key, SEG])
    w = Window.partitionBy(*key, SEG).orderBy("_rn")
    wl = w.rowsBetween(UNB, -1)
    wr = w.rowsBetween(-max(roll, 1), -1)
    # every window expression once, as a column: Spark evaluates one that is written twice twice
    out = {}
    for c in cols:
        for k in lags:
            out[f"{c}_lag{k}"] = F.lag(c, k).over(w)
        # local running sums over non-halo rows only, plus the prefix of earlier segments
        local = F.when(F.col("_halo") == 0, F.col(c))
        xs = local - F.col(f"_{c}_x0")
        out[f"_{c}_en"] = F.coalesce(F.count(local).over(wl), F.lit(0)) + F.coalesce(F.col(f"_{c}_pn"), F.lit(0))
        out[f"_{c}_es"] = F.coalesce(F.sum(xs).over(wl), F.lit(0.0)) + F.coalesce(F.col(f"_{c}_ps"), F.lit(0.0))
        out[f"_{c}_eq"] = F.coalesce(F.sum(xs * xs).over(wl), F.lit(0.0)) + F.coalesce(F.col(f"_{c}_pq"), F.lit(0.0))
        out[f"{c}_exp_max"] = F.greatest(F.max(local).over(wl), F.col(f"_{c}_pmx"))
        out[f"{c}_exp_min"] = F.least(F.min(local).over(wl), F.col(f"_{c}_pmn"))
        if roll >= 2:                                   # a rolling block is requested
            out |= {f"_{c}_r{name}": f(c).over(wr) for name, f in _ROLLED.items()}
            out |= {f"_{c}_l{k}": F.lag(c, k).over(w) for k in range(1, roll + 1) if k not in lags}
    fin = {}
    for c in cols:
        n, s, q = F.col(f"_{c}_en"), F.col(f"_{c}_es"), F.col(f"_{c}_eq")
        fin[f"{c}_exp_mean"] = F.when(n > 0, F.try_divide(s, n) + F.col(f"_{c}_x0"))
        var = F.try_divide(q - F.try_divide(s * s, n), n - 1)
        fin[f"{c}_exp_std"] = F.when(n > 1, F.sqrt(F.greatest(var, F.lit(0.0))))
        if roll < 2:
            continue
        full, mean_r = F.col(f"_{c}_rn") == roll, F.col(f"_{c}_rmean")
        lagk = [F.col(f"{c}_lag{k}" if k in lags else f"_{c}_l{k}") for k in range(roll, 0, -1)]          # oldest .. newest
        xs_c = [(i - (roll - 1) / 2.0) for i in range(roll)]
        fin[f"{c}_roll_mad"] = F.when(full, sum((F.abs(v - mean_r) for v in lagk), F.lit(0.0)) / F.lit(float(roll)))
        fin[f"{c}_roll_trend"] = F.when(full, sum((v * F.lit(x) for v, x in zip(lagk, xs_c)), F.lit(0.0))
                                        / F.lit(sum(x * x for x in xs_c)))
        fin |= {f"{c}_roll_{name}": F.when(full, F.col(f"_{c}_r{name}")) for name in _ROLLED if name != "n"}
    helper = ["_halo"] + [f"_{c}_{s}" for c in cols for s in ("pn", "ps", "pq", "pmx", "pmn", "en", "es", "eq",
                                                              *[f"r{name}" for name in _ROLLED], *[f"l{k}" for k in range(1, roll + 1)])]
    return seg.then(lambda d: d.withColumns(out).filter("_halo = 0").withColumns(fin).drop(*helper)).stage()


#: Aggregates of the rolling frames.
_ROLLED = {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "max": F.max, "min": F.min}
#: What ``running_features`` adds for later steps, besides ``_{c}_x0`` of each column.
HELPERS = ("_rn", "_seg_start", SEG)


def _halo_rows(pos: DataFrame, key, cols: Sequence[str], h: int) -> DataFrame:
    """Halo rows for each segment: the ``h`` rows preceding its first row, wherever
    they live, received through an equi-join on the receiving segment's start."""
    key = _cols(key)
    last_rows = pos.filter(F.col("_rn") >= F.col("_seg_start") + F.col("_n") - h)
    t = last_rows.select(*key, "_rn", *cols, F.explode(F.sequence(F.lit(1), F.lit(h))).alias("_j"))
    t = t.withColumn("_target", F.col("_rn") + F.col("_j")).drop("_j")
    starts = pos.select(*key, SEG, F.col("_seg_start").alias("_target"), "_seg_start").distinct()
    return t.join(starts, key + ["_target"]).drop("_target")


# -- EWM across segments ---------------------------------------------------------------------
def ewm_on_segments(seg: Segments, key, x: str, shift: str, alpha: float, mean_out: str,
                    std_out: str) -> Segments:
    """Recursive EWM mean / bias-corrected std of ``x`` on the rows of ``running_features``.

    Each segment is solved locally from a zero state with the decay-block scan;
    the segments' affine maps (total log-decay ``D``, local end value ``E``)
    are composed over the small table of cut keys' segments with the same scan; each
    row then adds ``exp(L_local) * Y_before``.  Same recurrences as
    ``ewm.ewm_moments``."""
    from tempolith.operators.ewm import W2_TOL, _over, _q, affine_scan, BEFORE, RUNNING
    key = _cols(key)
    part, order = key + [SEG], ["_rn"]
    ln_d, a = repr(math.log1p(-alpha)), repr(alpha)
    t = f"sg_{mean_out}"
    qx = _q(x)
    # gap to the previous observation, looking across segments
    seg_last = seg.cut.groupBy(*key, SEG).agg(F.max(F.when(F.col(x).isNotNull(), F.col("_rn"))).alias("_lo"),
                                              F.count(x).alias("_no"))
    wp = _before(key)
    seg = seg.carry(seg_last.select(*key, SEG, F.max("_lo").over(wp).alias(f"_{t}_plo"), F.sum("_no").over(wp).alias(f"_{t}_pno")), part)
    g, seen = f"_{t}_g", f"_{t}_seen"
    last_local = f"last(CASE WHEN {qx} IS NOT NULL THEN `_rn` END, true) {_over(part, order, BEFORE)}"
    gaps = {
        g: F.expr(f"CAST(`_rn` - coalesce({last_local}, `_{t}_plo`) AS DOUBLE)"),
        seen: F.expr(f"count({qx}) {_over(part, order, RUNNING)} + coalesce(`_{t}_pno`, 0)")}
    qg = _q(g)
    later, first = f"({qx} IS NOT NULL AND {qg} IS NOT NULL)", f"({qx} IS NOT NULL AND {qg} IS NULL)"
    old = f"exp({qg} * {ln_d})"
    log_a = f"(CASE WHEN {later} THEN {qg} * {ln_d} - ln({old} + {a}) ELSE 0D END)"
    b = f"(CASE WHEN {later} THEN {a} / ({old} + {a}) WHEN {first} THEN 1D ELSE 0D END)"
    aa = f"(CASE WHEN {later} THEN {old} / ({old} + {a}) ELSE 0D END)"
    xs = f"({qx} - {_q(shift)})"

    def compose(seg, cols_pows, tag):
        """Add the state entering each segment (kept as ``_{tag}_in{i}``) per (local column, power)."""
        L = f"_{tag}_L"
        ends = seg.cut.groupBy(*key, SEG).agg(F.max_by(L, "_rn").alias("_D"), *[F.max_by(c, "_rn").alias(f"_E{i}") for i, (c, _) in enumerate(cols_pows)])
        ends = affine_scan(ends, key, [SEG], "`_D`", [(f"`_E{i}`", p, f"_Y{i}") for i, (_, p) in enumerate(cols_pows)], tag=f"{tag}s")
        wseg = Window.partitionBy(*key).orderBy(SEG)
        seg = seg.carry(ends.select(*key, SEG, *[F.lag(f"_Y{i}", 1).over(wseg).alias(f"_{tag}_in{i}") for i in range(len(cols_pows))]), part)
        return seg.then(lambda d: d.withColumns({c: F.col(c) + F.coalesce(F.exp(F.lit(p) * F.col(L)) * F.col(f"_{tag}_in{i}"), F.lit(0.0))
                                                 for i, (c, p) in enumerate(cols_pows)}))

    m, mp, entering = f"_{t}_m", f"_{t}_mp", f"_{t}_in0"
    seg = compose(seg.then(lambda d: affine_scan(d.withColumns(gaps), part, order, log_a, [(f"{b} * {xs}", 1, m)], tag=t)).stage(), [(m, 1)], t)
    ok = f"{_q(seen)} > 0"
    # previous carried mean: inside the segment a lag, at its first row the mean that enters it
    lag = f"CASE WHEN `_rn` = `_seg_start` THEN {_q(entering)} ELSE lag({_q(m)}, 1) {_over(part, [f'_{t}_K'] + order)} END"
    seg = seg.then(lambda d: d.withColumns({mean_out: F.expr(f"CASE WHEN {ok} THEN {_q(m)} + {_q(shift)} END"), mp: F.expr(lag)}).drop(entering))
    c_, u_ = f"_{t}_c", f"_{t}_u"
    dev = f"({xs} - {_q(mp)})"
    terms = [(f"{aa} * {b} * {dev} * {dev}", 1, c_), (f"2D * {aa} * {b}", 2, u_)]
    seg = compose(seg.then(lambda d: affine_scan(d, part, order, log_a, terms, tag=t)).stage(), [(c_, 1), (u_, 2)], t)
    std = F.expr(f"CASE WHEN {ok} AND {_q(u_)} > {W2_TOL} THEN sqrt({_q(c_)} / {_q(u_)}) END")
    return seg.then(lambda d: d.withColumn(std_out, std).drop(
        m, mp, c_, u_, g, seen, f"_{t}_plo", f"_{t}_pno", f"_{t}_L", f"_{t}_K", f"_{t}_in0", f"_{t}_in1")).stage()


# -- per-season prefix features on a segmented frame -------------------------------------------
def lag_across(seg: Segments, key, cols: Sequence[str], suffix: str = "_prev", rising: Sequence[str] = ()) -> Segments:
    """Previous row's value of each column in the key's series: a lag inside the
    segment, and at a segment's first row the previous segment's last value.
    ``rising``: columns that the series was ordered by first; windows of other
    steps that have them among their keys then share this one's sort."""
    key = _cols(key)
    w = Window.partitionBy(*key, SEG).orderBy(*rising, "_rn")
    ends = seg.cut.groupBy(*key, SEG).agg(*[F.max_by(c, "_rn").alias(f"_end_{c}") for c in cols])
    wseg = Window.partitionBy(*key).orderBy(SEG)
    seg = seg.carry(ends.select(*key, SEG, *[F.lag(f"_end_{c}", 1).over(wseg).alias(f"_in_{c}") for c in cols]), key + [SEG])
    first = F.col("_rn") == F.col("_seg_start")
    return seg.then(lambda d: d.withColumns({f"{c}{suffix}": F.when(first, F.col(f"_in_{c}")).otherwise(F.lag(c, 1).over(w)) for c in cols})
                    .drop(*[f"_in_{c}" for c in cols]))


def season_features(seg: Segments, key, season: str, date: str, y: str, flags: dict[str, str],
                    slope_out: str, slope_min_rows: int = 21, rtol: float = 1e-5,
                    atol: float = 1e-8, rising: Sequence[str] = ()) -> Segments:
    """Within (key, season) on segments: rest days and back-to-back
    flag, run length of each flag ending at the previous row (``flags`` maps
    flag column -> output), and the expanding OLS slope of ``y`` on the row
    position (same guards as ``windows.trend_slope``).  Earlier segments
    contribute through per-(key, season, segment) totals."""
    key = _cols(key)
    ks = key + [season]
    seg = lag_across(seg, key, [date, season] + list(flags), rising=rising)
    same = F.col(f"{season}_prev") == F.col(season)
    seg = seg.then(lambda d: d.withColumn("rest_days", F.when(same, F.datediff(F.col(date), F.col(f"{date}_prev"))))
                   .withColumn("back_to_back", F.coalesce(F.col("rest_days") == 1, F.lit(False)).cast("int")))
    # per-(key, season) constants: first position and a value shift for well-conditioned sums
    seg = seg.carry(_cut_groups(seg.cut, ks, F.min("_rn").alias("_c0"), F.max(y).alias("_cy")), ks)
    run = Window.partitionBy(*key, SEG, season).orderBy("_rn").rowsBetween(UNB, CUR)
    whole = run.rowsBetween(UNB, Window.unboundedFollowing)
    seg = seg.then(lambda d: d.withColumns({"_s0": F.coalesce("_c0", F.min("_rn").over(whole)), "_yc": F.coalesce("_cy", F.max(y).over(whole))}).drop("_c0", "_cy"))
    has = F.col(y).isNotNull()
    xp = (F.col("_rn") - F.col("_s0")).cast("double")
    yp = F.col(y) - F.col("_yc")
    parts = {"_sn": F.when(has, F.lit(1.0)), "_sx": F.when(has, xp), "_sy": yp, "_sxy": yp * xp,
             "_sxx": F.when(has, xp * xp)}
    restarts = {f: F.when(~F.coalesce(same & (F.col(f"{f}_prev") == 1), F.lit(False)), F.col("_rn"))
                for f in flags}
    seg = seg.then(lambda d: d.withColumns({**parts, **{f"_rs_{f}": e for f, e in restarts.items()}})).stage()
    tot = seg.cut.groupBy(*ks, SEG).agg(
        *[F.sum(c).alias(c) for c in parts], F.max(y).alias("_mx"), F.min(y).alias("_mn"),
        F.min_by(y, F.when(has, F.col("_rn"))).alias("_y0"), F.min(F.when(has, F.col("_rn"))).alias("_y0rn"),
        *[F.max(f"_rs_{f}").alias(f"_rs_{f}") for f in flags])
    wsp = _before(ks)
    tot = tot.select(*ks, SEG, F.count(F.lit(1)).over(wsp).alias("_np"), *[F.sum(c).over(wsp).alias(f"_p{c}") for c in parts],
                     F.max("_mx").over(wsp).alias("_pmx"), F.min("_mn").over(wsp).alias("_pmn"),
                     F.min_by("_y0", "_y0rn").over(wsp).alias("_py0"),
                     *[F.max(f"_rs_{f}").over(wsp).alias(f"_prs_{f}") for f in flags])
    seg = seg.carry(tot.filter("_np > 0").drop("_np"), ks + [SEG])
    # every window expression once, as a column, as in running_features
    run_out = {f"_t{c}": F.coalesce(F.sum(c).over(run), F.lit(0.0)) + F.coalesce(F.col(f"_p{c}"), F.lit(0.0)) for c in parts}
    run_out |= {"_ty0": F.coalesce(F.col("_py0"), F.first(y, ignorenulls=True).over(run)),
                "_thi": F.greatest(F.max(y).over(run), F.col("_pmx")), "_tlo": F.least(F.min(y).over(run), F.col("_pmn"))}
    n, sx, sy, sxy, sxx = (F.col(f"_t{c}") for c in ("_sn", "_sx", "_sy", "_sxy", "_sxx"))
    y0, hi, lo = F.col("_ty0"), F.col("_thi"), F.col("_tlo")
    slope = F.try_divide(sxy - F.try_divide(sx * sy, n), sxx - F.try_divide(sx * sx, n))
    ok = ((F.col("_rn") - F.col("_s0") + 1 >= slope_min_rows) & (n >= 3) & F.col(season).isNotNull()
          & (F.greatest(hi - y0, y0 - lo) > F.lit(atol) + F.lit(rtol) * F.abs(y0)))
    res = {slope_out: F.when(ok, slope)}
    for f, name in flags.items():
        run_out[f"_t{f}"] = F.coalesce(F.max(f"_rs_{f}").over(run), F.col(f"_prs_{f}"))
        res[name] = (F.col("_rn") - F.col(f"_t{f}")).cast("int")
    drop = ["_s0", "_yc", "_pmx", "_pmn", "_py0", f"{date}_prev", f"{season}_prev", *parts,
            *[f"_p{c}" for c in parts], *run_out]
    drop += [c for f in flags for c in (f"_rs_{f}", f"_prs_{f}", f"{f}_prev")]
    return seg.then(lambda d: d.withColumns(run_out).withColumns(res).drop(*drop))


def sum_on_segments(seg: Segments, key, col: str, out: str, rising: Sequence[str] = ()) -> Segments:
    """Running sum (current row included) of ``col`` over the key's whole series; ``rising`` as in ``lag_across``."""
    key = _cols(key)
    w = Window.partitionBy(*key, SEG).orderBy(*rising, "_rn").rowsBetween(UNB, CUR)
    tot = seg.cut.groupBy(*key, SEG).agg(F.sum(col).alias("_t"))
    seg = seg.carry(tot.select(*key, SEG, F.sum("_t").over(_before(key)).alias("_pt")), key + [SEG])
    return seg.then(lambda d: d.withColumn(out, F.sum(col).over(w) + F.coalesce("_pt", F.lit(0))).drop("_pt"))


def count_last_days(df: DataFrame, key, date: str, days: int = 7, out: str = "n_last_days") -> DataFrame:
    """Distinct active dates in ``(date - days, date]`` per key, computed on the
    distinct (key, date) table - small even for a hot key (one row per day) -
    and joined back on (key, date)."""
    from tempolith.operators.windows import count_last_days as per_key
    key = _cols(key)
    dd = df.select(*key, date).distinct()
    dd = per_key(dd, key, date, days=days, out=out)
    return left_join_nulls(df, dd, key + [date])


def running_sum_across(rows: DataFrame, key, col: str, out: str) -> DataFrame:
    """Running sum (current row included) of ``col`` over the key's whole series."""
    key = _cols(key)
    w = Window.partitionBy(*key, SEG).orderBy("_rn").rowsBetween(UNB, CUR)
    seg = rows.groupBy(*key, SEG).agg(F.sum(col).alias("_t"))
    seg = seg.select(*key, SEG, F.coalesce(F.sum("_t").over(
        Window.partitionBy(*key).orderBy(SEG).rowsBetween(UNB, -1)), F.lit(0)).alias("_pt"))
    rows = rows.join(seg, key + [SEG], "left")
    # no stage boundary here: callers follow with a checkpointed stage, and one
    # small join on top of a checkpointed frame keeps the plan small
    return rows.withColumn(out, F.sum(col).over(w) + F.col("_pt")).drop("_pt")
