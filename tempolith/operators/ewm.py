"""Exponentially weighted features as native window plans.

The recursive EWM (``adjust=False``, gaps decay, value carried through
NULLs) is a first-order linear recurrence ``y_i = a_i * y_{i-1} + c_i``.
Its closed form ``y_i = sum_j c_j * exp(L_i - L_j)`` with ``L`` the running
sum of ``ln a`` turns it into running sums, i.e. ordinary window aggregates.

To stay exact on arbitrarily long series (``exp(-L)`` would overflow after a
few thousand rows) the rows of a series are cut into *decay blocks* of
``BLOCK`` nats (``k = floor(-L / BLOCK)``).  Inside a block all exponents are
bounded by ``BLOCK``; across blocks the contribution of the block before is
added through the block's last row.  A block three or more back has decayed
by more than ``2*BLOCK`` nats and contributes below 1e-260 relative, so three
previous block ends give the double-precision result.  Blocks are nested in
the entity partition, so no extra exchange is planned — only one local sort.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempolith.operators.windows import UNB, CUR, _cols, pct_rank_expr

BLOCK = 300.0      # nats per decay block (exp(2*BLOCK) still fits a double)
N_PREV_ENDS = 3    # previous block ends that can still matter in double precision
EPS = 1e-6         # stabiliser in z-score style denominators
W2_TOL = 1.2e-16   # 1 - sum(w^2) below half an ulp of 1 counts as zero (no spread yet)


def alpha_from_span(span: float) -> float:
    return 2.0 / (span + 1.0)


def _q(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def _over(part: Sequence[str], order: Sequence[str], frame: str | None = None) -> str:
    o = f" ORDER BY {', '.join(_q(c) for c in order)}" if order else ""
    f = f" {frame}" if frame else ""
    return f"OVER (PARTITION BY {', '.join(_q(c) for c in part)}{o}{f})"


RUNNING = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def affine_scan(df: DataFrame, part: Sequence[str], order: Sequence[str], log_a: str,
                terms: Sequence[tuple[str, int, str]], tag: str) -> DataFrame:
    """Solve ``y_i = exp(p*log_a_i) * y_{i-1} + c_i`` (y before the first row = 0).

    ``log_a`` (<= 0) and each ``c`` are SQL expressions; ``terms`` holds
    ``(c, p, output_column)`` sharing the decay scaled by the integer power
    ``p`` (1 or 2).  Adds the block id ``_{tag}_K``; every window after the
    first sorts by (part, K, order), so the scan costs one extra local sort.
    Expressions are built as SQL text: one JVM call per column.
    """
    L, K, end = f"_{tag}_L", f"_{tag}_K", f"_{tag}_end"
    qL, qK = _q(L), _q(K)
    if L not in df.columns:            # a second scan with the same decay reuses L and K (and the sort)
        df = df.withColumn(L, F.expr(f"sum({log_a}) {_over(part, order, RUNNING)}"))
        df = df.withColumn(K, F.expr(f"floor(-{qL} / {BLOCK})"))
    # in-block running sums (exponents bounded by p*BLOCK) and the block-end flag, in one window
    wk = _over(list(part) + [K], order, RUNNING)
    inner = {end: F.expr(f"lead(true, 1) {_over(list(part) + [K], order)} IS NULL")}
    ref = f"(-{qK} * {BLOCK})"
    for c, p, out in terms:
        inner[f"_{out}_in"] = F.expr(
            f"exp({p} * ({qL} - {ref})) * sum(coalesce({c}, 0D) * exp({p} * ({ref} - {qL}))) {wk}")
    df = df.withColumns(inner)
    # (L, in-block values) at the last rows of the previous N_PREV_ENDS blocks, in one window
    fields = ", ".join([f"{qL} AS l"] + [f"{_q('_' + out + '_in')} AS v{i}" for i, (_, _, out) in enumerate(terms)])
    ends = [f"_{tag}_e{m}" for m in range(1, N_PREV_ENDS + 1)]
    prev = _over(part, [K] + list(order))
    df = df.withColumns({e: F.expr(f"lag(CASE WHEN {_q(end)} THEN struct({fields}) END, {m}) IGNORE NULLS {prev}")
                         for m, e in enumerate(ends, 1)})
    outs = {}
    for i, (_, p, out) in enumerate(terms):
        parts = [_q(f"_{out}_in")] + [f"coalesce({_q(e)}.v{i} * exp({p} * ({qL} - {_q(e)}.l)), 0D)" for e in ends]
        outs[out] = F.expr(" + ".join(parts))
    df = df.withColumns(outs)
    return df.drop(end, *ends, *[f"_{out}_in" for _, _, out in terms])


def ewm_moments(df: DataFrame, x: str, part: Sequence[str], order: Sequence[str], alpha: float,
                mean_out: str, std_out: str | None = None, keep_block: str | None = None) -> DataFrame:
    """Recursive EWM mean (and bias-corrected std) of column ``x``.

    Rows before the first non-NULL value stay NULL; NULL rows carry the last
    value; a gap of ``g`` rows decays the old weight by ``(1-alpha)**g``.

    With ``A = old/(old+alpha)``, ``B = alpha/(old+alpha)`` per observation:
    mean  m_i = A m_{i-1} + B x_i;
    cov   c_i = A c_{i-1} + A B (x_i - m_{i-1})^2;
    u_i = 1 - sum w^2 = A^2 u_{i-1} + 2 A B.
    Every term is non-negative, so even after long NULL gaps (where u is
    ~1e-15) var = c / u keeps full precision.  The mean is one scan, cov and u
    a second scan on the same decay blocks (no extra sort).  ``x`` is shifted
    by the series' first value for accuracy.  With ``keep_block`` the block id
    is kept so later windows can order by ``(block, order)``.
    """
    part, order = _cols(part), _cols(order)
    ln_d, a = repr(math.log1p(-alpha)), repr(alpha)
    t = f"ewm_{mean_out}"
    qx = _q(x)
    rn, seen, x0, g = (f"_{t}_{n}" for n in ("rn", "seen", "x0", "g"))
    qrn, qg = _q(rn), _q(g)
    df = df.withColumns({rn: F.expr(f"row_number() {_over(part, order)}"),
                         seen: F.expr(f"count({qx}) {_over(part, order, RUNNING)}"),
                         x0: F.expr(f"first({qx}, true) {_over(part, order, RUNNING)}")})
    df = df.withColumn(g, F.expr(
        f"CAST({qrn} - last(CASE WHEN {qx} IS NOT NULL THEN {qrn} END, true) {_over(part, order, BEFORE)} AS DOUBLE)"))
    later = f"({qx} IS NOT NULL AND {qg} IS NOT NULL)"
    first = f"({qx} IS NOT NULL AND {qg} IS NULL)"
    old = f"exp({qg} * {ln_d})"                       # (1-alpha)^g, underflows gracefully
    log_a = f"(CASE WHEN {later} THEN {qg} * {ln_d} - ln({old} + {a}) ELSE 0D END)"
    b = f"(CASE WHEN {later} THEN {a} / ({old} + {a}) WHEN {first} THEN 1D ELSE 0D END)"
    aa = f"(CASE WHEN {later} THEN {old} / ({old} + {a}) ELSE 0D END)"
    xs = f"({qx} - {_q(x0)})"
    mean_c = f"_{t}_m"
    df = affine_scan(df, part, order, log_a, [(f"{b} * {xs}", 1, mean_c)], tag=t)
    ok = f"{_q(seen)} > 0"
    m = _q(mean_c)
    df = df.withColumn(mean_out, F.expr(f"CASE WHEN {ok} THEN {m} + {_q(x0)} END"))
    drop = [rn, seen, x0, g, mean_c, f"_{t}_L"]
    if std_out:
        K = f"_{t}_K"
        mprev = f"_{t}_mp"
        df = df.withColumn(mprev, F.expr(f"lag({m}, 1) {_over(part, [K] + order)}"))
        dev = f"({xs} - {_q(mprev)})"
        terms = [(f"{aa} * {b} * {dev} * {dev}", 1, f"_{t}_c"), (f"2D * {aa} * {b}", 2, f"_{t}_u")]
        df = affine_scan(df, part, order, log_a, terms, tag=t)
        c, u = _q(f"_{t}_c"), _q(f"_{t}_u")
        # u below half an ulp of 1 is where a direct evaluation of 1 - sum w^2 rounds to 0
        df = df.withColumn(std_out, F.expr(f"CASE WHEN {ok} AND {u} > {W2_TOL} THEN sqrt({c} / {u}) END"))
        drop += [mprev, f"_{t}_c", f"_{t}_u"]
    if keep_block:
        df = df.withColumnRenamed(f"_{t}_K", keep_block)
    else:
        drop.append(f"_{t}_K")
    return df.drop(*drop)


# W7 - W11 -----------------------------------------------------------------------
def ewm(df: DataFrame, cols: Sequence[str], entity, order, span: float = 21, date: str | None = None) -> DataFrame:
    """EWM block over ``prev = lag(x)``: mean, std, z-score, above-mean flag,
    running surge count, reversion score, absolute deviation, and (if
    ``date`` is given) the per-date percentile rank of the mean."""
    entity, order = _cols(entity), _cols(order)
    alpha = alpha_from_span(span)
    w = Window.partitionBy(*entity).orderBy(*order)
    for c in cols:
        prev = f"_{c}_prev"
        df = df.withColumn(prev, F.lag(c, 1).over(w))
        m, s = f"{c}_ewm_mean", f"{c}_ewm_std"
        blk = f"_{c}_blk"
        df = ewm_moments(df, prev, entity, order, alpha, m, s, keep_block=blk)
        diff = F.col(prev) - F.col(m)
        above = F.coalesce(F.col(prev) > F.col(m), F.lit(False)).cast("int")
        df = df.withColumns({
            f"{c}_ewm_z": diff / (F.col(s) + F.lit(EPS)),
            f"{c}_ewm_above": above,
            f"{c}_ewm_revert": F.abs(diff) / (F.col(s) + F.lit(EPS)),
            f"{c}_ewm_dev": F.abs(diff),
        })
        wb = Window.partitionBy(*entity).orderBy(blk, *order).rowsBetween(UNB, CUR)
        df = df.withColumn(f"{c}_ewm_surges", F.sum(f"{c}_ewm_above").over(wb).cast("long"))
        if date:
            df = df.withColumn(f"{m}_prank", pct_rank_expr(m, date))
        df = df.drop(prev, blk)
    return df


# W13 ----------------------------------------------------------------------------
def ewm_by_context(df: DataFrame, cols: Sequence[str], entity, order, ctx: str, values: Sequence[str],
                   span: float = 21, date: str | None = None) -> DataFrame:
    """EWM of ``prev`` computed inside (entity, context) only; each output column
    is filled on its own context's rows, ranked among them per date."""
    entity, order = _cols(entity), _cols(order)
    part = entity + [ctx]
    alpha = alpha_from_span(span)
    w = Window.partitionBy(*part).orderBy(*order)
    for c in cols:
        prev = f"_{c}_cprev"
        df = df.withColumn(prev, F.lag(c, 1).over(w))
        df = ewm_moments(df, prev, part, order, alpha, f"_{c}_cm")
        if date:
            df = df.withColumn(f"_{c}_cr", pct_rank_expr(f"_{c}_cm", [date, ctx]))
        outs = {}
        for v in values:
            outs[f"{c}_ewm_mean_{v}"] = F.when(F.col(ctx) == v, F.col(f"_{c}_cm"))
            if date:
                outs[f"{c}_ewm_mean_{v}_prank"] = F.when(F.col(ctx) == v, F.col(f"_{c}_cr"))
        df = df.withColumns(outs).drop(prev, f"_{c}_cm", f"_{c}_cr")
    return df


# W19 ----------------------------------------------------------------------------
def allowed(df: DataFrame, group, date: str, stats: Sequence[str], span: float = 21,
            prefix: str = "allowed", dedupe_by: str | None = None) -> DataFrame:
    """Group-side EWM: daily sums per (group, date), EWM of the previous
    day's sum inside the group, percentile rank per date.  Returns the daily
    table; join it back on ``group + [date]`` (small: groups x dates).

    ``dedupe_by`` (an event column) is for stats repeated on every row of an
    event (a team total on each member's row): their maximum per event is
    taken before the daily sum, so the total is not multiplied by the rows."""
    from tempolith.operators.aggs import daily_sum
    group = _cols(group)
    alpha = alpha_from_span(span)
    if dedupe_by:
        df = df.groupBy(*group, date, dedupe_by).agg(*[F.max(s).alias(s) for s in stats])
    daily = daily_sum(df, group + [date], stats)
    w = Window.partitionBy(*group).orderBy(date)
    for s in stats:
        daily = daily.withColumn(f"_{s}_p", F.lag(s, 1).over(w))
        daily = ewm_moments(daily, f"_{s}_p", group, [date], alpha, f"{prefix}_{s}_ewm")
        daily = daily.withColumn(f"{prefix}_{s}_ewm_prank", pct_rank_expr(f"{prefix}_{s}_ewm", date))
        daily = daily.drop(f"_{s}_p")
    return daily.drop(*stats)


# W20 ----------------------------------------------------------------------------
def allowed_ratio(df: DataFrame, group, date: str, pairs: Sequence[tuple[str, str, str]],
                  span: float = 21) -> DataFrame:
    """EWM(made) / EWM(attempted) of previous daily sums, per (group, date),
    plus its per-date rank.  ``pairs`` = (made, attempted, output)."""
    from tempolith.operators.aggs import daily_sum
    group = _cols(group)
    alpha = alpha_from_span(span)
    cols = sorted({c for m, a, _ in pairs for c in (m, a)})
    daily = daily_sum(df, group + [date], cols)
    w = Window.partitionBy(*group).orderBy(date)
    for c in cols:
        daily = daily.withColumn(f"_{c}_p", F.lag(c, 1).over(w))
        daily = ewm_moments(daily, f"_{c}_p", group, [date], alpha, f"_{c}_e")
    for m, a, out in pairs:
        daily = daily.withColumn(out, F.try_divide(F.col(f"_{m}_e"), F.col(f"_{a}_e")))
        daily = daily.withColumn(f"{out}_prank", pct_rank_expr(out, date))
    return daily.drop(*cols, *[f"_{c}_p" for c in cols], *[f"_{c}_e" for c in cols])
