"""Leakage-safe window features over ordered entity series.

Convention: a feature at row *t* only sees rows strictly before *t* (the
"shift by one" idiom), so every frame here ends at ``-1`` or runs over
``prev = lag(x, 1)``.  ``entity`` and ``order`` are column-name lists; the
order must end in a unique tie-break column so results are deterministic.

All windows that share ``partitionBy(entity).orderBy(order)`` plan as one
exchange plus one sort; per-date ranks add one exchange on the date key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNB = Window.unboundedPreceding
CUR = Window.currentRow


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def series_window(entity, order):
    return Window.partitionBy(*_cols(entity)).orderBy(*_cols(order))


# W1 -------------------------------------------------------------------------
def lags(df: DataFrame, cols: Sequence[str], entity, order, ks=(1, 2)) -> DataFrame:
    w = series_window(entity, order)
    return df.withColumns({f"{c}_lag{k}": F.lag(c, k).over(w) for c in cols for k in ks})


# W2 -------------------------------------------------------------------------
def expanding(df: DataFrame, cols: Sequence[str], entity, order) -> DataFrame:
    """Mean / sample std / max / min of all prior rows (NULLs skipped)."""
    w = series_window(entity, order).rowsBetween(UNB, -1)
    out = {}
    for c in cols:
        out[f"{c}_exp_mean"] = F.avg(c).over(w)
        out[f"{c}_exp_std"] = F.stddev_samp(c).over(w)
        out[f"{c}_exp_max"] = F.max(c).over(w)
        out[f"{c}_exp_min"] = F.min(c).over(w)
    return df.withColumns(out)


# W3 -------------------------------------------------------------------------
def pct_rank_expr(c: str, by) -> Column:
    """Average-tie percentile rank of ``c`` within ``by``: rank / non-null count.

    ``rank()`` is 1 + #smaller; ``count(c)`` with the default RANGE frame is
    #(<=), i.e. the highest tied rank, so their mean is the average rank.
    NULLs sort last and keep a NULL rank.
    """
    w = Window.partitionBy(*_cols(by)).orderBy(F.col(c).asc_nulls_last())
    n = F.count(c).over(Window.partitionBy(*_cols(by)))
    avg_rank = (F.rank().over(w) + F.count(c).over(w)) / F.lit(2.0)
    return F.when(F.col(c).isNotNull(), avg_rank / n)


def pct_rank_within(df: DataFrame, by, cols: Sequence[str], suffix: str = "_prank") -> DataFrame:
    return df.withColumns({f"{c}{suffix}": pct_rank_expr(c, by) for c in cols})


# W4, W5, W6 -------------------------------------------------------------------
def rolling(df: DataFrame, cols: Sequence[str], entity, order, n: int = 5) -> DataFrame:
    """Statistics over the previous ``n`` rows, only when all ``n`` are non-NULL.

    Mean absolute deviation and the least-squares slope (x = 0..n-1, oldest
    first) are closed forms over the ``n`` lag columns, so no Python runs.
    """
    ws = series_window(entity, order)
    w = ws.rowsBetween(-n, -1)
    xs = [(i - (n - 1) / 2.0) for i in range(n)]          # centred positions, oldest first
    sxx = sum(x * x for x in xs)
    out = {}
    for c in cols:
        full = F.count(c).over(w) == n
        lagk = [F.lag(c, k).over(ws) for k in range(n, 0, -1)]   # oldest .. newest
        mean = F.avg(c).over(w)
        out[f"{c}_roll_mean"] = F.when(full, mean)
        out[f"{c}_roll_std"] = F.when(full, F.stddev_samp(c).over(w))
        out[f"{c}_roll_max"] = F.when(full, F.max(c).over(w))
        out[f"{c}_roll_min"] = F.when(full, F.min(c).over(w))
        mad = sum((F.abs(v - mean) for v in lagk), F.lit(0.0)) / F.lit(float(n))
        out[f"{c}_roll_mad"] = F.when(full, mad)
        slope = sum((v * F.lit(x) for v, x in zip(lagk, xs)), F.lit(0.0)) / F.lit(sxx)
        out[f"{c}_roll_trend"] = F.when(full, slope)
    return df.withColumns(out)


# W12 --------------------------------------------------------------------------
def delta(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Last value minus the expanding mean (needs ``lags`` and ``expanding`` first)."""
    return df.withColumns({f"{c}_delta": F.col(f"{c}_lag1") - F.col(f"{c}_exp_mean") for c in cols})


# W14 --------------------------------------------------------------------------
def trend_slope(df: DataFrame, cols: Sequence[str], entity, order, min_rows: int = 21,
                min_values: int = 3, rtol: float = 1e-5, atol: float = 1e-8) -> DataFrame:
    """Expanding least-squares slope of ``prev`` on the row position.

    Defined from the ``min_rows``-th row of the group on, when at least
    ``min_values`` prior values exist and they are not all close to the first
    one (``|y - y0| <= atol + rtol*|y0|`` for all).  O(n) via running sums.
    """
    ws = series_window(entity, order)
    run = ws.rowsBetween(UNB, CUR)
    rn = F.row_number().over(ws)
    out = {}
    for c in cols:
        prev = F.lag(c, 1).over(ws)
        out[f"_{c}_prev"] = prev
    df = df.withColumns(out).withColumn("_rn", rn)
    res = {}
    for c in cols:
        p = F.col(f"_{c}_prev")
        y0 = F.first(p, ignorenulls=True).over(run)
        spread = F.greatest(F.max(p).over(run) - y0, y0 - F.min(p).over(run))
        ok = ((F.col("_rn") >= min_rows) & (F.count(p).over(run) >= min_values)
              & (spread > F.lit(atol) + F.lit(rtol) * F.abs(y0)))
        res[f"{c}_slope"] = F.when(ok, F.regr_slope(p, F.col("_rn").cast("double")).over(run))
    return df.withColumns(res).drop("_rn", *[f"_{c}_prev" for c in cols])


# W15 --------------------------------------------------------------------------
def streak_before(df: DataFrame, flag: str, entity, order, out: str) -> DataFrame:
    """Length of the run of ``flag == 1`` that ends at the previous row.

    Gaps and islands: the run restarts at every row whose previous flag is not
    1, so the streak is the distance to the latest restart.
    """
    ws = series_window(entity, order)
    rn = F.row_number().over(ws)
    prev = F.lag(flag, 1).over(ws)
    df = df.withColumn("_rn", rn).withColumn("_restart", ~F.coalesce(prev == 1, F.lit(False)))
    last_restart = F.last(F.when(F.col("_restart"), F.col("_rn")), ignorenulls=True).over(
        ws.rowsBetween(UNB, CUR))
    return df.withColumn(out, (F.col("_rn") - last_restart).cast("int")).drop("_rn", "_restart")


def hot_cold_flags(df: DataFrame, x: str, mean: str, std: str, hot: str, cold: str) -> DataFrame:
    up = F.col(mean) + F.col(std)
    down = F.col(mean) - F.col(std)
    return df.withColumns({
        hot: F.coalesce(F.col(x) >= up, F.lit(False)).cast("int"),
        cold: F.coalesce(F.col(x) < down, F.lit(False)).cast("int"),
    })


# W16 --------------------------------------------------------------------------
def rest_days(df: DataFrame, entity, date: str, order, out: str = "rest_days",
              b2b: str = "back_to_back") -> DataFrame:
    ws = series_window(entity, order)
    gap = F.datediff(F.col(date), F.lag(date, 1).over(ws))
    return df.withColumn(out, gap).withColumn(b2b, F.coalesce(F.col(out) == 1, F.lit(False)).cast("int"))


# W17 --------------------------------------------------------------------------
def count_last_days(df: DataFrame, entity, date: str, days: int = 7, out: str = "n_last_days") -> DataFrame:
    """Distinct active dates in ``(date - days, date]`` per entity.

    The first row of each date carries a 1; a RANGE frame over the day number
    sums those flags, so duplicates never need a self-join or a distinct.
    """
    day = F.datediff(F.col(date), F.lit("1970-01-01").cast("date"))
    df = df.withColumn("_day", day)
    wd = Window.partitionBy(*_cols(entity)).orderBy("_day")
    first_of_day = F.coalesce(F.lag("_day", 1).over(wd) != F.col("_day"), F.lit(True)).cast("int")
    df = df.withColumn("_first", first_of_day)
    cnt = F.sum("_first").over(wd.rangeBetween(-(days - 1), 0))
    return df.withColumn(out, cnt.cast("long")).drop("_day", "_first")


# W18 --------------------------------------------------------------------------
def cumulative_record(df: DataFrame, entity, order, win_flag: str, prefix: str = "cum") -> DataFrame:
    """Running wins / losses / win share, current row included.

    Entities here are teams and the like, few and large, so the series are cut
    into range segments whose totals are carried over (``segmented``)."""
    from tempolith.operators import segmented as SG
    flags = df.withColumns({"_w": F.coalesce(F.col(win_flag).cast("int"), F.lit(0)), "_l": F.coalesce((~F.col(win_flag)).cast("int"), F.lit(0))})
    df = SG.global_positions(SG.segment(flags, entity, order), entity, order)
    df = SG.running_sum_across(SG.running_sum_across(df, entity, "_w", f"{prefix}_wins"), entity, "_l", f"{prefix}_losses")
    df = df.drop("_w", "_l", "_rn", "_seg_start", "_n", SG.SEG).withColumns({f"{prefix}_{c}": F.col(f"{prefix}_{c}").cast("long") for c in ("wins", "losses")})
    return df.withColumn(f"{prefix}_win_pct", F.try_divide(F.col(f"{prefix}_wins").cast("double"),
                                                          (F.col(f"{prefix}_wins") + F.col(f"{prefix}_losses")).cast("double")))


# W21 --------------------------------------------------------------------------
def rolling_sum_prev(df: DataFrame, cols: Sequence[str], entity, order, n: int = 5) -> DataFrame:
    w = series_window(entity, order).rowsBetween(-n, -1)
    return df.withColumns({f"{c}_sum_prev{n}": F.when(F.count(c).over(w) == n, F.sum(c).over(w))
                           for c in cols})


# W22 --------------------------------------------------------------------------
def latest(df: DataFrame, entity, order_desc: Sequence[Column | str]) -> DataFrame:
    """One row per entity: the greatest under ``order_desc`` (plans as a group limit)."""
    w = Window.partitionBy(*_cols(entity)).orderBy(*[F.col(o).desc() if isinstance(o, str) else o
                                                     for o in order_desc])
    return df.withColumn("_rk", F.row_number().over(w)).filter("_rk = 1").drop("_rk")


# W25 --------------------------------------------------------------------------
def interactions(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Products of listed feature pairs; absent columns skipped, duplicates dropped."""
    have = set(df.columns)
    seen, out = set(), {}
    for a, b in pairs:
        if a in have and b in have and (a, b) not in seen:
            seen.add((a, b))
            out[f"{a}_x_{b}"] = F.col(a) * F.col(b)
    return df.withColumns(out) if out else df
