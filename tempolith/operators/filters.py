"""Projections, filters and predicates.

Column-only predicates stay plain ``filter``s so Catalyst pushes them into
the parquet scan.  Entity-level qualifications (B8-B10) are an aggregate plus
a ``left_semi`` join: the aggregate is partial on the map side, and the semi
join never duplicates rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempolith.operators.windows import _cols


# B1 ---------------------------------------------------------------------------
def drop(df: DataFrame, *cols: str) -> DataFrame:
    """Drop columns, ignoring absent ones (Spark's drop already does)."""
    return df.drop(*cols)


# B2 ---------------------------------------------------------------------------
def align_to(df: DataFrame, cols: Sequence[str], rename: dict | None = None,
             types: dict | None = None) -> DataFrame:
    """Rename, then select exactly ``cols`` in order; absent columns become NULL, as does what cannot be cast."""
    if rename:
        df = df.withColumnsRenamed({k: v for k, v in rename.items() if k in df.columns})
    have = set(df.columns)
    types = types or {}
    out = []
    for c in cols:
        e = F.col(c) if c in have else F.lit(None)
        if c in types or c not in have:
            e = e.try_cast(types.get(c, "string"))
        out.append(e.alias(c))
    return df.select(*out)


# B3 ---------------------------------------------------------------------------
def exclude(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    return df.filter(~F.col(col).isin(list(values)) | F.col(col).isNull())


# B4 ---------------------------------------------------------------------------
def _day_bound(df: DataFrame, col: str, day: dt.date):
    """A literal comparable with ``col`` itself (date or timestamp), so the
    predicate stays on the raw column and reaches the parquet scan."""
    typ = df.schema[col].dataType
    if isinstance(typ, T.TimestampNTZType):        # zone-free: from text, not a zoned literal
        return F.lit(day.isoformat() + " 00:00:00").cast("timestamp_ntz")
    if isinstance(typ, T.TimestampType):
        return F.lit(dt.datetime(day.year, day.month, day.day))
    return F.lit(day)


def since_year(df: DataFrame, col: str, year: int) -> DataFrame:
    """Rows dated on or after Jan 1 of ``year`` (a range predicate on the raw
    column, pushed to the scan and used for row-group pruning)."""
    return df.filter(F.col(col) >= _day_bound(df, col, dt.date(year, 1, 1)))


# B5 ---------------------------------------------------------------------------
def complete_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=list(subset) if subset else None)


# B6 ---------------------------------------------------------------------------
def starts_with(df: DataFrame, col: str, prefix: str) -> DataFrame:
    return df.filter(F.lower(F.col(col)).startswith(prefix.lower()))


# B7 ---------------------------------------------------------------------------
def participated(df: DataFrame, flag: str, amount: str) -> DataFrame:
    """Flag false and amount > 0; a NULL flag drops the row."""
    return df.filter((F.col(flag) == F.lit(False)) & (F.col(amount) > 0))


# B8 ---------------------------------------------------------------------------
def min_rows(df: DataFrame, key, n: int = 10) -> DataFrame:
    keep = df.groupBy(*_cols(key)).count().filter(F.col("count") >= n).drop("count")
    return df.join(keep, _cols(key), "left_semi")


# B9, C5 -------------------------------------------------------------------------
def qualify(df: DataFrame, keys, col: str, threshold: float) -> DataFrame:
    """Keep (entity, season) groups whose mean of ``col`` is at least ``threshold``."""
    keep = df.groupBy(*_cols(keys)).agg(F.avg(col).alias("_m")).filter(F.col("_m") >= threshold).drop("_m")
    return df.join(keep, _cols(keys), "left_semi")


# B10 ----------------------------------------------------------------------------
def active_in(df: DataFrame, key: str, season_col: str, season) -> DataFrame:
    """All history of entities that have at least one row in ``season``."""
    keep = df.filter(F.col(season_col) == F.lit(season)).select(key)
    return df.join(keep, key, "left_semi")


# B11 ----------------------------------------------------------------------------
def drop_placeholder(df: DataFrame, cols: Sequence[str], placeholder: str = "TBD") -> DataFrame:
    cond = F.lit(True)
    for c in cols:
        cond = cond & (F.coalesce(F.col(c), F.lit("")) != placeholder)
    return df.filter(cond)


# B12 ----------------------------------------------------------------------------
def ensure_columns(df: DataFrame, spec: dict[str, tuple[str, object]]) -> DataFrame:
    """Guarantee ``name -> (type, default)``: add missing columns as the
    default, fill NULLs with it and cast existing ones."""
    out = {}
    for name, (typ, default) in spec.items():
        if name in df.columns:
            e = F.col(name).try_cast(typ)
            out[name] = F.coalesce(e, F.lit(default).cast(typ)) if default is not None else e
        else:
            out[name] = F.lit(default).cast(typ)
    return df.withColumns(out)


# B13 ----------------------------------------------------------------------------
def flag_in(df: DataFrame, col: str, values: Iterable, out: str) -> DataFrame:
    return df.withColumn(out, F.coalesce(F.col(col).isin(list(values)), F.lit(False)).cast("int"))


# B14 ----------------------------------------------------------------------------
def next_slate(df: DataFrame, date: str, today) -> DataFrame:
    """Rows on the first date >= today; else rows on the last date; if every
    date is NULL, all rows.  The pick is a scalar subquery (one partial
    aggregate over the frame), compared on every row - no join."""
    today = F.lit(today).cast(T.DateType()) if not isinstance(today, F.Column) else today
    pick = df.agg(F.coalesce(F.min(F.when(F.col(date) >= today, F.col(date))), F.max(date))).scalar()
    return df.filter(pick.isNull() | (F.col(date) == pick))


# B15 ----------------------------------------------------------------------------
def week_window(df: DataFrame, date: str, anchor: dt.date, days: int = 7, horizon: int = 365,
                cols: Sequence[str] | None = None) -> DataFrame:
    """Rows from the first active day in [anchor, anchor + horizon] through
    that day + days - 1 (``cols`` selected and de-duplicated).  ``date`` may be
    a date or a timestamp column; the outer range is a pushed-down predicate
    on it."""
    day = F.to_date(F.col(date))
    end = anchor + dt.timedelta(days=horizon + 1)
    live = df.filter((F.col(date) >= _day_bound(df, date, anchor)) & (F.col(date) < _day_bound(df, date, end)))
    first = live.agg(F.min(day)).scalar()
    out = live.filter(day <= F.date_add(first, days - 1))
    if cols:
        out = out.select(*cols)
    return out.distinct()


# B16 ----------------------------------------------------------------------------
def search_all(df: DataFrame, query: str | None) -> DataFrame:
    """Rows where any column, as lower-case text without tags, contains the
    query (case-insensitive); a blank query returns the frame unchanged."""
    if query is None or not query.strip():
        return df
    q = query.strip().lower()
    cond = F.lit(False)
    for c in df.columns:
        txt = F.lower(F.regexp_replace(F.col(c).cast("string"), r"<[^>]*>", ""))
        cond = cond | F.coalesce(F.instr(txt, q) > 0, F.lit(False))
    return df.filter(cond)


# B17 ----------------------------------------------------------------------------
def group_columns(columns: Sequence[str], spec: dict[str, Sequence[str]]) -> dict[str, list[str]]:
    """Driver-side metadata: group column names by regular-expression patterns
    (first matching group wins, order of ``columns`` kept)."""
    import re
    groups = {g: [] for g in spec}
    for c in columns:
        for g, pats in spec.items():
            if any(re.search(p, c) for p in pats):
                groups[g].append(c)
                break
    return groups


# B18 ----------------------------------------------------------------------------
class RequirementError(ValueError):
    pass


def require(df: DataFrame, cols: Sequence[str] = (), non_empty: bool = False) -> DataFrame:
    """Fail the job on missing columns (driver-side schema check) or, if
    ``non_empty``, on an empty frame (a ``limit(1)`` probe, not a count)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise RequirementError(f"missing required columns: {missing}")
    if non_empty and not df.limit(1).collect():
        raise RequirementError("frame is empty")
    return df
