"""Numeric expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# F8 -----------------------------------------------------------------------------
def safe_ratio(num, den) -> Column:
    """num / den with a zero (or NULL) denominator giving NULL (ANSI-safe)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


# F9 -----------------------------------------------------------------------------
def clip(c, lo=None, hi=None) -> Column:
    """Clamp to [lo, hi]; NULL stays NULL (greatest/least alone would skip it)."""
    x = _c(c)
    y = x
    if lo is not None:
        y = F.greatest(y, F.lit(lo))
    if hi is not None:
        y = F.least(y, F.lit(hi))
    return F.when(x.isNotNull(), y)


# F14 ----------------------------------------------------------------------------
def round_numeric(df: DataFrame, digits: int = 1) -> DataFrame:
    """Round every floating column half-to-even (R semantics)."""
    return df.select(*[F.bround(f.name, digits).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def seconds_to_minutes(c, digits: int = 1) -> Column:
    return F.bround(_c(c) / F.lit(60.0), digits)


# F15 ----------------------------------------------------------------------------
def implied_probability(c) -> Column:
    """American odds to implied probability in percent; non-numeric -> NULL."""
    o = _c(c).cast("string").try_cast("double")
    neg = F.abs(o) / (F.abs(o) + F.lit(100.0))
    pos = F.lit(100.0) / (o + F.lit(100.0))
    return F.when(o < 0, neg * 100).when(o.isNotNull(), pos * 100)


# F16 ----------------------------------------------------------------------------
def finite_or_null(c) -> Column:
    x = _c(c)
    return F.when(F.abs(x) < F.lit(float("inf")), x)       # NaN is above every other value


def clean_non_finite(df: DataFrame, narrow: bool = False, skip=()) -> DataFrame:
    """±inf and NaN -> NULL in every floating column but ``skip``; optionally narrow to float/int at a sink."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in skip:
            e = finite_or_null(f.name)
            out.append((e.cast("float") if narrow else e).alias(f.name))
        elif narrow and isinstance(f.dataType, T.LongType):
            out.append(F.col(f.name).cast("int").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


# F17 ----------------------------------------------------------------------------
def any_missing(cols: Sequence[str]) -> Column:
    return F.greatest(*[F.col(c).isNull().cast("int") for c in cols]) if len(cols) > 1 \
        else F.col(cols[0]).isNull().cast("int")
