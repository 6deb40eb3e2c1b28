"""Date expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text layouts, tried in order (first success wins).
# A leading weekday ("Tue, ") is cut off first: Spark 4 cannot parse 'E'.
DATE_FORMATS = ("M/d/yyyy", "M/d/yy", "MMM d, yyyy", "MMMM d, yyyy", "MMM d yyyy", "MMMM d yyyy", "yyyy-MM-dd", "yyyy/MM/dd", "yyyyMMdd",
                "d MMM yyyy", "d MMMM yyyy", "d-MMM-yyyy")

# Shape of the text each layout can parse; a row is only handed to the layouts
# whose shape it has (a failed parse costs an exception inside the parser).
_SHAPES = {"M/d/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yy": r"^\d{1,2}/\d{1,2}/\d{2}$", "MMM d, yyyy": r"^[A-Za-z]{3} \d{1,2}, \d{4}$",
           "MMMM d, yyyy": r"^[A-Za-z]{3,9} \d{1,2}, \d{4}$", "MMM d yyyy": r"^[A-Za-z]{3} \d{1,2} \d{4}$",
           "MMMM d yyyy": r"^[A-Za-z]{4,9} \d{1,2} \d{4}$", "yyyy-MM-dd": r"^\d{4}-\d{1,2}-\d{1,2}$",
           "yyyy/MM/dd": r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyyMMdd": r"^\d{8}$", "d MMM yyyy": r"^\d{1,2} [A-Za-z]{3} \d{4}$",
           "d MMMM yyyy": r"^\d{1,2} [A-Za-z]{4,9} \d{4}$", "d-MMM-yyyy": r"^\d{1,2}-[A-Za-z]{3}-\d{4}$"}
# A time of day after the date, with or without a zone.
_TIME = r"[T ]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?( ?[AaPp][Mm])?( ?(Z|UTC|[+-]\d{2}:?\d{2}))?$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# F4 -----------------------------------------------------------------------------
def parse_date(c, formats: Sequence[str] = DATE_FORMATS) -> Column:
    s = F.trim(_c(c))
    s = F.regexp_replace(s, r"^[A-Za-z]+,\s*(?=[A-Za-z\d])", "")
    s = F.regexp_replace(s, _TIME, "")
    s = F.regexp_replace(s, r"\bSept\b\.?", "Sep")
    tries = [F.when(s.rlike(_SHAPES[f]), F.try_to_date(s, f)) if f in _SHAPES else F.try_to_date(s, f)
             for f in formats]
    return F.coalesce(*tries)


# F5 -----------------------------------------------------------------------------
def season_start(c) -> Column:
    """Season start year: October or later belongs to this year's season."""
    d = _c(c)
    return F.when(F.month(d) >= 10, F.year(d)).otherwise(F.year(d) - 1)


def season_label(c) -> Column:
    """'YYYY-YY' for the season containing the date."""
    y = season_start(c)
    return F.format_string("%d-%02d", y, (y + 1) % 100)


# F6 -----------------------------------------------------------------------------
def is_post_season(c, start_md=(4, 12), end_md=(10, 1)) -> Column:
    """Date in [start, end) of the season's second calendar year."""
    d = _c(c)
    y = season_start(d) + 1
    lo = F.make_date(y, F.lit(start_md[0]), F.lit(start_md[1]))
    hi = F.make_date(y, F.lit(end_md[0]), F.lit(end_md[1]))
    return (d >= lo) & (d < hi)


# F7 -----------------------------------------------------------------------------
def in_season_window(c, start="1021", year_end="1231", year_start="0101", end="0622") -> Column:
    """Month-day in [start, Dec 31] or [Jan 1, end]."""
    md = F.date_format(_c(c), "MMdd")
    return md.between(start, year_end) | md.between(year_start, end)
