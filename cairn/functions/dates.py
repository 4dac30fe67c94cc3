
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


def trunc_ntz(unit: str, col: ColumnOrName) -> Column:
    """``DATE_TRUNC(unit, ts)`` that keeps a zone-less timestamp zone-less.

    Spark's ``date_trunc`` returns a zoned ``timestamp`` even for
    ``timestamp_ntz`` input; with the session in UTC the cast back is exact.
    Weeks start on Monday, as in the reference engine.
    """
    return F.date_trunc(unit, _c(col)).cast("timestamp_ntz")


def trunc_date(unit: str, col: ColumnOrName) -> Column:
    """``DATE_TRUNC(unit, ts)::DATE``."""
    return F.date_trunc(unit, _c(col)).cast("date")


def date_part(part: str, col: ColumnOrName) -> Column:
    """YEAR/MONTH/DAY/QUARTER/WEEK/HOUR as BIGINT (Spark returns INT)."""
    fn = {
        "year": F.year,
        "month": F.month,
        "day": F.dayofmonth,
        "quarter": F.quarter,
        "week": F.weekofyear,  # ISO week, 2021-01-03 -> 53
        "hour": F.hour,
    }[part]
    return fn(_c(col)).cast("bigint")


def day_name(col: ColumnOrName) -> Column:
    """Full English day name ('Monday'); Spark's ``dayname`` gives 'Mon'."""
    return F.date_format(_c(col), "EEEE")


def month_name(col: ColumnOrName) -> Column:
    """Full English month name ('January'); Spark's ``monthname`` gives 'Jan'."""
    return F.date_format(_c(col), "MMMM")


def parse_ts_ntz(col: ColumnOrName) -> Column:
    """Text -> TIMESTAMP without zone; an offset suffix is dropped, not applied.

    Malformed text raises under ANSI mode, as the reference's cast does.
    """
    return _c(col).cast("timestamp_ntz")
