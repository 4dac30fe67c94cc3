"""Scalar column helpers that keep Spark results equal to the reference engine's.

Every helper returns a ``Column`` built from built-in functions, so it stays
inside whole-stage codegen; none of them is a Python UDF.
"""

from cairn.functions.dates import (
    day_name,
    date_part,
    month_name,
    parse_ts_ntz,
    trunc_date,
    trunc_ntz,
)
from cairn.functions.numeric import null_if_zero, round_half_away_sql
from cairn.functions.mapping import case_map

__all__ = [
    "case_map",
    "date_part",
    "day_name",
    "month_name",
    "null_if_zero",
    "parse_ts_ntz",
    "round_half_away_sql",
    "trunc_date",
    "trunc_ntz",
]
