
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away_sql(expr: str, digits: int = 0) -> str:
    """``ROUND(x, n)`` as the reference engine computes it on doubles, as SQL.

    The reference scales by 10^n, rounds half away from zero on the scaled
    double and scales back; Spark's ``round`` rounds the decimal text of the
    double instead (1.005 -> 1.01 there, 1.0 here). The fractional part of
    the scaled value is exact in floating point, so the half test is exact.
    From 2^53 on a double has no fraction (and infinity and NaN none at all):
    such values come back unchanged.
    """
    scale = f"{float(10**digits)}D"
    v = f"(({expr}) * {scale})"
    mag = f"abs({v})"
    whole = f"CAST(floor({mag}) AS DOUBLE)"
    return (
        f"CASE WHEN ({expr}) IS NULL THEN CAST(NULL AS DOUBLE) "
        f"WHEN NOT ({mag} < 9007199254740992D) THEN CAST(({expr}) AS DOUBLE) "
        f"ELSE signum({v}) * (CASE WHEN {mag} - {whole} >= 0.5D THEN {whole} + 1.0D ELSE {whole} END) / {scale} END"
    )


def null_if_zero(col: Column) -> Column:
    """``NULLIF(x, 0)``: the divide guard; a bare ``/ 0`` raises under ANSI."""
    return F.nullif(col, F.lit(0))
