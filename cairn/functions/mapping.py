"""Value maps written as CASE expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def case_map(col: Column, pairs: Iterable[tuple[object, object]], default: object = None) -> Column:
    """Simple ``CASE col WHEN k THEN v ... ELSE default END``.

    A NULL operand matches no branch and takes the default, as in SQL.
    Stays a native expression (no map lookup, no UDF).
    """
    expr = None
    for key, value in pairs:
        cond = col == F.lit(key)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))
