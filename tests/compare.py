"""Spark-vs-DuckDB result comparison used by the oracle tests.

Columns are compared by name, rows as an unordered multiset. Rows are
matched after sorting on a coarse key (doubles to 6 significant digits),
then doubles are compared with a relative tolerance of 1e-9: a double SUM
in the reference engine adds in join-output order, so its last bits are
not reproducible by any other plan.
"""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


REL_TOL = 1e-9


def _coarse(v):
    if isinstance(v, float):
        return float(f"{v:.6g}")
    if isinstance(v, tuple):
        return tuple(_coarse(x) for x in v)
    return v


def _close(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=REL_TOL, abs_tol=1e-12)
    if isinstance(a, tuple) and isinstance(b, tuple) and len(a) == len(b):
        return all(_close(x, y) for x, y in zip(a, b))
    return a == b


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if hasattr(v, "is_integer") and not isinstance(v, (int, bool)):  # Decimal
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_norm(r[i]) for i in order) for r in records), key=lambda t: repr(_coarse(t))
    ), [columns[i] for i in order]


def compare(spark_df, con, sql: str):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    s_sorted, s_names = rows_of(s_cols, s_rows)
    d_sorted, d_names = rows_of(d_cols, d_rows)
    problems = []
    if s_names != d_names:
        problems.append(f"columns differ: spark={s_names} duck={d_names}")
    if len(s_rows) != len(d_rows):
        problems.append(f"row count differ: spark={len(s_rows)} duck={len(d_rows)}")
    elif not all(_close(a, b) for a, b in zip(s_sorted, d_sorted)):
        diff = [(a, b) for a, b in zip(s_sorted, d_sorted) if not _close(a, b)][:2]
        problems.append(f"values differ, e.g. {diff}")
    return problems, len(s_rows)
