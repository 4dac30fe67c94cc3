"""Scalar helpers against the reference engine's semantics (DuckDB)."""

import duckdb
import pytest
from pyspark.sql import functions as F

from cairn.functions import (
    case_map,
    date_part,
    day_name,
    month_name,
    parse_ts_ntz,
    round_half_away_sql,
    trunc_ntz,
)


@pytest.mark.parametrize("digits", [0, 1, 2])
def test_round_matches_duckdb_on_halves(spark, digits):
    values = [1.005, 0.285, 2.5, -2.5, 0.125, 1.115, 10.0049999, 123.455, -0.285, 0.0, 7.0, 2.675, 1e-9]
    values += [i / 1000 + 0.0005 for i in range(0, 3000, 7)]
    con = duckdb.connect()
    expected = [con.execute(f"SELECT ROUND({v!r}::DOUBLE, {digits})").fetchone()[0] for v in values]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got_sql = [r[0] for r in df.selectExpr(round_half_away_sql("x", digits)).collect()]
    assert got_sql == expected


def test_round_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert df.selectExpr(round_half_away_sql("x", 2)).first()[0] is None


def test_round_keeps_huge_and_special_values(spark):
    values = [1e18, 1.5e17, -1e18, 9e15, 4503599627370497.5, 1e300, float("inf"), float("-inf")]
    con = duckdb.connect()
    expected = [con.execute("SELECT ROUND(?::DOUBLE, 2)", [v]).fetchone()[0] for v in values]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.selectExpr(round_half_away_sql("x", 2)).collect()] == expected
    nan = spark.createDataFrame([(float("nan"),)], "x double").selectExpr(round_half_away_sql("x", 2)).first()[0]
    assert nan != nan


def test_week_trunc_starts_monday_and_stays_ntz(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-07 23:59:59' AS ts")  # a Sunday
    row = df.select(trunc_ntz("week", "ts").alias("w"), trunc_ntz("month", "ts").alias("m")).first()
    assert str(row.w) == "2024-01-01 00:00:00"
    assert str(row.m) == "2024-01-01 00:00:00"
    assert dict(df.select(trunc_ntz("week", "ts").alias("w")).dtypes)["w"] == "timestamp_ntz"


def test_iso_week_and_names(spark):
    df = spark.sql("SELECT timestamp_ntz'2021-01-03 10:00:00' AS ts")
    row = df.select(
        date_part("week", "ts").alias("wk"),
        date_part("year", "ts").alias("y"),
        day_name("ts").alias("dn"),
        month_name("ts").alias("mn"),
    ).first()
    assert (row.wk, row.y, row.dn, row.mn) == (53, 2021, "Sunday", "January")
    assert dict(df.select(date_part("week", "ts").alias("wk")).dtypes)["wk"] == "bigint"


def test_text_to_timestamp_drops_offset(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00Z",), ("2024-01-01T10:00:00+02:00",)], "s string")
    got = [str(r[0]) for r in df.select(parse_ts_ntz("s")).collect()]
    assert got == ["2024-01-01 10:00:00", "2024-01-01 10:00:00"]


def test_malformed_timestamp_raises(spark):
    df = spark.createDataFrame([("not a date",)], "s string")
    with pytest.raises(Exception):
        df.select(parse_ts_ntz("s")).collect()


def test_case_map_null_takes_default(spark):
    df = spark.createDataFrame([("Run",), ("Kayak",), (None,)], "s string")
    got = [r[0] for r in df.select(case_map(F.col("s"), [("Run", "Cardio")], "Other")).collect()]
    assert got == ["Cardio", "Other", "Other"]


def test_round_matches_duckdb_on_random_values(spark):
    """Property check over many values (exact halves included)."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from cairn.functions import round_half_away_sql

    con = duckdb.connect()
    finite = st.floats(min_value=-1e9, max_value=1e9, allow_nan=False, allow_infinity=False)
    halves = st.integers(-10**7, 10**7).map(lambda i: i / 200.0)  # many x.xx5 values

    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.one_of(finite, halves), min_size=50, max_size=200), st.integers(0, 3))
    def check(values, digits):
        expected = [r[0] for r in con.execute(
            f"SELECT ROUND(v, {digits}) FROM (SELECT UNNEST(?::DOUBLE[]) AS v, generate_subscripts(?::DOUBLE[], 1) AS i) ORDER BY i",
            [values, values],
        ).fetchall()]
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
        got = [r[0] for r in df.orderBy("i").selectExpr(round_half_away_sql("x", digits)).collect()]
        assert got == expected

    check()
