"""Column expressions on the cases that trip them up."""

import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from kpiloom import functions as fn

d = dt.date


def test_week_starts_on_sunday(evaluate):
    days = [d(2026, 3, 1), d(2026, 3, 7), d(2026, 3, 8), d(2025, 12, 31), None]
    assert evaluate(lambda X: fn.week_sunday(X), days, "date") == [
        d(2026, 3, 1), d(2026, 3, 1), d(2026, 3, 8), d(2025, 12, 28), None]


def test_month_ends(evaluate):
    assert evaluate(lambda X: fn.month_start(X), [d(2024, 2, 29), d(2024, 3, 31)], "date") == [d(2024, 2, 1), d(2024, 3, 1)]
    assert evaluate(lambda X: fn.previous_month_end(X), [d(2024, 3, 31), d(2025, 1, 1)], "date") == [d(2024, 2, 29), d(2024, 12, 31)]


def test_month_from_yyyymm(evaluate):
    assert evaluate(lambda X: fn.month_from_yyyymm(X), ["202510", "202601.0", "x", None, "202513"]) == [
        d(2025, 10, 1), d(2026, 1, 1), None, None, None]


def test_spanish_labels(evaluate):
    days = [d(2026, 4, 27), d(2025, 1, 5)]
    assert evaluate(lambda X: fn.month_label(X), days, "date") == ["Abr'26", "Ene'25"]
    assert evaluate(lambda X: fn.day_label(X), days, "date") == ["27/abr", "5/ene"]
    assert evaluate(lambda X: fn.day_text(X), days, "date") == ["27 abr", "5 ene"]


def test_parse_day_month(evaluate):
    got = evaluate(lambda X: fn.parse_day_month(X, 2026, F.lit(7)), ["1-abr", " 31-DIC ", "5-zzz", "5", "30-feb", "x-abr", None])
    assert got == [d(2026, 4, 1), d(2026, 12, 31), d(2026, 7, 5), d(2026, 7, 5), None, None, None]


def test_decimal_comma(evaluate):
    got = evaluate(lambda X: fn.parse_decimal_comma(X), ["1.234,5", " 12 ", "71,0%", "", None, "abc", "-3,25", "1d", "NaN"])
    assert got == [1234.5, 12.0, None, None, None, None, -3.25, None, None]


def test_percent(evaluate):
    assert evaluate(lambda X: fn.parse_percent(X), ["71,0%", "58,79 %", "12,2", "", None]) == pytest.approx(
        [0.71, 0.5879, 0.122, None, None])


def test_guards(evaluate):
    assert evaluate(lambda X: fn.safe_ratio(F.lit(1.0), X), [2.0, 0.0, None], "double") == [0.5, None, None]
    assert evaluate(lambda X: fn.safe_ratio_nz(X, F.lit(2.0)), [2.0, 0.0, None], "double") == [1.0, None, None]
    assert evaluate(lambda X: fn.positive_ratio(F.lit(1.0), X), [2.0, 0.0, -2.0, None], "double") == [0.5, None, None, None]


def test_rounding_modes(evaluate):
    values = [0.5, 1.5, 2.5, -0.5, -1.5]
    assert evaluate(lambda X: F.round(X, 0), values, "double") == [1, 2, 3, -1, -2]
    assert evaluate(lambda X: fn.round_half_even(X), values, "double") == [0, 2, 2, 0, -2]
    assert evaluate(lambda X: fn.round_half_up(X), values, "double") == [1, 2, 3, 0, -1]


def test_nan_to_null(evaluate):
    got = evaluate(lambda X: fn.nan_to_null(X), ["1.5", "NaN", "Infinity", "-Infinity", "none", None])
    assert got == [1.5, None, None, None, None, None]


def test_nps_bucket_rounds_scores(evaluate):
    scores = ["6.4", "6.5", "7", "8.4", "8.5", "9", "10", "11", "n/a", None, "0"]
    assert evaluate(lambda X: fn.nps_bucket(X), scores) == [-1, 0, 0, 0, 1, 1, 1, None, None, None, -1]


def test_age_band(evaluate):
    texts = ["18 - 24", "29", "30 - 34", "45-49", "60 - 64", "70 y más", "10 - 12", "sin dato", None, "", "-5", "18a"]
    assert evaluate(lambda X: fn.age_band(X), texts) == [
        "18-29", "18-29", "30-44", "45-59", "60+", "60+", "18-29"] + ["Sin clasif."] * 5


def test_segments_and_blanks(evaluate):
    assert evaluate(lambda X: fn.segment_map(X), ["GOLD", "NA", None]) == ["GOLD", "Sin clasif.", "Sin clasif."]
    assert evaluate(lambda X: fn.blank_to_total(X), ["", " ", None, "nan", "None", " North "]) == ["Total"] * 5 + ["North"]


def test_quantities(spark):
    df = spark.createDataFrame(
        [(10.0, "unit", 2.0, 12.0), (10.0, "kg", 2.0, 8.0), (10.0, None, 2.0, None), (10.0, "kg", 0.0, 1.0)],
        "q double, measure string, nw double, picked double")
    got = df.select(fn.qty_normalise(F.col("q"), F.col("measure"), F.col("nw")),
                    fn.qty_cap(F.col("picked"), F.col("q"))).collect()
    assert [tuple(r) for r in got] == [(10.0, 10.0), (5.0, 8.0), (10.0, None), (None, 1.0)]


def test_refund_value(evaluate):
    got = evaluate(lambda X: fn.refund_value(X, F.lit(10), F.lit(7)), ["partially_refunded", "paid", None])
    assert got == [7, 10, 10]


def test_value_status(evaluate):
    assert evaluate(lambda X: fn.value_status(X, 50, 20), [50.0, 20.0, 19.0, None], "double") == ["good", "neutral", "bad", None]
    assert evaluate(lambda X: fn.value_status(X, 10, higher_better=False), [10.0, 10.1], "double") == ["good", "bad"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.dates(d(1990, 1, 1), d(2060, 12, 31)), min_size=20, max_size=60))
def test_week_sunday_matches_calendar(spark, days):
    df = spark.createDataFrame([(x,) for x in days], "x date").select("x", fn.week_sunday(F.col("x")).alias("w"))
    for x, w in df.collect():
        assert w == x - dt.timedelta(days=(x.weekday() + 1) % 7)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-10**9, 10**9), min_size=20, max_size=60))
def test_decimal_comma_round_trip(spark, numbers):
    text = [f"{n / 10:,.1f}".translate(str.maketrans(",.", ".,")) for n in numbers]
    df = spark.createDataFrame([(t,) for t in text], "x string").select(fn.parse_decimal_comma(F.col("x")))
    assert [r[0] for r in df.collect()] == [n / 10 for n in numbers]


def test_junk_numbers_are_null_not_errors(evaluate):
    from kpiloom.functions import month_from_yyyymm
    from kpiloom.functions.retail import nps_bucket
    assert evaluate(nps_bucket, ["NaN", "1e12", "-1e300", "9.4", "n/a"]) == [None, None, None, 1, None]
    assert evaluate(month_from_yyyymm, ["NaN", "1e300", "202601.0"])[:2] == [None, None]
