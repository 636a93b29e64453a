"""Filters, joins, aggregates and period operators on small inline rows."""

import datetime as dt

from pyspark.sql import functions as F

from kpiloom import operators as ops

d = dt.date


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_tags_null_empty_many(spark, rows):
    df = frame(spark, [(1, None), (2, []), (3, ["a", "x_partner_y"]), (4, ["other", None]), (5, ["p", "q"])], "i int, tags array<string>")
    assert rows(ops.tag_filter(df, "tags", "partner").select("i")) == [(3,)]
    assert rows(ops.tag_filter(df, "tags", "p,q").select("i")) == [(5,)]


def test_unnest_drops_empty(spark, rows):
    df = frame(spark, [(1, []), (2, None), (3, [("a",), ("b",)])], "i int, ev array<struct<name string>>".replace("name string", "name: string"))
    assert rows(ops.unnest_items(df, "ev").select("i", "item.name")) == [(3, "a"), (3, "b")]
    assert rows(ops.unnest_events(df, "ev", ["b", "c"]).select("i", "event.name")) == [(3, "b")]
    assert rows(df.filter(ops.has_event(F.col("ev"), ["a"])).select("i")) == [(3,)]


def test_status_and_flags_with_nulls(spark, rows):
    df = frame(spark, [(1, "paid", True), (2, None, None), (3, "cancelled", False)], "i int, s string, f boolean")
    assert rows(ops.status_filter(df, "s").select("i")) == [(1,)]
    assert rows(ops.flag_filter(df, "f").select("i")) == [(1,)]
    assert rows(ops.flag_filter(df, "f", False).select("i")) == [(2,), (3,)]


def test_cutoffs(spark, rows):
    days = [d(2026, 6, 30), d(2026, 7, 1), d(2026, 7, 14), d(2026, 7, 15)]
    df = frame(spark, [(x,) for x in days], "p date")
    assert rows(ops.cutoff_filter(df, "p", "2026-07-15", "week")) == [(days[0],)]
    assert rows(ops.cutoff_filter(df, "p", "2026-07-15", "day")) == [(x,) for x in days[:3]]
    assert ops.ytd_filter(df, "p", "2026-01-01").count() == 4
    assert ops.lookback_filter(df, "p", "2026-07-15", 1).count() == 2


def test_full_join_counts_default_to_zero(spark, rows):
    buyers = frame(spark, [(d(2026, 1, 4), 2), (d(2026, 1, 11), 3)], "w date, Buyers bigint")
    visitors = frame(spark, [(d(2026, 1, 11), 6), (d(2026, 1, 18), 0)], "w date, Visitors bigint")
    assert rows(ops.full_join_cvr(buyers, visitors, "w")) == [
        (d(2026, 1, 4), 2, 0, None), (d(2026, 1, 11), 3, 6, 0.5), (d(2026, 1, 18), 0, 0, None)]


def test_total_label_keeps_unmapped_apart(spark, rows):
    df = frame(spark, [("m", "A", 1), ("m", None, 2)], "m string, s string, v int")
    got = rows(ops.total_label(df, ["m", "s"], "s", [F.sum("v").alias("v")], unmapped="?"))
    assert got == [("m", "?", 2), ("m", "A", 1), ("m", "Total", 3)]


def test_all_null_sums(spark, rows):
    df = frame(spark, [(d(2026, 1, 5), None), (d(2026, 2, 5), 2.0), (None, 9.0)], "p date, v double")
    assert rows(ops.sum_to_period(df, "p", ["v"])) == [(d(2026, 1, 1), 0.0), (d(2026, 2, 1), 2.0)]
    assert rows(ops.running_total_sum(df.filter("v is null"), ["v"])) == [(None,)]


def test_sum_times_average_of_nonzero(spark, rows):
    df = frame(spark, [("a", 10.0, 0.0), ("a", 20.0, 2.0), ("b", 5.0, 0.0)], "k string, v double, r double")
    assert rows(ops.sum_times_avg(df, ["k"], "v", "r", "out")) == [("a", 60.0), ("b", None)]


def test_weighted_mean_of_rates(spark, rows):
    df = frame(spark, [(d(2026, 1, 4), 0.5, 10), (d(2026, 1, 11), None, 90), (d(2026, 1, 18), 1.0, 30)], "w date, r double, n int")
    assert rows(ops.mean_of_rates(df, "w", ["r"])) == [(d(2026, 1, 1), 0.75)]
    assert rows(ops.mean_of_rates(df, "w", ["r"], weights={"r": "n"})) == [(d(2026, 1, 1), 0.875)]


def test_delta_skips_nulls_and_zero(spark, rows):
    df = frame(spark, [("k", 1, 10.0), ("k", 2, None), ("k", 3, 15.0), ("k", 4, 0.0), ("k", 5, 5.0)], "k string, t int, v double")
    got = rows(ops.prev_non_null_delta(df, ["k"], "t", "v").select("t", "prev_value", "delta"))
    assert got == [(1, None, None), (2, 10.0, None), (3, 10.0, 0.5), (4, 15.0, -1.0), (5, 0.0, None)]


def test_direction(evaluate):
    deltas = [0.5, -0.5, 0.0005, None]
    assert evaluate(ops.delta_direction(F.col("x")), deltas, "double") == ["good", "bad", "neutral", "neutral"]
    assert evaluate(ops.delta_direction(F.col("x"), False), deltas, "double") == ["bad", "good", "neutral", "neutral"]


def test_trend(spark, rows):
    df = frame(spark, [("a", 1, 2.0), ("a", 2, None), ("a", 3, 4.0), ("b", 1, 7.0), ("c", 1, 5.0), ("c", 2, 5.0)], "k string, t int, v double")
    got = rows(ops.trend_normalise(df, ["k"], "t", "v").select("k", "t", "point", "height"))
    assert got == [("a", 1, 0, 0.0), ("a", 3, 1, 1.0), ("c", 1, 0, 0.0), ("c", 2, 1, 0.0)]


def test_rolling_periods_with_gap(spark, rows):
    days = frame(spark, [(d(2026, 7, 15), 100), (d(2026, 7, 14), 1), (d(2026, 7, 8), 2), (d(2026, 6, 30), 4)], "Fecha date, v int")
    got = rows(ops.rolling_periods(days, "2026-07-15", 7, 3, ["v"]))
    assert got == [(0, "P", d(2026, 7, 8), d(2026, 7, 14), 3), (1, "P-1", d(2026, 7, 1), d(2026, 7, 7), None),
                   (2, "P-2", d(2026, 6, 24), d(2026, 6, 30), 4)]


def test_rolling_periods_of_nothing(spark):
    empty = frame(spark, [], "Fecha date, v int")
    assert ops.rolling_periods(empty, "2026-07-15", 7, 3, ["v"]).count() == 0


def test_last_n_days_keeps_gaps(spark, rows):
    days = frame(spark, [(d(2026, 7, 1),), (d(2026, 7, 3),), (d(2026, 7, 9),)], "f date")
    assert rows(ops.last_n_days(days, "f", "2026-07-05", 3)) == [(d(2026, 7, 3),)]
    assert rows(ops.last_n_days(days, "f", "2026-08-05", 7)) == [(d(2026, 7, 3),), (d(2026, 7, 9),)]


def test_relative_labels_share_a_period(spark, rows):
    df = frame(spark, [(d(2026, 1, 4), "a"), (d(2026, 1, 11), "a"), (d(2026, 1, 11), "b"), (d(2026, 1, 25), "a")], "w date, s string")
    got = rows(ops.relative_label(df, "w").select("s", "label"))
    assert got == [("a", "S-1"), ("a", "S-2"), ("a", "Ult.sem"), ("b", "S-1")]


def test_share_ignores_unlisted_and_empty(spark, rows):
    df = frame(spark, [("m1", "a", 1), ("m1", "b", 3), ("m1", "z", 96), ("m2", "z", 5)], "m string, s string, v bigint")
    got = rows(ops.share_of_total(df, "m", "s", "v", ["a", "b"]).select("m", "s", "share"))
    assert got == [("m1", "a", 25), ("m1", "b", 75), ("m2", "a", 0), ("m2", "b", 0)]


def test_spine_has_every_store(spark, rows):
    mart = frame(spark, [(1, "a", 5)], "p int, s string, v int")
    assert rows(ops.period_spine_join(mart, ["a", "b"], "p", "s")) == [(1, "a", 5), (1, "b", None)]


def test_ytd_needs_a_positive_plan(spark, rows):
    df = frame(spark, [(d(2026, 1, 1), 110.0, 100.0, None), (d(2025, 12, 31), 9.0, 9.0, 9.0)], "p date, r double, a double, b double")
    assert rows(ops.ytd_attainment(df, "p", "2026-07-01", "r", {"a": "va", "b": "vb"})) == [(110.0, 100.0, None, 0.1, None)]


def test_forward_fill_across_chunks(spark, rows):
    values = {0: "x", 7: "y", 29: "z"}
    df = frame(spark, [(i, values.get(i)) for i in range(40)], "i bigint, v string")
    want = [(i, "x" if i < 7 else "y" if i < 29 else "z") for i in range(40)]
    got = ops.forward_fill(df, [], "i", ["v"], chunk=10)
    assert sorted((r.i, r.v) for r in got.collect()) == want


def test_order_flag_of_a_hot_order(spark):
    lines = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("o"), "id")
    got = ops.order_flag_window(lines, "o", F.col("id") == 29_997).groupBy("order_flag").count()
    assert {r.order_flag: r["count"] for r in got.collect()} == {1: 10_000, 0: 20_000}


def test_latest_and_caps(spark, rows):
    df = frame(spark, [("a", 1, 5), ("a", 3, None), ("b", 2, 8)], "k string, t int, v int")
    assert rows(ops.latest_period(df, "t", ["k"])) == [("a", 3, None), ("b", 2, 8)]
    assert rows(ops.top_latest(df, "t")) == [("a", 3, None)]
    assert [r.t for r in ops.result_cap(df, 2, "t").collect()] == [1, 2]
