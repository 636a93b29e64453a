"""Bucketed facts, incremental marts, stores as a table, partitions, batches with a history."""

import datetime as dt
import os
import random
import sys

import pytest
from pyspark.sql import functions as F

from checks import QUERIES, inputs, scorecard, states
from kpiloom import bindings, operators as ops, plans, session, sources
from kpiloom.session import BUCKETED_CONF, bucketed, materialise, open_bucketed

SCOPE = {"pick_keys": ("order_id", "line_id")}
DAY0 = dt.date(2026, 3, 1)
LINES = ("order_id long, line_id int, purchase_id long, buyer_id long, status string, closed_at timestamp_ntz, site string, "
         "marketplace_id string, gmv_flag boolean, auto_offer_flag boolean, fx_ratio double, "
         "item struct<node_id string, unit_price double, supermarket_flag boolean>, tags array<string>")
PICKS = "order_id long, line_id int, requested_qty double, measure string, picked_qty double, net_weight double"


def facts(seed, orders=120, days=30):
    rng, lines, picks = random.Random(seed), [], []
    for k in range(orders):
        order = seed * 1000 + k
        at = dt.datetime.combine(DAY0 + dt.timedelta(rng.randrange(days)), dt.time(rng.randrange(24)))
        for line in range(rng.randint(1, 4)):
            lines.append((order, line, order // 2, order % 17, rng.choice(["paid", "partially_refunded"]), at, "S1", "TM", True, False,
                          rng.choice([None, 0.5, 2.0]), (rng.choice("AB"), float(rng.randint(1, 9)), True), ["supermarket_partnership"]))
            picks.append((order, line, float(rng.randint(1, 5)), "unit", float(rng.randint(0, 5)), None))
    return lines, picks


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def co_located(spark):
    conf = {**BUCKETED_CONF, "spark.sql.autoBroadcastJoinThreshold": "-1"}  # no side is small at scale
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_bucketed_facts_join_and_group_without_exchange(spark, rows, tmp_path, co_located):
    lines, picks = facts(1)
    lines, picks = spark.createDataFrame(lines, LINES), spark.createDataFrame(picks, PICKS)
    claims = lines.select("order_id", F.lit("late").alias("claim_type")).where("order_id % 3 = 0")
    stored = [bucketed(df, f"{tmp_path}/{name}", f"{name}_by_order", ["order_id"], 6)
              for name, df in (("lines", lines), ("picks", picks), ("claims", claims))]
    pairs = [(plans.orders_of_lines(plans.valued_lines(a, b, **SCOPE), "day"),
              ops.order_flag_window(a, "order_id", F.col("status") == "paid", known_keys=True),
              ops.join_claims_orders(c, a.select("order_id", "status"))) for a, b, c in (stored, (lines, picks, claims))]
    for kept, plain in zip(*pairs):
        assert "Exchange" not in plan_of(kept) and "SortMergeJoin" in plan_of(kept)
        assert "Exchange" in plan_of(plain)
        assert sorted(map(repr, kept.collect())) == sorted(map(repr, plain.collect()))
    weekly = plans.growth_of_lines(plans.valued_lines(*stored[:2], **SCOPE), "week")
    assert rows(weekly) == rows(plans.growth_weekly(lines, picks, **SCOPE))
    spark.sql("DROP TABLE picks_by_order")
    again = open_bucketed(spark, f"{tmp_path}/picks", "picks_again", PICKS, ["order_id"], 6)
    assert again.count() == picks.count()
    assert "Exchange" not in plan_of(plans.valued_lines(stored[0], again, **SCOPE))


def test_a_hot_key_is_not_bucketed(spark, tmp_path):
    df = spark.range(500).select((F.col("id") % 400).alias("order_id")).unionByName(
        spark.range(300).select(F.lit(7).cast("long").alias("order_id")))
    with pytest.raises(ValueError, match="302 rows"):
        bucketed(df, f"{tmp_path}/hot", "hot_by_order", ["order_id"], 4, most_rows=100)


def test_bucketed_and_partitioned(spark, tmp_path):
    df = spark.range(60).select("id", (F.col("id") % 3).cast("int").alias("part"))
    bucketed(df, f"{tmp_path}/p", "parted_by_id", ["id"], 4, by=["part"])
    again = open_bucketed(spark, f"{tmp_path}/p", "parted_again", "id long, part int", ["id"], 4, by=["part"])
    assert again.where("part = 1").count() == 20


def files_of(path):
    return {d: sorted(f for f in names if f.endswith(".parquet")) for d, _, names in os.walk(path) if "part=" in d}


@pytest.mark.parametrize("stores", [None, {"A": "North", "B": "East"}])
def test_late_lines_recompute_their_days_only(spark, rows, tmp_path, stores):
    lines, picks = facts(2)
    path, late = f"{tmp_path}/orders", facts(3, orders=4, days=3)
    moved_id, lone_day = lines[0][0], DAY0 + dt.timedelta(40)
    lone = [(9000, 0, *lines[0][2:5], dt.datetime.combine(lone_day, dt.time(1)), *lines[0][6:])]
    old = spark.createDataFrame(lines + lone, LINES)
    all_picks = spark.createDataFrame(picks + late[1], PICKS)
    first = plans.refresh_orders(old, all_picks, old, path, first=True, stores=stores, **SCOPE)
    assert first == sorted({r[5].date() for r in lines + lone})
    before = files_of(path)
    # new lines on old days, an order that moves to a new day, and a day that loses its only order
    moved = [(*r[:5], dt.datetime.combine(DAY0 + dt.timedelta(33), dt.time(5)), *r[6:]) for r in lines if r[0] == moved_id]
    gone = [(*r[:4], "cancelled", *r[5:]) for r in lone]
    now = spark.createDataFrame([r for r in lines if r[0] != moved_id] + moved + late[0] + gone, LINES)
    changed = spark.createDataFrame(moved + late[0] + gone, LINES)
    days = plans.refresh_orders(now, all_picks, changed, path, stores=stores, **SCOPE)
    assert days == sorted({r[5].date() for r in moved + late[0] + gone} | {lines[0][5].date()})
    after = files_of(path)
    untouched = {d for d in before if d.split("part=")[1] not in {str(d) for d in days}}
    assert len(untouched) > 15 and all(after[d] == before[d] for d in untouched)
    state = sources.read_days(spark, path)
    for grain in ("day", "week", "month"):
        got = plans.growth_of_orders(state, grain)
        assert rows(got) == rows(plans.growth(now, all_picks, grain, stores=stores, **SCOPE))
    # nothing changed: nothing is written
    assert plans.refresh_orders(now, all_picks, changed.limit(0), path, stores=stores, **SCOPE) == []
    assert files_of(path) == after


def test_folders_of_months_are_recomputed_whole(spark, rows, tmp_path):
    lines, picks = facts(4, days=100)
    path, late = f"{tmp_path}/orders", facts(5, orders=3, days=2)
    old, all_picks = spark.createDataFrame(lines, LINES), spark.createDataFrame(picks + late[1], PICKS)
    plans.refresh_orders(old, all_picks, old, path, first=True, grain="month", **SCOPE)
    before = files_of(path)
    now = spark.createDataFrame(lines + late[0], LINES)
    days = plans.refresh_orders(now, all_picks, spark.createDataFrame(late[0], LINES), path, grain="month", **SCOPE)
    assert days == [DAY0 + dt.timedelta(k) for k in range(31)]
    after = files_of(path)
    assert [d.split("part=")[1] for d in sorted(before) if before[d] != after[d]] == ["2026-03-01"] and len(after) == 4
    assert rows(plans.growth_of_orders(sources.read_days(spark, path), "week")) == rows(plans.growth(now, all_picks, "week", **SCOPE))
    assert sources.incremental.whole_periods([dt.date(2026, 3, 7)], "week") == {
        dt.date(2026, 3, 1): [dt.date(2026, 3, k) for k in range(1, 8)]}


def test_a_stores_table_filters_and_names_like_a_mapping(spark, rows, tmp_path):
    names = {f"N{k}": f"Store {k}" for k in range(5000)}
    df = spark.range(20_000).select("id", F.concat(F.lit("N"), (F.col("id") % 9000).cast("string")).alias("node"))
    table = spark.createDataFrame(list(names.items()), "node_id string, store_name string")
    assert rows(ops.store_filter(df, "node", table)) == rows(ops.store_filter(df, "node", list(names)))
    some = {k: names[k] for k in ("N3", "N4999")}
    small = table.filter(F.col("node_id").isin(*some))
    assert rows(ops.store_label(df, "node", small)) == rows(ops.store_label(df, "node", some))
    twice = table.unionByName(table)
    assert ops.store_filter(df, "node", twice).count() == ops.store_filter(df, "node", table).count()
    parted = materialise(df.withColumn("p", F.col("id") % 8).select("id", F.concat(F.lit("N"), F.col("p").cast("string")).alias("node")),
                         f"{tmp_path}/nodes", ["node"])
    chosen = spark.read.parquet(materialise_path(table.limit(4000), tmp_path)).filter(F.col("store_name") == "Store 3")
    plan = plan_of(ops.store_filter(parted, "node", chosen))
    assert "dynamicpruning" in plan


def materialise_path(df, tmp_path):
    df.write.parquet(f"{tmp_path}/stores")
    return f"{tmp_path}/stores"


@pytest.mark.parametrize("grain", ["day", "week", "month"])
def test_date_filters_prune_folders(spark, rows, tmp_path, grain):
    data = [(DAY0 + dt.timedelta(k), k) for k in range(80)]
    df = spark.createDataFrame(data, "day date, n int").select(F.to_timestamp("day").alias("at"), "n",
                                                              ops.filters.to_period(F.col("day"), grain).alias("part"))
    stored, where = materialise(df, f"{tmp_path}/{grain}", ["part"]), ("part", grain)
    anchor = spark.createDataFrame([(DAY0 + dt.timedelta(50),)], "anchor date")
    for filtered, want in ((ops.lookback_filter(stored, "at", DAY0 + dt.timedelta(70), 10, where), range(60, 80)),
                           (ops.start_date_filter(stored, "at", DAY0 + dt.timedelta(45), where), range(45, 80)),
                           (ops.within_days(stored, "at", anchor, 12, where), range(39, 51))):
        assert sorted(r.n for r in filtered.collect()) == list(want)
        scan = [line for line in plan_of(filtered).splitlines() if "FileScan" in line][0]
        assert "part" in scan.split("PartitionFilters: [")[1].split("]")[0].replace("isnotnull(part", "")


def test_a_rerun_runs_only_what_failed(spark, tmp_path):
    calls, broken, history = [], [True], f"{tmp_path}/history"

    def job(name, fails=False):
        def build():
            calls.append((name, spark.sparkContext.getLocalProperty("spark.scheduler.pool")))
            if fails and broken[0]:
                raise LookupError(f"{name} not delivered")
            return spark.range(4)
        return build

    jobs = {"one": job("one"), "two": job("two", True), "three": job("three")}
    first = sources.run_batch(spark, jobs, f"{tmp_path}/out", history=history)
    run_id = first.first().run_id
    assert [(r.job, r.ok) for r in first.collect()] == [("one", True), ("two", False), ("three", True)]
    assert sorted(calls) == [(n, n) for n in ("one", "three", "two")]
    written = os.path.getmtime(f"{tmp_path}/out/one/_SUCCESS")
    broken[0] = False
    calls.clear()
    again = sources.run_batch(spark, jobs, f"{tmp_path}/out", history=history, run_id=run_id)
    assert calls == [("two", "two")] and [(r.job, r.ok, r.rows) for r in again.collect()] == [(n, True, 4) for n in jobs]
    assert os.path.getmtime(f"{tmp_path}/out/one/_SUCCESS") == written
    sources.run_batch(spark, {"one": job("one")}, f"{tmp_path}/out", history=history)
    told = sources.read_history(spark, history)
    assert told.count() == 5 and told.select("run_id").distinct().count() == 2
    runs = {r.run_id: r for r in sources.run_history(told).collect()}
    assert (runs[run_id].queries_ok, runs[run_id].queries_failed) == (3, 0) and len(runs) == 2
    assert sources.read_history(spark, f"{tmp_path}/never").count() == 0


def test_dropped_rows_are_counted_while_the_job_runs(spark, tmp_path):
    def visits():
        drops = sources.Drops()
        text = spark.createDataFrame([("2026-03-01", "N1", 1.0), ("bad", "N1", 2.0), (None, "N9", 3.0), ("2026-03-02", "N9", 4.0),
                                      ("2026-03-03", "N2", float("nan"))], "day string, node string, x double")
        dated = sources.coerce_dates(text, ["day"], drops=drops)
        return drops.keep(dated, "unknown store", F.col("node").isin("N1", "N2")), drops

    def plain():
        return spark.range(3)

    status = sources.run_batch(spark, {"visits": visits, "plain": plain}, str(tmp_path))
    assert {r.job: (r.rows, r.dropped) for r in status.collect()} == {
        "visits": (2, {"unreadable day": 2, "unknown store": 1}), "plain": (3, {})}
    meta = sources.run_metadata(status).first()
    assert [tuple(r) for r in meta.dropped] == [("visits/unknown store", 1), ("visits/unreadable day", 2)]


def star(spark, path, orders, lines=3):
    """Small ``orders`` and ``lineitem`` tables at ``path``."""
    day = F.expr("timestamp_ntz'1996-03-01 00:00:00' + make_interval(0, 0, 0, id % 90)")
    head = spark.range(orders).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 40).alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        F.lit(100.0).alias("o_totalprice"), day.alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"))
    rows = spark.range(orders * lines).select(
        (F.col("id") % orders).alias("l_orderkey"), (F.col("id") % 200).alias("l_partkey"), (F.col("id") % 7).alias("l_suppkey"),
        F.floor(F.col("id") / orders).cast("int").alias("l_linenumber"), F.lit(4.0).alias("l_quantity"), F.lit(80.0).alias("l_extendedprice"),
        F.lit(0.05).alias("l_discount"), F.lit(0.02).alias("l_tax"), F.lit("A").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.expr("timestamp_ntz'1996-04-01 00:00:00'").alias("l_shipdate"))
    head.write.parquet(f"{path}/orders.parquet")
    rows.write.parquet(f"{path}/lineitem.parquet")
    return str(path)


def test_bucket_counts_grow_with_the_facts(spark, rows, tmp_path, monkeypatch):
    assert [session.parts_for(n, 8) for n in (0, 8_000_000, 8_000_001, 216_000_000)] == [8, 8, 9, 216]
    path = star(spark, tmp_path, 1000)
    few = QUERIES["growth_weekly_bucketed"](spark, path)
    assert len(few.inputFiles()) == 2 * 8
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    many = QUERIES["growth_weekly_bucketed"](spark, path)
    assert len(many.inputFiles()) == 2 * 30
    assert rows(many) == rows(few) == rows(QUERIES["growth_weekly"](spark, path)) != []


def test_flagged_lines_are_dealt_to_buckets_that_grow(spark, rows, tmp_path, monkeypatch):
    path = star(spark, tmp_path, 1000)
    few = rows(QUERIES["order_flag_bucketed"](spark, path))
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    many = QUERIES["order_flag_bucketed"](spark, path)
    assert len(many.inputFiles()) == 30
    assert rows(many) == few == rows(QUERIES["order_flag_window"](spark, path)) != []


def test_rows_of_a_day_and_store_meet_periods_once(spark, rows, tmp_path, monkeypatch):
    path, met = star(spark, tmp_path, 2000, lines=1), []
    plain = ops.period_membership
    monkeypatch.setattr(ops, "period_membership", lambda daily, *a, **k: met.append(daily.count()) or plain(daily, *a, **k))
    got = QUERIES["range_membership_periods"](spark, path)
    visits, spans = bindings.order_visits(spark, path), states.periods(spark, path)
    brute = (visits.join(spans, visits.day.between(spans.start, spans.end)).groupBy("kind", "node_id")
             .agg(F.count("*").alias("n"), F.sum("visits").alias("visits")))
    assert rows(got) == rows(brute) != []
    assert met == [visits.select("day", "node_id").distinct().count()] and met[0] < visits.count()


def test_distinct_counts_deal_their_rows_to_enough_partitions(spark, rows, monkeypatch):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), (F.col("id") % 70).alias("a"), F.col("id").cast("int").alias("b"))
    plain = rows(df.groupBy("g").agg(F.countDistinct("a"), F.countDistinct("b")))
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    for cols in ({"a": "a", "b": "b"}, {"a": "a", "b": F.col("b").cast("string")}):
        got = ops.count_distinct(df, ["g"], cols)
        assert rows(got) == plain
        assert ", 10), REPARTITION_BY_NUM" in plan_of(got)
    maps = df.select("g", F.create_map("a", "a").alias("m"), "b")
    assert rows(ops.count_distinct(maps, ["g"], {"m": "m", "b": "b"})) == plain


def test_scorecard_joins_its_lines_once(spark, rows, tmp_path, monkeypatch):
    path, joins, module = star(spark, tmp_path, 300), [], sys.modules["kpiloom.plans.growth"]
    spark.createDataFrame([(k, "c", k % 5, 100.0 * k, "BUILDING") for k in range(40)], bindings.SCHEMAS["customer"]).write.parquet(f"{path}/customer.parquet")
    plain = module.join_picks
    monkeypatch.setattr(module, "join_picks", lambda *a: joins.append(1) or plain(*a))
    QUERIES["scorecard_records"](spark, path)
    scorecard.stored_inputs(spark, path)
    assert len(joins) == 2
    lines = inputs.stored_lines(spark, path)
    for result in (inputs.g_day, inputs.g_week, inputs.g_day_store, inputs.g_week_store):
        assert rows(result(spark, path, lines)) == rows(result(spark, path)) != []
