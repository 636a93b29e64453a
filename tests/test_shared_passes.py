"""Results of the scorecard that are made from one pass over the lines, against the plans that read them alone."""

import datetime as dt
import itertools
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from test_storage import star

from checks import QUERIES, inputs, scorecard
from kpiloom import bindings, plans, session
from kpiloom.functions.masks import held, mask_names, row_masks
from kpiloom.functions.retail import nps_bucket, store_number

D = dt.date
LINES = ("day date, node_id string, purchase_id long, order_id long, status string, fx_ratio double, "
         "TSIE decimal(28,9), TSI decimal(28,9), full_value double, picked_value double")


@pytest.fixture
def lines(spark):
    """Equal lines on two days of a week, in two nodes of one store and in two stores; lines without ids, store, day or pieces."""
    made, nodes = [], ["N0", "N1", "N2", "N8", None]
    days = [D(2026, 4, 5), D(2026, 4, 6), D(2026, 4, 11), D(2026, 4, 12), None]
    for k, (d, n) in enumerate(itertools.product(days, nodes)):
        for order in (1, 2 + k % 3, None):
            made.append((d, n, None if k % 7 == 0 else 10 + k % 4, order, ["paid", "partially_refunded", None][k % 3 if order != 1 else 0],
                         [0.0, 0.5][k % 2 if order != 1 else 0], None if k % 2 else Decimal(k), None if order == 1 else Decimal(1), None if order == 1 else 8.0 + k, 3.0))
    made += made[:9]
    return spark.createDataFrame(made, LINES)


@pytest.mark.parametrize("stores", [{"N0": "North", "N1": "North", "N2": "South"},
                                    {f"N{k}": f"Store {k}" for k in range(9)}, {"N2": None, "N8": "West"}])
def test_tallies_give_what_the_lines_give(spark, rows, lines, stores):
    by_week = plans.lines_by_week(lines, stores)
    assert len([c for c in by_week.columns if c.startswith("mask_")]) == (2 if len(stores) == 9 else 1)
    counted = plans.growth_tallies(by_week)
    for grain in ("day", "week"):
        assert rows(plans.growth_of_tallies(counted, grain, stores)) == rows(plans.growth_of_lines(lines, grain)) != []
        got, alone = plans.growth_of_tallies(counted, grain, stores, True, "P"), plans.growth_of_lines(lines, grain, stores, name="P")
        assert got.schema.simpleString() == alone.schema.simpleString()
        assert rows(got) == rows(alone) != []
    with pytest.raises(ValueError):
        plans.growth_of_tallies(counted, "month", stores)
    assert rows(plans.growth_of_tallies(plans.growth_tallies(plans.lines_by_week(lines.limit(0), stores)), "week", stores)) == []


def test_masks_hold_sets_of_any_size(spark):
    names = mask_names(130)
    united = spark.range(130).where("id % 3 = 0").agg(*[F.bit_or(m).alias(n) for n, m in zip(names, row_masks(F.col("id"), 130), strict=True)])
    found = united.select(held(names, [(k, [0], str(k)) for k in range(130)]).alias("f")).first().f
    assert len(names) == 3 and [s.name for s in found] == [str(k) for k in range(0, 130, 3)]


def test_responses_meet_the_different_stores_of_their_order(spark, rows):
    stores = {f"N{k}": f"S{k}" for k in range(60)}
    at = dt.datetime(2026, 4, 6)
    sold = spark.createDataFrame([(1, at, ("N0",)), (1, at, ("N59",)), (1, at, ("N59",)), (1, at, ("X",)), (2, at, ("N58",)), (None, at, ("N1",))],
                                 "order_id long, closed_at timestamp, item struct<node_id string>")
    survey = spark.createDataFrame([("1", "9", at, "SHOP"), ("1", "9", at, "SHOP"), ("2", "3", at, "SHOP"), ("7", "8", at, "SHOP"), (None, "10", at, "SHOP")],
                                   "order_id string, score string, end_date timestamp, code string")
    shown = {r.Tienda: r.Total_Responses for r in plans.nps_monthly(survey, sold, stores, unmapped="none").collect()}
    assert shown == {"S0": 2, "S59": 2, "S58": 1, "none": 4, "Total": 9}


def test_totals_stand_for_their_rows(spark, rows, tmp_path):
    path = star(spark, tmp_path, 300)
    card, claims, bpp = bindings.scorecard(spark, path), bindings.claims_monthly(spark, path), bindings.bpp_monthly(spark, path)
    for result in (inputs.o_week, inputs.o_day, inputs.o_week_store):
        assert rows(result(spark, path, plans.ops_totals(card))) == rows(result(spark, path))
    assert rows(plans.claims_reasons(plans.claims_totals(claims))) == rows(plans.claims_reasons(claims))
    few = plans.bpp_totals(bpp, "paid_lc", "recovered_lc")
    assert rows(plans.bpp_trend(few, "paid_lc")) == rows(plans.bpp_trend(bpp, "paid_lc"))
    assert rows(plans.bpp_by_type(few, "paid_lc", "recovered_lc")) == rows(plans.bpp_by_type(bpp, "paid_lc", "recovered_lc"))


def test_scorecard_reads_its_facts_once(spark, tmp_path, monkeypatch):
    path, seen = star(spark, tmp_path, 200), Counter()
    spark.createDataFrame([(k, "c", k % 5, 100.0 * k, "BUILDING") for k in range(40)], bindings.SCHEMAS["customer"]).write.parquet(f"{path}/customer.parquet")
    for name in ("order_lines", "scorecard", "plan", "assortment_sheet", "claims_monthly", "bpp_monthly"):
        monkeypatch.setattr(bindings, name, lambda *a, plain=getattr(bindings, name), name=name: seen.update([name]) or plain(*a))
    scorecard.stored_inputs(spark, path)
    assert seen == {"order_lines": 2, "scorecard": 1, "plan": 1, "assortment_sheet": 1, "claims_monthly": 1, "bpp_monthly": 1}
    seen.clear()
    QUERIES["scorecard_records"](spark, path)
    assert seen == {"order_lines": 2, "scorecard": 1}


def test_tables_are_stored_under_their_names(spark, rows, tmp_path):
    tables = {f"t{k}": (lambda k=k: spark.range(k)) for k in range(6)}
    stored = session.materialise_all(spark, tables, {name: str(tmp_path / name) for name in tables}, parallel=3)
    assert {name: df.count() for name, df in stored.items()} == {f"t{k}": k for k in range(6)}
    with pytest.raises(ZeroDivisionError):
        session.materialise_all(spark, {"a": lambda: 1 / 0}, {"a": str(tmp_path / "x")})


def test_conversion_of_days_and_weeks_from_one_count(spark, rows):
    days = [D(2026, 4, 5), D(2026, 4, 6), D(2026, 4, 11), D(2026, 4, 12), D(2026, 5, 3), None]
    page, other = [("ITEM_PAGE",)], [("FOOTER",)]
    sold = spark.createDataFrame([(d, b) for k, d in enumerate(days) for b in (1, 1, 2 + k % 2, None)] + [(D(2026, 6, 1), None)], "day date, buyer_id long")
    seen = spark.createDataFrame([(d, u, p) for k, d in enumerate(days[1:]) for u, p in ((1, page), (1, page), (3 + k % 2, page), (9, other), (None, page))],
                                 "day date, user_id long, page_events array<struct<name string>>")
    for visits in (seen, seen.limit(0)):
        counted = plans.conversion_tallies(sold, visits)
        for plan in (plans.cvr_daily, plans.cvr_weekly):
            got, alone = plan(sold, visits, tallies=counted), plan(sold, visits)
            assert got.schema.simpleString() == alone.schema.simpleString()
            assert rows(got) == rows(alone) != []
    with pytest.raises(ValueError):
        plans.conversion_of_tallies(counted, "month", "Mes")


def test_people_and_lines_of_both_files_are_counted_once(spark, rows, tmp_path, monkeypatch):
    path, seen = star(spark, tmp_path, 200), Counter()
    counts = bindings.cx_counts(spark, path).localCheckpoint()
    assert rows(bindings.cx_month(spark, path, counts)) == rows(bindings.cx_month(spark, path)) != []
    assert rows(bindings.cx_store(spark, path, counts)) == rows(bindings.cx_store(spark, path)) != []
    for module, name in ((bindings, "cx_counts"), (plans, "conversion_tallies")):
        monkeypatch.setattr(module, name, lambda *a, plain=getattr(module, name), name=name: seen.update([name]) or plain(*a))
    monkeypatch.setattr(plans.traffic, "conversion", None)
    QUERIES["scorecard_records"](spark, path)
    assert seen == {"cx_counts": 1, "conversion_tallies": 1}


def test_scores_fall_into_the_bucket_of_their_integer(spark):
    texts = ["6.4999999999999", "6.49999999999999999999", "6.5", "6.500001", "8.5", "8.4999999", "8.999", "9", "10", "10.4999", "10.5", "11", "0.5", "-0.5", "-3",
             "-2147483648", "-2147483648.4", "-2147483648.5", "-2147483649", "-1e12", "1e12", "2147483647.4", "NaN", "Infinity", "-Infinity", "n/a", "", None]
    s = F.round(F.col("x").try_cast("double"), 0).try_cast("int")
    rounded = F.when(s < 7, -1).when(s < 9, 0).when(s.isin(9, 10), 1)
    for made in (spark.createDataFrame([(x,) for x in texts], "x string"), spark.range(-40, 240).select((F.col("id") / 20).alias("x"))):
        found = made.select("x", nps_bucket(F.col("x")).alias("now"), rounded.alias("then")).collect()
        assert [r for r in found if r.now != r.then] == [] and {r.now for r in found} >= {-1, 0, 1, None}


def test_nodes_are_numbered_by_store(spark):
    stores = {"N0": "North", "N1": None, "N2": "South", "N3": "North"}
    number = store_number(F.col("n"), stores)
    got = spark.createDataFrame([(n,) for n in ("N0", "N1", "N2", "N3", "N4", None)], "n string").select(number.alias("k")).collect()
    assert [r.k for r in got] == [1, 0, 2, 1, 0, 0]
    assert spark.sql("SELECT 'N0' AS n").select(store_number(F.col("n"), {}).alias("k")).first().k == 0


def test_a_filter_on_the_score_does_not_round_the_cents_again(spark, tmp_path):
    survey = bindings.survey(spark, star(spark, tmp_path, 20))
    kept = survey.filter(nps_bucket(F.col("score")).isNotNull())
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("round(") == 1
