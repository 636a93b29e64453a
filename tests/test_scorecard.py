"""Which marts the scorecard shows, and from what."""

import datetime as dt
import json

import pytest

from kpiloom import plans

D = dt.date
GROWTH = "Fecha date, Compras long, Ordenes long, NMV double, NMV_USD double, NSI double, TSIE_total long"


def growth(spark, *rows):
    return spark.createDataFrame([(d, c, 2 * c, 10.0 * c, 1.0 * c, 3.0 * c, 4 * c) for d, c in rows], GROWTH)


@pytest.fixture
def week(spark):
    return growth(spark, (D(2026, 4, 5), 5), (D(2026, 4, 12), 6), (D(2026, 5, 3), 7))


def of(records, mart):
    return sorted((tuple(r["keys"]), json.loads(r["values"])) for r in records.where(f"mart = '{mart}'").collect())


def test_marts_without_their_lookups_keep_the_rest(spark, week):
    records = plans.scorecard_records({"growth_week": week}, "2026-06-15")
    assert sorted({r.mart for r in records.collect()}) == ["monthly", "weekly"]
    shown = of(records, "weekly")
    assert [(k, v["Compras"], v["Visitas"], v["CVR"], v["Stores"], v["label"]) for k, v in shown] == [
        (("2026-04-05",), 5, None, None, None, "5/abr"), (("2026-04-12",), 6, None, None, None, "12/abr"),
        (("2026-05-03",), 7, None, None, None, "3/may")]
    visits = spark.createDataFrame([(D(2026, 4, 5), 100)], "Fecha date, Visitas long")
    shown = of(plans.scorecard_records({"growth_week": week, "visits_week": visits}, "2026-06-15"), "monthly")
    assert [(k, v["Compras"], v["Visitas"], v["label"]) for k, v in shown] == [
        (("2026-04-01",), 11, 100, "Abr'26"), (("2026-05-01",), 7, None, "May'26")]


def test_daily_growth_without_rows_gives_way_to_weekly(spark, week):
    empty, some = growth(spark), growth(spark, (D(2026, 4, 7), 4))
    months = lambda day: [(k[0], v["Compras"]) for k, v in of(
        plans.scorecard_records({"growth_week": week, "growth_day": day}, "2026-06-15"), "monthly")]
    assert months(empty) == [("2026-04-01", 11), ("2026-05-01", 7)]
    assert months(some) == [("2026-04-01", 4)]


def test_marts_without_a_main_input_are_left_out(spark, week):
    assert plans.scorecard_marts({}, "2026-06-15") == {}
    ops = spark.createDataFrame([(D(2026, 4, 5), *[0.5] * 10)], "Semana date, " + ", ".join(
        f"{c} double" for c in ("FR_Items", "FR_Items_Reemplazo", "FR_Compras", "FR_Compras_Reemplazo", "Compra_Perfecta", "On_Time",
                                "Cancel_Rate", "Cancel_Buyer", "Cancel_Stockout", "Cancel_Seller")))
    assert sorted(plans.scorecard_marts({"ops_week": ops}, "2026-06-15")) == ["monthly_ops", "weekly_ops"]
    shown = plans.scorecard_tables({"ops_week": ops, "growth_week": week}, "2026-06-15")
    latest = {(r.view, r.period) for r in shown.where("latest").collect()}
    assert latest == {("weekly", D(2026, 5, 3)), ("monthly", D(2026, 5, 1)), ("weekly_ops", D(2026, 4, 5)), ("monthly_ops", D(2026, 4, 1))}
    change = shown.where("view = 'weekly' and metric = 'Compras' and latest").first()
    assert (change.value, change.prev_value, change.direction) == (7.0, 6.0, "good")
