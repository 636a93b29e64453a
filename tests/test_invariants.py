"""Relations that hold between results, on the generated tables."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from checks import inputs as i
from kpiloom import bindings as b, plans
from kpiloom.functions import month_start, week_sunday

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="generated tables not present")


def mismatches(left, right, key, cols, within=0):
    both = left.select(*key, *[F.col(c).alias(f"l_{c}") for c in cols]).join(right.select(*key, *cols), key, "full")
    apart = [F.abs(F.coalesce(f"l_{c}", F.lit(0)) - F.coalesce(c, F.lit(0))) > within for c in cols]
    bad = apart[0]
    for a in apart[1:]:
        bad = bad | a
    return both.filter(bad).count()


def test_a_cart_of_two_days_counts_on_both_but_once_a_week(spark):
    line = ("order_id long, purchase_id long, day date, node_id string, status string, fx_ratio double, TSIE double, TSI double, "
            "full_value double, picked_value double")
    lines = spark.createDataFrame([(1, 9, dt.date(2026, 3, 2), "N0", "paid", 1.0, 1.0, 1.0, 5.0, 5.0), (2, 9, dt.date(2026, 3, 3), "N0", "paid", 1.0, 1.0, 1.0, 5.0, 5.0)], line)
    assert plans.growth_of_lines(lines, "week").first().Compras == 1
    assert sum(r.Compras for r in plans.growth_of_lines(lines, "day").collect()) == 2


def test_days_add_up_to_weeks(spark):
    week = i.g_week(spark, SF)
    days = (i.g_day(spark, SF).groupBy(week_sunday(F.col("Fecha")).alias("Fecha"))
            .agg(*[F.sum(c).alias(c) for c in ("Ordenes", "Compras", "NMV", "NSI")]))
    assert mismatches(week, days, ["Fecha"], ["Ordenes"]) == 0
    assert mismatches(week, days, ["Fecha"], ["NMV", "NSI"], within=7) == 0


def test_rates_follow_from_counts(spark):
    cvr = i.c_week(spark, SF)
    assert cvr.filter(~F.col("CVR").eqNullSafe(F.round(F.try_divide("Buyers", "Visitors"), 4))).count() == 0
    nps = i.nps(spark, SF)
    assert nps.filter(F.col("Total_Responses") != F.col("Promotores") + F.col("Neutros") + F.col("Detractores")).count() == 0


def test_nps_total_is_the_sum_of_stores(spark):
    nps = i.nps(spark, SF)
    total = nps.filter("Tienda = 'Total'")
    stores = nps.filter("Tienda != 'Total'").groupBy("Mes").agg(F.sum("Total_Responses").alias("Total_Responses"))
    assert mismatches(total, stores, ["Mes"], ["Total_Responses"]) == 0


def test_perfect_purchase_is_purchase_fill(spark):
    assert i.o_week(spark, SF).filter("not (Compra_Perfecta <=> FR_Compras)").count() == 0


def test_sheet_reproduces_the_plan(spark):
    daily = plans.plan_daily(b.plan_sheet(spark, SF), F.col("sheet"))
    assert mismatches(b.plan(spark, SF), daily, ["Fecha"], ["NMV_V2", "NSI_V2"]) == 0
    months = plans.plan_monthly(b.plan_sheet(spark, SF), F.col("sheet"), ["sheet"])
    summed = daily.groupBy(month_start(F.col("Fecha")).alias("Mes")).agg(F.sum("NMV_V2").alias("NMV_V2"))
    assert mismatches(months, summed, ["Mes"], ["NMV_V2"]) == 0


def test_segment_shares_near_100(spark):
    from kpiloom.constants import SEGMENTS
    from kpiloom.operators import share_of_total
    demo = plans.demo_segment_month(b.demographics(spark, SF))
    total = share_of_total(demo, "Mes", "segment", "MABs", SEGMENTS).groupBy("Mes").agg(F.sum("share").alias("s"), F.sum("MABs").alias("n"))
    assert total.filter("n > 0 and abs(s - 100) > 2").count() == 0


def test_exact_buyers_never_exceed_summed_ones(spark):
    exact = plans.buyers_exact(b.store_sales(spark, SF))
    weekly = plans.monthly_buyers_store(plans.buyers_weekly_store(b.store_sales(spark, SF)))
    total = lambda df: df.agg(F.sum("Buyers")).first()[0]
    assert total(exact) <= total(weekly)
