"""Plans on small inline inputs, against plain Python where the rule is intricate."""

import datetime as dt
import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from kpiloom import plans
from kpiloom.plans import tables

d = dt.date
LINE = ("order_id bigint, purchase_id bigint, buyer_id bigint, status string, closed_at timestamp_ntz, gmv_flag boolean, "
        "auto_offer_flag boolean, fx_ratio double, item struct<node_id: string, unit_price: double, supermarket_flag: boolean>, tags array<string>")
PICK = "order_id bigint, requested_qty double, measure string, picked_qty double, net_weight double"
TAGS = ["supermarket_partnership"]
STORES = {"A": "North", "B": "South"}


def line(order, purchase=1, day=5, price=10.0, node="A", status="paid", fx=0.0, **over):
    row = dict(order_id=order, purchase_id=purchase, buyer_id=1, status=status, closed_at=dt.datetime(2026, 1, day, 12),
               gmv_flag=True, auto_offer_flag=None, fx_ratio=fx, item=(node, price, True), tags=TAGS) | over
    return tuple(row.values())


def test_growth_rules(spark, rows):
    lines = spark.createDataFrame([
        line(1, fx=2.0), line(1, fx=2.0),                      # equal lines count once
        line(2, price=5.0, status="partially_refunded"),       # picked value
        line(3, purchase=2, price=1.0, fx=4.0),                # weight-sold, no pick
        line(4, status="cancelled"), line(5, status=None), line(6, gmv_flag=None), line(7, auto_offer_flag=True),
        line(8, tags=None), line(9, tags=[]),                  # none of these count
        line(10, purchase=3, price=2.0)], LINE)                # no pick row at all
    picks = spark.createDataFrame([(1, 3.0, "unit", 9.0, None), (2, 4.0, None, 1.0, None), (3, 6.0, "kg", None, 2.0)], PICK)
    got = rows(plans.growth_weekly(lines, picks))
    # NMV 30 + 5 + 3; fx mean of 2 and 4; pieces 3 (capped) + 1 + 3
    assert got == [(d(2026, 1, 4), 3, 4, 38.0, 114.0, 7.0, 10)]


def test_growth_by_order_equals_brute_force(spark):
    rng = random.Random(7)
    lines = [line(o, purchase=o % 5, day=rng.randint(1, 28), price=float(rng.randint(1, 3)), node=rng.choice("ABC"),
                  status=rng.choice(["paid", "partially_refunded", "cancelled"]), fx=rng.choice([0.0, 1.0, 2.0]))
             for o in [1] * 40 + [rng.randint(2, 30) for _ in range(80)]]
    picks = [(o, float(rng.randint(1, 4)), "unit", rng.choice([None, 1.0, 2.0, 9.0]), None) for o in list(range(1, 25)) + [1] * 10]
    got = plans.growth_daily_store(spark.createDataFrame(lines, LINE), spark.createDataFrame(picks, PICK), STORES)
    distinct = set()
    for x in lines:
        node = x[8][0]
        if x[3] == "cancelled" or node not in STORES:
            continue
        for p in [p for p in picks if p[0] == x[0]] or [(x[0], None, None, None, None)]:
            req, pick = p[1], p[3]
            tsi = req if pick is not None and pick > req else pick
            value = lambda q: None if q is None else x[8][1] * q
            distinct.add((x[4].date(), STORES[node], x[1], x[0], x[3], x[7], req, tsi, value(req), value(tsi)))
    want = []
    for key, group in itertools.groupby(sorted(distinct, key=repr), key=lambda r: (r[0], r[1])):
        group = list(group)
        net = [r[9] if r[4] == "partially_refunded" else r[8] for r in group]
        total = sum(v for v in net if v is not None) if any(v is not None for v in net) else None
        fx = [r[5] for r in group if r[5]]
        usd = total * sum(fx) / len(fx) if total is not None and fx else None
        pieces = [r[7] if r[7] is not None else r[6] for r in group]
        sums = lambda v: sum(x for x in v if x is not None) if any(x is not None for x in v) else None
        want.append((*key, len({r[2] for r in group}), len({r[3] for r in group}), total,
                     None if usd is None else float(int(usd + 0.5)), sums(pieces), sums([r[6] for r in group])))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)


NESTED = ("order_id bigint, buyer_id bigint, status string, created_at timestamp_ntz, gross_value_usd double, net_value_usd double, "
          "delivery_fee_usd double, service_fee_usd double, items array<struct<node_id: string, supermarket_flag: boolean, tags: array<string>>>")


def nested(spark):
    fresh, dry = ("A", True, TAGS + ["Fresh"]), ("B", True, TAGS)
    at = dt.datetime(2026, 1, 5, 9)
    return spark.createDataFrame([
        (1, 7, "paid", at, 100.0, 80.0, 5.0, 1.0, [fresh, dry, dry]), (2, 7, "paid", at, 50.0, 0.0, 5.0, 1.0, [dry]),
        (3, 8, "paid", at, 10.0, 9.0, 0.0, 0.0, []), (4, 8, None, at, 10.0, 9.0, 0.0, 0.0, [dry]),
        (5, 8, "invalid", at, 10.0, 9.0, 0.0, 0.0, [dry]), (6, 9, "paid", at, 0.0, 0.0, 0.0, 0.0, [("B", None, TAGS), ("Z", True, TAGS)])], NESTED)


def test_growth_daily_order_flag_and_fan_out(spark, rows):
    day = d(2026, 1, 5)
    got = rows(plans.growth_daily(nested(spark), STORES, "2026-02-01"))
    assert got == [(day, "A", 1, 1, 100.0, 1, 1), (day, "B", 2, 1, 250.0, 1, 1)]
    once = rows(plans.growth_daily(nested(spark), STORES, "2026-02-01", order_once=True))
    assert once == [(day, "A", 1, 1, 100.0, 1, 1), (day, "B", 2, 1, 150.0, 1, 1)]


def test_pnl_take_rate(spark, rows):
    got = {r.store_id: r for r in plans.pnl_daily(nested(spark), STORES, "2026-02-01").collect()}
    assert (got["B"].gmv_usd, got["B"].nmv_usd, got["B"].take_rate) == (250.0, 160.0, 0.64)


def test_cancel_rate_counts_statuses(spark, rows):
    lines = spark.createDataFrame([line(1), line(1, status="cancelled"), line(2, status="cancelled"), line(3, node="Z"), line(4, status=None)], LINE)
    assert rows(plans.cancel_rate_weekly(lines, STORES)) == [(d(2026, 1, 4), 2, 4, 0.5)]


def test_nps_with_unmapped_and_many_stores(spark, rows):
    survey = spark.createDataFrame(
        [("1", "10", d(2026, 1, 3), "SHOP"), ("1", "6", d(2026, 1, 9), "SHOP"), ("9", "8", d(2026, 1, 9), "SHOP"),
         ("1", "10", d(2026, 1, 9), "OTHER"), ("1", None, d(2026, 1, 9), "SHOP")], "order_id string, score string, end_date date, code string")
    lines = spark.createDataFrame([line(1), line(1, node="B"), line(1, node="B")], LINE)
    got = rows(plans.nps_monthly(survey, lines, STORES, "SHOP", unmapped="none"))
    m = d(2026, 1, 1)
    assert got == [(m, "North", 0.0, 2, 1, 0, 1), (m, "South", 0.0, 2, 1, 0, 1), (m, "Total", 0.0, 5, 2, 1, 2), (m, "none", 0.0, 1, 0, 1, 0)]


def test_ops_rates_guard_zero(spark, rows):
    data = [(d(2026, 1, 5), 7000, 0.0, 0)]
    cols = "day date, store_id int, fi_requested double, cr_purchases int"
    df = spark.createDataFrame(data, cols)
    for name in ("fi_picked", "fi_picked_replaced", "fc_complete", "fc_complete_replaced", "fc_purchases", "ot_packs", "ot_on_time",
                 "cr_cancels", "cr_buyer_cancels", "cr_stockout_cancels", "cr_seller_cancels"):
        df = df.withColumn(name, F.lit(1))
    week = plans.ops_weekly(df, ["7000"]).collect()[0]
    assert (week.FR_Items, week.Cancel_Rate, week.On_Time) == (None, None, 1.0)
    assert plans.ops_weekly(df, ["7"]).count() == 0


def test_bpp_columns_must_exist(spark):
    bpp = spark.createDataFrame([(202601, " ", 10.0, 4.0, 2.0), (202601, "pdd", 0.0, 1.0, None)], "mes int, CLAIM_TYPE string, paid double, rec double, casos double")
    got = {r.CLAIM_TYPE: (r.paid, r.recovered, r.cases, r.coverage) for r in plans.bpp_by_type(bpp, "paid", "rec").collect()}
    assert got == {"OTHER": (10.0, 4.0, 2, 0.4), "pdd": (0.0, 1.0, 0, None), "TOTAL": (10.0, 5.0, 2, 0.5)}
    with pytest.raises(Exception, match="other_currency"):
        plans.bpp_by_type(bpp, "other_currency", "rec")


def test_plan_weekly_half_even_and_nulls(spark, rows):
    daily = spark.createDataFrame(
        [(d(2026, 1, 4), 1.5, 1.0, None, None, 0.5), (d(2026, 1, 10), 1.0, 1.5, None, None, None)],
        "Fecha date, NMV_V2 double, NSI_V2 double, `NMV_4+8` double, `NSI_4+8` double, `Purchases_4+8` double")
    assert rows(plans.plan_weekly(daily)) == [(d(2026, 1, 4), 2, 2, 0, 0, 0)]


def test_economics_null_on_zero(spark, rows):
    df = spark.createDataFrame([(0, 4, 8.0, 2.0, 4), (2, 4, 0.0, 0.0, 0)], "Compras int, Ordenes int, NMV double, NSI double, TSIE_total int")
    got = rows(plans.unit_economics(df).select("APV_LC", "NASP_LC", "FR_Items", "NSI_Cart", "Ord_Comp"))
    assert got == [(None, None, None, None, 2.0), (None, 2.0, 0.5, 0.5, None)]


def test_metric_table(spark, rows):
    mart = spark.createDataFrame([(1, 10.0, 0.2), (2, None, 0.1), (3, 12.0, None)], "t int, NMV double, Cancel_Rate double")
    table = plans.metric_table(mart, {"NMV": True, "Cancel_Rate": False}, "t")
    got = rows(table.select("metric", "t", "delta", "direction", "point", "height"))
    assert got == [("Cancel_Rate", 1, None, "neutral", 0, 1.0), ("Cancel_Rate", 2, -0.5, "good", 1, 0.0), ("Cancel_Rate", 3, None, "neutral", None, None),
                   ("NMV", 1, None, "neutral", 0, 0.0), ("NMV", 2, None, "neutral", None, None), ("NMV", 3, 0.2, "good", 1, 1.0)]
    assert rows(plans.metric_table_latest(table, "t").select("metric", "t", "value")) == [("Cancel_Rate", 3, None), ("NMV", 3, 12.0)]


def test_status_flags(spark, rows):
    df = spark.createDataFrame([("m", 0.09, -0.1, None)], "m string, Take_Rate double, VC_Over_NMV double, coverage double")
    got = rows(plans.status_flags(df, ["m"]).select("metric", "status"))
    assert got == [("Take_Rate", "good"), ("VC_Over_NMV", "bad"), ("coverage", "bad")]
    assert set(tables.PLAN_METRICS) >= set(tables.BY_VALUE) | set(tables.NO_DELTA)


def test_claims_wide_leaves_out_empty_rows(spark, rows):
    claims = spark.createDataFrame(
        [(d(2026, 1, 9), None, " r ", "v", 2, 1.5), (d(2026, 1, 20), "", "r", "v", 1, None), (d(2026, 2, 1), "North", "q", None, None, 5.0),
         (d(2026, 2, 2), None, "r", "v", 0, None)],
        "mes date, tienda string, motivo string, fallo string, claims int, gmv_reclamado double")
    assert rows(plans.claims_reasons(claims)) == [
        (d(2026, 1, 1), "Total", "r", "v", 3, 1.5), (d(2026, 2, 1), "North", "q", "", 0, 5.0), (d(2026, 2, 1), "Total", "r", "v", 0, 0.0)]
    wide = plans.claims_reasons(claims, wide=True)
    assert wide.columns == ["Tienda", "motivo", "fallo", "2026-01-01", "2026-02-01"]
    assert rows(wide) == [("Total", "r", "v", 3, 0)]


def test_window_without_rows_in_cvr(spark):
    growth = spark.createDataFrame([(d(2026, 7, 1), 1, 1, 5.0, 1.0, 1)], "Fecha date, Compras int, Ordenes int, NMV double, NSI double, TSIE_total int")
    visits = spark.createDataFrame([], "Fecha date, Visitas bigint")
    cvr = spark.createDataFrame([], "Fecha date, Buyers bigint, Visitors bigint, CVR double")
    latest = plans.rolling_7d(growth, visits, cvr, "2026-07-15").filter("bucket = 0").collect()[0]
    assert (latest.label, latest.NMV, latest.Visitas, latest.CVR) == ("P", 5.0, None, None)
    assert plans.rolling_28d(growth, visits, cvr, "2026-07-15").count() == 7


def test_pl_ratios_keep_given_ones_without_nmv(spark, rows):
    lines = ["TGMV", "Net_Variable_Fee", "Net_Monetization", "Product_Net_Monetization", "Variable_Contribution",
             "Direct_Contribution", "Shipping_Cost", "Promotions", "Coupons"]
    pl = spark.createDataFrame([(202601, 0, 0.5), (202602, 100, 0.5)], "Mes int, NMV bigint, Take_Rate double")
    for name in lines:
        pl = pl.withColumn(name, F.lit(9).cast("bigint"))
    got = rows(plans.pl_ratios(pl).select("Mes", "Take_Rate", "VC_Over_NMV"))
    assert got == [(d(2026, 1, 1), 0.5, None), (d(2026, 2, 1), 0.09, 0.09)]


def test_summary_counts_missing_stores_as_zero(spark):
    long = spark.createDataFrame([("A", d(2026, 1, 1), "Gap", 8.0)], "Tienda string, Mes date, metric string, value double")
    gap = lambda **o: plans.assortment_summary(long, **o).collect()[0].Gap
    assert (gap(), gap(stores=["A", "B"])) == (8.0, 4.0)


KEYED_LINE = ("order_id long, line_id int, purchase_id long, buyer_id long, status string, closed_at timestamp, site string, marketplace_id string,"
        "gmv_flag boolean, auto_offer_flag boolean, fx_ratio double, item struct<node_id:string,unit_price:double,supermarket_flag:boolean>, tags array<string>")


def test_order_key_growth_equals_the_pairs_it_does_not_build(spark):
    """All pairs of an order's prices and pieces, by brute force."""
    random.seed(5)
    prices = [1.0, 2.0, 2.0, None, 0.0]
    pieces = [(3.0, 1.0), (3.0, 5.0), (0.0, 0.0), (0.0, None), (None, None), (None, 2.0), (4.0, None)]
    lines, picks, want = [], [], [0.0, 0.0, 0.0]
    for order in range(40):
        status = random.choice(["paid", "partially_refunded"])
        own, got = random.choices(prices, k=random.randint(1, 4)), random.choices(pieces, k=random.randint(0, 4))
        lines += [(order, k, order // 2, 1, status, dt.datetime(2026, 1, 5), "S", "M", True, False, 2.0, ("N0", p, True), ["supermarket_partnership"])
                  for k, p in enumerate(own)]
        picks += [(order, q, "unit", t, 1.0) for q, t in got]
        rows = set()
        for price, (q, t) in itertools.product(own, got or [(None, None)]):
            t = q if t is not None and q is not None and t > q else t
            times = lambda x: None if price is None or x is None else price * x
            rows.add((q, t, times(q), times(t)))
        for q, t, full, part in rows:
            want[0] += (part if status == "partially_refunded" else full) or 0
            want[1] += (q if t is None else t) or 0
            want[2] += q or 0
    orders = spark.createDataFrame(lines, KEYED_LINE)
    details = spark.createDataFrame(picks, "order_id long, requested_qty double, measure string, picked_qty double, net_weight double")
    row = plans.growth_weekly(orders, details).first()
    assert (row.NMV, row.NSI, row.TSIE_total, row.Compras, row.Ordenes) == (*want, 20, 40)


def test_order_key_growth_of_a_hot_order(spark):
    n = 100_000
    lines = spark.range(n).selectExpr(
        "1L AS order_id", "2L AS purchase_id", "'paid' AS status", "timestamp'2026-01-05' AS closed_at", "true AS gmv_flag", "false AS auto_offer_flag",
        "1.0D AS fx_ratio", "struct('N0' AS node_id, cast(id AS double) AS unit_price, true AS supermarket_flag) AS item",
        "array('supermarket_partnership') AS tags")
    picks = spark.range(n).selectExpr("1L AS order_id", "cast(id + 1 AS double) AS requested_qty", "'unit' AS measure",
                                      "cast(null AS double) AS picked_qty", "1.0D AS net_weight")
    start = time.time()
    row = plans.growth_weekly(lines, picks).first()
    assert row.NMV == pytest.approx(sum(range(n)) * sum(range(1, n + 1))) and time.time() - start < 60
