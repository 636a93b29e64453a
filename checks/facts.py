"""Checks of the query-level plans over fact tables."""

from pyspark.sql import functions as F

from checks import inputs as i
from checks.registry import check
from checks.tables_sql import (
    STORE_LIST, STORE_RATE_NAMES, cvr_sql, growth_sql, month, store_case, week)
from kpiloom import bindings as b, plans

check("growth_weekly", growth_sql("week"))(i.g_week)
check("growth_weekly_line_key", growth_sql("week", line_key=True))(
    lambda spark, sf: plans.growth_weekly(b.order_lines(spark, sf), b.picks(spark, sf), i.START, line_key=b.PICK_KEYS[1:], **i.SCOPE))
check("growth_weekly_order_key", growth_sql("week", order_key=True))(
    lambda spark, sf: plans.growth_weekly(b.order_lines(spark, sf), b.picks(spark, sf), i.START, site="S1", marketplace="TM"))
check("growth_daily_net", growth_sql("day"))(i.g_day)
check("growth_weekly_store", growth_sql("week", True, name="Semana"))(i.g_week_store)
check("growth_daily_store", growth_sql("day", True, True))(i.g_day_store)


@check("growth_daily", """
WITH live AS (SELECT * FROM scoped_items WHERE status NOT IN ('cancelled', 'invalid')),
fresh AS (SELECT order_id FROM live WHERE list_contains(string_split(lower(array_to_string(tags, ',')), ','), 'fresh') GROUP BY order_id),
sold AS (SELECT order_date, store_id, round(sum(gross_value_usd), 2) AS gmv_usd FROM live GROUP BY ALL),
ids AS (SELECT DISTINCT l.order_date, l.store_id, l.order_id, l.buyer_id, f.order_id IS NOT NULL AS is_fresh
  FROM live l LEFT JOIN fresh f ON l.order_id = f.order_id),
counted AS (SELECT order_date, store_id, count(DISTINCT order_id) AS orders, count(DISTINCT buyer_id) AS buyers FROM ids GROUP BY ALL),
chilled AS (SELECT order_date, store_id, count(DISTINCT order_id) AS fresh_orders, count(DISTINCT buyer_id) AS fresh_buyers
  FROM ids WHERE is_fresh GROUP BY ALL)
SELECT order_date, store_id, orders, buyers, gmv_usd, coalesce(fresh_orders, 0) AS fresh_orders, coalesce(fresh_buyers, 0) AS fresh_buyers
FROM counted JOIN sold USING (order_date, store_id) LEFT JOIN chilled USING (order_date, store_id)""")
def _(spark, sf):
    return plans.growth_daily(b.nested_orders(spark, sf), b.STORES, i.LOOKBACK_AS_OF)


PNL = """
WITH amounts AS (SELECT order_date, store_id, order_id, sum(gross_value_usd) AS gross, sum(net_value_usd) AS net,
    sum(delivery_fee_usd) AS delivery, sum(service_fee_usd) AS service
  FROM {} WHERE coalesce(status NOT IN ('cancelled', 'invalid'), FALSE) GROUP BY ALL)
SELECT order_date, store_id, count(order_id) AS orders, round(sum(gross), 2) AS gmv_usd, round(sum(net), 2) AS nmv_usd,
  round(sum(delivery), 2) AS delivery_fee_usd, round(sum(service), 2) AS service_fee_usd,
  CASE WHEN sum(gross) != 0 THEN round(sum(net) / sum(gross), 4) END AS take_rate
FROM amounts GROUP BY ALL"""


@check("pnl_daily", PNL.format("scoped_items"))
def _(spark, sf):
    return plans.pnl_daily(b.nested_orders(spark, sf), b.STORES, i.LOOKBACK_AS_OF)


# a lookback that leaves out most of the table
@check("pnl_daily_recent", PNL.format("(SELECT * FROM scoped_items_all WHERE order_date >= DATE '2000-06-01' - 395)"))
def _(spark, sf):
    return plans.pnl_daily(b.nested_orders(spark, sf), b.STORES, "2000-06-01")


@check("visits_daily_store", f"""
SELECT day AS visit_date, node_id AS store_id, CAST(sum(sessions) AS BIGINT) AS sessions, CAST(sum(visitors) AS BIGINT) AS unique_visitors
FROM event_visits WHERE node_id IN {STORE_LIST} AND day >= DATE '2024-06-01' - 395 GROUP BY 1, 2""")
def _(spark, sf):
    return plans.visits_daily_store(b.event_visits(spark, sf), b.STORES, "2024-06-01")


VISITS = "SELECT {} AS Fecha, CAST(sum(visits) AS BIGINT) AS Visitas FROM event_visits WHERE site = 'S1' AND model = 'INSTORE' AND day >= DATE '2024-01-01' GROUP BY 1"


@check("visits_weekly", VISITS.format(week("day")))
def _(spark, sf):
    return plans.visits_weekly(b.event_visits(spark, sf), "2024-01-01", site="S1", model="INSTORE")


@check("visits_daily", VISITS.format("day"))
def _(spark, sf):
    return plans.visits_daily(b.event_visits(spark, sf), "2024-01-01", site="S1", model="INSTORE")


IN_STORE = "(SELECT * FROM {} WHERE site = 'S1' AND model = 'INSTORE' AND day >= DATE '2024-01-01' {})"
SEEN = "AND list_has_any(events, ['ITEM_PAGE', 'HOME_INSTORE', 'ADD_TO_CART', 'HOME_STORE_BUTTON'])"


def _cvr(grain, name):
    return cvr_sql(grain, name, IN_STORE.format("buyer_orders", ""), IN_STORE.format("traffic", SEEN))


@check("cvr_weekly", _cvr("week", "Semana"))
def _(spark, sf):
    return plans.cvr_weekly(b.buyer_orders(spark, sf), b.traffic(spark, sf), "2024-01-01", site="S1", model="INSTORE")


@check("cvr_daily", _cvr("day", "Fecha"))
def _(spark, sf):
    return plans.cvr_daily(b.buyer_orders(spark, sf), b.traffic(spark, sf), "2024-01-01", site="S1", model="INSTORE")


check("buyers_weekly_store", "SELECT * FROM b_week_store")(i.b_week_store)


@check("cancel_rate_weekly", f"""
SELECT Semana, count(*) FILTER (status = 'cancelled') AS Cancelled, count(*) AS Total_Orders,
  round(count(*) FILTER (status = 'cancelled') / nullif(count(*), 0), 4) AS Cancel_Rate
FROM (SELECT DISTINCT {week('closed_at')} AS Semana, order_id, status FROM scoped WHERE node_id IN {STORE_LIST}) GROUP BY 1""")
def _(spark, sf):
    return plans.cancel_rate_weekly(b.order_lines(spark, sf), b.STORES, i.START, site="S1", marketplace="TM")


SCORECARD = ("cancel_rate", "cancels_total", "cancels_seller", "cancels_buyer", "cancels_stockout", "fill_rate", "ot_rate",
             "ot_early_pct", "ot_delay_pct", "ot_ontime_pct", "perfect_purchase_rate", "total_orders")


@check("ops_scorecard", f"""
SELECT day AS order_date, node_id AS store_id, {', '.join(f'coalesce({c}, 0) AS {c}' for c in SCORECARD)}
FROM scorecard WHERE node_id IN {STORE_LIST} AND day >= DATE '1993-06-01' - 395""")
def _(spark, sf):
    return plans.ops_scorecard(b.scorecard(spark, sf), b.STORES, "1993-06-01")


check("ops_weekly", "SELECT * FROM o_week")(i.o_week)
check("ops_weekly_store", f"SELECT Semana, Tienda, {', '.join(STORE_RATE_NAMES)} FROM o_week_store")(i.o_week_store)

check("ops_daily", "SELECT * FROM o_day")(i.o_day)

RECENT = f"node_id IN {STORE_LIST} AND day >= DATE '1993-06-01' - 395"


@check("cancels_by_type", f"""
SELECT day AS cancel_date, node_id AS store_id, upper(reason_type) AS cancel_type, count(*) AS cancels FROM cancels WHERE {RECENT} GROUP BY 1, 2, 3""")
def _(spark, sf):
    return plans.cancels_by_type(b.cancels(spark, sf), b.STORES, "1993-06-01")


@check("ontime_by_status", f"""
SELECT day AS pack_date, node_id AS store_id, upper(status) AS ot_status, count(DISTINCT pack_id) AS packs FROM ontime_packs WHERE {RECENT} GROUP BY 1, 2, 3""")
def _(spark, sf):
    return plans.ontime_by_status(b.ontime_packs(spark, sf), b.STORES, "1993-06-01")


@check("perfect_purchase", f"""
SELECT day AS order_date, node_id AS store_id, count(DISTINCT order_id) AS total_orders,
  CAST(sum(CAST(perfect_flag AS INTEGER)) AS BIGINT) AS perfect_orders FROM perfect_orders WHERE {RECENT} GROUP BY 1, 2""")
def _(spark, sf):
    return plans.perfect_purchase(b.perfect_orders(spark, sf), b.STORES, "1993-06-01")


@check("fill_rate_items", f"""
SELECT day AS order_date, node_id AS store_id, sum(fi_requested) AS items_ordered, sum(fi_picked) AS items_picked,
  round(sum(fi_picked) / nullif(sum(fi_requested), 0), 4) AS fill_rate FROM scorecard WHERE {RECENT} GROUP BY 1, 2""")
def _(spark, sf):
    return plans.fill_rate_items(b.fill_items(spark, sf), b.STORES, "1993-06-01")


@check("claims_by_order", """
SELECT o.order_date, o.store_id, c.claim_date, c.claim_type, c.claim_result, count(DISTINCT c.order_id) AS claims
FROM (SELECT * FROM claims WHERE respondent_id = 101 AND claim_date >= DATE '1993-06-01' - 395) c
JOIN (SELECT DISTINCT order_id, order_date, store_id FROM order_items WHERE supermarket_flag IS TRUE
  AND array_to_string(tags, ',') LIKE '%supermarket_partnership%' AND store_id IN ('N0', 'N1', 'N2', 'N3')) o
ON c.order_id = o.order_id GROUP BY 1, 2, 3, 4, 5""")
def _(spark, sf):
    return plans.claims_by_order(b.claims(spark, sf), b.nested_orders(spark, sf), b.STORES, "1993-06-01", 101)


@check("bpp_daily", """
SELECT day AS bpp_date, upper(claim_type) AS claim_type, round(sum(total_usd), 2) AS bpp_total_usd,
  round(sum(recovery_usd), 2) AS bpp_recovery_usd, count(*) AS cases FROM bpp WHERE day >= DATE '1993-06-01' - 395 GROUP BY 1, 2""")
def _(spark, sf):
    return plans.bpp_daily(b.bpp(spark, sf), "1993-06-01")


check("nps_monthly", "SELECT * FROM nps")(i.nps)


@check("nps_pivot", "SELECT Tienda, CAST(Mes AS VARCHAR) AS Mes, NPS_Score FROM nps WHERE NPS_Score IS NOT NULL")
def _(spark, sf):
    wide = plans.nps_pivot(i.nps(spark, sf))
    return wide.unpivot(["Tienda"], [c for c in wide.columns if c != "Tienda"], "Mes", "NPS_Score").dropna()


@check("nps_pivot_status", """
SELECT Tienda, Mes, NPS_Score, CASE WHEN NPS_Score >= 50 THEN 'good' WHEN NPS_Score >= 20 THEN 'neutral' WHEN NPS_Score IS NOT NULL THEN 'bad' END AS status
FROM nps""")
def _(spark, sf):
    return plans.nps_pivot(i.nps(spark, sf), wide=False)


@check("buyers_monthly_exact", f"SELECT {month('day')} AS Mes, store AS TIENDA, count(DISTINCT buyer_id) AS Buyers FROM store_sales GROUP BY 1, 2")
def _(spark, sf):
    return plans.buyers_exact(b.store_sales(spark, sf))
