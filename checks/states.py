"""Checks of mergeable distinct counts and of joins with a table of periods.

States are stored first; the counts read only the stored tables.
"""

from pyspark.sql import functions as F

from checks import inputs as i
from checks.registry import check, shared_path
from checks.tables_sql import ECONOMICS, growth_sql, month, week
from kpiloom import bindings as b, operators as ops, plans
from kpiloom.functions.dates import to_period
from kpiloom.session import materialise


def numbered(spark, facts, col, name):
    return materialise(ops.number_ids(facts, col), shared_path(spark, f"{name}-numbers"))


def buyer_states(spark, sf):
    """Daily states of buyers per store."""
    sales = b.store_sales(spark, sf)
    states = plans.people_states(sales, numbered(spark, sales, "buyer_id", "sales"), "buyer_id", keys=["store"])
    return materialise(states, shared_path(spark, "buyer-states"))


@check("buyers_month_store_states", f"""SELECT {month('day')} AS Mes, store, count(DISTINCT buyer_id) AS Buyers FROM store_sales GROUP BY 1, 2""")
def _(spark, sf):
    return plans.people_per_period(buyer_states(spark, sf), "month", period="Mes", keys=["store"])


@check("buyers_week_states", f"SELECT {week('day')} AS Semana, count(DISTINCT buyer_id) AS Buyers FROM store_sales GROUP BY 1")
def _(spark, sf):
    return plans.people_per_period(buyer_states(spark, sf), "week", period="Semana")


@check("buyers_ytd_exact", f"""WITH m AS (SELECT DISTINCT {month('day')} AS Mes, buyer_id FROM store_sales)
SELECT a.Mes, count(DISTINCT CASE WHEN m.Mes = a.Mes THEN buyer_id END) AS Total_Buyers, count(DISTINCT buyer_id) AS YTD_Buyers
FROM (SELECT DISTINCT Mes FROM m) a JOIN m ON m.Mes <= a.Mes AND year(m.Mes) = year(a.Mes) GROUP BY 1""")
def _(spark, sf):
    return plans.buyers_ytd_exact(buyer_states(spark, sf))


@check("rolling_buyers_28d", """WITH a AS (SELECT least(max(day), DATE '2001-07-14') AS anchor FROM store_sales)
SELECT s.bucket, CASE WHEN s.bucket = 0 THEN 'P28' ELSE 'P28-' || s.bucket END AS label, anchor - s.bucket * 28 - 27 AS start,
  anchor - s.bucket * 28 AS "end", coalesce(Buyers, 0) AS Buyers
FROM (SELECT anchor, CAST(unnest(range(7)) AS INTEGER) AS bucket FROM a) s
LEFT JOIN (SELECT CAST((anchor - day) // 28 AS INTEGER) AS bucket, count(DISTINCT buyer_id) AS Buyers FROM store_sales, a
  WHERE anchor - day BETWEEN 0 AND 195 GROUP BY 1) USING (bucket)""")
def _(spark, sf):
    states = buyer_states(spark, sf)
    return plans.rolling_people(states, ops.rolling_anchor(states, "day", i.AS_OF), 28, 7, "P28")


@check("buyers_trailing_weeks", f"""WITH w AS (SELECT DISTINCT {week('day')} AS Semana, buyer_id FROM store_sales)
SELECT a.Semana, count(DISTINCT buyer_id) AS Buyers FROM (SELECT DISTINCT Semana FROM w) a
JOIN w ON a.Semana - w.Semana BETWEEN 0 AND 27 GROUP BY 1""")
def _(spark, sf):
    weeks = ops.unite_states(buyer_states(spark, sf), {"Semana": to_period(F.col("day"), "week")})
    return ops.trailing_counts(weeks, "Semana", 28, "Buyers")


@check("monthly_kpis_exact", f"""
SELECT Mes, Compras, Ordenes, NMV, NSI, {ECONOMICS}, Visitas, Buyers, Visitors, Buyers / nullif(Visitors, 0) AS CVR, Stores
FROM ({growth_sql('month', name='Mes')}) g
LEFT JOIN (SELECT {month('Fecha')} AS Mes, CAST(sum(Visitas) AS BIGINT) AS Visitas FROM v_day GROUP BY 1) USING (Mes)
LEFT JOIN (SELECT Mes, coalesce(Buyers, 0) AS Buyers, coalesce(Visitors, 0) AS Visitors
  FROM (SELECT {month('day')} AS Mes, count(DISTINCT buyer_id) AS Buyers FROM order_buyers GROUP BY 1)
  FULL JOIN (SELECT {month('day')} AS Mes, count(DISTINCT user_id) AS Visitors FROM order_traffic GROUP BY 1) USING (Mes)) USING (Mes)
LEFT JOIN (SELECT Mes, count(DISTINCT Tienda) AS Stores FROM ({growth_sql('month', store=True, name='Mes')}) GROUP BY 1) USING (Mes)
WHERE Mes <= DATE '2001-06-30'""")
def _(spark, sf):
    lines = i.valued(spark, sf)
    buyers, traffic = b.order_buyers(spark, sf), b.order_traffic(spark, sf)
    people = buyers.select(F.col("buyer_id").alias("id")).unionByName(traffic.select(F.col("user_id").alias("id")))
    numbers = numbered(spark, people, "id", "people")
    states = [materialise(plans.people_states(facts, numbers, col), shared_path(spark, f"{col}-states"))
              for facts, col in ((buyers, "buyer_id"), (traffic, "user_id"))]
    by_store = plans.growth_of_lines(lines, "month", b.STORES, name="Mes")
    return plans.monthly_kpis_exact(plans.growth_of_lines(lines, "month"), i.v_day(spark, sf), *states, by_store, i.AS_OF)


PERIODS = """SELECT CAST(o_orderdate AS DATE) AS start, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 200 AS INTEGER) - 20 AS "end",
  o_orderkey % 50 AS kind FROM orders WHERE o_orderkey % 97 = 3 GROUP BY ALL"""


def periods(spark, sf):
    """Overlapping periods of -20 to 179 days, some of which end before they start."""
    start = F.to_date("o_orderdate")
    return b.scan_table(spark, "orders", sf).where("o_orderkey % 97 = 3").select(
        start.alias("start"), F.date_add(start, (F.col("o_orderkey") % 200).cast("int") - 20).alias("end"),
        (F.col("o_orderkey") % 50).alias("kind")).distinct()


@check("range_membership_periods", f"""SELECT kind, node_id, count(*) AS n, CAST(sum(visits) AS BIGINT) AS visits
FROM order_visits JOIN ({PERIODS}) p ON day BETWEEN p.start AND p."end" GROUP BY 1, 2""")
def _(spark, sf):
    # the rows of a day and store lie in the same periods: they meet them as one row, as in ``period_sums``
    days = b.order_visits(spark, sf).groupBy("day", "node_id").agg(F.count("*").alias("n"), F.sum("visits").alias("visits"))
    met = ops.period_membership(days, "day", periods(spark, sf))
    return met.groupBy("kind", "node_id").agg(F.sum("n").alias("n"), F.sum("visits").alias("visits"))


@check("period_sums", f"""SELECT p.start, p."end", kind, CAST(coalesce(sum(visits), 0) AS BIGINT) AS visits
FROM ({PERIODS}) p LEFT JOIN order_visits ON day BETWEEN p.start AND p."end" GROUP BY 1, 2, 3""")
def _(spark, sf):
    return ops.period_sums(b.order_visits(spark, sf), "day", periods(spark, sf), ["visits"])


@check("count_distinct_if_several", """SELECT node_id, count(DISTINCT CASE WHEN status = 'cancelled' THEN order_id END) AS cancelled,
  count(DISTINCT CASE WHEN unit_price > 1200 THEN purchase_id END) AS dear, count(DISTINCT closed_at) AS days FROM order_lines GROUP BY 1""")
def _(spark, sf):
    lines = b.order_lines(spark, sf).select("*", "item.*")
    return ops.count_distinct_if(lines, ["node_id"], {
        "cancelled": ("order_id", F.col("status") == "cancelled"), "dear": ("purchase_id", F.col("unit_price") > 1200),
        "days": ("closed_at", F.lit(True))})
