"""Checks of bucketed facts, incremental marts, batches with a history, stores as a table and pruned folders."""

import uuid

from pyspark.sql import functions as F

from checks import inputs as i
from checks.registry import check, shared_path
from checks.tables_sql import STORE_LIST, month
from kpiloom import bindings as b, functions as fn, operators as ops, plans, sources
from kpiloom.session import bucketed, materialise, parts_for

#: Least buckets of the checks' facts; there are so many that each fits one task.
BUCKETS = 8
LINE_SCOPE = {"site": "S1", "marketplace": "TM", "start": i.START}


def buckets(spark, sf):
    """Buckets of all facts by order: as many as the picks need, which have a row per line and are no join."""
    return parts_for(b.picks(spark, sf).count(), BUCKETS)


def by_order(spark, facts, name, count):
    """``facts`` in ``count`` buckets of their order id."""
    return bucketed(facts, shared_path(spark, name), f"{name}_{uuid.uuid4().hex}", ["order_id"], count)


@check("growth_weekly_bucketed", "SELECT * FROM g_week")
def _(spark, sf):
    count = buckets(spark, sf)
    lines, picks = by_order(spark, b.order_lines(spark, sf), "lines", count), by_order(spark, b.picks(spark, sf), "picks", count)
    return plans.growth_weekly(lines, picks, i.START, **i.SCOPE)


@check("order_flag_bucketed", """SELECT status, order_flag, count(*) AS n, CAST(sum(order_id) AS BIGINT) AS checksum
FROM order_lines JOIN (SELECT order_id, max(CASE WHEN node_id = 'N4' THEN 1 ELSE 0 END) AS order_flag FROM order_lines GROUP BY 1) USING (order_id)
GROUP BY 1, 2""")
def _(spark, sf):
    lines = by_order(spark, b.order_lines(spark, sf), "flag_lines", buckets(spark, sf))
    flagged = ops.order_flag_window(lines, "order_id", F.col("item.node_id") == "N4", known_keys=True)
    return flagged.groupBy("status", "order_flag").agg(F.count("*").alias("n"), F.sum("order_id").alias("checksum"))


def order_state(spark, sf, stores=None):
    """The state after two runs: every third order arrives late, in months that the first run has already written."""
    lines, picks, path = b.order_lines(spark, sf), b.picks(spark, sf), shared_path(spark, "order-state")
    early, late = lines.filter("order_id % 3 != 0"), lines.filter("order_id % 3 = 0")
    options = {"stores": stores, "grain": "month", "pick_keys": b.PICK_KEYS, **LINE_SCOPE}
    plans.refresh_orders(early, picks, early, path, first=True, **options)
    plans.refresh_orders(lines, picks, late, path, **options)
    return sources.read_days(spark, path)


@check("growth_daily_incremental", "SELECT * FROM g_day")
def _(spark, sf):
    return plans.growth_of_orders(order_state(spark, sf), "day")


@check("growth_weekly_store_incremental", "SELECT * FROM g_week_store")
def _(spark, sf):
    return plans.growth_of_orders(order_state(spark, sf, b.STORES), "week", "Semana")


def _runs(spark, sf):
    """A batch with a failing job, and its repetition after the input has come."""
    delivered = []

    def late():
        if not delivered:
            raise LookupError("input not delivered")
        return i.v_week(spark, sf)

    jobs = {"visits": lambda: i.v_day(spark, sf), "buyers": lambda: i.b_week_store(spark, sf), "late": late}
    path, history = shared_path(spark, "batch"), shared_path(spark, "batch-history")
    run_id = sources.run_batch(spark, jobs, path, history=history).first().run_id
    delivered.append(True)
    sources.run_batch(spark, jobs, path, history=history, run_id=run_id)
    return sources.read_history(spark, history)


@check("batch_history", """SELECT 'visits' AS job, CAST(1 AS BIGINT) AS attempts, CAST(0 AS BIGINT) AS failures, (SELECT count(*) FROM v_day) AS rows
UNION ALL SELECT 'buyers', 1, 0, (SELECT count(*) FROM b_week_store) UNION ALL SELECT 'late', 2, 1, (SELECT count(*) FROM v_week)""")
def _(spark, sf):
    return _runs(spark, sf).groupBy("job").agg(
        F.count("*").alias("attempts"), F.count_if(~F.col("ok")).alias("failures"), F.sum("rows").alias("rows"))


@check("dropped_rows", f"""SELECT (SELECT count(*) FROM orders WHERE o_orderpriority = '1-URGENT') AS unreadable,
  (SELECT count(*) FROM orders WHERE o_orderpriority != '1-URGENT' AND 'N' || CAST(o_orderkey % 5 AS VARCHAR) NOT IN {STORE_LIST}) AS unknown,
  (SELECT count(*) FROM orders WHERE o_orderpriority != '1-URGENT' AND 'N' || CAST(o_orderkey % 5 AS VARCHAR) IN {STORE_LIST}) AS rows""")
def _(spark, sf):
    def orders():
        drops = sources.Drops()
        text = F.when(F.col("o_orderpriority") == "1-URGENT", "31/31/1999").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        rows = b.scan_table(spark, "orders", sf).select(text.alias("day"), F.concat(F.lit("N"), (F.col("o_orderkey") % 5).cast("string")).alias("node"))
        dated = sources.coerce_dates(rows, ["day"], drops=drops)
        return drops.keep(dated, "unknown store", F.col("node").isin(*b.STORES)), drops

    status = sources.run_batch(spark, {"orders": orders}, shared_path(spark, "dropped"))
    return status.select(F.col("dropped")["unreadable day"].alias("unreadable"), F.col("dropped")["unknown store"].alias("unknown"), "rows")


def store_table(spark, sf):
    """Stores as a dimension: the nodes that occur, with names for the listed ones."""
    nodes = b.store_sales(spark, sf).select(F.col("store").alias("node_id")).distinct()
    return nodes.select("node_id", fn.store_label(F.col("node_id"), b.STORES).alias("store_name"))


@check("store_filter_table", f"SELECT node_id, count(*) AS n FROM order_lines WHERE node_id IN {STORE_LIST} GROUP BY 1")
def _(spark, sf):
    lines = b.order_lines(spark, sf).select(F.col("item.node_id").alias("node_id"))
    listed = store_table(spark, sf).filter(F.col("store_name").isNotNull())
    return ops.store_filter(lines, "node_id", listed).groupBy("node_id").agg(F.count("*").alias("n"))


@check("date_filters_partitioned", f"""SELECT 'lookback' AS kind, {month('day')} AS month, count(*) AS n, CAST(sum(visits) AS BIGINT) AS visits
FROM order_visits WHERE day >= DATE '1996-01-15' - 395 GROUP BY 2
UNION ALL SELECT 'start', {month('day')}, count(*), CAST(sum(visits) AS BIGINT) FROM order_visits WHERE day >= DATE '1995-01-03' GROUP BY 2
UNION ALL SELECT 'window', {month('day')}, count(*), CAST(sum(visits) AS BIGINT) FROM order_visits
WHERE day BETWEEN (SELECT max(day) FROM order_visits) - 99 AND (SELECT max(day) FROM order_visits) GROUP BY 2""")
def _(spark, sf):
    visits = b.order_visits(spark, sf).withColumn("month", fn.month_start(F.col("day")))
    stored, part = materialise(visits, shared_path(spark, "visits-by-month"), ["month"]), ("month", "month")
    anchor = ops.rolling_anchor(stored, "day", "2100-01-01")
    kinds = {"lookback": ops.lookback_filter(stored, "day", i.LOOKBACK_AS_OF, partition=part),
             "start": ops.start_date_filter(stored, "day", i.START, part), "window": ops.within_days(stored, "day", anchor, 100, part)}
    return sources.union_sources(*[df.groupBy("month").agg(F.count("*").alias("n"), F.sum("visits").alias("visits"))
                                   .withColumn("kind", F.lit(kind)) for kind, df in kinds.items()])
