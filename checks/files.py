"""Checks of sources, sinks, sheets and batches.

Files are written under the session's scratch folder from the generated tables and
read back.
"""

from pyspark.sql import Window, functions as F

from checks import inputs as i
from checks.registry import check, shared_path
from checks.tables_sql import month
from kpiloom import bindings as b, plans, schemas, sources


@check("scan_table", "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def _(spark, sf):
    return sources.scan_table(spark, "orders", sf).groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


ORDER_FILE = "o_orderkey bigint, o_orderpriority string, o_totalprice double, day date"


def order_file(spark, sf):
    orders = b.scan_table(spark, "orders", sf).select(
        "o_orderkey", "o_orderpriority", "o_totalprice", F.to_date("o_orderdate").alias("day"))
    return sources.write_csv(orders, shared_path(spark, "orders-csv"))


@check("scan_csv", "SELECT o_orderkey, o_orderpriority, o_totalprice, CAST(o_orderdate AS DATE) AS day FROM orders")
def _(spark, sf):
    return sources.scan_csv(spark, order_file(spark, sf), ORDER_FILE)


@check("write_csv", "SELECT * FROM b_week_store")
def _(spark, sf):
    path = sources.write_csv(i.b_week_store(spark, sf), shared_path(spark, "buyers-csv"))
    return sources.scan_csv(spark, path, schemas.BUYERS_STORE)


@check("coerce_dates", """SELECT day, count(*) AS n FROM (SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority FROM orders)
WHERE o_orderpriority != '1-URGENT' GROUP BY 1""")
def _(spark, sf):
    text = F.when(F.col("o_orderpriority") == "1-URGENT", "31/31/1999").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    rows = b.scan_table(spark, "orders", sf).select(text.alias("day"))
    return sources.coerce_dates(rows, ["day"]).groupBy("day").agg(F.count("*").alias("n"))


@check("optional_source", "SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1")
def _(spark, sf):
    present = sources.optional_source(spark, order_file(spark, sf), ORDER_FILE)
    missing = sources.optional_source(spark, shared_path(spark, "never-written"), ORDER_FILE)
    return present.unionByName(missing).groupBy("day").agg(F.count("*").alias("n"))


@check("source_fallback", """SELECT 'kept' AS source, day, CAST(sum(visits) AS BIGINT) AS visits FROM order_visits GROUP BY 2
UNION ALL SELECT 'replaced', day, CAST(sum(visits) AS BIGINT) FROM event_visits GROUP BY 2""")
def _(spark, sf):
    columns = ["day", "visits"]
    orders, events = b.order_visits(spark, sf).select(columns), b.event_visits(spark, sf).select(columns)
    empty = spark.createDataFrame([], "day date, visits bigint")
    kept = sources.source_fallback(orders, events).withColumn("source", F.lit("kept"))
    replaced = sources.source_fallback(empty, events).withColumn("source", F.lit("replaced"))
    return kept.unionByName(replaced).groupBy("source", "day").agg(F.sum("visits").alias("visits"))


@check("category_census", "SELECT l_returnflag, l_linestatus, count(*) AS rows_count FROM lineitem GROUP BY 1, 2")
def _(spark, sf):
    return sources.category_census(b.scan_table(spark, "lineitem", sf), "l_returnflag", "l_linestatus")


@check("write_json_doc", """SELECT 'weekly' AS mart, CAST(Fecha AS VARCHAR) AS period, '' AS key, CAST(Visitas AS DOUBLE) AS value FROM v_week
UNION ALL SELECT 'buyers', CAST(Semana AS VARCHAR), TIENDA, CAST(Buyers AS DOUBLE) FROM b_week_store""")
def _(spark, sf):
    marts = {"weekly": (i.v_week(spark, sf), ["Fecha"]), "buyers": (i.b_week_store(spark, sf), ["Semana", "TIENDA"])}
    path = sources.write_json_doc(marts, shared_path(spark, "scorecard-json"))
    doc = spark.read.schema("value string, mart string").text(path).select("mart", F.from_json(
        "value", "period string, rows map<string, map<string, double>>").alias("doc"))
    rows = doc.select("mart", "doc.period", F.explode("doc.rows").alias("key", "values"))
    return rows.select("mart", "period", "key", F.explode("values").alias("name", "value")).drop("name")


@check("json_records", "SELECT 'buyers' AS mart, CAST(Semana AS VARCHAR) AS period, TIENDA AS store, '{\"Buyers\":' || Buyers || '}' AS values FROM b_week_store")
def _(spark, sf):
    rows = sources.json_records({"buyers": (i.b_week_store(spark, sf), ["Semana", "TIENDA"])})
    return rows.select("mart", F.col("keys")[0].alias("period"), F.col("keys")[1].alias("store"), "values")


def _status(spark, sf):
    def broken():
        raise LookupError("input not delivered")

    jobs = {"visits": lambda: i.v_day(spark, sf), "buyers": lambda: i.b_week_store(spark, sf), "broken": broken}
    return sources.run_batch(spark, jobs, shared_path(spark, "batch"))


@check("run_batch", """SELECT 'visits' AS job, TRUE AS ok, (SELECT count(*) FROM v_day) AS rows, FALSE AS has_error
UNION ALL SELECT 'buyers', TRUE, (SELECT count(*) FROM b_week_store), FALSE UNION ALL SELECT 'broken', FALSE, NULL, TRUE""")
def _(spark, sf):
    return _status(spark, sf).select("job", "ok", "rows", F.col("error").isNotNull().alias("has_error"))


@check("run_metadata", "SELECT CAST(2 AS BIGINT) AS queries_ok, CAST(1 AS BIGINT) AS queries_failed, 'broken' AS failed FROM (SELECT count(*) FROM orders)")
def _(spark, sf):
    meta = sources.run_metadata(_status(spark, sf))
    return meta.select("queries_ok", "queries_failed", F.array_join("errors.job", ",").alias("failed"))


# ---- sheets ----


def _stored(spark, sheet, name, width):
    """Write stacked sheets as headerless CSV in row order, all years in one path, blank rows where a sheet has none.

    Every row begins with its sheet, so that a reader can part them again.
    """
    path = shared_path(spark, name)
    lines = sheet.groupBy("sheet").agg(F.max("row_no").alias("last")).select(
        "sheet", F.explode(F.sequence(F.lit(0).cast("bigint"), "last")).alias("row_no"))
    cells = [F.get("cells", F.lit(k)).alias(f"c{k}") for k in range(width)]
    lines.join(sheet, ["sheet", "row_no"], "left").orderBy("sheet", "row_no").select("sheet", *cells).write.csv(path)
    return path


def _parted(rows):
    """Sheets of a read file: numbered from 0 each, without the leading cell."""
    sheets = rows.withColumn("sheet", F.get("cells", F.lit(0)).cast("int"))
    first = F.min("row_no").over(Window.partitionBy("sheet"))
    return sheets.select("sheet", (F.col("row_no") - first).alias("row_no"),
                         F.slice("cells", F.lit(2), F.size("cells")).alias("cells"))


def _plan_file(spark, sf):
    return sources.scan_plan_sheet(spark, _stored(spark, b.plan_sheet(spark, sf), "plan-sheet", 50))


def _assortment_file(spark, sf):
    return sources.scan_block_sheet(spark, _stored(spark, b.assortment_sheet(spark, sf), "assortment-sheet", 14))


def _filled():
    return F.size(F.filter("cells", lambda c: c.isNotNull())).alias("filled")


MONTH_WORDS = "['ene','feb','mar','abr','may','jun','jul','ago','sep','oct','nov','dic']"


@check("scan_plan_sheet", f"""
WITH y AS (SELECT CAST(year(Fecha) AS INTEGER) AS sheet, max(dayofyear(Fecha)) * 2 + 23 AS bottom FROM plan GROUP BY 1),
d AS (SELECT year(Fecha) AS sheet, 22 + dayofyear(Fecha) * 2 + t AS r, CASE t WHEN 0 THEN day(Fecha) || '-' || {MONTH_WORDS}[CAST(month(Fecha) AS INTEGER)] END AS daily,
    CASE t WHEN 0 THEN 7 + CASE WHEN Pur_48 IS NOT NULL THEN 1 ELSE 0 END ELSE 2 END AS own FROM plan, (SELECT unnest([0, 1]) AS t)),
h AS (SELECT sheet, r, CASE r WHEN 0 THEN 13 WHEN 22 THEN 1 ELSE 1 + months END AS own,
    CASE r WHEN 0 THEN 'feb-' || substr(CAST(sheet AS VARCHAR), 3, 2) END AS daily
  FROM (SELECT year(Fecha) AS sheet, count(DISTINCT month(Fecha)) AS months FROM plan GROUP BY 1), (SELECT unnest([0, 4, 6, 22]) AS r))
SELECT row_number() OVER (ORDER BY l.sheet, l.r) - 1 AS row_no, CAST(l.sheet AS VARCHAR) AS sheet,
  coalesce(d.daily, h.daily) AS third, CAST(1 + coalesce(d.own, h.own, 0) AS INTEGER) AS filled
FROM (SELECT sheet, unnest(range(CAST(bottom + 1 AS BIGINT))) AS r FROM y) l
LEFT JOIN d ON d.sheet = l.sheet AND d.r = l.r LEFT JOIN h ON h.sheet = l.sheet AND h.r = l.r""")
def _(spark, sf):
    rows = _plan_file(spark, sf)
    return rows.select("row_no", F.get("cells", F.lit(0)).alias("sheet"), F.when(
        (F.get("cells", F.lit(1)).isNull() | ~F.get("cells", F.lit(1)).isin("NMV", "4+8")), F.get("cells", F.lit(3))).alias("third"), _filled())


@check("scan_block_sheet", """SELECT (row_number() OVER (ORDER BY y, s, r)) - 1 AS row_no, CAST(y AS VARCHAR) AS sheet,
  CASE r WHEN 2 THEN 'Disponibilidad' WHEN 3 THEN 'Profundidad' WHEN 4 THEN 'Gap (p.p.)' END AS head,
  CAST(1 + CASE r WHEN 0 THEN 1 WHEN 1 THEN 13 WHEN 5 THEN 0 ELSE 1 + months END AS INTEGER) AS filled
FROM (SELECT CAST(year(l_shipdate) AS INTEGER) AS y, l_suppkey % 4 AS s, count(DISTINCT month(l_shipdate)) AS months FROM lineitem GROUP BY 1, 2),
  (SELECT unnest(range(6)) AS r)""")
def _(spark, sf):
    return _assortment_file(spark, sf).select("row_no", F.get("cells", F.lit(0)).alias("sheet"), F.get("cells", F.lit(1)).alias("head"), _filled())


@check("scan_sheet_quotes", """SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS row_no, CAST(o_orderkey AS VARCHAR) AS key,
  o_orderkey % 7 || '" wide' AS width, 'see, "' || o_orderpriority || '"' || chr(10) || 'end' AS note, o_orderstatus AS status FROM orders""")
def _(spark, sf):
    """Stray quotes, and quoted cells with commas, doubled quotes and line breaks."""
    width, note = F.concat((F.col("o_orderkey") % 7).cast("string"), F.lit('" wide')), F.concat(
        F.lit('"see, ""'), "o_orderpriority", F.lit('""\nend"'))
    lines = b.scan_table(spark, "orders", sf).orderBy("o_orderkey").select(
        F.concat_ws(",", F.col("o_orderkey").cast("string"), width, note, "o_orderstatus").alias("value"))
    path = shared_path(spark, "quoted-sheet")
    lines.write.text(path)
    cell = lambda k, name: F.get("cells", F.lit(k)).alias(name)
    return sources.scan_plan_sheet(spark, path).select("row_no", cell(0, "key"), cell(1, "width"), cell(2, "note"), cell(3, "status"))


@check("plan_monthly", f"SELECT CAST(year(Fecha) AS INTEGER) AS sheet, {month('Fecha')} AS Mes, sum(NMV_V2) AS NMV_V2, sum(NMV_48) AS \"NMV_4+8\" FROM plan GROUP BY 1, 2")
def _(spark, sf):
    months = plans.plan_monthly(b.plan_sheet(spark, sf), F.col("sheet"), ["sheet"])
    # the sheet has a column for every month of a year, also for those without a plan
    return months.filter(F.col("NMV_V2").isNotNull() | F.col("`NMV_4+8`").isNotNull())


DAYS = "['Domingo', 'lunes', 'martes', 'miércoles', 'jueves', 'viernes', 'Sábado'][CAST(dayofweek(Fecha) + 1 AS INTEGER)]"


@check("plan_daily", f'SELECT Fecha, {DAYS} AS Dia, NMV_V2, NSI_V2, NMV_48 AS "NMV_4+8", NSI_48 AS "NSI_4+8", Pur_48 AS "Purchases_4+8" FROM plan')
def _(spark, sf):
    return plans.plan_daily(b.plan_sheet(spark, sf), F.col("sheet"))


PLAN_MONTH = f"SELECT CAST(year(Fecha) AS INTEGER) AS sheet, {month('Fecha')} AS Mes, sum(NMV_V2) AS NMV_V2, sum(NMV_48) AS \"NMV_4+8\" FROM plan GROUP BY 1, 2"
PLAN_DAY = f'SELECT Fecha, {DAYS} AS Dia, NMV_V2, NSI_V2, NMV_48 AS "NMV_4+8", NSI_48 AS "NSI_4+8", Pur_48 AS "Purchases_4+8" FROM plan'


@check("plan_monthly_file", PLAN_MONTH)
def _(spark, sf):
    months = plans.plan_monthly(_parted(_plan_file(spark, sf)), F.col("sheet"), ["sheet"])
    return months.filter(F.col("NMV_V2").isNotNull() | F.col("`NMV_4+8`").isNotNull())


@check("plan_daily_file", PLAN_DAY)
def _(spark, sf):
    return plans.plan_daily(_parted(_plan_file(spark, sf)), F.col("sheet"))


@check("assortment_file", "SELECT * FROM assortment")
def _(spark, sf):
    return plans.assortment_parse(_parted(_assortment_file(spark, sf)), F.col("sheet"), list(b.STORES.values()), ["sheet"]).drop("sheet")


@check("plan_weekly", "SELECT * FROM plan_week")
def _(spark, sf):
    return plans.plan_weekly(plans.plan_daily(b.plan_sheet(spark, sf), F.col("sheet")))
