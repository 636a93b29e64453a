"""Checks of filters, unnesting, labels and scalar expressions."""

from pyspark.sql import functions as F

from checks.registry import check
from checks.tables_sql import K, STORE_LIST, month, store_case, week
from kpiloom import bindings as b, functions as fn, operators as ops
from kpiloom.constants import TRAFFIC_EVENTS
from kpiloom.bindings import scan_table


def tally(df, *keys, total="order_id"):
    """Rows and a checksum per key: enough to tell any two filters apart."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(F.col(total).cast("bigint")).alias("checksum"))


def tally_sql(keys, table, where="TRUE", total="order_id"):
    return f"SELECT {keys}, count(*) AS n, CAST(sum({total}) AS BIGINT) AS checksum FROM {table} WHERE {where} GROUP BY ALL"


def on_lines(name, where, keep):
    """A check that a filter of order lines keeps the rows of ``where``."""
    sql = tally_sql("node_id, status", "order_lines", where)

    @check(name, sql)
    def _(spark, sf):
        return tally(keep(b.order_lines(spark, sf)), F.col("item.node_id").alias("node_id"), "status")


@check("unnest_items", "SELECT store_id, status, count(*) AS n, CAST(sum(order_id) AS BIGINT) AS checksum FROM order_items GROUP BY ALL")
def _(spark, sf):
    items = ops.unnest_items(b.nested_orders(spark, sf), "items")
    return tally(items, F.col("item.node_id").alias("store_id"), "status")


@check("unnest", "SELECT store_id, count(*) AS n, count(DISTINCT order_id) AS orders FROM order_items GROUP BY 1")
def _(spark, sf):
    items = ops.unnest_items(b.nested_orders(spark, sf), "items")
    return items.groupBy(F.col("item.node_id").alias("store_id")).agg(
        F.count("*").alias("n"), F.countDistinct("order_id").alias("orders"))


@check("unnest_events", """SELECT day, e.name AS name, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS checksum
FROM traffic, unnest(events) AS e(name) WHERE e.name IN ('ITEM_PAGE', 'HOME_INSTORE', 'ADD_TO_CART') GROUP BY ALL""")
def _(spark, sf):
    events = ops.unnest_events(b.traffic(spark, sf), "page_events", TRAFFIC_EVENTS)
    return tally(events, "day", F.col("event.name").alias("name"), total="user_id")


@check("has_event", tally_sql("day, model", "traffic", "list_has_any(events, ['ITEM_PAGE', 'HOME_INSTORE', 'ADD_TO_CART'])", "user_id"))
def _(spark, sf):
    return tally(b.traffic(spark, sf).filter(ops.has_event(F.col("page_events"), TRAFFIC_EVENTS)), "day", "model", total="user_id")


on_lines("tag_filter", "array_to_string(tags, ',') LIKE '%supermarket_partnership%'",
         lambda df: ops.tag_filter(df, "tags", "supermarket_partnership"))
on_lines("tag_filter_joined", "array_to_string(tags, ',') LIKE '%partnership,Fresh%'",
         lambda df: ops.tag_filter(df, "tags", "partnership,Fresh"))
on_lines("store_filter", f"node_id IN {STORE_LIST}", lambda df: ops.store_filter(df, "item.node_id", b.STORES))
on_lines("status_filter", "status NOT IN ('cancelled', 'invalid')", lambda df: ops.status_filter(df, "status"))
on_lines("flag_filter", "gmv_flag IS TRUE AND auto_offer_flag IS NOT TRUE",
         lambda df: ops.flag_filter(ops.flag_filter(df, "gmv_flag"), "auto_offer_flag", False))
on_lines("equality_filter", "site = 'S1' AND marketplace_id = 'TM'",
         lambda df: ops.equality_filter(df, site="S1", marketplace_id="TM"))
on_lines("lookback_filter", "CAST(closed_at AS DATE) >= DATE '1996-04-01' - 395",
         lambda df: ops.lookback_filter(df, "closed_at", "1996-04-01"))
on_lines("start_date_filter", "closed_at >= DATE '1995-02-01'", lambda df: ops.start_date_filter(df, "closed_at", "1995-02-01"))
on_lines("between_filter", "CAST(closed_at AS DATE) BETWEEN DATE '1995-02-01' AND DATE '2001-06-30'",
         lambda df: ops.between_filter(df, "closed_at", "1995-02-01", "2001-06-30"))
on_lines("not_null_filter", "status IS NOT NULL AND auto_offer_flag IS NOT NULL",
         lambda df: ops.not_null_filter(df, "status", "auto_offer_flag"))
on_lines("value_set_filter", "node_id IN ('N1', 'N4')", lambda df: ops.value_set_filter(df, "item.node_id", ["N1", "N4"]))


@check("store_filter_cast", tally_sql("node_id, site", "scorecard", "CAST(store_id AS VARCHAR) IN ('7000', '7003')", "store_id"))
def _(spark, sf):
    return tally(ops.store_filter_cast(b.scorecard(spark, sf), "store_id", ["7000", "7003"]), "node_id", "site", total="store_id")


@check("like_filter", tally_sql("code", "survey", "code LIKE '%-LOW%'", "CAST(order_id AS BIGINT)"))
def _(spark, sf):
    return tally(ops.like_filter(b.survey(spark, sf), "code", "-LOW"), "code")


GRAIN_END = {"day": "2001-07-14", "week": "2001-06-30", "month": "2001-06-30"}


@check("cutoff_filter", " UNION ALL ".join(
    f"SELECT '{g}' AS grain, {p} AS period, count(*) AS n FROM orders WHERE {p} <= DATE '{GRAIN_END[g]}' GROUP BY ALL"
    for g, p in (("day", "CAST(o_orderdate AS DATE)"), ("week", week("o_orderdate")), ("month", month("o_orderdate")))))
def _(spark, sf):
    orders = scan_table(spark, "orders", sf)
    parts = [ops.cutoff_filter(orders.select(F.lit(g).alias("grain"), fn.to_period(F.col("o_orderdate"), g).alias("period")),
                               "period", "2001-07-15", g).groupBy("grain", "period").agg(F.count("*").alias("n"))
             for g in GRAIN_END]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@check("ytd_filter", f"SELECT {month('o_orderdate')} AS Mes, count(*) AS n FROM orders WHERE o_orderdate >= DATE '1999-01-01' GROUP BY 1")
def _(spark, sf):
    rows = ops.ytd_filter(scan_table(spark, "orders", sf), "o_orderdate", "1999-08-20")
    return rows.groupBy(fn.month_start(F.col("o_orderdate")).alias("Mes")).agg(F.count("*").alias("n"))


@check("store_label", tally_sql(f"{store_case('node_id')} AS Tienda, {store_case('node_id')} AS Joined", "order_lines"))
def _(spark, sf):
    lookup = spark.createDataFrame(list(b.STORES.items()), "node_id string, store_name string")
    lines = b.order_lines(spark, sf).select("order_id", "item.node_id")
    return tally(ops.store_label(ops.store_label(lines, "node_id", b.STORES), "node_id", lookup, name="Joined"), "Tienda", "Joined")


PIECES = """SELECT measure, count(TSIE) AS requested_known, CAST(sum(TSIE) AS DOUBLE) AS requested, count(TSI_PICKED) AS picked_known,
  CAST(sum(TSI_PICKED) AS DOUBLE) AS picked FROM (SELECT k.measure, CAST(CASE WHEN measure != 'unit' THEN requested_qty / nullif(net_weight, 0) ELSE requested_qty END AS DECIMAL(28, 9)) AS TSIE,
  CAST(CASE WHEN measure != 'unit' THEN picked_qty / nullif(net_weight, 0) ELSE picked_qty END AS DECIMAL(28, 9)) AS TSI_PICKED FROM picks k) GROUP BY 1"""


@check("qty_normalise", PIECES)
def _(spark, sf):
    pieces = lambda q: fn.qty_normalise(F.col(q), F.col("measure"), F.col("net_weight"))
    fixed = lambda q: pieces(q).cast("decimal(18,9)")
    rows = b.picks(spark, sf).select("measure", fixed("requested_qty").alias("r"), fixed("picked_qty").alias("p"))
    return rows.groupBy("measure").agg(
        F.count("r").alias("requested_known"), F.sum("r").cast("double").alias("requested"),
        F.count("p").alias("picked_known"), F.sum("p").cast("double").alias("picked"))


@check("qty_cap", """SELECT measure, count(c) AS known, round(sum(c), 4) AS capped
FROM (SELECT measure, CASE WHEN picked_qty > requested_qty THEN requested_qty ELSE picked_qty END AS c FROM picks) GROUP BY 1""")
def _(spark, sf):
    capped = fn.qty_cap(F.col("picked_qty"), F.col("requested_qty"))
    return b.picks(spark, sf).groupBy("measure").agg(F.count(capped).alias("known"), F.round(F.sum(capped), 4).alias("capped"))


@check("line_value", "SELECT l_returnflag, round(sum(l_extendedprice * l_quantity), 2) AS value FROM lineitem GROUP BY 1")
def _(spark, sf):
    value = fn.line_value(F.col("l_extendedprice"), F.col("l_quantity"))
    return scan_table(spark, "lineitem", sf).groupBy("l_returnflag").agg(F.round(F.sum(value), 2).alias("value"))


@check("refund_value", """SELECT status, sum(CASE WHEN status = 'partially_refunded' THEN net_value_usd ELSE gross_value_usd - net_value_usd % 7 END) AS value
FROM (SELECT status, net_value_usd, floor(gross_value_usd) AS gross_value_usd FROM nested_orders) GROUP BY 1""")
def _(spark, sf):
    full = F.floor("gross_value_usd").cast("double") - F.col("net_value_usd") % 7
    value = fn.refund_value(F.col("status"), full, F.col("net_value_usd"))
    return b.nested_orders(spark, sf).groupBy("status").agg(F.sum(value).alias("value"))


@check("nps_bucket", "SELECT score, bucket, count(*) AS n FROM survey_buckets GROUP BY 1, 2")
def _(spark, sf):
    return b.survey(spark, sf).groupBy("score", fn.nps_bucket(F.col("score")).alias("bucket")).agg(F.count("*").alias("n"))


@check("age_band", "SELECT age_group, count(*) AS n FROM demographics GROUP BY 1")
def _(spark, sf):
    return b.demographics(spark, sf).groupBy(fn.age_band(F.col("Rango_edad")).alias("age_group")).agg(F.sum("MABs").alias("n"))


@check("segment_map", "SELECT segment, count(*) AS n FROM demographics GROUP BY 1")
def _(spark, sf):
    return b.demographics(spark, sf).groupBy(fn.segment_map(F.col("Segmento")).alias("segment")).agg(F.sum("MABs").alias("n"))


@check("blank_to_total", "SELECT Tienda, CLAIM_TYPE, count(*) AS n FROM (SELECT Tienda FROM claims_rows) POSITIONAL JOIN (SELECT CLAIM_TYPE FROM bpp_rows) GROUP BY 1, 2".replace(
    "FROM (SELECT Tienda FROM claims_rows) POSITIONAL JOIN (SELECT CLAIM_TYPE FROM bpp_rows)",
    """FROM (SELECT CASE WHEN l_suppkey % 5 = 4 THEN 'Total' ELSE 'N' || l_suppkey % 5 END AS Tienda,
  CASE l_partkey % 4 WHEN 0 THEN 'pdd' WHEN 1 THEN 'Pnr' WHEN 2 THEN 'LOWCOST' ELSE 'OTHER' END AS CLAIM_TYPE FROM lineitem)"""))
def _(spark, sf):
    rows = scan_table(spark, "lineitem", sf).select(
        F.when(F.col("l_suppkey") % 5 == 4, " ").otherwise(F.concat(F.lit("N"), (F.col("l_suppkey") % 5).cast("string"))).alias("s"),
        F.element_at(F.array(F.lit("pdd"), F.lit("Pnr"), F.lit("LOWCOST"), F.lit("")), (F.col("l_partkey") % 4 + 1).cast("int")).alias("t"))
    return rows.groupBy(fn.blank_to_total(F.col("s")).alias("Tienda"), fn.blank_to_total(F.col("t"), "OTHER").alias("CLAIM_TYPE")).agg(
        F.count("*").alias("n"))


@check("nan_to_null", """SELECT event_type, count(x) AS known, round(sum(x), 2) AS total FROM (
  SELECT event_type, CASE WHEN k % 5 IN (0, 1, 2) THEN NULL ELSE value END AS x FROM (SELECT *, """ + K + """ AS k FROM events)) GROUP BY 1""")
def _(spark, sf):
    k = F.get_json_object("props", "$.k").cast("bigint")
    text = (F.when(k % 5 == 0, "NaN").when(k % 5 == 1, "Infinity").when(k % 5 == 2, "none")
            .otherwise(F.col("value").cast("string")))
    x = fn.nan_to_null(text)
    return scan_table(spark, "events", sf).groupBy("event_type").agg(F.count(x).alias("known"), F.round(F.sum(x), 2).alias("total"))


# ---- scalar functions, each over a whole table ----

ABBR = "['Ene','Feb','Mar','Abr','May','Jun','Jul','Ago','Sep','Oct','Nov','Dic'][CAST(month(d) AS INTEGER)]"


@check("scalar_dates", f"""SELECT d, {week('d')} AS week, {month('d')} AS month, d - 395 AS lookback,
  CAST(date_trunc('month', d) AS DATE) - 1 AS prev_end, d - 1 AS day_before,
  CAST(date_trunc('month', d) AS DATE) AS from_yyyymm, count(*) AS n FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) GROUP BY ALL""")
def _(spark, sf):
    d = F.col("d")
    rows = scan_table(spark, "orders", sf).select(fn.day(F.col("o_orderdate")).alias("d"))
    return rows.groupBy("d").agg(F.count("*").alias("n")).select(
        "d", fn.week_sunday(d).alias("week"), fn.month_start(d).alias("month"), F.date_sub(d, 395).alias("lookback"),
        fn.previous_month_end(d).alias("prev_end"), fn.day_before(d).alias("day_before"),
        fn.month_from_yyyymm(F.date_format(d, "yyyyMM")).alias("from_yyyymm"), "n")


@check("scalar_labels", f"""SELECT d, {ABBR} || '''' || strftime(d, '%y') AS month_label, day(d) || '/' || lower({ABBR}) AS day_label,
  day(d) || ' ' || lower({ABBR}) AS day_text, d AS parsed, count(*) AS n FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) GROUP BY ALL""")
def _(spark, sf):
    d = F.col("d")
    rows = scan_table(spark, "orders", sf).groupBy(F.to_date("o_orderdate").alias("d")).agg(F.count("*").alias("n"))
    text = F.concat(F.dayofmonth(d).cast("string"), F.lit("-"), F.lower(fn.month_abbr(d)))
    return rows.select("d", fn.month_label(d).alias("month_label"), fn.day_label(d).alias("day_label"),
                       fn.day_text(d).alias("day_text"), fn.parse_day_month(text, F.year(d), F.lit(1)).alias("parsed"), "n")


@check("scalar_guards", """SELECT l_quantity, l_tax, l_quantity / nullif(l_tax, 0) AS ratio, CASE WHEN l_tax != 0 THEN l_tax / nullif(l_quantity, 0) END AS ratio_nz,
  CASE WHEN l_tax > 0 THEN l_quantity / l_tax END AS positive, nullif(l_tax, 0) AS nulled, coalesce(nullif(l_tax, 0), -1.0) AS filled, count(*) AS n
FROM lineitem GROUP BY l_quantity, l_tax""")
def _(spark, sf):
    q, t = F.col("l_quantity"), F.col("l_tax")
    return scan_table(spark, "lineitem", sf).groupBy("l_quantity", "l_tax").agg(F.count("*").alias("n")).select(
        "l_quantity", "l_tax", fn.safe_ratio(q, t).alias("ratio"), fn.safe_ratio_nz(t, q).alias("ratio_nz"),
        fn.positive_ratio(q, t).alias("positive"), F.nullif(t, F.lit(0.0)).alias("nulled"),
        F.coalesce(F.nullif(t, F.lit(0.0)), F.lit(-1.0)).alias("filled"), "n")


@check("scalar_rounding", """SELECT l_quantity, l_linenumber, round(l_quantity / 4, 0) AS away, round_even(l_quantity / 4, 0) AS even,
  CAST(floor(l_quantity / 4 + 0.5) AS BIGINT) AS up, CAST(floor(0.5 - l_quantity / 4) AS BIGINT) AS up_negative, abs(-l_quantity) AS size,
  count(*) AS n FROM lineitem GROUP BY l_quantity, l_linenumber""")
def _(spark, sf):
    x = F.col("l_quantity") / 4
    return scan_table(spark, "lineitem", sf).groupBy("l_quantity", "l_linenumber").agg(F.count("*").alias("n")).select(
        "l_quantity", "l_linenumber", F.round(x, 0).alias("away"), fn.round_half_even(x).alias("even"),
        fn.round_half_up(x).alias("up"), fn.round_half_up(-x).alias("up_negative"), F.abs(-F.col("l_quantity")).alias("size"), "n")


@check("scalar_casts", """SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS as_text, CAST(o_totalprice AS DECIMAL(38, 9))::DOUBLE AS as_decimal,
  CAST(o_orderkey AS DOUBLE) AS as_double, TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS digit, TRY_CAST(o_orderpriority AS DOUBLE) AS unreadable,
  CAST(o_orderdate AS DATE) AS as_date, o_orderstatus = 'O' AS flag FROM orders""")
def _(spark, sf):
    c = F.col
    return scan_table(spark, "orders", sf).select(
        "o_orderkey", c("o_orderkey").cast("string").alias("as_text"), c("o_totalprice").cast("decimal(38,9)").cast("double").alias("as_decimal"),
        c("o_orderkey").cast("double").alias("as_double"), F.substring("o_orderpriority", 1, 1).try_cast("int").alias("digit"),
        c("o_orderpriority").try_cast("double").alias("unreadable"), c("o_orderdate").cast("date").alias("as_date"),
        (c("o_orderstatus") == "O").alias("flag"))


@check("scalar_text", """SELECT p_partkey, upper(p_type) AS up, lower(p_brand) AS low, p_name LIKE '%ring%' AS has_ring,
  array_to_string(['x', p_type, NULL, p_brand], ',') AS joined, string_split(p_name, ' ')[1] AS first_word,
  p_type || '|' || p_brand AS key, trim('  ' || p_name || ' ') AS trimmed, TRY_CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) AS brand_no,
  CASE WHEN p_size > 25 THEN 'big' ELSE 'small' END AS size_class FROM part""")
def _(spark, sf):
    c = F.col
    return scan_table(spark, "part", sf).select(
        "p_partkey", F.upper("p_type").alias("up"), F.lower("p_brand").alias("low"), c("p_name").contains("ring").alias("has_ring"),
        F.array_join(F.array(F.lit("x"), "p_type", F.lit(None), "p_brand"), ",").alias("joined"),
        F.split("p_name", " ")[0].alias("first_word"), F.concat("p_type", F.lit("|"), "p_brand").alias("key"),
        F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"),
        F.regexp_extract("p_brand", "([0-9]+)", 1).try_cast("int").alias("brand_no"),
        F.when(c("p_size") > 25, "big").otherwise("small").alias("size_class"))


@check("scalar_parsing", """SELECT o_orderkey, v AS whole, t / 10 AS tenths, t / 10 / 100 AS percent, CAST(NULL AS DOUBLE) AS not_a_number
FROM (SELECT o_orderkey, floor(o_totalprice) AS v, CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS DOUBLE) AS t FROM orders)""")
def _(spark, sf):
    v = F.floor("o_totalprice").cast("bigint")
    tenth = v % 1000
    comma = F.concat((tenth - tenth % 10).cast("bigint").cast("string"), F.lit(""))
    text = F.concat(F.floor(tenth / 10).cast("string"), F.lit(","), (tenth % 10).cast("string"))
    return scan_table(spark, "orders", sf).select(
        "o_orderkey", fn.parse_decimal_comma(b.comma_number(v)).alias("whole"), fn.parse_decimal_comma(text).alias("tenths"),
        fn.parse_percent(F.concat(text, F.lit("%"))).alias("percent"),
        fn.parse_decimal_comma(F.concat(comma, F.lit("%"))).alias("not_a_number"))


@check("scalar_json", f"""SELECT s.survey_site AS site, {K.replace('props', 'e.props')} AS k, count(*) AS n FROM events e
JOIN (SELECT CAST(order_id AS BIGINT) AS order_id, survey_site FROM survey) s ON e.event_id = s.order_id GROUP BY ALL""")
def _(spark, sf):
    asked = b.survey(spark, sf).select(F.col("order_id").cast("bigint").alias("event_id"),
                                       F.get_json_object("questions", "$[0].site").alias("site"))
    events = scan_table(spark, "events", sf).select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    return events.join(asked, "event_id").groupBy("site", "k").agg(F.count("*").alias("n"))
