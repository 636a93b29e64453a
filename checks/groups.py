"""Checks of joins, aggregations, windows and ordering."""

from pyspark.sql import functions as F

from checks import inputs as i
from checks.registry import check
from checks.tables_sql import STORE_LIST, cvr_sql, month, store_case, week
from kpiloom import bindings as b, functions as fn, operators as ops
from kpiloom.bindings import scan_table


@check("join_picks", """SELECT node_id, count(*) AS n, count(requested_qty) AS picked_rows, CAST(sum(requested_qty) AS DOUBLE) AS requested
FROM order_lines LEFT JOIN (SELECT * FROM picks WHERE measure = 'unit') USING (order_id, sku_id, line_id) GROUP BY 1""")
def _(spark, sf):
    units = b.picks(spark, sf).filter(F.col("measure") == "unit")
    joined = ops.join_picks(b.order_lines(spark, sf), units, b.PICK_KEYS)
    return joined.groupBy(F.col("item.node_id").alias("node_id")).agg(
        F.count("*").alias("n"), F.count("requested_qty").alias("picked_rows"), F.sum("requested_qty").alias("requested"))


@check("join_claims_orders", """SELECT claim_type, status, count(*) AS n, CAST(sum(order_id) AS BIGINT) AS checksum
FROM (SELECT DISTINCT order_id, claim_type FROM claims) JOIN (SELECT DISTINCT order_id, status FROM order_lines) USING (order_id) GROUP BY 1, 2""")
def _(spark, sf):
    joined = ops.join_claims_orders(b.claims(spark, sf).select("order_id", "claim_type"), b.order_lines(spark, sf).select("order_id", "status"))
    return joined.groupBy("claim_type", "status").agg(F.count("*").alias("n"), F.sum("order_id").alias("checksum"))


@check("join_survey_store", f"""SELECT Tienda, score, count(*) AS n FROM survey s
LEFT JOIN (SELECT DISTINCT order_id, {store_case('node_id')} AS Tienda FROM order_lines) m ON s.order_id = CAST(m.order_id AS VARCHAR) GROUP BY 1, 2""")
def _(spark, sf):
    stores = b.order_lines(spark, sf).select("order_id", fn.store_label(F.col("item.node_id"), b.STORES).alias("Tienda")).distinct()
    return ops.join_survey_store(b.survey(spark, sf), stores).groupBy("Tienda", "score").agg(F.count("*").alias("n"))


@check("full_join_cvr", cvr_sql("day", "Fecha", "(SELECT * FROM order_buyers WHERE day >= DATE '1996-01-01')",
                                "(SELECT * FROM order_traffic WHERE day < DATE '2001-01-01')"))
def _(spark, sf):
    buyers = ops.count_distinct(b.order_buyers(spark, sf).filter(F.col("day") >= "1996-01-01"), ["day"], {"Buyers": "buyer_id"})
    visitors = ops.count_distinct(b.order_traffic(spark, sf).filter(F.col("day") < "2001-01-01"), ["day"], {"Visitors": "user_id"})
    return ops.full_join_cvr(buyers, visitors, "day").withColumnRenamed("day", "Fecha")


@check("enrich_period", "SELECT Fecha, Visitas, Buyers, Visitors, CVR FROM (SELECT Fecha, Visitas FROM v_day) LEFT JOIN c_day USING (Fecha)")
def _(spark, sf):
    return ops.enrich_period(i.v_day(spark, sf), [i.c_day(spark, sf)], "Fecha")


@check("join_plan_actual", """SELECT Fecha, Visitas, NMV_V2, NMV_48 AS "NMV_4+8" FROM v_day LEFT JOIN plan USING (Fecha)""")
def _(spark, sf):
    return ops.join_plan_actual(i.v_day(spark, sf), b.plan(spark, sf).select("Fecha", "NMV_V2", "`NMV_4+8`"), "Fecha")


@check("join_pl_growth", f"""SELECT Mes, NMV, CASE WHEN NMV > 0 THEN TGMV / NMV END AS gross, CASE WHEN NMV > 0 THEN Coupons / NMV END AS coupons
FROM (SELECT Mes, TGMV, Coupons FROM pl_monthly) FULL JOIN (SELECT {month('day')} AS Mes, CAST(sum(visits) AS BIGINT) AS NMV FROM order_visits WHERE day >= DATE '1996-01-01' GROUP BY 1) USING (Mes)
WHERE Mes < DATE '2001-01-01'""")
def _(spark, sf):
    growth = (b.order_visits(spark, sf).filter(F.col("day") >= "1996-01-01").groupBy(fn.month_start(F.col("day")).alias("Mes"))
              .agg(F.sum("visits").alias("NMV")))
    pl = b.pl_monthly(spark, sf).withColumn("Mes", fn.month_from_yyyymm(F.col("Mes")))
    months = pl.select("Mes").filter(F.col("Mes") < "2001-01-01")
    return ops.join_pl_growth(pl, growth, "Mes", {"gross": "TGMV", "coupons": "Coupons"}, months)


@check("period_spine_join", """SELECT Semana, TIENDA, Buyers
FROM (SELECT Semana, unnest(['N0', 'N1', 'N2', 'N9']) AS TIENDA FROM (SELECT DISTINCT Semana FROM b_week_store))
LEFT JOIN b_week_store USING (Semana, TIENDA)""")
def _(spark, sf):
    return ops.period_spine_join(i.b_week_store(spark, sf), ["N0", "N1", "N2", "N9"], "Semana", "TIENDA")


@check("range_membership", """SELECT CAST((DATE '2001-07-14' - day) // 28 AS INTEGER) AS bucket, count(*) AS n, CAST(sum(visits) AS BIGINT) AS visits FROM order_visits
WHERE DATE '2001-07-14' - day BETWEEN 0 AND 28 * 90 - 1 GROUP BY 1""")
def _(spark, sf):
    rows = ops.range_membership(b.order_visits(spark, sf), "day", fn.as_date("2001-07-14"), 28, 90)
    return rows.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("visits").alias("visits"))


# ---- aggregations ----

DISTINCT = "SELECT node_id, count(DISTINCT order_id) AS orders, count(DISTINCT purchase_id) AS purchases, count(DISTINCT buyer_id) AS buyers FROM order_lines GROUP BY 1"


def lines(spark, sf):
    return b.order_lines(spark, sf).withColumn("node_id", F.col("item.node_id"))


@check("count_distinct", DISTINCT)
def _(spark, sf):
    return ops.count_distinct(lines(spark, sf), ["node_id"], {"orders": "order_id", "purchases": "purchase_id", "buyers": "buyer_id"})


@check("count_distinct_if", "SELECT node_id, count(DISTINCT CASE WHEN status = 'cancelled' THEN order_id END) AS cancelled FROM order_lines GROUP BY 1")
def _(spark, sf):
    return ops.count_distinct_if(lines(spark, sf), ["node_id"], "order_id", F.col("status") == "cancelled", "cancelled")


@check("count_if", "SELECT node_id, count(*) FILTER (status = 'cancelled') AS cancelled, count(*) FILTER (fx_ratio > 0.05) AS high_fx FROM order_lines GROUP BY 1")
def _(spark, sf):
    return ops.count_if(lines(spark, sf), ["node_id"], {"cancelled": F.col("status") == "cancelled", "high_fx": F.col("fx_ratio") > 0.05})


@check("count_star", "SELECT status, count(*) AS rows FROM order_lines GROUP BY 1")
def _(spark, sf):
    return ops.count_star(b.order_lines(spark, sf), ["status"])


@check("sum_rounded", "SELECT l_shipdate, round(sum(l_extendedprice), 2) AS price, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY 1")
def _(spark, sf):
    return ops.sum_rounded(scan_table(spark, "lineitem", sf), ["l_shipdate"], {"price": "l_extendedprice", "quantity": "l_quantity"}, 2)


@check("sum_flag", "SELECT node_id, CAST(sum(CAST(perfect_flag AS INTEGER)) AS BIGINT) AS perfect FROM perfect_orders GROUP BY 1")
def _(spark, sf):
    return ops.sum_flag(b.perfect_orders(spark, sf), ["node_id"], "perfect_flag", "perfect")


@check("ratio_of_sums", """SELECT day, round(sum(fi_picked) / nullif(sum(fi_requested), 0), 4) AS fill,
  round(sum(ot_on_time) / nullif(sum(ot_packs), 0), 4) AS on_time FROM scorecard GROUP BY 1""")
def _(spark, sf):
    return ops.ratio_of_sums(b.scorecard(spark, sf), ["day"], {"fill": ("fi_picked", "fi_requested"), "on_time": ("ot_on_time", "ot_packs")})


@check("sum_times_avg", "SELECT site, round(sum(unit_price) * avg(nullif(fx_ratio, 0)), 0) AS value FROM order_lines GROUP BY 1")
def _(spark, sf):
    priced = b.order_lines(spark, sf).withColumn("unit_price", F.col("item.unit_price"))
    return ops.sum_times_avg(priced, ["site"], "unit_price", "fx_ratio", "value")


@check("sum_coalesced", "SELECT measure, round(sum(coalesce(picked_qty, requested_qty)), 2) AS pieces FROM picks GROUP BY 1")
def _(spark, sf):
    return ops.sum_coalesced(b.picks(spark, sf), ["measure"], "picked_qty", "requested_qty", "pieces", 2)


DISTINCT_LINES = f"SELECT DISTINCT {week('closed_at')} AS Semana, order_id, status FROM order_lines"


def week_orders(spark, sf):
    return b.order_lines(spark, sf).select(fn.week_sunday(F.col("closed_at")).alias("Semana"), "order_id", "status")


@check("group_by_all", DISTINCT_LINES)
def _(spark, sf):
    return ops.group_by_all(week_orders(spark, sf))


@check("select_distinct", "SELECT DISTINCT order_id, node_id FROM order_lines")
def _(spark, sf):
    return ops.select_distinct(b.order_lines(spark, sf), "order_id", F.col("item.node_id").alias("node_id"))


@check("group_by_ordinals", f"SELECT {week('closed_at')} AS Semana, status, count(*) AS n FROM order_lines GROUP BY 1, 2")
def _(spark, sf):
    return ops.group_by_ordinals(week_orders(spark, sf), 1, 3, aggs=[F.count("*").alias("n")])


NODE_STATUS = "SELECT {} FROM order_lines GROUP BY GROUPING SETS ((site, status), (site))"


@check("grouping_sets", NODE_STATUS.format("site, status, grouping(status) AS is_total, count(*) AS n"))
def _(spark, sf):
    return ops.grouping_sets(b.order_lines(spark, sf), [["site", "status"], ["site"]], ["site", "status"],
                             [F.grouping("status").cast("bigint").alias("is_total"), F.count("*").alias("n")])


@check("total_label", NODE_STATUS.format("site, CASE WHEN grouping(status) = 1 THEN 'Total' ELSE coalesce(status, 'unknown') END AS status, count(*) AS n"))
def _(spark, sf):
    return ops.total_label(b.order_lines(spark, sf), ["site", "status"], "status", [F.count("*").alias("n")], unmapped="unknown")


@check("nps_score", f"""SELECT {month('end_date')} AS Mes, round((count(*) FILTER (bucket = 1) - count(*) FILTER (bucket = -1)) / count(*) * 100, 0) + 0 AS NPS_Score,
  count(*) AS Total_Responses, count(*) FILTER (bucket = 1) AS Promotores, count(*) FILTER (bucket = 0) AS Neutros, count(*) FILTER (bucket = -1) AS Detractores
FROM survey_buckets WHERE bucket IS NOT NULL GROUP BY 1""")
def _(spark, sf):
    answers = b.survey(spark, sf).select(fn.month_start(F.col("end_date")).alias("Mes"), fn.nps_bucket(F.col("score")).alias("bucket"))
    return ops.nps_score(ops.not_null_filter(answers, "bucket"), ["Mes"], "bucket")


@check("mean_of_rates", f"SELECT {month('Semana')} AS Mes, Tienda, round(avg(Cancel_Rate), 6) AS Cancel_Rate, round(avg(On_Time), 6) AS On_Time FROM o_week_store GROUP BY 1, 2")
def _(spark, sf):
    means = ops.mean_of_rates(i.o_week_store(spark, sf), "Semana", ["Cancel_Rate", "On_Time"], ["Tienda"])
    return means.withColumns({c: F.round(c, 6) for c in ("Cancel_Rate", "On_Time")})


@check("sum_to_period", f"SELECT {month('day')} AS Mes, node_id, CAST(sum(visits) AS BIGINT) AS visits FROM order_visits GROUP BY 1, 2")
def _(spark, sf):
    return ops.sum_to_period(b.order_visits(spark, sf), "day", ["visits"], ["node_id"])


@check("store_nunique", "SELECT Semana, count(DISTINCT TIENDA) AS Stores FROM b_week_store GROUP BY 1")
def _(spark, sf):
    return ops.store_nunique(i.b_week_store(spark, sf), "Semana", "TIENDA")


@check("accumulate_pairs", "SELECT Mes, motivo, fallo, CAST(sum(claims) AS BIGINT) AS claims, sum(gmv) AS gmv_reclamado FROM claims_rows GROUP BY 1, 2, 3")
def _(spark, sf):
    rows = b.claims_monthly(spark, sf).select(
        fn.month_start(F.col("mes")).alias("Mes"), F.trim("motivo").alias("motivo"), F.coalesce("fallo", F.lit("")).alias("fallo"),
        F.col("claims").cast("bigint").alias("claims"), "gmv_reclamado")
    return ops.accumulate_pairs(rows, ["Mes", "motivo", "fallo"], ["claims", "gmv_reclamado"])


@check("total_over_stores", "SELECT Semana, CAST(nullif(sum(Buyers), 0) AS BIGINT) AS Total FROM b_week_store GROUP BY 1")
def _(spark, sf):
    return ops.total_over_stores(i.b_week_store(spark, sf), "Semana", "Buyers")


@check("grand_total_row", """SELECT Mes, CASE WHEN grouping(CLAIM_TYPE) = 1 THEN 'TOTAL' ELSE CLAIM_TYPE END AS CLAIM_TYPE, sum(paid) AS paid,
  CAST(sum(cases) AS BIGINT) AS cases FROM bpp_rows GROUP BY GROUPING SETS ((Mes, CLAIM_TYPE), (Mes))""")
def _(spark, sf):
    rows = b.bpp_monthly(spark, sf).select(
        fn.month_from_yyyymm(F.col("mes")).alias("Mes"), fn.blank_to_total(F.col("CLAIM_TYPE"), "OTHER").alias("CLAIM_TYPE"),
        F.col("paid_lc").cast("double").alias("paid"), F.col("casos").cast("bigint").alias("cases"))
    return ops.grand_total_row(rows, ["Mes"], ["paid", "cases"], "CLAIM_TYPE")


@check("mean_over_stores", "SELECT Semana, round(avg(coalesce(On_Time, 0)), 6) AS On_Time, round(avg(coalesce(FR_Items, 0)), 6) AS FR_Items FROM o_week_store GROUP BY 1")
def _(spark, sf):
    means = ops.mean_over_stores(i.o_week_store(spark, sf), "Semana", ["On_Time", "FR_Items"])
    return means.withColumns({c: F.round(c, 6) for c in ("On_Time", "FR_Items")})


@check("running_total_sum", "SELECT node_id, sum(cancels_seller) AS cancels_seller, sum(total_orders) AS total_orders FROM scorecard GROUP BY 1")
def _(spark, sf):
    return ops.running_total_sum(b.scorecard(spark, sf), ["cancels_seller", "total_orders"], ["node_id"])


# ---- windows and periods ----


@check("order_flag_window", """SELECT status, order_flag, count(*) AS n, CAST(sum(order_id) AS BIGINT) AS checksum
FROM (SELECT *, max(CASE WHEN node_id = 'N4' THEN 1 ELSE 0 END) OVER (PARTITION BY order_id) AS order_flag FROM order_lines) GROUP BY 1, 2""")
def _(spark, sf):
    flagged = ops.order_flag_window(b.order_lines(spark, sf), "order_id", F.col("item.node_id") == "N4")
    return flagged.groupBy("status", "order_flag").agg(F.count("*").alias("n"), F.sum("order_id").alias("checksum"))


SERIES = "(SELECT Semana, TIENDA, CASE WHEN Buyers % 4 = 0 THEN NULL ELSE Buyers - 9 END AS v FROM b_week_store)"


def series(spark, sf):
    """Weekly values with gaps, zeros and negatives."""
    v = F.when(F.col("Buyers") % 4 != 0, F.col("Buyers") - 9)
    return i.b_week_store(spark, sf).select("Semana", "TIENDA", v.alias("v"))


DELTA = f"""SELECT *, (v - prev_value) / nullif(abs(prev_value), 0) AS delta FROM (SELECT *, last_value(v IGNORE NULLS) OVER (
  PARTITION BY TIENDA ORDER BY Semana ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_value FROM {SERIES})"""


@check("prev_non_null_delta", DELTA)
def _(spark, sf):
    return ops.prev_non_null_delta(series(spark, sf), ["TIENDA"], "Semana", "v")


@check("delta_direction", f"""SELECT up, down, count(*) AS n FROM (SELECT CASE WHEN delta IS NULL OR abs(delta) < 0.001 THEN 'neutral' WHEN delta > 0 THEN 'good' ELSE 'bad' END AS up,
  CASE WHEN delta IS NULL OR abs(delta) < 0.001 THEN 'neutral' WHEN delta < 0 THEN 'good' ELSE 'bad' END AS down FROM ({DELTA})) GROUP BY 1, 2""")
def _(spark, sf):
    deltas = ops.prev_non_null_delta(series(spark, sf), ["TIENDA"], "Semana", "v")
    return deltas.groupBy(ops.delta_direction(F.col("delta")).alias("up"), ops.delta_direction(F.col("delta"), False).alias("down")).agg(
        F.count("*").alias("n"))


@check("trend_normalise", f"""SELECT Semana, TIENDA, v, so_far - 1 AS point, n AS points, (v - lo) / CASE WHEN hi = lo THEN 1 ELSE hi - lo END AS height
FROM (SELECT *, min(v) OVER (PARTITION BY TIENDA) AS lo, max(v) OVER (PARTITION BY TIENDA) AS hi, count(v) OVER (PARTITION BY TIENDA) AS n,
  count(v) OVER (PARTITION BY TIENDA ORDER BY Semana ROWS UNBOUNDED PRECEDING) AS so_far FROM {SERIES}) WHERE v IS NOT NULL AND n >= 2""")
def _(spark, sf):
    return ops.trend_normalise(series(spark, sf), ["TIENDA"], "Semana", "v")


@check("rolling_periods", """WITH anchor AS (SELECT least(max(Fecha), DATE '2001-07-14') AS a FROM v_day)
SELECT s.bucket, CASE WHEN s.bucket = 0 THEN 'P' ELSE 'P-' || s.bucket END AS label, a - s.bucket * 7 - 6 AS start, a - s.bucket * 7 AS "end", Visitas
FROM (SELECT a, CAST(unnest(range(400)) AS INTEGER) AS bucket FROM anchor) s
LEFT JOIN (SELECT CAST((a - Fecha) // 7 AS INTEGER) AS bucket, CAST(sum(Visitas) AS BIGINT) AS Visitas FROM v_day, anchor WHERE Fecha <= a GROUP BY 1) USING (bucket)""")
def _(spark, sf):
    return ops.rolling_periods(i.v_day(spark, sf), i.AS_OF, 7, 400, ["Visitas"])


@check("last_n_days", """SELECT Fecha, Visitas FROM v_day WHERE Fecha BETWEEN (SELECT least(max(Fecha), DATE '2001-07-14') - 27 FROM v_day)
  AND (SELECT least(max(Fecha), DATE '2001-07-14') FROM v_day)""")
def _(spark, sf):
    return ops.last_n_days(i.v_day(spark, sf), "Fecha", i.AS_OF, 28)


@check("window_margin_sum", """SELECT TIENDA, CAST(sum(Buyers) AS BIGINT) AS Buyers FROM b_week_store
WHERE Semana BETWEEN (SELECT min(Fecha) FROM v_day) - 6 AND (SELECT max(Fecha) FROM v_day) GROUP BY 1""")
def _(spark, sf):
    return ops.window_margin_sum(i.b_week_store(spark, sf), "Semana", ["TIENDA"], i.v_day(spark, sf), "Fecha", ["Buyers"])


@check("relative_label", """SELECT Semana, TIENDA, Buyers, CASE WHEN back = 0 THEN 'Ult.sem' ELSE 'S-' || back END AS label FROM b_week_store
JOIN (SELECT Semana, row_number() OVER (ORDER BY Semana DESC) - 1 AS back FROM (SELECT DISTINCT Semana FROM b_week_store)) USING (Semana)""")
def _(spark, sf):
    return ops.relative_label(i.b_week_store(spark, sf), "Semana")


SHARE = """SELECT Mes, segment, v AS MABs, CASE WHEN total > 0 THEN CAST(floor(v / total * 100 + 0.5) AS BIGINT) ELSE 0 END AS share
FROM (SELECT *, sum(v) OVER (PARTITION BY Mes) AS total FROM (SELECT m.Mes, s.segment, count(d.Mes) AS v FROM (SELECT DISTINCT Mes FROM demographics) m
  CROSS JOIN (SELECT unnest(['PLATINUM', 'GOLD', 'SILVER']) AS segment) s LEFT JOIN demographics d ON d.Mes = m.Mes AND d.segment = s.segment GROUP BY 1, 2))"""


@check("share_of_total", SHARE)
def _(spark, sf):
    demo = b.demographics(spark, sf).withColumn("segment", fn.segment_map(F.col("Segmento")))
    return ops.share_of_total(demo, "Mes", "segment", "MABs", ["PLATINUM", "GOLD", "SILVER"])


@check("latest_period", "SELECT TIENDA, max(Semana) AS Semana, arg_max(Buyers, Semana) AS Buyers FROM b_week_store GROUP BY 1")
def _(spark, sf):
    return ops.latest_period(i.b_week_store(spark, sf), "Semana", ["TIENDA"])


@check("ytd_attainment", """SELECT Visitas, NSI_V2, CASE WHEN NSI_V2 > 0 THEN (Visitas - NSI_V2) / NSI_V2 END AS gap
FROM (SELECT CAST(sum(Visitas) AS BIGINT) AS Visitas, sum(NSI_V2) AS NSI_V2 FROM v_day LEFT JOIN plan USING (Fecha) WHERE Fecha >= DATE '1998-01-01')""")
def _(spark, sf):
    joined = ops.join_plan_actual(i.v_day(spark, sf), b.plan(spark, sf).select("Fecha", "NSI_V2"), "Fecha")
    return ops.ytd_attainment(joined, "Fecha", "1998-05-05", "Visitas", {"NSI_V2": "gap"})


# ---- ordering, limits, keys ----


@check("order_output", "SELECT Semana, TIENDA, Buyers FROM b_week_store ORDER BY 1, 2")
def _(spark, sf):
    return ops.order_output(i.b_week_store(spark, sf), "Semana", "TIENDA")


@check("sort_periods", "SELECT DISTINCT Semana FROM b_week_store ORDER BY 1")
def _(spark, sf):
    return ops.sort_periods(i.b_week_store(spark, sf), "Semana")


@check("result_cap", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10000")
def _(spark, sf):
    return ops.result_cap(scan_table(spark, "orders", sf).select("o_orderkey", "o_totalprice"), 10000, "o_totalprice", "o_orderkey")


@check("top_latest", "SELECT * FROM v_day ORDER BY Fecha DESC LIMIT 1")
def _(spark, sf):
    return ops.top_latest(i.v_day(spark, sf), "Fecha")


@check("distinct_keys", "SELECT DISTINCT motivo, fallo FROM claims_rows")
def _(spark, sf):
    rows = b.claims_monthly(spark, sf).select(F.trim("motivo").alias("motivo"), F.coalesce("fallo", F.lit("")).alias("fallo"))
    return ops.distinct_keys(rows, "motivo", "fallo")


@check("distinct_keys_nested", "SELECT DISTINCT t.tag AS tag FROM order_lines, unnest(tags) AS t(tag)")
def _(spark, sf):
    return ops.distinct_keys(b.order_lines(spark, sf).withColumnRenamed("tags", "tag"), "tag", unpack="tag")


@check("distinct_dates", "SELECT DISTINCT CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem")
def _(spark, sf):
    return ops.distinct_dates(scan_table(spark, "lineitem", sf), "l_shipdate")
