"""Checks of the period marts."""

from pyspark.sql import functions as F

from checks import inputs as i
from checks.registry import check, shared_path
from checks.tables_sql import ECONOMICS, RATE_PAIRS, month, rates_sql, week
from kpiloom import bindings as b, operators as ops, plans
from kpiloom.plans import marts
from kpiloom.session import materialise_all

check("weekly_kpis", "SELECT * FROM k_week")(i.k_week)
check("monthly_kpis", "SELECT * FROM k_month")(i.k_month)
check("daily_kpis", "SELECT * FROM k_day")(i.k_day)


@check("unit_economics", f"SELECT Fecha, Compras, Ordenes, NMV, NMV_USD, NSI, TSIE_total, {ECONOMICS} FROM g_day")
def _(spark, sf):
    return plans.unit_economics(i.g_day(spark, sf))


OPS = """FR_Items, FR_Items_Reemplazo AS FR_Items_Remp, FR_Compras, FR_Compras_Reemplazo AS FR_Compras_Remp, Compra_Perfecta,
  On_Time, Cancel_Rate, Cancel_Buyer, Cancel_Stockout, Cancel_Seller"""
OPS_STORE = "FR_Items, FR_Items_Reemplazo AS FR_Items_Remp, FR_Compras, Compra_Perfecta, On_Time, Cancel_Rate"


def _means(names):
    return ", ".join(f"round(avg({c}), 6) AS {out}" for out, c in names.items())


def _rounded(df, names):
    return df.withColumns({n: F.round(n, 6) for n in names})


@check("weekly_ops_mart", f"SELECT Semana, {OPS} FROM o_week")
def _(spark, sf):
    return plans.weekly_ops_mart(i.o_week(spark, sf))


@check("weekly_ops_store_mart", f"SELECT Semana, Tienda, {OPS_STORE} FROM o_week_store")
def _(spark, sf):
    return plans.weekly_ops_store_mart(i.o_week_store(spark, sf))


@check("monthly_ops", f"SELECT {month('Semana')} AS Mes, {_means(marts.OPS_NAMES)} FROM o_week GROUP BY 1")
def _(spark, sf):
    return _rounded(plans.monthly_ops(i.o_week(spark, sf)), marts.OPS_NAMES)


@check("monthly_ops_store", f"SELECT {month('Semana')} AS Mes, Tienda, {_means(marts.OPS_STORE_NAMES)} FROM o_week_store GROUP BY 1, 2")
def _(spark, sf):
    return _rounded(plans.monthly_ops_store(i.o_week_store(spark, sf)), marts.OPS_STORE_NAMES)


WEIGHTED = ", ".join(
    f"round(sum({n} * {d}) / nullif(sum({d}) FILTER ({n} IS NOT NULL), 0), 6) AS {out}"
    for out, n, d in ((out, n, RATE_PAIRS[n][1]) for out, n in marts.OPS_NAMES.items()))


@check("monthly_ops_weighted", f"""SELECT {month('Semana')} AS Mes, {WEIGHTED}
FROM (SELECT {week('day')} AS Semana, {rates_sql()}, sum(fi_requested) AS fi_requested, sum(fc_purchases) AS fc_purchases,
    sum(ot_packs) AS ot_packs, sum(cr_purchases) AS cr_purchases
  FROM scorecard WHERE site = 'S1' AND store_id IN (7000, 7001, 7002, 7003) AND day >= DATE '1993-01-01' GROUP BY 1) GROUP BY 1""")
def _(spark, sf):
    weeks = plans.ops_weekly(b.scorecard(spark, sf), b.STORE_IDS, i.SHIP_START, "S1", totals=True)
    return _rounded(plans.monthly_ops(weeks, plans.ops.RATE_WEIGHTS), marts.OPS_NAMES)


@check("weekly_store_mart", "SELECT Semana, Tienda, Compras, Ordenes, NMV, NSI, TSIE_total AS TSIE FROM g_week_store")
def _(spark, sf):
    return plans.weekly_store_mart(i.g_week_store(spark, sf))


@check("weekly_buyers_mart", "SELECT Semana, TIENDA, CAST(Buyers AS DOUBLE) AS Buyers FROM b_week_store")
def _(spark, sf):
    return plans.weekly_buyers_mart(i.b_week_store(spark, sf))


@check("monthly_buyers_store", f"SELECT {month('Semana')} AS Mes, TIENDA, CAST(sum(Buyers) AS BIGINT) AS Buyers FROM b_week_store GROUP BY 1, 2")
def _(spark, sf):
    return plans.monthly_buyers_store(i.b_week_store(spark, sf))


@check("monthly_store", f"""SELECT {month('Semana')} AS Mes, Tienda, CAST(sum(Compras) AS BIGINT) AS Compras,
  CAST(sum(Ordenes) AS BIGINT) AS Ordenes, coalesce(sum(NMV), 0) AS NMV, coalesce(sum(NSI), 0) AS NSI FROM g_week_store GROUP BY 1, 2""")
def _(spark, sf):
    return plans.monthly_store(i.g_week_store(spark, sf))


@check("daily_ops", f"""SELECT Fecha, {OPS} FROM o_day
WHERE Fecha BETWEEN (SELECT min(Fecha) FROM k_day) AND (SELECT max(Fecha) FROM k_day)""")
def _(spark, sf):
    return plans.daily_ops(i.o_day(spark, sf), i.k_day(spark, sf).select("Fecha"))


@check("daily_store", """SELECT Fecha, Tienda, Compras, Ordenes, NMV, NSI,
  CASE WHEN NSI != 0 THEN NSI / nullif(TSIE_total, 0) END AS FR_Items FROM g_day_store""")
def _(spark, sf):
    return plans.daily_store(i.g_day_store(spark, sf))


TOTALS = """SELECT Tienda, CAST(sum(Compras) AS BIGINT) AS Compras, CAST(sum(Ordenes) AS BIGINT) AS Ordenes, coalesce(sum(NMV), 0) AS NMV,
  coalesce(sum(NSI), 0) AS NSI FROM g_week_store
WHERE Semana BETWEEN (SELECT min(Fecha) FROM k_day) - 6 AND (SELECT max(Fecha) FROM k_day) GROUP BY 1"""


@check("window_store_totals", TOTALS)
def _(spark, sf):
    return plans.window_store_totals(i.g_week_store(spark, sf), i.k_day(spark, sf).select("Fecha"))


def _rolling_sql(width, n, prefix):
    def sums(table, cols):
        return f"""(SELECT CAST((a.anchor - Fecha) // {width} AS INTEGER) AS bucket, {cols} FROM {table}, anchor a
  WHERE a.anchor - Fecha BETWEEN 0 AND {width * n - 1} GROUP BY 1)"""
    return f"""WITH anchor AS (SELECT least(max(Fecha), DATE '2001-07-14') AS anchor FROM g_day)
SELECT s.bucket, CASE WHEN s.bucket = 0 THEN '{prefix}' ELSE '{prefix}-' || s.bucket END AS label,
  anchor - s.bucket * {width} - {width - 1} AS start, anchor - s.bucket * {width} AS "end", NMV, Compras, Ordenes, NSI,
  CASE WHEN NMV != 0 THEN NMV / nullif(Compras, 0) END AS APV_LC, CASE WHEN NSI != 0 THEN NSI / nullif(TSIE_total, 0) END AS FR_Items,
  Visitas, CVR
FROM (SELECT anchor, CAST(unnest(range({n})) AS INTEGER) AS bucket FROM anchor) s
LEFT JOIN {sums('g_day', '''CAST(sum(Compras) AS BIGINT) AS Compras, CAST(sum(Ordenes) AS BIGINT) AS Ordenes, coalesce(sum(NMV), 0) AS NMV,
  coalesce(sum(NSI), 0) AS NSI, coalesce(sum(TSIE_total), 0) AS TSIE_total''')} USING (bucket)
LEFT JOIN {sums('v_day', 'CAST(sum(Visitas) AS BIGINT) AS Visitas')} USING (bucket)
LEFT JOIN {sums('c_day', 'sum(Buyers) / nullif(sum(Visitors), 0) AS CVR')} USING (bucket)"""


@check("rolling_7d", _rolling_sql(7, 14, "P"))
def _(spark, sf):
    *facts, anchor = i.window(spark, sf, 14 * 7)
    return plans.rolling_7d(*facts, i.AS_OF, anchor)


@check("rolling_28d", _rolling_sql(28, 7, "P28"))
def _(spark, sf):
    return i.rolled_28d(spark, sf)


PL_LINES = ("TGMV, NMV, Net_Variable_Fee, Net_Monetization, Product_Net_Monetization, Variable_Contribution, "
            "Direct_Contribution, Shipping_Cost, Promotions, Coupons")


@check("pl_ratios", f"SELECT Mes, {PL_LINES}, " + ", ".join(
    f"CASE WHEN NMV > 0 THEN {c} / NMV END AS {out}" for out, c in marts.PL_RATIOS.items()) + " FROM pl_monthly")
def _(spark, sf):
    return plans.pl_ratios(b.pl_monthly(spark, sf))


PL_SHARES = "SELECT Mes, g.NMV, " + ", ".join(
    f"CASE WHEN g.NMV > 0 THEN p.{c} / g.NMV END AS {out}" for out, c in marts.PL_GROWTH_SHARES.items()
) + """ FROM (SELECT * FROM pl_monthly) p FULL JOIN (SELECT Mes, nullif(NMV, 0) AS NMV FROM k_month) g USING (Mes)"""


@check("pl_pct_of_growth", PL_SHARES)
def _(spark, sf):
    return plans.pl_pct_of_growth(b.pl_monthly(spark, sf), i.k_month(spark, sf))


@check("cx_monthly", """SELECT Mes, Perfect_Purchases, Total_Purchases, Perfect_Purchase_Rate, Total_Claims, Repentance_Claims AS Repentance,
  Incomplete_Claims AS Incomplete, Different_Claims AS Different, Defective_Claims AS Defective, Claims_Rate, On_Time AS On_Time_CX,
  Cancel_Rate AS Cancel_Rate_CX FROM cx_month""")
def _(spark, sf):
    return plans.cx_monthly(b.cx_month(spark, sf))


@check("cx_monthly_store", "SELECT Mes, Tienda, Perfect_Purchase_Rate, Claims_Rate, Total_Claims, On_Time FROM cx_store")
def _(spark, sf):
    return plans.cx_monthly_store(b.cx_store(spark, sf))


def _demo_sql(*keys, where=""):
    return f"SELECT {', '.join(keys)}, count(*) AS MABs FROM demographics {where} GROUP BY ALL"


@check("demo_segment_month", _demo_sql("Mes", "segment"))
def _(spark, sf):
    return plans.demo_segment_month(b.demographics(spark, sf))


@check("demo_segment_store", _demo_sql("TIENDA", "segment"))
def _(spark, sf):
    return plans.demo_segment_store(b.demographics(spark, sf))


@check("demo_age_month", _demo_sql("Mes", "age_group"))
def _(spark, sf):
    return plans.demo_age_month(b.demographics(spark, sf))


@check("demo_gender_month", _demo_sql("Mes", "Genero", where="WHERE Genero IN ('female', 'male')"))
def _(spark, sf):
    return plans.demo_gender_month(b.demographics(spark, sf))


@check("buyers_ytd", """SELECT CASE WHEN grouping(Mes) = 1 THEN 'Total' ELSE CAST(Mes AS VARCHAR) END AS Mes, CAST(sum(Total_Buyers) AS BIGINT) AS Total_Buyers
FROM buyers_monthly GROUP BY GROUPING SETS ((Mes), ())""")
def _(spark, sf):
    return plans.buyers_ytd(b.buyers_monthly(spark, sf))


PLAN_JOIN = {"day": ("g_day", "Fecha", "plan"), "week": ("k_week", "Fecha", "(SELECT Semana AS Fecha, NMV_V2, \"NMV_4+8\" AS NMV_48 FROM plan_week)"),
             "month": ("k_month", "Mes", f"(SELECT {month('Fecha')} AS Mes, sum(NMV_V2) AS NMV_V2, sum(NMV_48) AS NMV_48 FROM plan GROUP BY 1)")}


def _plan_sql(grain):
    kpis, period, plan = PLAN_JOIN[grain]
    return f"""SELECT {period}, k.NMV, CAST(p.NMV_V2 AS DOUBLE) AS NMV_V2, CAST(p.NMV_48 AS DOUBLE) AS NMV_4p8,
  (k.NMV - p.NMV_V2) / nullif(abs(p.NMV_V2), 0) AS VS_V2, (k.NMV - p.NMV_48) / nullif(abs(p.NMV_48), 0) AS VS_4p8, k.NSI
FROM {kpis} k LEFT JOIN {plan} p USING ({period})"""


def _doubles(df):
    return df.withColumns({c: F.col(c).cast("double") for c in ("NMV_V2", "NMV_4p8")})


@check("plan_vs_actual", _plan_sql("day"))
def _(spark, sf):
    return _doubles(plans.plan_vs_actual(i.g_day(spark, sf), b.plan(spark, sf), "Fecha"))


@check("plan_vs_actual_week", _plan_sql("week"))
def _(spark, sf):
    weekly = plans.plan_weekly(b.plan(spark, sf)).withColumnRenamed("Semana", "Fecha")
    return _doubles(plans.plan_vs_actual(i.k_week(spark, sf), weekly, "Fecha"))


@check("plan_vs_actual_month", _plan_sql("month"))
def _(spark, sf):
    monthly = ops.sum_to_period(b.plan(spark, sf), "Fecha", ["NMV_V2"]).join(
        b.plan(spark, sf).groupBy(F.trunc("Fecha", "month").alias("Mes")).agg(F.sum("`NMV_4+8`").alias("NMV_4+8")), "Mes")
    return _doubles(plans.plan_vs_actual(i.k_month(spark, sf), monthly, "Mes"))


YTD = """SELECT NMV, NMV_V2, NMV_4p8, CASE WHEN NMV_V2 > 0 THEN (NMV - NMV_V2) / NMV_V2 END AS VS_V2,
  CASE WHEN NMV_4p8 > 0 THEN (NMV - NMV_4p8) / NMV_4p8 END AS VS_4p8
FROM (SELECT sum(k.NMV) AS NMV, sum(p.NMV_V2) AS NMV_V2, sum(p.NMV_48) AS NMV_4p8 FROM g_day k LEFT JOIN plan p USING (Fecha) WHERE Fecha >= DATE '2000-01-01')"""


@check("plan_ytd", YTD)
def _(spark, sf):
    return plans.plan_ytd(i.g_day(spark, sf), b.plan(spark, sf), "Fecha", "2000-09-15")


check("assortment_parse", "SELECT CAST(year(Mes) AS INTEGER) AS sheet, * FROM assortment")(i.assortment)

SUMMARY = """SELECT Mes, round(avg(coalesce(disp, 0) / 10 / 100), 6) AS Disponibilidad, round(avg(coalesce(prof, 0) / 10 / 100), 6) AS Profundidad,
  round(avg(coalesce(gap, 0) / 10), 6) AS Gap FROM assortment_rates GROUP BY 1"""


@check("assortment_summary", f"""SELECT *, CASE WHEN Disponibilidad >= 0.70 THEN 'good' ELSE 'bad' END AS Disponibilidad_status,
  CASE WHEN Profundidad >= 0.60 THEN 'good' ELSE 'bad' END AS Profundidad_status, CASE WHEN Gap <= 10 THEN 'good' ELSE 'bad' END AS Gap_status FROM ({SUMMARY})""")
def _(spark, sf):
    return _rounded(plans.assortment_summary(i.assortment(spark, sf), list(b.STORES.values())), ["Disponibilidad", "Profundidad", "Gap"])


@check("claims_reasons", """SELECT Mes, Tienda, motivo, fallo, CAST(sum(claims) AS BIGINT) AS claims, sum(gmv) AS gmv FROM claims_rows GROUP BY 1, 2, 3, 4""")
def _(spark, sf):
    return plans.claims_reasons(b.claims_monthly(spark, sf))


@check("claims_reasons_wide", """
SELECT Tienda, motivo, fallo, CAST(Mes AS VARCHAR) AS Mes, claims
FROM (SELECT *, max(claims) OVER (PARTITION BY Tienda, motivo, fallo) AS most
  FROM (SELECT Mes, Tienda, motivo, fallo, CAST(sum(claims) AS BIGINT) AS claims FROM claims_rows GROUP BY ALL)) WHERE most > 0""")
def _(spark, sf):
    wide = plans.claims_reasons(b.claims_monthly(spark, sf), wide=True)
    keys = ["Tienda", "motivo", "fallo"]
    return wide.unpivot(keys, [c for c in wide.columns if c not in keys], "Mes", "claims").dropna(subset=["claims"])


BPP_TYPES = """SELECT Mes, CASE WHEN grouping(CLAIM_TYPE) = 1 THEN 'TOTAL' ELSE CLAIM_TYPE END AS CLAIM_TYPE,
  round(sum(paid), 2) AS paid, round(sum(recovered), 2) AS recovered, CAST(sum(cases) AS BIGINT) AS cases,
  CASE WHEN sum(paid) > 0 THEN sum(recovered) / sum(paid) END AS coverage
FROM bpp_rows GROUP BY GROUPING SETS ((Mes, CLAIM_TYPE), (Mes))"""


@check("bpp_by_type", BPP_TYPES)
def _(spark, sf):
    return plans.bpp_by_type(b.bpp_monthly(spark, sf), "paid_lc", "recovered_lc")


@check("bpp_trend", "SELECT Mes, round(sum(paid), 2) AS paid FROM bpp_rows GROUP BY 1")
def _(spark, sf):
    return plans.bpp_trend(b.bpp_monthly(spark, sf), "paid_lc")


@check("buyers_table", "SELECT Semana, CAST(nullif(sum(Buyers), 0) AS BIGINT) AS Total, " + ", ".join(
    f"CAST(sum(Buyers) FILTER (TIENDA = 'N{k}') AS BIGINT) AS N{k}" for k in range(4)) + " FROM b_week_store GROUP BY 1")
def _(spark, sf):
    return plans.buyers_table(i.b_week_store(spark, sf), ["N0", "N1", "N2", "N3"])


@check("status_flags", f"""SELECT Mes, Tienda, metric, value, CASE metric WHEN 'Perfect_Purchase_Rate' THEN CASE WHEN value >= 0.85 THEN 'good' ELSE 'bad' END
  WHEN 'Claims_Rate' THEN CASE WHEN value <= 0.03 THEN 'good' ELSE 'bad' END WHEN 'Cancel_Rate' THEN CASE WHEN value <= 0.1 THEN 'good' ELSE 'bad' END
  ELSE CASE WHEN value >= 0.9 THEN 'good' ELSE 'bad' END END AS status
FROM (SELECT Mes, Tienda, unnest(['Perfect_Purchase_Rate', 'Claims_Rate', 'Cancel_Rate', 'On_Time']) AS metric,
  unnest([Perfect_Purchase_Rate, Claims_Rate, Cancel_Rate, On_Time]) AS value FROM cx_store)""")
def _(spark, sf):
    return plans.status_flags(b.cx_store(spark, sf), ["Mes", "Tienda"])


def metric_table_sql(table, period, metrics, by=""):
    """Text of ``metric_table``; ``by`` is a key column followed by a comma."""
    names = "[" + ", ".join(f"'{m}'" for m in metrics) + "]"
    values = "[" + ", ".join(f"CAST({m} AS DOUBLE)" for m in metrics) + "]"
    lower = ", ".join(f"'{m}'" for m, up in metrics.items() if not up) or "''"
    part = f"PARTITION BY {by} metric"
    return f"""SELECT {by} {period}, metric, value, prev_value, delta,
  CASE WHEN metric IN ('VS_V2', 'VS_4p8') THEN CASE WHEN value IS NULL THEN 'neutral' WHEN value >= 0 THEN 'good' ELSE 'bad' END
    WHEN metric IN ('NMV_V2', 'NMV_4p8') THEN 'neutral' WHEN delta IS NULL OR abs(delta) < 0.001 THEN 'neutral'
    WHEN (delta > 0) = (metric NOT IN ({lower})) THEN 'good' ELSE 'bad' END AS direction,
  CASE WHEN value IS NOT NULL AND n >= 2 THEN so_far - 1 END AS point,
  CASE WHEN value IS NOT NULL AND n >= 2 THEN (value - lo) / CASE WHEN hi = lo THEN 1 ELSE hi - lo END END AS height
FROM (SELECT *, (value - prev_value) / nullif(abs(prev_value), 0) AS delta FROM (
  SELECT *, last_value(value IGNORE NULLS) OVER ({part} ORDER BY {period} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_value,
    min(value) OVER ({part}) AS lo, max(value) OVER ({part}) AS hi, count(value) OVER ({part}) AS n,
    count(value) OVER ({part} ORDER BY {period} ROWS UNBOUNDED PRECEDING) AS so_far
  FROM (SELECT {by} {period}, unnest({names}) AS metric, unnest({values}) AS value FROM {table})))"""


from kpiloom.plans import tables  # noqa: E402


@check("metric_table", metric_table_sql("k_month", "Mes", tables.GROWTH_METRICS))
def _(spark, sf):
    return plans.metric_table(i.k_month(spark, sf), tables.GROWTH_METRICS, "Mes")


@check("metric_table_ops", metric_table_sql(f"(SELECT Semana, {OPS} FROM o_week)", "Semana", tables.OPS_METRICS))
def _(spark, sf):
    return plans.metric_table(plans.weekly_ops_mart(i.o_week(spark, sf)), tables.OPS_METRICS, "Semana")


CX_NAMES = """(SELECT Mes, Tienda, Perfect_Purchases, Total_Purchases, Perfect_Purchase_Rate, Total_Claims, Repentance_Claims AS Repentance,
  Incomplete_Claims AS Incomplete, Different_Claims AS Different, Defective_Claims AS Defective, Claims_Rate FROM cx_store)"""


def _cx_named(spark, sf):
    return b.cx_store(spark, sf).withColumnsRenamed({f"{n}_Claims": n for n in ("Repentance", "Incomplete", "Different", "Defective")})


@check("metric_table_claims", metric_table_sql(CX_NAMES, "Mes", tables.CLAIM_METRICS, "Tienda,"))
def _(spark, sf):
    return plans.metric_table(_cx_named(spark, sf), tables.CLAIM_METRICS, "Mes", ["Tienda"])


@check("metric_table_cx", metric_table_sql(CX_NAMES, "Mes", tables.CX_METRICS, "Tienda,"))
def _(spark, sf):
    return plans.metric_table(_cx_named(spark, sf), tables.CX_METRICS, "Mes", ["Tienda"])


@check("metric_table_pl", metric_table_sql(f"({PL_SHARES})", "Mes", tables.PL_METRICS))
def _(spark, sf):
    return plans.metric_table(plans.pl_pct_of_growth(b.pl_monthly(spark, sf), i.k_month(spark, sf)), tables.PL_METRICS, "Mes")


@check("metric_table_plan", metric_table_sql(f"({_plan_sql('day')})", "Fecha", tables.PLAN_METRICS))
def _(spark, sf):
    return plans.metric_table(plans.plan_vs_actual(i.g_day(spark, sf), b.plan(spark, sf), "Fecha"), tables.PLAN_METRICS, "Fecha")


@check("metric_table_rolling", metric_table_sql("rolled", "\"end\"", tables.ROLLING_METRICS).replace(
    "SELECT", _rolling_sql(28, 7, "P28").replace("SELECT s.bucket", "rolled AS (SELECT s.bucket", 1).replace(
        "AS anchor FROM g_day)\n", "AS anchor FROM g_day),\n", 1) + ")\nSELECT", 1))
def _(spark, sf):
    rolled = i.rolled_28d(spark, sf)
    return plans.metric_table(rolled, tables.ROLLING_METRICS, "end")


@check("metric_table_latest", f"""SELECT metric, Mes, value, prev_value, delta, direction FROM ({metric_table_sql("k_month", "Mes", tables.GROWTH_METRICS)})
WHERE Mes = (SELECT max(Mes) FROM k_month)""")
def _(spark, sf):
    table = plans.metric_table(i.k_month(spark, sf), tables.GROWTH_METRICS, "Mes")
    return plans.metric_table_latest(table, "Mes")


@check("metric_table_daily", metric_table_sql("k_day", "Fecha", tables.DAILY_METRICS))
def _(spark, sf):
    return plans.metric_table(i.k_day(spark, sf), tables.DAILY_METRICS, "Fecha")


DAY_STORE = f"(SELECT Fecha, Tienda, NMV, Compras, Ordenes, NSI, {ECONOMICS} FROM g_day_store)"


def _daily_store(spark, sf):
    return plans.metric_table(plans.unit_economics(i.g_day_store(spark, sf)), tables.DAILY_STORE_METRICS, "Fecha", ["Tienda"])


@check("metric_table_daily_store", metric_table_sql(DAY_STORE, "Fecha", tables.DAILY_STORE_METRICS, "Tienda,"))
def _(spark, sf):
    return _daily_store(spark, sf)


# a store without sales on the last day of the view has no value there
@check("metric_table_latest_store", f"""
WITH shown AS ({metric_table_sql(DAY_STORE, "Fecha", tables.DAILY_STORE_METRICS, "Tienda,")}), final AS (SELECT max(Fecha) AS Fecha FROM shown)
SELECT k.Tienda, k.metric, f.Fecha, s.value, s.prev_value, s.delta, coalesce(s.direction, 'neutral') AS direction
FROM (SELECT DISTINCT Tienda, metric FROM shown) k CROSS JOIN final f
LEFT JOIN shown s ON s.Tienda = k.Tienda AND s.metric = k.metric AND s.Fecha = f.Fecha""")
def _(spark, sf):
    return plans.metric_table_latest(_daily_store(spark, sf), "Fecha", ["Tienda"])


MONTH_NAMES = "['Ene','Feb','Mar','Abr','May','Jun','Jul','Ago','Sep','Oct','Nov','Dic']"
MONTH_LABEL = MONTH_NAMES + "[CAST(month({0}) AS INTEGER)] || chr(39) || strftime({0}, '%y')"
DAY_LABEL = "day({0}) || '/' || lower(" + MONTH_NAMES + "[CAST(month({0}) AS INTEGER)])"
SHOWN = {  # mart: (table, period, store, label, a measure)
    "weekly": ("k_week", "Fecha", "NULL", DAY_LABEL, "Compras"), "monthly": ("k_month", "Mes", "NULL", MONTH_LABEL, "Compras"),
    "daily": ("k_day", "Fecha", "NULL", DAY_LABEL, "Compras"), "weekly_store": ("g_week_store", "Semana", "Tienda", DAY_LABEL, "Ordenes"),
    "weekly_ops": ("o_week", "Semana", "NULL", DAY_LABEL, "On_Time"),
    "weekly_ops_store": ("o_week_store", "Semana", "Tienda", DAY_LABEL, "On_Time"),
    "weekly_buyers": ("b_week_store", "Semana", "TIENDA", DAY_LABEL, "Buyers"), "nps": ("nps", "Mes", "Tienda", MONTH_LABEL, "NPS_Score"),
    "cx": ("cx_month", "Mes", "NULL", MONTH_LABEL, "Total_Claims"), "cx_store": ("cx_store", "Mes", "Tienda", MONTH_LABEL, "Total_Claims")}


def _store_all(spark, tables):
    return materialise_all(spark, tables, {name: shared_path(spark, f"records-{name}") for name in tables})  # marts read them many times


@check("scorecard_records", " UNION ALL ".join(
    f"SELECT '{name}' AS mart, CAST({period} AS VARCHAR) AS period, CAST({store} AS VARCHAR) AS store, {label.format(period)} AS label, "
    f"CAST({measure} AS DOUBLE) AS measure FROM {table}" for name, (table, period, store, label, measure) in SHOWN.items()))
def _(spark, sf):
    facts = _store_all(spark, {
        "tallies": lambda: i.tallies(spark, sf), "nps": lambda: i.nps(spark, sf), "buyers_week_store": lambda: i.b_week_store(spark, sf),
        "cvr": lambda: i.c_tallies(spark, sf), "ops": lambda: plans.ops_totals(b.scorecard(spark, sf)), "cx": lambda: b.cx_counts(spark, sf),
        "visits_week": lambda: i.v_week(spark, sf), "visits_day": lambda: i.v_day(spark, sf)})
    growth, ops, cvr, cx = i.growth_results(facts.pop("tallies")), facts.pop("ops"), facts.pop("cvr"), facts.pop("cx")
    stored = facts | _store_all(spark, {name: lambda df=growth[name]: df for name in ("growth_week", "growth_week_store", "growth_day")} | {
        "ops_week": lambda: i.o_week(spark, sf, ops), "ops_week_store": lambda: i.o_week_store(spark, sf, ops),
        "cvr_week": lambda: i.c_week(spark, sf, cvr), "cvr_day": lambda: i.c_day(spark, sf, cvr),
        "cx_month": lambda: b.cx_month(spark, sf, cx), "cx_store": lambda: b.cx_store(spark, sf, cx)})
    shown = plans.scorecard_records(stored, i.AS_OF)
    value = F.coalesce(*[F.when(F.col("mart") == name, F.get_json_object("values", f"$.{spec[4]}")) for name, spec in SHOWN.items()])
    return shown.filter(F.col("mart").isin(*SHOWN)).select(
        "mart", F.col("keys")[0].alias("period"), F.get("keys", F.lit(1)).alias("store"),
        F.get_json_object("values", "$.label").alias("label"), value.cast("double").alias("measure"))
