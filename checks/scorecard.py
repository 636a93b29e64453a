"""Checks of the whole scorecard: every mart with every measure, and the metric tables of all views."""

from pyspark.sql import functions as F

from checks import inputs as i, marts as m
from checks.registry import ORACLES, check, shared_path
from checks.tables_sql import month
from kpiloom import bindings as b, plans
from kpiloom.operators.periods import rolling_anchor
from kpiloom.plans.scorecard import VIEWS
from kpiloom.session import materialise, materialise_all

PLAN_MONTH = f"SELECT {month('Fecha')} AS Mes, sum(NMV_V2) AS NMV_V2, sum(NMV_48) AS \"NMV_4+8\" FROM plan GROUP BY 1"
PLAN_DAY = 'SELECT Fecha, NMV_V2, NSI_V2, NMV_48 AS "NMV_4+8", NSI_48 AS "NSI_4+8", Pur_48 AS "Purchases_4+8" FROM plan'
WINDOW_DAYS = "(SELECT Fecha, NMV, NSI FROM k_day)"


def plan_gap(kpis, period, plan):
    return f"""SELECT {period}, k.NMV, p.NMV_V2, p.NMV_48 AS NMV_4p8, (k.NMV - p.NMV_V2) / nullif(abs(p.NMV_V2), 0) AS VS_V2,
  (k.NMV - p.NMV_48) / nullif(abs(p.NMV_48), 0) AS VS_4p8, k.NSI FROM {kpis} k LEFT JOIN {plan} p USING ({period})"""


#: Mart -> (keys, SQL, or the check that states it).
MARTS = {
    "weekly": (["Fecha"], "SELECT * FROM k_week"), "monthly": (["Mes"], "SELECT * FROM k_month"), "daily": (["Fecha"], "SELECT * FROM k_day"),
    "weekly_ops": (["Semana"], "weekly_ops_mart"), "weekly_ops_store": (["Semana", "Tienda"], "weekly_ops_store_mart"),
    "weekly_buyers": (["Semana", "TIENDA"], "weekly_buyers_mart"), "weekly_store": (["Semana", "Tienda"], "weekly_store_mart"),
    "monthly_ops": (["Mes"], "monthly_ops"), "monthly_ops_store": (["Mes", "Tienda"], "monthly_ops_store"),
    "monthly_buyers": (["Mes", "TIENDA"], "monthly_buyers_store"), "monthly_store": (["Mes", "Tienda"], "monthly_store"),
    "pl": (["Mes"], "pl_ratios"), "pl_shares": (["Mes"], "pl_pct_of_growth"), "cx": (["Mes"], "cx_monthly"),
    "cx_store": (["Mes", "Tienda"], "cx_monthly_store"), "nps": (["Mes", "Tienda"], "SELECT * FROM nps"),
    "demo_segment": (["Mes", "segment"], "demo_segment_month"), "demo_segment_store": (["TIENDA", "segment"], "demo_segment_store"),
    "demo_age": (["Mes", "age_group"], "demo_age_month"), "demo_gender": (["Mes", "Genero"], "demo_gender_month"),
    "daily_ops": (["Fecha"], "daily_ops"), "daily_cvr": (["Fecha"], "SELECT Fecha, CVR FROM c_day"),
    "daily_store": (["Fecha", "Tienda"], "daily_store"), "window_store": (["Tienda"], "window_store_totals"),
    "rolling_7d": (["end"], "rolling_7d"), "rolling_28d": (["end"], "rolling_28d"), "plan_monthly": (["Mes"], PLAN_MONTH),
    "plan_weekly": (["Semana"], "SELECT * FROM plan_week"), "plan_daily": (["Fecha"], PLAN_DAY),
    "plan_vs_month": (["Mes"], plan_gap("k_month", "Mes", f"({PLAN_MONTH.replace('\"NMV_4+8\"', 'NMV_48')})")),
    "plan_vs_week": (["Fecha"], plan_gap("k_week", "Fecha", '(SELECT Semana AS Fecha, NMV_V2, "NMV_4+8" AS NMV_48 FROM plan_week)')),
    "plan_vs_day": (["Fecha"], plan_gap(WINDOW_DAYS, "Fecha", "plan")),
    "assortment": (["Mes", "Tienda", "metric"], "SELECT Mes, Tienda, metric, value FROM assortment"),
    "claims": (["Mes", "Tienda", "motivo", "fallo"], "claims_reasons"), "bpp_types": (["Mes", "CLAIM_TYPE"], "bpp_by_type"),
    "bpp_trend": (["Mes"], "bpp_trend")}
#: Texts among the measures.
TEXTS = {"rolling_7d": ["label", "start"], "rolling_28d": ["label", "start"]}


def mart_sql(name, spec):
    keys, sql = spec
    left_out = ", ".join(f'"{c}"' for c in keys + TEXTS.get(name, []))
    key = " || '/' || ".join(f'CAST("{k}" AS VARCHAR)' for k in keys)
    return f"""SELECT '{name}' AS mart, key, measure, round(value, 6) + 0 AS value FROM (
  UNPIVOT (SELECT {key} AS key, CAST(COLUMNS(* EXCLUDE ({left_out})) AS DOUBLE) FROM ({ORACLES.get(sql, sql)}))
  ON COLUMNS(* EXCLUDE (key)) INTO NAME measure VALUE value)"""


def store_all(spark, tables):
    return materialise_all(spark, tables, {name: shared_path(spark, f"score-{name}") for name in tables})


def stored_inputs(spark, sf):
    """All inputs of the scorecard, each computed once. What several of them are made from is stored too, and read once."""
    facts = store_all(spark, {
        "tallies": lambda: i.tallies(spark, sf), "nps": lambda: i.nps(spark, sf), "pl_month": lambda: b.pl_monthly(spark, sf),
        "demographics": lambda: plans.demographic_totals(b.demographics(spark, sf)), "buyers_week_store": lambda: i.b_week_store(spark, sf),
        "cvr": lambda: i.c_tallies(spark, sf), "ops": lambda: plans.ops_totals(b.scorecard(spark, sf)),
        "cx": lambda: b.cx_counts(spark, sf), "sheet": lambda: b.assortment_sheet(spark, sf),
        "claims": lambda: plans.claims_totals(b.claims_monthly(spark, sf)),
        "bpp": lambda: plans.bpp_totals(b.bpp_monthly(spark, sf), "paid_lc", "recovered_lc"),
        "plan": lambda: b.plan(spark, sf), "visits_week": lambda: i.v_week(spark, sf), "visits_day": lambda: i.v_day(spark, sf)})
    counted, ops, sheet, plan, cvr, cx = (facts.pop(name) for name in ("tallies", "ops", "sheet", "plan", "cvr", "cx"))
    results = i.growth_results(counted)
    inputs = facts | store_all(spark, {name: lambda df=df: df for name, df in results.items()} | {
        "ops_week": lambda: i.o_week(spark, sf, ops), "ops_day": lambda: i.o_day(spark, sf, ops), "ops_week_store": lambda: i.o_week_store(spark, sf, ops),
        "cvr_week": lambda: i.c_week(spark, sf, cvr), "cvr_day": lambda: i.c_day(spark, sf, cvr),
        "cx_month": lambda: b.cx_month(spark, sf, cx), "cx_store": lambda: b.cx_store(spark, sf, cx),
        "plan_week": lambda: plans.plan_weekly(plan),
        "plan_day": lambda: plan.select("Fecha", "NMV_V2", "NSI_V2", "`NMV_4+8`", "`NSI_4+8`", "`Purchases_4+8`"),
        "plan_month": lambda: plan.groupBy(F.trunc("Fecha", "month").alias("Mes")).agg(
            F.sum("NMV_V2").alias("NMV_V2"), F.sum("`NMV_4+8`").alias("NMV_4+8")),
        "assortment": lambda: i.assortment(spark, sf, sheet)})
    # the last day of the stored daily growth is the last day with sales
    return inputs, materialise(rolling_anchor(inputs["growth_day"], "Fecha", i.AS_OF), shared_path(spark, "score-anchor"))


@check("scorecard_all", " UNION ALL ".join(mart_sql(name, spec) for name, spec in MARTS.items()))
def _(spark, sf):
    inputs, anchor = stored_inputs(spark, sf)
    rows = plans.scorecard_records(inputs, i.AS_OF, anchor)
    values = rows.select("mart", F.array_join("keys", "/").alias("key"), F.col("keys"),
                         F.explode(F.from_json("values", "map<string,string>")).alias("measure", "text"))
    known = F.size(F.filter("keys", lambda k: k.isNull())) == 0
    numbers = values.select("mart", F.when(known, F.col("key")).alias("key"), "measure", (F.round(F.col("text").try_cast("double"), 6) + 0).alias("value"))
    return numbers.dropna(subset=["value"])


def views_sql():
    """Each view's metric table over its mart."""
    out = []
    for name, metrics in VIEWS.items():
        keys, sql = MARTS[name]
        period, by = f'"{keys[0]}"', f"{keys[1]}," if len(keys) > 1 else ""
        table = m.metric_table_sql(f"({ORACLES.get(sql, sql)})", period, metrics, by)
        out.append(f"""SELECT '{name}' AS view, CAST({period} AS DATE) AS period, {f'CAST({keys[1]} AS VARCHAR)' if by else 'CAST(NULL AS VARCHAR)'} AS key,
  metric, round(value, 6) + 0 AS value, round(prev_value, 6) + 0 AS prev_value, round(delta, 6) + 0 AS delta, direction, point, round(height, 6) + 0 AS height,
  {period} = max({period}) OVER () AS latest FROM ({table})""")
    return " UNION ALL ".join(out)


@check("scorecard_tables", views_sql())
def _(spark, sf):
    inputs, anchor = stored_inputs(spark, sf)
    shown = plans.scorecard_tables(inputs, i.AS_OF, anchor)
    return shown.withColumns({c: F.round(c, 6) + 0 for c in ("value", "prev_value", "delta", "height")})
