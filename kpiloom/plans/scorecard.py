"""The scorecard: its marts under their names, with period labels, as JSON records and as metric tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, Window, functions as F

from kpiloom.functions.dates import day_label, month_label
from kpiloom.operators.filters import DateLike
from kpiloom.plans import experience, marts, people, planning, tables
from kpiloom.sources.sinks import json_records
from kpiloom.sources.tables import source_fallback, union_sources

#: Label of a period by its grain: ``Ene'26`` for months, ``27/abr`` for days and weeks.
LABELS = {"month": month_label, "week": day_label, "day": day_label}

#: Lookups without which a mart is still shown; their columns are then null.
OPTIONAL = {"visits_week": "Fecha date, Visitas bigint", "visits_day": "Fecha date, Visitas bigint",
            "cvr_week": "Semana date, Buyers bigint, Visitors bigint, CVR double",
            "cvr_day": "Fecha date, Buyers bigint, Visitors bigint, CVR double",
            "growth_week_store": "Semana date, Tienda string"}

#: View -> the metrics of its table.
VIEWS = {"weekly": tables.GROWTH_METRICS, "monthly": tables.GROWTH_METRICS, "daily": tables.DAILY_METRICS,
         "daily_store": tables.DAILY_STORE_METRICS, "weekly_ops": tables.OPS_METRICS, "monthly_ops": tables.OPS_METRICS,
         "daily_ops": tables.OPS_METRICS, "cx": tables.CX_METRICS, "pl_shares": tables.PL_METRICS,
         "rolling_7d": tables.ROLLING_METRICS, "rolling_28d": tables.ROLLING_METRICS, "plan_vs_week": tables.PLAN_METRICS,
         "plan_vs_month": tables.PLAN_METRICS, "plan_vs_day": tables.PLAN_METRICS}

#: A mart, its keys (the period first, if it has one), and the grain of the period.
Mart = tuple[DataFrame, list[str], str | None]


def scorecard_marts(inputs: Mapping[str, DataFrame], as_of: DateLike, anchor: DataFrame | None = None,
                    paid: str = "paid_lc", recovered: str = "recovered_lc") -> dict[str, Mart]:
    """Every mart whose main input is there, by name.

    ``inputs`` holds stored period results: growth_week, growth_day, growth_week_store,
    growth_day_store, visits_week, visits_day, cvr_week, cvr_day, ops_week, ops_day, ops_week_store,
    buyers_week_store, nps, cx_month, cx_store, pl_month, demographics, plan_month, plan_week, plan_day,
    assortment, claims and bpp (of which ``paid`` and ``recovered`` name the amounts). Visits,
    conversion and stores are lookups: without them, their columns are null. The monthly mart takes
    daily growth and visits if they have rows, else weekly ones. ``anchor`` is the last day of
    the daily and rolling windows, if it is known.
    """
    spark = next(iter(inputs.values())).sparkSession if inputs else None

    def given(name: str) -> DataFrame:
        found = inputs.get(name)
        return found if found is not None else spark.createDataFrame([], OPTIONAL[name])

    def finer(name: str) -> DataFrame:
        return source_fallback(inputs.get(f"{name}_day"), given(f"{name}_week") if name == "visits" else inputs[f"{name}_week"])

    out: dict[str, Mart] = {}

    def add(name: str, needs: str | Iterable[str], build: Callable[[], DataFrame], keys: list[str], grain: str | None) -> None:
        if all(n in inputs or n in out for n in ([needs] if isinstance(needs, str) else needs)):
            out[name] = (build(), keys, grain)

    of = lambda plan, name: lambda: plan(inputs[name])
    mart = lambda name: out[name][0]
    week, month, day = ["Semana", "Tienda"], ["Mes", "Tienda"], ["Fecha", "Tienda"]
    lookups = lambda grain: [given(f"{n}_{grain}") for n in ("visits", "cvr")]

    add("weekly", "growth_week", lambda: marts.weekly_kpis(
        inputs["growth_week"], *lookups("week"), given("growth_week_store"), as_of), ["Fecha"], "week")
    add("weekly_ops", "ops_week", of(marts.weekly_ops_mart, "ops_week"), ["Semana"], "week")
    add("weekly_ops_store", "ops_week_store", of(marts.weekly_ops_store_mart, "ops_week_store"), week, "week")
    add("weekly_buyers", "buyers_week_store", of(marts.weekly_buyers_mart, "buyers_week_store"), ["Semana", "TIENDA"], "week")
    add("weekly_store", "growth_week_store", of(marts.weekly_store_mart, "growth_week_store"), week, "week")
    add("monthly", "growth_week", lambda: marts.monthly_kpis(
        finer("growth"), finer("visits"), given("cvr_week"), given("growth_week_store"), as_of), ["Mes"], "month")
    add("monthly_ops", "ops_week", of(marts.monthly_ops, "ops_week"), ["Mes"], "month")
    add("monthly_ops_store", "ops_week_store", of(marts.monthly_ops_store, "ops_week_store"), month, "month")
    add("monthly_buyers", "buyers_week_store", of(marts.monthly_buyers_store, "buyers_week_store"), ["Mes", "TIENDA"], "month")
    add("monthly_store", "growth_week_store", of(marts.monthly_store, "growth_week_store"), month, "month")
    add("pl", "pl_month", of(marts.pl_ratios, "pl_month"), ["Mes"], "month")
    add("pl_shares", ["pl_month", "monthly"], lambda: marts.pl_pct_of_growth(inputs["pl_month"], mart("monthly")), ["Mes"], "month")
    add("cx", "cx_month", of(experience.cx_monthly, "cx_month"), ["Mes"], "month")
    add("cx_store", "cx_store", of(experience.cx_monthly_store, "cx_store"), month, "month")
    add("nps", "nps", lambda: inputs["nps"], month, "month")
    add("demo_segment", "demographics", of(people.demo_segment_month, "demographics"), ["Mes", "segment"], "month")
    add("demo_segment_store", "demographics", of(people.demo_segment_store, "demographics"), ["TIENDA", "segment"], None)
    add("demo_age", "demographics", of(people.demo_age_month, "demographics"), ["Mes", "age_group"], "month")
    add("demo_gender", "demographics", of(people.demo_gender_month, "demographics"), ["Mes", "Genero"], "month")
    add("daily", "growth_day", lambda: marts.daily_kpis(inputs["growth_day"], *lookups("day"), as_of, anchor=anchor), ["Fecha"], "day")
    add("daily_ops", ["ops_day", "daily"], lambda: marts.daily_ops(inputs["ops_day"], mart("daily").select("Fecha")), ["Fecha"], "day")
    add("daily_cvr", "cvr_day", lambda: inputs["cvr_day"].select("Fecha", "CVR"), ["Fecha"], "day")
    add("daily_store", "growth_day_store", of(marts.daily_store, "growth_day_store"), day, "day")
    add("window_store", ["growth_week_store", "daily"], lambda: marts.window_store_totals(
        inputs["growth_week_store"], mart("daily").select("Fecha")), ["Tienda"], None)
    for name, plan in (("rolling_7d", marts.rolling_7d), ("rolling_28d", marts.rolling_28d)):
        add(name, "growth_day", lambda plan=plan: plan(inputs["growth_day"], *lookups("day"), as_of, anchor), ["end"], None)
    add("plan_monthly", "plan_month", lambda: inputs["plan_month"], ["Mes"], "month")
    add("plan_weekly", "plan_week", lambda: inputs["plan_week"], ["Semana"], "week")
    add("plan_daily", "plan_day", lambda: inputs["plan_day"], ["Fecha"], "day")
    weeks = lambda: inputs["plan_week"].withColumnRenamed("Semana", "Fecha")
    add("plan_vs_month", ["plan_month", "monthly"], lambda: planning.plan_vs_actual(mart("monthly"), inputs["plan_month"], "Mes"), ["Mes"], "month")
    add("plan_vs_week", ["plan_week", "weekly"], lambda: planning.plan_vs_actual(mart("weekly"), weeks(), "Fecha"), ["Fecha"], "week")
    add("plan_vs_day", ["plan_day", "daily"], lambda: planning.plan_vs_actual(mart("daily"), inputs["plan_day"], "Fecha"), ["Fecha"], "day")
    add("assortment", "assortment", lambda: inputs["assortment"].select("Mes", "Tienda", "metric", "value"), ["Mes", "Tienda", "metric"], "month")
    add("claims", "claims", of(experience.claims_reasons, "claims"), ["Mes", "Tienda", "motivo", "fallo"], "month")
    add("bpp_types", "bpp", lambda: experience.bpp_by_type(inputs["bpp"], paid, recovered), ["Mes", "CLAIM_TYPE"], "month")
    add("bpp_trend", "bpp", lambda: experience.bpp_trend(inputs["bpp"], paid), ["Mes"], "month")
    return out


def scorecard_records(inputs: Mapping[str, DataFrame], as_of: DateLike, anchor: DataFrame | None = None, **options) -> DataFrame:
    """All marts as rows (mart, keys, values); where a mart has periods, the measures include their ``label``."""
    return json_records({
        name: (df if grain is None else df.withColumn("label", LABELS[grain](F.col(keys[0]))), keys)
        for name, (df, keys, grain) in scorecard_marts(inputs, as_of, anchor, **options).items()})


def scorecard_tables(inputs: Mapping[str, DataFrame], as_of: DateLike, anchor: DataFrame | None = None, **options) -> DataFrame:
    """The metric tables of all views in one: (view, period, key, metric, value, prev_value, delta, direction, point, height, latest).

    ``key`` is null for tables without a store; ``latest`` marks the view's last period, the
    only one that the scorecard shows with its change.
    """
    found = scorecard_marts(inputs, as_of, anchor, **options)

    def view(name: str) -> DataFrame:
        df, keys, _ = found[name]
        period, by = keys[0], keys[1:]
        table = tables.metric_table(df, VIEWS[name], period, by)
        # every metric has a row in every period
        last = F.max(period).over(Window.partitionBy("metric")) == F.col(period)
        key = F.col(by[0]).cast("string") if by else F.lit(None).cast("string")
        return table.select(F.lit(name).alias("view"), F.col(period).cast("date").alias("period"), key.alias("key"), "metric", "value",
                            "prev_value", "delta", "direction", "point", "height", last.alias("latest"))

    return union_sources(*[view(name) for name in VIEWS if name in found])
