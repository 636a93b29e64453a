"""The generic metric table and metric status."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from kpiloom.operators.periods import delta_direction, prev_non_null_delta, trend_columns

# Fixed values -- metrics of each table; False where a lower value is better.
GROWTH_METRICS = {"NMV": True, "Compras": True, "Ordenes": True, "NSI": True, "APV_LC": True, "NASP_LC": True,
                  "FR_Items": True, "NSI_Cart": True, "Ord_Comp": True, "Visitas": True, "CVR": True, "Stores": True}
DAILY_METRICS = {m: up for m, up in GROWTH_METRICS.items() if m != "Stores"}
DAILY_STORE_METRICS = {m: GROWTH_METRICS[m] for m in ("NMV", "Compras", "Ordenes", "NSI", "FR_Items")}
OPS_METRICS = {"FR_Items": True, "FR_Items_Remp": True, "FR_Compras": True, "FR_Compras_Remp": True,
               "Compra_Perfecta": True, "On_Time": True, "Cancel_Rate": False, "Cancel_Buyer": False,
               "Cancel_Stockout": False, "Cancel_Seller": False}
CLAIM_METRICS = {"Perfect_Purchase_Rate": True, "Claims_Rate": False, "Total_Claims": False, "Repentance": False,
                 "Incomplete": False, "Different": False, "Defective": False}
CX_METRICS = {"Perfect_Purchase_Rate": True, "Perfect_Purchases": True, "Total_Purchases": True,
              "Claims_Rate": False, "Total_Claims": False, "Repentance": False, "Incomplete": False,
              "Different": False, "Defective": False}
PL_METRICS = {"NMV": True, "TGMV_pct": True, "Net_Variable_Fee_pct": True, "Net_Monetization_pct": True,
              "Product_NetMon_pct": True, "Shipping_Cost_pct": False, "Promotions_pct": False, "Coupons_pct": False,
              "Variable_Contribution_pct": True, "Direct_Contribution_pct": True}
ROLLING_METRICS = {"NMV": True, "Compras": True, "Ordenes": True, "APV_LC": True, "NSI": True, "FR_Items": True,
                   "Visitas": True, "CVR": True}
PLAN_METRICS = {"NMV": True, "NMV_V2": True, "NMV_4p8": True, "VS_V2": True, "VS_4p8": True}

#: Coloured by the sign of the value, and not coloured at all, instead of by delta.
BY_VALUE = ("VS_V2", "VS_4p8")
NO_DELTA = ("NMV_V2", "NMV_4p8")

# Fixed values -- status limits: (limit, higher is better).
THRESHOLDS = {
    "Take_Rate": (0.09, True), "VC_Over_NMV": (0.0, True), "DC_Over_NMV": (0.0, True),
    "Perfect_Purchase_Rate": (0.85, True), "Claims_Rate": (0.03, False), "Cancel_Rate": (0.10, False),
    "On_Time": (0.90, True), "coverage": (0.5, True), "Disponibilidad": (0.70, True),
    "Profundidad": (0.60, True), "Gap": (10.0, False)}


def unpivot_metrics(mart: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """(keys, metric, value) rows."""
    values = [F.col(m).cast("double").alias(m) for m in metrics]
    return mart.select(*keys, *values).unpivot(keys, metrics, "metric", "value")


def metric_table(mart: DataFrame, metrics: Mapping[str, bool], period: str, by: list[str] = (),
                 by_value: tuple[str, ...] = BY_VALUE, no_delta: tuple[str, ...] = NO_DELTA) -> DataFrame:
    """Every metric in every period: value, change against the latest earlier value,
    direction, and position and height in the metric's trend line.

    Series are windows over (keys, metric), bounded by the number of periods.
    """
    by = list(by)
    key = [*by, "metric"]
    long = unpivot_metrics(mart, [*by, period], list(metrics))
    deltas = prev_non_null_delta(long, key, period, "value")
    lower = [m for m, higher_better in metrics.items() if not higher_better]
    delta = F.col("delta")
    sign = F.when(F.col("value").isNull(), "neutral").when(F.col("value") >= 0, "good").otherwise("bad")
    direction = (F.when(F.col("metric").isin(*by_value), sign)
                 .when(F.col("metric").isin(*no_delta), "neutral")
                 .otherwise(delta_direction(delta, ~F.col("metric").isin(*lower))))
    trend = trend_columns(key, period, "value")
    return deltas.withColumns({"direction": direction, "point": trend["point"], "height": trend["height"]})


def metric_table_latest(table: DataFrame, period: str, by: list[str] = ()) -> DataFrame:
    """The view's last period, the only one shown with its change, for every metric and key.

    A key without a row in that period has nulls there, not its own last value.
    """
    key = [*by, "metric"]
    last = table.agg(F.max(period)).scalar()
    row = F.max(F.when(F.col(period) == last, F.struct("value", "prev_value", "delta", "direction")))
    return table.groupBy(*key).agg(row.alias("r")).select(
        *key, last.alias(period), "r.value", "r.prev_value", "r.delta", F.coalesce("r.direction", F.lit("neutral")).alias("direction"))


def status_flags(df: DataFrame, keys: list[str], thresholds: Mapping[str, tuple[float, bool]] = THRESHOLDS) -> DataFrame:
    """Status of each known metric of ``df``: (keys, metric, value, status)."""
    known = {m: t for m, t in thresholds.items() if m in df.columns}
    long = unpivot_metrics(df, keys, list(known))
    met = F.lit(None).cast("boolean")
    for m, (limit, up) in known.items():
        ok = F.col("value") >= limit if up else F.col("value") <= limit
        met = F.when(F.col("metric") == m, ok).otherwise(met)
    return long.withColumn("status", F.when(F.coalesce(met, F.lit(False)), "good").otherwise("bad"))
