"""Customer experience: claims, buyer protection, NPS."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, functions as F

from kpiloom.constants import LOOKBACK_DAYS, OTHER, PARTNERSHIP_TAG, TOTAL
from kpiloom.functions.dates import day, month_from_yyyymm, month_start
from kpiloom.functions.masks import held, mask_names, row_masks
from kpiloom.functions.numbers import positive_ratio, safe_ratio
from kpiloom.functions.retail import blank_to_total, nps_bucket, store_names, store_number, value_status
from kpiloom.operators.aggregates import total_label, zero_sum
from kpiloom.operators.filters import (
    DateLike, equality_filter, like_filter, lookback_filter, not_null_filter, start_date_filter)
from kpiloom.operators.joins import join_claims_orders, join_survey_store
from kpiloom.plans.growth import scoped_items


def claims_by_order(claims: DataFrame, orders: DataFrame, stores: Iterable[str], as_of: DateLike,
                    respondent: int | None = None, days: int = LOOKBACK_DAYS, tag: str = PARTNERSHIP_TAG) -> DataFrame:
    """Claimed orders by order date, store, claim date, type and result."""
    recent = lookback_filter(claims, "created_at", as_of, days)
    if respondent is not None:
        recent = equality_filter(recent, respondent_id=respondent)
    recent = recent.select("order_id", day(F.col("created_at")).alias("claim_date"), "claim_type", "claim_result")
    scoped = (scoped_items(orders, stores, as_of, days, tag, live_only=False)
              .select("order_id", "order_date", "store_id"))
    # both sides are distinct rows, and so is their join: the count needs no distinct
    return (join_claims_orders(recent, scoped)
            .groupBy("order_date", "store_id", "claim_date", "claim_type", "claim_result")
            .agg(F.count("order_id").alias("claims")))


def bpp_daily(bpp: DataFrame, as_of: DateLike, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Protection amounts and cases per day and type."""
    return (lookback_filter(bpp, "day", as_of, days)
            .groupBy(day(F.col("day")).alias("bpp_date"), F.upper("claim_type").alias("claim_type"))
            .agg(F.round(F.sum("total_usd"), 2).alias("bpp_total_usd"),
                 F.round(F.sum("recovery_usd"), 2).alias("bpp_recovery_usd"),
                 F.count("*").alias("cases")))


def nps_monthly(survey: DataFrame, order_lines: DataFrame, stores: Mapping[str, str], code: str = "",
                site: str | None = None, start: DateLike | None = None, unmapped: str | None = None) -> DataFrame:
    """NPS per month and store, with the month total.

    Responses are counted per (month, order, bucket) before they meet the order's
    stores; a heavily surveyed order is a few weighted rows by then. The different stores of an order
    are one row, a set in bits. Responses without
    a listed store form a group of their own (label ``unmapped``), apart from the total.
    """
    answers = like_filter(survey, "code", code).select(
        month_start(F.col("end_date")).alias("Mes"), "order_id", nps_bucket(F.col("score")).alias("bucket"))
    weighted = (not_null_filter(answers, "bucket").groupBy("Mes", "order_id", "bucket")
                .agg(F.count("*").alias("w")))
    lines = equality_filter(order_lines, site=site) if site is not None else order_lines
    names = [None, *store_names(stores)]
    masks = mask_names(len(names))
    sold = start_date_filter(lines, "closed_at", start).select("order_id", store_number(F.col("item.node_id"), stores).alias("store"))
    order_stores = sold.groupBy("order_id").agg(*[F.bit_or(m).alias(n) for n, m in zip(masks, row_masks(F.col("store"), len(names)))])
    per_set = (join_survey_store(weighted, order_stores)
               .groupBy("Mes", *[F.coalesce(F.col(m), F.lit(int(m == masks[0])).cast("bigint")).alias(m) for m in masks], "bucket")
               .agg(F.sum("w").alias("w")))
    found = held(masks, [(k, [0], name) for k, name in enumerate(names)])
    per_bucket = (per_set.select("Mes", "bucket", "w", F.explode(found).alias("s"))
                  .groupBy("Mes", F.col("s.name").alias("Tienda"), "bucket").agg(F.sum("w").alias("w")))
    n = lambda b: zero_sum(F.when(F.col("bucket") == b, F.col("w")))
    counts = [F.round(safe_ratio(n(1) - n(-1), F.sum("w")) * 100, 0).alias("NPS_Score"),
              F.sum("w").alias("Total_Responses"), n(1).alias("Promotores"), n(0).alias("Neutros"),
              n(-1).alias("Detractores")]
    return total_label(per_bucket, ["Mes", "Tienda"], "Tienda", counts, TOTAL, unmapped)


def nps_pivot(nps: DataFrame, wide: bool = True) -> DataFrame:
    """Store by month grid of scores; long form with status when not ``wide``.

    The wide form has a column for every month of the data, which Spark looks up first.
    """
    scores = not_null_filter(nps, "Mes").select(
        blank_to_total(F.col("Tienda")).alias("Tienda"), month_start(F.col("Mes")).alias("Mes"), "NPS_Score")
    if not wide:
        return scores.withColumn("status", value_status(F.col("NPS_Score"), 50, 20))
    columns = scores.withColumn("Mes", F.date_format("Mes", "yyyy-MM-dd"))
    return (columns.groupBy("Tienda").pivot("Mes").agg(F.max("NPS_Score")))


def cx_monthly(cx: DataFrame) -> DataFrame:
    """Customer-experience metrics of the month under their scorecard names."""
    rows = not_null_filter(cx, "Mes")
    same = lambda *names: [F.col(n) for n in names]
    return rows.select(
        month_start(F.col("Mes")).alias("Mes"),
        *same("Perfect_Purchases", "Total_Purchases", "Perfect_Purchase_Rate", "Total_Claims"),
        F.col("Repentance_Claims").alias("Repentance"), F.col("Incomplete_Claims").alias("Incomplete"),
        F.col("Different_Claims").alias("Different"), F.col("Defective_Claims").alias("Defective"),
        F.col("Claims_Rate"), F.col("On_Time").alias("On_Time_CX"), F.col("Cancel_Rate").alias("Cancel_Rate_CX"))


def cx_monthly_store(cx_store: DataFrame) -> DataFrame:
    return not_null_filter(cx_store, "Mes").select(
        month_start(F.col("Mes")).alias("Mes"), "Tienda", "Perfect_Purchase_Rate", "Claims_Rate",
        "Total_Claims", "On_Time")


def claims_totals(claims: DataFrame, value: str = "gmv_reclamado") -> DataFrame:
    """Claims of a month, store, reason and verdict in one row, for ``claims_reasons``."""
    return claims.groupBy(month_start(F.col("mes")).alias("mes"), "tienda", "motivo", "fallo").agg(
        F.sum(F.col("claims").cast("bigint")).alias("claims"), F.sum(F.col(value).cast("double")).alias(value))


def bpp_totals(bpp: DataFrame, paid_col: str, recovered_col: str) -> DataFrame:
    """Protection cases of a month and type in one row, for ``bpp_by_type`` and ``bpp_trend``."""
    amount = lambda c: F.sum(F.col(c).cast("double")).alias(c)
    return bpp.groupBy("mes", "CLAIM_TYPE").agg(
        amount(paid_col), amount(recovered_col), F.sum(F.col("casos").try_cast("double").try_cast("bigint")).alias("casos"))


def claims_reasons(claims: DataFrame, wide: bool = False, value: str = "gmv_reclamado") -> DataFrame:
    """Claims and claimed value by month, store, reason and verdict.

    The wide form has a claims column for every month of the data and leaves out rows
    without any claim.
    """
    rows = not_null_filter(claims, "mes").select(
        month_start(F.col("mes")).alias("Mes"), blank_to_total(F.col("tienda"), blanks=("",)).alias("Tienda"),
        F.coalesce(F.trim("motivo"), F.lit("")).alias("motivo"),
        F.coalesce(F.trim("fallo"), F.lit("")).alias("fallo"),
        F.col("claims").cast("bigint").alias("claims"), F.col(value).cast("double").alias("gmv"))
    keys = ["Tienda", "motivo", "fallo"]
    sums = rows.groupBy("Mes", *keys).agg(zero_sum("claims").alias("claims"), zero_sum("gmv").alias("gmv"))
    if not wide:
        return sums
    grid = (sums.withColumn("Mes", F.date_format("Mes", "yyyy-MM-dd"))
            .groupBy(*keys).pivot("Mes").agg(F.max("claims")))
    cells = [F.coalesce(F.col(c), F.lit(0)) for c in grid.columns if c not in keys]
    return grid.filter(F.exists(F.array(*cells), lambda n: n != 0))


def _bpp_rows(bpp: DataFrame, paid_col: str, recovered_col: str) -> DataFrame:
    amount = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return not_null_filter(bpp, "mes").select(
        month_from_yyyymm(F.col("mes")).alias("Mes"), blank_to_total(F.col("CLAIM_TYPE"), OTHER, ("",)).alias("CLAIM_TYPE"),
        amount(paid_col).alias("paid"), amount(recovered_col).alias("recovered"),
        F.coalesce(F.col("casos").try_cast("double").try_cast("bigint"), F.lit(0)).alias("cases"))


def bpp_by_type(bpp: DataFrame, paid_col: str, recovered_col: str, total: str = "TOTAL") -> DataFrame:
    """Paid and recovered amounts, cases and coverage per month and type, with totals."""
    sums = [F.round(F.sum("paid"), 2).alias("paid"), F.round(F.sum("recovered"), 2).alias("recovered"),
            F.sum("cases").alias("cases")]
    rows = total_label(_bpp_rows(bpp, paid_col, recovered_col), ["Mes", "CLAIM_TYPE"], "CLAIM_TYPE", sums, total)
    return rows.withColumn("coverage", positive_ratio(F.col("recovered"), F.col("paid")))


def bpp_trend(bpp: DataFrame, paid_col: str) -> DataFrame:
    """Total paid per month."""
    return (_bpp_rows(bpp, paid_col, paid_col).groupBy("Mes").agg(F.round(F.sum("paid"), 2).alias("paid")))
