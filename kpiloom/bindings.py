"""Logical tables built from the generated star-schema tables.

Each function turns ``lineitem``, ``orders``, ``customer`` or ``events`` into one
input of the plans. None of them aggregates away or leaves out rows: filters that
the plans apply are met by codes derived from the data (unknown status, empty tags,
zero weights, unmapped stores, unreadable scores).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kpiloom.constants import MONTH_ABBR, MONTH_NAMES, PARTNERSHIP_TAG
from kpiloom.functions.dates import month_start
from kpiloom.sources import tables

#: Columns of the generated tables.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

#: Node id -> store name; node N4 is not listed, so it is unmapped.
STORES = {"N0": "North", "N1": "East", "N2": "South", "N3": "West"}
#: The second id space, of the scorecard.
STORE_IDS = {"7000": "North", "7001": "East", "7002": "South", "7003": "West"}
PICK_KEYS = ("order_id", "sku_id", "line_id")


def scan_table(spark: SparkSession, name: str, sf: str) -> DataFrame:
    return tables.scan_table(spark, name, sf, SCHEMAS[name])


def _node(key: str) -> Column:
    return F.concat(F.lit("N"), (F.col(key) % 5).cast("string"))


def _tags() -> Column:
    group = F.col("l_partkey") % 40
    kind = F.when(F.col("l_partkey") % 3 == 0, "Fresh").otherwise("dry")
    return (F.when(group == 1, F.array().cast("array<string>")).when(group == 2, F.array(F.lit("other")))
            .when(group > 2, F.array(F.lit(PARTNERSHIP_TAG), kind)))


def _supermarket() -> Column:
    both = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F")
    return F.when(~both, True).when(F.col("l_quantity") > 25, False)


def _status() -> Column:
    return (F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"), "invalid")
            .when((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "2-HIGH"), F.lit(None))
            .when(F.col("o_orderstatus") == "F", "cancelled")
            .when(F.col("o_orderstatus") == "P", "partially_refunded").otherwise("paid"))


def _lines_of_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Two facts that grow together: a sort-merge join, which AQE can split by key."""
    orders = scan_table(spark, "orders", sf).hint("merge")
    return scan_table(spark, "lineitem", sf).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order line, the item as a struct."""
    ym = F.year("o_orderdate") * 100 + F.month("o_orderdate")
    return _lines_of_orders(spark, sf).select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku_id"),
        F.col("l_linenumber").alias("line_id"),
        (F.col("o_custkey") * 1000000 + ym).alias("purchase_id"), F.col("o_custkey").alias("buyer_id"),
        _status().alias("status"), F.col("o_orderdate").alias("closed_at"),
        F.when(F.col("o_orderpriority") == "5-LOW", "S2").otherwise("S1").alias("site"),
        F.when(F.col("l_quantity") == 50, "XX").otherwise("TM").alias("marketplace_id"),
        F.when(F.col("l_discount") < 0.005, False).when(F.col("l_discount") < 0.095, True).alias("gmv_flag"),
        F.when(F.col("l_tax") > 0.075, True).when(F.col("l_tax") > 0.005, False).alias("auto_offer_flag"),
        F.col("l_tax").alias("fx_ratio"),
        F.struct(_node("l_suppkey").alias("node_id"),
                 (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
                 _supermarket().alias("supermarket_flag")).alias("item"),
        _tags().alias("tags"))


def picks(spark: SparkSession, sf: str) -> DataFrame:
    """Pick details, one row per order line."""
    picked = (F.when(F.col("l_returnflag") == "R", F.col("l_quantity") * 1.1)
              .when(F.col("l_discount") <= 0.085, F.col("l_quantity") * (1 - F.col("l_discount"))))
    return scan_table(spark, "lineitem", sf).select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku_id"),
        F.col("l_linenumber").alias("line_id"), F.col("l_quantity").alias("requested_qty"),
        F.when(F.col("l_returnflag") == "A", "unit").when(F.col("l_returnflag") == "R", "kg").alias("measure"),
        picked.alias("picked_qty"), F.when(F.col("l_partkey") % 997 == 1, 1e-7).otherwise((F.col("l_partkey") % 25).cast("double")).alias("net_weight"))


def nested_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Order records with nested items: no item, one, or two in different stores."""
    item = lambda supplier: F.struct(
        F.concat(F.lit("N"), (supplier % 5).cast("string")).alias("node_id"),
        _supermarket().alias("supermarket_flag"), _tags().alias("tags"))
    both = F.array(item(F.col("l_suppkey")), item(F.col("l_suppkey") + 1))
    n_items = F.when(F.col("l_quantity") == 1, 0).when(F.col("l_returnflag") == "R", 2).otherwise(1)
    items = F.slice(both, F.lit(1), n_items)
    price = F.col("l_extendedprice")
    return _lines_of_orders(spark, sf).select(
        F.col("l_orderkey").alias("order_id"), F.col("o_custkey").alias("buyer_id"), _status().alias("status"),
        F.col("o_orderdate").alias("created_at"), price.alias("gross_value_usd"),
        F.floor(price * (1 - F.col("l_discount"))).cast("double").alias("net_value_usd"),
        F.floor(price * F.col("l_tax")).cast("double").alias("delivery_fee_usd"),
        F.col("l_quantity").alias("service_fee_usd"), items.alias("items"))


def _event_model() -> Column:
    k = F.get_json_object("props", "$.k").cast("int")
    return F.when(k < 95, "INSTORE").otherwise("ONLINE")


def traffic(spark: SparkSession, sf: str) -> DataFrame:
    """Traffic rows with nested page events."""
    named = lambda *names: F.array(*[F.struct(F.lit(n).alias("name")) for n in names])
    pages = (F.when(F.col("event_type") == "view", named("ITEM_PAGE", "HOME_INSTORE"))
             .when(F.col("event_type") == "click", named("ADD_TO_CART", "FOOTER"))
             .when(F.col("event_type") == "signup", named("SIGNUP"))
             .when(F.col("event_type") == "error", F.slice(named("FOOTER"), 1, 0)))
    return scan_table(spark, "events", sf).select(
        F.to_date("ts").alias("day"), "user_id", _event_model().alias("model"), F.lit("S1").alias("site"),
        pages.alias("page_events"))


def buyer_orders(spark: SparkSession, sf: str) -> DataFrame:
    return scan_table(spark, "events", sf).filter(F.col("event_type") == "purchase").select(
        F.to_date("ts").alias("day"), F.col("user_id").alias("buyer_id"), _event_model().alias("model"),
        F.lit("S1").alias("site"))


def event_visits(spark: SparkSession, sf: str) -> DataFrame:
    """A visit row per event, by day and store."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return scan_table(spark, "events", sf).select(
        F.to_date("ts").alias("day"), _node("user_id").alias("node_id"), F.lit(1).cast("bigint").alias("sessions"),
        (k % 3).alias("visitors"), k.alias("visits"), _event_model().alias("model"), F.lit("S1").alias("site"))


def order_visits(spark: SparkSession, sf: str) -> DataFrame:
    """Visits over the dates of the orders, for marts that join both."""
    return scan_table(spark, "orders", sf).select(
        F.to_date("o_orderdate").alias("day"), _node("o_orderkey").alias("node_id"),
        F.lit(1).cast("bigint").alias("sessions"), F.lit(1).cast("bigint").alias("visitors"),
        (F.lit(1) + F.col("o_orderkey") % 7).alias("visits"))


def order_traffic(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer with an order is a visitor of that day."""
    return scan_table(spark, "orders", sf).select(
        F.to_date("o_orderdate").alias("day"), F.col("o_custkey").alias("user_id"),
        F.array(F.struct(F.lit("ITEM_PAGE").alias("name"))).alias("page_events"))


def order_buyers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers of open orders are the buyers."""
    return scan_table(spark, "orders", sf).filter(F.col("o_orderstatus") == "O").select(
        F.to_date("o_orderdate").alias("day"), F.col("o_custkey").alias("buyer_id"))


def store_sales(spark: SparkSession, sf: str) -> DataFrame:
    return scan_table(spark, "orders", sf).select(
        F.to_date("o_orderdate").alias("day"), _node("o_orderkey").alias("store"), F.col("o_custkey").alias("buyer_id"))


def scorecard(spark: SparkSession, sf: str) -> DataFrame:
    """Numerators and denominators of the ops rates, and the ready-made columns."""
    line = scan_table(spark, "lineitem", sf)
    flag = lambda cond: F.when(cond, 1).otherwise(0).cast("bigint")
    cancelled = F.col("l_discount") > 0.085
    kind = F.col("l_partkey") % 3
    delay = F.col("l_linenumber") - 4
    return line.select(
        F.to_date("l_shipdate").alias("day"), (F.lit(7000) + F.col("l_suppkey") % 5).alias("store_id"),
        _node("l_suppkey").alias("node_id"), F.when(F.col("l_linenumber") == 7, "S2").otherwise("S1").alias("site"),
        F.col("l_quantity").alias("fi_requested"),
        F.floor(F.col("l_quantity") * (1 - F.col("l_discount"))).cast("double").alias("fi_picked"),
        F.floor(F.col("l_quantity") * (1 - F.col("l_discount") / 2)).cast("double").alias("fi_picked_replaced"),
        flag(F.col("l_discount") < 0.035).alias("fc_complete"),
        flag(F.col("l_discount") < 0.055).alias("fc_complete_replaced"),
        F.lit(1).cast("bigint").alias("fc_purchases"),
        flag(F.col("l_linestatus") == "O").alias("ot_packs"),
        flag((F.col("l_linestatus") == "O") & (F.col("l_returnflag") != "R")).alias("ot_on_time"),
        F.lit(1).cast("bigint").alias("cr_purchases"), flag(cancelled).alias("cr_cancels"),
        flag(cancelled & (kind == 0)).alias("cr_buyer_cancels"),
        flag(cancelled & (kind == 1)).alias("cr_stockout_cancels"),
        flag(cancelled & (kind == 2)).alias("cr_seller_cancels"),
        F.when(F.col("l_tax") > 0.005, F.col("l_discount")).alias("cancel_rate"),
        F.when(F.col("l_tax") > 0.005, F.col("l_quantity")).alias("cancels_total"),
        F.when(kind == 0, F.col("l_quantity")).alias("cancels_seller"),
        F.when(kind == 1, F.col("l_quantity")).alias("cancels_buyer"),
        F.when(kind == 2, F.col("l_quantity")).alias("cancels_stockout"),
        (1 - F.col("l_discount")).alias("fill_rate"), F.col("l_tax").alias("ot_rate"),
        F.when(delay < 0, F.col("l_tax")).alias("ot_early_pct"), F.when(delay > 0, F.col("l_tax")).alias("ot_delay_pct"),
        F.when(delay == 0, F.col("l_tax")).alias("ot_ontime_pct"),
        F.when(F.col("l_returnflag") != "R", F.col("l_discount")).alias("perfect_purchase_rate"),
        F.when(F.col("l_returnflag") != "N", F.col("l_quantity")).alias("total_orders"))


def cancels(spark: SparkSession, sf: str) -> DataFrame:
    reason = F.element_at(F.array(*[F.lit(r) for r in ("seller", "Buyer", "STOCKOUT")]),
                          (F.col("l_partkey") % 3 + 1).cast("int"))
    return scan_table(spark, "lineitem", sf).select(
        F.col("l_shipdate").alias("day"), _node("l_suppkey").alias("node_id"), reason.alias("reason_type"))


def ontime_packs(spark: SparkSession, sf: str) -> DataFrame:
    status = (F.when(F.col("l_linenumber") < 3, "early").when(F.col("l_linenumber") < 6, "On_Time")
              .otherwise("delay"))
    return scan_table(spark, "lineitem", sf).select(
        F.col("l_shipdate").alias("day"), _node("l_suppkey").alias("node_id"), status.alias("status"),
        F.col("l_orderkey").alias("pack_id"))


def perfect_orders(spark: SparkSession, sf: str) -> DataFrame:
    return scan_table(spark, "lineitem", sf).select(
        F.col("l_shipdate").alias("day"), _node("l_suppkey").alias("node_id"),
        F.col("l_orderkey").alias("order_id"),
        F.when(F.col("l_tax") > 0.005, F.col("l_discount") < 0.035).alias("perfect_flag"))


def fill_items(spark: SparkSession, sf: str) -> DataFrame:
    return scorecard(spark, sf).select("day", "node_id", F.col("fi_requested").alias("ordered"),
                                       F.col("fi_picked").alias("picked"))


def survey(spark: SparkSession, sf: str) -> DataFrame:
    """A survey response per order, scores as text with fractions and junk."""
    # exploded, so that a filter on the score finds the cents made and does not round them again for each of its uses
    rounded = F.explode(F.array(F.round(F.col("o_totalprice") * 100).cast("bigint")))
    cents = F.col("cents")
    score = (F.when(cents % 13 == 0, "6.5").when(cents % 17 == 0, F.lit(None)).when(cents % 19 == 0, "n/a")
             .when(cents % 23 == 0, "NaN").when(cents % 29 == 0, "1e12")
             .otherwise((cents % 11).cast("string")))
    return scan_table(spark, "orders", sf).select("o_orderkey", "o_orderdate", "o_orderpriority", rounded.alias("cents")).select(
        F.col("o_orderkey").cast("string").alias("order_id"), score.alias("score"),
        F.col("o_orderdate").alias("end_date"), F.concat(F.lit("SHOP_"), "o_orderpriority").alias("code"),
        F.concat(F.lit('[{"site":"'), F.substring("o_orderpriority", 1, 1), F.lit('"}]')).alias("questions"))


def claims(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.element_at(F.array(*[F.lit(r) for r in ("incomplete", "different", "defective", "repentance")]),
                        (F.col("l_partkey") % 4 + 1).cast("int"))
    result = F.when(F.col("l_tax") > 0.035, "buyer").when(F.col("l_tax") > 0.005, "seller")
    return scan_table(spark, "lineitem", sf).filter(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_shipdate").alias("created_at"), kind.alias("claim_type"),
        result.alias("claim_result"), (F.lit(100) + F.col("l_suppkey") % 2).alias("respondent_id"))


def _claim_type() -> Column:
    return F.element_at(F.array(*[F.lit(r) for r in ("pdd", "Pnr", "LOWCOST", " ")]),
                        (F.col("l_partkey") % 4 + 1).cast("int"))


def bpp(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return scan_table(spark, "lineitem", sf).filter(F.col("l_returnflag") == "R").select(
        F.col("l_shipdate").alias("day"), _claim_type().alias("claim_type"),
        F.floor(price * F.col("l_discount")).cast("double").alias("total_usd"),
        F.floor(price * F.col("l_tax")).cast("double").alias("recovery_usd"))


def bpp_monthly(spark: SparkSession, sf: str) -> DataFrame:
    """Month file rows of protection cases (month as ``yyyymm``)."""
    month = F.year("l_shipdate") * 100 + F.month("l_shipdate")
    price = F.col("l_extendedprice")
    return scan_table(spark, "lineitem", sf).filter(F.col("l_returnflag") == "R").select(
        month.alias("mes"), _claim_type().alias("CLAIM_TYPE"),
        F.floor(price * F.col("l_discount")).alias("paid_lc"), F.floor(price * F.col("l_tax")).alias("recovered_lc"),
        F.when(F.col("l_linenumber") > 1, 1).alias("casos"))


def claims_monthly(spark: SparkSession, sf: str) -> DataFrame:
    store = F.when(F.col("l_suppkey") % 5 == 4, " ").otherwise(_node("l_suppkey"))
    reason = F.element_at(F.array(*[F.lit(r) for r in ("incomplete ", "different", "defective")]),
                          (F.col("l_partkey") % 3 + 1).cast("int"))
    return scan_table(spark, "lineitem", sf).filter(F.col("l_returnflag") == "R").select(
        F.to_date("l_shipdate").alias("mes"), store.alias("tienda"), reason.alias("motivo"),
        F.when(F.col("l_tax") > 0.035, "buyer").when(F.col("l_tax") > 0.005, "seller").alias("fallo"),
        F.when(F.col("l_linenumber") > 1, F.lit(1)).alias("claims"),
        F.floor("l_extendedprice").cast("double").alias("gmv_reclamado"))


def pl_monthly(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly P&L lines by order month; in a January the NMV is 0."""
    price, off = F.col("l_extendedprice"), F.col("l_discount")
    whole = lambda c: F.sum(F.floor(c)).cast("bigint")
    # an order's month is computed once, not for each of its lines
    months = scan_table(spark, "orders", sf).select(
        "o_orderkey", (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("Mes")).hint("merge")
    return scan_table(spark, "lineitem", sf).join(months, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("Mes").agg(
        whole(price).alias("TGMV"),
        F.sum(F.when(F.col("Mes") % 100 == 1, 0).otherwise(F.floor(price * (1 - off)))).cast("bigint").alias("NMV"),
        whole(price * F.col("l_tax")).alias("Net_Variable_Fee"), whole(price * 0.09).alias("Net_Monetization"),
        whole(price * 0.07).alias("Product_Net_Monetization"),
        (whole(price * 0.02) - whole(price * off / 4)).alias("Variable_Contribution"),
        (whole(price * 0.01) - whole(price * off / 4)).alias("Direct_Contribution"),
        (-whole(price * 0.05)).alias("Shipping_Cost"), (-whole(price * off)).alias("Promotions"),
        (-whole(price * off / 2)).alias("Coupons"))


def cx_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Lines by month and store, all and those of each kind: what both customer-experience files count."""
    n = lambda cond, name: F.count_if(cond).alias(name)
    claimed = F.col("l_returnflag") == "R"
    return scan_table(spark, "lineitem", sf).groupBy(
        month_start(F.col("l_shipdate")).alias("Mes"), _node("l_suppkey").alias("Tienda")).agg(
        F.count("*").alias("all"), n(F.col("l_discount") < 0.035, "perfect"), n(claimed, "claims"),
        *[n(claimed & (F.col("l_partkey") % 5 == k), f"claims_{k}") for k in range(4)],
        n(F.col("l_linestatus") == "O", "on_time"), n(F.col("l_discount") > 0.085, "cancelled"))


def _cx(counts: DataFrame, *keys: str) -> DataFrame:
    n = F.sum
    perfect, all_ = n("perfect").cast("double"), n("all").cast("double")
    rate = lambda a, b: F.round(F.try_divide(a.cast("double"), b.cast("double")), 4)
    return counts.groupBy("Mes", *keys).agg(
        perfect.alias("Perfect_Purchases"), all_.alias("Total_Purchases"),
        rate(perfect, all_).alias("Perfect_Purchase_Rate"), n("claims").alias("Total_Claims"),
        n("claims_0").alias("Repentance_Claims"), n("claims_1").alias("Incomplete_Claims"), n("claims_2").alias("Different_Claims"),
        n("claims_3").alias("Defective_Claims"), rate(n("claims"), all_).alias("Claims_Rate"),
        rate(n("on_time"), all_).alias("On_Time"), rate(n("cancelled"), all_).alias("Cancel_Rate"))


def cx_month(spark: SparkSession, sf: str, counts: DataFrame | None = None) -> DataFrame:
    """Customer-experience file by month, counted from the lines or from stored ``cx_counts``."""
    return _cx(counts if counts is not None else cx_counts(spark, sf))


def cx_store(spark: SparkSession, sf: str, counts: DataFrame | None = None) -> DataFrame:
    """The same by month and store."""
    return _cx(counts if counts is not None else cx_counts(spark, sf), "Tienda")


def plan(spark: SparkSession, sf: str) -> DataFrame:
    """Daily plan: revenue of the same day one year earlier, times 1.1 and 0.9."""
    base = (scan_table(spark, "orders", sf)
            .groupBy(F.add_months(F.to_date("o_orderdate"), 12).alias("Fecha"))
            .agg(F.sum(F.floor("o_totalprice")).alias("v"), F.count("*").alias("n")))
    return base.select(
        "Fecha", F.round(F.col("v") * 1.1, 0).alias("NMV_V2"), (F.col("n") * 10).cast("double").alias("NSI_V2"),
        F.round(F.col("v") * 0.9, 0).alias("NMV_4+8"), (F.col("n") * 9).cast("double").alias("NSI_4+8"),
        F.when(F.col("n") > 3, F.col("n").cast("double")).alias("Purchases_4+8"))


def demographics(spark: SparkSession, sf: str) -> DataFrame:
    """Active buyers by month, store, segment, age range and gender.

    Orders are counted per customer and month before meeting the customers, so a
    customer with very many orders joins as a few rows.
    """
    active = scan_table(spark, "orders", sf).groupBy(
        "o_custkey", month_start(F.col("o_orderdate")).alias("Mes")).agg(F.count("*").alias("MABs"))
    who = scan_table(spark, "customer", sf)
    low = (F.floor(F.col("c_acctbal") / 150) * 5).cast("bigint")
    age = (F.when(low < 10, "sin dato").when(low > 64, "70 y más")
           .otherwise(F.concat(low.cast("string"), F.lit(" - "), (low + 4).cast("string"))))
    segment = (F.when(F.col("c_mktsegment") == "BUILDING", "BRONZE").when(F.col("c_mktsegment") == "FURNITURE", "SILVER")
               .when(F.col("c_mktsegment") == "HOUSEHOLD", "GOLD").when(F.col("c_mktsegment") == "MACHINERY", "PLATINUM")
               .otherwise("NA"))
    gender = F.when(F.col("c_nationkey") % 3 == 0, "female").when(F.col("c_nationkey") % 3 == 1, "male").otherwise("unknown")
    return active.join(who, F.col("o_custkey") == F.col("c_custkey")).select(
        "Mes", _node("c_custkey").alias("TIENDA"), segment.alias("Segmento"), age.alias("Rango_edad"),
        gender.alias("Genero"), "MABs")


def buyers_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return (scan_table(spark, "orders", sf).groupBy(month_start(F.col("o_orderdate")).alias("Mes"))
            .agg(F.countDistinct("o_custkey").alias("Total_Buyers")))


def comma_number(c: Column, digits: int = 0) -> Column:
    """``1.234,5`` text of a number."""
    return F.translate(F.format_number(c, digits), ",.", ".,")


def plan_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """Plan sheets of all years (column ``sheet``), in the fixed layout.

    Only three header rows and the daily rows carry data; daily rows are numbered by
    day of the year, with a subtotal row after each.
    """
    daily = plan(spark, sf).withColumn("sheet", F.year("Fecha"))
    blank = F.lit(None).cast("string")

    def cells(values: dict[int, Column]) -> Column:
        return F.array(*[values.get(i, blank) for i in range(50)])

    monthly = daily.groupBy("sheet").agg(*[
        F.sum(F.when(F.month("Fecha") == m, F.col(f"`{p}`"))).alias(f"{k}_{m}")
        for k, p in (("v2", "NMV_V2"), ("f48", "NMV_4+8")) for m in range(1, 13)])
    head = {m: F.concat(F.lit(f"{MONTH_ABBR[m - 1].lower()}-"), F.substring(F.col("sheet").cast("string"), 3, 2))
            for m in range(1, 13)}
    row = lambda no, values: F.struct(F.lit(no).cast("bigint").alias("row_no"), cells(values).alias("cells"))
    top = monthly.select("sheet", F.explode(F.array(
        row(0, head | {13: F.lit("FY")}),
        row(4, {0: F.lit("NMV")} | {m: comma_number(F.col(f"v2_{m}")) for m in range(1, 13)}),
        row(6, {0: F.lit("4+8")} | {m: comma_number(F.col(f"f48_{m}")) for m in range(1, 13)}),
        row(22, {0: F.lit("Dia")}))).alias("r")).select("sheet", "r.*")
    weekdays = F.array(*[F.lit(d) for d in ("Domingo", "lunes", "martes", "miércoles", "jueves", "viernes", "Sábado")])
    line = {0: F.element_at(weekdays, F.dayofweek("Fecha")), 1: F.month("Fecha").cast("string"),
            2: F.concat(F.dayofmonth("Fecha").cast("string"), F.lit("-"),
                        F.lower(F.element_at(F.array(*[F.lit(m) for m in MONTH_ABBR]), F.month("Fecha")))),
            12: comma_number(F.col("NMV_V2"), 1), 13: comma_number(F.col("NSI_V2")),
            47: comma_number(F.col("`NMV_4+8`"), 1), 48: comma_number(F.col("`NSI_4+8`")),
            49: comma_number(F.col("`Purchases_4+8`"))}
    at = F.lit(22) + F.dayofyear("Fecha") * 2
    struct = lambda no, values: F.struct(no.cast("bigint").alias("row_no"), cells(values).alias("cells"))
    body = daily.select("sheet", F.explode(F.array(
        struct(at, line), struct(at + 1, {0: F.lit("Total"), 12: line[12]}))).alias("r")).select("sheet", "r.*")
    return top.unionByName(body)


def assortment_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Availability, depth (percent, one decimal) and gap by year, store, month."""
    n = F.count("*")
    tenth = lambda c: F.floor(c * 1000 / n)
    return (scan_table(spark, "lineitem", sf)
            .groupBy(F.year("l_shipdate").alias("sheet"), (F.col("l_suppkey") % 4).alias("s"),
                     F.month("l_shipdate").alias("m"))
            .agg(tenth(F.count_if(F.col("l_discount") < 0.075)).alias("disp"),
                 tenth(F.count_if(F.col("l_quantity") < 31)).alias("prof"),
                 tenth(F.count_if(F.col("l_linenumber") == 1)).alias("gap")))


def assortment_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """Assortment sheets of all years: a block of six rows per store."""
    names = F.array(*[F.lit(n) for n in ("North", "East side", "SOUTH", "West")])
    text = lambda c, unit: F.concat((c / 10).cast("bigint").cast("string"), F.lit(","), (c % 10).cast("string"), F.lit(unit))
    wide = assortment_rates(spark, sf).groupBy("sheet", "s").agg(*[
        F.max(F.when(F.col("m") == m, text(F.col(k), unit))).alias(f"{k}_{m}")
        for k, unit in (("disp", "%"), ("prof", "%"), ("gap", "")) for m in range(1, 13)])
    months = [F.lit(m.capitalize()) for m in MONTH_NAMES]
    blank = F.lit(None).cast("string")
    metric = lambda title, k: F.array(F.lit(title), *[F.col(f"{k}_{m}") for m in range(1, 13)], blank)
    rows = F.array(
        F.array(blank, F.element_at(names, (F.col("s") + 1).cast("int")), *[blank] * 12),
        F.array(blank, *months, F.lit("Tendencia")), metric("Disponibilidad", "disp"),
        metric("Profundidad", "prof"), metric("Gap (p.p.)", "gap"), F.array(*[blank] * 14))
    return (wide.select("sheet", "s", F.posexplode(rows).alias("i", "cells"))
            .select("sheet", (F.col("s") * 6 + F.col("i")).cast("bigint").alias("row_no"), "cells"))
