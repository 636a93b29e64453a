"""Sales growth from order lines.

Input columns
  order lines    order_id, purchase_id, buyer_id, status, closed_at, site,
                 marketplace_id, gmv_flag, auto_offer_flag, fx_ratio,
                 item struct<node_id, unit_price, supermarket_flag>, tags
  picks          the join keys, requested_qty, measure, picked_qty, net_weight
  nested orders  order_id, buyer_id, status, created_at, amounts,
                 items array<struct<node_id, supermarket_flag, tags>>
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from kpiloom.constants import CANCELLED, FRESH_TAG, LOOKBACK_DAYS, PARTNERSHIP_TAG
from kpiloom.functions.dates import day, to_period
from kpiloom.functions.masks import WEEK_SLOTS, held, mask_names, row_masks
from kpiloom.functions.numbers import safe_ratio
from kpiloom.functions.retail import line_value, qty_cap, qty_normalise, refund_value, store_label, store_names, store_number
from kpiloom.operators.aggregates import zero_sum
from kpiloom.operators.filters import (
    DateLike, equality_filter, flag_filter, has_tag, lookback_filter, start_date_filter,
    status_filter, store_filter, tag_filter, unnest_items)
from kpiloom.operators.joins import join_picks
from kpiloom.operators.periods import rolling_anchor

Stores = Mapping[str, str]

#: Pieces are summed in fixed point, so that totals do not depend on row order.
PIECES = "decimal(28,9)"


def scoped_lines(order_lines: DataFrame, start: DateLike | None = None, site: str | None = None,
                 marketplace: str | None = None, tag: str = PARTNERSHIP_TAG,
                 excluded: Iterable[str] = (CANCELLED,)) -> DataFrame:
    """Order lines of the partnership: the filters shared by all growth queries."""
    lines = order_lines
    if site is not None:
        lines = equality_filter(lines, site=site)
    if marketplace is not None:
        lines = equality_filter(lines, marketplace_id=marketplace)
    lines = flag_filter(lines, "gmv_flag")
    lines = flag_filter(lines, "auto_offer_flag", want=False)
    lines = flag_filter(lines, "item.supermarket_flag")
    lines = tag_filter(lines, "tags", tag)
    lines = start_date_filter(lines, "closed_at", start)
    excluded = list(excluded)
    return status_filter(lines, "status", excluded) if excluded else lines


def sales_anchor(order_lines: DataFrame, as_of: DateLike, start: DateLike | None = None, **scope) -> DataFrame:
    """One row ``anchor``: the last day with sales before ``as_of``, from a narrow pass over the lines.

    Give it and ``within_days`` the facts of a rolling or daily mart, and only its window is read.
    """
    days = scoped_lines(order_lines, start, **scope).select("closed_at")
    return rolling_anchor(days.agg(day(F.max("closed_at")).alias("last")), "last", as_of)


def pick_quantities(picks: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Requested (TSIE) and picked pieces per pick row."""
    pieces = lambda q: qty_normalise(F.col(q), F.col("measure"), F.col("net_weight"))
    return picks.select(*keys, pieces("requested_qty").alias("TSIE"), pieces("picked_qty").alias("TSI_PICKED"))


def valued_lines(order_lines: DataFrame, picks: DataFrame, start: DateLike | None = None,
                 pick_keys: Iterable[str] = ("order_id", "line_id"), line_key: Iterable[str] = (), **scope) -> DataFrame:
    """Scoped order lines with requested and picked pieces and their values.

    The one join of large tables behind all growth results: store this table once
    (``session.materialise``, by day) when more than one of them is wanted, and give it to
    ``growth_of_lines``.

    ``pick_keys`` must name the columns that tell an order's lines apart: by the order id
    alone every line would pair up with every pick of its order. ``growth`` has a form of
    its own for data without such columns.
    """
    pick_keys = list(pick_keys)
    if pick_keys == ["order_id"]:
        raise ValueError("name the line columns in pick_keys, or use growth(pick_keys=('order_id',))")
    keys = ["day", "node_id", "purchase_id", "order_id", "status", "fx_ratio", *line_key]
    extra = [k for k in dict.fromkeys([*pick_keys, *line_key]) if k != "order_id"]
    head = scoped_lines(order_lines, start, **scope).select(
        day(F.col("closed_at")).alias("day"), F.col("item.node_id").alias("node_id"), "purchase_id", "order_id", "status",
        F.coalesce("fx_ratio", F.lit(0.0)).alias("fx_ratio"), F.col("item.unit_price").alias("unit_price"), *extra)
    pieces = pick_quantities(picks, pick_keys)
    tsie, picked = (F.col(c).cast(PIECES) for c in ("TSIE", "TSI_PICKED"))
    value = lambda qty: line_value(F.col("unit_price"), F.col(qty))
    return (join_picks(head, pieces, pick_keys)
            .select(*keys, "unit_price", tsie.alias("TSIE"), qty_cap(picked, tsie).alias("TSI"))
            .select(*keys, "TSIE", "TSI", value("TSIE").alias("full_value"), value("TSI").alias("picked_value")))


def growth_of_lines(lines: DataFrame, grain: str, stores: Stores | None = None, only_stores: bool = False,
                    name: str = "Fecha") -> DataFrame:
    """Purchases, orders and net value per period, and per store if ``stores`` is given.

    ``only_stores`` drops other stores' lines first. Lines are distinct within their
    period: two equal lines of an order count once unless a line key tells them apart.
    They are then reduced to one row per (period, store, purchase, order) before the
    two distinct counts, so those expand orders rather than lines; every shuffle key
    includes the order id.
    """
    orders = orders_of_lines(lines, grain, stores, only_stores)
    return _of_orders(orders, ["period"] if stores is None else ["period", "Tienda"], name)


def orders_of_lines(lines: DataFrame, grain: str, stores: Stores | None = None, only_stores: bool = False) -> DataFrame:
    """One row per period (and store), purchase and order with its sums: what ``growth_of_lines`` counts."""
    if only_stores:
        lines = store_filter(lines, "node_id", stores)
    period = to_period(F.col("day"), grain).alias("period")
    rest = [c for c in lines.columns if c not in ("day", "node_id")]
    if stores is None:
        by, sold = ["period"], lines.select(period, *rest)
    else:
        by = ["period", "Tienda"]
        sold = (lines.select(period, store_label(F.col("node_id"), stores).alias("Tienda"), *rest)
                .filter(F.col("Tienda").isNotNull()))
    fx = F.nullif(F.col("fx_ratio"), F.lit(0.0))
    return sold.distinct().groupBy(*by, "purchase_id", "order_id").agg(
        F.sum(refund_value(F.col("status"), F.col("full_value"), F.col("picked_value"))).alias("nmv"),
        F.sum(fx).alias("fx_sum"), F.count(fx).alias("fx_n"),
        F.sum(F.coalesce("TSI", "TSIE")).alias("nsi"), F.sum("TSIE").alias("tsie"))


def growth_of_orders(orders: DataFrame, grain: str, name: str = "Fecha") -> DataFrame:
    """Growth from daily order sums (``orders_of_lines`` by day, with the period as ``day``).

    Per store if they have a store. Equal to ``growth_of_lines`` as long as an order's equal
    lines lie on one day.
    """
    by = ["period", *(["Tienda"] if "Tienda" in orders.columns else [])]
    sums = [F.sum(c).alias(c) for c in ("nmv", "fx_sum", "fx_n", "nsi", "tsie")]
    periods = orders.withColumn("period", to_period(F.col("day"), grain))
    return _of_orders(periods.groupBy(*by, "purchase_id", "order_id").agg(*sums), by, name)


def _of_orders(orders: DataFrame, by: list[str], name: str) -> DataFrame:
    """Period results from one row per period, store, purchase and order."""
    counts = [F.countDistinct("purchase_id").alias("Compras"), F.countDistinct("order_id").alias("Ordenes")]
    return orders.groupBy(*by).agg(*counts, *_amounts()).withColumnRenamed("period", name)


def _amounts() -> list[Column]:
    mean_fx = safe_ratio(F.sum("fx_sum"), F.sum("fx_n"))
    return [F.round(F.sum("nmv"), 0).alias("NMV"),
            F.round(F.sum("nmv") * mean_fx, 0).alias("NMV_USD"),
            F.round(F.sum("nsi"), 0).cast("double").alias("NSI"),
            F.round(F.sum("tsie"), 0).cast("bigint").alias("TSIE_total")]


def lines_by_week(lines: DataFrame, stores: Stores) -> DataFrame:
    """The different lines of each week, once, with the days and listed stores they lie in as bits of ``mask_<n>``.

    What ``growth_of_lines`` makes distinct, for days, weeks and both by store at once. Deal ``lines``
    by order id first: then neither this nor the counts of orders shuffle.
    """
    members = len(store_names(stores)) + 1
    rest = [c for c in lines.columns if c not in ("day", "node_id")]
    placed = lines.select(to_period(F.col("day"), "week").alias("week"), *rest, store_number(F.col("node_id"), stores).alias("__store"),
                          F.coalesce(F.dayofweek("day") - 1, F.lit(WEEK_SLOTS - 1)).alias("__slot"))
    masks = lambda member: row_masks(member, members, F.col("__slot"), WEEK_SLOTS)
    named = mask_names(members, WEEK_SLOTS)
    # every line lies in the total, number 0
    different = placed.groupBy("week", *rest).agg(*[
        F.bit_or(a.bitwiseOR(t)).alias(n) for n, a, t in zip(named, masks(F.col("__store")), masks(F.lit(0)))])
    return different.select(
        "week", *named, "purchase_id", "order_id",
        refund_value(F.col("status"), F.col("full_value"), F.col("picked_value")).alias("nmv"),
        F.nullif(F.col("fx_ratio"), F.lit(0.0)).alias("fx"), F.coalesce("TSI", "TSIE").alias("nsi"), F.col("TSIE").alias("tsie"))


def growth_tallies(week_lines: DataFrame) -> DataFrame:
    """Sums, purchases and orders of ``lines_by_week`` by week and by the days and stores they lie in.

    A purchase of several lines is one that lies in all their days and stores. Few rows: store them once for all results.
    """
    masks = [c for c in week_lines.columns if c.startswith("mask_")]
    sums = week_lines.groupBy("week", *masks).agg(
        F.sum("nmv").alias("nmv"), F.sum("fx").alias("fx_sum"), F.count("fx").alias("fx_n"),
        F.sum("nsi").alias("nsi"), F.sum("tsie").alias("tsie"))

    def known(key: str, name: str) -> DataFrame:
        ids = week_lines.filter(F.col(key).isNotNull()).groupBy("week", key).agg(*[F.bit_or(m).alias(m) for m in masks])
        return ids.groupBy("week", *masks).agg(F.count("*").alias(name))

    return (sums.unionByName(known("purchase_id", "Compras"), allowMissingColumns=True)
            .unionByName(known("order_id", "Ordenes"), allowMissingColumns=True))


def growth_of_tallies(tallies: DataFrame, grain: str, stores: Stores, by_store: bool = False, name: str = "Fecha") -> DataFrame:
    """``growth_of_lines`` for days or weeks, in total or by the stores that ``lines_by_week`` was given."""
    if grain not in ("day", "week"):
        raise ValueError(f"no tallies by {grain}")
    masks = [c for c in tallies.columns if c.startswith("mask_")]
    members = list(enumerate(store_names(stores), 1)) if by_store else [(0, None)]
    slots = [[s] for s in range(WEEK_SLOTS)] if grain == "day" else [range(WEEK_SLOTS)]
    cells = held(masks, [(k, taken, label) for k, label in members for taken in slots], WEEK_SLOTS)
    met = (tallies.withColumn("cell", F.explode(cells))
           .withColumns({"period": F.date_add("week", F.col("cell.slot")), "Tienda": F.col("cell.name")}))
    n = lambda c: zero_sum(c).alias(c)
    return (met.groupBy("period", *(["Tienda"] if by_store else [])).agg(n("Compras"), n("Ordenes"), *_amounts())
            .withColumnRenamed("period", name))


def growth_by_order(order_lines: DataFrame, picks: DataFrame, grain: str, start: DateLike | None = None,
                    stores: Stores | None = None, only_stores: bool = False, name: str = "Fecha", **scope) -> DataFrame:
    """Growth where lines and picks share only the order id.

    Every different price of an order counts with every different pair of requested
    and picked pieces, and equal products once. No such pair is built: prices and pieces
    are each reduced to counts and sums per order, and those are multiplied. Only pieces
    other than 0 tell prices apart; of the rest, products are equal for all known prices.
    """
    lines = scoped_lines(order_lines, start, **scope)
    if only_stores:
        lines = store_filter(lines, "item.node_id", stores)
    period = to_period(F.col("closed_at"), grain).alias("period")
    by = ["period"] if stores is None else ["period", "Tienda"]
    label = [] if stores is None else [store_label(F.col("item.node_id"), stores).alias("Tienda")]
    sold = lines.select(period, *label, "purchase_id", "order_id", "status",
                        F.coalesce("fx_ratio", F.lit(0.0)).alias("fx_ratio"), F.col("item.unit_price").alias("unit_price"))
    if stores is not None:
        sold = sold.filter(F.col("Tienda").isNotNull())
    keys = [*by, "purchase_id", "order_id", "status", "fx_ratio"]
    prices = sold.distinct().groupBy(*keys).agg(
        F.count("unit_price").alias("known"), F.count_if(F.col("unit_price").isNull()).alias("unknown"),
        F.sum("unit_price").alias("price_sum"))

    tsie, picked = (F.col(c).cast(PIECES) for c in ("TSIE", "TSI_PICKED"))
    pieces = pick_quantities(picks, ["order_id"]).select(
        "order_id", tsie.alias("TSIE"), qty_cap(picked, tsie).alias("TSI")).distinct()
    some = F.coalesce(F.col("TSIE") != 0, F.lit(False)) | F.coalesce(F.col("TSI") != 0, F.lit(False))
    none = F.col("TSIE").isNull() & F.col("TSI").isNull()
    counts = pieces.groupBy("order_id").agg(
        F.count_if(some).alias("n_some"), F.count_if(~some & ~none).alias("n_zero"), F.count_if(none).alias("n_none"),
        *[F.sum(c).cast(PIECES).alias(out) for c, out in (("TSIE", "asked"), ("TSI", "got"))],
        F.sum(F.coalesce("TSI", "TSIE")).cast(PIECES).alias("sent"))

    joined = prices.join(counts.hint("merge"), "order_id", "left")
    n = lambda c, missing=0: F.coalesce(c, F.lit(missing))
    different = F.col("known") + F.col("unknown")
    rows = (n("n_some") * different + n("n_zero") * (F.least("known", F.lit(1)) + F.col("unknown")) + n("n_none", 1))
    times = different.cast("decimal(9,0)")
    fx = F.nullif(F.col("fx_ratio"), F.lit(0.0))
    value = lambda c: F.col("price_sum") * F.col(c).cast("double")
    orders = joined.groupBy(*by, "purchase_id", "order_id").agg(
        F.sum(refund_value(F.col("status"), value("asked"), value("got"))).alias("nmv"),
        F.sum(fx * rows).alias("fx_sum"), F.sum(F.when(fx.isNotNull(), rows)).alias("fx_n"),
        F.sum(F.col("sent") * times).alias("nsi"), F.sum(F.col("asked") * times).alias("tsie"))
    return _of_orders(orders, by, name)


def growth(order_lines: DataFrame, picks: DataFrame, grain: str, start: DateLike | None = None,
           stores: Stores | None = None, only_stores: bool = False, name: str = "Fecha", valued: DataFrame | None = None,
           **lines) -> DataFrame:
    """``growth_of_lines`` straight from the facts; ``lines`` goes to ``valued_lines``.

    By default, and wherever ``pick_keys`` is the order id alone, ``growth_by_order``. Where several
    results of the same facts and options are wanted, ``valued`` is their stored ``valued_lines``: the facts
    are then not joined again.
    """
    if valued is not None:
        return growth_of_lines(valued, grain, stores, only_stores, name)
    if list(lines.get("pick_keys", ["order_id"])) == ["order_id"] and not lines.get("line_key"):
        lines.pop("pick_keys", None)
        lines.pop("line_key", None)
        return growth_by_order(order_lines, picks, grain, start, stores, only_stores, name, **lines)
    return growth_of_lines(valued_lines(order_lines, picks, start, **lines), grain, stores, only_stores, name)


def growth_weekly(order_lines: DataFrame, picks: DataFrame, start: DateLike | None = None, **options) -> DataFrame:
    return growth(order_lines, picks, "week", start, **options)


def growth_daily_net(order_lines: DataFrame, picks: DataFrame, start: DateLike | None = None, **options) -> DataFrame:
    return growth(order_lines, picks, "day", start, **options)


def growth_weekly_store(order_lines: DataFrame, picks: DataFrame, stores: Stores, start: DateLike | None = None,
                        **options) -> DataFrame:
    return growth(order_lines, picks, "week", start, stores, name="Semana", **options)


def growth_daily_store(order_lines: DataFrame, picks: DataFrame, stores: Stores, start: DateLike | None = None,
                       **options) -> DataFrame:
    return growth(order_lines, picks, "day", start, stores, only_stores=True, **options)


def cancel_rate_weekly(order_lines: DataFrame, stores: Iterable[str], start: DateLike | None = None,
                       **scope) -> DataFrame:
    """Cancelled share of the distinct (week, order, status) rows."""
    lines = store_filter(scoped_lines(order_lines, start, excluded=(), **scope), "item.node_id", stores)
    orders = lines.select(to_period(F.col("closed_at"), "week").alias("Semana"), "order_id", "status").distinct()
    cancelled = F.count_if(F.col("status") == CANCELLED)
    return orders.groupBy("Semana").agg(
        cancelled.alias("Cancelled"), F.count("*").alias("Total_Orders"),
        F.round(safe_ratio(cancelled, F.count("*")), 4).alias("Cancel_Rate"))


def scoped_items(orders: DataFrame, stores: Iterable[str] | None, as_of: DateLike, days: int = LOOKBACK_DAYS,
                 tag: str = PARTNERSHIP_TAG, live_only: bool = True) -> DataFrame:
    """Items of nested orders, one row each: recent, of the partnership and stores."""
    recent = lookback_filter(orders, "created_at", as_of, days)
    if live_only:
        recent = status_filter(recent, "status")
    items = flag_filter(unnest_items(recent, "items"), "item.supermarket_flag")
    items = tag_filter(items, "item.tags", tag)
    if stores is not None:
        items = store_filter(items, "item.node_id", stores)
    return items.select(day(F.col("created_at")).alias("order_date"), F.col("item.node_id").alias("store_id"),
                        F.col("item.tags").alias("tags"), *[c for c in orders.columns if c != "items"])


def per_order(items: DataFrame, amounts: Iterable[str], order_once: bool) -> list[Column]:
    """Order amounts summed per item row, or taken once per order."""
    total = F.max if order_once else F.sum
    return [total(F.col(a).cast("double")).alias(a) for a in amounts]


def growth_daily(orders: DataFrame, stores: Iterable[str], as_of: DateLike, order_once: bool = False,
                 **scope) -> DataFrame:
    """Orders, buyers, gross value, and orders and buyers with fresh goods.

    An order counts as fresh in every store once one of its items is. The order value
    is counted per item row; ``order_once`` counts it once per order and store.

    Items are first collapsed to one row per order and store, with map-side
    combining, so even an order holding a large share of all rows is a handful of
    rows by the time the order-level flag is taken. Each of those rows then becomes
    one order row and one buyer row, which turns four distinct counts into plain
    counts over a single shuffle.
    """
    items = scoped_items(orders, stores, as_of, **scope)
    fresh = has_tag(F.col("tags"), FRESH_TAG, ignore_case=True)
    keys = ["order_date", "store_id", "order_id", "buyer_id"]
    compact = items.groupBy(*keys).agg(
        F.max(F.when(fresh, 1).otherwise(0)).alias("fresh"), *per_order(items, ["gross_value_usd"], order_once))
    flagged = compact.withColumn("fresh", F.max("fresh").over(Window.partitionBy("order_id")))
    entity = lambda kind, key, value: F.struct(
        F.lit(kind).alias("kind"), F.col(key).cast("string").alias("id"), value.cast("double").alias("gmv"))
    entities = flagged.select("order_date", "store_id", "fresh", F.explode(F.array(
        entity("order", "order_id", F.col("gross_value_usd")), entity("buyer", "buyer_id", F.lit(None)))).alias("e"))
    known = (entities.groupBy("order_date", "store_id", "e.kind", "e.id")
             .agg(F.max("fresh").alias("fresh"), F.sum("e.gmv").alias("gmv")))
    count = lambda kind, extra=F.lit(True): F.count_if((F.col("kind") == kind) & F.col("id").isNotNull() & extra)
    is_fresh = F.col("fresh") == 1
    return known.groupBy("order_date", "store_id").agg(
        count("order").alias("orders"), count("buyer").alias("buyers"),
        F.round(F.sum("gmv"), 2).alias("gmv_usd"),
        count("order", is_fresh).alias("fresh_orders"), count("buyer", is_fresh).alias("fresh_buyers"))


def pnl_daily(orders: DataFrame, stores: Iterable[str], as_of: DateLike, order_once: bool = False,
              **scope) -> DataFrame:
    """Orders, gross and net value, fees and take rate per day and store."""
    items = scoped_items(orders, stores, as_of, **scope)
    amounts = ["gross_value_usd", "net_value_usd", "delivery_fee_usd", "service_fee_usd"]
    per = items.groupBy("order_date", "store_id", "order_id").agg(*per_order(items, amounts, order_once))
    gross, net = F.sum("gross_value_usd"), F.sum("net_value_usd")
    return per.groupBy("order_date", "store_id").agg(
        F.count("order_id").alias("orders"),
        F.round(gross, 2).alias("gmv_usd"), F.round(net, 2).alias("nmv_usd"),
        F.round(F.sum("delivery_fee_usd"), 2).alias("delivery_fee_usd"),
        F.round(F.sum("service_fee_usd"), 2).alias("service_fee_usd"),
        F.round(safe_ratio(net, gross), 4).alias("take_rate"))
