"""DuckDB text of the logical tables in ``kpiloom.bindings``."""


def node(key: str) -> str:
    return f"'N' || CAST({key} % 5 AS VARCHAR)"


def week(c: str) -> str:
    return f"(CAST({c} AS DATE) - CAST(dayofweek({c}) AS INTEGER))"


def month(c: str) -> str:
    return f"CAST(date_trunc('month', {c}) AS DATE)"


def day(c: str) -> str:
    return f"CAST({c} AS DATE)"


PERIOD = {"day": day, "week": week, "month": month}


def store_case(c: str, ids: tuple[str, str, str, str] = ("N0", "N1", "N2", "N3")) -> str:
    names = ("North", "East", "South", "West")
    return "CASE " + " ".join(f"WHEN {c} = '{i}' THEN '{n}'" for i, n in zip(ids, names)) + " END"


STORE_LIST = "('N0', 'N1', 'N2', 'N3')"

TAGS = """CASE WHEN l_partkey % 40 = 1 THEN CAST([] AS VARCHAR[]) WHEN l_partkey % 40 = 2 THEN ['other']
  WHEN l_partkey % 40 > 2 THEN ['supermarket_partnership', CASE WHEN l_partkey % 3 = 0 THEN 'Fresh' ELSE 'dry' END] END"""
SUPERMARKET = """CASE WHEN NOT (l_returnflag = 'N' AND l_linestatus = 'F') THEN TRUE WHEN l_quantity > 25 THEN FALSE END"""
STATUS = """CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'invalid'
  WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN NULL WHEN o_orderstatus = 'F' THEN 'cancelled'
  WHEN o_orderstatus = 'P' THEN 'partially_refunded' ELSE 'paid' END"""
CLAIM_TYPE = "CASE l_partkey % 4 WHEN 0 THEN 'pdd' WHEN 1 THEN 'Pnr' WHEN 2 THEN 'LOWCOST' ELSE ' ' END"
K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
MODEL = f"CASE WHEN {K} < 95 THEN 'INSTORE' ELSE 'ONLINE' END"
CANCEL = "l_discount > 0.085"


def flag(cond: str) -> str:
    return f"CASE WHEN {cond} THEN 1 ELSE 0 END"


def _cx(key: str) -> str:
    shares = {"Perfect_Purchase_Rate": "l_discount < 0.035", "Claims_Rate": "l_returnflag = 'R'", "On_Time": "l_linestatus = 'O'",
              "Cancel_Rate": "l_discount > 0.085"}
    claims = ", ".join(f"count(*) FILTER (l_returnflag = 'R' AND l_partkey % 5 = {k}) AS {name}_Claims"
                       for k, name in enumerate(("Repentance", "Incomplete", "Different", "Defective")))
    return f"""
SELECT {month('l_shipdate')} AS Mes{key}, CAST(count(*) FILTER (l_discount < 0.035) AS DOUBLE) AS Perfect_Purchases,
  CAST(count(*) AS DOUBLE) AS Total_Purchases, count(*) FILTER (l_returnflag = 'R') AS Total_Claims, {claims},
  {', '.join(f"round(count(*) FILTER ({cond}) / count(*), 4) AS {name}" for name, cond in shares.items())}
FROM lineitem GROUP BY ALL"""


CTES: dict[str, str] = {
    "order_lines": f"""
SELECT l_orderkey AS order_id, l_partkey AS sku_id, l_linenumber AS line_id,
  o_custkey * 1000000 + year(o_orderdate) * 100 + month(o_orderdate) AS purchase_id, o_custkey AS buyer_id,
  {STATUS} AS status, o_orderdate AS closed_at,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'S2' ELSE 'S1' END AS site,
  CASE WHEN l_quantity = 50 THEN 'XX' ELSE 'TM' END AS marketplace_id,
  CASE WHEN l_discount < 0.005 THEN FALSE WHEN l_discount < 0.095 THEN TRUE END AS gmv_flag,
  CASE WHEN l_tax > 0.075 THEN TRUE WHEN l_tax > 0.005 THEN FALSE END AS auto_offer_flag,
  l_tax AS fx_ratio, {node('l_suppkey')} AS node_id, l_extendedprice / l_quantity AS unit_price,
  {SUPERMARKET} AS supermarket_flag, {TAGS} AS tags
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "picks": """
SELECT l_orderkey AS order_id, l_partkey AS sku_id, l_linenumber AS line_id, l_quantity AS requested_qty,
  CASE l_returnflag WHEN 'A' THEN 'unit' WHEN 'R' THEN 'kg' END AS measure,
  CASE WHEN l_returnflag = 'R' THEN l_quantity * 1.1 WHEN l_discount <= 0.085 THEN l_quantity * (1 - l_discount) END AS picked_qty,
  CASE WHEN l_partkey % 997 = 1 THEN 1e-7 ELSE CAST(l_partkey % 25 AS DOUBLE) END AS net_weight
FROM lineitem""",
    "pick_counts": """
SELECT order_id, sku_id, line_id, CAST(requested_qty / per_piece AS DECIMAL(28, 9)) AS wanted,
  least(CAST(picked_qty / per_piece AS DECIMAL(28, 9)), CASE WHEN picked_qty IS NOT NULL THEN CAST(requested_qty / per_piece AS DECIMAL(28, 9)) END) AS got
FROM (SELECT *, CASE WHEN coalesce(measure, 'unit') = 'unit' THEN 1 WHEN net_weight != 0 THEN net_weight END AS per_piece FROM picks)""",
    "scoped": """
SELECT * FROM order_lines WHERE site = 'S1' AND gmv_flag IS TRUE AND marketplace_id = 'TM'
  AND auto_offer_flag IS NOT TRUE AND supermarket_flag IS TRUE
  AND array_to_string(tags, ',') LIKE '%supermarket_partnership%' AND closed_at >= DATE '1995-01-03'""",
    "nested_orders": f"""
SELECT l_orderkey AS order_id, o_custkey AS buyer_id, {STATUS} AS status, o_orderdate AS created_at,
  l_extendedprice AS gross_value_usd, floor(l_extendedprice * (1 - l_discount)) AS net_value_usd,
  floor(l_extendedprice * l_tax) AS delivery_fee_usd, l_quantity AS service_fee_usd,
  CASE WHEN l_quantity = 1 THEN [] WHEN l_returnflag = 'R' THEN [{node('l_suppkey')}, {node('(l_suppkey + 1)')}]
    ELSE [{node('l_suppkey')}] END AS nodes,
  {SUPERMARKET} AS supermarket_flag, {TAGS} AS tags
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "order_items": """
SELECT * EXCLUDE (nodes), CAST(created_at AS DATE) AS order_date, n.node AS store_id
FROM nested_orders, unnest(nodes) AS n(node)""",
    "scoped_items_all": f"""
SELECT * FROM order_items WHERE supermarket_flag IS TRUE AND list_contains(tags, 'supermarket_partnership') AND store_id IN {STORE_LIST}""",
    "scoped_items": "SELECT * FROM scoped_items_all WHERE order_date >= DATE '1996-01-15' - 395",
    "traffic": f"""
SELECT CAST(ts AS DATE) AS day, user_id, {MODEL} AS model, 'S1' AS site,
  CASE event_type WHEN 'view' THEN ['ITEM_PAGE', 'HOME_INSTORE'] WHEN 'click' THEN ['ADD_TO_CART', 'FOOTER']
    WHEN 'signup' THEN ['SIGNUP'] WHEN 'error' THEN CAST([] AS VARCHAR[]) END AS events
FROM events""",
    "buyer_orders": f"""
SELECT CAST(ts AS DATE) AS day, user_id AS buyer_id, {MODEL} AS model, 'S1' AS site FROM events WHERE event_type = 'purchase'""",
    "event_visits": f"""
SELECT CAST(ts AS DATE) AS day, {node('user_id')} AS node_id, CAST(1 AS BIGINT) AS sessions, {K} % 3 AS visitors, {K} AS visits,
  {MODEL} AS model, 'S1' AS site FROM events""",
    "order_visits": f"""
SELECT CAST(o_orderdate AS DATE) AS day, {node('o_orderkey')} AS node_id, 1 + o_orderkey % 7 AS visits FROM orders""",
    "order_traffic": """SELECT CAST(o_orderdate AS DATE) AS day, o_custkey AS user_id FROM orders""",
    "order_buyers": """
SELECT CAST(o_orderdate AS DATE) AS day, o_custkey AS buyer_id FROM orders WHERE o_orderstatus = 'O'""",
    "store_sales": f"""
SELECT CAST(o_orderdate AS DATE) AS day, {node('o_orderkey')} AS store, o_custkey AS buyer_id FROM orders""",
    "scorecard": f"""
SELECT CAST(l_shipdate AS DATE) AS day, 7000 + l_suppkey % 5 AS store_id, {node('l_suppkey')} AS node_id,
  CASE WHEN l_linenumber = 7 THEN 'S2' ELSE 'S1' END AS site, l_quantity AS fi_requested,
  floor(l_quantity * (1 - l_discount)) AS fi_picked, floor(l_quantity * (1 - l_discount / 2)) AS fi_picked_replaced,
  {flag('l_discount < 0.035')} AS fc_complete, {flag('l_discount < 0.055')} AS fc_complete_replaced, 1 AS fc_purchases,
  {flag("l_linestatus = 'O'")} AS ot_packs, {flag("l_linestatus = 'O' AND l_returnflag != 'R'")} AS ot_on_time,
  1 AS cr_purchases, {flag(CANCEL)} AS cr_cancels, {flag(CANCEL + ' AND l_partkey % 3 = 0')} AS cr_buyer_cancels,
  {flag(CANCEL + ' AND l_partkey % 3 = 1')} AS cr_stockout_cancels, {flag(CANCEL + ' AND l_partkey % 3 = 2')} AS cr_seller_cancels,
  CASE WHEN l_tax > 0.005 THEN l_discount END AS cancel_rate, CASE WHEN l_tax > 0.005 THEN l_quantity END AS cancels_total,
  CASE WHEN l_partkey % 3 = 0 THEN l_quantity END AS cancels_seller, CASE WHEN l_partkey % 3 = 1 THEN l_quantity END AS cancels_buyer,
  CASE WHEN l_partkey % 3 = 2 THEN l_quantity END AS cancels_stockout, 1 - l_discount AS fill_rate, l_tax AS ot_rate,
  CASE WHEN l_linenumber < 4 THEN l_tax END AS ot_early_pct, CASE WHEN l_linenumber > 4 THEN l_tax END AS ot_delay_pct,
  CASE WHEN l_linenumber = 4 THEN l_tax END AS ot_ontime_pct,
  CASE WHEN l_returnflag != 'R' THEN l_discount END AS perfect_purchase_rate,
  CASE WHEN l_returnflag != 'N' THEN l_quantity END AS total_orders
FROM lineitem""",
    "cancels": f"""
SELECT CAST(l_shipdate AS DATE) AS day, {node('l_suppkey')} AS node_id,
  CASE l_partkey % 3 WHEN 0 THEN 'seller' WHEN 1 THEN 'Buyer' ELSE 'STOCKOUT' END AS reason_type FROM lineitem""",
    "ontime_packs": f"""
SELECT CAST(l_shipdate AS DATE) AS day, {node('l_suppkey')} AS node_id,
  CASE WHEN l_linenumber < 3 THEN 'early' WHEN l_linenumber < 6 THEN 'On_Time' ELSE 'delay' END AS status,
  l_orderkey AS pack_id FROM lineitem""",
    "perfect_orders": f"""
SELECT CAST(l_shipdate AS DATE) AS day, {node('l_suppkey')} AS node_id, l_orderkey AS order_id,
  CASE WHEN l_tax > 0.005 THEN l_discount < 0.035 END AS perfect_flag FROM lineitem""",
    "survey": """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
  CASE WHEN cents % 13 = 0 THEN '6.5' WHEN cents % 17 = 0 THEN NULL WHEN cents % 19 = 0 THEN 'n/a'
    WHEN cents % 23 = 0 THEN 'NaN' WHEN cents % 29 = 0 THEN '1e12'
    ELSE CAST(cents % 11 AS VARCHAR) END AS score,
  o_orderdate AS end_date, 'SHOP_' || o_orderpriority AS code, substr(o_orderpriority, 1, 1) AS survey_site
FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)""",
    "survey_buckets": """
SELECT *, CASE WHEN s < 7 THEN -1 WHEN s < 9 THEN 0 WHEN s IN (9, 10) THEN 1 END AS bucket
FROM (SELECT *, TRY_CAST(round(TRY_CAST(score AS DOUBLE)) AS INTEGER) AS s FROM survey)""",
    "claims": """
SELECT l_orderkey AS order_id, CAST(l_shipdate AS DATE) AS claim_date,
  CASE l_partkey % 4 WHEN 0 THEN 'incomplete' WHEN 1 THEN 'different' WHEN 2 THEN 'defective' ELSE 'repentance' END AS claim_type,
  CASE WHEN l_tax > 0.035 THEN 'buyer' WHEN l_tax > 0.005 THEN 'seller' END AS claim_result,
  100 + l_suppkey % 2 AS respondent_id
FROM lineitem WHERE l_returnflag = 'R'""",
    "bpp": f"""
SELECT CAST(l_shipdate AS DATE) AS day, {CLAIM_TYPE} AS claim_type, floor(l_extendedprice * l_discount) AS total_usd,
  floor(l_extendedprice * l_tax) AS recovery_usd FROM lineitem WHERE l_returnflag = 'R'""",
    "bpp_rows": f"""
SELECT {month('l_shipdate')} AS Mes, coalesce(nullif(trim({CLAIM_TYPE}), ''), 'OTHER') AS CLAIM_TYPE,
  floor(l_extendedprice * l_discount) AS paid, floor(l_extendedprice * l_tax) AS recovered,
  CASE WHEN l_linenumber > 1 THEN 1 ELSE 0 END AS cases
FROM lineitem WHERE l_returnflag = 'R'""",
    "claims_rows": f"""
SELECT {month('l_shipdate')} AS Mes, CASE WHEN l_suppkey % 5 = 4 THEN 'Total' ELSE {node('l_suppkey')} END AS Tienda,
  CASE l_partkey % 3 WHEN 0 THEN 'incomplete' WHEN 1 THEN 'different' ELSE 'defective' END AS motivo,
  CASE WHEN l_tax > 0.035 THEN 'buyer' WHEN l_tax > 0.005 THEN 'seller' ELSE '' END AS fallo,
  CASE WHEN l_linenumber > 1 THEN 1 ELSE 0 END AS claims, floor(l_extendedprice) AS gmv
FROM lineitem WHERE l_returnflag = 'R'""",
    "pl_monthly": f"""
SELECT {month('o_orderdate')} AS Mes, CAST(sum(floor(l_extendedprice)) AS BIGINT) AS TGMV,
  CAST(sum(CASE WHEN month(o_orderdate) = 1 THEN 0 ELSE floor(l_extendedprice * (1 - l_discount)) END) AS BIGINT) AS NMV,
  CAST(sum(floor(l_extendedprice * l_tax)) AS BIGINT) AS Net_Variable_Fee,
  CAST(sum(floor(l_extendedprice * CAST(0.09 AS DOUBLE))) AS BIGINT) AS Net_Monetization,
  CAST(sum(floor(l_extendedprice * CAST(0.07 AS DOUBLE))) AS BIGINT) AS Product_Net_Monetization,
  CAST(sum(floor(l_extendedprice * CAST(0.02 AS DOUBLE))) - sum(floor(l_extendedprice * l_discount / 4)) AS BIGINT) AS Variable_Contribution,
  CAST(sum(floor(l_extendedprice * CAST(0.01 AS DOUBLE))) - sum(floor(l_extendedprice * l_discount / 4)) AS BIGINT) AS Direct_Contribution,
  CAST(-sum(floor(l_extendedprice * CAST(0.05 AS DOUBLE))) AS BIGINT) AS Shipping_Cost,
  CAST(-sum(floor(l_extendedprice * l_discount)) AS BIGINT) AS Promotions,
  CAST(-sum(floor(l_extendedprice * l_discount / 2)) AS BIGINT) AS Coupons
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
    "cx_store": _cx(f", {node('l_suppkey')} AS Tienda"),
    "cx_month": _cx(""),
    "plan": """
SELECT Fecha, round(v * CAST(1.1 AS DOUBLE)) AS NMV_V2, CAST(n * 10 AS DOUBLE) AS NSI_V2,
  round(v * CAST(0.9 AS DOUBLE)) AS NMV_48, CAST(n * 9 AS DOUBLE) AS NSI_48, CASE WHEN n > 3 THEN CAST(n AS DOUBLE) END AS Pur_48
FROM (SELECT CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 YEAR AS DATE) AS Fecha, sum(floor(o_totalprice)) AS v, count(*) AS n
  FROM orders GROUP BY 1)""",
    "demographics": f"""
SELECT {month('o_orderdate')} AS Mes, {node('c_custkey')} AS TIENDA,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'BRONZE' WHEN 'FURNITURE' THEN 'SILVER' WHEN 'HOUSEHOLD' THEN 'GOLD'
    WHEN 'MACHINERY' THEN 'PLATINUM' ELSE 'Sin clasif.' END AS segment,
  CASE WHEN low < 10 THEN 'Sin clasif.' WHEN low < 30 THEN '18-29' WHEN low < 45 THEN '30-44' WHEN low < 60 THEN '45-59' ELSE '60+' END AS age_group,
  CASE c_nationkey % 3 WHEN 0 THEN 'female' WHEN 1 THEN 'male' ELSE 'unknown' END AS Genero
FROM orders JOIN (SELECT *, floor(c_acctbal / 150) * 5 AS low FROM customer) ON o_custkey = c_custkey""",
    "buyers_monthly": f"""
SELECT {month('o_orderdate')} AS Mes, count(DISTINCT o_custkey) AS Total_Buyers FROM orders GROUP BY 1""",
    "assortment_rates": """
SELECT Tienda, Mes, disp, prof, gap
FROM (SELECT make_date(y, m, 1) AS Mes, Tienda FROM (SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS y FROM lineitem),
  (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS m), (SELECT unnest(['North', 'East', 'South', 'West']) AS Tienda))
LEFT JOIN (SELECT CASE l_suppkey % 4 WHEN 0 THEN 'North' WHEN 1 THEN 'East' WHEN 2 THEN 'South' ELSE 'West' END AS Tienda,
    CAST(date_trunc('month', l_shipdate) AS DATE) AS Mes, count(*) FILTER (l_discount < 0.075) * 1000 // count(*) AS disp,
    count(*) FILTER (l_quantity < 31) * 1000 // count(*) AS prof, count(*) FILTER (l_linenumber = 1) * 1000 // count(*) AS gap
  FROM lineitem GROUP BY 1, 2) USING (Tienda, Mes)""",
}


def growth_sql(grain: str, store: bool = False, only_stores: bool = False, name: str = "Fecha", line_key: bool = False,
               order_key: bool = False) -> str:
    """Growth stated by its definition: each different line of a period once, summed per order, then per period."""
    place = f"{store_case('node_id')}" if store else "'all'"
    keep = f"node_id IN {STORE_LIST}" if only_stores else "TRUE"
    out = f"{name}, place AS Tienda" if store else name
    tell = ", sku_id, line_id" if line_key else ""
    match = "order_id" if order_key else "order_id, sku_id, line_id"
    return f"""
SELECT {out}, count(DISTINCT purchase_id) AS Compras, count(DISTINCT order_id) AS Ordenes, round(sum(worth), 0) AS NMV,
  round(sum(worth) * (sum(rates) / nullif(sum(n_rates), 0)), 0) AS NMV_USD,
  CAST(round(sum(sent), 0) AS DOUBLE) AS NSI, CAST(round(sum(asked), 0) AS BIGINT) AS TSIE_total
FROM (
  SELECT {name}, place, purchase_id, order_id, sum(CASE status WHEN 'partially_refunded' THEN price_got ELSE price_wanted END) AS worth,
    sum(rate) FILTER (rate != 0) AS rates, count(*) FILTER (rate != 0) AS n_rates, sum(ifnull(got, wanted)) AS sent, sum(wanted) AS asked
  FROM (
    SELECT DISTINCT {PERIOD[grain]('closed_at')} AS {name}, {place} AS place, purchase_id, order_id, status, ifnull(fx_ratio, 0) AS rate,
      wanted, got, unit_price * CAST(wanted AS DOUBLE) AS price_wanted, unit_price * CAST(got AS DOUBLE) AS price_got{tell}
    FROM scoped LEFT JOIN pick_counts USING ({match})
    WHERE status <> 'cancelled' AND {keep})
  WHERE place IS NOT NULL GROUP BY ALL)
GROUP BY {name}, place"""


RATE_PAIRS = {
    "FR_Items": ("fi_picked", "fi_requested"), "FR_Items_Reemplazo": ("fi_picked_replaced", "fi_requested"),
    "FR_Compras": ("fc_complete", "fc_purchases"), "FR_Compras_Reemplazo": ("fc_complete_replaced", "fc_purchases"),
    "Compra_Perfecta": ("fc_complete", "fc_purchases"), "On_Time": ("ot_on_time", "ot_packs"),
    "Cancel_Rate": ("cr_cancels", "cr_purchases"), "Cancel_Buyer": ("cr_buyer_cancels", "cr_purchases"),
    "Cancel_Stockout": ("cr_stockout_cancels", "cr_purchases"), "Cancel_Seller": ("cr_seller_cancels", "cr_purchases")}
STORE_RATE_NAMES = ("FR_Items", "FR_Items_Reemplazo", "FR_Compras", "Compra_Perfecta", "On_Time", "Cancel_Rate")


def rates_sql(names=tuple(RATE_PAIRS)) -> str:
    return ", ".join(f"round(sum({RATE_PAIRS[n][0]}) / nullif(sum({RATE_PAIRS[n][1]}), 0), 4) AS {n}" for n in names)


def cvr_sql(grain: str, name: str, buyers: str, visitors: str) -> str:
    period = PERIOD[grain]("day")
    return f"""
SELECT coalesce(b.p, v.p) AS {name}, coalesce(b.n, 0) AS Buyers, coalesce(v.n, 0) AS Visitors,
  round(coalesce(b.n, 0) / nullif(coalesce(v.n, 0), 0), 4) AS CVR
FROM (SELECT {period} AS p, count(DISTINCT buyer_id) AS n FROM {buyers} GROUP BY 1) b
FULL JOIN (SELECT {period} AS p, count(DISTINCT user_id) AS n FROM {visitors} GROUP BY 1) v ON b.p = v.p"""


ECONOMICS = """NMV / nullif(CASE WHEN NMV != 0 THEN Compras END, 0) AS APV_LC,
  NMV / nullif(CASE WHEN NMV != 0 THEN Ordenes END, 0) AS NASP_LC,
  NSI / nullif(CASE WHEN NSI != 0 THEN TSIE_total END, 0) AS FR_Items,
  NSI / nullif(CASE WHEN NSI != 0 THEN Ordenes END, 0) AS NSI_Cart, Ordenes / nullif(Compras, 0) AS Ord_Comp"""

# Period results that the mart checks build on.
CTES |= {
    "g_day": growth_sql("day"),
    "g_week": growth_sql("week"),
    "g_week_store": growth_sql("week", True, name="Semana"),
    "g_day_store": growth_sql("day", True, True),
    "v_day": "SELECT day AS Fecha, CAST(sum(visits) AS BIGINT) AS Visitas FROM order_visits GROUP BY 1",
    "v_week": f"SELECT {week('day')} AS Fecha, CAST(sum(visits) AS BIGINT) AS Visitas FROM order_visits GROUP BY 1",
    "c_day": cvr_sql("day", "Fecha", "order_buyers", "order_traffic"),
    "c_week": cvr_sql("week", "Semana", "order_buyers", "order_traffic"),
    "o_week": f"""SELECT {week('day')} AS Semana, {rates_sql()}, CAST(sum(cr_purchases) AS BIGINT) AS CR_Purchases_total
FROM scorecard WHERE site = 'S1' AND CAST(store_id AS VARCHAR) IN ('7000', '7001', '7002', '7003') AND day >= DATE '1993-01-01' GROUP BY 1""",
    "o_day": f"""SELECT day AS Fecha, {rates_sql()} FROM scorecard
WHERE site = 'S1' AND CAST(store_id AS VARCHAR) IN ('7000', '7001', '7002', '7003') AND day >= DATE '1993-01-01' - 60 GROUP BY 1""",
    "o_week_store": f"""SELECT {week('day')} AS Semana, {store_case('CAST(store_id AS VARCHAR)', ('7000', '7001', '7002', '7003'))} AS Tienda,
  {rates_sql(STORE_RATE_NAMES)}
FROM scorecard WHERE site = 'S1' AND CAST(store_id AS VARCHAR) IN ('7000', '7001', '7002', '7003') AND day >= DATE '1993-01-01' GROUP BY 1, 2""",
    "b_week_store": f"""SELECT {week('day')} AS Semana, store AS TIENDA, count(DISTINCT buyer_id) AS Buyers FROM store_sales GROUP BY 1, 2""",
    "k_week": f"""SELECT g.Fecha, Compras, Ordenes, NMV, NSI, {ECONOMICS}, Visitas, CVR, Buyers, Stores
FROM g_week g LEFT JOIN v_week USING (Fecha)
LEFT JOIN (SELECT Semana AS Fecha, CVR, Buyers FROM c_week) USING (Fecha)
LEFT JOIN (SELECT Semana AS Fecha, count(DISTINCT Tienda) AS Stores FROM g_week_store GROUP BY 1) USING (Fecha)
WHERE g.Fecha <= DATE '2001-06-30'""",
    "k_month": f"""SELECT Mes, Compras, Ordenes, NMV, NSI, {ECONOMICS}, Visitas, Buyers, Visitors,
  Buyers / nullif(Visitors, 0) AS CVR, Stores
FROM (SELECT {month('Fecha')} AS Mes, CAST(coalesce(sum(Compras), 0) AS BIGINT) AS Compras, CAST(coalesce(sum(Ordenes), 0) AS BIGINT) AS Ordenes,
    coalesce(sum(NMV), 0) AS NMV, coalesce(sum(NSI), 0) AS NSI, CAST(coalesce(sum(TSIE_total), 0) AS BIGINT) AS TSIE_total FROM g_day GROUP BY 1) g
LEFT JOIN (SELECT {month('Fecha')} AS Mes, CAST(sum(Visitas) AS BIGINT) AS Visitas FROM v_day GROUP BY 1) USING (Mes)
LEFT JOIN (SELECT {month('Semana')} AS Mes, CAST(sum(Buyers) AS BIGINT) AS Buyers, CAST(sum(Visitors) AS BIGINT) AS Visitors FROM c_week GROUP BY 1) USING (Mes)
LEFT JOIN (SELECT {month('Semana')} AS Mes, count(DISTINCT Tienda) AS Stores FROM g_week_store GROUP BY 1) USING (Mes)
WHERE Mes <= DATE '2001-06-30'""",
    "k_day": f"""SELECT g.Fecha, Compras, Ordenes, NMV, NSI, {ECONOMICS}, Visitas, Buyers, CVR
FROM g_day g LEFT JOIN v_day USING (Fecha) LEFT JOIN (SELECT Fecha, Buyers, CVR FROM c_day) USING (Fecha)
WHERE g.Fecha BETWEEN (SELECT least(max(Fecha), DATE '2001-07-14') - 27 FROM g_day) AND (SELECT least(max(Fecha), DATE '2001-07-14') FROM g_day)""",
    "plan_week": f"""SELECT {week('Fecha')} AS Semana, CAST(round_even(coalesce(sum(NMV_V2), 0), 0) AS BIGINT) AS NMV_V2,
  CAST(round_even(coalesce(sum(NSI_V2), 0), 0) AS BIGINT) AS NSI_V2, CAST(round_even(coalesce(sum(NMV_48), 0), 0) AS BIGINT) AS "NMV_4+8",
  CAST(round_even(coalesce(sum(NSI_48), 0), 0) AS BIGINT) AS "NSI_4+8", CAST(round_even(coalesce(sum(Pur_48), 0), 0) AS BIGINT) AS "Purchases_4+8"
FROM plan GROUP BY 1""",
    "nps": f"""SELECT Mes, CASE WHEN grouping(Tienda) = 1 THEN 'Total' ELSE coalesce(Tienda, 'unmapped') END AS Tienda,
  round((count(*) FILTER (bucket = 1) - count(*) FILTER (bucket = -1)) / count(*) * 100, 0) + 0 AS NPS_Score,
  count(*) AS Total_Responses, count(*) FILTER (bucket = 1) AS Promotores, count(*) FILTER (bucket = 0) AS Neutros,
  count(*) FILTER (bucket = -1) AS Detractores
FROM (SELECT {month('s.end_date')} AS Mes, s.bucket, m.Tienda FROM survey_buckets s
  LEFT JOIN (SELECT DISTINCT CAST(order_id AS VARCHAR) AS order_id, {store_case('node_id')} AS Tienda FROM order_lines WHERE site = 'S1') m
  ON s.order_id = m.order_id WHERE s.bucket IS NOT NULL AND s.code LIKE '%SHOP%')
GROUP BY GROUPING SETS ((Mes, Tienda), (Mes))""",
    "assortment": """SELECT Tienda, Mes, unnest(['Disponibilidad', 'Profundidad', 'Gap']) AS metric,
  unnest([CAST(disp AS DOUBLE) / 10 / 100, CAST(prof AS DOUBLE) / 10 / 100, CAST(gap AS DOUBLE) / 10]) AS value FROM assortment_rates""",
}
