"""Schemas, as DDL text, of the files users already have (period results and inputs)."""

_GROWTH = "Compras bigint, Ordenes bigint, NMV double, NMV_USD double, NSI double, TSIE_total bigint"
_RATES = ("FR_Items double, FR_Items_Reemplazo double, FR_Compras double, "
          "FR_Compras_Reemplazo double, Compra_Perfecta double, On_Time double, "
          "Cancel_Rate double, Cancel_Buyer double, Cancel_Stockout double, Cancel_Seller double")
_CX = ("Perfect_Purchases double, Total_Purchases double, Perfect_Purchase_Rate double, "
       "Total_Claims bigint, Repentance_Claims bigint, Incomplete_Claims bigint, "
       "Different_Claims bigint, Defective_Claims bigint, Claims_Rate double, "
       "On_Time double, Cancel_Rate double")

GROWTH = f"Fecha date, {_GROWTH}"
GROWTH_STORE_WEEKLY = f"Semana date, Tienda string, {_GROWTH}"
GROWTH_STORE_DAILY = f"Fecha date, Tienda string, {_GROWTH}"
BUYERS_STORE = "Semana date, TIENDA string, Buyers bigint"
CANCEL_RATE = "Semana date, Cancelled bigint, Total_Orders bigint, Cancel_Rate double"
VISITS = "Fecha date, Visitas bigint"
CVR_WEEKLY = "Semana date, Buyers bigint, Visitors bigint, CVR double"
CVR_DAILY = "Fecha date, Buyers bigint, Visitors bigint, CVR double"
OPS_WEEKLY = f"Semana date, {_RATES}, CR_Purchases_total double"
OPS_DAILY = f"Fecha date, {_RATES}"
OPS_STORE_WEEKLY = ("Semana date, Tienda string, FR_Items double, FR_Items_Reemplazo double, "
                           "FR_Compras double, Compra_Perfecta double, On_Time double, Cancel_Rate double")
NPS_MONTHLY = ("Mes date, Tienda string, NPS_Score double, Total_Responses bigint, "
                      "Promotores bigint, Neutros bigint, Detractores bigint")
CX_MONTHLY = f"Mes date, {_CX}"
CX_STORE_MONTHLY = f"Mes date, Tienda string, {_CX}"
PL_MONTHLY = ("Mes int, TGMV bigint, NMV bigint, Net_Variable_Fee bigint, Net_Monetization bigint, "
                     "Product_Net_Monetization bigint, Variable_Contribution bigint, "
                     "Direct_Contribution bigint, Shipping_Cost bigint, Promotions bigint, Coupons bigint")
PLAN_MONTHLY = "Mes date, NMV_V2 double, `NMV_4+8` double"
PLAN_DAILY = ("Fecha date, Dia string, NMV_V2 double, NSI_V2 double, `NMV_4+8` double, "
                     "`NSI_4+8` double, `Purchases_4+8` double")
PLAN_WEEKLY = ("Semana date, NMV_V2 bigint, NSI_V2 bigint, `NMV_4+8` bigint, "
                      "`NSI_4+8` bigint, `Purchases_4+8` bigint")
DEMOGRAPHICS = "Mes date, Segmento string, Rango_edad string, Genero string, MABs bigint"
DEMOGRAPHICS_STORE = "Mes date, TIENDA string, Segmento string, Rango_edad string, MABs bigint"
BUYERS_YTD = "Mes date, Total_Buyers bigint"
CLAIMS_REASONS = ("mes date, tienda string, motivo string, fallo string, claims bigint, "
                         "gmv_reclamado double")
