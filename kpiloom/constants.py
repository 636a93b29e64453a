"""Codes and word lists that results depend on."""

# Fixed values -- order status codes.
CANCELLED = "cancelled"
INVALID = "invalid"
PARTIALLY_REFUNDED = "partially_refunded"

# Fixed values -- item tags.
PARTNERSHIP_TAG = "supermarket_partnership"
FRESH_TAG = "fresh"

# Fixed values -- traffic.
TRAFFIC_EVENTS = (
    "ITEM_PAGE",
    "HOME_INSTORE",
    "ADD_TO_CART",
    "HOME_STORE_BUTTON",
    "MAIN_AISLE",
    "WIDGET",
    "AISLE",
    "BANNER",
    "CART_INTERVENTION",
    "CAROUSEL",
    "PUSH_OPEN",
)

# Fixed values -- quantity measure of goods sold by piece.
UNIT_MEASURE = "unit"

# Fixed values -- windows, in days.
LOOKBACK_DAYS = 395
OPS_LOOKBACK_DAYS = 60
DAILY_WINDOW_DAYS = 28

# Fixed values -- Spanish calendar words of the input sheets and period labels.
MONTH_ABBR = ("Ene", "Feb", "Mar", "Abr", "May", "Jun",
              "Jul", "Ago", "Sep", "Oct", "Nov", "Dic")
MONTH_NAMES = ("enero", "febrero", "marzo", "abril", "mayo", "junio",
               "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")
WEEKDAY_NAMES = ("lunes", "martes", "miércoles", "jueves", "viernes", "sábado",
                 "domingo", "miercoles", "sabado")

# Fixed values -- demographics.
SEGMENTS = ("PLATINUM", "GOLD", "SILVER", "BRONZE")
UNCLASSIFIED = "Sin clasif."
AGE_BANDS = ("18-29", "30-44", "45-59", "60+")
GENDERS = ("female", "male")

# Fixed values -- subtotal labels.
TOTAL = "Total"
OTHER = "OTHER"
