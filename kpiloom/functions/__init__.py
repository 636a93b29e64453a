from kpiloom.functions.dates import (  # noqa: F401
    as_date, day, day_before, day_label, day_text, month_abbr, month_from_yyyymm,
    month_label, month_number, month_start, parse_day_month, previous_month_end,
    to_period, try_date, week_sunday)
from kpiloom.functions.numbers import (  # noqa: F401
    nan_to_null, parse_comma_cell, parse_decimal_comma, parse_percent, positive_ratio,
    round_half_even, round_half_up, safe_ratio, safe_ratio_nz)
from kpiloom.functions.retail import (  # noqa: F401
    age_band, blank_to_total, line_value, nps_bucket, qty_cap, qty_normalise,
    refund_value, segment_map, store_label, total_label, value_status)
