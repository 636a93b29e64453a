from kpiloom.plans.assortment import assortment_parse, assortment_summary, assortment_wide  # noqa: F401
from kpiloom.plans.experience import (  # noqa: F401
    bpp_by_type, bpp_daily, bpp_totals, bpp_trend, claims_by_order, claims_reasons, claims_totals, cx_monthly, cx_monthly_store,
    nps_monthly, nps_pivot)
from kpiloom.plans.growth import (  # noqa: F401
    cancel_rate_weekly, growth, growth_daily, growth_daily_net, growth_daily_store, growth_weekly,
    growth_of_lines, growth_of_orders, growth_of_tallies, growth_tallies, lines_by_week, orders_of_lines, sales_anchor, growth_weekly_store, pnl_daily, valued_lines)
from kpiloom.plans.incremental import refresh_orders  # noqa: F401
from kpiloom.plans.marts import (  # noqa: F401
    buyers_exact, buyers_table, daily_kpis, daily_ops, daily_store, monthly_buyers_store, monthly_kpis,
    monthly_ops, monthly_ops_store, monthly_store, pl_pct_of_growth, pl_ratios, rolling_28d, rolling_7d,
    rolling_kpis, unit_economics, weekly_buyers_mart, weekly_kpis, weekly_ops_mart, weekly_ops_store_mart,
    weekly_store_mart, window_store_totals)
from kpiloom.plans.ops import (  # noqa: F401
    cancels_by_type, fill_rate_items, ontime_by_status, ops_daily, ops_scorecard, ops_totals, ops_weekly,
    ops_weekly_store, perfect_purchase)
from kpiloom.plans.people import (  # noqa: F401
    buyers_ytd, demo_age_month, demographic_totals, demo_gender_month, demo_segment_month, demo_segment_store)
from kpiloom.plans.people_states import (  # noqa: F401
    buyers_ytd_exact, conversion_exact, monthly_kpis_exact, people_per_period, people_states, rolling_people)
from kpiloom.plans.planning import plan_daily, plan_monthly, plan_vs_actual, plan_weekly, plan_ytd  # noqa: F401
from kpiloom.plans.scorecard import scorecard_marts, scorecard_records, scorecard_tables  # noqa: F401
from kpiloom.plans.tables import metric_table, metric_table_latest, status_flags  # noqa: F401
from kpiloom.plans.traffic import (  # noqa: F401
    buyers_weekly_store, conversion_of_tallies, conversion_tallies, cvr_daily, cvr_weekly, visits_daily, visits_daily_store, visits_weekly)
