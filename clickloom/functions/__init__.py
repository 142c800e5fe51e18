from clickloom.functions.kpis import conversion_rate, cpa, cpc, ctr, roas
from clickloom.functions.scalar import (
    band,
    budget_tier,
    channel_group,
    clamp,
    conversion_label,
    count_where,
    elapsed,
    exact_sum,
    exact_units,
    limbs,
    micros_to_euros,
    month_start,
    normalize_label,
    revenue_tier,
    round_half_away,
    safe_divide,
    strip_space,
    units_of,
    units_to_double,
    week_start,
)

__all__ = [
    "band",
    "budget_tier",
    "channel_group",
    "clamp",
    "conversion_label",
    "conversion_rate",
    "count_where",
    "cpa",
    "cpc",
    "ctr",
    "elapsed",
    "exact_sum",
    "exact_units",
    "limbs",
    "micros_to_euros",
    "month_start",
    "normalize_label",
    "revenue_tier",
    "roas",
    "round_half_away",
    "safe_divide",
    "strip_space",
    "units_of",
    "units_to_double",
    "week_start",
]
