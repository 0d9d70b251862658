from .reports import (
    age_bands, age_quantiles, arrivals_by_month, arrivals_by_origin, months_after, trend_of_months, correlate, warming_by_country,
    age_distribution, climatology, primary_destinations, recent_temperatures, state_trend,
    warming_and_origins,
)

__all__ = [
    "age_bands", "age_quantiles", "arrivals_by_month", "arrivals_by_origin", "months_after", "trend_of_months", "correlate", "warming_by_country",
    "age_distribution", "climatology", "primary_destinations", "recent_temperatures", "state_trend",
    "warming_and_origins",
]
