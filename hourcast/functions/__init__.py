"""Column-expression functions (native Catalyst expressions, no Python UDFs)."""

from hourcast.functions.aqi import (aqi_category, aqi_color, aqi_category_struct, pm25_to_aqi,
                                    pm25_to_aqi_rounded, threshold_label)
from hourcast.functions.calendar import (add_calendar, add_cyclical, cyclical, day_of_week, floor_hour,
                                         hours_between, local_time, to_ntz)
from hourcast.functions.numeric import round4, round_half_even, r6, coerce_double

__all__ = [
    "aqi_category", "aqi_color", "aqi_category_struct", "pm25_to_aqi", "pm25_to_aqi_rounded",
    "threshold_label", "add_calendar", "add_cyclical", "cyclical", "day_of_week", "floor_hour",
    "hours_between", "local_time", "to_ntz", "round4", "round_half_even", "r6", "coerce_double",
]
