"""Column functions."""

from priceloom.functions.keys import surrogate_key
from priceloom.functions.places import geo_label, postal_department
from priceloom.functions.text import clean_text, empty_to_null, fixed_point, price, strict_ts
from priceloom.functions.times import (
    business_day,
    date_key,
    local_to_utc,
    micros_to_ts,
    slot_columns,
    utc_instant,
    utc_wall_clock,
)

__all__ = [
    "business_day", "clean_text", "date_key", "empty_to_null", "fixed_point", "geo_label", "local_to_utc",
    "micros_to_ts", "postal_department", "price", "slot_columns", "strict_ts", "surrogate_key", "utc_instant",
    "utc_wall_clock",
]
