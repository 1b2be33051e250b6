"""Column expressions shared by the operators (all JVM built-ins, no UDF)."""

from farelake.functions.json import (  # noqa: F401
    json_len, quoted_json_text, parse_request, parse_response,
)
from farelake.functions.dates import (  # noqa: F401
    month_from_text, search_date_from_link, weekday_short, weekday_full,
    weekday_order, days_between, month_start, parse_iso_ts, month_spine_array,
    day_spine_array,
)
from farelake.functions.buckets import (  # noqa: F401
    price_bucket, is_direct, lead_bucket, lead_bucket_order,
)
