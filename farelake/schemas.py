"""Schemas and fixed values of the document log and its derived tables."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference behaviour for equal results.
# ---------------------------------------------------------------------------
# Open-version marker of the SCD2 log: 5999-12-31 00:00:00 UTC.
SENTINEL = _dt.datetime(5999, 12, 31, 0, 0, 0)
# Price bucket edges: < 5000 cheap; 5000..15000 (inclusive) medium; else expensive.
CHEAP_BELOW = 5000
MEDIUM_UP_TO = 15000
# Weekday names in week order (short form 'Dy', full form 'FMDay').
WEEKDAYS_SHORT = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
WEEKDAYS_FULL = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
# Lead-time bins (right-closed) and their labels.
LEAD_BIN_EDGES = [0, 7, 14, 30, 60, 90, 180, 365]
LEAD_BIN_LABELS = ["0-7", "8-14", "15-30", "31-60", "61-90", "91-180", "181-365"]
# Pattern of the search date inside an offer link, and its date format.
SEARCH_DATE_PATTERN = r"search_date=([0-9]{8})"
SEARCH_DATE_FORMAT = "ddMMyyyy"
# Request model rules.
IATA_PATTERN = r"^[A-Z]{2,3}$"
MARKET_PATTERN = r"^[a-z]{2}$"
CURRENCIES = ["RUB", "USD", "EUR"]
SORTINGS = ["price", "route"]
LIMIT_MIN, LIMIT_MAX = 1, 1000
DATE_TEXT_LENGTHS = [7, 10]
UNKNOWN_API_ERROR = "Unknown API error"
# Collector parameters: offers per call and months per pass (current + 12).
OFFERS_PER_CALL = 100
MONTHS_AHEAD = 12
# ---------------------------------------------------------------------------

# Endpoint label of the calendar-price calls in our log (neutral name).
DEFAULT_ENDPOINT = "/v3/prices_for_dates"

# Raw SCD2 log: one row per document version.
LOG_SCHEMA = T.StructType([
    T.StructField("doc_id", T.StringType(), False),
    T.StructField("endpoint", T.StringType(), True),
    T.StructField("request", T.StringType(), True),      # JSON text
    T.StructField("response", T.StringType(), True),     # JSON text (object or string)
    T.StructField("status_code", T.IntegerType(), True),
    T.StructField("error", T.BooleanType(), True),
    T.StructField("created_at", T.TimestampType(), True),
    T.StructField("updated_at", T.TimestampType(), True),
    T.StructField("batch_started_at", T.TimestampType(), True),
    T.StructField("valid_from_dttm", T.TimestampType(), False),
    T.StructField("valid_to_dttm", T.TimestampType(), False),
])

# Landing document (before versioning): the log minus the SCD2 columns.
DOC_COLUMNS = [f.name for f in LOG_SCHEMA.fields if f.name not in ("valid_from_dttm", "valid_to_dttm")]

# Request fields read by the ODS; every field is read as text (JSON ->> semantics).
REQUEST_SCHEMA = T.StructType([
    T.StructField(n, T.StringType()) for n in
    ["origin", "destination", "departure_at", "currency", "one_way"]
])

# Offer element fields; all read as text, then cast (numbers given as "7" or 7 both work).
OFFER_FIELDS = ["link", "price", "origin", "origin_airport", "destination",
                "destination_airport", "airline", "flight_number", "duration",
                "transfers", "duration_to", "duration_back", "return_transfers",
                "departure_at"]
OFFER_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in OFFER_FIELDS])

RESPONSE_SCHEMA = T.StructType([
    T.StructField("success", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("data", T.ArrayType(OFFER_SCHEMA)),
])

ODS_COLUMNS = [
    "doc_id", "endpoint", "batch_started_at", "status_code", "error", "created_at",
    "updated_at", "processed_src_dttm", "processed_at", "req_origin", "req_destination",
    "req_departure_month", "req_currency", "req_one_way", "resp_currency", "link",
    "price_rub", "origin", "origin_airport", "destination", "destination_airport",
    "airline", "flight_number", "duration_min", "transfers_cnt", "duration_to_min",
    "duration_back_min", "return_transfers_cnt", "departure_at_utc", "search_date",
]

FACT_COLUMNS = [
    "doc_id", "link", "batch_started_at", "endpoint", "status_code", "error",
    "created_at", "updated_at", "processed_src_dttm", "processed_at",
    "req_departure_month", "currency", "price_rub", "origin", "origin_airport",
    "destination", "destination_airport", "airline", "flight_number", "duration_min",
    "transfers_cnt", "duration_to_min", "duration_back_min", "return_transfers_cnt",
    "departure_at_utc", "search_date", "is_direct", "price_bucket", "departure_date",
    "departure_month", "departure_weekday_short", "departure_weekday_full",
    "search_weekday_short", "search_weekday_full",
]
