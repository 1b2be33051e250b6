"""Fact table of offers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.functions.buckets import is_direct, price_bucket
from farelake.functions.dates import month_start, weekday_full, weekday_short
from farelake.schemas import FACT_COLUMNS


def fact_offers(ods: DataFrame) -> DataFrame:
    """34-column fact: ODS columns plus direct flag, price band, calendar parts.

    Dates are cut in the session zone (UTC): ``departure_date`` is the UTC day
    of ``departure_at_utc``.
    """
    dep = F.col("departure_at_utc")
    return ods.select(
        "doc_id", "link", "batch_started_at", "endpoint", "status_code", "error",
        "created_at", "updated_at", "processed_src_dttm", "processed_at",
        "req_departure_month",
        F.col("resp_currency").alias("currency"),
        "price_rub", "origin", "origin_airport", "destination", "destination_airport",
        "airline", "flight_number", "duration_min", "transfers_cnt", "duration_to_min",
        "duration_back_min", "return_transfers_cnt", "departure_at_utc", "search_date",
        is_direct("transfers_cnt").alias("is_direct"),
        price_bucket("price_rub").alias("price_bucket"),
        F.to_date(dep).alias("departure_date"),
        month_start(dep).alias("departure_month"),
        weekday_short(dep).alias("departure_weekday_short"),
        weekday_full(dep).alias("departure_weekday_full"),
        weekday_short("search_date").alias("search_weekday_short"),
        weekday_full("search_date").alias("search_weekday_full"),
    ).select(*FACT_COLUMNS)
