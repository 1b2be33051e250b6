import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from farelake.operators.fact import fact_offers
from farelake.operators.flatten import ods_flatten, stage_current, unnest_misses
from farelake.schemas import DEFAULT_ENDPOINT, FACT_COLUMNS, LOG_SCHEMA, ODS_COLUMNS, SENTINEL

T0 = dt.datetime(2025, 12, 1, 10, 0, 0)


def offer(**kw):
    base = {"link": "/o?id=1&search_date=01122025", "price": 7000, "origin": "LON",
            "origin_airport": "LHR", "destination": "PAR", "destination_airport": "CDG",
            "airline": "XX", "flight_number": "12", "duration": 90, "transfers": 0,
            "duration_to": 90, "departure_at": "2025-12-20T09:10:00+03:00"}
    base.update(kw)
    return base


def req(one_way="true", departure_at="2025-12"):
    return json.dumps({"origin": "LON", "destination": "PAR", "currency": "RUB",
                       "departure_at": departure_at, "one_way": one_way})


def log_rows(spark, docs):
    rows = []
    for i, (request, response) in enumerate(docs):
        rows.append((f"d{i}", DEFAULT_ENDPOINT, request, response, 200, False, T0, T0, T0, T0,
                     SENTINEL))
    return spark.createDataFrame(rows, LOG_SCHEMA)


def test_unnest_rules(spark):
    docs = [
        (req(), json.dumps({"success": True, "currency": "rub", "data": [offer(), offer(link="/o?id=2")]})),
        (req(), json.dumps({"success": True, "currency": "rub"})),             # data missing
        (req(), json.dumps({"success": True, "data": None})),                  # data null
        (req(), json.dumps({"success": True, "data": []})),                    # empty
        (req(), json.dumps({"success": True, "data": {"a": 1}})),              # object
        (req(), json.dumps("boom")),                                           # string response
        (req(one_way="false"), json.dumps({"success": True, "data": [offer()]})),  # round trip
    ]
    log = log_rows(spark, docs)
    ods = ods_flatten(stage_current(log), processed_at=T0)
    assert ods.columns == ODS_COLUMNS
    assert ods.count() == 2
    reasons = {r.doc_id: r.reason for r in unnest_misses(log).collect()}
    assert reasons == {"d1": "no_data", "d2": "no_data", "d3": "empty", "d4": "not_array", "d5": "text"}


def test_types_offsets_and_text_numbers(spark):
    docs = [(req(departure_at="2025-12-15"),
             json.dumps({"data": [offer(price="7", link="/o?x"), offer(price=8, transfers=None)]}))]
    ods = ods_flatten(log_rows(spark, docs), processed_at=T0)
    rows = sorted(ods.collect(), key=lambda r: r.price_rub)
    assert [r.price_rub for r in rows] == [7, 8]
    assert rows[0].search_date is None                      # no search_date in link
    assert rows[0].req_departure_month == dt.date(2025, 12, 1)
    assert rows[0].departure_at_utc == dt.datetime(2025, 12, 20, 6, 10)  # +03:00 -> UTC
    fact = fact_offers(ods)
    assert fact.columns == FACT_COLUMNS
    f = sorted(fact.collect(), key=lambda r: r.price_rub)
    assert f[1].is_direct is False and f[0].is_direct is True
    assert f[0].price_bucket == "cheap" and f[0].departure_weekday_short == "Sat"


def test_strict_and_lenient_casts(spark):
    docs = [(req(), json.dumps({"data": [offer(price="7.5")]}))]
    log = log_rows(spark, docs)
    with pytest.raises(Exception):
        ods_flatten(log, processed_at=T0).collect()
    rows = ods_flatten(log, processed_at=T0, strict=False).collect()
    assert rows[0].price_rub is None


def test_stage_current_keeps_errors_drops_closed(spark):
    rows = [("a", DEFAULT_ENDPOINT, req(), '"boom"', None, True, T0, T0, T0, T0, SENTINEL),
            ("b", DEFAULT_ENDPOINT, req(), "{}", 200, False, T0, T0, T0, T0, T0),
            ("c", "/other", req(), "{}", 200, False, T0, T0, T0, T0, SENTINEL)]
    log = spark.createDataFrame(rows, LOG_SCHEMA)
    assert [r.doc_id for r in stage_current(log).collect()] == ["a"]
