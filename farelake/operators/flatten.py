"""Staging and offer flattening."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.functions.dates import month_from_text, search_date_from_link
from farelake.functions.json import parse_request, parse_response
from farelake.schemas import DEFAULT_ENDPOINT, ODS_COLUMNS, SENTINEL


def stage_current(log: DataFrame, endpoint: str | None = DEFAULT_ENDPOINT) -> DataFrame:
    """Current versions of one endpoint's documents; error documents are kept (B1)."""
    cond = F.col("valid_to_dttm") == F.lit(SENTINEL)
    if endpoint is not None:
        cond = cond & (F.col("endpoint") == endpoint)
    return log.filter(cond)


def _offers() -> F.Column:
    """Offers of a parsed response; none instead of NULL."""
    return F.coalesce(F.col("resp.data"), F.array())


def ods_flatten(stg: DataFrame, processed_at=None, strict: bool = True,
                one_way_only: bool = True) -> DataFrame:
    """One typed row per offer element of one-way requests (30 columns).

    * request / response JSON is parsed once with all-text schemas;
    * the one-way filter runs before the unnest (it depends on the parent only);
    * ``explode`` is inner: a string response, a missing / null / non-array
      ``data`` or an empty array yields no row. It reads an expression (``_offers``), not
      a column: of a column Spark infers a filter, which parses each response twice more;
    * ``strict`` casts raise on bad numbers (ANSI), lenient mode gives NULL;
    * ``processed_at`` is the run timestamp (a literal keeps runs repeatable).
    """
    cast = (lambda c, t: F.col(c).cast(t)) if strict else (lambda c, t: F.col(c).try_cast(t))
    run_ts = F.current_timestamp() if processed_at is None else (
        processed_at if isinstance(processed_at, F.Column) else F.lit(processed_at).cast("timestamp"))
    src = stg.select(
        "doc_id", "endpoint", "batch_started_at", "status_code", "error", "created_at",
        "updated_at", "valid_from_dttm",
        parse_request("request").alias("req"),
        parse_response("response").alias("resp"),
    )
    if one_way_only:
        src = src.filter(F.col("req.one_way") == "true")
    flat = src.select(
        "doc_id", "endpoint", "batch_started_at", "status_code", "error", "created_at",
        "updated_at", "valid_from_dttm",
        F.col("req.origin").alias("req_origin"),
        F.col("req.destination").alias("req_destination"),
        month_from_text(F.col("req.departure_at")).alias("req_departure_month"),
        F.col("req.currency").alias("req_currency"),
        F.col("req.one_way").alias("req_one_way"),
        F.col("resp.currency").alias("resp_currency"),
        F.explode(_offers()).alias("e"),
    )
    out = flat.select(
        "doc_id", "endpoint", "batch_started_at", "status_code", "error", "created_at",
        "updated_at",
        F.col("valid_from_dttm").alias("processed_src_dttm"),
        run_ts.alias("processed_at"),
        "req_origin", "req_destination", "req_departure_month", "req_currency",
        "req_one_way", "resp_currency",
        F.col("e.link").alias("link"),
        cast("e.price", "int").alias("price_rub"),
        F.col("e.origin").alias("origin"),
        F.col("e.origin_airport").alias("origin_airport"),
        F.col("e.destination").alias("destination"),
        F.col("e.destination_airport").alias("destination_airport"),
        F.col("e.airline").alias("airline"),
        F.col("e.flight_number").alias("flight_number"),
        cast("e.duration", "int").alias("duration_min"),
        cast("e.transfers", "int").alias("transfers_cnt"),
        cast("e.duration_to", "int").alias("duration_to_min"),
        cast("e.duration_back", "int").alias("duration_back_min"),
        cast("e.return_transfers", "int").alias("return_transfers_cnt"),
        cast("e.departure_at", "timestamp").alias("departure_at_utc"),
        search_date_from_link(F.col("e.link")).alias("search_date"),
    )
    return out.select(*ODS_COLUMNS)


def unnest_misses(stg: DataFrame) -> DataFrame:
    """Documents whose response yields no offer rows, with the reason.

    ``text`` (string response), ``no_data`` (key missing or null),
    ``not_array`` (``data`` is not an array) or ``empty``.
    """
    data_txt = F.get_json_object("response", "$.data")
    resp_is_obj = F.trim(F.col("response")).startswith("{")
    reason = (F.when(~resp_is_obj, "text")
              .when(data_txt.isNull(), "no_data")
              .when(~F.trim(data_txt).startswith("["), "not_array")
              .when(F.json_array_length(data_txt) == 0, "empty"))
    return stg.select("doc_id", reason.alias("reason")).filter(F.col("reason").isNotNull())


MISS_REASONS = ["text", "no_data", "not_array", "empty"]
CAST_FIELDS = {"price": "int", "duration": "int", "transfers": "int", "duration_to": "int", "duration_back": "int",
               "return_transfers": "int", "departure_at": "timestamp"}


def bad_casts(stg: DataFrame) -> DataFrame:
    """Offer fields whose text does not cast (lenient mode makes them NULL): one row
    (doc_id, reason = field) each. One-way requests only, as in ``ods_flatten``."""
    src = stg.select("doc_id", parse_request("request").alias("req"), parse_response("response").alias("resp"))
    offers = src.filter(F.col("req.one_way") == "true").select("doc_id", F.explode(_offers()).alias("e"))
    bad = [F.when(F.col(f"e.{f}").isNotNull() & F.col(f"e.{f}").try_cast(t).isNull(), F.lit(f))
           for f, t in CAST_FIELDS.items()]
    return offers.select("doc_id", F.explode(F.array(*bad)).alias("reason")).filter(F.col("reason").isNotNull())
