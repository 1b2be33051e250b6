"""Request grid, request validation / normalisation and response classes
(A3, B12-B14, C2, C3, D13, H16-H20)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.functions.dates import day_spine_array, month_spine_array
from farelake.functions.json import json_len
from farelake.schemas import (CURRENCIES, DATE_TEXT_LENGTHS, IATA_PATTERN, LIMIT_MAX, LIMIT_MIN,
                              MARKET_PATTERN, MONTHS_AHEAD, OFFERS_PER_CALL, SORTINGS,
                              UNKNOWN_API_ERROR)

BOOL_TEXT = ["true", "false"]
FALSY = ["false", "null", "", "[]", "{}"]


def _text_bool_ok(c) -> F.Column:
    return c.isNull() | F.lower(c.cast("string")).isin(*BOOL_TEXT)


def _date_text_ok(c) -> F.Column:
    return c.isNull() | F.length(F.trim(c)).isin(*DATE_TEXT_LENGTHS)


def validate_requests(df: DataFrame) -> DataFrame:
    """Add ``reject_reasons`` (array of rule names) and ``is_valid``.

    Rules of the request model, checked side by side (every failing rule is
    listed): codes are upper-cased first and must match ``^[A-Z]{2,3}$``;
    currency in RUB/USD/EUR; date texts trimmed to length 7 or 10; one-way
    requests carry no return date; market two lower-case letters; limit
    1..1000; page >= 1; sorting price/route; flags are booleans. A NULL
    optional field takes its default and passes.
    """
    up = lambda c: F.upper(F.col(c))
    lim = F.col("limit").try_cast("int")
    page = F.col("page").try_cast("int")
    one_way_true = F.coalesce(F.lower(F.col("one_way").cast("string")), F.lit("true")) == "true"
    rules = [
        ("origin", F.col("origin").isNull() | ~up("origin").rlike(IATA_PATTERN)),
        ("destination", F.col("destination").isNull() | ~up("destination").rlike(IATA_PATTERN)),
        ("currency", F.col("currency").isNotNull() & ~F.col("currency").isin(*CURRENCIES)),
        ("departure_at", ~_date_text_ok(F.col("departure_at"))),
        ("return_at", ~_date_text_ok(F.col("return_at"))),
        ("return_with_one_way", one_way_true & F.col("return_at").isNotNull()),
        ("market", F.col("market").isNotNull() & ~F.col("market").rlike(MARKET_PATTERN)),
        ("limit", F.col("limit").isNotNull() & (lim.isNull() | ~lim.between(LIMIT_MIN, LIMIT_MAX))),
        ("page", F.col("page").isNotNull() & (page.isNull() | (page < 1))),
        ("sorting", F.col("sorting").isNotNull() & ~F.col("sorting").isin(*SORTINGS)),
        ("one_way", ~_text_bool_ok(F.col("one_way"))),
        ("direct", ~_text_bool_ok(F.col("direct"))),
        ("unique", ~_text_bool_ok(F.col("unique"))),
    ]
    reasons = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules]))
    return (df.withColumn("reject_reasons", reasons)
              .withColumn("is_valid", F.size("reject_reasons") == 0))


def normalize_requests(df: DataFrame) -> DataFrame:
    """Serialised query of valid requests (B13): NULLs dropped, codes upper-case,
    date texts trimmed, flags as ``'true'/'false'``, limit/page as numbers,
    defaults filled (currency RUB, flags, limit 30, page 1, sorting price)."""
    flag = lambda c, d: F.lower(F.coalesce(F.col(c).cast("string"), F.lit(d)))
    q = F.struct(
        F.upper("origin").alias("origin"),
        F.upper("destination").alias("destination"),
        F.coalesce("currency", F.lit("RUB")).alias("currency"),
        F.trim("departure_at").alias("departure_at"),
        F.trim("return_at").alias("return_at"),
        flag("one_way", "true").alias("one_way"),
        flag("direct", "false").alias("direct"),
        F.col("market").alias("market"),
        F.coalesce(F.col("limit").try_cast("int"), F.lit(30)).alias("limit"),
        F.coalesce(F.col("page").try_cast("int"), F.lit(1)).alias("page"),
        F.coalesce("sorting", F.lit("price")).alias("sorting"),
        flag("unique", "false").alias("unique"),
    )
    return df.withColumn("query_json", F.to_json(q))


def classify_responses(log: DataFrame) -> DataFrame:
    """Success flag and error message of each stored response.

    An object response whose ``success`` is missing or falsy (false, null, 0,
    an empty text, list or object) is an error whose message is its ``error`` text or 'Unknown API error'; a bare JSON string response is
    an error whose message is that text.
    """
    resp = F.trim(F.col("response"))
    is_obj = resp.startswith("{")
    is_text = resp.startswith('"')
    success = F.coalesce(F.get_json_object("response", "$.success"), F.lit(""))
    falsy = success.isin(*FALSY) | F.coalesce(success.try_cast("double") == 0, F.lit(False))
    ok = is_obj & ~falsy & F.coalesce(F.col("error"), F.lit(False)).eqNullSafe(False)
    text = F.from_json(F.concat(F.lit("["), resp, F.lit("]")), "array<string>")[0]
    message = (F.when(ok, F.lit(None))
               .when(is_text, text)
               .otherwise(F.coalesce(F.nullif(F.get_json_object("response", "$.error"), F.lit("")),
                                     F.lit(UNKNOWN_API_ERROR))))
    return log.withColumn("is_success", ok).withColumn("error_message", message)


def ordered_pairs(routes: DataFrame) -> DataFrame:
    """The distinct (origin, destination) routes of a log, origin != destination.

    The pairs come from the routes the data hold, by one partial aggregate: the
    result grows with the routes in use, not with the square of the codes.
    """
    return (routes.select("origin", "destination")
                  .filter((F.col("origin") != F.col("destination"))).distinct())


def request_grid(pairs: DataFrame, start, one_way_flags=(True, False),
                 limit: int = OFFERS_PER_CALL, months_ahead: int = MONTHS_AHEAD) -> DataFrame:
    """Requests of one collection pass: pairs x months (current + 12) x trip flag."""
    start_col = start if isinstance(start, F.Column) else F.lit(start).cast("date")
    flags = F.array(*[F.lit("true" if f else "false") for f in one_way_flags])
    return (pairs.select("origin", "destination",
                         F.explode(month_spine_array(start_col, months_ahead)).alias("departure_at"))
                 .select("origin", "destination", "departure_at", F.explode(flags).alias("one_way"))
                 .select("origin", "destination", "departure_at", "one_way",
                         F.lit(limit).alias("limit"), F.lit("price").alias("sorting")))


def month_spine(df: DataFrame, date_col: str, months_ahead: int = MONTHS_AHEAD) -> DataFrame:
    """'yyyy-MM' periods (current month + ``months_ahead``) per date."""
    return df.select(date_col, F.explode(month_spine_array(F.col(date_col), months_ahead)).alias("period"))


def day_spine(df: DataFrame, date_col: str, months_ahead: int = MONTHS_AHEAD) -> DataFrame:
    """Every day from the date to the last day of the ``months_ahead``-th month after."""
    return df.select(date_col, F.explode(day_spine_array(F.col(date_col), months_ahead)).alias("day"))


def batch_summary(log: DataFrame) -> DataFrame:
    """Per collection batch: offers on successful calls, missed calls, routes and
    periods requested (D13, H20). A call is missed when it is an error document
    or its response is not a success."""
    classified = classify_responses(log)
    ok = F.col("is_success")
    route = F.struct(F.get_json_object("request", "$.origin"),
                     F.get_json_object("request", "$.destination"))
    return (classified.groupBy("batch_started_at")
                      .agg(F.sum(F.when(ok, json_len("response")).otherwise(0)).alias("number_tickets"),
                           F.count_if(~ok).alias("number_missed"),
                           F.count_distinct(route).alias("routes"),
                           F.count_distinct(F.get_json_object("request", "$.departure_at")).alias("periods")))


def latest_date(df: DataFrame, column: str) -> _dt.date | None:
    """Scalar max of a date column (one aggregate row read on the driver)."""
    row = df.agg(F.max(column).alias("m")).first()
    return None if row is None else row["m"]
