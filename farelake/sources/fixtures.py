"""Map the driver's tables onto the document-log shapes the jobs consume.

* ``offer_rows`` / ``offer_log``: priced offers from the order tables, grouped
  into API documents (one document per route, departure month, trip type and
  page of at most ~``OFFERS_PER_CALL`` offers), one current version each.
* ``event_log``: a versioned change log from ``events`` (one version per event),
  used for SCD2, watermarks, batches and time-bucket checks.
* ``request_rows``: request parameters with planted faults from ``customer``.

Everything is a Spark plan over the input tables; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.schemas import DEFAULT_ENDPOINT, OFFERS_PER_CALL, SENTINEL
from farelake.session import scratch_path
from farelake.sources.log import build_documents
from farelake.sources.tables import read_table, spread

ISO_FMT = "yyyy-MM-dd'T'HH:mm:ss"


def _iso(ts) -> F.Column:
    """ISO-8601 text with an explicit UTC offset."""
    return F.concat(F.date_format(ts, ISO_FMT), F.lit("+00:00"))


def offer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One priced offer per line item (city = region, airport = nation)."""
    # Small numbers go into the shuffle join, not the amounts and texts they come from.
    li = spread(read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.floor(F.col("l_extendedprice") / 5).cast("int").alias("price"),
        (F.col("l_quantity").cast("int") * 10).alias("duration"),
        F.col("l_shipdate").cast("timestamp").alias("departure_at"),
        (F.col("l_returnflag") != "R").alias("one_way")))
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("search_date"))
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supp = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey) \
        .select("n_nationkey", "n_name", "r_name")
    geo_o = geo.select(F.col("n_nationkey").alias("o_nk"), F.col("n_name").alias("origin_airport"),
                       F.col("r_name").alias("origin"))
    geo_d = geo.select(F.col("n_nationkey").alias("d_nk"), F.col("n_name").alias("destination_airport"),
                       F.col("r_name").alias("destination"))
    # Customers meet the orders first: a shuffle join moves an order, not each of its line items.
    orders = orders.join(cust, F.col("o_custkey") == cust.c_custkey).select("o_orderkey", "search_date", "c_nationkey")
    j = (li.join(orders, li.l_orderkey == orders.o_orderkey)
           .join(supp, F.col("l_suppkey") == supp.s_suppkey)
           .join(part, F.col("l_partkey") == part.p_partkey)
           .join(geo_o, F.col("c_nationkey") == F.col("o_nk"))
           .join(geo_d, F.col("s_nationkey") == F.col("d_nk")))
    return j.select(
        "origin", "origin_airport", "destination", "destination_airport",
        F.col("p_brand").alias("airline"),
        F.col("l_partkey").cast("string").alias("flight_number"),
        "price",
        (F.col("l_linenumber") - 1).alias("transfers"),
        "duration", "departure_at", "search_date", "one_way",
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
    )


def offer_link(df: DataFrame) -> F.Column:
    return F.concat(
        F.lit("/o?id="), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        F.lit("&search_date="), F.date_format("search_date", "ddMMyyyy"))


def offer_log(spark: SparkSession, sf_dir: str, limit: int = OFFERS_PER_CALL,
              endpoint: str = DEFAULT_ENDPOINT) -> DataFrame:
    """Document log (LOG_SCHEMA) with one current version per document.

    A call returns one route and departure month; calls with more offers than
    ``limit`` are split into pages, so every document holds about ``limit``
    offers no matter how hot the route is. Page count comes from a partial
    aggregate (one row per call: routes x months x trip type), which is written
    first: Spark decides by the size of that table how to join it, so the offers
    are not shuffled by call for a table that a broadcast holds, and it splits a
    hot route in a shuffle join. The document grouping shuffles by (call, page),
    which splits a hot route over its pages.
    """
    offers = offer_rows(spark, sf_dir).withColumn(
        "dep_month", F.date_format("departure_at", "yyyy-MM"))
    call = ["origin", "destination", "dep_month", "one_way"]
    sizes = offers.groupBy(*call).agg(F.count(F.lit(1)).alias("call_n"))
    path = scratch_path(spark, "call-sizes")
    sizes.write.parquet(path)
    sizes = spark.read.schema(sizes.schema).parquet(path)
    n_pages = F.ceil(F.col("call_n") / F.lit(limit))
    paged = (offers.join(sizes, call)
             .withColumn("page", (F.pmod(F.col("l_orderkey") * 8 + F.col("l_linenumber"), n_pages) + 1)
                         .cast("int")))
    # From the keys that the link needs anyway: not shuffled beside them.
    flight, transfers = F.col("l_partkey").cast("string"), F.col("l_linenumber") - 1
    elem = F.struct(
        offer_link(paged).alias("link"),
        F.col("price"),
        "origin", "origin_airport", "destination", "destination_airport", "airline",
        flight.alias("flight_number"), "duration",
        transfers.alias("transfers"),
        F.col("duration").alias("duration_to"),
        F.when(~F.col("one_way"), F.col("duration")).alias("duration_back"),
        F.when(~F.col("one_way"), transfers).alias("return_transfers"),
        _iso(F.col("departure_at")).alias("departure_at"),
    )
    # Shuffle by document first: collect_list gains nothing from a map-side
    # partial aggregate, and the grouping then reuses this partitioning.
    docs = paged.repartition(*call, "page").groupBy(*call, "page").agg(
        F.collect_list(elem).alias("data"),
        F.min("search_date").alias("first_search"),
        F.max("search_date").alias("last_search"),
        # The same as the key. A filter on the request's text that read the keys alone would
        # be moved below the grouping and write and parse a request for each line item.
        F.first("one_way").alias("trip"))
    request = F.to_json(F.struct(
        F.col("origin"), F.col("destination"), F.lit("RUB").alias("currency"),
        F.col("dep_month").alias("departure_at"),
        F.when(F.col("trip"), "true").otherwise("false").alias("one_way"),
        F.lit("false").alias("direct"), F.lit(limit).alias("limit"), F.col("page"),
        F.lit("price").alias("sorting"), F.lit("false").alias("unique")))
    response = F.to_json(F.struct(F.lit(True).alias("success"), F.col("data"),
                                  F.lit("rub").alias("currency")))
    created = F.col("first_search").cast("timestamp")
    updated = F.col("last_search").cast("timestamp")
    return docs.select(
        F.concat_ws("-", F.lit("o"), "origin", "destination", "dep_month",
                    F.when(F.col("one_way"), "ow").otherwise("rt"), F.col("page").cast("string"))
        .alias("doc_id"),
        F.lit(endpoint).alias("endpoint"),
        request.alias("request"),
        response.alias("response"),
        F.lit(200).alias("status_code"),
        F.lit(False).alias("error"),
        created.alias("created_at"),
        updated.alias("updated_at"),
        created.alias("batch_started_at"),
        updated.alias("valid_from_dttm"),
        F.lit(SENTINEL).alias("valid_to_dttm"),
    )


def event_calls(spark: SparkSession, sf_dir: str, endpoint: str = DEFAULT_ENDPOINT) -> DataFrame:
    """Collector call results from ``events``: one call per event.

    ``doc_id = 'u<user>-<type>'``; the call starts at ``ts`` and is answered
    ``k`` minutes later (``k`` from ``props``). ``error`` events fail with the
    text 'boom'; ``signup`` events return a failed response object; other
    events return ``k % 5`` copies of one offer. ``event_id`` and ``k`` ride
    along as the version tie-break and offer multiplicity.
    """
    ev = spread(read_table(spark, sf_dir, "events"))
    k = F.get_json_object("props", "$.k").cast("int")
    ev = ev.select("event_id", "ts", "user_id", "event_type", "value", k.alias("k"))
    ts = F.col("ts").cast("timestamp")
    search = F.date_format(ts, "ddMMyyyy")
    origin = F.upper(F.substring("event_type", 1, 3))
    dest = F.concat(F.lit("D"), (F.col("user_id") % 10).cast("string"))
    offer = F.struct(
        F.concat(F.lit("/e?id="), F.col("event_id").cast("string"), F.lit("&search_date="), search)
        .alias("link"),
        F.round(F.col("value") * 100).cast("int").alias("price"),
        origin.alias("origin"),
        F.concat(origin, F.lit("1")).alias("origin_airport"),
        dest.alias("destination"),
        F.concat(dest, F.lit("A")).alias("destination_airport"),
        F.concat(F.lit("A"), (F.col("event_id") % 7).cast("string")).alias("airline"),
        F.col("event_id").cast("string").alias("flight_number"),
        (F.col("k") * 10).alias("duration"),
        (F.col("k") % 3).alias("transfers"),
        F.col("k").alias("duration_to"),
        _iso(ts + F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.col("k"))).alias("departure_at"),
    )
    success = F.to_json(F.struct(F.lit(True).alias("success"), F.lit("rub").alias("currency"),
                                 F.array_repeat(offer, F.col("k") % 5).alias("data")))
    failed = F.to_json(F.struct(F.lit(False).alias("success"), F.lit("quota").alias("error")))
    request = F.to_json(F.struct(
        origin.alias("origin"), dest.alias("destination"), F.lit("RUB").alias("currency"),
        F.date_format(ts, "yyyy-MM").alias("departure_at"),
        F.lit("true").alias("one_way"), F.lit("false").alias("direct"),
        F.lit(OFFERS_PER_CALL).alias("limit"), F.lit(1).alias("page"),
        F.lit("price").alias("sorting"), F.lit("false").alias("unique")))
    is_err = F.col("event_type") == "error"
    return ev.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("-"), F.col("event_type"))
        .alias("doc_id"),
        F.lit(endpoint).alias("endpoint"),
        request.alias("request"),
        F.when(~is_err, F.when(F.col("event_type") == "signup", failed).otherwise(success))
        .alias("response_json"),
        F.when(is_err, F.lit("boom")).alias("error_text"),
        F.lit(None).cast("int").alias("http_status"),
        ts.alias("created_at"),
        (ts + F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.col("k")))
        .alias("updated_at"),
        F.date_trunc("day", ts).alias("batch_started_at"),
        "event_id", "k",
    )


def event_documents(spark: SparkSession, sf_dir: str, endpoint: str = DEFAULT_ENDPOINT) -> DataFrame:
    """Landing documents (A5) of the event calls, with ``event_id`` kept."""
    return build_documents(event_calls(spark, sf_dir, endpoint), extra=["event_id"])


def event_log(spark: SparkSession, sf_dir: str, endpoint: str = DEFAULT_ENDPOINT) -> DataFrame:
    """Full SCD2 history of the event documents: each version is loaded at its
    call time and closed by the next version of the same document."""
    from farelake.operators.scd2 import scd2_history
    docs = event_documents(spark, sf_dir, endpoint)
    return scd2_history(docs.withColumn("valid_from_dttm", F.col("created_at")))


def request_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request parameters from ``customer`` with planted faults (all text fields)."""
    c = read_table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return c.select(
        key.alias("request_id"),
        F.when(key % 7 == 0, "1X").otherwise(F.lower(F.substring("c_mktsegment", 1, 3))).alias("origin"),
        F.when(F.col("c_nationkey") == 3, "LONDON").otherwise("PAR").alias("destination"),
        F.element_at(F.array(*[F.lit(x) for x in ["RUB", "USD", "EUR", "GBP"]]),
                     (F.col("c_nationkey") % 4 + 1).cast("int")).alias("currency"),
        F.when(key % 11 == 0, "2025/1").otherwise("2025-12-01").alias("departure_at"),
        F.when(key % 3 == 0, "2026-01-15").alias("return_at"),
        F.when(key % 2 == 0, "true").otherwise("false").alias("one_way"),
        F.lit("false").alias("direct"),
        F.lit(None).cast("string").alias("market"),
        F.floor("c_acctbal").cast("string").alias("limit"),
        F.lit("1").alias("page"),
        F.lit("price").alias("sorting"),
        F.lit("false").alias("unique"),
    )
