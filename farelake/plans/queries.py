"""Registered queries: name -> fn(spark, sf_dir) -> DataFrame.

Each query reads the driver tables (or data Spark derives from them) in full.
Computed columns carry the same aliases as the SQL oracle (``oracle.py``).
Floating results are rounded to 6 places on both sides.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.functions.json import json_len
from farelake.operators import anomaly as an
from farelake.operators import marts, stats
from farelake.operators import quality as dq
from farelake.operators.fact import fact_offers
from farelake.operators.flatten import CAST_FIELDS, MISS_REASONS, bad_casts, ods_flatten, unnest_misses
from farelake.operators import requests as rq
from farelake.operators.quantiles import exact_quantiles
from farelake.operators.scd2 import interval_faults
from farelake.plans import checks
from farelake.plans import incremental as inc
from farelake.plans import check_states, keyed_state, live_marts, stat_states
from farelake.schemas import FACT_COLUMNS, ODS_COLUMNS, SENTINEL
from farelake.sources.fixtures import event_documents, event_log, request_rows
from farelake.sources.fixtures import offer_log, offer_rows
from farelake.sources.log import land_documents_json, read_code_list, read_landing, read_since_table
from farelake.sources.tables import read_table
from farelake.plans.refresh import RUN_TS, offer_fact, offer_ods, offer_stage, to_output
from farelake.session import prepare, scratch_path
from farelake.streaming.ingest import land_documents, stream_ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return to_output(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# --- staging / flattening / fact ------------------------------------------

@query("stage_current")
def q_stage_current(spark, sf_dir):
    """Current documents with their offer count (JSON compared by content)."""
    stg = offer_stage(spark, sf_dir)
    return stg.select("doc_id", "endpoint", "status_code", "error", "created_at", "updated_at",
                      "batch_started_at",
                      F.get_json_object("request", "$.departure_at").alias("req_departure_at"),
                      F.get_json_object("request", "$.page").cast("int").alias("req_page"),
                      F.json_array_length(F.get_json_object("response", "$.data")).alias("n_offers"))


@query("scan_log")
def q_scan_log(spark, sf_dir):
    """Offer documents landed as JSON lines (ISO-8601 text times), read back
    with the declared schema and versioned (A1, A5, H18)."""
    path = scratch_path(spark, "landing")
    land_documents_json(offer_log(spark, sf_dir), path)
    docs = read_landing(spark, path)
    return docs.select("doc_id", "endpoint", "status_code", "error", "created_at", "updated_at",
                       "batch_started_at",
                       F.get_json_object("request", "$.departure_at").alias("req_departure_at"),
                       F.get_json_object("request", "$.page").cast("int").alias("req_page"),
                       F.json_array_length(F.get_json_object("response", "$.data")).alias("n_offers"))


@query("ods_flatten")
def q_ods_flatten(spark, sf_dir):
    return offer_ods(spark, sf_dir)


@query("fact_offers")
def q_fact_offers(spark, sf_dir):
    return offer_fact(spark, sf_dir)


# --- marts -------------------------------------------------------------------

@query("agg_route")
def q_agg_route(spark, sf_dir):
    return marts.agg_route(offer_fact(spark, sf_dir)).withColumn("avg_price_rub", r6("avg_price_rub"))


@query("agg_dep_route")
def q_agg_dep_route(spark, sf_dir):
    return marts.agg_dep_route(offer_fact(spark, sf_dir)).withColumn("avg_price_rub", r6("avg_price_rub"))


@query("agg_search_dep_route")
def q_agg_search_dep_route(spark, sf_dir):
    return marts.agg_search_dep_route(offer_fact(spark, sf_dir)) \
        .withColumn("avg_price_rub", r6("avg_price_rub"))


@query("first_offer")
def q_first_offer(spark, sf_dir):
    return marts.first_offer(offer_fact(spark, sf_dir))


@query("latest_cheapest")
def q_latest_cheapest(spark, sf_dir):
    return marts.latest_cheapest(offer_fact(spark, sf_dir))


@query("airports")
def q_airports(spark, sf_dir):
    return marts.airports(offer_fact(spark, sf_dir))


# --- statistics ------------------------------------------------------------

def _monthly(spark, sf_dir):
    return stats.stats_month(offer_fact(spark, sf_dir))


def _weekly(spark, sf_dir):
    return stats.stats_weekday(offer_fact(spark, sf_dir))


def _lead(spark, sf_dir):
    return stats.lead_time_offers(offer_fact(spark, sf_dir))


def _round_doubles(df: DataFrame) -> DataFrame:
    return df.select(*[r6(f.name).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
                       for f in df.schema.fields])


@query("stats_month")
def q_stats_month(spark, sf_dir):
    return _round_doubles(_monthly(spark, sf_dir))


@query("stats_weekday")
def q_stats_weekday(spark, sf_dir):
    return _round_doubles(_weekly(spark, sf_dir))


@query("lead_time_offers")
def q_lead_time_offers(spark, sf_dir):
    return _lead(spark, sf_dir)


@query("stats_lead_bucket")
def q_stats_lead_bucket(spark, sf_dir):
    return _round_doubles(stats.stats_lead_bucket(_lead(spark, sf_dir)))


@query("stats_lead_day")
def q_stats_lead_day(spark, sf_dir):
    return _round_doubles(stats.stats_lead_day(_lead(spark, sf_dir)))


@query("smooth_lead_curve")
def q_smooth_lead_curve(spark, sf_dir):
    return _round_doubles(stats.smooth_lead_curve(_lead(spark, sf_dir), sigma=2.0))


@query("month_rollup")
def q_month_rollup(spark, sf_dir):
    return _round_doubles(stats.month_rollup(_monthly(spark, sf_dir)))


@query("pivot_month_year")
def q_pivot_month_year(spark, sf_dir):
    return _round_doubles(stats.pivot_month_year(_monthly(spark, sf_dir)))


@query("cheapest_months")
def q_cheapest_months(spark, sf_dir):
    return _round_doubles(stats.cheapest_months(_monthly(spark, sf_dir), 3))


@query("cheapest_weekdays")
def q_cheapest_weekdays(spark, sf_dir):
    return _round_doubles(stats.cheapest_weekdays(_weekly(spark, sf_dir), 2))


@query("price_extremes")
def q_price_extremes(spark, sf_dir):
    # Four statistics of one fact: what they read of it is computed and written once.
    fact = _written(offer_fact(spark, sf_dir).select(
        "departure_month", "departure_weekday_short", "departure_weekday_full", "departure_date", "search_date",
        "price_rub", "origin", "destination"), "prices")
    lead = stats.lead_time_offers(fact)
    return _round_doubles(stats.price_extremes(
        stats.stats_month(fact), stats.stats_weekday(fact),
        stats.stats_lead_bucket(lead), stats.stats_lead_day(lead)))


@query("box_stats")
def q_box_stats(spark, sf_dir):
    return _round_doubles(stats.box_stats(offer_fact(spark, sf_dir)))


@query("stats_quantiles_exact")
def q_stats_quantiles_exact(spark, sf_dir):
    """Quartiles and outer percentiles of offer prices by weekday, and of a measure of line
    items, nearly all of whose values differ, by return flag; by selection."""
    probs = [0.05, 0.25, 0.5, 0.75, 0.95]
    fact = offer_fact(spark, sf_dir).filter("departure_weekday_short is not null").select("departure_weekday_short", "price_rub")
    items = read_table(spark, sf_dir, "lineitem").select(
        "l_returnflag", (F.col("l_extendedprice").cast("double") * (F.lit(1.0) + F.col("l_orderkey") / F.lit(1e9))).alias("x"))
    out = None
    for part, df, group, value in (("weekday", _written(fact, "prices"), "departure_weekday_short", "price_rub"),
                                   ("return flag", items, "l_returnflag", "x")):
        found = exact_quantiles(df, group, value, probs).select(
            F.lit(part).alias("part"), F.col(group).alias("item"), "quantile", "n", r6("value").alias("value"))
        out = found if out is None else out.unionByName(found)
    return out


@query("offers_sample")
def q_offers_sample(spark, sf_dir):
    return stats.offers_sample(offer_fact(spark, sf_dir))


# --- requests, code lists, collection log ------------------------------------

@query("offers_bottom_k")
def q_offers_bottom_k(spark, sf_dir):
    """One hundred offers of each weekday by least hash."""
    return stats.offers_bottom_k(offer_fact(spark, sf_dir)).select(
        "departure_weekday_short", "sample_rank", "doc_id", "link", "price_rub")


def _codes_lines(spark, sf_dir):
    """One text line per order: the city (region) of its customer."""
    o = read_table(spark, sf_dir, "orders").select("o_custkey")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey)
             .join(r, F.col("n_regionkey") == r.r_regionkey).select(F.col("r_name").alias("value")))


@query("code_list")
def q_code_list(spark, sf_dir):
    """The city lines written as a text file and read back with the A3 rules."""
    path = scratch_path(spark, "codes")
    lines = _codes_lines(spark, sf_dir)
    lines.write.text(path)
    return read_code_list(spark, path).distinct()


def _routes(spark, sf_dir):
    return rq.ordered_pairs(offer_rows(spark, sf_dir))


@query("ordered_pairs")
def q_ordered_pairs(spark, sf_dir):
    return _routes(spark, sf_dir)


@query("request_grid")
def q_request_grid(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    start = rq.latest_date(orders.select(F.col("o_orderdate").cast("date").alias("d")), "d")
    return rq.request_grid(_routes(spark, sf_dir), start)


def _validated(spark, sf_dir):
    return rq.validate_requests(request_rows(spark, sf_dir))


@query("validate_requests")
def q_validate_requests(spark, sf_dir):
    v = _validated(spark, sf_dir)
    return v.withColumn("reject_reasons", F.array_join("reject_reasons", ","))


@query("normalize_requests")
def q_normalize_requests(spark, sf_dir):
    v = _validated(spark, sf_dir).filter("is_valid")
    return rq.normalize_requests(v).select("request_id", "query_json")


@query("classify_responses")
def q_classify_responses(spark, sf_dir):
    return rq.classify_responses(event_documents(spark, sf_dir)) \
        .select("doc_id", "event_id", "is_success", "error_message")


@query("log_documents")
def q_log_documents(spark, sf_dir):
    d = event_documents(spark, sf_dir)
    kind = (F.when(F.trim("response").startswith("{"), "object")
            .when(F.trim("response").startswith('"'), "text").otherwise("other"))
    return d.select("doc_id", "event_id", "endpoint", "status_code", "error", "created_at",
                    "updated_at", "batch_started_at", kind.alias("response_kind"),
                    json_len("response").alias("n_offers"))


@query("batch_summary")
def q_batch_summary(spark, sf_dir):
    return rq.batch_summary(event_documents(spark, sf_dir))


def _batch_days(spark, sf_dir):
    return event_documents(spark, sf_dir).select(
        F.to_date("batch_started_at").alias("batch_date")).distinct()


@query("month_spine")
def q_month_spine(spark, sf_dir):
    return rq.month_spine(_batch_days(spark, sf_dir), "batch_date")


@query("day_spine")
def q_day_spine(spark, sf_dir):
    return rq.day_spine(_batch_days(spark, sf_dir), "batch_date")


# --- SCD2 / watermarks -------------------------------------------------------

def _history_out(log: DataFrame) -> DataFrame:
    open_ = F.col("valid_to_dttm") == F.lit(SENTINEL).cast("timestamp")
    return log.select("doc_id", "event_id", "valid_from_dttm",
                      F.when(~open_, F.col("valid_to_dttm")).alias("valid_to_dttm"),
                      open_.alias("is_current"))


@query("scd2_history")
def q_scd2_history(spark, sf_dir):
    return _history_out(event_log(spark, sf_dir))


@query("scd2_intervals")
def q_scd2_intervals(spark, sf_dir):
    """Overlaps, gaps and keys without one open version in the event log, some of whose ends
    are moved."""
    end, start, n = F.col("valid_to_dttm"), F.col("valid_from_dttm"), F.col("event_id")
    sentinel = F.lit(SENTINEL).cast("timestamp")
    moved = (F.when((end == sentinel) & (n % 19 == 0), start + F.expr("interval 1 day"))
              .when(end == sentinel, end)
              .when(n % 13 == 0, end + F.expr("interval 30 hours"))
              .when(n % 17 == 0, end - F.expr("interval 1 hour"))
              .when(n % 23 == 0, sentinel).otherwise(end))
    return interval_faults(event_log(spark, sf_dir).withColumn("valid_to_dttm", moved))


def _first_half(docs: DataFrame) -> F.Column:
    """Cut time: the first batch day plus 15 days (one scalar, used as a literal)."""
    b0 = docs.agg(F.min("batch_started_at")).first()[0]
    return F.lit(b0).cast("timestamp") + F.expr("interval 15 days")


@query("scan_log_since")
def q_scan_log_since(spark, sf_dir):
    docs = event_documents(spark, sf_dir)
    loaded = docs.filter(F.col("created_at") < _first_half(docs))
    return read_since_table(docs, loaded, "updated_at", "1 day") \
        .select("doc_id", "event_id", "updated_at")


# --- incremental runs (three slices of the event documents) ------------------

N_RUNS = 3
SLICE_DAYS = 10


def run_ts(run_id: int) -> str:
    """Deterministic processing time of run ``run_id``."""
    return f"2026-01-01 {run_id:02d}:00:00"


def event_slices(docs: DataFrame) -> list[DataFrame]:
    """Run r takes documents created before first batch + r*10 days (last run: all)."""
    b0 = F.lit(docs.agg(F.min("batch_started_at")).first()[0]).cast("timestamp")
    out, lo = [], None
    for r in range(1, N_RUNS + 1):
        hi = None if r == N_RUNS else b0 + F.expr(f"interval {SLICE_DAYS * r} days")
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (F.col("created_at") >= lo)
        if hi is not None:
            cond = cond & (F.col("created_at") < hi)
        out.append(docs.filter(cond))
        lo = hi
    return out


def run_event_increments(spark, sf_dir, with_marts: bool = False) -> str:
    root = scratch_path(spark, "runs")
    docs = event_documents(spark, sf_dir)
    for r, batch in enumerate(event_slices(docs), start=1):
        inc.run_increment(spark, root, batch, r, run_ts(r), with_marts=with_marts, loaded_at="created_at")
    return root


@query("scd2_apply")
def q_scd2_apply(spark, sf_dir):
    root = scratch_path(spark, "scd2")
    docs = event_documents(spark, sf_dir)
    for r, batch in enumerate(event_slices(docs), start=1):
        inc.apply_log_batch(spark, root, batch, r)
    return _history_out(inc.read_raw_log(spark, root, extra=["event_id"]))


@query("delete_insert")
def q_delete_insert(spark, sf_dir):
    root = run_event_increments(spark, sf_dir)
    return inc.read_ods(spark, root).select(*ODS_COLUMNS)


@query("incremental_append")
def q_incremental_append(spark, sf_dir):
    root = run_event_increments(spark, sf_dir)
    return spark.read.parquet(f"{root}/fact").select(*FACT_COLUMNS, "run_id")


@query("latest_append")
def q_latest_append(spark, sf_dir):
    root = run_event_increments(spark, sf_dir)
    return inc.read_latest(spark, root, "append").select(*FACT_COLUMNS, "rn", "run_id")


@query("latest_upsert")
def q_latest_upsert(spark, sf_dir):
    root = run_event_increments(spark, sf_dir)
    return inc.read_latest(spark, root, "upsert").select(*FACT_COLUMNS, "rn")


@query("marts_increment")
def q_marts_increment(spark, sf_dir):
    """Mean price per search day, departure day and route, from the partial sums of three
    runs, the first two compacted."""
    root = scratch_path(spark, "marts")
    for r, batch in enumerate(event_slices(event_documents(spark, sf_dir)), start=1):
        inc.run_increment(spark, root, batch, r, run_ts(r), loaded_at="created_at", with_checks=False)
        if r == 2:
            inc.compact(spark, root, vacuum=True)
    return _round_doubles(inc.read_table_model(spark, root, "agg_search_dep_route"))


@query("stats_increment")
def q_stats_increment(spark, sf_dir):
    """Monthly and lead-time price statistics from the states of three runs, the first two
    compacted."""
    root = scratch_path(spark, "stats")
    for r, batch in enumerate(event_slices(event_documents(spark, sf_dir)), start=1):
        inc.run_increment(spark, root, batch, r, run_ts(r), loaded_at="created_at", with_marts=False)
        stat_states.write_state(spark, root, r)
        if r == 2:
            inc.compact(spark, root, vacuum=True)
    states = stat_states.read_states(spark, root)
    none = F.lit(None).cast("int")
    month = stat_states.stats_month(states).select(
        F.lit("month").alias("part"), F.col("departure_month").cast("string").alias("item"), F.col("ticket_count").alias("n"),
        r6("avg_price").alias("avg_price"), "min_price", "max_price", r6("price_stddev").alias("price_stddev"))
    year = stat_states.stats_month_of_year(states).select(
        F.lit("month of year").alias("part"), F.col("month_num").cast("string").alias("item"), F.col("ticket_count").alias("n"),
        r6("avg_price").alias("avg_price"), "min_price", "max_price", r6("price_stddev").alias("price_stddev"))
    lead = stat_states.stats_lead_bucket(states).select(
        F.lit("lead").alias("part"), F.col("days_range").alias("item"), F.col("n_offers").alias("n"),
        r6("mean_price").alias("avg_price"), none.alias("min_price"), none.alias("max_price"), r6("std_price").alias("price_stddev"))
    return month.unionByName(year).unionByName(lead)


@query("late_updates")
def q_late_updates(spark, sf_dir):
    """Raw log, ODS and fact after three runs loaded by run time, where some documents
    land a run late and some are read again with a newer update time."""
    root = scratch_path(spark, "late")
    docs = event_documents(spark, sf_dir)
    b0 = F.lit(docs.agg(F.min("batch_started_at")).first()[0]).cast("timestamp")
    cut = lambda n: b0 + F.expr(f"interval {SLICE_DAYS * n} days")
    due = F.when(F.col("created_at") < cut(1), 1).when(F.col("created_at") < cut(2), 2).otherwise(3)
    late = F.when(F.col("event_id") % 11 == 0, 1).otherwise(0)
    landed = docs.withColumn("run", F.least(F.lit(N_RUNS), due + late)).unionByName(
        docs.filter(F.col("event_id") % 7 == 0)
            .withColumn("run", F.least(F.lit(N_RUNS), due + 1))
            .withColumn("updated_at", F.col("updated_at") + F.expr("interval 1 hour"))
            .withColumn("status_code", F.lit(203)))
    for r in range(1, N_RUNS + 1):
        inc.run_increment(spark, root, landed.filter(F.col("run") == r).drop("run"), r, run_ts(r),
                          with_marts=False)
    return _loaded_models(spark, root)


def _loaded_models(spark, root: str) -> DataFrame:
    """Raw log, ODS and fact side by side."""
    none = F.lit(None)
    open_ = F.col("valid_to_dttm") == F.lit(SENTINEL).cast("timestamp")
    raw = inc.read_raw_log(spark, root, extra=["event_id"]).select(
        F.lit("raw").alias("model"), "doc_id", none.cast("string").alias("link"),
        none.cast("int").alias("price_rub"), "status_code", F.col("valid_from_dttm").alias("loaded_at"),
        F.when(~open_, F.col("valid_to_dttm")).alias("closed_at"))
    for model, rows in (("ods", inc.read_ods(spark, root)), ("fact", spark.read.parquet(f"{root}/fact"))):
        raw = raw.unionByName(rows.select(
            F.lit(model).alias("model"), "doc_id", "link", "price_rub", "status_code",
            F.col("processed_src_dttm").alias("loaded_at"), none.cast("timestamp").alias("closed_at")))
    return raw


def _run_el(spark, sf_dir, faithful: bool) -> str:
    """Three passes of the load loop over a source that shows each pass the documents
    answered by then."""
    root = scratch_path(spark, "el")
    docs = event_documents(spark, sf_dir)
    b0 = F.lit(docs.agg(F.min("batch_started_at")).first()[0]).cast("timestamp")
    for r in range(1, N_RUNS + 1):
        seen = docs if r == N_RUNS else docs.filter(
            F.col("updated_at") < b0 + F.expr(f"interval {SLICE_DAYS * r} days"))
        inc.run_el(spark, root, seen, r, run_ts(r), faithful=faithful, with_marts=False)
    return root


@query("scd2_keyed_state")
def q_scd2_keyed_state(spark, sf_dir):
    """Raw log and its keyed state after three runs that read some documents again, some
    unchanged and some with another status; the state is compacted after the second run."""
    root = scratch_path(spark, "keyed")
    docs = event_documents(spark, sf_dir)
    b0 = F.lit(docs.agg(F.min("batch_started_at")).first()[0]).cast("timestamp")
    cut = lambda n: b0 + F.expr(f"interval {SLICE_DAYS * n} days")
    due = F.when(F.col("created_at") < cut(1), 1).when(F.col("created_at") < cut(2), 2).otherwise(3)
    again = docs.filter(F.col("event_id") % 3 == 0).withColumn("run", due + 1).filter("run <= 3")
    landed = docs.withColumn("run", due).unionByName(again.withColumn(
        "status_code", F.when(F.col("event_id") % 2 == 0, 203).otherwise(F.col("status_code"))))
    for r in range(1, N_RUNS + 1):
        inc.run_increment(spark, root, landed.filter(F.col("run") == r).drop("run"), r, run_ts(r), with_marts=False)
        if r == 2:
            inc.compact(spark, root, vacuum=True)
    log = inc.read_raw_log(spark, root, extra=["event_id"]).select(
        F.lit("log").alias("part"), "doc_id", "event_id", F.col("valid_from_dttm").alias("loaded_at"))
    state = keyed_state.newest_versions_of(
        keyed_state.read_state(spark, root, keyed_state.VERSIONS), "doc_id", ["valid_from_dttm", "event_id"])
    return log.unionByName(state.select(
        F.lit("state").alias("part"), "doc_id", "event_id", F.col("valid_from_dttm").alias("loaded_at")))


@query("marts_retract")
def q_marts_retract(spark, sf_dir):
    """The marts that follow the ODS after three runs with late documents and documents read
    again at another price, and the deletion of some; compacted after the second run."""
    root = scratch_path(spark, "retract")
    docs = event_documents(spark, sf_dir)
    b0 = F.lit(docs.agg(F.min("batch_started_at")).first()[0]).cast("timestamp")
    cut = lambda n: b0 + F.expr(f"interval {SLICE_DAYS * n} days")
    due = F.when(F.col("created_at") < cut(1), 1).when(F.col("created_at") < cut(2), 2).otherwise(3)
    late = F.when(F.col("event_id") % 11 == 0, 1).otherwise(0)
    landed = docs.withColumn("run", F.least(F.lit(N_RUNS), due + late)).unionByName(
        docs.filter(F.col("event_id") % 7 == 0)
            .withColumn("run", F.least(F.lit(N_RUNS), due + 1))
            .withColumn("updated_at", F.col("updated_at") + F.expr("interval 1 hour"))
            .withColumn("response", F.regexp_replace("response", r'"price":(\d+)', '"price":1$1')))
    for r in range(1, N_RUNS + 1):
        live_marts.run_live(spark, root, landed.filter(F.col("run") == r).drop("run"), r, run_ts(r))
        if r == 2:
            inc.compact(spark, root, vacuum=True)
    live_marts.delete_documents(spark, root, docs.filter(F.col("event_id") % 29 == 0).select("doc_id"), N_RUNS + 1,
                                run_ts(N_RUNS + 1))
    day = F.lit("")
    rows = [live_marts.read_live(spark, root, "airports").select(
        F.lit("airports").alias("mart"), day.alias("search_date"), day.alias("departure_date"), F.col("airport_code").alias("a"),
        F.col("city_code").alias("b"), F.lit(None).cast("double").alias("avg_price_rub"))]
    for mart, keys in (("agg_route", []), ("agg_dep_route", ["departure_date"]),
                       ("agg_search_dep_route", ["search_date", "departure_date"])):
        rows.append(live_marts.read_live(spark, root, mart).select(
            F.lit(mart).alias("mart"), *[(F.col(c).cast("string") if c in keys else day).alias(c) for c in ("search_date", "departure_date")],
            F.col("origin").alias("a"), F.col("destination").alias("b"), r6("avg_price_rub").alias("avg_price_rub")))
    return functools.reduce(DataFrame.unionByName, rows)


@query("el_lookback")
def q_el_lookback(spark, sf_dir):
    """Raw log, ODS and fact after three passes with a look-back of a day: documents read
    again unchanged make no new version."""
    return _loaded_models(spark, _run_el(spark, sf_dir, faithful=False))


@query("faithful_cascade")
def q_faithful_cascade(spark, sf_dir):
    """The same with every re-read document versioned again: the fact holds its offers
    once per pass that read it."""
    return _loaded_models(spark, _run_el(spark, sf_dir, faithful=True))


@query("el_matched")
def q_el_matched(spark, sf_dir):
    """Documents that each pass matched (D15), from the run table."""
    runs = inc.read_runs(spark, _run_el(spark, sf_dir, faithful=False))
    return runs.select("run_id", F.col("load_time").alias("loaded_at"), "n_docs")


# --- data quality ---------------------------------------------------------------

def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _offer_models(spark, sf_dir) -> dict[str, DataFrame]:
    """All models, the document build, the parse and the marts' sums done once (as in the
    full refresh)."""
    stg = _written(offer_stage(spark, sf_dir), "stg")
    ods = _written(ods_flatten(stg, processed_at=RUN_TS), "ods")
    fact = fact_offers(ods)
    return {"stg": stg, "ods": ods, "fact": fact, "latest": marts.first_offer(fact),
            **marts.from_sums(_written(marts.route_sums(fact), "sums")), "airports": marts.airports(fact)}


@query("dq_not_null")
def q_dq_not_null(spark, sf_dir):
    models = _offer_models(spark, sf_dir)
    return dq.dq_report(*checks.column_checks(models)).filter("test = 'not_null'")


@query("dq_unique")
def q_dq_unique(spark, sf_dir):
    return dq.unique(offer_stage(spark, sf_dir), "stg_ticket_offers", "doc_id")


@query("dq_relationships")
def q_dq_relationships(spark, sf_dir):
    fact = offer_fact(spark, sf_dir)
    return dq.relationships(marts.first_offer(fact), fact, "dm_prices_latest", "doc_id")


@query("dq_accepted_range")
def q_dq_accepted_range(spark, sf_dir):
    return dq.accepted_range(offer_fact(spark, sf_dir), "dm_fact_ticket_offers", "price_rub",
                             min_value=0)


@query("dq_freshness")
def q_dq_freshness(spark, sf_dir):
    return dq.freshness(offer_stage(spark, sf_dir), "raw_api_log", "updated_at", RUN_TS)


def metric_source(spark, sf_dir) -> DataFrame:
    """Time-bucket metric table from events: event time, update time
    (``k`` minutes later), one dimension and one numeric column."""
    ev = read_table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    k = F.get_json_object("props", "$.k").cast("int")
    return ev.select(ts.alias("ts"), "event_type", "value", "user_id",
                     (ts + F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(0), k))
                     .alias("updated_ts"))


def _anomaly_out(df: DataFrame) -> DataFrame:
    return df.select("test", "series", "bucket_start", r6("value").alias("value"),
                     r6("training_mean").alias("training_mean"),
                     r6("training_stddev").alias("training_stddev"), "training_n",
                     r6("z_score").alias("z_score"), "is_anomalous")


def _anomaly_checks(src: DataFrame, as_of: dict | None = None) -> dict[str, Callable[[], DataFrame]]:
    """Builders of the six checks; ``as_of``: newest time by column, if known."""
    newest = as_of or {}
    at = lambda column: {"as_of": newest.get(column)}
    return {
        "dq_volume": lambda: an.volume_anomalies(
            src, "ts", period="12 hours", detection_period="14 days", detection_delay="12 hours", **at("ts")),
        "dq_freshness_anomaly": lambda: an.freshness_anomalies(
            src, "updated_ts", period="12 hours", detection_period="7 days", detection_delay="12 hours",
            **at("updated_ts")),
        "dq_event_freshness": lambda: an.event_freshness_anomalies(
            src, "ts", "updated_ts", period="12 hours", detection_delay="12 hours", **at("ts")),
        "dq_dimension": lambda: an.dimension_anomalies(
            src, "ts", ["event_type"], period="12 hours", detection_period="14 days",
            detection_delay="12 hours", **at("ts")),
        "dq_column": lambda: an.column_anomalies(
            src, "ts", ["value"], period="12 hours", detection_period="14 days",
            detection_delay="12 hours", **at("ts")),
        "dq_all_columns": lambda: an.all_columns_anomalies(
            src.select("ts", "event_type", "value", "user_id"), "ts", period="1 day",
            detection_period="14 days", detection_delay=None, **at("ts")),
    }


def _register_anomaly(name: str):
    @query(name)
    def q(spark, sf_dir):
        return _anomaly_out(_anomaly_checks(metric_source(spark, sf_dir))[name]())
    q.__name__ = f"q_{name}"
    return q


for _name in ["dq_volume", "dq_freshness_anomaly", "dq_event_freshness", "dq_dimension",
              "dq_column", "dq_all_columns"]:
    _register_anomaly(_name)


@query("dq_report")
def q_dq_report(spark, sf_dir):
    src = metric_source(spark, sf_dir)
    newest = src.agg(F.max("ts").alias("ts"), F.max("updated_ts").alias("updated_ts")).first().asDict()
    summaries = [an.anomaly_summary(check(), "events") for check in _anomaly_checks(src, newest).values()]
    models = _offer_models(spark, sf_dir)
    return dq.dq_report(*checks.column_checks(models), *checks.table_checks(models, RUN_TS), *summaries)


@query("dq_models")
def q_dq_models(spark, sf_dir):
    """The anomaly checks declared on fact, latest, search and departure marts."""
    models = _offer_models(spark, sf_dir)
    return dq.dq_report(*checks.anomaly_rows({**models, "latest": _written(models["latest"], "latest")}))


@query("dq_incremental")
def q_dq_incremental(spark, sf_dir):
    """The checks after three runs from the states that each run added, compacted after the
    second run; no model is read whole."""
    root = scratch_path(spark, "states")
    for r, batch in enumerate(event_slices(event_documents(spark, sf_dir)), start=1):
        inc.run_increment(spark, root, batch, r, run_ts(r), loaded_at="created_at", with_checks=False)
        check_states.write_states(spark, root, r)
        if r == 2:
            inc.compact(spark, root, vacuum=True)
    return check_states.state_checks(spark, root)


@query("dq_misses")
def q_dq_misses(spark, sf_dir):
    """Event documents without offer rows by reason, and offer fields that do not cast."""
    docs = event_documents(spark, sf_dir)
    return dq.dq_report(dq.reason_counts(unnest_misses(docs), checks.STG, "response", MISS_REASONS),
                        dq.reason_counts(bad_casts(docs), checks.STG, "cast", list(CAST_FIELDS)))


# --- streaming -------------------------------------------------------------------

@query("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    """Landing files of three collector runs streamed as micro-batches; the
    resulting SCD2 history is independent of how files fall into batches."""
    return _history_out(inc.read_raw_log(spark, _stream_events(spark, sf_dir), extra=["event_id"]))


@query("stream_models")
def q_stream_models(spark, sf_dir):
    """ODS and fact written by the stream, one micro-batch per collector run."""
    root = _stream_events(spark, sf_dir)
    keep = ["doc_id", "link", "price_rub", "processed_src_dttm", "processed_at"]
    return inc.read_ods(spark, root).select(F.lit("ods").alias("model"), *keep).unionByName(
        spark.read.parquet(f"{root}/fact").select(F.lit("fact").alias("model"), *keep))


@query("stream_lookback")
def q_stream_lookback(spark, sf_dir):
    """Raw log, ODS and fact of a stream over landing files that hold the last days again;
    it is stopped after two passes and started again for the third. Re-read documents are
    left out by the stream's state alone: the log's change detection is off."""
    root = scratch_path(spark, "lookback")
    landing, docs = f"{root}/landing", event_documents(spark, sf_dir)
    b0 = F.lit(docs.agg(F.min("batch_started_at")).first()[0]).cast("timestamp")
    cut = lambda n, back=0: b0 + F.expr(f"interval {SLICE_DAYS * n - back} days")
    for r in range(1, N_RUNS + 1):
        seen = docs if r == N_RUNS else docs.filter(F.col("updated_at") < cut(r))
        land_documents(seen if r == 1 else seen.filter(F.col("updated_at") >= cut(r - 1, back=3)), landing, files=2)
        if r > 1:
            stream_ingest(spark, landing, root, docs.schema, max_files_per_trigger=2, processed_at=run_ts,
                          lookback="1 day", with_marts=False, detect_changes=False).awaitTermination()
    return _loaded_models(spark, root)


@query("compacted_since")
def q_compacted_since(spark, sf_dir):
    """Versions of the last day in the log, read from its clustered base after compaction."""
    root = scratch_path(spark, "clustered")
    for r, batch in enumerate(event_slices(event_documents(spark, sf_dir)), 1):
        inc.run_increment(spark, root, batch, r, run_ts(r), with_marts=False, loaded_at="created_at")
    inc.compact(spark, root, vacuum=True)
    newest = inc.read_runs_of(spark, f"{root}/raw").agg(F.max("valid_from_dttm")).first()[0]
    since = F.lit(newest).cast("timestamp") - F.expr("interval 1 day")
    return inc.versions_since(spark, root, since).select("doc_id", "event_id", F.col("valid_from_dttm").alias("loaded_at"))


def _stream_events(spark, sf_dir) -> str:
    root = scratch_path(spark, "stream")
    landing = f"{root}/landing"
    docs = event_documents(spark, sf_dir)
    for batch in event_slices(docs):
        land_documents(batch, landing, files=2)
    q = stream_ingest(spark, landing, root, docs.schema, max_files_per_trigger=2,
                      processed_at=run_ts, with_marts=False, loaded_at="created_at")
    q.awaitTermination()
    return root
