"""Check states: what the declared checks need of a model, kept by run and time bucket.

A run adds the states of its own rows; states of several runs merge (counts and sums add
up, bounds by min and max, spread by ``moments``, update times by cells). The checks after
a run read the states only, so their cost follows the buckets, not the rows of a model.

Tables under the state root:

* ``fact_states/run_id=N``    by 12 hours and combination of the watched dimensions: one
  aggregate feeds volume, dimension, column, event freshness, null and range checks
* ``fact_cells/run_id=N``     distinct update times by cell of 0.1 s (gap check)
* ``latest_states/run_id=N``  by day, every column
* ``search_states/run_id=N``, ``dep_states/run_id=N``  by day of the marts. These are
  table models, whose rows change: a run computes the days it touched again, from the mart's
  rows of these days, and the newest run of a day counts.

Defined cases: rows without a time count for the null and range checks and are in no time
bucket; a run that was not taken is caught up with the next one; a run taken again replaces
its own states; a model without rows gives no bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.operators import anomaly as an
from farelake.operators import moments
from farelake.operators import quality as dq
from farelake.plans import checks
from farelake.plans import incremental as inc

#: partial and merging aggregate of each counter of a column
ADD, LEAST, MOST, JOIN = F.sum, F.min, F.max, moments.merged


def _counters(c: str, dtype: T.DataType) -> dict[str, tuple]:
    """name -> (partial aggregate, merge) of a column's state."""
    x = F.col(c)
    out = {f"{c}__nulls": (F.count_if(x.isNull()), ADD)}
    if isinstance(dtype, T.NumericType):
        out |= {f"{c}__min": (F.min(x), LEAST), f"{c}__max": (F.max(x), MOST),
                f"{c}__zeros": (F.count_if(x == 0), ADD), f"{c}__moments": (moments.moments(x), JOIN)}
        if isinstance(dtype, T.IntegralType):
            out[f"{c}__sum"] = (F.sum(x), ADD)  # whole numbers add up exactly
    elif isinstance(dtype, T.StringType):
        n = F.length(x)
        out |= {f"{c}__min_length": (F.min(n), LEAST), f"{c}__max_length": (F.max(n), MOST),
                f"{c}__length": (F.sum(n), ADD), f"{c}__missing": (F.count_if(x.isNull() | (F.trim(x) == "")), ADD)}
    return out


def _metrics(c: str, dtype: T.DataType) -> list[F.Column]:
    """The metrics of ``column_anomalies`` from a merged state."""
    at = lambda name: F.col(f"{c}__{name}")
    known = F.col("rows") - at("nulls")
    nulls = at("nulls").cast("double")
    out = [nulls.alias(f"{c}::null_count"), (nulls / F.col("rows") * 100).alias(f"{c}::null_percent")]
    if isinstance(dtype, T.NumericType):
        average = moments.mean(f"{c}__moments")
        if isinstance(dtype, T.IntegralType):
            average = F.try_divide(at("sum").cast("double"), known)
        out += [at("min").cast("double").alias(f"{c}::min"), at("max").cast("double").alias(f"{c}::max"),
                average.alias(f"{c}::average"), moments.stddev_samp(f"{c}__moments").alias(f"{c}::standard_deviation"),
                at("zeros").cast("double").alias(f"{c}::zero_count")]
    elif isinstance(dtype, T.StringType):
        out += [at("min_length").cast("double").alias(f"{c}::min_length"), at("max_length").cast("double").alias(f"{c}::max_length"),
                F.try_divide(at("length").cast("double"), known).alias(f"{c}::average_length"),
                at("missing").cast("double").alias(f"{c}::missing_count")]
    return out


class ModelState:
    """The state of one model: its time column, bucket length, series and columns."""

    def __init__(self, ts: str, period: str, columns: dict[str, T.DataType], dims: tuple[str, ...] = (),
                 at_least: dict[str, float] | None = None, update_ts: str | None = None):
        self.ts, self.period, self.columns, self.dims = ts, period, columns, list(dims)
        self.at_least, self.update_ts = at_least or {}, update_ts

    def counters(self) -> dict[str, tuple]:
        """name -> (partial aggregate, merge) of everything the state counts."""
        out = {"rows": (F.count(F.lit(1)), ADD), "newest": (F.max(self.ts), MOST)}
        if self.update_ts:
            lag = F.unix_micros(F.col(self.update_ts).cast("timestamp")) - F.unix_micros(F.col(self.ts).cast("timestamp"))
            out["lag"] = (F.max(lag), MOST)
        for c, low in self.at_least.items():
            out[f"{c}__below"] = (F.count_if(F.col(c) < low), ADD)
        for c, dtype in self.columns.items():
            out |= _counters(c, dtype)
        return out

    def of(self, rows: DataFrame) -> DataFrame:
        """State of a model's rows."""
        return rows.withColumn("bucket_start", an.bucket_start(self.ts, self.period)).groupBy("bucket_start", *self.dims).agg(
            *[partial.alias(name) for name, (partial, _) in self.counters().items()])

    def merge(self, states: DataFrame, *keys: str) -> DataFrame:
        """States as one for each combination of the keys (of all, if none is given)."""
        return states.groupBy(*keys).agg(*[merge(name).alias(name) for name, (_, merge) in self.counters().items()])

    def column_metrics(self, states: DataFrame, columns: list[str] | None = None) -> DataFrame:
        """(bucket_start, metric, value) of the columns, from merged states."""
        wide = states.select("bucket_start", *[m for c in (columns or self.columns) for m in _metrics(c, self.columns[c])])
        return wide.unpivot("bucket_start", [c for c in wide.columns if c != "bucket_start"], "metric", "value")


TYPES = {c: t for name, t in (
    ("status_code price_rub duration_min transfers_cnt duration_to_min duration_back_min return_transfers_cnt rn", T.IntegerType()),
    ("doc_id link endpoint currency origin origin_airport destination destination_airport airline flight_number price_bucket "
     "departure_weekday_short departure_weekday_full search_weekday_short search_weekday_full", T.StringType()),
    ("batch_started_at error updated_at processed_src_dttm processed_at req_departure_month departure_at_utc search_date "
     "is_direct departure_date departure_month", T.NullType())) for c in name.split()}
FACT = ModelState("created_at", "12 hours", {"price_rub": T.IntegerType()}, tuple(checks.DIMENSIONS),
                  checks.AT_LEAST["fact"], "processed_src_dttm")
LATEST = ModelState("created_at", "1 day", TYPES)
SEARCH = ModelState("search_date", "1 day", {})
DEP = ModelState("departure_date", "1 day", {"avg_price_rub": T.DoubleType()})
MARTS = {"search_states": (SEARCH, "agg_search_dep_route"), "dep_states": (DEP, "agg_dep_route")}


def _touched(sums: DataFrame, column: str) -> list:
    """Days of a run's rows; as literals they reach the mart's scan. Bounded by the calendar."""
    return [r[0] for r in sums.filter(F.col(column).isNotNull()).select(column).distinct().collect()]


def write_states(spark: SparkSession, root: str, run_id: int) -> None:
    """States of the rows that the fact and the first offers got since the last run taken,
    and of the days of the marts that those runs touched."""
    taken = inc.last_run(spark, root, "states", run_id)
    new = lambda t: inc.read_if_exists(spark, f"{root}/{t}").filter(
        (F.col("run_id") > taken) & (F.col("run_id") <= run_id)).drop("run_id")
    fact = new("fact")
    inc.write_run(FACT.of(fact), f"{root}/fact_states", run_id)
    timed = fact.select("created_at").withColumn("bucket_start", an.bucket_start("created_at", "12 hours"))
    inc.write_run(an.time_cells(timed, "created_at"), f"{root}/fact_cells", run_id)
    inc.write_run(LATEST.of(new("latest")), f"{root}/latest_states", run_id)
    if inc.list_paths(spark, f"{root}/route_sums/run_id=*"):
        sums = new("route_sums")
        for table, (state, mart) in MARTS.items():
            rows = inc.read_table_model(spark, root, mart)
            rows = rows.filter(F.col(state.ts).isin(_touched(sums, state.ts))).withColumn(state.ts, F.col(state.ts).cast("timestamp"))
            inc.write_run(state.of(rows), f"{root}/{table}", run_id)
    inc.set_watermark(spark, root, "states", run_id, fact, "processed_src_dttm")


def newest_days(states: DataFrame) -> DataFrame:
    """The newest run's state of each day."""
    return inc.newest_inserts(states, ["bucket_start"])


def anomaly_checks(spark: SparkSession, root: str) -> list[tuple[str, str | None, DataFrame]]:
    """(model, column, scored buckets) of the declared anomaly checks, from the states."""
    by_dims = inc.read_runs_of(spark, f"{root}/fact_states")
    fact = FACT.merge(by_dims, "bucket_start")
    latest = LATEST.merge(inc.read_runs_of(spark, f"{root}/latest_states"), "bucket_start")
    half = an.cut_of(_newest(by_dims), "12 hours")
    old = lambda rows: an.complete(rows, "12 hours", half)
    values = fact.select("bucket_start", F.col("rows").alias("value"), (F.col("lag") / 1e6).alias("lag"))
    cells = an.merge_cells(old(inc.read_runs_of(spark, f"{root}/fact_cells")))
    out = [
        (checks.FACT, None, an.report(old(values.drop("lag")), [], "volume_anomalies", half, "12 hours", "14 days", missing=0)),
        (checks.FACT, None, an.report(an.gap_values(an.gap_summaries(cells)), [], "freshness_anomalies", half, "12 hours", "7 days")),
        (checks.FACT, None, an.report(old(values.select("bucket_start", F.col("lag").alias("value"))), [],
                                      "event_freshness_anomalies", half, "12 hours", None)),
        (checks.FACT, None, an.report(old(by_dims).groupBy("bucket_start", *FACT.dims).agg(F.sum("rows").alias("value")),
                                      FACT.dims, "dimension_anomalies", half, "12 hours", "14 days", missing=0)),
        (checks.FACT, "price_rub", an.report(FACT.column_metrics(old(fact)), ["metric"], "column_anomalies", half, "12 hours", "14 days")),
    ]
    day = an.cut_of(_newest(latest), None)
    out.append((checks.LATEST, None, an.report(LATEST.column_metrics(an.complete(latest, "1 day", day)), ["metric"],
                                               "all_columns_anomalies", day, "1 day", "14 days")))
    if inc.path_exists(spark, f"{root}/search_states"):
        search, dep = (newest_days(inc.read_runs_of(spark, f"{root}/{t}")) for t in MARTS)
        day = an.cut_of(_newest(search), None)
        rows = an.complete(search, "1 day", day).select("bucket_start", F.col("rows").alias("value"))
        out.append((checks.SEARCH, None, an.report(rows, [], "volume_anomalies", day, "1 day", "7 days", missing=0)))
        day = an.cut_of(_newest(dep), None)
        out.append((checks.DEP, "avg_price_rub", an.report(DEP.column_metrics(an.complete(dep, "1 day", day)), ["metric"],
                                                           "column_anomalies", day, "1 day", "7 days")))
    return out


def _newest(states: DataFrame):
    return states.agg(F.max("newest")).first()[0]


def column_checks(spark: SparkSession, root: str) -> DataFrame:
    """The null and range checks (J1, J4) of the fact and the first offers."""
    nulls = lambda c: F.coalesce(F.sum(f"{c}__nulls"), F.lit(0))
    rows = []
    for model, table in (("fact", "fact_states"), ("latest", "latest_states")):
        states = inc.read_runs_of(spark, f"{root}/{table}")
        name, columns = checks.NOT_NULL[model]
        counts = [("not_null", c, severity, nulls(c)) for c, severity in columns.items()]
        counts += [("accepted_range", c, "error", F.coalesce(F.sum(f"{c}__below"), F.lit(0)))
                   for c in checks.AT_LEAST.get(model, {})]
        rows.append(dq.counted_checks(states, name, counts))
    return dq.dq_report(*rows)


def state_checks(spark: SparkSession, root: str) -> DataFrame:
    """Check rows (J1, J4, J6-J12) from the states of all runs; no model is read."""
    return dq.dq_report(column_checks(spark, root), *[
        an.anomaly_summary(found, model, column) for model, column, found in anomaly_checks(spark, root)])


def catch_up(spark: SparkSession, root: str, last: int) -> None:
    """Take the runs up to ``last`` that the states, if there are any, have not taken."""
    if inc.path_exists(spark, f"{root}/fact_states") and inc.last_run(spark, root, "states", last + 1) < last:
        write_states(spark, root, last)


def compact(spark: SparkSession, root: str, last: int, vacuum: bool) -> None:
    """Merge the states of the runs; called by ``incremental.compact``."""
    merges = {"fact_states": lambda rows: FACT.merge(rows, "bucket_start", *FACT.dims), "fact_cells": an.merge_cells,
              "latest_states": lambda rows: LATEST.merge(rows, "bucket_start"),
              "search_states": newest_days, "dep_states": newest_days}
    for table, merge in merges.items():
        if inc.compacted_through(spark, f"{root}/{table}") != last and inc.path_exists(spark, f"{root}/{table}"):
            inc.write_base(merge(inc.read_runs_of(spark, f"{root}/{table}")), root, table, last, vacuum)
