"""Price statistics kept by run (D4, D6, D8): each run adds the states of its own fact rows.

A state holds, by departure month and lead day, the offers, the priced offers, their exact
sum, bounds and moments (``operators.moments``). Monthly and lead-time statistics merge the
states of all runs; no fact row is read again.

Defined cases: offers without a departure day are in no month; offers without a search day,
or bought after departure, count for their month and for no lead time; groups without a
price have no mean; a run taken again replaces its state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.functions.buckets import lead_bucket, lead_bucket_order
from farelake.functions.dates import days_between
from farelake.operators import moments
from farelake.plans import incremental as inc

TABLE = "stat_states"
KEYS = ["departure_month", "days_before_departure"]


def state_of(fact: DataFrame) -> DataFrame:
    """State of fact rows by departure month and lead day."""
    days = days_between("departure_date", "search_date")
    return fact.filter(F.col("departure_month").isNotNull()).withColumn("days_before_departure", days).groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("offers"), F.sum("price_rub").cast("long").alias("total"),
        F.min("price_rub").alias("least"), F.max("price_rub").alias("most"), moments.moments("price_rub").alias("prices"))


def merge(states: DataFrame, *keys) -> DataFrame:
    """States as one for each combination of the keys."""
    return states.groupBy(*keys).agg(
        F.sum("offers").alias("offers"), F.sum("total").alias("total"), F.min("least").alias("least"),
        F.max("most").alias("most"), moments.merged("prices").alias("prices"))


def write_state(spark: SparkSession, root: str, run_id: int) -> None:
    """State of the fact rows since the last run taken."""
    taken = inc.last_run(spark, root, TABLE, run_id)
    fact = inc.read_if_exists(spark, f"{root}/fact").filter((F.col("run_id") > taken) & (F.col("run_id") <= run_id))
    inc.write_run(state_of(fact), f"{root}/{TABLE}", run_id)
    inc.set_watermark(spark, root, TABLE, run_id, fact, "processed_src_dttm")


def _mean() -> F.Column:
    return F.try_divide(F.col("total").cast("double"), F.col("prices.n"))


def stats_month(states: DataFrame) -> DataFrame:
    """Per departure month: offers, mean, bounds and sample deviation of prices."""
    return merge(states, "departure_month").select(
        "departure_month", F.col("offers").alias("ticket_count"), _mean().alias("avg_price"), F.col("least").alias("min_price"),
        F.col("most").alias("max_price"), moments.stddev_samp("prices").alias("price_stddev"))


def stats_month_of_year(states: DataFrame) -> DataFrame:
    """The same over all years by month number."""
    return merge(states.withColumn("month_num", F.month("departure_month")), "month_num").select(
        "month_num", F.col("offers").alias("ticket_count"), _mean().alias("avg_price"), F.col("least").alias("min_price"),
        F.col("most").alias("max_price"), moments.stddev_samp("prices").alias("price_stddev"))


def stats_lead_bucket(states: DataFrame, min_days: int = 0, max_days: int = 365) -> DataFrame:
    """Mean, priced offers and sample deviation per lead-time bin that occurs."""
    rows = states.filter(F.col("days_before_departure").between(min_days, max_days)).withColumn(
        "days_range", lead_bucket("days_before_departure")).filter("days_range is not null")
    return merge(rows, "days_range").select(
        "days_range", lead_bucket_order("days_range").alias("bucket_order"), _mean().alias("mean_price"),
        F.col("prices.n").alias("n_offers"), moments.stddev_samp("prices").alias("std_price"))


def read_states(spark: SparkSession, root: str) -> DataFrame:
    return inc.read_runs_of(spark, f"{root}/{TABLE}")


def catch_up(spark: SparkSession, root: str, last: int) -> None:
    """Take the runs up to ``last`` that the states, if there are any, have not taken."""
    if inc.path_exists(spark, f"{root}/{TABLE}") and inc.last_run(spark, root, TABLE, last + 1) < last:
        write_state(spark, root, last)


def compact(spark: SparkSession, root: str, last: int, vacuum: bool) -> None:
    """Merge the states of the runs; called by ``incremental.compact``."""
    if inc.compacted_through(spark, f"{root}/{TABLE}") != last and inc.path_exists(spark, f"{root}/{TABLE}"):
        inc.write_base(merge(read_states(spark, root), *KEYS), root, TABLE, last, vacuum)
