"""Price statistics over the fact table.

All statistics are distributed aggregations. Exact quantiles use
``percentile`` (linear interpolation, equal to ``PERCENTILE_CONT``); its
partial state is a value->count map, so memory per group is bounded by the
number of distinct prices, not by rows. Second-level statistics (rollups,
extremes, smoothing) run on already aggregated, bounded series.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelake.functions.buckets import lead_bucket, lead_bucket_order
from farelake.functions.dates import days_between, weekday_order
from farelake.schemas import LEAD_BIN_LABELS
from farelake.session import scratch_path


# --- D4 / D5 ---------------------------------------------------------------

def stats_month(fact: DataFrame) -> DataFrame:
    """Per departure month: counts, mean, exact median, min, max, sample stddev."""
    return (fact.filter(F.col("departure_month").isNotNull())
                .groupBy("departure_month")
                .agg(F.count(F.lit(1)).alias("ticket_count"),
                     F.avg("price_rub").alias("avg_price"),
                     F.percentile("price_rub", F.lit(0.5)).alias("median_price"),
                     F.min("price_rub").alias("min_price"),
                     F.max("price_rub").alias("max_price"),
                     F.stddev_samp("price_rub").alias("price_stddev"))
                .select("departure_month",
                        F.month("departure_month").alias("month_num"),
                        F.year("departure_month").alias("year"),
                        "ticket_count", "avg_price", "median_price", "min_price", "max_price",
                        "price_stddev")
                .orderBy("departure_month"))


def stats_weekday(fact: DataFrame) -> DataFrame:
    """Per departure weekday: count, mean, median, min, first quartile; week order."""
    q = F.percentile("price_rub", F.array(F.lit(0.25), F.lit(0.5)))
    return (fact.filter(F.col("departure_weekday_short").isNotNull())
                .groupBy("departure_weekday_short", "departure_weekday_full")
                .agg(F.count(F.lit(1)).alias("ticket_count"),
                     F.avg("price_rub").alias("avg_price"),
                     q.alias("q"),
                     F.min("price_rub").alias("min_price"))
                .select("departure_weekday_short", "departure_weekday_full", "ticket_count",
                        "avg_price", F.col("q")[1].alias("median_price"), "min_price",
                        F.col("q")[0].alias("q1_price"),
                        weekday_order("departure_weekday_short").alias("weekday_order"))
                .orderBy("weekday_order"))


# --- B11 / D6 / D7 / E3 ------------------------------------------------------

def lead_time_offers(fact: DataFrame, min_days: int = 0, max_days: int = 365) -> DataFrame:
    """Offers with both dates and a lead time in ``[min_days, max_days]``."""
    days = days_between("departure_date", "search_date")
    return (fact.filter(F.col("departure_date").isNotNull() & F.col("search_date").isNotNull())
                .select("search_date", "departure_date", days.alias("days_before_departure"),
                        "price_rub", "origin", "destination")
                .filter(F.col("days_before_departure").between(min_days, max_days)))


def stats_lead_bucket(lead: DataFrame, include_lowest: bool = False) -> DataFrame:
    """Mean, non-null count and sample std of price per lead-time bin.

    Bins are right-closed, so day 0 is in no bin (unless ``include_lowest``).
    Empty bins are kept (count 0) by a right join onto the bin labels.
    """
    spark = lead.sparkSession
    labels = spark.createDataFrame([(x,) for x in LEAD_BIN_LABELS], "days_range string")
    per = (lead.select(lead_bucket("days_before_departure", include_lowest).alias("days_range"),
                       "price_rub")
               .filter(F.col("days_range").isNotNull())
               .groupBy("days_range")
               .agg(F.avg("price_rub").alias("mean_price"),
                    F.count("price_rub").alias("n_offers"),
                    F.stddev_samp("price_rub").alias("std_price")))
    return (labels.join(per, "days_range", "left")
                  .select("days_range", lead_bucket_order("days_range").alias("bucket_order"),
                          "mean_price", F.coalesce("n_offers", F.lit(0)).alias("n_offers"),
                          "std_price")
                  .orderBy("bucket_order"))


def stats_lead_day(lead: DataFrame) -> DataFrame:
    """Mean price per exact lead day, ascending."""
    return (lead.groupBy("days_before_departure")
                .agg(F.avg("price_rub").alias("avg_price"))
                .orderBy("days_before_departure"))


def gaussian_weights(sigma: float, truncate: float = 4.0) -> tuple[int, float]:
    """Radius and normaliser of a sampled Gaussian kernel."""
    radius = int(truncate * float(sigma) + 0.5)
    norm = sum(math.exp(-0.5 * (k / sigma) ** 2) for k in range(-radius, radius + 1))
    return radius, norm


def smooth_series(series: DataFrame, value: str, order: str, sigma: float = 2.0,
                  group: list[str] | None = None, out: str = "smoothed") -> DataFrame:
    """Gaussian smoothing over row position with mirror ('reflect') edges.

    Each row emits its ``2r+1`` taps with ``explode(sequence)``; a tap's
    position is reflected into ``[0, n)`` (``d c b a | a b c d | d c b a``) and
    joined back on (group, position); weighted sums give the curve. Equi-join
    and aggregation only, partitioned by ``group``; a global series (no group)
    must already be aggregated (e.g. <= 366 lead days). The series is written once:
    its taps, values and positions would each compute it from its source.
    """
    group = list(group or [])
    series = series.select(*group, order, value)
    path = scratch_path(series.sparkSession, "series")
    series.write.parquet(path)
    series = series.sparkSession.read.schema(series.schema).parquet(path)
    radius, norm = gaussian_weights(sigma)
    w_ord = Window.partitionBy(*group).orderBy(order) if group else Window.orderBy(order)
    w_all = Window.partitionBy(*group) if group else Window.partitionBy()
    pos = (series.select(*group, order, value)
                 .withColumn("i", F.row_number().over(w_ord) - 1)
                 .withColumn("n", F.count(F.lit(1)).over(w_all)))
    taps = pos.select(*group, "i", "n", F.explode(F.sequence(F.lit(-radius), F.lit(radius))).alias("k"))
    m = F.pmod(F.col("i") + F.col("k"), 2 * F.col("n"))
    taps = taps.select(*group, "i", F.when(m < F.col("n"), m).otherwise(2 * F.col("n") - 1 - m).alias("j"),
                       (F.exp(-0.5 * F.pow(F.col("k") / F.lit(float(sigma)), 2)) / F.lit(norm)).alias("w"))
    vals = pos.select(*group, F.col("i").alias("j"), F.col(value).alias("v"))
    sm = (taps.join(vals, [*group, "j"])
              .groupBy(*group, "i").agg(F.sum(F.col("w") * F.col("v")).alias(out)))
    return (pos.join(sm, [*group, "i"]).select(*group, order, value, out).orderBy(*group, order))


def smooth_lead_curve(lead: DataFrame, sigma: float = 2.0, by_route: bool = False) -> DataFrame:
    """Smoothed mean-price-by-lead-day curve; ``by_route`` smooths each route."""
    if by_route:
        per_day = lead.groupBy("origin", "destination", "days_before_departure") \
            .agg(F.avg("price_rub").alias("avg_price"))
        return smooth_series(per_day, "avg_price", "days_before_departure", sigma,
                             ["origin", "destination"], "smoothed_price")
    return smooth_series(stats_lead_day(lead), "avg_price", "days_before_departure", sigma,
                         None, "smoothed_price")


# --- D8 / D9 -----------------------------------------------------------------

def month_rollup(monthly: DataFrame) -> DataFrame:
    """Per calendar month over years: mean of monthly means (unweighted), summed
    counts, mean of monthly stddevs (NULLs skipped) (D8)."""
    return (monthly.groupBy("month_num")
                   .agg(F.avg("avg_price").alias("avg_price"),
                        F.sum("ticket_count").alias("ticket_count"),
                        F.avg("price_stddev").alias("price_stddev"))
                   .orderBy("month_num"))


def pivot_month_year(monthly: DataFrame, years: list[int] | None = None) -> DataFrame:
    """Mean monthly price by month_num and year.

    Long form (month_num, year, avg_price), one row per cell that has data; with
    ``years`` the matrix of those years, one column each.
    """
    if years is None:
        return monthly.groupBy("month_num", "year").agg(F.avg("avg_price").alias("avg_price"))
    return monthly.groupBy("month_num").pivot("year", list(years)).agg(F.avg("avg_price"))


# --- D10 / D11 / F3 ----------------------------------------------------------

def cheapest_months(monthly: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` calendar months with the lowest mean of monthly means."""
    return (month_rollup(monthly).filter(F.col("avg_price").isNotNull())
                .orderBy(F.col("avg_price").asc(), F.col("month_num").asc())
                .limit(k).select("month_num", "avg_price"))


def cheapest_weekdays(weekly: DataFrame, k: int = 2) -> DataFrame:
    """The ``k`` departure weekdays with the lowest mean price."""
    return (weekly.filter(F.col("avg_price").isNotNull())
                  .orderBy(F.col("avg_price").asc(), F.col("weekday_order").asc())
                  .limit(k)
                  .select("departure_weekday_short", "departure_weekday_full", "avg_price"))


def _findings(df: DataFrame, *findings) -> DataFrame:
    """Rows (finding, label, value) from one aggregate row."""
    cells = [F.struct(F.lit(name).alias("finding"), label.cast("string").alias("label"),
                      value.cast("double").alias("value")) for name, label, value in findings]
    return df.select(F.inline(F.array(*cells)))


def price_extremes(monthly: DataFrame, weekly: DataFrame, buckets: DataFrame,
                   per_day: DataFrame, window: tuple[int, int] = (30, 60)) -> DataFrame:
    """Arg-min / arg-max findings and spreads as rows ``(finding, label, value)``.

    Ties go to the first in natural order (month number, week order, bin
    order, lead day), as ``idxmin``/``idxmax`` do. Each aggregated series gives
    one row, whose findings are laid out as rows.
    """
    roll = month_rollup(monthly).filter(F.col("avg_price").isNotNull())
    wk = weekly.filter(F.col("avg_price").isNotNull())
    bk = buckets.filter(F.col("mean_price").isNotNull())
    lo, hi = window
    dd = per_day.filter(F.col("days_before_departure").between(lo, hi) & F.col("avg_price").isNotNull())

    def argmin(val, key):
        return F.struct(F.col(val), F.col(key))

    def argmax(val, key):
        return F.struct(F.col(val), -F.col(key))

    m = roll.agg(F.max_by("month_num", argmax("avg_price", "month_num")).alias("hi_m"),
                 F.max("avg_price").alias("hi_v"), F.min("avg_price").alias("lo_v"))
    w = wk.agg(F.min_by("departure_weekday_full", argmin("avg_price", "weekday_order")).alias("best"),
               F.min("avg_price").alias("best_v"),
               F.max_by("departure_weekday_full", argmax("avg_price", "weekday_order")).alias("worst"),
               F.max("avg_price").alias("worst_v"))
    b = bk.agg(F.min_by("days_range", argmin("mean_price", "bucket_order")).alias("best"),
               F.min("mean_price").alias("best_v"),
               F.max_by("days_range", argmax("mean_price", "bucket_order")).alias("worst"),
               F.max("mean_price").alias("worst_v"))
    d = dd.agg(F.min_by("days_before_departure",
                        argmin("avg_price", "days_before_departure")).alias("day"),
               F.min("avg_price").alias("v"))
    c = F.col
    out = _findings(
        m, ("most_expensive_month", c("hi_m"), c("hi_v")),
        ("month_spread", F.lit(None), c("hi_v") - c("lo_v")))
    out = out.unionByName(_findings(
        w, ("best_weekday", c("best"), c("best_v")), ("worst_weekday", c("worst"), c("worst_v")),
        ("weekday_saving", F.lit(None), c("worst_v") - c("best_v")),
        ("weekday_saving_pct", F.lit(None), (c("worst_v") - c("best_v")) / c("worst_v") * 100)))
    out = out.unionByName(_findings(
        b, ("cheapest_lead_bucket", c("best"), c("best_v")),
        ("dearest_lead_bucket", c("worst"), c("worst_v"))))
    out = out.unionByName(_findings(d, ("optimal_lead_day", c("day"), c("v"))))
    return out.filter(F.col("value").isNotNull() | F.col("label").isNotNull())


# --- D14 / F4 ----------------------------------------------------------------

def box_stats(fact: DataFrame, group: str = "departure_weekday_short",
              value: str = "price_rub", whisker: float = 1.5) -> DataFrame:
    """Five-number summary with 1.5*IQR whiskers and outlier count per group.

    The rows are first counted by (group, value) and that table is written once;
    quartiles, whiskers and outliers all come from it, so the source is read a
    single time and no state grows with the rows.
    """
    base = fact.filter(F.col(group).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("c"))
    path = scratch_path(fact.sparkSession, "box")
    base.write.parquet(path)
    base = fact.sparkSession.read.schema(base.schema).parquet(path)
    qs = (base.groupBy(group)
              .agg(F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("c")).alias("q"),
                   F.sum(F.when(F.col(value).isNotNull(), F.col("c")).otherwise(0)).alias("n"),
                   F.min(value).alias("min_value"),
                   F.max(value).alias("max_value"))
              .select(group, "n", "min_value", "max_value",
                      F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"),
                      F.col("q")[2].alias("q3")))
    lo = F.col("q1") - whisker * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + whisker * (F.col("q3") - F.col("q1"))
    v = F.col(value)
    tails = (base.join(qs.select(group, "q1", "q3"), group)
                 .groupBy(group)
                 .agg(F.min(F.when(v >= lo, v)).alias("whisker_low"),
                      F.max(F.when(v <= hi, v)).alias("whisker_high"),
                      F.sum(F.when((v < lo) | (v > hi), F.col("c")).otherwise(0)).alias("outliers")))
    return (qs.join(tails, group)
              .select(group, "n", "min_value", "q1", "median", "q3", "max_value",
                      (F.col("q3") - F.col("q1")).alias("iqr"), "whisker_low", "whisker_high",
                      "outliers"))


def offers_sample(fact: DataFrame, n: int | None = None,
                  order: tuple[str, ...] = ("doc_id", "link")) -> DataFrame:
    """Weekday and price of all offers (F4); ``n`` keeps the first ``n`` in a total order."""
    df = fact.filter(F.col("departure_weekday_short").isNotNull()) \
        .select(*order, "departure_weekday_short", "price_rub")
    if n is None:
        return df
    return df.orderBy(*order).limit(n)


def offers_bottom_k(fact: DataFrame, k: int = 100, stratum: str = "departure_weekday_short") -> DataFrame:
    """Stratified sample: the ``k`` offers of each stratum whose hash of (doc_id, link) is least.

    The same offers under any partitioning. Samples merge: the sample of samples of several
    parts is the sample of all their rows. Ranks over ``k`` fall in a partial group limit
    before the shuffle, so a hot stratum ships at most ``k`` rows a task. Offers without a
    stratum are one; equal offers are ranked each, by price.
    """
    key = F.md5(F.concat_ws("|", F.coalesce("doc_id", F.lit("")), F.coalesce("link", F.lit(""))).cast("binary"))
    w = Window.partitionBy(stratum).orderBy("_hash", F.col("price_rub").asc_nulls_last())
    return (fact.withColumn("_hash", key).withColumn("sample_rank", F.row_number().over(w))
                .filter(F.col("sample_rank") <= k).drop("_hash"))
