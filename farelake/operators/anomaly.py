"""Anomaly checks on time-bucketed metrics.

The reference names its checks and parameters but not their algorithm, so
the definition here is ours:

* metric per time bucket (and per series: dimension value, column/metric);
  buckets of a series form a gap-free spine (count-type metrics read 0);
* training = the ``training_buckets`` buckets before each bucket;
* anomalous when ``|x - mean| > sensitivity * stddev_samp``; with zero
  variance, anomalous when ``x != mean``; fewer than ``min_training`` training
  buckets -> not scored;
* ``as_of`` defaults to the newest timestamp; buckets ending after
  ``as_of - detection_delay`` are incomplete and dropped; only buckets that
  start within ``detection_period`` before that cut are reported.

All metrics are aggregates first; the trailing windows run on the aggregated
series (one row per bucket and series), partitioned by series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT_COLUMNS = ["test", "series", "bucket_start", "value", "training_mean", "training_stddev",
                  "training_n", "z_score", "is_anomalous"]


UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def period_seconds(period: str) -> int:
    """Length of a fixed period such as '12 hours' or '1 day' in seconds."""
    n, unit = period.split()
    return int(n) * UNIT_SECONDS[unit.lower().rstrip("s")]


def bucket_start(ts, period: str) -> F.Column:
    """Start of the epoch-aligned bucket of length ``period`` (e.g. '12 hours')."""
    p = period_seconds(period)
    secs = F.unix_seconds((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))
    return F.timestamp_seconds(F.floor(secs / F.lit(p)) * F.lit(p))


def _cut(df: DataFrame, ts: str, as_of, delay: str | None) -> F.Column:
    if as_of is None:  # newest timestamp: one aggregate row, used as a literal
        as_of = df.agg(F.max(ts)).first()[0]
    return cut_of(as_of, delay)


def cut_of(as_of, delay: str | None) -> F.Column:
    """Time up to which buckets are complete: ``as_of`` less the detection delay."""
    as_of_c = as_of if isinstance(as_of, F.Column) else F.lit(as_of).cast("timestamp")
    return as_of_c - F.expr(f"interval {delay}") if delay else as_of_c


def spine(series_first: DataFrame, series: list[str], last, period: str) -> DataFrame:
    """Every bucket from each series' first bucket to ``last`` (generator, no join)."""
    return series_first.select(
        *series, F.explode(F.sequence(F.col("_first"), last, F.expr(f"interval {period}")))
        .alias("bucket_start"))


def score(metrics: DataFrame, series: list[str], training_buckets: int = 14,
          sensitivity: float = 3.0, min_training: int = 3) -> DataFrame:
    """Trailing-window mean / sample stddev and the anomaly flag per row."""
    w = (Window.partitionBy(*series) if series else Window.partitionBy()) \
        .orderBy("bucket_start").rowsBetween(-training_buckets, -1)
    x = F.col("value")
    m, s, n = F.avg(x).over(w), F.stddev_samp(x).over(w), F.count(x).over(w)
    out = metrics.withColumn("training_mean", m).withColumn("training_stddev", s) \
        .withColumn("training_n", n)
    scored = (F.col("training_n") >= min_training) & x.isNotNull()
    dev = F.abs(x - F.col("training_mean"))
    anomalous = F.when(~scored, False).when(
        F.coalesce(F.col("training_stddev"), F.lit(0.0)) > 0,
        dev > F.lit(sensitivity) * F.col("training_stddev")).otherwise(dev > 0)
    z = F.when(scored & (F.col("training_stddev") > 0), (x - F.col("training_mean")) / F.col("training_stddev"))
    return out.withColumn("z_score", z).withColumn("is_anomalous", anomalous)


def _finish(scored: DataFrame, test: str, series: list[str], cut: F.Column,
            detection_period: str | None) -> DataFrame:
    if detection_period:
        scored = scored.filter(F.col("bucket_start") >= cut - F.expr(f"interval {detection_period}"))
    label = (F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("<null>")) for c in series])
             if series else F.lit(""))
    return scored.select(F.lit(test).alias("test"), label.alias("series"), "bucket_start",
                         F.col("value").cast("double").alias("value"), "training_mean",
                         "training_stddev", "training_n", "z_score", "is_anomalous")


def _bucketed(df: DataFrame, ts: str, period: str, cut: F.Column) -> DataFrame:
    """Rows with their bucket; only complete buckets (end <= cut)."""
    b = bucket_start(F.col(ts), period)
    # The plain bound reaches the scan; the bucket's end is what counts.
    return (df.filter(F.col(ts) < cut).withColumn("bucket_start", b)
              .filter(F.col("bucket_start") + F.expr(f"interval {period}") <= cut))


def _last_bucket(cut: F.Column, period: str) -> F.Column:
    """Start of the last complete bucket before ``cut``."""
    return bucket_start(cut - F.expr(f"interval {period}"), period)


def complete(rows: DataFrame, period: str, cut: F.Column) -> DataFrame:
    """Rows of the buckets that end by ``cut``."""
    return rows.filter(F.col("bucket_start") + F.expr(f"interval {period}") <= cut)


def report(metrics: DataFrame, series: list[str], test: str, cut: F.Column, period: str, detection_period: str | None,
           training_buckets: int = 14, sensitivity: float = 3.0, missing=None) -> DataFrame:
    """Scored buckets from metrics (bucket_start, series..., value): each series runs without
    gaps from its first bucket to the last complete one; a bucket without a row reads
    ``missing``."""
    first = metrics.groupBy(*series).agg(F.min("bucket_start").alias("_first"))
    full = spine(first, series, _last_bucket(cut, period), period).join(metrics, ["bucket_start", *series], "left")
    if missing is not None:
        full = full.withColumn("value", F.coalesce("value", F.lit(missing)).cast("double"))
    return _finish(score(full, series, training_buckets, sensitivity), test, series, cut, detection_period)


def count_anomalies(df: DataFrame, ts: str, period: str = "12 hours", dims: list[str] | None = None,
                    training_buckets: int = 14, sensitivity: float = 3.0,
                    detection_period: str | None = "14 days", detection_delay: str | None = "12 hours",
                    as_of=None, test: str = "volume_anomalies") -> DataFrame:
    """Row count per bucket (J6) or per bucket and dimension combination."""
    dims = list(dims or [])
    cut = _cut(df, ts, as_of, detection_delay)
    counts = _bucketed(df, ts, period, cut).groupBy("bucket_start", *dims).agg(F.count(F.lit(1)).alias("value"))
    return report(counts, dims, test, cut, period, detection_period, training_buckets, sensitivity, missing=0)


def volume_anomalies(df: DataFrame, ts: str, **kw) -> DataFrame:
    return count_anomalies(df, ts, dims=None, test="volume_anomalies", **kw)


def dimension_anomalies(df: DataFrame, ts: str, dims: list[str], **kw) -> DataFrame:
    return count_anomalies(df, ts, dims=dims, test="dimension_anomalies", **kw)


# Widths of the cells in which gaps are folded, in microseconds: 0.1 s holds at most 100,000
# distinct times, and each wider cell at most 100 of the ones below.
CELL_MICROS = [100_000, 10_000_000, 600_000_000]


def time_cells(rows: DataFrame, ts: str) -> DataFrame:
    """(bucket_start, cell, times): distinct times in microseconds by cell of 0.1 s. Cells of
    several inputs merge by putting their times together."""
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    return rows.select("bucket_start", t.alias("t")).filter("t is not null") \
        .withColumn("cell", F.floor(F.col("t") / CELL_MICROS[0])) \
        .groupBy("bucket_start", "cell").agg(F.collect_set("t").alias("times"))


def merge_cells(cells: DataFrame) -> DataFrame:
    """Cells of several inputs as one: each cell's distinct times."""
    return cells.groupBy("bucket_start", "cell").agg(F.array_distinct(F.flatten(F.collect_list("times"))).alias("times"))


def _join_gaps(a: F.Column, b: F.Column) -> F.Column:
    """Summary of two neighbouring ranges, a before b: associative."""
    return F.struct(a["first"].alias("first"), b["last"].alias("last"),
                    F.greatest(a["gap"], b["gap"], b["first"] - a["last"]).alias("gap"))


def gap_summaries(cells: DataFrame) -> DataFrame:
    """(bucket_start, first, last, gap) of each bucket's times: its first and last time and the
    largest gap between neighbours, in seconds.

    The times of a cell are sorted alone; the summaries of neighbouring cells are joined in
    wider and wider cells up to the bucket. No group holds more than a cell's times or the
    cells of one wider cell, however the rows fall, and raw rows go through no window.
    """
    times = F.transform(F.sort_array("times"), lambda t: t / 1e6)
    inner = F.array_max(F.zip_with(F.slice(times, 2, F.size(times)), times, lambda b, a: b - a))
    rows = cells.select("bucket_start", "cell", F.struct(
        F.element_at(times, 1).alias("first"), F.element_at(times, -1).alias("last"),
        F.coalesce(inner, F.lit(0.0)).alias("gap")).alias("s"))
    for narrow, wide in zip(CELL_MICROS, [*CELL_MICROS[1:], None], strict=True):
        cell = F.lit(0).cast("long") if wide is None else F.floor(F.col("cell") / (wide // narrow))
        parts = F.sort_array(F.collect_list("s"))
        rows = rows.withColumn("cell", cell).groupBy("bucket_start", "cell").agg(parts.alias("p")).select(
            "bucket_start", "cell", F.aggregate(F.slice("p", 2, F.size("p")), F.get("p", F.lit(0)), _join_gaps).alias("s"))
    return rows.select("bucket_start", "s.first", "s.last", "s.gap")


def gap_values(summaries: DataFrame) -> DataFrame:
    """(bucket_start, value): the largest gap in seconds that ends in a bucket, the one to the
    bucket before (one row a bucket) included."""
    over = F.col("first") - F.lag("last").over(Window.orderBy("bucket_start"))
    return summaries.select("bucket_start", F.greatest("gap", F.coalesce(over, F.lit(0.0))).alias("value"))


def freshness_anomalies(df: DataFrame, ts: str, period: str = "12 hours", training_buckets: int = 14,
                        sensitivity: float = 3.0, detection_period: str | None = "7 days",
                        detection_delay: str | None = "12 hours", as_of=None) -> DataFrame:
    """Longest gap (seconds) between consecutive update times, per bucket of the
    later update (J7). Buckets without updates have no value and are not scored."""
    cut = _cut(df, ts, as_of, detection_delay)
    rows = _bucketed(df.select(ts), ts, period, cut)
    values = gap_values(gap_summaries(time_cells(rows, ts)))
    return report(values, [], "freshness_anomalies", cut, period, detection_period, training_buckets, sensitivity)


def event_freshness_anomalies(df: DataFrame, event_ts: str, update_ts: str,
                              period: str = "12 hours", training_buckets: int = 14,
                              sensitivity: float = 3.0, detection_period: str | None = None,
                              detection_delay: str | None = "12 hours", as_of=None) -> DataFrame:
    """Largest lag (seconds) from event time to update time per event bucket."""
    cut = _cut(df, event_ts, as_of, detection_delay)
    rows = _bucketed(df, event_ts, period, cut)
    lag = (F.unix_micros(F.col(update_ts).cast("timestamp"))
           - F.unix_micros(F.col(event_ts).cast("timestamp"))) / 1e6
    per_bucket = rows.groupBy("bucket_start").agg(F.max(lag).alias("value"))
    return report(per_bucket, [], "event_freshness_anomalies", cut, period, detection_period, training_buckets, sensitivity)


NUMERIC_METRICS = ["min", "max", "average", "standard_deviation", "null_count", "null_percent",
                   "zero_count"]
TEXT_METRICS = ["null_count", "null_percent", "min_length", "max_length", "average_length",
                "missing_count"]


def _column_metrics(c: str, dtype: T.DataType) -> list[F.Column]:
    x = F.col(c)
    nulls = F.count_if(x.isNull()).cast("double")
    pct = nulls / F.count(F.lit(1)) * 100
    if isinstance(dtype, T.NumericType):
        return [F.min(x).cast("double").alias(f"{c}::min"), F.max(x).cast("double").alias(f"{c}::max"),
                F.avg(x).alias(f"{c}::average"), F.stddev_samp(x).alias(f"{c}::standard_deviation"),
                nulls.alias(f"{c}::null_count"), pct.alias(f"{c}::null_percent"),
                F.count_if(x == 0).cast("double").alias(f"{c}::zero_count")]
    if isinstance(dtype, T.StringType):
        n = F.length(x)
        return [nulls.alias(f"{c}::null_count"), pct.alias(f"{c}::null_percent"),
                F.min(n).cast("double").alias(f"{c}::min_length"),
                F.max(n).cast("double").alias(f"{c}::max_length"),
                F.avg(n).alias(f"{c}::average_length"),
                F.count_if(x.isNull() | (F.trim(x) == "")).cast("double").alias(f"{c}::missing_count")]
    return [nulls.alias(f"{c}::null_count"), pct.alias(f"{c}::null_percent")]


def column_anomalies(df: DataFrame, ts: str, columns: list[str] | None = None,
                     period: str = "12 hours", training_buckets: int = 14,
                     sensitivity: float = 3.0, detection_period: str | None = "14 days",
                     detection_delay: str | None = "12 hours", as_of=None,
                     test: str = "column_anomalies") -> DataFrame:
    """Column metrics per bucket, one series per (column, metric).

    One wide aggregate computes every metric of every column per bucket;
    ``unpivot`` turns it into (column::metric, value) series for scoring.
    Buckets without rows have no metric values (not scored as zero).
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    columns = [c for c in (columns or [c for c in df.columns if c != ts])]
    cut = _cut(df, ts, as_of, detection_delay)
    rows = _bucketed(df, ts, period, cut)
    aggs = [m for c in columns for m in _column_metrics(c, types[c])]
    wide = rows.groupBy("bucket_start").agg(*aggs)
    names = [c for c in wide.columns if c != "bucket_start"]
    long = wide.unpivot("bucket_start", names, "metric", "value")
    return report(long, ["metric"], test, cut, period, detection_period, training_buckets, sensitivity)


def all_columns_anomalies(df: DataFrame, ts: str, period: str = "1 day", **kw) -> DataFrame:
    return column_anomalies(df, ts, None, period=period, test="all_columns_anomalies", **kw)


def anomaly_summary(results: DataFrame, model: str, column: str | None = None,
                    severity: str = "warn") -> DataFrame:
    """One check row (CHECK_COLUMNS) per anomaly test: anomalous reported buckets."""
    agg = results.groupBy("test").agg(F.count_if("is_anomalous").alias("failures"),
                                      F.count(F.lit(1)).alias("buckets"))
    return agg.select(
        "test", F.lit(model).alias("model"), F.lit(column).cast("string").alias("column"),
        F.lit(severity).alias("severity"), F.lit("dqc").alias("tags"),
        F.col("failures").cast("long").alias("failures"),
        F.when(F.col("failures") == 0, "pass").when(F.lit(severity) == "warn", "warn")
         .otherwise("fail").alias("status"),
        F.concat(F.col("buckets").cast("string"), F.lit(" buckets")).alias("detail"))
