"""Exact quantiles by distributed selection.

A quantile between two ranks is a mean of the values at these ranks. Each wanted rank of a
group has a range of values that holds it, at first from the least to the greatest. A round
counts the rows of every range in ``BINS`` equal bins, takes the bin that holds the rank,
and narrows the range to the least and greatest value that occur in it. A rank is found
when both are equal. Bins are summed in the tasks before the shuffle, so a group of any
size, with any number of distinct values, ships ``BINS`` rows a rank and task; no task holds
a group's values.

The least and the greatest value of a range fall into different bins, so each round narrows
every open range; evenly spread values take two or three rounds. The ranges are a written
table between rounds (groups x ranks rows).

Defined cases: nulls, NaN and infinite values are left out; a null group is a group; a group
without values has no row; a quantile outside 0..1 is an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelake.session import scratch_path

BINS = 1024


def _table(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _bin(x: F.Column, lo: F.Column, hi: F.Column) -> F.Column:
    """Number of a value's bin; halves keep the widest range finite."""
    share = F.coalesce(F.try_divide(x / 2 - lo / 2, hi / 2 - lo / 2), F.lit(0.0))
    return F.when(x == hi, BINS - 1).otherwise(F.least(F.lit(BINS - 2), F.floor(share * (BINS - 1)).cast("int")))


def values_at(rows: DataFrame, ranks: DataFrame) -> DataFrame:
    """(_g, rank, value): the value at each rank, counted from 0, of a group's sorted values.
    rows: _g, x; ranks: _g, rank, and the group's least and greatest value lo and hi."""
    open_ = _table(ranks.select("_g", "rank", "lo", "hi", F.lit(0).cast("long").alias("below")), "ranges")
    found = []
    while True:
        found.append(open_.filter("lo = hi").select("_g", "rank", F.col("lo").alias("value")))
        open_ = open_.filter("lo < hi")
        if not open_.limit(1).count():
            return _union(found)
        ranges = open_.withColumnRenamed("_g", "_h")
        hits = rows.join(ranges, F.col("_g").eqNullSafe(F.col("_h")) & F.col("x").between(F.col("lo"), F.col("hi")))
        counts = hits.groupBy("_g", "rank", "below", _bin(F.col("x"), F.col("lo"), F.col("hi")).alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        # One row a bin: at most BINS rows in a window.
        w = Window.partitionBy("_g", "rank").orderBy("bin")
        counts = counts.withColumn("after", F.col("below") + F.sum("n").over(w))
        open_ = _table(counts.filter((F.col("rank") < F.col("after")) & (F.col("rank") >= F.col("after") - F.col("n")))
                       .select("_g", "rank", "lo", "hi", (F.col("after") - F.col("n")).alias("below")), "ranges")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def exact_quantiles(df: DataFrame, group: str, value: str, quantiles: list[float]) -> DataFrame:
    """(group, quantile, n, value): exact quantiles, interpolated between neighbours as
    ``PERCENTILE_CONT`` does, of a numeric column."""
    if any(not 0 <= q <= 1 for q in quantiles):
        raise ValueError(f"quantiles outside 0..1: {quantiles}")
    x = F.col(value).cast("double")
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    # -0.0 and 0.0 are one value.
    rows = df.filter(finite).select(F.col(group).alias("_g"), (x + F.lit(0.0)).alias("x"))
    sizes = _table(rows.groupBy("_g").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")), "sizes")
    at = sizes.select("*", F.explode(F.array(*[F.lit(float(q)) for q in sorted(set(quantiles))])).alias("quantile")) \
        .withColumn("at", F.col("quantile") * (F.col("n") - 1)) \
        .withColumn("left", F.floor("at")).withColumn("right", F.ceil("at"))
    ranks = at.select("_g", "lo", "hi", F.explode(F.array("left", "right")).alias("rank")).distinct()
    values = _table(values_at(rows, ranks), "values").select(F.col("_g").alias("_v"), "rank", "value")
    for side in ("left", "right"):
        one = values.select("_v", F.col("rank").alias("_r"), F.col("value").alias(f"{side}_value"))
        at = at.join(one, F.col("_g").eqNullSafe(F.col("_v")) & (F.col(side) == F.col("_r"))).drop("_v", "_r")
    between = F.col("left_value") + (F.col("right_value") - F.col("left_value")) * (F.col("at") - F.col("left"))
    return at.select(F.col("_g").alias(group), "quantile", "n", between.alias("value"))
