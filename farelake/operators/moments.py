"""Mergeable moments: (n, mean, m2) of a column, joined by the parallel-variance rule.

``m2`` is the sum of squared distances from the mean. States of any split of the rows come
together as the state of all rows, without the cancellation of sums of squares.

Defined cases: nulls are left out; a state of no values has n = 0 and no mean; one value
has no sample standard deviation.
"""

from __future__ import annotations

from pyspark.sql import functions as F


def moments(x) -> F.Column:
    """State of a column as an aggregate expression."""
    x = (F.col(x) if isinstance(x, str) else x).cast("double")
    return F.struct(F.count(x).alias("n"), F.coalesce(F.avg(x), F.lit(0.0)).alias("mean"),
                    F.coalesce(F.var_pop(x) * F.count(x), F.lit(0.0)).alias("m2"))


def _join(a: F.Column, b: F.Column) -> F.Column:
    n = a["n"] + b["n"]
    apart = b["mean"] - a["mean"]
    return F.struct(n.alias("n"), (a["mean"] + apart * b["n"] / n).alias("mean"),
                    (a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / n).alias("m2"))


def merged(state: str) -> F.Column:
    """State of all rows of a group of states (one for each run or bucket), as an aggregate
    expression. The states are joined in sorted order, so the result does not depend on
    how Spark splits them."""
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    parts = F.sort_array(F.filter(F.collect_list(state), lambda s: s["n"] > 0))
    return F.aggregate(parts, none, _join)


def mean(state: str) -> F.Column:
    return F.when(F.col(state)["n"] > 0, F.col(state)["mean"])


def stddev_samp(state: str) -> F.Column:
    n = F.col(state)["n"]
    return F.when(n > 1, F.sqrt(F.col(state)["m2"] / F.greatest(n - 1, F.lit(1))))
