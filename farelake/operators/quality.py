"""Declarative data-quality checks.

Every check returns rows of CHECK_COLUMNS; ``dq_report`` unions them. Checks
never raise: failures are reported, as in the reference where tests do not
block the pipeline.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.operators.scd2 import interval_faults

CHECK_COLUMNS = ["test", "model", "column", "severity", "tags", "failures", "status", "detail"]


def _status(failures: F.Column, severity: str) -> F.Column:
    return F.when(failures == 0, "pass").when(F.lit(severity) == "warn", "warn").otherwise("fail")


def _row(df: DataFrame, test: str, model: str, column, severity: str, failures: F.Column,
         detail=None, tags: str = "dqc") -> DataFrame:
    col = column if isinstance(column, F.Column) else F.lit(column)
    return df.select(
        F.lit(test).alias("test"), F.lit(model).alias("model"), col.cast("string").alias("column"),
        F.lit(severity).alias("severity"), F.lit(tags).alias("tags"),
        failures.cast("long").alias("failures"), _status(failures, severity).alias("status"),
        (detail if detail is not None else F.lit(None)).cast("string").alias("detail"))


def not_null(df: DataFrame, model: str, columns: list[str], severity: str = "error") -> DataFrame:
    """Rows where each column is NULL; one pass for all columns."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counts.unpivot([], columns, "column", "failures")
    return _row(long, "not_null", model, F.col("column"), severity, F.col("failures"))


def column_checks(df: DataFrame, model: str, not_null: dict[str, str] | None = None,
                  at_least: dict[str, float] | None = None) -> DataFrame:
    """All declared column checks of a model from one aggregate.

    not_null: column -> severity; at_least: column -> smallest accepted value.
    """
    counts = [("not_null", c, sev, F.count_if(F.col(c).isNull())) for c, sev in (not_null or {}).items()]
    counts += [("accepted_range", c, "error", F.count_if(F.col(c) < low)) for c, low in (at_least or {}).items()]
    return counted_checks(df, model, counts)


def counted_checks(df: DataFrame, model: str, counts: list[tuple[str, str, str, F.Column]]) -> DataFrame:
    """Check rows from counts of failures, one aggregate of ``df``: (test, column, severity, count)."""
    one = df.agg(*[n.alias(f"_{i}") for i, (*_, n) in enumerate(counts)])
    rows = one.select(F.explode(F.array(*[
        F.struct(F.lit(test).alias("test"), F.lit(c).alias("column"), F.lit(sev).alias("severity"),
                 F.col(f"_{i}").alias("failures")) for i, (test, c, sev, _) in enumerate(counts)])).alias("r")).select("r.*")
    status = F.when(F.col("failures") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail")
    return rows.select("test", F.lit(model).alias("model"), "column", "severity", F.lit("dqc").alias("tags"),
                       F.col("failures").cast("long").alias("failures"), status.alias("status"),
                       F.lit(None).cast("string").alias("detail"))


def reason_counts(misses: DataFrame, model: str, column: str, reasons: list[str], severity: str = "warn") -> DataFrame:
    """One row per known reason: rows of ``misses`` (with a ``reason``) that have it."""
    one = misses.agg(*[F.count_if(F.col("reason") == r).alias(r) for r in reasons])
    return one.select(F.explode(F.array(*[F.struct(F.lit(r).alias("reason"), F.col(r).alias("n")) for r in reasons])).alias("r")) \
        .select(F.concat(F.lit(column + "_"), "r.reason").alias("test"), F.lit(model).alias("model"),
                F.lit(column).alias("column"), F.lit(severity).alias("severity"), F.lit("dqc").alias("tags"),
                F.col("r.n").cast("long").alias("failures"),
                _status(F.col("r.n"), severity).alias("status"), F.lit(None).cast("string").alias("detail"))


def unique(df: DataFrame, model: str, column: str, severity: str = "error") -> DataFrame:
    """Non-null values occurring more than once (J2); counts the duplicated values."""
    dup = (df.filter(F.col(column).isNotNull()).groupBy(column).count()
             .filter(F.col("count") > 1))
    agg = dup.agg(F.count(F.lit(1)).alias("failures"))
    return _row(agg, "unique", model, column, severity, F.col("failures"))


def relationships(child: DataFrame, parent: DataFrame, model: str, column: str,
                  to_field: str | None = None, severity: str = "error") -> DataFrame:
    """Child rows whose non-null key is absent from the parent."""
    to_field = to_field or column
    keys = parent.select(F.col(to_field).alias("_k")).filter(F.col("_k").isNotNull()).distinct()
    orphans = (child.select(F.col(column).alias("_k")).filter(F.col("_k").isNotNull())
                    .join(keys, "_k", "left_anti"))
    agg = orphans.agg(F.count(F.lit(1)).alias("failures"))
    return _row(agg, "relationships", model, column, severity, F.col("failures"))


def intervals(log: DataFrame, model: str, key: str = "doc_id", severity: str = "error") -> DataFrame:
    """Overlaps, gaps, keys without one open version and reversed versions of an SCD2 log."""
    agg = interval_faults(log, key).agg(F.count(F.lit(1)).alias("failures"))
    return _row(agg, "intervals", model, key, severity, F.col("failures"))


def accepted_range(df: DataFrame, model: str, column: str, min_value=None, max_value=None,
                   inclusive: bool = True, severity: str = "error") -> DataFrame:
    """Rows outside ``[min_value, max_value]``; NULL passes."""
    c = F.col(column)
    ok = F.lit(True)
    if min_value is not None:
        ok = ok & ((c >= min_value) if inclusive else (c > min_value))
    if max_value is not None:
        ok = ok & ((c <= max_value) if inclusive else (c < max_value))
    agg = df.agg(F.count_if(~ok).alias("failures"))
    return _row(agg, "accepted_range", model, column, severity, F.col("failures"))


def freshness(df: DataFrame, model: str, loaded_at: str, as_of, warn_after: str = "1 day",
              error_after: str = "2 days") -> DataFrame:
    """Source freshness: age of ``max(loaded_at)`` at ``as_of``.

    Status ``fail`` beyond ``error_after``, ``warn`` beyond ``warn_after``;
    ``detail`` is the age in seconds.
    """
    as_of_c = as_of if isinstance(as_of, F.Column) else F.lit(as_of).cast("timestamp")
    agg = df.agg(F.max(loaded_at).alias("_m"))
    age = F.unix_timestamp(as_of_c) - F.unix_timestamp(F.col("_m"))
    error = (F.col("_m").isNull() | (as_of_c - F.expr(f"interval {error_after}") > F.col("_m")))
    warn = as_of_c - F.expr(f"interval {warn_after}") > F.col("_m")
    out = agg.select(
        F.lit("freshness").alias("test"), F.lit(model).alias("model"),
        F.lit(loaded_at).alias("column"),
        F.when(error, "error").when(warn, "warn").otherwise("none").alias("severity"),
        F.lit("dqc").alias("tags"),
        F.when(error | warn, 1).otherwise(0).cast("long").alias("failures"),
        F.when(error, "fail").when(warn, "warn").otherwise("pass").alias("status"),
        age.cast("string").alias("detail"))
    return out


def dq_report(*checks: DataFrame) -> DataFrame:
    """All check rows in one table."""
    out = None
    for c in checks:
        c = c.select(*CHECK_COLUMNS)
        out = c if out is None else out.unionByName(c)
    return out
