"""SCD2 versioning of the document log.

A version is open while ``valid_to_dttm`` is the sentinel. Closing a version
stamps it with the next version's ``valid_from_dttm`` (same transaction in the
reference, so the two are equal).

Hot documents: a key may hold a large share of all versions. The version
chain is therefore computed per (key, time split) -- ``lead`` inside each
split, plus the first start of the next split from a small per-split table --
so no task has to sort all versions of one key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelake.schemas import SENTINEL

# A re-read document that did not change is equal in every landing column.
CONTENT_COLUMNS = ["endpoint", "request", "response", "status_code", "error", "created_at",
                   "updated_at", "batch_started_at"]


def scd2_history(versions: DataFrame, key: str = "doc_id", valid_from: str = "valid_from_dttm",
                 tie: str | None = "event_id", split: str = "day") -> DataFrame:
    """Stamp ``valid_to_dttm`` on every version: the next version's start, or
    the sentinel for the newest one (E2)."""
    order = [F.col(valid_from).asc()] + ([F.col(tie).asc()] if tie else [])
    part = F.date_trunc(split, F.col(valid_from))
    v = versions.withColumn("_split", part)
    nxt_in = F.lead(valid_from).over(Window.partitionBy(key, "_split").orderBy(*order))
    v = v.withColumn("_next_in", nxt_in)
    starts = (v.groupBy(key, "_split").agg(F.min(valid_from).alias("_first"))
               .withColumn("_next_split",
                           F.lead("_first").over(Window.partitionBy(key).orderBy("_split")))
               .drop("_first"))
    out = v.join(starts, [key, "_split"])
    valid_to = F.coalesce("_next_in", "_next_split", F.lit(SENTINEL).cast("timestamp"))
    cols = [c for c in versions.columns if c != "valid_to_dttm"]
    return out.select(*cols, valid_to.alias("valid_to_dttm"))


def content_hash(cols: list[str] = CONTENT_COLUMNS) -> F.Column:
    """Hash of the content; a null is not the same as an absent neighbour."""
    return F.xxhash64(*[F.col(c) for c in cols], *[F.col(c).isNull() for c in cols])


def newest_versions(df: DataFrame, keys: list[str], tie: str | None = "event_id") -> DataFrame:
    """One row per ``keys``: the one updated last, in a total order."""
    order = [F.desc_nulls_last("updated_at"), F.desc_nulls_last("created_at")]
    if tie:
        order.append(F.desc_nulls_last(tie))
    w = Window.partitionBy(*keys).orderBy(*order, content_hash().desc())
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def interval_faults(log: DataFrame, key: str = "doc_id", valid_from: str = "valid_from_dttm",
                    valid_to: str = "valid_to_dttm", split: str = "day") -> DataFrame:
    """Faults of a version log: (key, kind, from_dttm, to_dttm, n_open). A sound log has none.

    A sweep over the starts (+1) and ends (-1) of versions keeps the running count of open
    ones: more than one is an ``overlap`` until the count changes, none between two versions
    is a ``gap``, and other than one behind a key's last event is ``open`` (no end). A version
    that ends before it starts is ``reversed`` and left out of the sweep.

    The count runs inside each (key, time split), on top of what the key's earlier splits
    come to (a small per-split table), so a hot key is never swept in one task.

    Defined cases: a version without end, or with the sentinel, is open; one that ends where
    it starts holds at no time; versions without key or start are left out.
    """
    sentinel = F.lit(SENTINEL).cast("timestamp")
    versions = log.select(F.col(key).alias("_key"), F.col(valid_from).alias("_from"),
                          F.when(F.col(valid_to) < sentinel, F.col(valid_to)).alias("_to")).filter("_key is not null and _from is not null")
    is_reversed = F.coalesce(F.col("_to") < F.col("_from"), F.lit(False))
    event = F.explode(F.array(F.struct(F.col("_from").alias("at"), F.lit(1).alias("d")),
                              F.struct(F.col("_to").alias("at"), F.lit(-1).alias("d"))))
    points = versions.filter(~is_reversed).select("_key", event.alias("e")).filter("e.at is not null") \
        .groupBy("_key", "e.at").agg(F.sum("e.d").alias("d")).filter("d <> 0").withColumn("_split", F.date_trunc(split, "at"))
    by_split = Window.partitionBy("_key").orderBy("_split")
    splits = points.groupBy("_key", "_split").agg(F.sum("d").alias("_d"), F.min("at").alias("_first")) \
        .select("_key", "_split", F.coalesce(F.sum("_d").over(by_split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
                F.lead("_first").over(by_split).alias("_next"))
    inside = Window.partitionBy("_key", "_split").orderBy("at")
    swept = points.withColumn("_run", F.sum("d").over(inside)).withColumn("_lead", F.lead("at").over(inside)) \
        .join(splits, ["_key", "_split"]) \
        .select("_key", "at", F.coalesce("_lead", "_next").alias("to"), (F.col("_before") + F.col("_run")).alias("n"))
    kind = F.when(F.col("to").isNull(), F.when(F.col("n") != 1, "open")).when(F.col("n") > 1, "overlap").when(F.col("n") == 0, "gap")
    found = swept.withColumn("kind", kind).filter("kind is not null").select(
        F.col("_key").alias(key), "kind", F.col("at").alias("from_dttm"), F.col("to").alias("to_dttm"), F.col("n").alias("n_open"))
    return found.unionByName(versions.filter(is_reversed).select(
        F.col("_key").alias(key), F.lit("reversed").alias("kind"), F.col("_from").alias("from_dttm"),
        F.col("_to").alias("to_dttm"), F.lit(0).cast("long").alias("n_open")))


def drop_unchanged(chain: DataFrame, key: str = "doc_id", valid_from: str = "valid_from_dttm",
                   tie: str | None = "event_id", cols: list[str] = CONTENT_COLUMNS,
                   split: str = "day") -> DataFrame:
    """Drop versions whose content equals the previous version of the same key.

    The previous version is found inside each (key, time split) with ``lag``;
    the first version of a split compares with the last version of the key's
    previous non-empty split (a small per-split table), so a hot key is never
    sorted in one task. Consecutive equal versions collapse to the first.
    """
    order = [F.col(valid_from).asc()] + ([F.col(tie).asc()] if tie else [])
    c = (chain.withColumn("_h", content_hash(cols))
              .withColumn("_split", F.date_trunc(split, F.col(valid_from))))
    c = c.withColumn("_prev", F.lag("_h").over(Window.partitionBy(key, "_split").orderBy(*order)))
    last_key = F.struct(*[F.col(valid_from)] + ([F.col(tie)] if tie else []))
    tails = (c.groupBy(key, "_split").agg(F.max_by("_h", last_key).alias("_last"))
              .withColumn("_prev_split",
                          F.lag("_last").over(Window.partitionBy(key).orderBy("_split")))
              .drop("_last"))
    prev = F.coalesce(F.col("_prev"), F.col("_prev_split"))
    return (c.join(tails, [key, "_split"])
             .filter(prev.isNull() | (F.col("_h") != prev))
             .drop("_h", "_prev", "_prev_split", "_split"))


def scd2_apply(log: DataFrame, batch: DataFrame, key: str = "doc_id",
               valid_from: str = "valid_from_dttm", tie: str | None = "event_id",
               detect_changes: bool = True, now=None) -> DataFrame:
    """Fold one batch of documents into the log (I3); returns the whole new log.

    * the open version of every key in the batch is closed at the first new
      version's start; batch versions chain among themselves; the newest is open;
    * ``now`` (faithful mode) loads every batch row at that instant;
      otherwise a batch row brings its own ``valid_from``;
    * ``detect_changes`` drops a batch version equal in content to the version
      before it (a re-read unchanged document then makes no new version);
    * closed history is passed through untouched (set-based, no per-row upsert).

    The log is referenced three times (closed, touched, untouched), so write
    the result before folding the next batch; ``plans.incremental`` does this
    with staged tables.
    """
    if now is not None:
        batch = batch.withColumn(valid_from, F.lit(now).cast("timestamp"))
    sentinel = F.lit(SENTINEL).cast("timestamp")
    batch = batch.withColumn("valid_to_dttm", sentinel).select(*log.columns)
    is_open = F.col("valid_to_dttm") == sentinel
    closed = log.filter(~is_open)
    open_ = log.filter(is_open)
    keys = batch.select(key).distinct()
    touched = open_.join(keys, key, "left_semi")
    untouched = open_.join(keys, key, "left_anti")
    # Rows loaded at one instant are one version of their key.
    same = [key, valid_from] + ([tie] if tie and now is None else [])
    chain = newest_versions(touched.unionByName(batch), same, tie)
    if detect_changes:
        chain = drop_unchanged(chain, key, valid_from, tie)
    chain = scd2_history(chain, key, valid_from, tie)
    return closed.unionByName(untouched).unionByName(chain)
