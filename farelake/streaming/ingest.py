"""Micro-batch ingest of landing documents with Structured Streaming.

The file source picks up new landing files; each micro-batch runs the same
increment as the batch jobs (SCD2 log -> staging -> ODS -> fact -> latest ->
marts) inside ``foreachBatch``. The streaming checkpoint records which files
are done; a micro-batch is a run of the state root, known by its checkpoint and
epoch, and idempotent (staged, then published by partition overwrite), so a
replayed micro-batch after a failure gives the same tables, and a new checkpoint on
an old root starts new runs. A batch without rows is no run.

Landing folders may hold documents again (the collector reads some of the past again with
each pass). ``lookback`` leaves these out before the increment (``recent_once``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.operators.scd2 import content_hash
from farelake.plans.incremental import next_run_id, run_increment


def recent_once(docs: DataFrame, lookback: str = "1 day", key: str = "doc_id") -> DataFrame:
    """Each document content once, of a stream that may bring it again.

    The watermark is the newest ``updated_at`` so far less the look-back: documents
    updated at or before it are left out, as the load loop's source filter does (the
    watermark counts whole milliseconds). Those after it pass unless the same content of
    the same document passed before. The state holds (document, content hash) until the
    watermark is past its update time by the look-back, so it is bounded by what two
    look-backs bring and does not grow with the log. It is kept in the streaming
    checkpoint and goes on after a restart. Documents without ``updated_at`` cannot be
    placed and are left out.
    """
    known = docs.filter(F.col("updated_at").isNotNull()).withColumn("_content", content_hash())
    return known.withWatermark("updated_at", lookback).dropDuplicatesWithinWatermark([key, "_content"]).drop("_content")


def stream_ingest(spark: SparkSession, source_dir: str, root: str, schema: T.StructType,
                  checkpoint: str | None = None, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None,
                  processed_at: Callable[[int], object] | None = None,
                  available_now: bool = True, lookback: str | None = None, **run_kw):
    """Run the pipeline over landing files as micro-batches; returns the query.

    ``available_now`` processes what is there and stops (scheduled runs);
    otherwise the stream keeps running with the default trigger.
    ``processed_at(run_id)`` gives the run timestamp (default: now). With ``lookback``
    documents that were read before, or are updated too long ago, are left out by the
    stream's own state; the log then needs no change detection (``detect_changes=False``).
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    docs = reader.load(source_dir)
    if lookback:
        docs = recent_once(docs, lookback)
    folder = checkpoint or f"{root}/_stream_checkpoint"

    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        source = f"{folder}#{epoch_id}"
        run_id = next_run_id(batch.sparkSession, root, source)
        ts = processed_at(run_id) if processed_at else None
        run_increment(batch.sparkSession, root, batch, run_id, ts, source=source, skip_empty=True, **run_kw)

    w = docs.writeStream.foreachBatch(each_batch).option("checkpointLocation", folder)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def land_documents(docs: DataFrame, landing_dir: str, files: int | None = None) -> None:
    """Append landing documents as new files (a collector run's drop)."""
    out = docs.repartition(files) if files else docs
    out.write.mode("append").parquet(landing_dir)
