"""State kept by key and bucketed by the key's hash, so that a run reads the buckets of its
batch and no others.

Layout under ``{root}/{name}``: ``run_id=N/bucket=B`` holds what run N left for the keys of
bucket B, ``{name}_base/through=N/bucket=B`` what the runs up to N come to. Rows are sorted
by key inside a bucket. The number of buckets is fixed when a root is begun
(``spark.farelake.state.buckets``) and read from the root afterwards.

The buckets of a batch are a list of small numbers, so they go into the plan as literals:
the scan lists and opens the folders of these buckets only (``PartitionFilters``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.session import list_paths, remove_path

BUCKETS = 32  # without a setting; on a cluster some thousands, so that a bucket fits a task


def bucket_count(spark: SparkSession, root: str) -> int:
    """Buckets of a root's state; fixed by the first call on a new root."""
    path = f"{root}/_state_layout"
    known = list_paths(spark, f"{path}/buckets=*")
    if known:
        return int(known[0].rsplit("=", 1)[1])
    n = int(spark.conf.get("spark.farelake.state.buckets", str(BUCKETS)))
    spark.range(0, 1, 1, 1).write.mode("overwrite").parquet(f"{path}/buckets={n}")
    return n


def bucket_of(key: str, n: int) -> F.Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def write_state(rows: DataFrame, root: str, name: str, run_id: int, key: str = "doc_id") -> None:
    """Replace what a run left in the state. One file a bucket: rows of a bucket meet in a
    task, which the number of buckets keeps small."""
    n = bucket_count(rows.sparkSession, root)
    rows.withColumn("bucket", bucket_of(key, n)).repartition("bucket").sortWithinPartitions("bucket", key) \
        .write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/{name}/run_id={run_id}")


def batch_buckets(keys: DataFrame, root: str, key: str = "doc_id") -> list[int]:
    """The buckets that hold the keys: at most as many numbers as there are buckets."""
    n = bucket_count(keys.sparkSession, root)
    return sorted(r[0] for r in keys.select(bucket_of(key, n)).distinct().collect())


def read_state(spark: SparkSession, root: str, name: str, buckets: list[int] | None = None,
               before: int | None = None) -> DataFrame | None:
    """Rows of the newest base and of the runs after it, with ``run_id`` (a base counts as
    the last run it covers); only the given buckets, and runs before ``before``."""
    bases = [p for p in list_paths(spark, f"{root}/{name}_base/through=*/_SUCCESS")]
    through = max((int(p.split("/through=")[1].split("/")[0]) for p in bases), default=None)
    parts = []
    if through is not None and (before is None or through < before):
        parts.append(spark.read.parquet(f"{root}/{name}_base/through={through}").withColumn("run_id", F.lit(through)))
    if list_paths(spark, f"{root}/{name}/run_id=*/bucket=*"):
        runs = spark.read.parquet(f"{root}/{name}")
        if through is not None:
            runs = runs.filter(F.col("run_id") > through)
        if before is not None:
            runs = runs.filter(F.col("run_id") < before)
        parts.append(runs)
    if not parts:
        return None
    if buckets is not None:
        parts = [p.filter(F.col("bucket").isin(buckets)) for p in parts]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def compact_state(spark: SparkSession, root: str, name: str, last: int, merged: DataFrame, key: str = "doc_id",
                  vacuum: bool = False) -> None:
    """Write ``merged`` (what the runs up to ``last`` come to) as the new base."""
    n = bucket_count(spark, root)
    merged.drop("run_id", "bucket").withColumn("bucket", bucket_of(key, n)).repartition("bucket") \
        .sortWithinPartitions("bucket", key).write.mode("overwrite").partitionBy("bucket") \
        .parquet(f"{root}/{name}_base/through={last}")
    if vacuum:
        for path in list_paths(spark, f"{root}/{name}/run_id=*"):
            if int(path.rsplit("=", 1)[1]) <= last:
                remove_path(spark, path)


# --- newest version of every document ----------------------------------------------

VERSIONS = "version_state"


def newest_versions_of(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row a key: the one last in ``order``, then in run_id."""
    columns = [*order, "run_id", "content"]
    return rows.groupBy(key).agg(F.max(F.struct(*columns)).alias("v")).select(
        key, *[F.col("v")[c].alias(c) for c in columns])


def write_versions(spark: SparkSession, root: str, run_id: int, versions: DataFrame, key: str, order: list[str]) -> None:
    """Keep the newest version a run loaded of each of its keys: key, order, content hash."""
    rows = versions.select(key, *order, "content", F.lit(run_id).alias("run_id"))
    write_state(newest_versions_of(rows, key, order).drop("run_id"), root, VERSIONS, run_id, key)


def known_versions(spark: SparkSession, root: str, batch: DataFrame, run_id: int, key: str, order: list[str],
                   log: DataFrame | None = None) -> DataFrame | None:
    """The newest version before ``run_id`` of each of the batch's keys, from the batch's
    buckets. log: rows of a root that was begun without this state; they make it up once."""
    if log is not None and not list_paths(spark, f"{root}/{VERSIONS}*/*=*"):
        old = log.filter(F.col("run_id") < run_id).select(key, *order, "content", "run_id")
        write_state(newest_versions_of(old, key, order).drop("run_id"), root, VERSIONS, 0, key)
    keys = batch.select(key).distinct()
    state = read_state(spark, root, VERSIONS, batch_buckets(keys, root, key), before=run_id)
    if state is None:
        return None
    return newest_versions_of(state.join(keys, key, "left_semi"), key, order)
