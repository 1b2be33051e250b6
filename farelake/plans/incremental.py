"""Incremental materialisation on plain parquet (A6, A8-A10, I1-I5 core).

Every run appends; no run rewrites what an earlier one wrote. Layout under a state
root (a folder in the shared checkpoint dir):

* ``raw/run_id=N``      document versions each run loaded; a version is closed by its
  successor, so ``valid_to_dttm`` is told when the log is read
* ``ods/run_id=N``      offers each run inserted; the newest insert of a key counts
* ``fact/run_id=N``     fact rows each run appended
* ``latest/run_id=N``   first offers of each run's new fact rows
* ``route_sums/run_id=N``, ``airport_pairs/run_id=N``  partial aggregates of the marts
* ``version_state/run_id=N/bucket=B``  content hash of the newest version of each key a run
  loaded, by hash bucket (``keyed_state``)
* ``ods_deletes/run_id=N``, ``offer_state``, ``mart_deltas``, ``airport_deltas``, ``live_*``
  deletions and the marts that follow them (``live_marts``)
* ``fact_states``, ``fact_cells``, ``latest_states``, ``search_states``, ``dep_states``  what the
  checks need, by run and time bucket (``check_states``)
* ``stat_states``  price statistics by run, departure month and lead day (``stat_states``)
* ``T_base/through=N``  what the runs up to N come to, written by ``compact``; log, ODS, fact
  and first offers by day of load (``load_day=D``), each file a sorted range of (load time, document)
* ``T/through=N``       table models (marts): whole tables, the newest complete one counts
* ``dq_results/run_id=N``  check results after each run
* ``_marks/step=S/run_id=N``  watermark of each step and run (one row)
* ``_runs/run_id=N``    run table: source, load time, mark of the documents, status

A run reads only what is newer than the watermarks: file statistics prune the rest,
and the newest version among those rows is the newest of all. Running a run again
replaces its own partitions, so a run may stop anywhere and be run again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelake.operators import marts
from farelake.operators import quality as dq
from farelake.operators.fact import fact_offers
from farelake.operators.flatten import ods_flatten, stage_current
from farelake.operators.scd2 import content_hash, scd2_history
from farelake.plans import keyed_state
from farelake.schemas import DEFAULT_ENDPOINT, LOG_SCHEMA, SENTINEL
from farelake.session import list_paths, path_exists, remove_path

LOG_COLUMNS = [f.name for f in LOG_SCHEMA.fields]
VERSION_COLUMNS = [c for c in LOG_COLUMNS if c != "valid_to_dttm"]
ODS_KEYS = ["doc_id", "link"]


# --- tables partitioned by run ---------------------------------------------------

def read_if_exists(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The partitioned table at ``path``; None when it has no partition yet. A known
    schema spares the job that reads it from a file."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path) if list_paths(spark, f"{path}/*=*") else None


def write_run(df: DataFrame, target: str, run_id: int) -> DataFrame:
    """Replace the partition of a run, and nothing else; returns what it holds."""
    path = f"{target}/run_id={run_id}"
    df = df.drop("run_id")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def compacted_through(spark: SparkSession, target: str) -> int | None:
    """The newest run that a complete base of the table covers."""
    runs = [int(p.split("/through=")[1].split("/")[0]) for p in list_paths(spark, f"{target}_base/through=*/_SUCCESS")]
    return max(runs, default=None)


LOAD_DAY = "load_day"


def read_runs_of(spark: SparkSession, target: str, since: F.Column | None = None) -> DataFrame | None:
    """Rows of a table with their ``run_id``: its newest base (as one run) and the runs after it.

    ``since`` (a literal load time) leaves out the base's folders of earlier days; the
    caller's own filter on the time column then prunes files and row groups.
    """
    rows, through = read_if_exists(spark, target), compacted_through(spark, target)
    if through is None:
        return rows
    base = spark.read.parquet(f"{target}_base/through={through}").withColumn("run_id", F.lit(through))
    if LOAD_DAY in base.columns:
        if since is not None:
            base = base.filter(F.col(LOAD_DAY).cast("date") >= F.to_date(since))
        base = base.drop(LOAD_DAY)
    return base if rows is None else base.unionByName(rows.filter(F.col("run_id") > through))


def delete_insert(batch: DataFrame, target: str, run_id: int) -> DataFrame:
    """Delete the rows whose key occurs in the batch, insert all batch rows (A9): the
    batch is appended, ``read_merged`` leaves out what later inserts replaced."""
    return write_run(batch, target, run_id)


def newest_inserts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the newest run of each key. No de-duplication inside a run; a key with a
    null never matches another, so such rows all stay."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    newest = rows.filter(known).groupBy(*keys).agg(F.max("run_id").alias("run_id"))
    return rows.filter(known).join(newest, [*keys, "run_id"], "left_semi").unionByName(rows.filter(~known))


def read_merged(spark: SparkSession, target: str, keys: list[str]) -> DataFrame | None:
    """The table as delete+insert run by run would leave it."""
    rows = read_runs_of(spark, target)
    return None if rows is None else newest_inserts(rows, keys)


def undeleted(spark: SparkSession, root: str, rows: DataFrame) -> DataFrame:
    """ODS rows without those of documents deleted after their insert."""
    deletes = read_if_exists(spark, f"{root}/ods_deletes", "doc_id string, run_id int")
    if deletes is None:
        return rows
    last = deletes.groupBy("doc_id").agg(F.max("run_id").alias("_deleted"))
    return rows.join(last, "doc_id", "left").filter(
        F.col("_deleted").isNull() | (F.col("run_id") > F.col("_deleted"))).drop("_deleted")


def read_ods(spark: SparkSession, root: str) -> DataFrame:
    return newest_inserts(undeleted(spark, root, read_runs_of(spark, f"{root}/ods")), ODS_KEYS)


def read_latest(spark: SparkSession, root: str, mode: str = "append") -> DataFrame:
    """``dm_prices_latest`` (A10).

    * ``append`` (what the reference effectively does): the first offers of every run;
    * ``upsert``: per (departure_date, origin, destination) the first offer over all
      runs -- equal to ranking the whole fact.
    """
    rows = read_runs_of(spark, f"{root}/latest")
    if mode == "append":
        return rows
    if mode != "upsert":
        raise ValueError(f"unknown mode {mode!r}")
    return marts.first_offer(rows.drop("rn", "run_id"))


def write_base(rows: DataFrame, root: str, table: str, last: int, vacuum: bool,
               loaded: str | None = None) -> None:
    """What the runs up to ``last`` come to, as the new base of a table.

    With ``loaded`` (its load time column) the base is clustered: a folder a day, in it
    files that each hold a range of (load time, document), sorted. A load that stamps
    many rows with one instant is cut by document. Rows without a load time have a
    folder of their own, which no read since a time opens.
    """
    spark, rows = rows.sparkSession, rows.drop("run_id")
    path = f"{root}/{table}_base/through={last}"
    if loaded:
        order = [LOAD_DAY, loaded, "doc_id"]
        rows.withColumn(LOAD_DAY, F.to_date(loaded)).repartitionByRange(*order).sortWithinPartitions(*order) \
            .write.mode("overwrite").partitionBy(LOAD_DAY).parquet(path)
    else:
        rows.write.mode("overwrite").parquet(path)
    if vacuum:
        for path in list_paths(spark, f"{root}/{table}/run_id=*"):
            if int(path.rsplit("=", 1)[1]) <= last:
                remove_path(spark, path)


#: Load time of the tables that watermarks read.
CLUSTERED = {"raw": "valid_from_dttm", "ods": "processed_src_dttm", "fact": "processed_src_dttm",
             "latest": "processed_src_dttm"}


def compact(spark: SparkSession, root: str, vacuum: bool = False) -> int | None:
    """Merge what the finished runs left into one base per table; returns the last run.

    A base counts once it is complete; readers then leave out the runs it covers.
    With ``vacuum`` the partitions of these runs are removed (no other job may be
    reading them).
    """
    from farelake.plans import check_states, live_marts, stat_states
    runs = read_runs(spark, root)
    if runs is None:
        return None
    if runs.filter("status <> 'done'").limit(1).count():
        raise ValueError("a run is not finished: run it again before compacting")
    last = runs.agg(F.max("run_id")).first()[0]
    live_marts.catch_up(spark, root, last)  # before the inserts of single runs are gone
    check_states.catch_up(spark, root, last)
    stat_states.catch_up(spark, root, last)
    same = lambda rows: rows
    tables = {"raw": same, "ods": lambda rows: newest_inserts(undeleted(spark, root, rows), ODS_KEYS), "fact": same, "latest": same,
              "route_sums": marts.add_sums, "airport_pairs": lambda rows: rows.drop("run_id").distinct()}
    for table, merge in tables.items():
        target = f"{root}/{table}"
        if compacted_through(spark, target) == last or not path_exists(spark, target):
            continue
        write_base(merge(read_runs_of(spark, target)), root, table, last, vacuum, CLUSTERED.get(table))
    name = keyed_state.VERSIONS
    if compacted_through(spark, f"{root}/{name}") != last and path_exists(spark, f"{root}/{name}"):
        rows = keyed_state.read_state(spark, root, name)
        order = [c for c in rows.columns if c not in ("doc_id", "content", "run_id", "bucket")]
        order.sort(key=lambda c: c != "valid_from_dttm")
        keyed_state.compact_state(spark, root, name, last, keyed_state.newest_versions_of(rows, "doc_id", order), vacuum=vacuum)
    live_marts.compact(spark, root, last, vacuum)
    check_states.compact(spark, root, last, vacuum)
    stat_states.compact(spark, root, last, vacuum)
    return last


# --- whole tables --------------------------------------------------------------------

KEPT_TABLES = 2  # complete copies of a table model; a reader of the one before is not cut off


def write_table(df: DataFrame, root: str, name: str, run_id: int) -> DataFrame:
    """Write a table model (A6) whole. Readers see the old table until the new one is
    complete; a run that stops in between leaves the old one."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{root}/{name}/through={run_id}")
    done = sorted(int(p.split("/through=")[1].split("/")[0]) for p in list_paths(spark, f"{root}/{name}/through=*/_SUCCESS"))
    for old in done[:-KEPT_TABLES]:
        remove_path(spark, f"{root}/{name}/through={old}")
    return read_table_model(spark, root, name)


def read_table_model(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The newest complete table of a table model."""
    done = [int(p.split("/through=")[1].split("/")[0]) for p in list_paths(spark, f"{root}/{name}/through=*/_SUCCESS")]
    return spark.read.parquet(f"{root}/{name}/through={max(done)}")


# --- watermarks --------------------------------------------------------------------

def set_watermark(spark: SparkSession, root: str, step: str, run_id: int, written: DataFrame, column: str) -> None:
    """Keep the maximum of a column over what a run wrote (one row, a partition of its own)."""
    written.agg(F.max(column).alias("watermark")).coalesce(1).write.mode("overwrite") \
        .parquet(f"{root}/_marks/step={step}/run_id={run_id}")


MARK_SCHEMA = "watermark timestamp, step string, run_id int"


def watermark(spark: SparkSession, root: str, step: str, run_id: int) -> F.Column | None:
    """Largest watermark of a step over the other runs as a literal, so it reaches the
    scan and prunes files and row groups (B8, D12); None before the first row."""
    marks = read_if_exists(spark, f"{root}/_marks", MARK_SCHEMA)
    if marks is None:
        return None
    row = marks.filter((F.col("step") == step) & (F.col("run_id") != run_id)) \
        .agg(F.unix_micros(F.max("watermark"))).first()
    return None if row[0] is None else F.timestamp_micros(F.lit(row[0]))


def last_run(spark: SparkSession, root: str, step: str, run_id: int) -> int:
    """The last run before this one that a step has taken; 0 if there is none."""
    marks = read_if_exists(spark, f"{root}/_marks", MARK_SCHEMA)
    if marks is None:
        return 0
    return marks.filter((F.col("step") == step) & (F.col("run_id") < run_id)) \
        .agg(F.coalesce(F.max("run_id"), F.lit(0))).first()[0]


# --- raw SCD2 log ------------------------------------------------------------------

def _tie(rows: DataFrame, tie: str | None) -> list[str]:
    return [tie] if tie and tie in rows.columns else []


def read_raw_log(spark: SparkSession, root: str, extra: list[str] | None = None, key: str = "doc_id",
                 tie: str | None = "event_id") -> DataFrame | None:
    """Whole SCD2 log with ``valid_to_dttm``: each version ends where its successor
    begins. A version loaded twice at the same instant counts as its newer run has it."""
    rows = read_runs_of(spark, f"{root}/raw")
    if rows is None:
        return None
    more = _tie(rows, tie)
    w = Window.partitionBy(key, "valid_from_dttm", *more).orderBy(F.desc("run_id"))
    rows = rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
    log = scd2_history(rows, key, "valid_from_dttm", more[0] if more else None)
    return log.select(*LOG_COLUMNS, *(extra or []))


def versions_since(spark: SparkSession, root: str, since: F.Column) -> DataFrame | None:
    """Versions loaded at ``since`` or later, with their ``run_id``."""
    rows = read_runs_of(spark, f"{root}/raw", since)
    return None if rows is None else rows.filter(F.col("valid_from_dttm") >= since)


def current_versions(spark: SparkSession, root: str, since: F.Column | None = None, key: str = "doc_id",
                     tie: str | None = "event_id") -> DataFrame:
    """Open version of every document (of those loaded at ``since`` or later).

    A document's open version is its newest, so rows before ``since`` are not needed
    to find the ones after it. Rank 1 is kept by a partial group limit before the shuffle.
    """
    rows = versions_since(spark, root, since) if since is not None else read_runs_of(spark, f"{root}/raw")
    w = Window.partitionBy(key).orderBy(F.desc("valid_from_dttm"), *[F.desc_nulls_last(t) for t in _tie(rows, tie)],
                                        F.desc("run_id"))
    return (rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1")
                .withColumn("valid_to_dttm", F.lit(SENTINEL).cast("timestamp")).select(*LOG_COLUMNS))


ROW = "_row"  # number of a row in the staged batch


def stage_batch(docs: DataFrame, path: str) -> DataFrame:
    """The batch as a written table, each document with its number and content hash: what
    decides on a document is read without its texts."""
    rows = docs.withColumn("content", content_hash()).withColumn(ROW, F.monotonically_increasing_id())
    rows.write.mode("overwrite").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def left_out_rows(batch: DataFrame, known: DataFrame | None, same: list[str], key: str, tie: str | None,
                  detect_changes: bool = True) -> DataFrame:
    """Numbers of the staged rows that make no version: all but the newest of those that
    are one version and, with ``detect_changes``, those equal to the version before them.

    Rows are numbers, times and hashes here, shuffled once by (key, day): a hot key is never
    sorted in one task. The last version of a key's earlier day comes from a small table.
    """
    extra = [tie] if tie else []
    rows = batch.select(key, "valid_from_dttm", *extra, "updated_at", "created_at", "content", ROW, F.lit(False).alias("_known"))
    if known is not None:
        rows = rows.unionByName(known.select(key, "valid_from_dttm", *extra, "content", F.lit(True).alias("_known")),
                                allowMissingColumns=True)
    rows = rows.withColumn("_split", F.date_trunc("day", "valid_from_dttm")).repartition(key, "_split")
    order = [F.desc_nulls_last(c) for c in ("updated_at", "created_at", *extra)]
    one = Window.partitionBy(key, "_split", "_known", *[c for c in same if c != key]).orderBy(*order, F.desc("content"))
    rows = rows.withColumn("_double", F.row_number().over(one) > 1)
    if not detect_changes:
        return rows.filter("_double").select(ROW)
    version = [F.col(c).asc() for c in ("valid_from_dttm", *extra)]
    before = F.lag("content").over(Window.partitionBy(key, "_split").orderBy("_double", *version))
    last = F.struct("valid_from_dttm", *extra)
    days = (rows.filter("not _double").groupBy(key, "_split").agg(F.max_by("content", last).alias("_last"))
                .select(F.col(key).alias("_key"), F.col("_split").alias("_day"),
                        F.lag("_last").over(Window.partitionBy(key).orderBy("_split")).alias("_before_day")))
    found = rows.withColumn("_before", before).join(
        days, (F.col(key) == F.col("_key")) & (F.col("_split") == F.col("_day")), "left")
    unchanged = F.col("content") == F.coalesce("_before", "_before_day")
    # Documents without a key or a load time are in no chain of versions.
    out = F.col("_double") | F.col(key).isNull() | F.col("_split").isNull() | F.coalesce(unchanged, F.lit(False))
    return found.filter(~F.col("_known") & out).select(ROW)


def apply_log_batch(spark: SparkSession, root: str, docs: DataFrame, run_id: int,
                    key: str = "doc_id", tie: str | None = "event_id", detect_changes: bool = True,
                    loaded_at: str = "created_at", load_time=None) -> DataFrame:
    """Append the versions that one batch of landing documents brings.

    With ``load_time`` every row of the batch is loaded at that instant: rows of
    one key are one version, the one updated last, and a document that comes late
    or is read again still makes a newer version. Without it the column
    ``loaded_at`` tells each row's load time (replays of a known history, whose
    batches must come in that order). With ``detect_changes`` a version equal to
    the one before it is left out; the newest content hash of the batch's keys comes from
    the keyed state (``keyed_state``), of which only the batch's buckets are read.
    """
    if ROW not in docs.columns:
        stage = f"{root}/_staging/log={run_id}"
        try:
            return apply_log_batch(spark, root, stage_batch(docs, stage), run_id, key, tie, detect_changes, loaded_at, load_time)
        finally:
            remove_path(spark, stage)
    extra = [tie] if tie else []
    start = F.col(loaded_at) if load_time is None else F.lit(load_time).cast("timestamp")
    batch = docs.withColumn("valid_from_dttm", start)
    order = ["valid_from_dttm", *extra]
    newest = None
    if detect_changes:
        log = read_runs_of(spark, f"{root}/raw")
        newest = keyed_state.known_versions(spark, root, batch, run_id, key, order, log)
    same = [key, "valid_from_dttm"] + (extra if load_time is None else [])
    left_out = left_out_rows(batch, newest, same, key, tie, detect_changes)
    # Written first: Spark joins it by its size, so the documents are not shuffled for a few rows.
    path = f"{root}/_staging/left_out={run_id}"
    left_out.write.mode("overwrite").parquet(path)
    batch = batch.join(spark.read.schema(left_out.schema).parquet(path), ROW, "left_anti")
    written = write_run(batch.select(*VERSION_COLUMNS, *extra, "content"), f"{root}/raw", run_id)
    remove_path(spark, path)
    keyed_state.write_versions(spark, root, run_id, written, key, order)
    set_watermark(spark, root, "raw", run_id, written, "updated_at")
    return written


# --- models --------------------------------------------------------------------------

def ods_increment(spark: SparkSession, root: str, run_id: int, processed_at, overlap: str = "1 hour",
                  endpoint: str | None = DEFAULT_ENDPOINT, tie: str | None = "event_id") -> DataFrame:
    """ODS model: take the open versions from ``max(processed_src_dttm) - overlap``
    (inclusive), flatten, then delete+insert on (doc_id, link) (I2, A9)."""
    newest = watermark(spark, root, "ods", run_id)
    since = None if newest is None else newest - F.expr(f"interval {overlap}")
    stg = stage_current(current_versions(spark, root, since, tie=tie), endpoint)
    written = delete_insert(ods_flatten(stg, processed_at=processed_at), f"{root}/ods", run_id)
    set_watermark(spark, root, "ods", run_id, written, "processed_src_dttm")
    return written


def fact_increment(spark: SparkSession, root: str, run_id: int) -> DataFrame:
    """Fact model: append ODS rows strictly newer than the fact watermark.

    Reads the inserts of the runs that the fact has not taken yet: any ODS row newer
    than the watermark is among them, also after a run in which the fact was skipped.
    """
    newest = watermark(spark, root, "fact", run_id)
    taken = last_run(spark, root, "fact", run_id)
    new = spark.read.parquet(f"{root}/ods").filter((F.col("run_id") > taken) & (F.col("run_id") <= run_id))
    if newest is not None:
        new = new.filter(F.col("processed_src_dttm") > newest)
    # A key inserted by several of these runs is in the ODS only as its newest insert.
    # Offers without a link are offers too: the match is null-safe.
    last = (new.groupBy("doc_id", "link").agg(F.max("run_id").alias("_r"))
               .withColumnsRenamed({"doc_id": "_d", "link": "_l"}))
    new = new.join(last, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("link").eqNullSafe(F.col("_l"))
                   & (F.col("run_id") == F.col("_r")), "left_semi")
    written = write_run(fact_offers(new), f"{root}/fact", run_id)
    set_watermark(spark, root, "fact", run_id, written, "processed_src_dttm")
    return written


def latest_increment(spark: SparkSession, root: str, run_id: int) -> DataFrame:
    """``dm_prices_latest``: rank the fact rows newer than the table's watermark and
    append the ``rn = 1`` rows (A10); ``read_latest`` gives either mode."""
    newest = watermark(spark, root, "latest", run_id)
    fact = read_runs_of(spark, f"{root}/fact", newest).filter(F.col("run_id") <= run_id).drop("run_id")
    if newest is not None:
        fact = fact.filter(F.col("processed_src_dttm") > newest)
    written = write_run(marts.first_offer(fact), f"{root}/latest", run_id)
    set_watermark(spark, root, "latest", run_id, written, "processed_src_dttm")
    return written


def refresh_marts(spark: SparkSession, root: str, run_id: int) -> None:
    """Table models (A6) from partial aggregates: a run adds those of its own fact rows
    and reads no older fact row."""
    fact = spark.read.parquet(f"{root}/fact/run_id={run_id}")
    write_run(marts.route_sums(fact), f"{root}/route_sums", run_id)
    write_run(marts.airports(fact), f"{root}/airport_pairs", run_id)
    pairs = read_runs_of(spark, f"{root}/airport_pairs").select("airport_code", "city_code").distinct()
    for name, df in [*marts.from_sums(read_runs_of(spark, f"{root}/route_sums")).items(), ("airports", pairs)]:
        write_table(df, root, name, run_id)


def check_models(spark: SparkSession, root: str, run_id: int, as_of, tie: str | None = "event_id",
                 endpoint: str | None = DEFAULT_ENDPOINT) -> DataFrame:
    """The declared checks on all models after a run, kept as ``dq_results/run_id=N``."""
    from farelake.plans.checks import model_checks
    stg = stage_current(current_versions(spark, root, tie=tie), endpoint)
    models = {"stg": stg, "ods": read_ods(spark, root).drop("run_id"),
              "fact": read_runs_of(spark, f"{root}/fact").drop("run_id"),
              "latest": read_latest(spark, root).drop("run_id"),
              **{m: read_table_model(spark, root, m)
                 for m in ("agg_route", "agg_dep_route", "agg_search_dep_route", "airports")}}
    log = dq.intervals(read_raw_log(spark, root, tie=tie), "raw_api_log")
    return write_run(dq.dq_report(model_checks(models, as_of), log), f"{root}/dq_results", run_id)


def check_run(spark: SparkSession, root: str, run_id: int) -> DataFrame:
    """The checks after a run from the states that runs add (``check_states``); no model is
    read whole. Kept as ``dq_results/run_id=N``."""
    from farelake.plans import check_states
    check_states.write_states(spark, root, run_id)
    return write_run(check_states.state_checks(spark, root), f"{root}/dq_results", run_id)


# --- run table -------------------------------------------------------------------

RUN_SCHEMA = ("source string, load_time timestamp, n_docs long, mark long, status string")


def read_runs(spark: SparkSession, root: str) -> DataFrame | None:
    """One row per run: run_id, source, load_time, n_docs (documents matched), mark, status."""
    return read_if_exists(spark, f"{root}/_runs", f"{RUN_SCHEMA}, run_id int")


def batch_mark(docs: DataFrame) -> tuple[int, int]:
    """(rows, order-free hash) of a batch: tells whether a run id is used for other data."""
    cols = [F.col(c) for c in docs.columns]
    row = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.pmod(F.xxhash64(*cols), F.lit(1 << 40))), F.lit(0))).first()
    return int(row[0]), int(row[1])


def next_run_id(spark: SparkSession, root: str, source: str | None = None) -> int:
    """The run of this source if it has begun before, else a new one."""
    runs = read_runs(spark, root)
    if runs is None:
        return 1
    row = runs.agg(F.max(F.when(F.col("source") == source, F.col("run_id"))), F.max("run_id")).first()
    return int(row[0] if row[0] is not None else row[1] + 1)


def write_run_row(spark: SparkSession, root: str, run_id: int, values: tuple) -> None:
    # A row of literals: no Python worker is started for it.
    fields = [f.split() for f in RUN_SCHEMA.split(", ")]
    row = [F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(values, fields, strict=True)]
    write_run(spark.range(0, 1, 1, 1).select(*row), f"{root}/_runs", run_id)


def begin_run(spark: SparkSession, root: str, run_id: int, mark: tuple[int, int], load_time,
              source: str | None) -> tuple[str, object]:
    """Record a run before it changes anything; (status, load time) of the run.

    An error, since each would lose rows without a sign: a run id used for other
    documents, a run id or load time not beyond those of earlier runs, and a new run
    while an earlier one is not finished.
    """
    runs = read_runs(spark, root)
    if runs is not None:
        row = runs.filter(F.col("run_id") == run_id).first()
        if row is not None:
            if (row["n_docs"], row["mark"]) != mark:
                raise ValueError(f"run {run_id} was used for other documents")
            return row["status"], row["load_time"]
        last = runs.agg(F.max("run_id"), F.max("load_time"),
                        F.min(F.when(F.col("status") != "done", F.col("run_id")))).first()
        if last[2] is not None:
            raise ValueError(f"run {last[2]} is not finished: run it again first")
        if run_id < last[0]:
            raise ValueError(f"run {run_id} comes behind run {last[0]}")
        if load_time is not None and last[1] is not None and load_time <= last[1]:
            raise ValueError(f"run {run_id} loads at {load_time}, at or before {last[1]}")
    write_run_row(spark, root, run_id, (source, load_time, *mark, "started"))
    return "started", load_time


def instant(spark: SparkSession, value):
    """A load time as a Python value (one literal row)."""
    return spark.range(1).select((F.current_timestamp() if value is None else F.lit(value)).cast("timestamp")).first()[0]


def run_increment(spark: SparkSession, root: str, docs: DataFrame, run_id: int, processed_at=None,
                  endpoint: str | None = DEFAULT_ENDPOINT, detect_changes: bool = True, with_marts: bool = True,
                  with_checks: bool | str | None = None, tie: str | None = "event_id", load_time=None,
                  loaded_at: str | None = None, source: str | None = None, skip_empty: bool = False) -> None:
    """One hourly slice end to end: log (I3) -> stg (B1) -> ods (C1, A9) ->
    fact (A8) -> latest (A10) -> marts (A6) -> checks (J12) (I5).

    The batch is loaded at ``load_time`` (default: ``processed_at``, else now), so
    late and re-read documents are newer versions and reach every model. With
    ``loaded_at`` the documents carry their load time in that column instead. A run
    is recorded in the run table with a mark of its documents; running it again is
    a no-op when it was done and goes on otherwise. ``detect_changes=False`` versions
    unchanged documents again and so appends their offers again, as the reference
    does. Checks follow the marts unless ``with_checks`` says otherwise; ``"states"`` takes
    those that follow from check states (``check_run``). With ``skip_empty`` an empty
    batch is no run.
    """
    if loaded_at is None:
        load_time = instant(spark, load_time if load_time is not None else processed_at)
    # The batch is computed once; its mark and its versions come from the written rows.
    stage = f"{root}/_staging/run={run_id}"
    batch = stage_batch(docs, stage)
    mark = batch_mark(batch.select(docs.columns))
    try:
        if skip_empty and not mark[0]:
            return
        status, load_time = begin_run(spark, root, run_id, mark, load_time, source)
        if status == "done":
            return
        if mark[0]:
            run_ts = processed_at if processed_at is not None else load_time
            apply_log_batch(spark, root, batch, run_id, tie=tie, detect_changes=detect_changes,
                            load_time=load_time, **({"loaded_at": loaded_at} if loaded_at else {}))
            ods_increment(spark, root, run_id, run_ts, endpoint=endpoint, tie=tie)
            fact_increment(spark, root, run_id)
            latest_increment(spark, root, run_id)
            if with_marts:
                refresh_marts(spark, root, run_id)
            if with_checks == "states":
                check_run(spark, root, run_id)
            elif with_marts if with_checks is None else with_checks:
                check_models(spark, root, run_id, run_ts if run_ts is not None else F.current_timestamp(), tie, endpoint)
        write_run_row(spark, root, run_id, (source, load_time, *mark, "done"))
    finally:
        remove_path(spark, stage)


def run_el(spark: SparkSession, root: str, source: DataFrame, run_id: int, load_time=None,
           lookback: str = "1 day", faithful: bool = False, **run_kw) -> None:
    """One pass of the load loop: read the source from the log's watermark less a
    look-back (strictly later ``updated_at``), then run the increment (I1, I3, I4).

    Documents updated late, up to ``lookback``, are read again. ``faithful`` makes a
    new version of every re-read document, changed or not, whose offers the fact then
    holds again; by default unchanged ones make none. The run table's ``n_docs`` is
    the count of matched documents (D15).
    """
    newest = watermark(spark, root, "raw", run_id)
    if newest is not None:
        source = source.filter(F.col("updated_at") > newest - F.expr(f"interval {lookback}"))
    run_increment(spark, root, source, run_id, load_time=load_time, processed_at=run_kw.pop("processed_at", load_time),
                  detect_changes=not faithful, **run_kw)
