import datetime as dt
import pathlib

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from farelake.operators.scd2 import scd2_apply, scd2_history
from farelake.plans import incremental as inc
from farelake.schemas import DEFAULT_ENDPOINT, SENTINEL
from farelake.session import scratch_path

DOC = ("doc_id string, endpoint string, request string, response string, status_code int, "
       "error boolean, created_at timestamp, updated_at timestamp, batch_started_at timestamp, "
       "event_id long")


def docs(spark, rows):
    out = []
    for key, t, eid, body in rows:
        out.append((key, DEFAULT_ENDPOINT, '{"one_way":"true"}', body, 200, False, t, t,
                    t.replace(hour=0, minute=0, second=0), eid))
    return spark.createDataFrame(out, DOC)


def ts(day, hour=0):
    return dt.datetime(2025, 1, day, hour)


def test_history_across_splits_hot_key(spark):
    rows = [("hot", ts(1, h), h, "{}") for h in range(0, 24, 3)] + \
           [("hot", ts(3, 5), 100, "{}"), ("cold", ts(2, 1), 200, "{}")]
    v = docs(spark, rows).withColumn("valid_from_dttm", F.col("created_at"))
    h = {(r.doc_id, r.event_id): r.valid_to_dttm for r in scd2_history(v).collect()}
    assert h[("hot", 21)] == ts(3, 5)          # closed by the next day's first version
    assert h[("hot", 0)] == ts(1, 3)
    assert h[("hot", 100)] == SENTINEL and h[("cold", 200)] == SENTINEL


def test_apply_fold_equals_history_and_change_detection(spark):
    rows = [("a", ts(1, 1), 1, '{"v":1}'), ("a", ts(1, 2), 2, '{"v":2}'), ("b", ts(1, 3), 3, "{}"),
            ("a", ts(2, 1), 4, '{"v":3}'), ("b", ts(2, 2), 5, "{}"), ("c", ts(3, 1), 6, "{}")]
    all_docs = docs(spark, rows).withColumn("valid_from_dttm", F.col("created_at"))
    expect = {(r.doc_id, r.event_id, r.valid_to_dttm) for r in scd2_history(all_docs).collect()}
    log = scd2_history(all_docs.filter(F.col("event_id") <= 3))
    log = scd2_apply(log, all_docs.filter(F.col("event_id") > 3))
    assert {(r.doc_id, r.event_id, r.valid_to_dttm) for r in log.collect()} == expect
    # re-reading the same open version changes nothing with change detection
    again = scd2_apply(log, all_docs.filter(F.col("event_id") == 6))
    assert again.count() == log.count()


def test_faithful_now_loads_all_at_once(spark):
    all_docs = docs(spark, [("a", ts(1), 1, "{}")]).withColumn("valid_from_dttm", F.col("created_at"))
    log = scd2_history(all_docs)
    now = dt.datetime(2025, 2, 1)
    again = scd2_apply(log, all_docs.drop("valid_from_dttm").withColumn("valid_from_dttm", F.lit(None).cast("timestamp")),
                       detect_changes=False, now=now)
    rows = sorted(again.collect(), key=lambda r: r.valid_from_dttm)
    assert [r.valid_to_dttm for r in rows] == [now, SENTINEL]


def test_delete_insert_duplicates_and_null_keys(spark, tmp_dir):
    target = f"{tmp_dir}/t"
    b1 = spark.createDataFrame([("a", "x", 1), ("a", "y", 1), (None, "z", 1)], "doc_id string, link string, v int")
    inc.delete_insert(b1, target, 1)
    b2 = spark.createDataFrame([("a", "x", 2), ("a", "x", 2), (None, "z", 2)], "doc_id string, link string, v int")
    inc.delete_insert(b2, target, 2)
    merged = lambda: inc.read_merged(spark, target, ["doc_id", "link"])
    got = [(r.doc_id, r.link, r.v) for r in merged().collect()]
    expect = sorted([("a", "x", 2), ("a", "x", 2), ("a", "y", 1), (None, "z", 1), (None, "z", 2)],
                    key=lambda t: (str(t[0]), t[1], t[2]))
    assert sorted(got, key=lambda t: (str(t[0]), t[1], t[2])) == expect
    # a run written again replaces only itself
    inc.delete_insert(b2, target, 2)
    assert merged().count() == 5


def test_run_increment_rerun_is_idempotent(spark):
    root = scratch_path(spark, "test-runs")
    rows = [("a", ts(1, 1), 1, '{"success":true,"data":[{"link":"/e?id=1&search_date=01012025","price":5,"departure_at":"2025-01-02T00:00:00+00:00","origin":"O","destination":"D"}]}'),
            ("b", ts(1, 2), 2, '{"success":true,"data":[{"link":"/e?id=2&search_date=01012025","price":7,"departure_at":"2025-01-02T00:00:00+00:00","origin":"O","destination":"D"}]}')]
    d = docs(spark, rows)
    inc.run_increment(spark, root, d.filter("event_id = 1"), 1, "2026-01-01 01:00:00")
    inc.run_increment(spark, root, d.filter("event_id = 2"), 2, "2026-01-01 02:00:00")
    snap = sorted(tuple(r) for r in spark.read.parquet(f"{root}/fact").select("doc_id", "price_rub", "run_id").collect())
    inc.run_increment(spark, root, d.filter("event_id = 2"), 2, "2026-01-01 02:00:00")
    again = sorted(tuple(r) for r in spark.read.parquet(f"{root}/fact").select("doc_id", "price_rub", "run_id").collect())
    assert snap == again == [("a", 5, 1), ("b", 7, 2)]
    assert inc.read_table_model(spark, root, "agg_route").first().avg_price_rub == 6.0
    hist = inc.read_raw_log(spark, root, extra=["event_id"])
    assert hist.count() == 2


def test_fact_catches_up_after_a_skipped_run(spark):
    body = ('{"success":true,"data":[{"link":"/e?id=%d&search_date=01012025","price":%d,'
            '"departure_at":"2025-01-02T00:00:00+00:00","origin":"O","destination":"D"}]}')
    rows = [("a", ts(1, 1), 1, body % (1, 5)), ("b", ts(1, 2), 2, body % (2, 7)),
            ("a", ts(1, 3), 3, body % (3, 9))]
    d = docs(spark, rows)
    normal, skipped = scratch_path(spark, "t-normal"), scratch_path(spark, "t-skip")
    for r in (1, 2, 3):
        inc.run_increment(spark, normal, d.filter(f"event_id = {r}"), r, f"2026-01-01 0{r}:00:00",
                          with_marts=False)
    for r in (1, 2, 3):
        b = d.filter(f"event_id = {r}")
        if r == 2:  # fact and latest do not run for run 2
            inc.apply_log_batch(spark, skipped, b, r, load_time=f"2026-01-01 0{r}:00:00")
            inc.ods_increment(spark, skipped, r, f"2026-01-01 0{r}:00:00")
        else:
            inc.run_increment(spark, skipped, b, r, f"2026-01-01 0{r}:00:00", with_marts=False)
    # same offers once each; a caught-up row carries the run time of its newest
    # ODS insert (the overlap re-read), as the ODS itself does
    cols = ["doc_id", "link", "price_rub", "processed_src_dttm"]
    a = sorted(tuple(x) for x in spark.read.parquet(f"{normal}/fact").select(*cols).collect())
    b = sorted(tuple(x) for x in spark.read.parquet(f"{skipped}/fact").select(*cols).collect())
    assert a == b and len(a) == 3
    ods_b = inc.read_ods(spark, skipped).filter("doc_id = 'b'").first().processed_at
    fact_b = spark.read.parquet(f"{skipped}/fact").filter("doc_id = 'b'").first().processed_at
    assert ods_b == fact_b


OFFER = ('{"success":true,"data":[{"link":%s,"price":%d,"departure_at":"2025-01-02T00:00:00+00:00",'
         '"origin":"O","destination":"D"}]}')


def raw_docs(spark, rows):
    """rows: (doc_id, created, updated, event_id, response)."""
    return spark.createDataFrame([(k, DEFAULT_ENDPOINT, '{"one_way":"true"}', body, 200, False, c, u, c, e)
                                  for k, c, u, e, body in rows], DOC)


def prices(spark, root, model):
    rows = inc.read_ods(spark, root) if model == "ods" else spark.read.parquet(f"{root}/{model}")
    return sorted((r.doc_id, r.link, r.price_rub) for r in rows.select("doc_id", "link", "price_rub").collect())


def test_late_updated_and_linkless_documents_reach_every_model(spark):
    from farelake.operators.scd2 import interval_faults
    root = scratch_path(spark, "t-late")
    run = lambda r, rows: inc.run_increment(spark, root, raw_docs(spark, rows), r, f"2026-01-01 0{r}:00:00",
                                            with_marts=False)
    run(1, [("a", ts(1, 10), ts(1, 10), 1, OFFER % ('"/x"', 5)), ("n", ts(1, 10), ts(1, 10), 2, OFFER % ("null", 8))])
    run(2, [("b", ts(1, 8), ts(1, 12), 3, OFFER % ('"/y"', 6)),            # called before, answered after run 1
            ("a", ts(1, 10), ts(1, 11), 1, OFFER % ('"/x"', 9)),           # read again, same call, newer answer
            ("a", ts(1, 10), ts(1, 10), 1, OFFER % ('"/x"', 7))])          # an older answer of the same batch
    assert prices(spark, root, "fact") == [("a", "/x", 5), ("a", "/x", 9), ("b", "/y", 6), ("n", None, 8)]
    assert [p for p in prices(spark, root, "ods") if p[1]] == [("a", "/x", 9), ("b", "/y", 6)]
    log = inc.read_raw_log(spark, root, extra=["event_id"])
    assert sorted((r.doc_id, r.valid_from_dttm.hour) for r in log.collect()) == [("a", 1), ("a", 2), ("b", 2), ("n", 1)]
    run(3, [("a", ts(1, 4), ts(1, 4), 9, OFFER % ('"/z"', 1))])            # an older call, loaded last
    assert interval_faults(inc.read_raw_log(spark, root)).count() == 0


def test_run_table_refuses_other_documents_and_takes_empty_batches(spark):
    import pytest
    root = scratch_path(spark, "t-runs")
    one = raw_docs(spark, [("a", ts(1), ts(1), 1, OFFER % ('"/x"', 5))])
    inc.run_increment(spark, root, one.limit(0), 1, "2026-01-01 01:00:00", with_marts=False)  # empty first batch
    inc.run_increment(spark, root, one, 2, "2026-01-01 02:00:00", with_marts=False)
    with pytest.raises(ValueError, match="other documents"):
        inc.run_increment(spark, root, raw_docs(spark, [("b", ts(1), ts(1), 2, "{}")]), 2, "2026-01-01 02:00:00")
    with pytest.raises(ValueError, match="before"):
        inc.run_increment(spark, root, one, 3, "2026-01-01 01:30:00")
    assert inc.next_run_id(spark, root, "other#0") == 3
    assert {r.run_id: r.status for r in inc.read_runs(spark, root).collect()} == {1: "done", 2: "done"}


def test_new_stream_checkpoint_on_an_old_root_loses_nothing(spark, tmp_dir):
    from farelake.streaming.ingest import stream_ingest
    root = scratch_path(spark, "t-stream")
    for n, key in enumerate("ab", 1):
        rows = raw_docs(spark, [(key, ts(n), ts(n), n, OFFER % (f'"/{key}"', n))])
        rows.write.parquet(f"{tmp_dir}/land{n}")
        stream_ingest(spark, f"{tmp_dir}/land{n}", root, rows.schema, checkpoint=f"{tmp_dir}/ckpt{n}",
                      processed_at=lambda r: f"2026-01-01 0{r}:00:00", with_marts=False).awaitTermination()
    assert prices(spark, root, "fact") == [("a", "/a", 1), ("b", "/b", 2)]


def test_unchanged_means_nulls_in_the_same_columns(spark):
    from farelake.operators.scd2 import drop_unchanged
    rows = raw_docs(spark, [("a", ts(1), ts(1), 1, "x"), ("a", ts(1), ts(1), 2, "x")]).withColumn("valid_from_dttm", F.col("created_at"))
    moved = rows.withColumn("updated_at", F.when(F.col("event_id") == 1, F.col("updated_at"))) \
        .withColumn("batch_started_at", F.when(F.col("event_id") == 2, F.col("batch_started_at")))
    assert drop_unchanged(moved).count() == 2 and drop_unchanged(rows).count() == 1


def data_files(root, *tables):
    return {p: p.stat().st_mtime_ns for t in tables for p in pathlib.Path(root.removeprefix("file:"), t).rglob("*.parquet")}


def test_small_batch_rewrites_no_older_file_and_compaction_keeps_every_row(spark):
    root = scratch_path(spark, "t-merge")
    many = [(f"d{i}", ts(1, i % 20), ts(1, i % 20), i, OFFER % (f'"/{i}"', i)) for i in range(40)]
    run = lambda r, rows: inc.run_increment(spark, root, raw_docs(spark, rows), r, f"2026-01-01 0{r}:00:00",
                                            with_checks=False)
    run(1, many)
    tables = ("raw", "ods", "fact", "latest", "route_sums", "airport_pairs")
    before = data_files(root, *tables)
    run(2, [("d3", ts(1, 5), ts(1, 6), 99, OFFER % ('"/3"', 500)), ("new", ts(1), ts(1), 100, OFFER % ('"/n"', 7))])
    after = data_files(root, *tables)
    assert before and before.items() <= after.items() and len(after) > len(before)
    assert spark.read.parquet(f"{root}/raw/run_id=2").count() == 2       # only the batch's versions
    expect = [prices(spark, root, "ods"), sorted(inc.read_latest(spark, root, "upsert").collect()),
              sorted(inc.read_raw_log(spark, root).collect())]
    assert ("d3", "/3", 500) in expect[0] and len(expect[0]) == 41
    assert inc.compact(spark, root, vacuum=True) == 2 and inc.compact(spark, root) == 2
    assert [prices(spark, root, "ods"), sorted(inc.read_latest(spark, root, "upsert").collect()),
            sorted(inc.read_raw_log(spark, root).collect())] == expect
    run(3, [("d4", ts(1, 5), ts(1, 6), 101, OFFER % ('"/4"', 600)), many[5]])                 # on top of the base
    assert ("d4", "/4", 600) in prices(spark, root, "ods") and len(prices(spark, root, "ods")) == 41
    assert inc.read_raw_log(spark, root).count() == 43                   # many[5] is unchanged
    mean = inc.read_table_model(spark, root, "agg_route").first().avg_price_rub
    assert abs(mean - (sum(range(40)) + 500 + 7 + 600) / 43) < 1e-9


def test_load_loop_reads_a_day_back_and_faithful_mode_appends_again(spark):
    at = lambda day, hour, key, eid, n: (key, ts(day, hour), ts(day, hour), eid, OFFER % (f'"/{key}"', n))
    first, late = [at(3, 1, "a", 1, 5), at(3, 2, "b", 2, 6)], [at(2, 12, "c", 3, 7), at(1, 12, "old", 4, 8)]
    for faithful, fact in ((False, [("a", 5), ("b", 6), ("c", 7)]),
                           (True, [("a", 5), ("a", 5), ("b", 6), ("b", 6), ("c", 7)])):
        root = scratch_path(spark, "t-el")
        inc.run_el(spark, root, raw_docs(spark, first), 1, "2026-01-01 01:00:00", faithful=faithful, with_marts=False)
        inc.run_el(spark, root, raw_docs(spark, first + late), 2, "2026-01-01 02:00:00", faithful=faithful, with_marts=False)
        assert sorted((r.doc_id, r.n_docs) for r in inc.read_runs(spark, root).selectExpr("run_id as doc_id", "n_docs").collect()) \
            == [(1, 2), (2, 3)]
        assert [(k, p) for k, _, p in prices(spark, root, "fact")] == fact
        assert [(k, p) for k, _, p in prices(spark, root, "ods")] == [("a", 5), ("b", 6), ("c", 7)]


def test_unfinished_run_is_finished_first(spark):
    import pytest
    root = scratch_path(spark, "t-unfinished")
    one = raw_docs(spark, [("a", ts(1), ts(1), 1, OFFER % ('"/x"', 5))])
    two = raw_docs(spark, [("b", ts(1), ts(1), 2, OFFER % ('"/y"', 6))])
    with pytest.raises(Exception, match="no_such_column"):
        inc.run_increment(spark, root, one, 1, "2026-01-01 01:00:00", loaded_at=None, tie="no_such_column")
    with pytest.raises(ValueError, match="not finished"):
        inc.run_increment(spark, root, two, 2, "2026-01-01 02:00:00")
    inc.run_increment(spark, root, one, 1, "2026-01-01 01:30:00", with_marts=False)  # keeps its first load time
    inc.run_increment(spark, root, two, 2, "2026-01-01 02:00:00", with_marts=False)
    assert prices(spark, root, "fact") == [("a", "/x", 5), ("b", "/y", 6)]
    assert inc.read_raw_log(spark, root).agg(F.min("valid_from_dttm")).first()[0] == dt.datetime(2026, 1, 1, 1)


def test_checks_follow_the_increment(spark):
    root = scratch_path(spark, "t-checks")
    inc.run_increment(spark, root, raw_docs(spark, [("a", ts(1), ts(1), 1, OFFER % ('"/x"', -5))]), 1, "2026-01-01 01:00:00")
    found = {(r.test, r.model, r["column"]): r.failures for r in spark.read.parquet(f"{root}/dq_results").collect()}
    assert found["accepted_range", "dm_fact_ticket_offers", "price_rub"] == 1
    assert found["not_null", "ods_ticket_offers", "search_date"] == 1
    assert ("unique", "stg_ticket_offers", "doc_id") in found


def test_change_detection_reads_the_buckets_of_its_batch(spark):
    from farelake.plans import keyed_state as ks
    root = scratch_path(spark, "t-keyed")
    many = [(f"d{i}", ts(1, i % 20), ts(1, i % 20), i, OFFER % (f'"/{i}"', i)) for i in range(200)]
    run = lambda r, rows: inc.run_increment(spark, root, raw_docs(spark, rows), r, f"2026-01-01 0{r}:00:00",
                                            with_marts=False)
    run(1, many)
    run(2, [("d3", ts(1, 3), ts(1, 3), 3, OFFER % ('"/3"', 4)), many[4]])
    files = lambda df: {r[0] for r in df.select("_metadata.file_path").distinct().collect()}
    batch = raw_docs(spark, [many[4], many[5]])
    buckets = ks.batch_buckets(batch, root)
    whole, read = ks.read_state(spark, root, ks.VERSIONS), ks.read_state(spark, root, ks.VERSIONS, buckets)
    assert len(buckets) <= 2 and len(files(read)) <= 4 and len(files(whole)) >= 30
    assert {f for f in files(whole) if any(f"/bucket={b}/" in f for b in buckets)} == files(read)
    plan = read._jdf.queryExecution().executedPlan().toString()
    listed = "bucket" + "#"
    assert f"PartitionFilters: [{'isnotnull(' + listed if len(buckets) == 1 else listed}" in plan
    known = {r.doc_id: (r.event_id, r.valid_from_dttm.hour) for r in ks.known_versions(
        spark, root, raw_docs(spark, [many[3], many[4]]), 3, "doc_id", ["valid_from_dttm", "event_id"]).collect()}
    assert known == {"d3": (3, 2), "d4": (4, 1)}
    assert inc.read_raw_log(spark, root).count() == 201                  # d4 was unchanged
    # A root whose state is gone, as one begun without it, makes it up from the log.
    from farelake.session import remove_path
    remove_path(spark, f"{root}/{ks.VERSIONS}")
    run(3, [many[3], many[6], ("d3", ts(1, 3), ts(1, 3), 3, OFFER % ('"/3"', 4))])
    assert inc.read_raw_log(spark, root).count() in (201, 202)
    assert ks.read_state(spark, root, ks.VERSIONS).filter("run_id = 0").count() == 200


def test_compaction_takes_the_sums_in_and_a_stopped_write_keeps_the_old_table(spark):
    root = scratch_path(spark, "t-tables")
    run = lambda r, rows: inc.run_increment(spark, root, raw_docs(spark, rows), r, f"2026-01-01 0{r}:00:00",
                                            with_checks=False)
    run(1, [("a", ts(1), ts(1), 1, OFFER % ('"/x"', 5))])
    run(2, [("b", ts(1), ts(1), 2, OFFER % ('"/y"', 7))])
    inc.compact(spark, root, vacuum=True)
    assert inc.compacted_through(spark, f"{root}/route_sums") == 2 and not data_files(root, "route_sums")
    run(3, [("c", ts(1), ts(1), 3, OFFER % ('"/z"', 9))])
    assert inc.read_table_model(spark, root, "agg_route").first().avg_price_rub == 7.0
    # A table without its mark of completion is not read.
    spark.range(1).write.parquet(f"{root}/agg_route/through=9")
    (pathlib.Path(root.removeprefix("file:")) / "agg_route/through=9/_SUCCESS").unlink()
    assert inc.read_table_model(spark, root, "agg_route").first().avg_price_rub == 7.0
    assert len(data_files(root, "agg_route")) >= 3 and inc.read_table_model(spark, root, "airports").count() >= 1


def test_live_marts_follow_replaced_and_deleted_offers(spark):
    from farelake.operators import marts
    from farelake.plans import live_marts as live
    two = ('{"success":true,"data":[{"link":"/t","price":%s,"departure_at":"2025-01-02T00:00:00+00:00","origin":"P","destination":"Q"},'
           '{"link":"/t","price":%s,"departure_at":"2025-01-02T00:00:00+00:00","origin":"P","destination":"Q","origin_airport":"P1"}]}')
    root = scratch_path(spark, "t-live")

    def check(means):
        ods = inc.read_ods(spark, root)
        fact = live.offers_of(ods)
        rebuilt = {(r.origin, r.destination): r.avg_price_rub for r in marts.agg_route(fact).collect()}
        got = {(r.origin, r.destination): r.avg_price_rub for r in live.read_live(spark, root, "agg_route").collect()}
        assert got == rebuilt == means
        pairs = lambda df: sorted((str(r.airport_code), str(r.city_code)) for r in df.collect())
        assert pairs(live.read_live(spark, root, "airports")) == pairs(marts.airports(fact))

    run = lambda r, rows, **kw: live.run_live(spark, root, raw_docs(spark, rows), r, f"2026-01-01 {2 * r:02d}:00:00", **kw)
    run(1, [("a", ts(1), ts(1), 1, OFFER % ('"/x"', 5)), ("b", ts(1), ts(1), 2, two % (10, "null")),
            ("n", ts(1), ts(1), 3, OFFER % ("null", 8))])
    check({("O", "D"): 6.5, ("P", "Q"): 10.0})
    # Replaced at another price; a null link stays beside its newer offer; equal keys all go.
    run(2, [("a", ts(1), ts(2), 1, OFFER % ('"/x"', 50)), ("n", ts(1), ts(2), 3, OFFER % ("null", 20)),
            ("b", ts(1), ts(2), 2, OFFER % ('"/t"', 30))])
    check({("O", "D"): 27.0})
    # The next run also takes the one that the live marts did not see.
    inc.run_increment(spark, root, raw_docs(spark, [("a", ts(1), ts(3), 1, OFFER % ('"/x"', 7))]), 3, "2026-01-01 06:00:00", with_marts=False)
    inc.compact(spark, root, vacuum=True)
    run(4, [("c", ts(1), ts(4), 4, two % (1, 2))])
    # Run 3 read the open versions of run 2 again, and an offer without link matches nothing.
    check({("O", "D"): (7 + 8 + 20 + 20 + 30) / 5, ("P", "Q"): 1.5})
    gone = spark.createDataFrame([("n",), ("c",), ("never",), (None,)], "doc_id string")
    live.delete_documents(spark, root, gone, 5, "2026-01-01 10:00:00")
    live.delete_documents(spark, root, gone, 5, "2026-01-01 10:00:00")      # a no-op
    check({("O", "D"): 18.5})
    inc.compact(spark, root)
    run(6, [("c", ts(1), ts(6), 4, OFFER % ('"/t"', 9))])                   # a deleted document comes again
    check({("O", "D"): (7 + 30 + 9) / 3})


def test_compacted_log_opens_the_files_of_the_days_since(spark):
    root = scratch_path(spark, "t-cluster")
    for run, days in ((1, range(15, 18)), (2, range(18, 21))):
        rows = [(f"d{i}", ts(d, i), ts(d, i), 100 * d + i, OFFER % (f'"/{i}"', i)) for d in days for i in range(20)]
        inc.run_increment(spark, root, raw_docs(spark, rows), run, f"2026-01-01 0{run}:00:00", with_marts=False,
                          loaded_at="created_at")
    hour = F.lit(ts(20, 18)).cast("timestamp")
    models = lambda: [inc.read_raw_log(spark, root).count(), prices(spark, root, "ods"),
                      sorted(inc.versions_since(spark, root, hour).drop("run_id").collect())]
    before = models()
    inc.compact(spark, root, vacuum=True)
    assert models() == before and len(before[2]) == 2
    base = pathlib.Path(root.removeprefix("file:"), "raw_base", "through=2")
    files = {p: [f.name for f in p.glob("*.parquet")] for p in base.glob("load_day=*")}
    read = inc.versions_since(spark, root, hour)
    assert len(read.collect()) == 2
    scan = read._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    opened = scan.metrics().apply("numFiles").value()
    assert len(files) == 6 and opened == len(files[base / "load_day=2025-01-20"]) < sum(map(len, files.values()))
    for day, names in files.items():                       # files are ranges: sorted, and apart from each other
        ends = []
        for name in names:
            got = [tuple(r.values()) for r in pq.read_table(day / name, columns=["valid_from_dttm", "doc_id"]).to_pylist()]
            assert got == sorted(got)
            ends.append((got[0], got[-1]))
        assert all(a[1] < b[0] for a, b in zip(sorted(ends), sorted(ends)[1:], strict=False))
    # A run on top of the base reads it by its watermark.
    inc.run_increment(spark, root, raw_docs(spark, [("new", ts(21), ts(21), 9000, OFFER % ('"/n"', 77))]), 3,
                      "2026-01-01 03:00:00", with_marts=False, loaded_at="created_at")
    assert len(prices(spark, root, "ods")) == len(before[1]) + 1


def test_stream_lookback_keeps_its_state_over_a_restart_and_lets_go_of_the_past(spark, tmp_dir):
    from farelake.streaming.ingest import stream_ingest
    root, landing = scratch_path(spark, "t-lookback"), f"{tmp_dir}/land-again"
    at = lambda day, hour, key, eid, n: (key, ts(day, hour), ts(day, hour), eid, OFFER % (f'"/{key}"', n))
    passes = [[at(3, 1, "a", 1, 5), at(3, 2, "b", 2, 6)],
              [at(3, 1, "a", 1, 5), at(3, 2, "b", 2, 6), at(2, 12, "c", 3, 7), at(1, 12, "old", 4, 8), at(3, 3, "a", 5, 9)],
              [at(3, 3, "a", 5, 9), at(3, 2, "b", 2, 6)],
              [at(9, 1, "d", 6, 1)], [at(9, 1, "d", 6, 1), at(9, 2, "e", 7, 2), at(3, 2, "b", 2, 60)]]
    for rows in passes:                                    # every pass is a start of its own on the same checkpoint
        raw_docs(spark, rows).coalesce(1).write.mode("append").parquet(landing)
        q = stream_ingest(spark, landing, root, raw_docs(spark, rows).schema, lookback="1 day", detect_changes=False,
                          processed_at=lambda r: f"2026-01-01 0{r}:00:00", with_marts=False)
        q.awaitTermination()
    assert prices(spark, root, "fact") == [("a", "/a", 5), ("a", "/a", 9), ("b", "/b", 6), ("c", "/c", 7), ("d", "/d", 1), ("e", "/e", 2)]
    assert inc.read_runs(spark, root).count() == 4          # the third pass brought nothing new
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] == 2


def test_rows_left_out_of_the_log_are_told_without_their_texts(spark):
    """Doubles and unchanged documents, by numbers, times and hashes alone, are those that
    ranking and comparing whole documents finds."""
    from farelake.operators.scd2 import drop_unchanged, newest_versions
    day = "timestamp'2024-01-01' + make_interval(0, 0, 0, cast(id * 7 % 4 as int))"
    docs = spark.range(240).selectExpr(
        "if(id % 31 = 0, null, concat('d', id % 5)) as doc_id", "'e' as endpoint", "'q' as request",
        "concat('text', id div 60 % 2) as response", "200 as status_code", "false as error", f"{day} as created_at",
        f"if(id % 17 = 0, null, {day}) as updated_at", "timestamp'2024-01-01' as batch_started_at",
        f"if(id % 29 = 0, null, {day}) as valid_from_dttm", "id % 90 as event_id", "id as _row")
    docs = docs.withColumn("content", inc.content_hash())
    known = docs.filter("doc_id is not null and valid_from_dttm is not null").limit(3).select(
        "doc_id", "valid_from_dttm", "event_id", "content", F.lit(0).alias("run_id"))
    same = ["doc_id", "valid_from_dttm", "event_id"]
    for old in (None, known):
        chain = newest_versions(docs, same).withColumn("_known", F.lit(False))
        if old is not None:
            chain = chain.unionByName(old.drop("run_id").withColumn("_known", F.lit(True)), allowMissingColumns=True)
        kept = drop_unchanged(chain, cols=["content"]).filter("not _known").select(*same, "content")
        out = inc.left_out_rows(docs, old, same, "doc_id", "event_id")
        got = docs.join(out, "_row", "left_anti").select(*same, "content")
        assert sorted(map(str, got.collect())) == sorted(map(str, kept.collect())) and 0 < got.count() < 240
    assert "response" not in inc.left_out_rows(docs.drop("content").withColumn("content", F.lit(1).cast("long")), None, same, "doc_id", "event_id") \
        ._jdf.queryExecution().optimizedPlan().toString()
