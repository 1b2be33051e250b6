"""Property tests: incremental folds equal one full computation."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from farelake.operators.scd2 import scd2_apply, scd2_history
from farelake.plans import incremental as inc
from farelake.schemas import DEFAULT_ENDPOINT
from farelake.session import scratch_path

DOC = ("doc_id string, endpoint string, request string, response string, status_code int, "
       "error boolean, created_at timestamp, updated_at timestamp, batch_started_at timestamp, "
       "event_id long, valid_from_dttm timestamp")
BASE = dt.datetime(2025, 1, 1)

versions = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 200), st.integers(0, 2)),
    min_size=1, max_size=25, unique_by=lambda t: t[1])

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(versions, st.lists(st.integers(0, 200), max_size=3))
def test_scd2_fold_equals_history(spark, vs, cuts):
    rows = []
    for i, (key, hours, body) in enumerate(vs):
        t = BASE + dt.timedelta(hours=hours * 7)
        rows.append((key, DEFAULT_ENDPOINT, "{}", f'{{"v":{body},"i":{i}}}', 200, False, t, t,
                     t.replace(hour=0), i, t))
    docs = spark.createDataFrame(rows, DOC)
    expect = sorted((r.doc_id, r.event_id, r.valid_to_dttm) for r in scd2_history(docs).collect())
    bounds = sorted(set(cuts))
    log = None
    lo = None
    for hi in bounds + [None]:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (F.col("event_id") >= 0) & (F.col("created_at") >= BASE + dt.timedelta(hours=lo * 7))
        if hi is not None:
            cond = cond & (F.col("created_at") < BASE + dt.timedelta(hours=hi * 7))
        part = docs.filter(cond)
        log = scd2_history(part) if log is None else scd2_apply(log, part)
        path = scratch_path(spark, "prop-scd2")  # cut lineage between folds, as the jobs do
        log.write.parquet(path)
        log = spark.read.parquet(path)
        lo = hi
    got = sorted((r.doc_id, r.event_id, r.valid_to_dttm) for r in log.collect())
    assert got == expect


batches = st.lists(
    st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from(["x", "y"]),
                       st.integers(0, 9)), min_size=1, max_size=6),
    min_size=1, max_size=3)


@SETTINGS
@given(batches)
def test_delete_insert_matches_model(spark, bs):
    root = scratch_path(spark, "prop-di")
    model: list[tuple] = []
    for i, b in enumerate(bs):
        df = spark.createDataFrame(b, "doc_id string, link string, v int")
        inc.delete_insert(df, f"{root}/t", i)
        keys = {(k, l) for k, l, _ in b if k is not None and l is not None}
        model = [r for r in model if (r[0], r[1]) not in keys] + list(b)
    got = [(r.doc_id, r.link, r.v) for r in inc.read_merged(spark, f"{root}/t", ["doc_id", "link"]).collect()]
    key = lambda t: (str(t[0]), t[1], t[2])
    assert sorted(got, key=key) == sorted(model, key=key)
