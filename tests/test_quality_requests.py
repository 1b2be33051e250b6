import datetime as dt
import json

from farelake.operators import anomaly as an
from farelake.operators import quality as dq
from farelake.operators import requests as rq


def test_basic_checks(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", None), (None, "b", -1)], "id int, k string, p int")
    nn = {r.column: r.failures for r in dq.not_null(df, "m", ["id", "p"]).collect()}
    assert nn == {"id": 1, "p": 1}
    assert dq.unique(df, "m", "k").first().failures == 1
    assert dq.accepted_range(df, "m", "p", min_value=0).first().failures == 1
    parent = spark.createDataFrame([(1,)], "id int")
    rel = dq.relationships(df, parent, "m", "id").first()
    assert rel.failures == 1 and rel.status == "fail"
    src = spark.createDataFrame([(dt.datetime(2025, 1, 1),)], "loaded timestamp")
    assert dq.freshness(src, "raw", "loaded", dt.datetime(2025, 1, 1, 12)).first().status == "pass"
    assert dq.freshness(src, "raw", "loaded", dt.datetime(2025, 1, 2, 12)).first().status == "warn"
    assert dq.freshness(src, "raw", "loaded", dt.datetime(2025, 1, 4)).first().status == "fail"


def test_volume_spike_is_flagged(spark):
    rows = []
    base = dt.datetime(2025, 1, 1)
    for b in range(30):
        n = 10 + (b % 3)
        if b == 25:
            n = 200
        for i in range(n):
            rows.append((base + dt.timedelta(hours=12 * b, minutes=i),))
    df = spark.createDataFrame(rows, "ts timestamp")
    out = an.volume_anomalies(df, "ts", period="12 hours", detection_period="14 days",
                              detection_delay=None)
    flagged = [r.bucket_start for r in out.collect() if r.is_anomalous]
    assert flagged == [base + dt.timedelta(hours=12 * 25)]


def test_validate_and_normalize(spark):
    rows = [("lon", "par", None, " 2025-12 ", None, None, None, None, None, None, None, None),
            ("L1", "PARIS", "GBP", "2025/1", "2026-01", "true", "x", "RU", "0", "0", "fast", "no")]
    cols = ("origin string, destination string, currency string, departure_at string, return_at string, "
            "one_way string, direct string, market string, limit string, page string, sorting string, unique string")
    df = rq.validate_requests(spark.createDataFrame(rows, cols))
    r = df.collect()
    assert r[0].is_valid and r[0].reject_reasons == []
    assert set(r[1].reject_reasons) == {"origin", "destination", "currency", "departure_at",
                                        "return_with_one_way", "market", "limit", "page",
                                        "sorting", "direct", "unique"}
    q = json.loads(rq.normalize_requests(df.filter("is_valid")).first().query_json)
    assert q == {"origin": "LON", "destination": "PAR", "currency": "RUB", "departure_at": "2025-12",
                 "one_way": "true", "direct": "false", "limit": 30, "page": 1, "sorting": "price",
                 "unique": "false"}


def test_classify_and_pairs_and_grid(spark):
    log = spark.createDataFrame([('{"success":true,"data":[]}', False), ('{"success":false}', False),
                                 ('{"success":false,"error":"quota"}', False), ('"boom"', True)],
                                "response string, error boolean")
    got = [(r.is_success, r.error_message) for r in rq.classify_responses(log).collect()]
    assert got == [(True, None), (False, "Unknown API error"), (False, "quota"), (False, "boom")]
    codes = "LON PAR BER ROM MAD LIS AMS BRU VIE PRG".split()
    routes = [(a, b) for a in codes for b in codes] + [("LON", "PAR"), (None, "PAR"), ("LON", None)]
    pairs = rq.ordered_pairs(spark.createDataFrame(routes, "origin string, destination string"))
    assert pairs.count() == 90 and pairs.filter("origin = destination").count() == 0
    grid = rq.request_grid(pairs, dt.date(2025, 12, 12))
    assert grid.count() == 2340


def test_error_text_and_truth_of_success(spark):
    from farelake.functions.json import quoted_json_text
    texts = ['line\nfeed', 'a "quote"', 'back\\slash', 'tab\t é', '', None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", quoted_json_text("t").alias("response"))
    for r in df.collect():
        assert (r.response is None) if r.t is None else json.loads(r.response) == r.t
    back = rq.classify_responses(df.where("t is not null").selectExpr("t", "response", "true as error")).collect()
    assert all(r.error_message == r.t and not r.is_success for r in back)
    for value, ok in [("1", True), ("true", True), ('"yes"', True), ("[0]", True), ("0", False), ("0.0", False),
                      ('""', False), ("null", False), ("[]", False), ("{}", False), ("false", False)]:
        log = spark.createDataFrame([('{"success":%s,"data":[]}' % value, False)], "response string, error boolean")
        assert rq.classify_responses(log).first().is_success == ok, value


def test_batch_summary_counts(spark):
    t = dt.datetime(2025, 1, 1)
    log = spark.createDataFrame([
        ('{"origin":"A","destination":"B","departure_at":"2025-01"}', '{"success":true,"data":[1,2,3]}', False, t),
        ('{"origin":"A","destination":"C","departure_at":"2025-02"}', '{"success":true,"data":null}', False, t),
        ('{"origin":"A","destination":"B","departure_at":"2025-02"}', '"boom"', True, t)],
        "request string, response string, error boolean, batch_started_at timestamp")
    r = rq.batch_summary(log).first()
    assert (r.number_tickets, r.number_missed, r.routes, r.periods) == (3, 1, 2, 2)


def _brute_score(values, training=14, sens=3.0):
    import statistics
    out = []
    for i, x in enumerate(values):
        hist = [v for v in values[max(0, i - training):i] if v is not None]
        if len(hist) < 3 or x is None:
            out.append(False)
            continue
        m, s = statistics.mean(hist), statistics.stdev(hist)
        out.append(abs(x - m) > sens * s if s > 0 else abs(x - m) > 0)
    return out


def test_freshness_anomalies_match_brute_force(spark):
    import random
    rnd = random.Random(7)
    base = dt.datetime(2025, 3, 1)
    times = sorted({base + dt.timedelta(seconds=rnd.randint(0, 20 * 86400)) for _ in range(400)})
    times += [base + dt.timedelta(days=21, hours=h) for h in (0, 30)]  # a long gap late on
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp")
    out = sorted(an.freshness_anomalies(df, "ts", period="12 hours", detection_period=None,
                                        detection_delay=None).collect(), key=lambda r: r.bucket_start)
    # brute force: global consecutive gaps, max per 12-hour bucket of the later time
    cut = max(times)
    p = 12 * 3600
    start = lambda t: dt.datetime.fromtimestamp((int(t.replace(tzinfo=dt.timezone.utc).timestamp()) // p) * p,
                                                dt.timezone.utc).replace(tzinfo=None)
    kept = [t for t in times if start(t) + dt.timedelta(seconds=p) <= cut]
    gaps = {}
    for prev, cur in zip([None] + kept[:-1], kept):
        g = 0.0 if prev is None else (cur - prev).total_seconds()
        b = start(cur)
        gaps[b] = max(gaps.get(b, 0.0), g)
    buckets = [r.bucket_start for r in out]
    assert buckets[0] == min(gaps)
    vals = [gaps.get(b) for b in buckets]
    assert [r.value for r in out] == vals
    assert [r.is_anomalous for r in out] == _brute_score(vals)


def test_validation_counts_match_fixture_notes(spark):
    """FIXTURES B4: planted faults in the customer-derived requests at sf0.01."""
    from pyspark.sql import functions as F

    from farelake.sources.fixtures import request_rows
    v = rq.validate_requests(request_rows(spark, "/root/testdata/sf0.01"))
    counts = {r.reason: r.n for r in v.select(F.explode("reject_reasons").alias("reason"))
              .groupBy("reason").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {"origin": 215, "destination": 67, "currency": 411, "limit": 1351,
                      "return_with_one_way": 250, "departure_at": 137}


def test_batch_summary_matches_fixture_notes(spark):
    """FIXTURES B2: 30 batches, 11,990 offers, 4,031 missed calls at sf0.01."""
    from pyspark.sql import functions as F

    from farelake.sources.fixtures import event_documents
    s = rq.batch_summary(event_documents(spark, "/root/testdata/sf0.01"))
    r = s.agg(F.count(F.lit(1)).alias("b"), F.sum("number_tickets").alias("t"),
              F.sum("number_missed").alias("m")).first()
    assert (r.b, r.t, r.m) == (30, 11990, 4031)


def test_column_checks_in_one_aggregate(spark):
    df = spark.createDataFrame([(1, None), (-2, "x"), (None, "y")], "price int, code string")
    got = {(r.test, r["column"]): (r.severity, r.failures, r.status)
           for r in dq.column_checks(df, "m", {"price": "error", "code": "warn"}, {"price": 0}).collect()}
    assert got == {("not_null", "price"): ("error", 1, "fail"), ("not_null", "code"): ("warn", 1, "warn"),
                   ("accepted_range", "price"): ("error", 1, "fail")}
    assert {r.failures for r in dq.column_checks(df.limit(0), "m", {"price": "error"}, {"price": 0}).collect()} == {0}


def test_unnest_misses_and_bad_casts_as_checks(spark):
    from farelake.operators.flatten import CAST_FIELDS, MISS_REASONS, bad_casts, unnest_misses
    offer = '{"price":%s,"departure_at":%s}'
    body = '{"data":[' + offer % ('"12"', '"2025-01-01T00:00:00Z"') + "," + offer % ('"cheap"', '"soon"') + "]}"
    stg = spark.createDataFrame(
        [("a", '{"one_way":"true"}', body), ("b", '{"one_way":"false"}', body), ("c", None, '"boom"'),
         ("d", None, "{}"), ("e", None, '{"data":{}}'), ("f", None, '{"data":[]}')],
        "doc_id string, request string, response string")
    count = lambda rows: {r.test: r.failures for r in rows.collect()}
    assert count(dq.reason_counts(unnest_misses(stg), "m", "response", MISS_REASONS)) == {
        "response_text": 1, "response_no_data": 1, "response_not_array": 1, "response_empty": 1}
    casts = count(dq.reason_counts(bad_casts(stg), "m", "cast", list(CAST_FIELDS)))
    assert {k for k, n in casts.items() if n} == {"cast_price", "cast_departure_at"} and sum(casts.values()) == 2


def test_view_over_a_registered_table(spark, tmp_dir):
    from farelake.plans.refresh import create_view, register_table
    spark.range(3).write.parquet(f"{tmp_dir}/t")
    register_table(spark, "dm.view_source", f"{tmp_dir}/t", tmp_dir)
    create_view(spark, "dm.view_of_it", "SELECT id FROM dm.view_source WHERE id > 0")
    create_view(spark, "view_of_it", "SELECT id FROM dm.view_source", temporary=True)
    assert spark.table("dm.view_of_it").count() == 2 and spark.table("view_of_it").count() == 3


def test_gaps_fold_over_cells_however_the_rows_fall(spark):
    import random

    from pyspark.sql import functions as F
    rng = random.Random(4)
    base = 1_735_689_600_000_000
    hot = [base + 3_600_000_000 + rng.randrange(60_000_000) for _ in range(4000)]    # half the rows in one minute
    times = hot + [base + rng.randrange(5 * 86_400_000_000) for _ in range(1500)] + hot[:300]
    times += [base + 43_200_000_000 * n - 1 for n in (1, 2, 3)] + [base + 43_200_000_000]  # at the bucket's edges
    df = spark.createDataFrame([(t,) for t in times] + [(None,)], "t long").select(F.timestamp_micros("t").alias("ts"))
    rows = df.withColumn("bucket_start", an.bucket_start("ts", "12 hours")).repartition(5)
    got = {r.bucket_start.timestamp(): r.value for r in an.gap_values(an.gap_summaries(an.time_cells(rows, "ts"))).collect()}
    want, before = {}, None
    for t in sorted(set(times)):
        bucket = t // 43_200_000_000 * 43_200
        want[bucket] = max(want.get(bucket, 0), (t - before) / 1e6 if before is not None else 0)
        before = t
    assert {k: round(v, 6) for k, v in got.items()} == {float(k): round(v, 6) for k, v in want.items()}
    # The same from parts that overlap in time, put together cell by cell.
    halves = an.time_cells(rows.filter("unix_micros(ts) % 2 = 0"), "ts").unionByName(
        an.time_cells(rows.filter("unix_micros(ts) % 3 <> 0 or unix_micros(ts) % 2 = 1"), "ts"))
    assert {r.bucket_start.timestamp(): r.value for r in an.gap_values(an.gap_summaries(an.merge_cells(halves))).collect()} == got
    plan = an.gap_summaries(an.time_cells(rows, "ts"))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_gap_summaries_of_nothing(spark):
    none = spark.createDataFrame([], "ts timestamp, bucket_start timestamp")
    assert an.gap_values(an.gap_summaries(an.time_cells(none, "ts"))).collect() == []
