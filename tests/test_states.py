"""Mergeable states: moments, checks and statistics by run, and the sweep over versions."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from farelake.operators import moments
from farelake.operators import quality as dq
from farelake.operators.scd2 import interval_faults
from farelake.plans import check_states, checks, stat_states
from farelake.plans import incremental as inc
from farelake.schemas import DEFAULT_ENDPOINT, SENTINEL
from farelake.session import scratch_path
from test_scd2_incremental import DOC


def test_moments_merge_without_cancellation(spark):
    rng = random.Random(4)
    rows = [(i % 3, i % 7, 1e9 + rng.random()) for i in range(700)] + [(0, 9, None), (4, 1, None), (5, 1, 2.5)]
    df = spark.createDataFrame(rows, "g int, part int, x double")
    states = df.groupBy("g", "part").agg(moments.moments("x").alias("s"))
    got = {r.g: r for r in states.groupBy("g").agg(moments.merged("s").alias("s")).select(
        "g", "s.n", moments.mean("s").alias("mean"), moments.stddev_samp("s").alias("sd")).collect()}
    for g in range(3):
        values = [x for a, _, x in rows if a == g and x is not None]
        assert got[g].n == len(values)
        assert got[g].mean == pytest.approx(statistics.mean(values), rel=1e-15)
        assert got[g].sd == pytest.approx(statistics.stdev(values), rel=1e-6)
    assert (got[4].n, got[4].mean, got[4].sd) == (0, None, None)
    assert (got[5].n, got[5].mean, got[5].sd) == (1, 2.5, None)


def _documents(spark, days, prices):
    """One document a day and price; null prices and offers without a departure among them."""
    rows = []
    for i, day in enumerate(days):
        t = dt.datetime(2025, 1, 1) + dt.timedelta(days=day, hours=i % 24)
        offers = ",".join('{"link":"/%d-%d?search_date=%s","price":%s,"origin":"O%d","destination":"D"%s}' % (
            i, j, t.strftime("%d%m%Y"), "null" if (i + j) % 5 == 0 else p, j,
            "" if (i + j) % 4 == 0 else ',"departure_at":"2025-03-%02dT00:00:00+00:00"' % (1 + j)) for j, p in enumerate(prices))
        rows.append((f"d{i}", DEFAULT_ENDPOINT, '{"one_way":"true"}', '{"success":true,"currency":"rub","data":[%s]}' % offers,
                     200, False, t, t, t.replace(hour=0), i))
    return spark.createDataFrame(rows, DOC)


def _rows(df):
    return sorted(tuple(str(x) for x in r) for r in df.select(*dq.CHECK_COLUMNS).collect())


def test_state_checks_equal_the_whole_models_and_read_none(spark):
    root = scratch_path(spark, "t-states")
    slices = [range(0, 8), range(8, 12), range(10, 20)]
    for r, days in enumerate(slices, start=1):
        inc.run_increment(spark, root, _documents(spark, days, [-5, 10 * r, 70, 5000]).withColumn("doc_id", F.concat("doc_id", F.lit(f"-{r}"))),
                          r, f"2026-01-01 0{r}:00:00", with_checks=False)
        if r != 2:  # run 2 is caught up
            check_states.write_states(spark, root, r)
    found = check_states.state_checks(spark, root)
    models = {"fact": inc.read_runs_of(spark, f"{root}/fact").drop("run_id"), "latest": inc.read_latest(spark, root).drop("run_id"),
              **{m: inc.read_table_model(spark, root, m) for m in ("agg_dep_route", "agg_search_dep_route")}}
    want = dq.dq_report(*[dq.column_checks(models[m], checks.NOT_NULL[m][0], checks.NOT_NULL[m][1], checks.AT_LEAST.get(m))
                          for m in ("fact", "latest")], *checks.anomaly_rows(models))
    expected = _rows(want)
    assert _rows(found) == expected
    assert any(r[0] == "accepted_range" and int(r[5]) > 0 for r in expected)
    assert not [f for f in found.inputFiles() if "_states" not in f and "fact_cells" not in f]
    # compacted states and a run taken again give the same
    inc.compact(spark, root, vacuum=True)
    assert not inc.list_paths(spark, f"{root}/fact_states/run_id=*")
    assert _rows(check_states.state_checks(spark, root)) == expected


def test_checks_of_a_run_from_states(spark):
    root = scratch_path(spark, "t-states-run")
    inc.run_increment(spark, root, _documents(spark, range(3), [-5, 7]), 1, "2026-01-01 01:00:00", with_checks="states")
    found = {(r.test, r.model): r.failures for r in spark.read.parquet(f"{root}/dq_results").collect()}
    assert found["accepted_range", checks.FACT] == 2 and found["not_null", checks.FACT] == 1
    assert ("volume_anomalies", checks.SEARCH) in found


def test_statistics_from_states_equal_one_pass(spark):
    root = scratch_path(spark, "t-stat-states")
    for r in (1, 2, 3):
        docs = _documents(spark, range(5 * r, 5 * r + 5), [3 * r, 10, 999]).withColumn("doc_id", F.concat("doc_id", F.lit(f"-{r}")))
        inc.run_increment(spark, root, docs, r, f"2026-01-01 0{r}:00:00", with_marts=False)
        if r != 2:
            stat_states.write_state(spark, root, r)
    fact = inc.read_runs_of(spark, f"{root}/fact").filter("departure_month is not null")
    want = fact.groupBy("departure_month").agg(
        F.count(F.lit(1)), F.avg("price_rub"), F.min("price_rub"), F.max("price_rub"), F.stddev_samp("price_rub")).collect()
    timed = fact.filter("price_rub is not null and search_date is not null").count()
    for _ in range(2):
        got = stat_states.stats_month(stat_states.read_states(spark, root)).collect()
        assert [tuple(r)[:5] for r in got] == [tuple(r)[:5] for r in want]
        assert [r[5] for r in got] == pytest.approx([r[5] for r in want], rel=1e-9)
        inc.compact(spark, root, vacuum=True)
    lead = stat_states.stats_lead_bucket(stat_states.read_states(spark, root))
    assert lead.agg(F.sum("n_offers")).first()[0] == timed


def _swept(versions):
    """Brute force: the open count at every event time."""
    out = []
    for key in {v[0] for v in versions}:
        mine = [(a, b) for k, a, b in versions if k == key and not (b is not None and b < a)]
        times = sorted({t for v in mine for t in v if t is not None})
        change = [t for t in times if sum(a == t for a, _ in mine) != sum(b == t for _, b in mine)]
        for t, to in zip(change, [*change[1:], None], strict=True):
            n = sum(a <= t and (b is None or b > t) for a, b in mine)
            if n != 1:
                out.append((key, "open" if to is None else "overlap" if n else "gap", t, to, n))
    return out + [(k, "reversed", a, b, 0) for k, a, b in versions if b is not None and b < a]


def test_interval_faults_against_brute_force(spark):
    rng = random.Random(8)
    at = lambda: dt.datetime(2025, 1, 1) + dt.timedelta(hours=rng.randint(0, 200))
    versions = []
    for key in ["hot"] * 60 + [f"k{i % 12}" for i in range(60)]:
        a = at()
        versions.append((key, a, rng.choice([None, a, a + dt.timedelta(hours=rng.randint(-3, 60))])))
    for i in range(4):  # a sound chain
        versions.append(("sound", dt.datetime(2025, 1, 1 + i), dt.datetime(2025, 1, 2 + i) if i < 3 else None))
    log = spark.createDataFrame(versions + [(None, at(), None)], "doc_id string, valid_from_dttm timestamp, valid_to_dttm timestamp")
    key = lambda rows: sorted(tuple(str(x) for x in r) for r in rows)
    assert key(interval_faults(log).collect()) == key(_swept(versions))
    closed = log.fillna({}).withColumn("valid_to_dttm", F.coalesce("valid_to_dttm", F.lit(SENTINEL).cast("timestamp")))
    assert key(interval_faults(closed).collect()) == key(_swept(versions))
    assert interval_faults(log.limit(0)).count() == 0
    assert dq.intervals(log.filter("doc_id = 'sound'"), "raw_api_log").first().failures == 0
