import datetime as dt
import math

import numpy as np
from pyspark.sql import functions as F

from farelake.operators import marts, stats

D = dt.date(2025, 12, 20)
T1 = dt.datetime(2025, 12, 1, 0, 0)
T2 = dt.datetime(2025, 12, 2, 0, 0)


def fact_frame(spark, rows):
    schema = ("doc_id string, link string, created_at timestamp, processed_src_dttm timestamp, "
              "departure_date date, origin string, destination string, price_rub int, "
              "departure_weekday_short string, origin_airport string, destination_airport string")
    return spark.createDataFrame(rows, schema)


def test_first_offer_ties_and_order(spark):
    rows = [("b", "l2", T1, T1, D, "LON", "PAR", 100, "Sat", "LHR", "CDG"),
            ("b", "l1", T1, T1, D, "LON", "PAR", 300, "Sat", "LHR", "CDG"),
            ("a", "l9", T2, T1, D, "LON", "PAR", 50, "Sat", "LHR", "CDG"),
            ("c", "l3", None, T1, D, "LON", "PAR", 10, "Sat", "LHR", "CDG")]
    got = marts.first_offer(fact_frame(spark, rows)).collect()
    assert len(got) == 1 and (got[0].doc_id, got[0].link, got[0].rn) == ("b", "l1", 1)
    cheap = marts.latest_cheapest(fact_frame(spark, rows)).first()
    assert cheap.doc_id == "a"  # latest created (NULLs last), then cheapest


def test_airports_keep_null_codes(spark):
    rows = [("a", "l", T1, T1, D, "LON", "PAR", 1, "Sat", None, "CDG"),
            ("a", "m", T1, T1, D, "LON", "PAR", 1, "Sat", None, "CDG")]
    got = {(r.airport_code, r.city_code) for r in marts.airports(fact_frame(spark, rows)).collect()}
    assert got == {(None, "LON"), ("CDG", "PAR")}


def test_constant_relation(spark):
    assert [r.id for r in marts.constant_relation(spark).collect()] == [1]


def test_lead_buckets_keep_empty_and_single_row_std(spark):
    lead = spark.createDataFrame([(0, 100), (3, 100), (3, 300), (20, 50)],
                                 "days_before_departure int, price_rub int")
    rows = {r.days_range: r for r in stats.stats_lead_bucket(lead).collect()}
    assert len(rows) == 7
    assert rows["0-7"].n_offers == 2 and rows["0-7"].mean_price == 200
    assert rows["15-30"].n_offers == 1 and rows["15-30"].std_price is None
    assert rows["61-90"].n_offers == 0 and rows["61-90"].mean_price is None


def gaussian_reflect(x, sigma=2.0, truncate=4.0):
    r = int(truncate * sigma + 0.5)
    k = np.arange(-r, r + 1)
    w = np.exp(-0.5 * (k / sigma) ** 2)
    w /= w.sum()
    n = len(x)
    out = np.zeros(n)
    for i in range(n):
        for kk, ww in zip(k, w):
            j = (i + kk) % (2 * n)
            j = j if j < n else 2 * n - 1 - j
            out[i] += ww * x[j]
    return out


def test_smoothing_matches_reflect_gaussian(spark):
    for n in (1, 5, 40):
        xs = [float((i * 37) % 11 + i) for i in range(n)]
        df = spark.createDataFrame([(i * 3, v) for i, v in enumerate(xs)], "d int, v double")
        got = [r.smoothed for r in stats.smooth_series(df, "v", "d", 2.0).collect()]
        assert np.allclose(got, gaussian_reflect(np.array(xs)), atol=1e-9)


def test_smoothing_per_group(spark):
    rows = [("a", i, float(i)) for i in range(10)] + [("b", i, float(-i)) for i in range(4)]
    df = spark.createDataFrame(rows, "g string, d int, v double")
    out = stats.smooth_series(df, "v", "d", 2.0, group=["g"]).collect()
    a = [r.smoothed for r in out if r.g == "a"]
    assert np.allclose(a, gaussian_reflect(np.arange(10.0)), atol=1e-9)


def test_box_stats(spark):
    vals = [1, 2, 3, 4, 5, 6, 7, 8, 100]
    df = spark.createDataFrame([("Mon", v) for v in vals], "departure_weekday_short string, price_rub int")
    r = stats.box_stats(df).first()
    q1, q3 = np.percentile(vals, [25, 75])
    assert (r.q1, r.q3) == (q1, q3)
    assert r.outliers == 1 and r.whisker_high == 8 and r.whisker_low == 1


def test_extremes_tie_break(spark):
    monthly = spark.createDataFrame([(1, 2025, 10, 100.0, 5.0), (2, 2025, 10, 100.0, None),
                                     (3, 2025, 10, 50.0, 1.0)],
                                    "month_num int, year int, ticket_count long, avg_price double, price_stddev double")
    weekly = spark.createDataFrame([("Tue", "Tuesday", 10.0, 2), ("Mon", "Monday", 10.0, 1)],
                                   "departure_weekday_short string, departure_weekday_full string, avg_price double, weekday_order int")
    buckets = spark.createDataFrame([("0-7", 1, 5.0), ("8-14", 2, None)],
                                    "days_range string, bucket_order int, mean_price double")
    per_day = spark.createDataFrame([(31, 3.0), (45, 3.0), (70, 1.0)], "days_before_departure int, avg_price double")
    f = {r.finding: r for r in stats.price_extremes(monthly, weekly, buckets, per_day).collect()}
    assert f["most_expensive_month"].label == "1"
    assert f["best_weekday"].label == "Monday" and f["worst_weekday"].label == "Monday"
    assert f["optimal_lead_day"].label == "31"
    assert f["cheapest_lead_bucket"].label == "0-7"
    roll = {r.month_num: r for r in stats.month_rollup(monthly).collect()}
    assert roll[2].price_stddev is None


def test_pivot_columns(spark):
    monthly = spark.createDataFrame([(1, 2024, 1.0), (1, 2026, 3.0)], "month_num int, year int, avg_price double")
    p = stats.pivot_month_year(monthly, [2024, 2025, 2026])
    assert p.columns == ["month_num", "2024", "2025", "2026"]
    r = p.first()
    assert (r["2024"], r["2025"], r["2026"]) == (1.0, None, 3.0)
    assert sorted(tuple(r) for r in stats.pivot_month_year(monthly).collect()) == [(1, 2024, 1.0), (1, 2026, 3.0)]


def test_full_refresh_registers_models(spark, tmp_dir):
    from farelake.plans.refresh import RUN_TS, run_full_refresh, table_name
    from farelake.sources.fixtures import offer_log
    paths = run_full_refresh(spark, offer_log(spark, "/root/testdata/sf0.001"), tmp_dir,
                             processed_at=RUN_TS, as_of=RUN_TS)
    assert table_name("dm_prices_agg_route") == "dm.dm_prices_agg_route"
    assert table_name("dq_results") == "raw.dq_results"
    n = spark.sql("SELECT count(*) AS n FROM dm.dm_prices_agg_route").first().n
    assert n == spark.read.parquet(paths["dm_prices_agg_route"]).count() > 0
    statuses = {r.test: r.status for r in spark.sql("SELECT * FROM raw.dq_results").collect()}
    assert statuses["not_null"] == "pass" and statuses["freshness"] == "fail"
