"""Exact quantiles by selection against numpy; samples by least hash."""

import random

import numpy as np
import pytest

from farelake.operators import quantiles, stats


@pytest.mark.parametrize("bins", [4, 1024])
def test_quantiles_by_selection(spark, monkeypatch, bins):
    monkeypatch.setattr(quantiles, "BINS", bins)
    rng = random.Random(bins)
    groups = {"even": [float(i) for i in range(300)], "ties": [1.0] * 90 + [2.0] * 30 + [-3.5], "one": [7.25],
              "wide": [rng.choice([-1, 1]) * 2.0 ** rng.randint(-60, 60) for _ in range(120)],
              "ends": [1.7e308, -1.7e308, 5e-324, 0.0, -0.0, 1e-323], None: [rng.random() for _ in range(75)]}
    rows = [(g, v) for g, some in groups.items() for v in some]
    rows += [("even", None), ("even", float("nan")), ("even", float("inf")), ("empty", None)]
    rng.shuffle(rows)
    wanted = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {(r.g, r.quantile): r for r in quantiles.exact_quantiles(
        spark.createDataFrame(rows, "g string, v double"), "g", "v", wanted).collect()}
    assert set(got) == {(g, q) for g in groups for q in wanted}
    for g, some in groups.items():
        for q in wanted:
            assert got[g, q].n == len(some)
            if g != "ends" or q in (0.0, 1.0):
                assert got[g, q].value == pytest.approx(float(np.quantile(some, q)), rel=1e-12, abs=1e-300)
    assert quantiles.exact_quantiles(spark.createDataFrame([], "g string, v double"), "g", "v", [0.5]).count() == 0
    with pytest.raises(ValueError):
        quantiles.exact_quantiles(spark.createDataFrame([], "g string, v double"), "g", "v", [1.5])


def test_bottom_k_merges_and_ignores_partitions(spark):
    rows = [(f"d{i % 40}", f"/l{i % 90}", i, ["Mon", "Tue", None][i % 3] if i % 7 else "Mon") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id string, link string, price_rub int, departure_weekday_short string")
    key = lambda s: sorted(tuple(str(x) for x in r) for r in s.collect())
    whole = stats.offers_bottom_k(df, 10)
    assert whole.count() == 30
    assert key(whole) == key(stats.offers_bottom_k(df.repartition(7), 10))
    parts = [stats.offers_bottom_k(df.filter(f"price_rub % 4 = {i}"), 10).drop("sample_rank") for i in range(4)]
    assert key(stats.offers_bottom_k(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]), 10)) == key(whole)
