import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from farelake.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
FAST = ["agg_route", "stats_month", "stats_weekday", "smooth_lead_curve", "price_extremes",
        "validate_requests", "batch_summary", "scd2_history", "dq_volume", "dq_column", "airports"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["origin", "destination", "avg_price_rub"]
    assert df.count() > 0


def test_every_warehouse_query_has_sql():
    assert set(E.QUERIES) - set(E.oracle_sql()) == set()


@pytest.mark.parametrize("gone", [["farelake/llm", "tests/llm"], ["farelake/llm", "tests/llm", "corpus_pipeline.py"],
                                  ["corpus_pipeline.py"]])
def test_entry_without_the_training_data_parts(tmp_path, gone):
    root = Path(E.__file__).parent
    skip = shutil.ignore_patterns(".git", "__pycache__", "spark-warehouse")
    shutil.copytree(root / "farelake", tmp_path / "farelake", ignore=lambda folder, names: [
        *skip(folder, names), *[n for n in names if str((Path(folder) / n).relative_to(root)) in gone]])
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (root / name).exists() and name not in gone:
            shutil.copy(root / name, tmp_path / name)
    run = subprocess.run([sys.executable, "-c", "import __spark_entry__ as E; print(len(E.QUERIES), set(E.queries()) >= "
                          "set(E.QUERIES), 'pipeline' in E.queries())"], cwd=tmp_path, capture_output=True, text=True,
                         timeout=120, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": ":".join(p for p in sys.path if p and Path(p) != root)})
    assert run.returncode == 0, run.stderr
    assert run.stdout.split() == [str(len(E.QUERIES)), "True", "False"]


def _canon(df):
    df = df[sorted(df.columns)].astype(str)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle_small(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = E.queries()[name](spark, SF).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    for c in got.columns:
        if pd.api.types.is_float_dtype(got[c]):
            got[c] = got[c].round(6)
            want[c] = want[c].astype(float).round(6)
        if pd.api.types.is_datetime64_any_dtype(want[c]):
            got[c] = pd.to_datetime(got[c])
            want[c] = pd.to_datetime(want[c])
    pd.testing.assert_frame_equal(_canon(got), _canon(want))
