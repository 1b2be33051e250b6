"""What the offer chain computes only once."""

import os

from pyspark.sql import functions as F

from farelake.operators import stats
from farelake.operators.fact import fact_offers
from farelake.operators.flatten import ods_flatten
from farelake.plans.queries import QUERIES
from farelake.sources.fixtures import offer_log
from farelake.sources.log import land_documents_json, read_landing

SF = "/root/testdata/sf0.001"


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_responses_are_parsed_once(spark):
    plan = optimized(fact_offers(ods_flatten(offer_log(spark, SF))))
    filters = [line for line in plan.split("\n") if line.lstrip(" :+-").startswith("Filter")]
    assert not [line for line in filters if "from_json" in line and "success" in line]


def test_requests_are_not_parsed_for_each_line_item(spark):
    plan = optimized(fact_offers(ods_flatten(offer_log(spark, SF))))
    below = plan[plan.index("RepartitionByExpression"):]
    assert "from_json" not in below


def test_landed_json_is_compressed_and_reads_back(spark, tmp_dir):
    docs, path = offer_log(spark, SF), f"{tmp_dir}/landed"
    land_documents_json(docs, path)
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert files and all(f.endswith(".json.gz") for f in files)
    same = ["doc_id", "request", "response", "created_at"]
    assert read_landing(spark, path).select(*same).exceptAll(docs.select(*same)).isEmpty()


def test_smoothing_computes_its_series_once(spark):
    lead = spark.range(50).select(F.col("id").alias("days_before_departure"), F.col("id").alias("price_rub"))
    plan = executed(stats.smooth_lead_curve(lead))
    assert "Range (" not in plan


def test_price_extremes_reads_a_written_fact(spark):
    assert "lineitem.parquet" not in executed(QUERIES["price_extremes"](spark, SF))


def test_offers_are_shuffled_once_as_small_columns(spark):
    """The document grouping ships no column that its keys give; kept models are packed well."""
    import pyarrow.parquet as pq
    from farelake.plans.queries import _written
    from farelake.sources.fixtures import offer_log
    plan = offer_log(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    below = plan.split("RepartitionByExpression", 1)[1]
    assert "AS flight_number" not in below and "AS transfers" not in below
    path = _written(spark.range(10).selectExpr("id", "'x' as t"), "packed").inputFiles()[0].replace("file:", "")
    assert pq.ParquetFile(path).metadata.row_group(0).column(0).compression == "ZSTD"
