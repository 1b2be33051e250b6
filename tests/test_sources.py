import datetime as dt

from pyspark.sql import functions as F

from farelake.schemas import DEFAULT_ENDPOINT, LOG_SCHEMA
from farelake.sources.log import (LANDING_SCHEMA, create_raw_table, land_documents_json, read_code_list,
                                  read_landing, read_log, read_log_since)


def test_code_list_file(spark, tmp_dir):
    path = f"{tmp_dir}/codes.txt"
    with open(path, "w") as f:
        f.write(" lon \n\n# comment\npar\nLON\n")
    assert [r.code for r in read_code_list(spark, path).collect()] == ["LON", "PAR", "LON"]


def test_landing_round_trip_and_bad_times(spark, tmp_dir):
    t = dt.datetime(2025, 12, 10, 16, 17, 57, 252607)
    docs = spark.createDataFrame(
        [("d1", DEFAULT_ENDPOINT, "{}", "{}", 200, False, t, t, t)],
        "doc_id string, endpoint string, request string, response string, status_code int, "
        "error boolean, created_at timestamp, updated_at timestamp, batch_started_at timestamp")
    land_documents_json(docs, f"{tmp_dir}/land")
    back = read_landing(spark, f"{tmp_dir}/land").first()
    assert back.created_at == t
    bad = spark.createDataFrame([("d2", None, None, None, None, None, "not a time", "2025-12-10T16:17:57+03:00", None)],
                                LANDING_SCHEMA)
    bad.write.json(f"{tmp_dir}/bad")
    r = read_landing(spark, f"{tmp_dir}/bad").first()
    assert r.created_at is None and r.updated_at == dt.datetime(2025, 12, 10, 13, 17, 57)


def test_read_log_formats_and_since(spark, tmp_dir):
    t1, t2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 3)
    log = spark.createDataFrame(
        [("a", DEFAULT_ENDPOINT, "{}", "{}", 200, False, t1, t1, t1, t1, t1),
         ("b", DEFAULT_ENDPOINT, "{}", "{}", 200, False, t2, t2, t2, t2, t2)], LOG_SCHEMA)
    log.write.json(f"{tmp_dir}/j")
    j = read_log(spark, f"{tmp_dir}/j", "json")
    assert [(f.name, f.dataType) for f in j.schema] == [(f.name, f.dataType) for f in LOG_SCHEMA]
    assert j.count() == 2
    since = read_log_since(j, dt.datetime(2025, 1, 3, 12), lookback="1 day")
    assert [r.doc_id for r in since.collect()] == ["b"]
    assert read_log_since(j, t2).count() == 0  # strictly greater


def test_create_raw_table(spark, tmp_dir):
    name = create_raw_table(spark, "raw_test", "api_log", location=f"{tmp_dir}/raw")
    assert spark.table(name).schema.fieldNames() == LOG_SCHEMA.fieldNames()
    create_raw_table(spark, "raw_test", "api_log", location=f"{tmp_dir}/raw")  # idempotent
