import datetime as dt

from pyspark.sql import functions as F

from farelake.functions import (day_spine_array, is_direct, lead_bucket, month_from_text,
                                month_spine_array, price_bucket, quoted_json_text,
                                search_date_from_link, weekday_full, weekday_short)


def test_price_bucket_edges(spark):
    df = spark.createDataFrame([(None,), (4999,), (5000,), (15000,), (15001,)], "p int")
    got = [r[0] for r in df.select(price_bucket("p")).collect()]
    assert got == ["expensive", "cheap", "medium", "medium", "expensive"]


def test_is_direct_null_is_false(spark):
    df = spark.createDataFrame([(None,), (0,), (2,)], "t int")
    assert [r[0] for r in df.select(is_direct("t")).collect()] == [False, True, False]


def test_lead_bucket_right_closed(spark):
    df = spark.createDataFrame([(d,) for d in [0, 1, 7, 8, 365, 366]], "d int")
    got = [r[0] for r in df.select(lead_bucket("d")).collect()]
    assert got == [None, "0-7", "0-7", "8-14", "181-365", None]
    low = [r[0] for r in df.select(lead_bucket("d", include_lowest=True)).collect()]
    assert low[0] == "0-7"


def test_month_text_and_link_date(spark):
    df = spark.createDataFrame([("2025-12", "/x?search_date=05122025"),
                                ("2025-12-15", "/x?nothing=1")], "m string, link string")
    rows = df.select(month_from_text("m").alias("m"), search_date_from_link("link").alias("s")).collect()
    assert rows[0].m == dt.date(2025, 12, 1) and rows[1].m == dt.date(2025, 12, 1)
    assert rows[0].s == dt.date(2025, 12, 5) and rows[1].s is None


def test_weekday_names(spark):
    df = spark.createDataFrame([(dt.date(2025, 12, 1),)], "d date")
    r = df.select(weekday_short("d"), weekday_full("d")).first()
    assert tuple(r) == ("Mon", "Monday")


def test_quoted_json_text_escapes(spark):
    df = spark.createDataFrame([('say "hi" \\ ok',)], "t string")
    q = df.select(quoted_json_text("t").alias("q")).first().q
    import json
    assert json.loads(q) == 'say "hi" \\ ok'


def test_spines(spark):
    df = spark.createDataFrame([(dt.date(2025, 12, 12),)], "d date")
    months = df.select(month_spine_array(F.col("d")).alias("m")).first().m
    assert len(months) == 13 and months[0] == "2025-12" and months[1] == "2026-01" and months[-1] == "2026-12"
    days = df.select(day_spine_array(F.col("d")).alias("x")).first().x
    assert len(days) == 385 and days[-1] == dt.date(2026, 12, 31)
