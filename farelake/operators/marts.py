"""Price marts over the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelake.functions.dates import weekday_short

ROUTE = ["origin", "destination"]


def agg_route(fact: DataFrame) -> DataFrame:
    """Mean price per route."""
    return fact.groupBy(*ROUTE).agg(F.avg("price_rub").alias("avg_price_rub"))


def agg_dep_route(fact: DataFrame) -> DataFrame:
    """Mean price per departure day and route; weekday rides along.

    The weekday is a function of the day, so ``any_value`` (NULLs skipped, as
    in PostgreSQL) is deterministic.
    """
    return (fact.groupBy("departure_date", *ROUTE)
                .agg(F.any_value("departure_weekday_short", True).alias("departure_weekday"),
                     F.avg("price_rub").alias("avg_price_rub"))
                .select("departure_date", "departure_weekday", *ROUTE, "avg_price_rub"))


def agg_search_dep_route(fact: DataFrame) -> DataFrame:
    """Mean price per search day, departure day and route (D3)."""
    return (fact.groupBy("search_date", "departure_date", *ROUTE)
                .agg(F.any_value("search_weekday_short", True).alias("search_weekday"),
                     F.any_value("departure_weekday_short", True).alias("departure_weekday"),
                     F.avg("price_rub").alias("avg_price_rub"))
                .select("search_date", "search_weekday", "departure_date", "departure_weekday",
                        *ROUTE, "avg_price_rub"))


def route_sums(fact: DataFrame) -> DataFrame:
    """Sum and count of prices per search day, departure day and route: partial
    aggregates of D1-D3, which add up over any split of the fact."""
    return fact.groupBy("search_date", "departure_date", *ROUTE).agg(
        F.sum("price_rub").alias("price_sum"), F.count("price_rub").alias("price_n"))


def add_sums(sums: DataFrame) -> DataFrame:
    """Sums of several parts as one row a group."""
    return sums.groupBy("search_date", "departure_date", *ROUTE).agg(
        F.sum("price_sum").alias("price_sum"), F.sum("price_n").alias("price_n"))


def from_sums(sums: DataFrame) -> dict[str, DataFrame]:
    """The three mean-price marts (D1-D3) from ``route_sums`` rows."""
    def mean(*keys: str) -> DataFrame:
        return sums.groupBy(*keys).agg(
            F.try_divide(F.sum("price_sum"), F.sum("price_n")).alias("avg_price_rub"))

    return {
        "agg_route": mean(*ROUTE),
        "agg_dep_route": mean("departure_date", *ROUTE).select(
            "departure_date", weekday_short("departure_date").alias("departure_weekday"), *ROUTE, "avg_price_rub"),
        "agg_search_dep_route": mean("search_date", "departure_date", *ROUTE).select(
            "search_date", weekday_short("search_date").alias("search_weekday"),
            "departure_date", weekday_short("departure_date").alias("departure_weekday"), *ROUTE, "avg_price_rub"),
    }


FIRST_OFFER_KEYS = ["departure_date", "destination", "origin"]


def first_offer(fact: DataFrame, tie_break: str | None = "link") -> DataFrame:
    """Earliest-created offer per departure day and route, with ``rn``.

    Order: created_at, processed_src_dttm, doc_id (all ascending, NULLs last as
    in PostgreSQL), then ``tie_break`` because one document can hold several
    offers of the same group. ``rn = 1`` lets Catalyst plan a partial
    WindowGroupLimit before the shuffle, so a hot group ships one row per map
    task instead of all its rows.
    """
    order = [F.col("created_at").asc_nulls_last(), F.col("processed_src_dttm").asc_nulls_last(),
             F.col("doc_id").asc_nulls_last()]
    if tie_break:
        order.append(F.col(tie_break).asc_nulls_last())
    w = Window.partitionBy(*FIRST_OFFER_KEYS).orderBy(*order)
    return fact.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") == 1)


def latest_cheapest(fact: DataFrame) -> DataFrame:
    """Variant the mart's description promises: latest created, then cheapest."""
    w = Window.partitionBy(*FIRST_OFFER_KEYS).orderBy(
        F.col("created_at").desc_nulls_last(), F.col("price_rub").asc_nulls_last(),
        F.col("doc_id").asc_nulls_last(), F.col("link").asc_nulls_last())
    return fact.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") == 1)


def airports(fact: DataFrame) -> DataFrame:
    """Distinct (airport, city) pairs over origins and destinations (G1).

    One scan: both pairs of a row are generated side by side and de-duplicated
    with a partial aggregate before the shuffle. NULL codes are kept.
    """
    pairs = F.array(
        F.struct(F.col("origin_airport").alias("airport_code"), F.col("origin").alias("city_code")),
        F.struct(F.col("destination_airport").alias("airport_code"),
                 F.col("destination").alias("city_code")))
    return (fact.select(F.explode(pairs).alias("p"))
                .select("p.airport_code", "p.city_code").distinct())


def constant_relation(spark: SparkSession) -> DataFrame:
    """Starter model: rows (1) and (NULL) by UNION ALL, then ``id = 1``.

    Library only: it reads no table, so it is not a registered query.
    """
    first = spark.range(1).select(F.lit(1).cast("int").alias("id")).unionByName(
        spark.range(1).select(F.lit(None).cast("int").alias("id")))
    return first.filter(F.col("id") == 1)
