"""The checks declared on the models (J1-J11), one list for every job that runs them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.operators import anomaly as an
from farelake.operators import quality as dq

# Models, their checked columns and the parameters of the anomaly checks.
STG, ODS, FACT, LATEST = "stg_ticket_offers", "ods_ticket_offers", "dm_fact_ticket_offers", "dm_prices_latest"
ROUTE, DEP, SEARCH, AIRPORTS = ("dm_prices_agg_route", "dm_prices_agg_dep_route", "dm_prices_agg_search_dep_route",
                                "dm_airports")
NOT_NULL = {
    "stg": (STG, {"response": "error", "request": "error"}),
    "ods": (ODS, {"search_date": "error", "origin": "error", "destination": "error"}),
    "fact": (FACT, {"price_rub": "error"}),
    "latest": (LATEST, {"price_rub": "error"}),
    "agg_route": (ROUTE, {"avg_price_rub": "warn"}),
    "airports": (AIRPORTS, {"airport_code": "error"}),
}
AT_LEAST = {"fact": {"price_rub": 0}}
DIMENSIONS = ["status_code", "endpoint", "currency", "price_bucket", "transfers_cnt", "is_direct"]
HALF_DAY = {"period": "12 hours", "detection_delay": "12 hours"}
DAY = {"period": "1 day", "detection_delay": None}


def column_checks(models: dict[str, DataFrame]) -> list[DataFrame]:
    """Null and range checks: one aggregate per model."""
    return [dq.column_checks(models[m], name, columns, AT_LEAST.get(m)) for m, (name, columns) in NOT_NULL.items()]


def table_checks(models: dict[str, DataFrame], as_of) -> list[DataFrame]:
    """Uniqueness, relationship and source freshness."""
    return [
        dq.unique(models["stg"], STG, "doc_id"),
        dq.relationships(models["latest"], models["fact"], LATEST, "doc_id"),
        dq.freshness(models["stg"], "raw_api_log", "updated_at", as_of),
    ]


def anomaly_checks(models: dict[str, DataFrame]) -> list[tuple[str, str | None, DataFrame]]:
    """(model, column, scored buckets) of the anomaly checks; each model is asked for
    its newest time once."""
    fact, latest = models["fact"], models["latest"]
    newest = lambda df, ts: df.agg(F.max(ts)).first()[0]
    at = {**HALF_DAY, "as_of": newest(fact, "created_at")}
    search = models["agg_search_dep_route"].withColumn("search_date", F.col("search_date").cast("timestamp"))
    dep = models["agg_dep_route"].withColumn("departure_date", F.col("departure_date").cast("timestamp"))
    return [
        (FACT, None, an.volume_anomalies(fact, "created_at", detection_period="14 days", **at)),
        (FACT, None, an.freshness_anomalies(fact, "created_at", detection_period="7 days", **at)),
        (FACT, None, an.event_freshness_anomalies(fact, "created_at", "processed_src_dttm", **at)),
        (FACT, None, an.dimension_anomalies(fact, "created_at", DIMENSIONS, detection_period="14 days", **at)),
        (FACT, "price_rub", an.column_anomalies(fact, "created_at", ["price_rub"], detection_period="14 days", **at)),
        (LATEST, None, an.all_columns_anomalies(latest, "created_at", detection_period="14 days", **DAY)),
        (SEARCH, None, an.volume_anomalies(search, "search_date", detection_period="7 days", **DAY)),
        (DEP, "avg_price_rub", an.column_anomalies(dep, "departure_date", ["avg_price_rub"],
                                                   detection_period="7 days", **DAY)),
    ]


def anomaly_rows(models: dict[str, DataFrame]) -> list[DataFrame]:
    return [an.anomaly_summary(found, model, column) for model, column, found in anomaly_checks(models)]


def model_checks(models: dict[str, DataFrame], as_of) -> DataFrame:
    """Every declared check as one table (J12). models: stg, ods, fact, latest, agg_route,
    agg_dep_route, agg_search_dep_route and airports, best as written tables."""
    return dq.dq_report(*column_checks(models), *table_checks(models, as_of), *anomaly_rows(models))
