"""Full refresh composition: log -> stg -> ods -> fact -> marts (K1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.operators.fact import fact_offers
from farelake.operators.flatten import ods_flatten, stage_current
from farelake.operators import marts
from farelake.plans.checks import model_checks
from farelake.schemas import DEFAULT_ENDPOINT
from farelake.sources.fixtures import offer_log

# Run timestamp used by the registered queries so results repeat.
RUN_TS = "2026-01-01 00:00:00"


def offer_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_current(offer_log(spark, sf_dir), DEFAULT_ENDPOINT)


def offer_ods(spark: SparkSession, sf_dir: str, processed_at=RUN_TS) -> DataFrame:
    return ods_flatten(offer_stage(spark, sf_dir), processed_at=processed_at)


def offer_fact(spark: SparkSession, sf_dir: str, processed_at=RUN_TS) -> DataFrame:
    return fact_offers(offer_ods(spark, sf_dir, processed_at))


def to_output(df: DataFrame) -> DataFrame:
    """Zone-less timestamps for consumers outside Spark (session zone is UTC)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# Schema of each model layer; a layer without one uses the default.
LAYER_SCHEMAS = {"stg": "stg", "ods": "ods", "dm": "dm"}
MODEL_LAYERS = {
    "stg_ticket_offers": "stg", "ods_ticket_offers": "ods", "dm_fact_ticket_offers": "dm",
    "dm_prices_latest": "dm", "dm_prices_agg_route": "dm", "dm_prices_agg_dep_route": "dm",
    "dm_prices_agg_search_dep_route": "dm", "dm_airports": "dm", "dq_results": None,
}


def table_name(model: str, default_schema: str = "raw") -> str:
    """``schema.model``: the layer's custom schema used verbatim, else the default."""
    custom = LAYER_SCHEMAS.get(MODEL_LAYERS.get(model) or "")
    return f"{(custom or default_schema).strip()}.{model}"


def register_table(spark: SparkSession, name: str, path: str, db_root: str) -> None:
    """Expose a written table in the session catalog so ``spark.sql`` reads it."""
    db, table = name.split(".")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{db_root}/{db}.db'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")


def create_view(spark: SparkSession, name: str, query: str, temporary: bool = False) -> None:
    """``schema.model`` as a view over registered tables (A7); temporary views have no schema."""
    kind = "TEMPORARY VIEW" if temporary else "VIEW"
    spark.sql(f"CREATE OR REPLACE {kind} {name} AS {query}")


def run_full_refresh(spark: SparkSession, log: DataFrame, out_dir: str, processed_at=None,
                     endpoint: str | None = DEFAULT_ENDPOINT, as_of=None,
                     register: bool = True) -> dict[str, str]:
    """Full refresh of every model from a document log, then the checks (K1).

    stg -> ods -> fact are written once; the five marts read the written fact,
    so the JSON parse and unnest run a single time. The declared checks run on
    the written models and land in ``dq_results`` (J12). Each table is
    registered as ``schema.model`` in the session catalog. Returns name -> path.
    """
    paths: dict[str, str] = {}

    def write(model: str, df: DataFrame) -> DataFrame:
        path = f"{out_dir}/{model}"
        df.write.mode("overwrite").parquet(path)
        paths[model] = path
        return spark.read.parquet(path)

    stg = write("stg_ticket_offers", stage_current(log, endpoint))
    ods = write("ods_ticket_offers", ods_flatten(stg, processed_at=processed_at))
    fact = write("dm_fact_ticket_offers", fact_offers(ods))
    models = {"stg": stg, "ods": ods, "fact": fact, "latest": write("dm_prices_latest", marts.first_offer(fact))}
    for name, df in marts.from_sums(marts.route_sums(fact)).items():
        models[name] = write(f"dm_prices_{name}", df)
    models["airports"] = write("dm_airports", marts.airports(fact))
    write("dq_results", model_checks(models, as_of if as_of is not None else F.current_timestamp()))
    if register:
        for model, path in paths.items():
            register_table(spark, table_name(model), path, out_dir)
    return paths
