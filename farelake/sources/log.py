"""Document-log sources and sinks (A1-A5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from farelake.functions.dates import parse_iso_ts
from farelake.functions.json import quoted_json_text
from farelake.schemas import DOC_COLUMNS, LOG_SCHEMA, SENTINEL

TIME_COLUMNS = ["created_at", "updated_at", "batch_started_at"]

# Landing document as the collector writes it: timestamps are ISO-8601 text.
LANDING_SCHEMA = T.StructType([
    T.StructField(f.name, T.StringType() if f.name in TIME_COLUMNS else f.dataType, True)
    for f in LOG_SCHEMA.fields if f.name in DOC_COLUMNS
])


def read_log(spark: SparkSession, path: str, fmt: str = "parquet", schema=LOG_SCHEMA,
             options: dict | None = None) -> DataFrame:
    """Full scan of the document log in any file format (A1).

    JSON-lines and CSV need the declared schema (no inference at scale);
    parquet/orc carry it. Other connectors (jdbc, mongodb) are format strings
    whose jars the cluster provides.
    """
    r = spark.read.format(fmt).options(**(options or {}))
    if fmt in ("json", "csv"):
        r = r.schema(schema)
    return r.load(path)


LANDING_FILE_DOCS = 2000  # a compressed file is read by one task


def land_documents_json(docs: DataFrame, path: str) -> None:
    """Write landing documents as JSON lines with ISO-8601 text timestamps (A5 sink), compressed."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    cols = [F.date_format(c, iso).alias(c) if c in TIME_COLUMNS else F.col(c) for c in DOC_COLUMNS]
    docs.select(*cols).write.mode("append").option("maxRecordsPerFile", LANDING_FILE_DOCS).json(path, compression="gzip")


def read_landing(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Landing documents with the declared schema; ISO-8601 texts are parsed to
    timestamps, and text that does not parse becomes NULL (H18)."""
    raw = spark.read.schema(LANDING_SCHEMA).format(fmt).load(path)
    return raw.select(*[parse_iso_ts(c).alias(c) if c in TIME_COLUMNS else F.col(c)
                        for c in DOC_COLUMNS])


def read_log_since(df: DataFrame, watermark, column: str = "updated_at",
                   lookback=None) -> DataFrame:
    """Documents updated strictly after a watermark.

    ``watermark`` is a timestamp value or a Column (e.g. a scalar subquery);
    ``lookback`` (e.g. ``"1 day"``) is subtracted first so late updates of the
    last period are re-read. The filter is a plain comparison, so it pushes into
    the parquet scan when the watermark is a literal.
    """
    wm = watermark if isinstance(watermark, F.Column) else F.lit(watermark).cast("timestamp")
    if lookback:
        wm = wm - F.expr(f"interval {lookback}")
    return df.filter(F.col(column) > wm)


def log_watermark(target: DataFrame, column: str = "updated_at", lookback: str | None = "1 day",
                  default: str = "1970-01-01 00:00:00") -> F.Column:
    """``coalesce(max(column), default) - lookback`` over the target as a literal.

    The maximum is one aggregate row read once (a bounded scalar), so the
    comparison that uses it pushes into the source scan like any literal.
    """
    m = target.agg(F.max(column)).first()[0]
    wm = F.lit(m if m is not None else default).cast("timestamp")
    if lookback:
        wm = wm - F.expr(f"interval {lookback}")
    return wm


def read_since_table(source: DataFrame, target: DataFrame, column: str = "updated_at",
                     lookback: str | None = "1 day", target_column: str | None = None) -> DataFrame:
    """Source rows strictly past the target's watermark."""
    return source.filter(F.col(column) > log_watermark(target, target_column or column, lookback))


def read_code_list(spark: SparkSession, path: str) -> DataFrame:
    """Code list text file: trimmed, upper-cased, blank and '#' lines skipped (A3)."""
    return code_list_from(spark.read.text(path), "value")


def code_list_from(df: DataFrame, column: str) -> DataFrame:
    """A3 rules applied to a text column; keeps order-free list with duplicates."""
    code = F.upper(F.trim(F.col(column)))
    return (df.select(code.alias("code"))
              .filter((F.col("code") != "") & ~F.col("code").startswith("#")))


def create_raw_table(spark: SparkSession, database: str = "raw",
                     table: str = "api_log", location: str | None = None) -> str:
    """Create-if-missing namespace and raw log table with the fixed schema (A4)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    default = {"valid_from_dttm": " DEFAULT current_timestamp()",
               "valid_to_dttm": f" DEFAULT TIMESTAMP '{SENTINEL}'"}
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}{default.get(f.name, '')}" for f in LOG_SCHEMA.fields)
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{table} ({cols}) USING parquet{loc}")
    return f"{database}.{table}"


def build_documents(calls: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Landing documents from call results (A5).

    ``calls`` has ``doc_id, endpoint, request, response_json, error_text,
    http_status, created_at, updated_at, batch_started_at``. A call with
    ``error_text`` becomes an error document (response = quoted text,
    status from the failure or NULL, ``error = true``); otherwise a normal
    document (status 200, ``error = false``). Both sets are unioned; ``extra``
    columns are carried through.
    """
    extra = list(extra or [])
    failed = F.col("error_text").isNotNull()
    ok = calls.filter(~failed).select(
        "doc_id", "endpoint", "request", F.col("response_json").alias("response"),
        F.lit(200).alias("status_code"), F.lit(False).alias("error"),
        "created_at", "updated_at", "batch_started_at", *extra)
    bad = calls.filter(failed).select(
        "doc_id", "endpoint", "request", quoted_json_text(F.col("error_text")).alias("response"),
        F.col("http_status").cast("int").alias("status_code"), F.lit(True).alias("error"),
        "created_at", "updated_at", "batch_started_at", *extra)
    return ok.unionByName(bad)
