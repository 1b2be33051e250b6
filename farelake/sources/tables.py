"""Access to the driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one table; projections and filters push into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Round-robin the rows over ``partitions`` where that is asked for: by the
    parameter, or by ``spark.farelake.scan.partitions`` for inputs that do not
    split (a file of one row group). Without either the scan stays as it is.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.farelake.scan.partitions", "0"))
    return df.repartition(n) if n > 0 else df
