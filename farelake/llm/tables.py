"""Reading inputs and keeping intermediate tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from farelake.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] = ()) -> DataFrame:
    """One input table with the named columns only; other columns are not read."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared checkpoint folder: computed once, lineage cut,
    readable after the loss of any executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
