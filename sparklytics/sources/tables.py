"""Reading the driver's tables.  How a scan is split belongs to the session
(``spark.sql.files.maxPartitionBytes``) and to the file layout, not to the queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df
