"""Table readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def scan_path(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def stream_table(spark: SparkSession, name: str) -> DataFrame:
    """Incremental read of an append-only table."""
    return spark.readStream.table(name)


def select_all(spark: SparkSession, schema: str, table: str) -> DataFrame:
    """``SELECT *`` by unqualified name with ``schema`` current; restores the old one."""
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(schema)
    try:
        return spark.sql(f"SELECT * FROM `{table}`")
    finally:
        spark.catalog.setCurrentDatabase(before)
