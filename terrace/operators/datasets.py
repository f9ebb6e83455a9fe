"""Named datasets: views, stored tables and their comments."""

from __future__ import annotations

import inspect
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

Dataset = Callable[..., DataFrame]


def named(*functions: Dataset) -> dict[str, Dataset]:
    """Datasets by name, which is the name of the function that defines them."""
    return {f.__name__: f for f in functions}


def comment_of(dataset: Dataset) -> str:
    """First line of the function's description."""
    return (inspect.getdoc(dataset) or "").split("\n")[0]


def set_comment(spark: SparkSession, table: str, comment: str) -> None:
    spark.sql(f"COMMENT ON TABLE {table} IS :comment", args={"comment": comment})


def save_table(df: DataFrame, table: str, comment: str | None = None) -> DataFrame:
    """Recompute a stored table in full and return it.

    The rows are written beside the last ones and take their place when they are complete: a
    run that fails leaves the table as it was, and a table may be recomputed from itself.
    """
    spark = df.sparkSession
    name = f"{table.rsplit('.', 1)[-1]}_{uuid.uuid4().hex}"
    new = ".".join([*table.rsplit(".", 1)[:-1], name])
    df.write.saveAsTable(new)
    if comment:
        set_comment(spark, new, comment)
    old = f"{new}_old"
    had = spark.catalog.tableExists(table)
    if had:
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    except Exception:
        if had:
            spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
        raise
    if had:
        spark.sql(f"DROP TABLE {old}")
    return spark.read.table(table)


def save_view(df: DataFrame, name: str) -> DataFrame:
    """Name a query, batch or streaming, without storing anything."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def preview(spark: SparkSession, tables: Iterable[str], rows: int = 10) -> None:
    """Print a few rows and the row count of each table."""
    for table in tables:
        df = spark.read.table(table)
        print(f"===== {table} =====")
        df.limit(rows).show(truncate=False)
        df.selectExpr("count(*) AS row_count").show()
