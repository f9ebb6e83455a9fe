"""File readers. Schemas are always given, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _csv_options(header: bool, check_header: bool, malformed: str | None) -> dict[str, object]:
    # Columns bind by position. enforceSchema=false makes Spark compare the header
    # with the schema, so a file with swapped columns fails instead of landing wrong.
    options = {"header": header, "enforceSchema": not check_header, "mode": "PERMISSIVE"}
    return options | ({"columnNameOfCorruptRecord": malformed} if malformed else {})


def _with_malformed(schema: str | StructType, malformed: str | None) -> StructType:
    parsed = StructType.fromDDL(schema) if isinstance(schema, str) else StructType(list(schema.fields))
    return parsed.add(malformed, "string") if malformed else parsed


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    *,
    header: bool = True,
    check_header: bool = True,
    malformed: str | None = None,
) -> DataFrame:
    """Batch read; cells that do not parse become NULL.

    ``malformed`` names a column to add, with the whole line where any cell did not parse or
    their number is wrong, else NULL.
    """
    reader = spark.read.schema(_with_malformed(schema, malformed))
    return reader.options(**_csv_options(header, check_header, malformed)).csv(path)


def stream_csv(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    *,
    header: bool = True,
    check_header: bool = True,
    max_files: int | None = None,
    malformed: str | None = None,
) -> DataFrame:
    """Incremental read of a folder: files already there first, then each new file once; ``malformed`` as in ``read_csv``."""
    reader = spark.readStream.schema(_with_malformed(schema, malformed))
    reader = reader.options(**_csv_options(header, check_header, malformed))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(path)


def stream_parquet(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    *,
    glob: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Incremental read of a folder of parquet files."""
    reader = spark.readStream.schema(schema)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def with_audit_columns(df: DataFrame) -> DataFrame:
    """Add the source file and the ingest time; call it directly on a file read."""
    return df.select("*", F.col("_metadata.file_path").alias("source_file"), F.current_timestamp().alias("ingested_at"))
