"""Duplicate removal on a stream with bounded state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_within_watermark(df: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """Drop repeats of ``keys`` that arrive within ``delay`` of each other in event time.

    State is dropped once the watermark passes it. A column without time zone is read
    in the session time zone, as watermarks need TIMESTAMP.
    """
    return (
        df.withColumn(time, F.col(time).cast("timestamp"))
        .withWatermark(time, delay)
        .dropDuplicatesWithinWatermark(list(keys))
    )
