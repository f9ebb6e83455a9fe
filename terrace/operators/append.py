"""Fan-in: several feeds into one frame, to be written by a single query."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def append_flows(*flows: DataFrame) -> DataFrame:
    """UNION ALL by column name, batch or streaming.

    Use this rather than two streaming writers into one folder: the file sink's log is
    keyed by batch id, so the second writer's batches would be skipped as already done.
    """
    if not flows:
        raise ValueError("append_flows needs at least one frame")
    return reduce(DataFrame.unionByName, flows)
