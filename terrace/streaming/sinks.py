"""Append-only streaming targets."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def write_stream(
    df: DataFrame,
    *,
    checkpoint: str,
    path: str | None = None,
    table: str | None = None,
    name: str | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Start appending ``df`` to a parquet folder or a table.

    By default the query takes everything available and stops; the next run with the
    same checkpoint takes only what is new. With ``interval`` it keeps running. Give
    each target exactly one query (fan in with ``append_flows`` first).
    """
    if (path is None) == (table is None):
        raise ValueError("give either path or table")
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if name is not None:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start(path) if path is not None else writer.toTable(table)


def finish(*queries: StreamingQuery) -> None:
    """Wait for queries that stop by themselves; then raise the first failure, if any."""
    failures = []
    for query in queries:
        try:
            query.awaitTermination()
        except StreamingQueryException as e:
            failures.append(e)
    if failures:
        raise failures[0]

