"""Transaction totals per customer, kept up to date from two streams.

A table kept by customer (see ``kept``) has three parts: ``totals``, mergeable sums per
customer, account and channel; ``customers``, how often each customer row was delivered; and
``result``, the totals of the join of both. A batch of either stream merges into its part and
makes the results of the buckets it touches anew, from the other part as it stands. Sums are not
idempotent: a batch is applied once, which the table's loads see to.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from terrace.operators.totals import merged_totals, partial_totals, totals_of
from terrace.streaming.kept import BUCKET_BYTES, FIRST_BITS, KeptTable, Load, Replacement, merged

TOTALS, CUSTOMERS, RESULT = "totals", "customers", "result"


class KeptTotals:
    """The table at ``path``: ``key`` joins both streams, ``keys`` are the columns of customers that the result has."""

    def __init__(
        self, spark: SparkSession, path: str, key: str, keys: Sequence[str], money: str | None = None,
        bucket_bytes: int = BUCKET_BYTES,
    ):
        self.table, self.key, self.keys, self.money = KeptTable(spark, path, bucket_bytes), key, list(keys), money

    def _new(self, part: str, rows: DataFrame) -> DataFrame:
        rows = rows.filter(F.col(self.key).isNotNull()).withColumn(self.key, F.col(self.key).cast("bigint"))
        if part == CUSTOMERS:
            return rows.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("copies"))
        return partial_totals(rows, [self.key], self.money)

    def _result(self, customers: DataFrame, totals: DataFrame) -> DataFrame:
        return totals_of(customers, totals, self.key, self.keys)

    def _schemas(self, customers: StructType, transactions: StructType) -> dict[str, StructType]:
        empty = lambda schema: self.table.spark.createDataFrame([], schema)
        of = {CUSTOMERS: self._new(CUSTOMERS, empty(customers)), TOTALS: self._new(TOTALS, empty(transactions))}
        of[RESULT] = self._result(of[CUSTOMERS], of[TOTALS])
        return {part: merged(df.schema, df.schema) for part, df in of.items()}

    def declare(self, customers: StructType, transactions: StructType) -> None:
        """Name the columns of both streams; the result is empty until they meet."""
        with self.table.lock():
            if self.table.last() is None:
                self.table.commit(Load(0, FIRST_BITS, 0, self._schemas(customers, transactions), {}))

    def add(self, part: str, rows: DataFrame, flow: str, number: int) -> None:
        """Apply a batch of one of the streams, unless it has been applied."""

        def make(last: Load | None) -> Replacement:
            if last is None:
                raise ValueError(f"declare the totals at {self.table.root} first")
            batch = Replacement(self.table, [self.key], last, last.schemas)
            new = batch.begin(self._new(part, rows), part)
            if not batch.touched:
                return batch
            both = {p: batch.stored(p) for p in (CUSTOMERS, TOTALS)}
            if part == CUSTOMERS:
                whole = both[part].unionByName(new).groupBy(*self.keys).agg(F.sum("copies").alias("copies"))
            else:
                whole = merged_totals(both[part].unionByName(new), [self.key])
            both[part] = batch.keep(whole, part, last.schemas[part])
            # Parts of buckets that this load divides move along.
            for p, df in both.items():
                if p == part or batch.divides():
                    batch.write({p: df})
            batch.write({RESULT: self._result(both[CUSTOMERS], both[TOTALS])})
            return batch

        self.table.apply_once(flow, number, make)

    def stream(self, part: str, df: DataFrame, checkpoint: str, interval: str | None = None) -> StreamingQuery:
        """Start applying one of the streams, by default what is there."""

        def apply(rows: DataFrame, number: int) -> None:
            self.add(part, rows, rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"), number)

        writer = df.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
        return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()

    def read(self) -> DataFrame:
        """Totals per customer row: a plain scan."""
        return self.table.read(self.table.last(), RESULT)
