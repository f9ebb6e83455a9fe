"""Per-customer transaction totals that stay balanced when a customer is hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sums of this type are exact, so they do not depend on the order of addition.
CENTS = "decimal(18,2)"

DETAIL = ("account_id", "txn_channel")


def money_sum(value: Column, money: str | None) -> Column:
    """Sum as ``money`` type, or as the column's own type when None."""
    return F.sum(value if money is None else value.cast(money))


def _when_type(name: str) -> Column:
    return F.when(F.col("txn_type") == name, F.col("txn_amount")).otherwise(F.lit(0.0))


def partial_totals(rows: DataFrame, keys: Sequence[str], money: str | None = None) -> DataFrame:
    """Totals per key, account and channel.

    This first step combines on the map side to a few rows per key, so the distinct
    counts that follow expand those instead of every transaction, and a hot key is
    spread over its accounts and channels.
    """
    amount = F.col("txn_amount")
    return rows.groupBy(*keys, *DETAIL).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(amount).alias("n_amount"),
        money_sum(_when_type("CREDIT"), money).alias("credits"),
        money_sum(_when_type("DEBIT"), money).alias("debits"),
        money_sum(amount, money).alias("amount"),
        F.min("txn_date").alias("first_txn_date"),
        F.max("txn_date").alias("last_txn_date"),
    )


def merged_totals(partial: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partial totals of several batches put together, with the same columns."""
    combine = {"first_txn_date": F.min, "last_txn_date": F.max}
    by = [*keys, *DETAIL]
    measures = [c for c in partial.columns if c not in by]
    return partial.groupBy(*by).agg(
        *[combine.get(c, F.sum)(c).cast(partial.schema[c].dataType).alias(c) for c in measures]
    )


def totals_of(groups: DataFrame, partial: DataFrame, key: str, keys: Sequence[str]) -> DataFrame:
    """Totals of customers (``keys`` and ``copies``, how often each was delivered) from partial totals per ``key``."""
    return groups.join(_totals(partial, [key]), key, "inner").select(*keys, *_measures(F.col("copies")))


def _totals(partial: DataFrame, keys: Sequence[str]) -> DataFrame:
    return partial.groupBy(*keys).agg(
        F.count_distinct("account_id").alias("accounts_count"),
        F.sum("n").alias("n"),
        F.sum("n_amount").alias("n_amount"),
        F.sum("credits").alias("credits"),
        F.sum("debits").alias("debits"),
        F.sum("amount").alias("amount"),
        F.min("first_txn_date").alias("first_txn_date"),
        F.max("last_txn_date").alias("last_txn_date"),
        F.count_distinct("txn_channel").alias("channels_used"),
    )


def _measures(copies: Column) -> list[Column]:
    """Final measures; ``copies`` is how often each transaction occurs in the join."""
    return [
        F.col("accounts_count"),
        (F.col("n") * copies).alias("txn_count"),
        (F.col("credits") * copies).cast("double").alias("total_credits"),
        (F.col("debits") * copies).cast("double").alias("total_debits"),
        F.when(F.col("n_amount") > 0, F.col("amount").cast("double") / F.col("n_amount")).alias("avg_txn_amount"),
        F.col("first_txn_date"),
        F.col("last_txn_date"),
        F.col("channels_used"),
    ]


def transaction_totals(joined: DataFrame, keys: Sequence[str], money: str | None = None) -> DataFrame:
    """Aggregate an already joined customer x transaction table by ``keys``."""
    totals = _totals(partial_totals(joined, keys, money), keys)
    return totals.select(*keys, *_measures(F.lit(1)))


def joined_transaction_totals(
    customers: DataFrame, transactions: DataFrame, key: str, keys: Sequence[str], money: str | None = None
) -> DataFrame:
    """``transaction_totals`` of the inner join of both on ``key``, without building the join.

    Transactions are summed per ``key`` before they meet the customers, so the join sees
    one row per key instead of one per transaction. A customer row delivered ``m`` times
    multiplies counts and sums by ``m``, as it does in the join.
    """
    known = transactions.filter(F.col(key).isNotNull()).withColumn(key, F.col(key).cast("bigint"))
    groups = (
        customers.withColumn(key, F.col(key).cast("bigint"))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    return totals_of(groups, partial_totals(known, [key], money), key, keys)
