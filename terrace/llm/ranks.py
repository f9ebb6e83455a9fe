"""Places of rows in an order, and running values along it, without one task per key.

Rows are range-sorted by (keys, order), so that Spark cuts a long key where it likes, and
written with the number of their range and their place in it. What precedes a row is then
its place in the range and one small row per range and key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import stored

#: Rows that ``monotonically_increasing_id`` leaves for one task.
IN_TASK = 33


def ranged(rows: DataFrame, keys: list[str], order: list[str], label: str) -> DataFrame:
    """``rows`` written in order of (keys, order) with ``at``: range number and place in the range."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [*keys, *order]
    sorted_ = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    return stored(sorted_.withColumn("at", F.monotonically_increasing_id()), label)


def range_of(at: str = "at") -> Column:
    return F.shiftright(at, IN_TASK)


def places(cut: DataFrame, keys: list[str]) -> DataFrame:
    """Per range and key of a ``ranged`` table: first ``at``, ``start`` (rows of the key in earlier ranges), ``n`` (of all)."""
    counted = cut.groupBy(range_of().alias("range"), *keys).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("here"))
    of_key = Window.partitionBy(*keys)
    earlier = of_key.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select(
        "range",
        *keys,
        "first",
        F.coalesce(F.sum("here").over(earlier), F.lit(0)).alias("start"),
        F.sum("here").over(of_key).alias("n"),
    )


def running(cut: DataFrame, keys: list[str], fold: dict[str, tuple]) -> DataFrame:
    """Adds to a ``ranged`` table what ``fold`` makes of a key's rows up to and including each row.

    ``fold`` has for each new column the aggregate function, the column it reads and the
    function that puts two results together, for which 0 is neutral.
    """
    with_range = cut.withColumn("range", range_of())
    totals = with_range.groupBy("range", *keys).agg(*(f(c).alias(name) for name, (f, c, _) in fold.items()))
    earlier = Window.partitionBy(*keys).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        "range", *keys, *(F.coalesce(f(name).over(earlier), F.lit(0)).alias(f"{name}_before") for name, (f, _, _) in fold.items())
    )
    inside = Window.partitionBy("range", *keys).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = with_range.withColumns({name: f(c).over(inside) for name, (f, c, _) in fold.items()})
    joined = here.join(before, ["range", *keys])
    joined = joined.withColumns({name: both(F.col(name), F.col(f"{name}_before")) for name, (_, _, both) in fold.items()})
    return joined.drop("range", *(f"{name}_before" for name in fold))
