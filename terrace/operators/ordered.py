"""Ordered work per key that survives hot keys.

A window over a key sorts all rows of that key in one task. When one key holds a
large share of the data that task never ends, so keys above ``hot_rows`` rows are cut
into *slices*: contiguous ranges of the key's order, produced by Spark's own range
partitioning. Windows then run per (key, slice), and what one slice needs from the
others travels in a carry table with one row per slice. The result is the same as
that of the plain window.

Range partitioning draws a sample for the driver with every partition it makes, and each
is a task with a result. Where ``hot_rows`` asks for more slices than the cluster shuffles
into, the ranges stay that many and are divided further where their rows are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from terrace.session import materialize

SLICE = "_slice"
# A key is cut into slices above this many rows.
DEFAULT_HOT_ROWS = 10_000_000


def null_safe(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names])


@dataclass(frozen=True)
class HotKeys:
    """Keys above ``rows`` rows: a stored table, or None if there are none; and the most rows of any key.

    Their rows make about ``slices`` slices, of at least ``ranges`` range partitions.
    """

    keys: tuple[str, ...]
    table: DataFrame | None
    slices: int
    most: int = 0
    rows: int = DEFAULT_HOT_ROWS
    ranges: int = 0


@dataclass(frozen=True)
class Split:
    """``cold`` rows fit a window per key; ``hot`` rows carry a slice column (or is None)."""

    cold: DataFrame
    hot: DataFrame | None


def find_hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int | None = None) -> HotKeys:
    """Count the rows of each key and keep the keys above ``hot_rows``.

    One pass that reads the key columns alone and combines before the shuffle. It looks at
    the rows that reach the window, whatever the sizes of the sources they come from.
    """
    hot_rows = hot_rows or DEFAULT_HOT_ROWS
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    hot = F.col("n") > hot_rows
    found = counts.agg(F.max("n").alias("most"), F.sum(F.when(hot, F.col("n"))).alias("total")).first()
    if found.total is None:
        return HotKeys(tuple(keys), None, 0, found.most or 0)
    slices, ranges = (int(-(-found.total // n) + 1) for n in (hot_rows, max(hot_rows, DEFAULT_HOT_ROWS)))
    return HotKeys(tuple(keys), materialize(counts.filter(hot), "hot-keys"), slices, found.most, hot_rows, ranges)


def settle(df: DataFrame, hot: HotKeys) -> DataFrame:
    """``df`` as both parts of a split are to read it: stored if it will be split.

    Evaluated once, so that a time or a random number in it is the same for all rows.
    """
    return df if hot.table is None else materialize(df, "ordered")


def split_hot_keys(df: DataFrame, order: Sequence[str], hot: HotKeys) -> Split:
    """Separate the rows of hot keys and cut them into slices.

    ``order`` must not tie within a key on its own across different slices; rows equal
    on the keys and ``order`` always share a slice. ``df`` should be settled.
    """
    if hot.table is None:
        return Split(df, None)
    match = null_safe(df, hot.table, hot.keys)
    ranges = min(hot.slices, max(hot.ranges, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    sliced = (
        df.join(hot.table, match, "left_semi")
        .repartitionByRange(ranges, *[F.col(c) for c in [*hot.keys, *order]])
        .withColumn(SLICE, F.spark_partition_id())
    )
    if ranges < hot.slices:
        # By rank, so that equal rows stay together here as well.
        inner = F.floor((F.rank().over(per_key([*hot.keys, SLICE], order)) - 1) / F.lit(hot.rows))
        sliced = sliced.withColumn(SLICE, F.shiftleft(F.col(SLICE).cast("long"), 32) + inner)
    # Stored, because the partition id is only meaningful for this one shuffle.
    return Split(df.join(hot.table, match, "left_anti"), materialize(sliced, "hot-slices"))


def per_key(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def join_carry(rows: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach the carry row of each (key, slice).

    The carry table has at most one row per slice and hot key and is stored, so
    Catalyst knows its size and broadcasts it only when it is small.
    """
    renamed = {k: f"_c{i}" for i, k in enumerate([*keys, SLICE])}
    right = carry.withColumnsRenamed(renamed)
    on = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(right[v]) for k, v in renamed.items()])
    return rows.join(right, on, "left").drop(*renamed.values())


def fill_forward(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    exprs: Mapping[str, Column],
    hot: HotKeys | int | None = None,
) -> DataFrame:
    """Add, per key in ``order``, the last non-NULL value so far of each expression.

    ``hot`` is what ``find_hot_keys`` found, or the number of rows above which a key is hot.
    """
    if not isinstance(hot, HotKeys):
        hot = find_hot_keys(df, keys, hot)
        df = settle(df, hot)
    split = split_hot_keys(df, order, hot)

    def running(rows: DataFrame, by: Sequence[str]) -> DataFrame:
        so_far = per_key(by, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return rows.withColumns({n: F.last(e, ignorenulls=True).over(so_far) for n, e in exprs.items()})

    cold = running(split.cold, keys)
    if split.hot is None:
        return cold

    position = F.struct(*order)
    tails = split.hot.groupBy(*keys, SLICE).agg(
        *[F.max_by(e, F.when(e.isNotNull(), position)).alias(f"_in_{n}") for n, e in exprs.items()]
    )
    earlier = per_key(keys, [SLICE]).rowsBetween(Window.unboundedPreceding, -1)
    carry = materialize(
        tails.withColumns({f"_in_{n}": F.last(f"_in_{n}", ignorenulls=True).over(earlier) for n in exprs}),
        "carry",
    )
    filled = join_carry(running(split.hot, [*keys, SLICE]), carry, keys)
    filled = filled.withColumns({n: F.coalesce(n, f"_in_{n}") for n in exprs})
    return cold.unionByName(filled.select(*cold.columns))
