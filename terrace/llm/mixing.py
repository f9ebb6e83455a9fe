"""Mixing sources to target weights by systematic sampling.

Within a source every document expects ``target / size of the source`` copies. The
expectations are summed along a fixed order of the source's documents, one offset is
added, and a document is taken once for each whole number its part of the sum crosses.
The order is by size, then id: partial sums of taken and expected copies never differ by
more than one, so the words taken miss the target by no more than the largest document.

Sources by code point, null last, have the given weights in turn and share all sizes. No
target is above ``MOST`` times its source; what that cuts off is shared by weight among
the others until none is above. With sources by ``MOST * size / weight``, the capped ones
are a prefix, so this is one running sum over the sources and not a loop.

A source with a third of all documents is no single group: documents are range-sorted by
(source, size, id), Spark cuts the range where it likes, and a place in the source is the
place in the range plus the counts of earlier ranges.

Defined cases: null text has size 0; a source without words has target 0 and takes no
words; repeated rows are documents of their own; a null id stays null and comes before any
other of its size; an empty table gives no rows; other
columns, whatever their names, take no part. The offset of a source is a hash of its name
and ``seed``, so reruns agree.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import n_words, stored

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = "mix"


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Adds ``target`` (double) to rows of (source, source_size). One row per source, so one task."""
    everything = Window.partitionBy()
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*(F.lit(w) for w in weights))
    weighed = sources.withColumn(
        "weight", F.element_at(turn, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).cast("long")
    )
    # Capped sources come first in this order. The level of a row is what one unit of weight
    # gets if all sources before it are capped and share nothing more.
    order = everything.orderBy(
        (most * F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last()
    )
    before, after = (
        order.rowsBetween(Window.unboundedPreceding, -1),
        order.rowsBetween(Window.currentRow, Window.unboundedFollowing),
    )
    left = F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    level = left / F.sum("weight").over(after)
    # The level rises with each capped source and falls after the first open one.
    share = F.max("level").over(everything) * F.col("weight")
    return weighed.withColumn("level", level).select(
        "source", "source_size", F.least(share, (most * F.col("source_size")).cast("double")).alias("target")
    )


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED, row: str | None = None
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken.

    ``row`` names a column that tells repeated rows apart, if there is one; it is kept.
    """
    ids = ["doc_id", *([row] if row else [])]
    spark = docs.sparkSession
    rows = docs.select(*ids, "source", n_words().alias("size"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Written before use: the ranges that Spark draws must be the same in both readings below.
    cut = stored(
        rows.repartitionByRange(parts, "source", "size", *ids).withColumn("part", F.spark_partition_id()), "mix-ranges"
    )
    sums = stored(
        cut.groupBy("source", "part").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")), "mix-sums"
    )
    per_source = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("source", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    plan = stored(
        starts.alias("s")
        .join(per_source.alias("p"), F.col("s.source").eqNullSafe(F.col("p.source")))
        .select("s.source", "part", "start", "source_size", "target", offset_of("s.source", seed).alias("offset")),
        "mix-plan",
    )
    inside = Window.partitionBy("source", "part").orderBy("size", *ids)
    placed = cut.withColumn("place", F.row_number().over(inside) - 1)
    # Expected copies are whole ones for all and a fraction to be drawn.
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole, fraction = F.floor("rate"), F.col("rate") - F.floor("rate")
    i = F.col("start") + F.col("place")
    crossed = F.floor(F.col("offset") + fraction * (i + 1)) - F.floor(F.col("offset") + fraction * i)
    return (
        placed.alias("d")
        .join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d.part") == F.col("p.part")))
        .withColumn("rate", rate)
        .withColumn("copies", (whole + crossed).cast("int"))
        .select(
            *ids, F.col("d.source").alias("source"), "size", "source_size", "target", "copies",
            (F.col("copies") * F.col("size")).alias("taken"),
        )
    )


def offset_of(source: str, seed: str) -> Column:
    """A number in [0, 1) for each source, the same in every run."""
    text = F.concat(F.lit(seed), F.coalesce(F.concat(F.lit(":"), F.col(source)), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The documents of the mix, all columns, each as often as it is taken."""
    mark = f"row_{uuid.uuid4().hex}"
    # Repeated rows are told apart by a number; it is written down, so both sides see the same.
    numbered = stored(docs.withColumn(mark, F.monotonically_increasing_id()), "mix-rows")
    copies = mix(numbered, weights, most, seed, row=mark).select(mark, F.col("copies").alias(f"{mark}_n"))
    times = F.explode(F.sequence(F.lit(1), F.col(f"{mark}_n")))
    taken = numbered.join(copies.filter(F.col(f"{mark}_n") > 0), mark)
    return taken.select(*docs.columns, times.alias(f"{mark}_i")).drop(f"{mark}_i")
