"""Exact deduplication against a persistent index of text digests.

The index is a Parquet table, bucketed and sorted by digest: one row per distinct text,
with the id of the document that stays. New documents are reduced to one row per digest
(combined before the shuffle, so a text with a third of all copies is one row per task),
anti-joined with the index bucket by bucket, and appended.

Texts are equal when identical after replacing each run of the six ASCII white-space
characters by one space; null counts as empty, and empty texts are copies of each other.

Defined cases: an empty table adds nothing; repeated rows (same id and text) are copies
of each other, of which one row stays; a null id is larger than any other id. Other
columns, whatever their names, pass through and take no part.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm.common import SPACES, stored, text_or_empty
from terrace.session import new_work_dir

DIGEST = "text_sha256"
#: Buckets of an index. A bucket of 10 TB of 64-byte digests is then about 1 GB of rows.
BUCKETS = 64


def digest(name: str = "text") -> Column:
    """Lowercase hex SHA-256 of the white-space-normalised text in UTF-8."""
    return F.sha2(F.regexp_replace(text_or_empty(name), SPACES, " ").cast("binary"), 256)


def digest_groups(docs: DataFrame) -> DataFrame:
    """One row per distinct text: digest, smallest id (``keep_id``), number of rows (``group_size``)."""
    return docs.groupBy(digest().alias(DIGEST)).agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )


class DigestIndex:
    """Digests seen so far, kept in a table of the session's catalog at ``path``.

    The path is the index: another session opens it by naming the same path and buckets.
    ``add`` appends and is safe to repeat: what is there already is not added again.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, name: str | None = None):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = name or f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({DIGEST} STRING, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY ({DIGEST}) SORTED BY ({DIGEST}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def unseen(self, groups: DataFrame) -> DataFrame:
        """Groups whose text the index lacks. The index side is neither shuffled nor broadcast."""
        known = self.rows().select(DIGEST).hint("merge")
        return groups.join(known, DIGEST, "left_anti")

    def add(self, groups: DataFrame) -> DataFrame:
        """Append the groups the index lacks; returns them, from the work folder."""
        new = stored(self.unseen(groups), "new-digests")
        (
            new.select(DIGEST, "keep_id")
            .repartition(self.buckets, DIGEST)
            .write.bucketBy(self.buckets, DIGEST)
            .sortBy(DIGEST)
            .format("parquet")
            .mode("append")
            .option("path", self.path)
            .saveAsTable(self.name)
        )
        return new

    def drop(self) -> None:
        """Forget the table's name; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def exact_dedup(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """Add ``docs`` to ``index``; one row per document, dropped ones too.

    Columns: doc_id, keep_id (the row that stays, perhaps of an earlier load), group_size
    (rows of this load with the text), kept, text_sha256. A text the index had before
    keeps no row of this load.
    """
    rows = stored(docs.groupBy("doc_id", digest().alias(DIGEST)).agg(F.count(F.lit(1)).alias("repeats")), "digests")
    groups = rows.groupBy(DIGEST).agg(F.min("doc_id").alias("keep_id"), F.sum("repeats").alias("group_size"))
    new = index.add(groups.select(DIGEST, "keep_id", "group_size")).select(DIGEST, F.lit(True).alias("is_new"))
    facts = groups.select(DIGEST, "group_size").join(index.rows().hint("merge"), DIGEST).join(new, DIGEST, "left")
    # Stored, so that both sides are plain exchanges and Spark splits a text with very many ids.
    facts = stored(facts, "digest-facts")
    return (
        rows.join(facts, DIGEST)
        .withColumn("place", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int"))))
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (
                F.col("is_new").isNotNull() & F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("place") == 1)
            ).alias("kept"),
            DIGEST,
        )
    )


def keep_first(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The documents that ``exact_dedup`` keeps, with all their columns."""
    mark = f"digest_{uuid.uuid4().hex}"
    marked = docs.withColumn(mark, digest())
    new = index.add(digest_groups(docs)).select(F.col(DIGEST).alias(mark), F.col("keep_id").alias(f"{mark}_id"))
    same = marked["doc_id"].eqNullSafe(new[f"{mark}_id"]) & (marked[mark] == new[mark])
    return marked.join(new, same, "left_semi").dropDuplicates(["doc_id", mark]).drop(mark)


def new_index(spark: SparkSession, buckets: int = BUCKETS) -> DigestIndex:
    """An empty index in the work folder."""
    return DigestIndex(spark, new_work_dir(spark, "digest-index"), buckets)
