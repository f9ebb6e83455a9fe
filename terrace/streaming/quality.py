"""Rules on streams: rows kept, rows that fail and counts, all of one pass over each micro-batch.

``write_checked`` stores a batch below ``<path>/rows``, ``<path>/failed`` and ``<path>/counts``, in
a folder that carries the batch's number. Folders take their place whole, the rows last, and
a replayed batch whose rows are there is left out: readers, streams among them, see each
batch once or not yet.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, StringType, StructType

from terrace.operators.quality import DROP, FAILED_RULES, Rule, counters, failed_rules, quality_report, resolve
from terrace.sources import stream_parquet

ABOUT = "about.json"
WELL_FORMED = "well_formed"
ROWS, FAILED, COUNTS = "rows", "failed", "counts"
TIMES, ON_TIME = "times", "on_time"
_NEWEST = "newest"
TIMES_SCHEMA = f"{_NEWEST} long"
REPORT = "rule string, action string, passed long, violations long"
_OUTCOME = "_outcome"
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


class _Folders:
    """Folders of batches below a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.hadoop = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def of(self, part: str, number: int) -> str:
        return f"{self.path}/{part}/b{number:012d}"

    def exists(self, folder: str) -> bool:
        return self.fs.exists(self.hadoop(folder))

    def put(self, new: str, folder: str) -> None:
        """Move a folder to its place; one that was never written is an empty one."""
        self.fs.delete(self.hadoop(folder), True)
        self.fs.mkdirs(self.hadoop(folder).getParent())
        if not (self.fs.rename(self.hadoop(new), self.hadoop(folder)) if self.exists(new) else self.fs.mkdirs(self.hadoop(folder))):
            raise RuntimeError(f"cannot move {new} to {folder}")


    def write_text(self, name: str, text: str) -> None:
        """Write a small file in one step."""
        new = self.hadoop(f"{self.path}/.{name}-{uuid.uuid4().hex}")
        out = self.fs.create(new, True)
        out.write(bytearray(text.encode()))
        out.close()
        self.fs.delete(self.hadoop(f"{self.path}/{name}"), False)
        if not self.fs.rename(new, self.hadoop(f"{self.path}/{name}")):
            raise RuntimeError(f"cannot write {self.path}/{name}")

    def text(self, name: str) -> str:
        file = self.fs.open(self.hadoop(f"{self.path}/{name}"))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8")
        finally:
            file.close()


@dataclass(frozen=True)
class Declared:
    """What is known of a checked table before, and after, its first batch."""

    schema: StructType
    rules: list[Rule]
    comment: str | None = None
    malformed: str | None = None


def declare_checked(spark: SparkSession, path: str, declared: Declared) -> None:
    """Name the columns, rules and comment of a checked table. It reads as empty until its first batch."""
    about = {
        "schema": declared.schema.jsonValue(),
        "rules": [[r.name, r.predicate, r.action] for r in declared.rules],
        "comment": declared.comment,
        "malformed": declared.malformed,
    }
    folders = _Folders(spark, path)
    text = json.dumps(about)
    if not folders.exists(f"{path}/{ABOUT}") or folders.text(ABOUT) != text:
        folders.write_text(ABOUT, text)


def is_checked(spark: SparkSession, path: str) -> bool:
    return _Folders(spark, path).exists(f"{path}/{ABOUT}")


def declared(spark: SparkSession, path: str) -> Declared:
    about = json.loads(_Folders(spark, path).text(ABOUT))
    rule_list = [Rule(*r) for r in about["rules"]]
    return Declared(StructType.fromJson(about["schema"]), rule_list, about["comment"], about["malformed"])


def write_checked(
    df: DataFrame,
    rule_set: Iterable[Rule],
    *,
    path: str,
    checkpoint: str,
    comment: str | None = None,
    malformed: str | None = None,
    name: str | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Start storing the stream ``df``: the rows that pass, those that fail a drop rule, and the counts of all rules.

    ``malformed`` names a column that holds the text of lines that did not parse; such rows
    fail the rule ``well_formed``, and only failing rows keep the column.
    """
    rule_list = list(rule_set)
    if malformed is not None:
        rule_list.insert(0, Rule(WELL_FORMED, f"`{malformed}` IS NULL", DROP))
    rule_list = resolve(df, rule_list)
    columns = StructType([f for f in df.schema.fields if f.name != malformed])
    declare_checked(df.sparkSession, path, Declared(columns, rule_list, comment, malformed))
    writer = df.writeStream.foreachBatch(lambda batch, number: _store(batch, number, rule_list, path))
    writer = writer.option("checkpointLocation", checkpoint)
    if name is not None:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


@contextmanager
def _unsorted(spark: SparkSession, folders: int) -> Iterator[None]:
    """Writes by partition keep up to ``folders`` files open in a task, instead of sorting all its rows."""
    had = spark.conf.get(WRITERS)
    spark.conf.set(WRITERS, max(folders, int(had)))
    try:
        yield
    finally:
        spark.conf.set(WRITERS, had)


def _store(
    batch: DataFrame, number: int, rule_list: list[Rule], path: str, time: str | None = None, before: int | None = None
) -> None:
    """Rows, failing rows and counts of a batch, in one pass; with ``time`` also the newest value of that
    column so far, which was ``before`` until now."""
    spark = batch.sparkSession
    folders = _Folders(spark, path)
    if folders.exists(folders.of(ROWS, number)):
        return
    new = f"{path}/new/{number}-{uuid.uuid4().hex}"
    seen = Observation()
    failed = failed_rules([r for r in rule_list if r.action == DROP])
    outcome = F.when(F.size(FAILED_RULES) > 0, FAILED).otherwise(ROWS)
    own = F.unix_micros(F.max(F.col(f"`{time}`").cast("timestamp")))
    newest = [F.greatest(own, F.lit(before).cast("long")).alias(_NEWEST)] if time else []
    checked = batch.observe(seen, *counters(rule_list), *newest).withColumn(FAILED_RULES, failed)
    with _unsorted(spark, 2):
        checked.withColumn(_OUTCOME, outcome).write.partitionBy(_OUTCOME).parquet(new)
    counts = seen.get
    report = [(r.name, r.action, counts["rows"] - counts[r.name], counts[r.name]) for r in rule_list]
    spark.createDataFrame(report, REPORT).coalesce(1).write.parquet(f"{new}/{COUNTS}")
    if time:
        spark.createDataFrame([(counts[_NEWEST],)], TIMES_SCHEMA).coalesce(1).write.parquet(f"{new}/{TIMES}")
        folders.put(f"{new}/{TIMES}", folders.of(TIMES, number))
    folders.put(f"{new}/{COUNTS}", folders.of(COUNTS, number))
    folders.put(f"{new}/{_OUTCOME}={FAILED}", folders.of(FAILED, number))
    folders.put(f"{new}/{_OUTCOME}={ROWS}", folders.of(ROWS, number))
    folders.fs.delete(folders.hadoop(new), True)


def write_on_time(
    df: DataFrame, time: str, delay: str, *, path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Start storing the stream ``df`` apart into rows on time and rows behind the watermark.

    The watermark is the newest ``time`` of all earlier batches less ``delay``, as a streaming
    operator with such a watermark has it, so what is on time here is not dropped there. Rows
    behind it, or without a time, fail the rule ``on_time`` and are read with ``quarantined``.
    """
    spark = df.sparkSession
    behind = f"`{time}` IS NOT NULL AND `{time}` >= (newest `{time}` of earlier batches) - INTERVAL {delay}"
    declare_checked(spark, path, Declared(df.schema, [Rule(ON_TIME, behind)]))

    def write(batch: DataFrame, number: int) -> None:
        before = f"{path}/{TIMES}/b{number - 1:012d}"
        newest = batch.sparkSession.read.schema(TIMES_SCHEMA).parquet(before).first()[0] if number else None
        holds = f"`{time}` IS NOT NULL"
        if newest is not None:
            holds += f" AND cast(`{time}` AS TIMESTAMP) >= timestamp_micros({newest}) - INTERVAL {delay}"
        _store(batch, number, [Rule(ON_TIME, holds)], path, time, newest)

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def _read(spark: SparkSession, path: str, part: str, schema: StructType | str) -> DataFrame:
    found = _Folders(spark, path).exists(f"{path}/{part}")
    return spark.read.schema(schema).parquet(f"{path}/{part}/b*") if found else spark.createDataFrame([], schema)


def read_checked(spark: SparkSession, path: str) -> DataFrame:
    """The rows that passed; none before the first batch."""
    return _read(spark, path, ROWS, declared(spark, path).schema)


def stream_checked(spark: SparkSession, path: str) -> DataFrame:
    """The rows that passed, as a stream that takes each batch once."""
    _Folders(spark, path).fs.mkdirs(_Folders(spark, path).hadoop(f"{path}/{ROWS}"))
    return stream_parquet(spark, f"{path}/{ROWS}/b*", declared(spark, path).schema)


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    """Rows that failed, with the names of the drop rules they violate, and malformed lines as they came."""
    about = declared(spark, path)
    schema = StructType(list(about.schema.fields))
    if about.malformed:
        schema = schema.add(about.malformed, "string")
    return _read(spark, path, FAILED, schema.add(FAILED_RULES, ArrayType(StringType())))


def count_rules(
    df: DataFrame, rule_set: Iterable[Rule], *, path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Start counting what passes and what violates each rule in the stream ``df``.

    Every micro-batch writes its own folder below ``path``, and a replayed batch the same one
    again, so totals stay right after failures and over any number of batches.
    """
    rule_list = list(rule_set)

    def write(batch: DataFrame, number: int) -> None:
        quality_report(batch, rule_list).write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def rule_totals(spark: SparkSession, path: str) -> DataFrame:
    """One row per rule over all batches so far: rule, action, passed, violations.

    ``path`` is one that ``count_rules`` or ``write_checked`` has written to.
    """
    counts = _read(spark, path, COUNTS, REPORT) if is_checked(spark, path) else spark.read.parquet(path)
    return counts.groupBy("rule", "action").agg(F.sum("passed").alias("passed"), F.sum("violations").alias("violations"))
