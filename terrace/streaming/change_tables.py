"""Type 1 and type 2 tables kept up to date from a stream, on plain parquet.

A table is kept bucket by bucket (see ``kept``): a micro-batch reads and replaces the buckets
its keys fall into, and no others.

- Type 1 keeps one state row per key (``scd1_state``). Merging states is commutative and
  idempotent, so late rows and replayed batches do no harm.
- Type 2 keeps the changes as they came, and the versions made of them: open ones apart from
  closed ones. A batch looks up, for each of its keys, the version that its earliest change
  falls into, and makes the versions from there on anew, from the changes since that version
  began. Changes in order thus rewrite the open versions of their buckets and add closed
  ones; only late changes, which divide or join closed versions, rewrite those.

``current_rows`` and ``history`` are plain scans. A flow is one streaming query (its id is in
its checkpoint) or a backfill; several flows may feed one target, one batch at a time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from terrace.operators.cdc import VALID_TO, Cdc, scd1_merge, scd1_rows, scd1_state, scd2
from terrace.streaming.kept import BUCKET_BYTES, FIRST_BITS, KeptTable, Load, Replacement, merged

TYPE_1 = 1
TYPE_2 = 2

STATE = "state"
CHANGES, OPEN, CLOSED = "changes", "open", "closed"
#: Column of a version: the whole sequence of the change that opened it.
OPENED_BY = "_opened_by"


def _check(kind: int) -> None:
    if kind not in (TYPE_1, TYPE_2):
        raise ValueError(f"kind must be {TYPE_1} or {TYPE_2}, not {kind}")


def _no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _schemas(spark: SparkSession, changes: StructType, cdc: Cdc, kind: int, known: Load | None) -> dict[str, StructType]:
    """Columns of the parts once changes with these columns have come."""
    if kind == TYPE_1:
        mine = scd1_state(_no_rows(spark, changes), cdc).schema
        return {STATE: merged(known.schemas[STATE], mine) if known else merged(mine, mine)}
    both = merged(known.schemas[CHANGES], changes) if known else merged(changes, changes)
    if known and both == known.schemas[CHANGES]:
        return known.schemas
    versions = scd2(_no_rows(spark, both), cdc, OPENED_BY).schema
    versions = merged(versions, versions)
    return {CHANGES: both, OPEN: versions, CLOSED: versions}


def declare(
    spark: SparkSession, target: str, changes: StructType, cdc: Cdc, kind: int, comment: str | None = None
) -> None:
    """Name the columns of the changes a table will get, before the first ones come; it then reads as empty."""
    _check(kind)
    table = KeptTable(spark, target)
    with table.lock():
        if table.last() is None:
            table.commit(Load(0, FIRST_BITS, 0, _schemas(spark, changes, cdc, kind, None), {}, comment))


def comment_of(spark: SparkSession, target: str) -> str | None:
    """The comment a table was declared with."""
    last = KeptTable(spark, target).last()
    return last.comment if last else None


def _same_keys(a: DataFrame, b: DataFrame, keys: tuple[str, ...]) -> Column:
    return reduce(lambda x, y: x & y, [a[f"`{k}`"].eqNullSafe(b[f"`_k{i}`"]) for i, k in enumerate(keys)])


class _Batch(Replacement):
    """One batch of changes on its way into a table."""

    def __init__(self, table: KeptTable, cdc: Cdc, last: Load | None, schemas: dict[str, StructType]):
        super().__init__(table, cdc.key_list, last, schemas)
        self.cdc = cdc

    def type_1(self, changes: DataFrame) -> _Batch:
        new = self.begin(scd1_state(changes, self.cdc), STATE)
        self.write({STATE: scd1_merge(self.stored(STATE).unionByName(new), self.cdc)})
        return self

    def type_2(self, rows: DataFrame) -> _Batch:
        new = self.begin(rows, CHANGES)
        if not self.touched:
            return self
        changes = self.stored(CHANGES)
        adds = self.addable(CHANGES)
        rewritten = changes.filter(self.bucket().isin(*(self.touched - adds))) if self.touched - adds else None
        log = new.unionByName(rewritten) if self.before and rewritten is not None else new
        self.write({CHANGES: log}, {CHANGES: adds})

        if self.before:
            since = self.keep(self._since(new), "since")
            kept, late = self._unaffected(since)
            versions = scd2(self._changes_since(changes.unionByName(new), since), self.cdc, OPENED_BY)
        else:
            kept, late, versions = {}, set(), scd2(new, self.cdc, OPENED_BY)
        versions = self.keep(versions, "versions")
        opened, closed = versions.filter(F.col(VALID_TO).isNull()), versions.filter(F.col(VALID_TO).isNotNull())
        adds = self.addable(CLOSED) - late
        if self.before:
            opened = opened.unionByName(kept[OPEN])
            if self.touched - adds:
                closed = closed.unionByName(kept[CLOSED].filter(self.bucket().isin(*(self.touched - adds))))
        self.write({OPEN: opened, CLOSED: closed}, {CLOSED: adds})
        return self

    def _position(self, rows: DataFrame) -> DataFrame:
        """Keys (as _k0, ...) and the sequence of each change, as ``OPENED_BY`` has it."""
        changes = self.cdc.changes(rows)
        sequence = self.cdc.sequence(rows)
        return changes.select(
            *[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(self.cdc.key_list)],
            F.struct(*[F.col(f"`{c}`").alias(f"s{i}") for i, c in enumerate(sequence)]).alias("_position"),
        )

    def _since(self, new: DataFrame) -> DataFrame:
        """Per key of the batch, where the versions that change begin; NULL: with the first one.

        That is the last version to begin before the batch's first change of the key. Values
        that NULLs leave as they are may come from any earlier change.
        """
        names = [f"_k{i}" for i in range(len(self.cdc.key_list))]
        first = self._position(new).groupBy(*names).agg(F.min("_position").alias("_first"))
        if self.cdc.ignore_nulls:
            return first.select(*names, F.lit(None).cast(first.schema["_first"].dataType).alias("_since"))
        versions = self.stored(OPEN).unionByName(self.stored(CLOSED)).select(*[f"`{k}`" for k in self.cdc.key_list], OPENED_BY)
        before = _same_keys(versions, first, self.cdc.key_list) & (F.col(OPENED_BY) < F.col("_first"))
        return first.join(versions, before, "left").groupBy(*names).agg(F.max(OPENED_BY).alias("_since"))

    def _unaffected(self, since: DataFrame) -> tuple[dict[str, DataFrame], set[int]]:
        """Versions that stay as they are, by part, and the buckets where closed ones do not."""
        kept = {}
        for p in (OPEN, CLOSED):
            rows = self.stored(p)
            gone = _same_keys(rows, since, self.cdc.key_list) & (F.col("_since").isNull() | (F.col(OPENED_BY) >= F.col("_since")))
            kept[p] = rows.join(since, gone, "left_anti")
            if p == CLOSED:
                lost = rows.join(since, gone, "left_semi").select(self.bucket()).distinct()
        return kept, {r[0] for r in lost.collect()}

    def _changes_since(self, changes: DataFrame, since: DataFrame) -> DataFrame:
        """Changes of the batch's keys from where the versions are made anew."""
        sequence = [F.col(c) if isinstance(c, str) else c for c in self.cdc.order_list]
        at = changes.withColumn("_position", F.struct(*[c.alias(f"s{i}") for i, c in enumerate(sequence)]))
        on = _same_keys(at, since, self.cdc.key_list) & (F.col("_since").isNull() | (F.col("_position") >= F.col("_since")))
        return at.join(since, on, "left_semi").drop("_position")


def _add(table: KeptTable, flow: str, number: int, changes: DataFrame, cdc: Cdc, kind: int) -> None:
    """Apply a flow's batch, unless it has been applied."""

    def make(last: Load | None) -> _Batch:
        batch = _Batch(table, cdc, last, _schemas(table.spark, changes.schema, cdc, kind, last))
        return batch.type_1(changes) if kind == TYPE_1 else batch.type_2(changes)

    table.apply_once(flow, number, make)


def stream_scd(
    df: DataFrame,
    cdc: Cdc,
    kind: int,
    target: str,
    checkpoint: str,
    *,
    name: str | None = None,
    interval: str | None = None,
    bucket_bytes: int = BUCKET_BYTES,
) -> StreamingQuery:
    """Start applying the change stream ``df`` to the table at ``target``.

    Without ``interval`` the query takes everything available and stops.
    """
    _check(kind)

    def apply(changes: DataFrame, batch: int) -> None:
        spark = changes.sparkSession
        flow = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        _add(KeptTable(spark, target, bucket_bytes), flow, batch, changes, cdc, kind)

    writer = df.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if name is not None:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def backfill(
    df: DataFrame, cdc: Cdc, kind: int, target: str, name: str = "backfill", *, bucket_bytes: int = BUCKET_BYTES
) -> None:
    """Apply a batch of changes once, as a flow of its own; a second call with the same name does nothing."""
    _check(kind)
    _add(KeptTable(df.sparkSession, target, bucket_bytes), name, 0, df, cdc, kind)


def remove_covered(spark: SparkSession, target: str, kind: int) -> int:
    """Delete what has been replaced; returns the number of folders.

    Call it when no reader that started before the last batch is still running.
    """
    _check(kind)
    return KeptTable(spark, target).remove_covered()


def _last(table: KeptTable) -> Load:
    last = table.last()
    if last is None:
        raise ValueError(f"no complete batch below {table.root}")
    return last


def current_rows(spark: SparkSession, target: str, cdc: Cdc) -> DataFrame:
    """The type 1 table at ``target``."""
    table = KeptTable(spark, target)
    return scd1_rows(table.read(_last(table), STATE), cdc)


def history(spark: SparkSession, target: str, cdc: Cdc, where: str | None = None) -> DataFrame:
    """The type 2 table at ``target``; ``where`` is a condition on the keys."""
    table = KeptTable(spark, target)
    versions = table.scan(_last(table), [OPEN, CLOSED]).drop(OPENED_BY)
    if where is not None:
        _no_rows(spark, versions.select(*cdc.key_list).schema).filter(where)
        versions = versions.filter(where)
    return versions


def open_versions(spark: SparkSession, target: str) -> DataFrame:
    """The open versions of the type 2 table at ``target``; closed ones are not read."""
    table = KeptTable(spark, target)
    return table.read(_last(table), OPEN).drop(OPENED_BY)
