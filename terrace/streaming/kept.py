"""Tables on plain parquet that are kept by replacing the buckets a batch touches.

Rows are dealt to buckets by a hash of their keys. A table has one or more parts, and each
part one folder per bucket and load: ``<root>/_part=<part>/_bucket=<bits>-<number>/_load=<n>r``.
A load writes what its buckets hold from now on (``r``), or what is to be added to them
(``a``), for the buckets it touches and no others. The file ``<root>/loads/<n>`` is written
last: folders of later loads do not count, so a load is there as a whole or not at all,
and a load that failed is repeated under the same number. That file also has the columns
of the parts and the last batch of each flow, so nobody opens data files to find those.

Buckets stay about as large as ``bucket_bytes``: when the table has outgrown them, the
number of buckets doubles, and a bucket is divided when it is next replaced. So what a load
writes depends on the buckets it touches, not on the size of the table.

Loads into one table run one at a time; within an application ``KeptTable`` sees to it.
Readers may run at any time. ``remove_covered`` deletes what no new reader looks at.
"""

from __future__ import annotations

import json
import threading
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from terrace.session import materialize, release_path

PART = "_part"
BUCKET = "_bucket"
LOAD = "_load"
#: Bits of the bucket number of a new table, and bytes of a bucket above which it gets one more.
FIRST_BITS = 2
BUCKET_BYTES = 128 << 20
#: Folders that are added to a bucket before it is replaced as a whole.
MOST_ADDED = 50

_locks: dict[str, threading.RLock] = defaultdict(threading.RLock)
_swept: set[tuple[str, str]] = set()


def merged(one: StructType, other: StructType, where: str = "") -> StructType:
    """Columns of both, also within structs; a column that changed its type is an error."""
    known = {f.name: f for f in one.fields}
    out = dict(known)
    for f in other.fields:
        mine = known.get(f.name)
        kind = f.dataType
        if mine is not None and isinstance(kind, StructType) and isinstance(mine.dataType, StructType):
            kind = merged(mine.dataType, kind, f"{where}{f.name}.")
        elif mine is not None and mine.dataType != kind:
            names = mine.dataType.simpleString(), kind.simpleString()
            raise ValueError(f"cannot merge column {where}{f.name}: it is {names[0]}, now {names[1]}")
        out[f.name] = StructField(f.name, kind, True)
    return StructType(list(out.values()))


@dataclass(frozen=True)
class Load:
    """What the last load left behind."""

    number: int
    bits: int
    size: int
    schemas: dict[str, StructType]
    flows: dict[str, int]
    comment: str | None = None


@dataclass(frozen=True, order=True)
class Folder:
    part: str
    bits: int
    bucket: int
    load: int
    replaces: bool

    @property
    def name(self) -> str:
        return f"{PART}={self.part}/{BUCKET}={self.bits}-{self.bucket}/{LOAD}={self.load:012d}{'r' if self.replaces else 'a'}"

    def covers(self, other: Folder) -> bool:
        """Whether ``other`` no longer counts because of this one."""
        if not self.replaces or self.load <= other.load or self.bits < other.bits:
            return False
        return self.bucket % (1 << other.bits) == other.bucket


@dataclass
class KeptTable:
    spark: SparkSession
    root: str
    bucket_bytes: int = BUCKET_BYTES
    _fs: object = field(init=False, repr=False)

    def __post_init__(self) -> None:
        self._fs = self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    # -- files ---------------------------------------------------------------

    def _path(self, name: str) -> object:
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def delete(self, name: str) -> bool:
        return bool(self._fs.delete(self._path(name), True))

    def lock(self) -> threading.RLock:
        return _locks[self.root]

    # -- loads ---------------------------------------------------------------

    def last(self) -> Load | None:
        done = [n for n in self._names("loads") if n.isdigit()]
        if not done:
            return None
        file = self._fs.open(self._path(f"loads/{max(done)}"))
        try:
            stored = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8"))
        finally:
            file.close()
        schemas = {part: StructType.fromJson(s) for part, s in stored.pop("schemas").items()}
        return Load(schemas=schemas, **stored)

    def commit(self, load: Load) -> None:
        """Make a load count. A file of this number that is there already is an error."""
        stored = load.__dict__ | {"schemas": {part: s.jsonValue() for part, s in load.schemas.items()}}
        new, final = self._path(f"loads/.{load.number:012d}"), self._path(f"loads/{load.number:012d}")
        out = self._fs.create(new, True)
        out.write(bytearray(json.dumps(stored).encode()))
        out.close()
        if self._fs.exists(final) or not self._fs.rename(new, final):
            raise RuntimeError(f"load {load.number} of {self.root} was written by someone else")

    def sweep(self, last: Load | None) -> None:
        """Once per application, and after a failure: delete what loads without an end have left."""
        if (self.spark.sparkContext.applicationId, self.root) in _swept:
            return
        number = last.number if last else -1
        for f in self.folders():
            if f.load > number:
                self.delete(f.name)
        _swept.add((self.spark.sparkContext.applicationId, self.root))

    def failed(self) -> None:
        _swept.discard((self.spark.sparkContext.applicationId, self.root))

    # -- folders -------------------------------------------------------------

    def folders(self, parts: Iterable[str] | None = None, buckets: Iterable[tuple[int, int]] | None = None) -> list[Folder]:
        """All folders of some parts, or of the buckets that the given ones (bits, number) come from."""
        out = []
        for part in parts or [p.removeprefix(f"{PART}=") for p in self._names("") if p.startswith(f"{PART}=")]:
            names = {n for n in self._names(f"{PART}={part}") if n.startswith(f"{BUCKET}=")}
            if buckets is not None:
                names &= {f"{BUCKET}={b}-{n % (1 << b)}" for bits, n in buckets for b in range(bits + 1)}
            for name in names:
                bits, number = map(int, name.removeprefix(f"{BUCKET}=").split("-"))
                for load in self._names(f"{PART}={part}/{name}"):
                    if load.startswith(f"{LOAD}="):
                        tag = load.removeprefix(f"{LOAD}=")
                        out.append(Folder(part, bits, number, int(tag[:-1]), tag[-1] == "r"))
        return out

    def valid(self, last: Load, found: list[Folder]) -> list[Folder]:
        """Those of ``found`` that count: of loads that ended, and not replaced since."""
        done = [f for f in found if f.load <= last.number]
        latest: dict[tuple, Folder] = {}
        for f in sorted(done, key=lambda f: f.load):
            if f.replaces:
                # A bucket, and every one it was divided from, is replaced by it.
                for b in range(f.bits + 1):
                    latest[f.part, b, f.bucket % (1 << b)] = f
        return [f for f in done if not ((by := latest.get((f.part, f.bits, f.bucket))) and by.covers(f))]

    def read(self, last: Load, part: str, buckets: Iterable[tuple[int, int]] | None = None) -> DataFrame:
        """Rows of a part, of the whole table or of the buckets that some come from. One plain scan."""
        return self.scan(last, [part], buckets)

    def scan(self, last: Load, parts: Sequence[str], buckets: Iterable[tuple[int, int]] | None = None) -> DataFrame:
        """Rows of parts with the same columns."""
        schema = last.schemas[parts[0]]
        found = self.valid(last, self.folders(parts, buckets))
        if not found:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f.name}" for f in sorted(found)])

    def bucket(self, keys: Sequence[str], bits: int) -> Column:
        """Number of the bucket of a row."""
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(1 << bits))

    def write(
        self, load: int, bits: int, touched: set[int], rows: dict[str, DataFrame], adds: dict[str, set[int]] | None = None
    ) -> None:
        """Rows by part, with a column ``BUCKET`` that holds numbers of ``bits`` bits; parts with the same columns.

        They replace what the ``touched`` buckets hold, of which those in ``adds`` keep it too.
        """
        adds = adds or {}
        whole = None
        for part, df in rows.items():
            tag = F.lit(f"{load:012d}r")
            if adds.get(part):
                tag = F.when(F.col(BUCKET).isin(*adds[part]), F.lit(f"{load:012d}a")).otherwise(tag)
            named = df.withColumns({PART: F.lit(part), LOAD: tag, BUCKET: F.concat(F.lit(f"{bits}-"), F.col(BUCKET).cast("string"))})
            whole = named if whole is None else whole.unionByName(named)
        # Buckets together as far as sizes allow: Spark gives a large one to several tasks.
        whole.hint("rebalance", PART, BUCKET).write.mode("append").partitionBy(PART, BUCKET, LOAD).parquet(self.root)
        for part in rows:
            for n in touched - adds.get(part, set()):
                # A bucket without rows has a folder too: it replaces what was there.
                self._fs.mkdirs(self._path(Folder(part, bits, n, load, True).name))

    def size_of(self, folders: Iterable[Folder]) -> int:
        return sum(self._fs.getContentSummary(self._path(f.name)).getLength() for f in folders)

    def remove_covered(self) -> int:
        """Delete folders that no longer count; returns their number.

        Call it when no reader that started before the last load is still running.
        """
        with self.lock():
            last = self.last()
            if last is None:
                return 0
            found = [f for f in self.folders() if f.load <= last.number]
            kept = set(self.valid(last, found))
            for f in found:
                if f not in kept:
                    self.delete(f.name)
            for n in self._names("loads"):
                if n.isdigit() and int(n) < last.number:
                    self.delete(f"loads/{n}")
            return len(found) - len(kept)

    def apply_once(self, flow: str, number: int, make: Callable[[Load | None], Replacement | None]) -> None:
        """Let ``make`` write a flow's batch as the next load, unless that batch has been applied."""
        with self.lock():
            last = self.last()
            if last and last.flows.get(flow, -1) >= number:
                return
            self.sweep(last)
            try:
                done = make(last)
                flows = {**(last.flows if last else {}), flow: number}
                size = (last.size if last else 0) + done.grown()
                self.commit(Load(done.number, done.bits, size, done.schemas, flows, last.comment if last else None))
            except BaseException:
                self.failed()
                raise
            done.release()


class Replacement:
    """A load in the making: the rows that come, the buckets they touch and what those hold."""

    def __init__(self, table: KeptTable, keys: Sequence[str], last: Load | None, schemas: dict[str, StructType]):
        self.table, self.keys, self.schemas = table, list(keys), schemas
        self.number = last.number + 1 if last else 0
        self.bits = last.bits if last else FIRST_BITS
        while last and last.size > table.bucket_bytes << self.bits:
            self.bits += 1
        # What was stored is read with the columns it has from now on.
        self.before = Load(last.number, self.bits, last.size, schemas, last.flows) if last else None
        self.touched: set[int] = set()
        self.held: list[Folder] = []
        self.made: list[DataFrame] = []

    def keep(self, df: DataFrame, label: str, schema: StructType | None = None) -> DataFrame:
        """``df`` written down for this load and read again, with all columns of ``schema``."""
        self.made.append(materialize(df, label, schema))
        return self.made[-1]

    def release(self) -> None:
        for df in self.made:
            release_path(df)

    def bucket(self) -> Column:
        return self.table.bucket(self.keys, self.bits)

    @property
    def buckets(self) -> list[tuple[int, int]]:
        return [(self.bits, n) for n in self.touched]

    def begin(self, rows: DataFrame, part: str) -> DataFrame:
        """The rows of the load, for the part they go to, written down; finds the buckets they touch."""
        rows = rows.withColumn(BUCKET, self.bucket())
        columns = StructType([*self.schemas[part].fields, rows.schema[BUCKET]])
        new = self.keep(rows, "load", columns)
        self.touched = {r[0] for r in new.select(BUCKET).distinct().collect()}
        if self.before:
            self.held = self.table.valid(self.before, self.table.folders(self.schemas, self.buckets))
        # A bucket that is divided is replaced by all of its parts.
        for f in self.held:
            if f.bits < self.bits:
                self.touched |= set(range(f.bucket, 1 << self.bits, 1 << f.bits))
        return new.drop(BUCKET)

    def stored(self, part: str) -> DataFrame:
        """Rows of the touched buckets."""
        if not self.before:
            return self.table.spark.createDataFrame([], self.schemas[part])
        return self.table.read(self.before, part, self.buckets)

    def divides(self) -> bool:
        """Whether this load divides buckets."""
        return any(f.bits < self.bits for f in self.held)

    def addable(self, part: str) -> set[int]:
        """Touched buckets that rows can be added to: not divided by this load, and not in too many pieces."""
        pieces = Counter(f.bucket for f in self.held if f.part == part and f.bits == self.bits)
        divided = {(f.bits, f.bucket) for f in self.held if f.bits < self.bits}
        whole = {n for n in self.touched if not any(n % (1 << bits) == bucket for bits, bucket in divided)}
        return {n for n in whole if 0 < pieces[n] < MOST_ADDED}

    def write(self, rows: dict[str, DataFrame], adds: dict[str, set[int]] | None = None) -> None:
        """Rows by part, of parts with the same columns; see ``KeptTable.write``."""
        if self.touched:
            dealt = {part: df.withColumn(BUCKET, self.bucket()) for part, df in rows.items()}
            self.table.write(self.number, self.bits, self.touched, dealt, adds)

    def grown(self) -> int:
        """Bytes by which the table grows."""
        after = [f for f in self.table.folders(self.schemas, self.buckets) if f.load == self.number]
        now = Load(self.number, self.bits, 0, self.schemas, {})
        still = set(self.table.valid(now, [*self.held, *after]))
        return self.table.size_of(after) - self.table.size_of(f for f in self.held if f not in still)
