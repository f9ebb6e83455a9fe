"""What several operators share: words, hashes, the shared work folder and packed exchanges.

A corpus has far more shingles and byte positions than rows. Where an operator has to
bring equal ones together, it does not send a row for each: every task packs what it has
for one range of the hash space (a *fragment*) into a few binary arrays, Spark shuffles
those by fragment, and numpy works on one fragment at a time. The number of fragments
grows with the input, so a fragment stays within a task's memory.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.session import materialize

#: A word is a run of characters other than these six; Python's ``bytes.split()`` cuts at the same.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"

MIX = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of text that numpy works on at a time, in one task.
CHUNK_BYTES = 1 << 21


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared work folder and read again: later steps survive lost executors."""
    return materialize(df, label)


def stored_alone(df: DataFrame, label: str) -> DataFrame:
    """``stored``, and the shuffle files that this took are deleted as soon as it is done.

    Otherwise they stay until the driver happens to collect its garbage, beside those of
    the next steps.
    """
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, None)
    conf.set(name, "true")
    try:
        return stored(df, label)
    finally:
        conf.unset(name) if before is None else conf.set(name, before)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def n_words(name: str = "text") -> Column:
    """Words of a text as long; null has none."""
    return F.coalesce(F.regexp_count(F.col(name), F.lit(WORD)), F.lit(0)).cast("long")


class Hashes(dict):
    """64-bit hashes of words, remembered up to a number of words, about 10 MB.

    A Python worker lives on from stage to stage, so what it remembers adds up: all
    operators share the one below.
    """

    LIMIT = 1 << 16

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


known_words = Hashes()


class Forgetful:
    """What a Python worker remembers belongs to the operator at work in it.

    A worker lives on from stage to stage, so without this a pipeline's workers would hold
    what all operators before remembered. ``begin`` is called where a task's work starts: if
    another operator was the last one, its memories go and the memory is given back. At the
    end of a task ``give_back`` returns what the task freed, or an idle worker would keep it
    beside whatever the executor does next.

    Functions that Spark sends to a worker name ``worker`` by reference, so a task meets the
    one of its process and not a copy that forgets with every task.
    """

    def __init__(self) -> None:
        self.owner, self.memories = "", [known_words.clear]

    def __reduce__(self) -> str:
        return "worker"

    def begin(self, owner: str) -> None:
        if owner == self.owner:
            return
        self.owner = owner
        for forget in self.memories:
            forget()
        gc.collect()
        self.give_back()

    def give_back(self) -> None:
        """Return freed memory to the system; nothing is forgotten."""
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


worker = Forgetful()


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(32))) * MIX
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def shingles(word_hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, in order of place; of all words where there are fewer."""
    n = len(word_hashes)
    if not n:
        return np.zeros(0, np.uint64)
    size_here = min(size, n)
    h = word_hashes[: n - size_here + 1].copy()
    for k in range(1, size_here):
        h = mixed(h) + word_hashes[k : n - size_here + 1 + k]
    return mixed(h + np.uint64(size_here))


def chunks(texts: list[bytes], most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes together; a longer text is a range of its own."""
    start = total = 0
    for k, t in enumerate(texts):
        if k > start and total + len(t) > most:
            yield start, k
            start, total = k, 0
        total += len(t)
    if start < len(texts):
        yield start, len(texts)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, for tasks that turn the rows of a batch into objects."""
    for b in batches:
        for start in range(0, b.num_rows, rows):
            yield b.slice(start, rows)


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes, null as empty."""
    binary = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [t or b"" for t in column.cast(binary).to_pylist()]


def squeezed(docs: DataFrame, least: int = 0) -> DataFrame:
    """doc_id and the text as zstd, for a join on doc_id: the shuffle then moves half the bytes.

    Texts under ``least`` bytes are left out.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("data", pa.binary())])

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            data = [compress(t) if len(t) >= least else None for t in utf8(b.column(1))]
            made = pa.RecordBatch.from_arrays([b.column(0), pa.array(data, pa.binary())], schema=schema)
            yield made.filter(made.column(1).is_valid())

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(squeeze, "doc_id long, data binary")


def opened(column: pa.Array) -> list[bytes]:
    """Texts that ``squeezed`` packed."""
    decompress = zstandard.ZstdDecompressor().decompress
    return [decompress(d) if d else b"" for d in column.to_pylist()]


def planes(a: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of integers, byte by byte: leading zeros then compress away."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1)[:, :width].T).tobytes()


def from_planes(data: bytes, width: int, dtype: type) -> np.ndarray:
    n = len(data) // width
    out = np.zeros((n, np.dtype(dtype).itemsize), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, n).T
    return out.view(dtype).ravel()


def fragment_of(h: np.ndarray, fragments: int) -> np.ndarray:
    """The range of the hash space, of ``fragments`` equal ones, that holds each hash."""
    return ((h >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)).astype(np.int32)


def fragments_for(docs: DataFrame, bytes_each: int, least: int = 32) -> int:
    """Number of fragments: one for so many bytes of text."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(least, -(-total // bytes_each))


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest id that each id of ``edges`` is connected with: columns id, component.

    Labels go to neighbours and then jump to their label's label, until none changes.
    Each round is a join and a minimum that combines before the shuffle, so that an id
    with very many edges is no group in one task; rounds are written to the work folder.
    """
    both = stored(
        edges.select(F.col(a).alias("id"), F.col(b).alias("other"))
        .union(edges.select(F.col(b).alias("id"), F.col(a).alias("other")))
        .filter("id <> other")
        .distinct(),
        "edges",
    )
    labels = stored(both.groupBy("id").agg(F.least("id", F.min("other")).alias("component")), "labels")
    while True:
        near = (
            both.join(labels.withColumnsRenamed({"id": "other", "component": "offered"}), "other")
            .groupBy("id")
            .agg(F.min("offered").alias("offered"))
        )
        moved = labels.join(near, "id").select("id", F.least("component", "offered").alias("next"), "component")
        jump = moved.select(F.col("id").alias("next"), F.col("next").alias("further"))
        new = stored(
            moved.join(jump, "next", "left").select(
                "id",
                F.least(F.coalesce("further", "next"), "next").alias("component"),
                F.col("component").alias("before"),
            ),
            "labels",
        )
        labels = new.select("id", "component")
        if new.filter("component <> before").isEmpty():
            return labels
