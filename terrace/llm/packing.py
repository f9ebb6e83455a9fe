"""Packing documents into sequences of fixed length: first-fit decreasing in random groups.

A document's token ids, with an end id, are cut every ``length`` ids; only what is left of
its last piece has to be packed. Whole pieces are sequences of their own. The rest go into
groups by a hash of the document, each of about ``GROUP`` pieces, and every group is packed
on its own: pieces by falling length, each into the first sequence with room, found in a
tournament tree whose inner nodes hold the largest room below them. A group is large
enough that its few open sequences do not matter, and its size does not depend on the data.

Ids never leave the task that makes them: pieces carry their place, length and checksum.

Defined cases: null and empty texts are documents of the end id alone; repeated rows are
packed each on its own; a null id stays null, as a document of its own; a text of any length
is encoded as a whole, in the task that reads it; an empty table gives none; other columns
take no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import slices, stored, worker
from terrace.llm.token_counts import vocabulary
from terrace.llm.tokens import table

LENGTH = 4096
END_ID = 2
GROUP = 8192
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = f"{PIECE}, sequence_id long, offset long"
#: Sequence ids of a group start at its number times this.
STRIDE = 1 << 32


def first_fit_decreasing(lengths: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; lengths at most ``length``. Ties keep their order."""
    n = len(lengths)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    leaves = 1 << max(0, (n - 1).bit_length())
    # All bins are open from the start: the first with room is then the first fit.
    room = [length] * (2 * leaves)
    for k in np.argsort(-lengths, kind="stable").tolist():
        size, node = int(lengths[k]), 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        bins[k], offsets[k] = node - leaves, length - room[node]
        room[node] -= size
        while node > 1:
            node //= 2
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
    return bins, offsets


def pieces(docs: DataFrame, path: str | None = None, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Pieces of at most ``length`` ids of every document, with the checksum of their ids."""
    where = path or vocabulary()
    end = np.array([end_id], "<u4").tobytes()
    out = pa.schema([(c.split()[0], pa.int64()) for c in PIECE.split(", ")])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.begin("tokens")
        ids_of = table(where).ids
        for b in slices(batches):
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = ids_of(text) + end
                total = len(ids) // 4
                view = memoryview(ids)
                for start in range(0, total, length):
                    part = view[4 * start : 4 * (start + length)]
                    rows.append((doc, start, len(part) // 4, zlib.crc32(part), total))
            if rows:
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=out)
        worker.give_back()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECE)


def pack(
    docs: DataFrame, path: str | None = None, length: int = LENGTH, end_id: int = END_ID, group: int = GROUP
) -> DataFrame:
    """Every piece with its sequence and its offset there; offsets have no gaps from 0."""
    cut = stored(pieces(docs, path, length, end_id), "pieces")
    rest = cut.filter(F.col("length") < length)
    groups = max(1, round(rest.count() / group))

    def fit(key: tuple, rows: pa.Table) -> pa.Table:
        # Arrow keeps null ids apart from numbers; pandas would make floats of all ids of the group.
        rows = rows.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        bins, offsets = first_fit_decreasing(rows.column("length").to_numpy(), length)
        sequence = pa.array(key[0].as_py() * STRIDE + bins, pa.int64())
        return rows.drop_columns("part").append_column("sequence_id", sequence).append_column("offset", pa.array(offsets))

    # The checksum takes part, so that many rows of one id are still dealt out.
    dealt = rest.withColumn("part", F.pmod(F.xxhash64("doc_id", "doc_tokens", "ids_crc32"), F.lit(groups)))
    packed = dealt.groupBy("part").applyInArrow(fit, PACKED)
    # Whole pieces: ids below 0, distinct within and across the tasks of a written table.
    whole = cut.filter(F.col("length") == length).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return packed.unionByName(whole)
