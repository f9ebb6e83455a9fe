"""Byte-level BPE: texts to token ids and back, by the tiktoken library and a local rank file.

The library splits a text by a pattern and merges the bytes of each match by their ranks.
A long text is cut before that, only where no match can span the cut and none can tell
that there was one: at a character of white space after another character, and before the
last character of a run of white space. Blocks then stay small, and a very long run of
white space, on which the pattern's look-ahead gives up, is one match that is encoded as
such. A match is never cut: the library merges one of a million letters in half a second.

Decoding joins the bytes of the ids. Ids that do not make up valid UTF-8 give the bytes they
stand for, nothing is replaced.

Both are one pass over the rows without a shuffle; a worker holds one batch of texts, the
ids of a few MB, and the table.

Defined cases: null and empty texts have no ids and decode to no bytes; strings of special
tokens are ordinary text; repeated rows give repeated rows; a null id stays null; an empty
table gives none; other columns, whatever their names, take no part.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, StructField, StructType

from terrace.llm.common import worker

RANKS = "byte_bpe_50k.tiktoken"
#: Characters of a block: a text is cut at the first safe place after so many.
BLOCK = 1 << 16
#: A run of white space of so many characters is encoded apart from the text around it.
LONG_RUN = 1 << 12
#: Bytes of ids or text that a worker gathers before it hands them on.
GATHERED = 1 << 22

# The characters of white space in the library's patterns.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

_safe = re.compile(f"(?<=[^{SPACE}])[{SPACE}]")
_long = re.compile(f"[{SPACE}]{{{LONG_RUN},}}")


def blocks(text: str) -> Iterator[tuple[bool, str]]:
    """Parts of a text that are encoded on their own: (is one run of white space, part)."""
    start = 0
    for run in _long.finditer(text) if len(text) > LONG_RUN else ():
        # The last character of a run belongs to what follows, if anything does.
        end = run.end() - (run.end() < len(text))
        yield from ((False, part) for part in _cut(text, start, run.start()))
        yield True, text[run.start() : end]
        start = end
    yield from ((False, part) for part in _cut(text, start, len(text)))


def _cut(text: str, start: int, end: int) -> Iterator[str]:
    while end - start > BLOCK:
        found = _safe.search(text, start + BLOCK, end)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    if end > start:
        yield text[start:end]


class Coder:
    """Ranks of a file, with the pattern that splits texts."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        whole = {"mergeable_ranks": ranks, "special_tokens": {}}
        self.split = tiktoken.Encoding("split", pat_str=pattern, **whole)
        self.run = tiktoken.Encoding("run", pat_str=f"[{SPACE}]+", **whole)

    def ids(self, text: str | None) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        return b"".join(
            np.array((self.run if run else self.split).encode_ordinary(part), "<u4").tobytes()
            for run, part in blocks(text or "")
        )

    def decoded(self, ids: bytes) -> bytes:
        return self.split.decode_bytes(np.frombuffer(ids, "<u4").tolist())


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> Coder:
    """One coder per process, file and pattern, until the process works on something else."""
    return Coder(path, pattern)


worker.memories.append(coder.cache_clear)


def ranks(name: str = RANKS) -> str:
    return public_tokenizers.path(name)


def _gathered(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Record batches of rows, each of about ``GATHERED`` bytes in the column of binary values."""
    sized = next(k for k, t in enumerate(schema.types) if pa.types.is_binary(t))
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += len(row[sized] or b"")
        if total >= GATHERED or len(held) >= 10_000:
            yield _batch(held, schema)
            held, total = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(zip(*rows, strict=True), schema.types, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], schema=schema)


def encode(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers) of every text.

    ``path`` is the rank file, at the same place on every executor.
    """
    where = path or ranks()
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        worker.begin("byte_bpe")
        ids_of = coder(where, pattern).ids
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = ids_of(text.as_py())
                yield doc, len(ids) // 4, ids

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda batches: _gathered(rows(batches), schema), "doc_id long, n_tokens long, ids binary"
    )


def decode(
    encoded: DataFrame,
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``data``, the bytes that ``ids`` stand for, with the columns of ``keep``; null ids give null."""
    where = path or ranks()
    rest = encoded.select(*keep)
    fields = StructType([StructField("data", BinaryType()), *rest.schema.fields])
    schema = to_arrow_schema(fields)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        worker.begin("byte_bpe")
        decoded = coder(where, pattern).decoded
        for b in batches:
            kept = zip(*(c.to_pylist() for c in b.columns[1:]), strict=True) if keep else iter(tuple, None)
            for ids, others in zip(b.column(0), kept):
                yield decoded(ids.as_py()) if ids.is_valid else None, *others

    return encoded.select("ids", *keep).mapInArrow(lambda batches: _gathered(rows(batches), schema), fields)
