"""Token counts per document, by the whole-token shortcut.

Most pre-tokens of ordinary text are vocabulary strings that encode alone as one token.
``tokens.TokenTable`` proves offline which; those count one each without merging, and the
library merges only the rest. The count is the library's own, without begin, end or added
tokens; strings of special tokens inside a text count as the library treats them.

One pass over the table, no shuffle; a worker holds one batch of texts and the table.

Defined cases: null and empty texts have no tokens; repeated rows give repeated rows; a null
id stays null; a text of any length is counted as a whole, in the task that reads it; an
empty table gives none; other columns, whatever their names, take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import worker
from terrace.llm.tokens import table

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048


def vocabulary(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens).

    ``path`` is the vocabulary file, at the same place on every executor.
    """
    where = path or vocabulary()

    out = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.begin("tokens")
        of = table(where).count
        for b in batches:
            n = pa.array([of(t) for t in b.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), n], schema=out)

    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    counted = docs.select(F.col("doc_id").cast("long"), n_bytes.alias("n_bytes"), "text").mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
