"""Quality rules: base measures, and a log-likelihood ratio of hashed n-grams.

The ratio compares two multinomials over hashed byte 4-grams: one counted over trusted
documents, one over every document of the corpus. A document's score is the mean of
``log(trusted / raw)`` over its n-grams, so long and short texts compare; it is summed in
whole millionths, so it does not depend on how Spark cuts the table. One threshold then
decides on every document.

Labels (doc_id, quality 1 or 0) teach both: of at most ``MAX_LABELLED`` labelled documents
(smallest hash of the id), half of the good ones are the trusted text, and the other half
with the bad ones set the threshold, in the middle of the gap where good and bad separate
best. Counts cover all documents; a task sends at most ``BUCKETS`` rows and the model has
as many, so its size is fixed. Nothing here shuffles a text.

Defined cases: null and empty texts have no words and fail the base rules; n-grams of
texts under four bytes are none, the score is then 0; repeated rows are rows of their own;
a null id stays null and has no label;
labels without a document, or null, are ignored, and the lowest of contradicting labels
counts; without good labels every score is 0 and, as without bad ones, only the base rules
reject; an empty table gives no rows; other columns, whatever their names, pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import MIX, chunks, known_words, shingles, slices, utf8, worker

GRAM = 4
BITS = 16
BUCKETS = 1 << BITS
MAX_LABELLED = 20_000
#: Scores are whole millionths.
UNIT = 1_000_000
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\r\x0b\x0c"
#: Bytes of text whose n-grams are hashed at a time: numpy holds about 50 bytes for each.
GRAM_BYTES = 1 << 19
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def gram_buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of some texts, in order, and how many each text has."""
    counts = np.array([max(0, len(t) - GRAM + 1) for t in texts], np.int64)
    if not counts.sum():
        return np.zeros(0, np.uint64), counts
    data = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint32)
    h = data[: len(data) - GRAM + 1]
    for k in range(1, GRAM):
        h = h << np.uint32(8) | data[k : len(data) - GRAM + 1 + k]
    starts = np.cumsum([0, *map(len, texts)])[:-1]
    # n-grams that start in one text and end in the next are left out.
    inside = np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    return h[inside].astype(np.uint64) * MIX >> np.uint64(64 - BITS), counts


@dataclass
class Model:
    """Weight of each bucket in millionths, and the score from which a document is kept."""

    weights: np.ndarray
    threshold: int

    def scores(self, texts: list[bytes]) -> np.ndarray:
        buckets, counts = gram_buckets(texts)
        sums = np.concatenate([[0], np.cumsum(self.weights[buckets])])
        ends = np.cumsum(counts)
        return (sums[ends] - sums[ends - counts]) // np.maximum(counts, 1)


def labelled(labels: DataFrame, most: int = MAX_LABELLED) -> dict[int, tuple[int, bool]]:
    """Quality of a bounded sample of labelled ids, and whether the id is among the trusted."""
    rows = (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
        .select("doc_id", "quality", (F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0).alias("even"))
        .collect()
    )
    return {r.doc_id: (r.quality, bool(r.even and r.quality == 1)) for r in rows}


def count_grams(docs: DataFrame, trusted: set[int]) -> tuple[np.ndarray, np.ndarray]:
    """n-gram counts over all documents and over the trusted ones, by bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.begin("quality")
        raw, good = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for b in slices(batches):
            texts, ids = utf8(b.column(1)), b.column(0).to_pylist()
            for start, stop in chunks(texts, GRAM_BYTES):
                raw += np.bincount(gram_buckets(texts[start:stop])[0].astype(np.int64), minlength=BUCKETS)
            of_good = [t for t, i in zip(texts, ids, strict=True) if i in trusted]
            for start, stop in chunks(of_good, GRAM_BYTES):
                good += np.bincount(gram_buckets(of_good[start:stop])[0].astype(np.int64), minlength=BUCKETS)
        held = np.flatnonzero(raw)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(held, pa.int32()), "raw": raw[held], "good": good[held]})
        worker.give_back()

    counted = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, "bucket int, raw long, good long")
    raw, good = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).toLocalIterator():
        raw[r.bucket], good[r.bucket] = r.raw, r.good
    return raw, good


def weights(raw: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Log ratio of both multinomials, each with one n-gram more in every bucket."""
    if not good.sum():
        return np.zeros(BUCKETS, np.int64)
    ratio = np.log((good + 1) / (good.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))
    return np.rint(ratio * UNIT).astype(np.int64)


def best_cut(scores: list[int], good: list[bool]) -> int:
    """Score that separates good from bad best, in the middle of the gap it lies in."""
    s, g = np.array(scores, np.int64), np.array(good, bool)
    lowest = int(-(1 << 62))
    if not g.any() or g.all():
        return lowest
    order = np.argsort(s, kind="stable")
    s, g = s[order], g[order]
    # Cut k keeps s[k:]; only where the score changes.
    bad_below, good_below = np.concatenate([[0], np.cumsum(~g)]), np.concatenate([[0], np.cumsum(g)])
    gain = bad_below / (~g).sum() - good_below / g.sum()
    cuts = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    k = cuts[np.argmax(gain[cuts])]
    return lowest if k == 0 else int(s[k - 1] + s[k] + 1) // 2


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> Model:
    known = labelled(labels, most)
    trusted = {i for i, (_, own) in known.items() if own}
    model = Model(weights(*count_grams(docs, trusted)), 0)
    rest = known.keys() - trusted

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.begin("quality")
        for b in slices(batches):
            picked = b.filter(pa.array([i in rest for i in b.column(0).to_pylist()], pa.bool_()))
            if picked.num_rows:
                texts = utf8(picked.column(1))
                passed = pa.array([not base_failed(measures(t)) for t in texts])
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": picked.column(0), "score": pa.array(model.scores(texts)), "passed": passed}
                )
        worker.give_back()

    held = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(score, "doc_id long, score long, passed boolean")
    # One row per id and so no more than ``most``, even where rows repeat.
    rows = held.filter("passed").groupBy("doc_id").agg(F.min("score").alias("score")).orderBy("doc_id").collect()
    model.threshold = best_cut([r.score for r in rows], [known[r.doc_id][0] == 1 for r in rows])
    return model


def measures(text: bytes) -> tuple[int, int, int, int, int]:
    """The base measures, in the order of ``MEASURES``."""
    words = text.split()
    code_points = len(text) - sum(text.count(c) for c in BLANKS)
    if not text.isascii():
        code_points = len(text.decode()) - sum(text.count(c) for c in BLANKS)
    seen: set[bytes] = set()
    again = 0
    for line in text.split(b"\n"):
        if line in seen:
            again += 1
        elif line.strip():
            seen.add(line)
    repeat = 0
    if len(words) > WINDOW:
        s = shingles(known_words.of(words), WINDOW)
        order = np.argsort(s)
        same = s[order][1:] == s[order][:-1]
        twice = np.zeros(len(s) + 1, np.int64)
        twice[order[1:][same]] = 1
        twice[order[:-1][same]] = 1
        running = np.concatenate([np.cumsum(twice[:-1]), np.full(WINDOW - 1, twice.sum())])
        running[WINDOW:] -= np.cumsum(twice[:-1])[: len(running) - WINDOW].copy()
        repeat = int((running > 0).sum())
    return len(words), code_points, sum(text.count(c) for c in SYMBOLS), again, repeat


def base_failed(m: tuple[int, ...]) -> bool:
    return m[0] < MIN_WORDS or 100 * m[4] > MAX_REPEAT_PERCENT * m[0]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, the measures, base_failed, kept, score (millionths)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.threshold))
    fields = ("doc_id", *MEASURES)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.begin("quality")
        own = Model(*shared.value)
        for b in slices(batches):
            texts = utf8(b.column(1))
            for start, stop in chunks(texts, GRAM_BYTES):
                part = texts[start:stop]
                rows = [measures(t) for t in part]
                scores = own.scores(part)
                failed = np.array([base_failed(m) for m in rows])
                columns = dict(zip(fields, [b.column(0).slice(start, stop - start), *map(pa.array, zip(*rows))]))
                columns |= {
                    "base_failed": pa.array(failed),
                    "kept": pa.array(~failed & (scores >= own.threshold)),
                    "score": pa.array(scores),
                }
                yield pa.RecordBatch.from_pydict(columns)
        worker.give_back()

    schema = ", ".join(f"{c} long" for c in fields) + ", base_failed boolean, kept boolean, score long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(rate, schema)


def keep(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are kept, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.threshold))
    at = docs.columns.index("text")

    def sieve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.begin("quality")
        own = Model(*shared.value)
        for b in slices(batches):
            texts = utf8(b.column(at))
            kept: list[bool] = []
            for start, stop in chunks(texts, GRAM_BYTES):
                good = own.scores(texts[start:stop]) >= own.threshold
                kept += [bool(g) and not base_failed(measures(t)) for g, t in zip(good, texts[start:stop], strict=True)]
            yield b.filter(pa.array(kept, pa.bool_()))
        worker.give_back()

    return docs.mapInArrow(sieve, docs.schema)


def rate_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
