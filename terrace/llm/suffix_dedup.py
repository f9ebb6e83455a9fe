"""Removal of repeated byte strings, by bucket-pointer refinement of sampled suffixes.

A byte goes when a ``SPAN``-byte string that covers it also starts in a document with a
smaller id. Suffix sorting by bucket pointers puts suffixes into buckets by their first
bytes and then refines a bucket by the bucket identifiers at later offsets, whose own
refinements are used at once. Only buckets with several documents need any of it:

1. Of every ``SPAN`` bytes, the q-gram with the smallest hash is an *anchor*, so equal
   strings have equal anchors at equal places. Anchors go into buckets by their q-gram.
2. A bucket is refined by the identifiers of the 16-byte buckets at fixed offsets around
   the anchor, which together span every string through it. Where an earlier document
   shares the refined bucket, all those strings repeat.
3. What is left are the edges of repeats: anchors that an earlier document shares, in other
   surroundings. Their surroundings are compared byte for byte: buckets of 8 bytes are
   refined to 16 by the identifier 8 further on, these to 32, these to ``SPAN``; suffixes
   alone in their bucket are dropped at each step. A q-gram that more than ``HOT_EDGES``
   edges have is a group of its own, whose strings are keys, one offset from the q-gram
   after the other. With more edges than a task has of all (``edges_per_task``) they do not
   meet in one task: each of their strings is a row, and Spark takes the smallest id per
   key, combined before the shuffle. That is 31 rows for an edge, so it is left to q-grams
   that would hold up a task.

Steps 1 and 2 work on packed arrays, a fragment of the hash space at a time (``common``);
a task packs equal texts once, so copies hardly add to the exchange, and copies of a
smaller id are resolved by their digest. Identifiers in steps 1 and 2 are hashes of 40 and
56 bits used together, besides the fragment. What a step shuffled or stored is deleted once
the steps that read it are stored, so disk is what the largest step needs.

Defined cases: null text is empty; texts under ``SPAN`` bytes stay whole; repeated rows
(same id) do not remove each other and give repeated rows; rows with a null id stay whole
and remove nothing; an empty table gives none; other columns take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import fragment_of, fragments_for, from_planes, mixed, opened, planes, squeezed, stored_alone, text_or_empty, utf8
from terrace.session import release_path

SPAN = 50
GRAM = 20
#: q-grams that start in a string of SPAN bytes and lie inside it.
WINDOW = SPAN - GRAM + 1
FRAGMENT_BYTES = 24 << 20
PACK_BYTES = 2 << 20
#: Numpy works on so much of a text at a time; longer ones are cut with an overlap.
SLICE = 1 << 20
PAD = 64
#: Groups of edges for each fragment: bytes take far more room there than packed anchors.
EDGE_GROUPS = 16
#: Edges with one q-gram that may meet those of others in a group.
HOT_EDGES = 2048
#: Edges with one q-gram that may meet in one task at most, about 8 MB.
TASK_EDGES = 1 << 16
REMEMBERED = 100_000
BASE = 0x9E3779B97F4A7C15 | 1
PACKED = "fragment int, docs binary, counts binary, places binary, grams binary, around binary"
FOUND = "doc_id long, covered binary, edges binary"


def _powers(n: int) -> list[np.uint64]:
    out = [1]
    for _ in range(n):
        out.append(out[-1] * BASE % (1 << 64))
    return [np.uint64(p) for p in out]


POWER = _powers(80)


def _double(h: np.ndarray, size: int) -> np.ndarray:
    """Identifiers of strings of twice ``size`` from those of ``size``."""
    return h[:-size] * POWER[size] + h[size:]


def _sliding(a: np.ndarray, pick) -> np.ndarray:
    """``pick`` over every ``WINDOW`` values in a row."""
    size = 1
    while 2 * size <= WINDOW:
        a = pick(a[:-size], a[size:])
        size *= 2
    return pick(a[: len(a) - (WINDOW - size)], a[WINDOW - size :]) if WINDOW > size else a


def slices(text: bytes) -> Iterator[tuple[bytes, int, int, int]]:
    """Parts of a text: bytes, their place, and the range of string starts they answer for."""
    last = len(text) - SPAN + 1
    for start in range(0, last, SLICE):
        stop = min(start + SLICE, last)
        yield text[max(0, start - PAD) : stop + SPAN + PAD], max(0, start - PAD), start, stop


def anchors(parts: list[tuple[bytes, int, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of some parts: index of the part, place in the text, q-gram and surroundings."""
    starts = PAD + np.cumsum([0, *(len(p[0]) + PAD for p in parts)])
    # Bytes count from 1 and padding is 0, so an end of a text equals only another end.
    h1 = np.zeros(starts[-1] + 2 * PAD, np.uint64)
    valid = np.zeros(len(h1), bool)
    for at, (data, place, first, stop) in zip(starts, parts, strict=False):
        h1[at : at + len(data)] = np.frombuffer(data, np.uint8)
        h1[at : at + len(data)] += np.uint64(1)
        valid[at + first - place : at + stop - place] = True
    h4 = _double(_double(h1, 1), 2)
    h16 = _double(_double(h4, 4), 8)
    gram = mixed(h16[: len(h16) - 4] * POWER[4] + h4[16 : 16 + len(h16) - 4])
    least = _sliding(gram, np.minimum)
    least[~valid[: len(least)]] = 0
    # A place is an anchor if the least of some string that holds it is its own.
    most = _sliding(np.concatenate([np.zeros(WINDOW - 1, np.uint64), least]), np.maximum)
    at = np.flatnonzero((gram[: len(most)] == most) & (most > 0))
    around = h16[at - 30]
    for offset in (-14, 2, 18, 34):
        around = mixed(around) + h16[at + offset]
    owner = np.searchsorted(starts, at, side="right") - 1
    place = at - starts[owner] + np.array([p[1] for p in parts], np.int64)[owner]
    return owner, place, mixed(gram[at]), mixed(around)


def pack_anchors(docs: DataFrame, fragments: int) -> DataFrame:
    schema = pa.schema([(c.split()[0], pa.int32() if c.endswith("int") else pa.binary()) for c in PACKED.split(", ")])

    def packed(ids: np.ndarray, parts: list) -> pa.RecordBatch:
        owner, place, gram, around = anchors(parts)
        f = fragment_of(gram, fragments)
        order = np.argsort(f, kind="stable")
        owner, place, gram, around, f = owner[order], place[order], gram[order], around[order], f[order]
        bounds = np.searchsorted(f, np.arange(fragments + 1))
        rows = []
        for k in np.flatnonzero(np.diff(bounds)):
            part = slice(bounds[k], bounds[k + 1])
            holders, counts = np.unique(owner[part], return_counts=True)
            rows.append(
                {
                    "fragment": int(k),
                    "docs": planes(ids[holders], 8),
                    "counts": planes(counts.astype(np.uint32), 4),
                    "places": planes(place[part].astype(np.uint32), 4),
                    "grams": planes(gram[part], 5),
                    "around": planes(around[part], 7),
                }
            )
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        ids: list[int] = []
        parts: list = []
        size = 0
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), utf8(b.column(1)), strict=True):
                if len(text) < SPAN:
                    continue
                key = xxhash.xxh3_128_digest(text)
                if seen.get(key, doc) < doc:
                    continue
                if key in seen or len(seen) < REMEMBERED:
                    seen[key] = doc
                for part in slices(text):
                    ids.append(doc)
                    parts.append(part)
                    size += len(part[0])
                    if size >= PACK_BYTES:
                        yield packed(np.array(ids, np.int64), parts)
                        ids, parts, size = [], [], 0
        if parts:
            yield packed(np.array(ids, np.int64), parts)

    return docs.select(F.col("doc_id").cast("long"), "text").filter("doc_id IS NOT NULL").mapInArrow(pack, PACKED)


def refine_anchors(packed: DataFrame) -> DataFrame:
    """Per document and fragment: places of anchors whose strings all repeat, and of edges."""
    schema = pa.schema([("doc_id", pa.int64()), ("covered", pa.binary()), ("edges", pa.binary())])

    def refine(key: tuple, table: pa.Table) -> pa.Table:
        rows = table.to_pydict()
        join = lambda name, width, kind: np.concatenate([from_planes(d, width, kind) for d in rows[name]])
        doc = np.repeat(join("docs", 8, np.int64), join("counts", 4, np.uint32))
        gram, around, place = join("grams", 5, np.uint64), join("around", 7, np.uint64), join("places", 4, np.uint32)
        order = np.argsort(gram)
        starts = bucket_starts(gram[order])
        sizes = np.diff(np.append(starts, len(order)))
        low, high = np.minimum.reduceat(doc[order], starts), np.maximum.reduceat(doc[order], starts)
        held = order[np.repeat(low < high, sizes)]
        first = np.repeat(low, sizes)[np.repeat(low < high, sizes)]
        gram, around, doc, place = gram[held], around[held], doc[held], place[held]
        # Refined by the surroundings: buckets stay together, in order of the identifiers.
        inner = np.lexsort((around, gram))
        gram, around, doc, place, first = gram[inner], around[inner], doc[inner], place[inner], first[inner]
        if not len(doc):
            return schema.empty_table()
        starts = bucket_starts(gram, around)
        sizes = np.diff(np.append(starts, len(doc)))
        earliest = np.repeat(np.minimum.reduceat(doc, starts), sizes)
        outer = bucket_starts(gram)
        kinds = np.add.reduceat(np.isin(np.arange(len(doc)), starts, assume_unique=True).astype(np.int64), outer)
        mixed_bucket = np.repeat(kinds > 1, np.diff(np.append(outer, len(doc))))
        covered = earliest < doc
        edge = ~covered & mixed_bucket
        some = covered | edge
        doc, place, covered = doc[some], place[some], covered[some]
        by_doc = np.argsort(doc, kind="stable")
        doc, place, covered = doc[by_doc], place[by_doc].astype("<u4"), covered[by_doc]
        cuts = bucket_starts(doc) if len(doc) else np.zeros(0, np.int64)
        ends = np.append(cuts[1:], len(doc))
        whole, edges = [], []
        for a, b in zip(cuts, ends, strict=True):
            whole.append(place[a:b][covered[a:b]].tobytes())
            edges.append(place[a:b][~covered[a:b]].tobytes())
        return pa.Table.from_arrays(
            [pa.array(doc[cuts]), pa.array(whole, pa.binary()), pa.array(edges, pa.binary())], schema=schema
        )

    return packed.groupBy("fragment").applyInArrow(refine, FOUND)


def bucket_starts(*keys: np.ndarray) -> np.ndarray:
    """Where a new bucket begins in sorted keys."""
    changed = np.zeros(len(keys[0]), bool)
    changed[:1] = True
    for k in keys:
        changed[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(changed)


def surroundings(edges: DataFrame, docs: DataFrame, groups: int) -> DataFrame:
    """The bytes around each edge anchor, its place in them, and the group that all equal anchors meet in."""
    names = ("part", "gram", "doc_id", "place", "inner", "data")
    schema = pa.schema(list(zip(names, [pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.binary()], strict=True)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, text, lists in zip(b.column(0).to_pylist(), opened(b.column(1)), b.column(2).to_pylist(), strict=True):
                for at in np.unique(np.frombuffer(b"".join(lists), "<u4")).tolist():
                    low = max(0, at - (SPAN - GRAM))
                    gram = xxhash.xxh3_64_intdigest(text[at : at + GRAM])
                    rows.append((gram % groups, gram - (1 << 63), doc, low, at - low, text[low : at + SPAN]))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema
                )

    held = edges.groupBy("doc_id").agg(F.collect_list("edges").alias("edges"))
    return squeezed(docs, SPAN).join(held, "doc_id").select("doc_id", "data", "edges").mapInArrow(
        cut, "part int, gram long, doc_id long, place long, inner int, data binary"
    )


def next_buckets(a: np.ndarray, b: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket identifiers of pairs, and which suffixes are not alone with their document."""
    order = np.lexsort((b, a))
    starts = bucket_starts(a[order], b[order])
    sizes = np.diff(np.append(starts, len(order)))
    low, high = np.minimum.reduceat(doc[order], starts), np.maximum.reduceat(doc[order], starts)
    identifier, several = np.empty(len(order), np.int64), np.empty(len(order), bool)
    identifier[order] = np.repeat(np.arange(len(starts)), sizes)
    several[order] = np.repeat(low < high, sizes)
    return identifier, several


def repeated_strings(doc: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Of all starts of ``SPAN``-byte strings in some byte runs, those that an earlier document has.

    Exact bucket-pointer refinement: 8 bytes, then 16, 32 and ``SPAN`` by pairs of buckets.
    Returns (index of the run, offset) in columns.
    """
    starts = np.cumsum([0, *map(len, texts)])
    data = np.frombuffer(b"".join(texts) + bytes(8), np.uint8).astype(np.uint64)
    eight = data[: starts[-1]].copy()
    for k in range(1, 8):
        eight = eight << np.uint64(8) | data[k : starts[-1] + k]
    run = np.repeat(np.arange(len(texts)), np.diff(starts))
    left = starts[run + 1] - np.arange(starts[-1])
    bucket = np.full(len(run) + 1, -1, np.int64)
    at = np.flatnonzero(left >= 8)
    bucket[at], several = next_buckets(eight[at], np.zeros(len(at), np.uint64), doc[run[at]])
    size = 8
    for longer in (16, 32, SPAN):
        # A string lies within one run, and so do the two shorter ones that make it up.
        at = at[several]
        at = at[left[at] >= longer]
        at = at[bucket[at + longer - size] >= 0]
        if not len(at):
            return np.zeros((0, 2), np.int64)
        identifier, several = next_buckets(bucket[at], bucket[at + longer - size], doc[run[at]])
        bucket[:] = -1
        bucket[at] = identifier
        size = longer
    at, identifier = at[several], identifier[several]
    if not len(at):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(identifier, kind="stable")
    own = doc[run[at[order]]]
    cuts = bucket_starts(identifier[order])
    low = np.repeat(np.minimum.reduceat(own, cuts), np.diff(np.append(cuts, len(order))))
    found = at[order][low < own]
    return np.stack([run[found], found - starts[run[found]]], axis=1)


def repeated_keys(doc: np.ndarray, inner: np.ndarray, data: pa.Array) -> np.ndarray:
    """``repeated_strings`` for runs that all hold a q-gram, at ``inner``, and that may be many.

    Equal strings hold their anchor at equal places, so strings are compared with those that
    start as far from the q-gram; each is a key of its own. Memory is a string for each run.
    """
    starts = np.frombuffer(data.buffers()[1], np.int32)[data.offset : data.offset + len(data) + 1].astype(np.int64)
    bytes_ = np.frombuffer(data.buffers()[2] or b"", np.uint8)
    found = [np.zeros((0, 2), np.int64)]
    for before in range(WINDOW):
        start = starts[:-1] + inner - before
        run = np.flatnonzero((before <= inner) & (start + SPAN <= starts[1:]))
        if not len(run):
            continue
        strings = np.lib.stride_tricks.sliding_window_view(bytes_, SPAN)[start[run]]
        keys = pa.FixedSizeBinaryArray.from_buffers(pa.binary(SPAN), len(run), [None, pa.py_buffer(strings)]).dictionary_encode()
        key, own = keys.indices.to_numpy(), doc[run]
        low = np.full(len(keys.dictionary), np.iinfo(np.int64).max)
        np.minimum.at(low, key, own)
        run = run[low[key] < own]
        found.append(np.stack([run, inner[run] - before], axis=1))
    return np.concatenate(found)


def refine_edges(around: DataFrame) -> DataFrame:
    """Starts of repeated strings at the edges, per document; a part below 0 is one of a hot q-gram."""
    schema = pa.schema([("doc_id", pa.int64()), ("starts", pa.binary())])

    def refine(key: tuple, table: pa.Table) -> pa.Table:
        doc, place = table["doc_id"].to_numpy(), table["place"].to_numpy()
        if key[0].as_py() < 0:
            found = repeated_keys(doc, table["inner"].to_numpy().astype(np.int64), table["data"].combine_chunks())
        else:
            found = repeated_strings(doc, table["data"].to_pylist())
        if not len(found):
            return schema.empty_table()
        owner, start = doc[found[:, 0]], place[found[:, 0]] + found[:, 1]
        order = np.lexsort((start, owner))
        owner, start = owner[order], start[order].astype("<u4")
        cuts = bucket_starts(owner)
        runs = np.split(start, cuts[1:])
        return pa.Table.from_arrays(
            [pa.array(owner[cuts]), pa.array([np.unique(r).tobytes() for r in runs], pa.binary())], schema=schema
        )

    return around.groupBy("part").applyInArrow(refine, "doc_id long, starts binary")


def hot_starts(around: DataFrame) -> DataFrame:
    """Starts of repeated strings at edges whose q-gram very many share, per document.

    Every string is a row, keyed by its bytes, so a q-gram splits by its surroundings.
    """
    offsets = F.sequence(F.lit(0), F.octet_length("data") - SPAN)
    strings = (
        around.filter(F.octet_length("data") >= SPAN)
        .select("doc_id", "place", "data", F.explode(offsets).alias("offset"))
        .select("doc_id", (F.col("place") + F.col("offset")).alias("start"), F.substring("data", F.col("offset") + 1, SPAN).alias("string"))
    )
    firsts = strings.groupBy("string").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    later = strings.join(firsts.filter("first < last").drop("last"), "string").filter("first < doc_id")
    schema = pa.schema([("doc_id", pa.int64()), ("starts", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            packed = [np.array(x, "<u4").tobytes() for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(packed, pa.binary())], schema=schema)

    starts = later.groupBy("doc_id").agg(F.array_sort(F.collect_set("start")).alias("starts"))
    return starts.mapInArrow(pack, "doc_id long, starts binary")


def edges_per_task(around: DataFrame) -> int:
    """Edges that may meet in one task for a q-gram they share: no more than a task has of all edges."""
    tasks = int(around.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(HOT_EDGES, min(TASK_EDGES, around.count() // tasks))


def edge_starts(around: DataFrame) -> DataFrame:
    """Starts of repeated strings at all edges, per document in one row or more."""
    around = stored_alone(around, "edge-bytes")
    counts = around.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT_EDGES)
    hot = stored_alone(counts.select("gram", (F.col("n") > edges_per_task(around)).alias("split")), "hot-grams")
    own = F.when(F.col("split").isNull(), F.col("part")).otherwise((-1 - F.pmod("gram", F.lit((1 << 31) - 1))).cast("int"))
    meet = around.join(hot, "gram", "left").filter("split IS NULL OR NOT split").withColumn("part", own).drop("gram", "split")
    starts = refine_edges(meet)
    split = hot.filter("split").select("gram")
    if not split.isEmpty():
        starts = starts.unionByName(hot_starts(around.join(split, "gram")))
    starts = stored_alone(starts, "edge-starts")
    release_path(around)
    release_path(hot)
    return starts


def removed_runs(length: int, covered: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Maximal removed runs (start, stop): around covered anchors, and strings from ``starts``."""
    low = np.concatenate([np.maximum(covered - (SPAN - GRAM), 0), starts])
    high = np.minimum(np.concatenate([covered + SPAN, starts + SPAN]), length)
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    new = np.flatnonzero(np.append(True, low[1:] > high[:-1]))
    return np.stack([low[new], np.append(high[new[1:] - 1], high[-1])], axis=1)


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, covered, starts (lists of packed places), copy (a smaller id has the whole text)."""
    fragments = fragments_for(docs, FRAGMENT_BYTES)
    found = stored_alone(refine_anchors(pack_anchors(docs, fragments)), "anchors")
    edges = found.filter(F.octet_length("edges") > 0).select("doc_id", "edges")
    starts = edge_starts(surroundings(edges, docs, EDGE_GROUPS * fragments))
    by_text = docs.filter("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long"), F.sha2(text_or_empty().cast("binary"), 256).alias("digest")
    )
    by_text = stored_alone(by_text, "text-digests")
    firsts = by_text.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    # Stored, so that Spark splits a text that a third of the documents have.
    firsts = stored_alone(firsts.filter("first < last"), "text-firsts")
    copies = by_text.join(firsts, "digest").filter("doc_id > first").select("doc_id").distinct()
    none = F.lit(None).cast("binary")
    places = (
        found.filter(F.octet_length("covered") > 0)
        .select("doc_id", "covered", none.alias("starts"), F.lit(False).alias("copy"))
        .unionByName(starts.select("doc_id", none.alias("covered"), "starts", F.lit(False).alias("copy")))
        .unionByName(copies.select("doc_id", none.alias("covered"), none.alias("starts"), F.lit(True).alias("copy")))
    )
    places = places.groupBy("doc_id").agg(
        F.collect_list("covered").alias("covered"), F.collect_list("starts").alias("starts"), F.max("copy").alias("copy")
    )
    places = stored_alone(places, "repeats")
    for step in (found, starts, by_text, firsts):
        release_path(step)
    return places


def runs_of(text: bytes, covered: list[bytes], starts: list[bytes], copy: bool) -> np.ndarray:
    if copy and len(text) >= SPAN:
        return np.array([[0, len(text)]])
    places = [np.frombuffer(b"".join(x or []), "<u4").astype(np.int64) for x in (covered, starts)]
    return removed_runs(len(text), *places) if sum(map(len, places)) else np.zeros((0, 2), np.int64)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept (bytes)."""
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept")
    pair = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
    kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pair), pa.binary()]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            ids, texts = b.column(0).to_pylist(), opened(b.column(1))
            for doc, text, *found in zip(ids, texts, *(b.column(k).to_pylist() for k in (2, 3, 4)), strict=True):
                runs = runs_of(text, *found).tolist()
                view, at, kept = memoryview(text), 0, []
                for start, stop in runs:
                    kept.append(view[at:start])
                    at = stop
                rest = b"".join([*kept, view[at:]])
                rows.append(
                    (doc, len(text), len(text) - len(rest), len(runs), hashlib.sha256(rest).hexdigest(),
                     [{"start": s, "stop": e} for s, e in runs], rest)
                )
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], schema=schema)

    return (
        squeezed(docs)
        .join(repeats(docs), "doc_id", "left")
        .select("doc_id", "data", "covered", "starts", "copy")
        .mapInArrow(
            remove,
            "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
            "spans array<struct<start: long, stop: long>>, kept binary",
        )
    )
