"""Documents linked by the Jaccard similarity of their word shingles, by vertical partitioning.

The global order of shingles is (number of documents that hold one, hash). The hash space
is cut into fragments, and each fragment is joined on its own:

1. A task hashes the shingles of its texts and packs them by fragment (``common``).
2. In a fragment, shingles that only one document holds are dropped: they count for sizes
   but can't overlap. What remains of a document is its segments, one for each fragment.
3. Two documents that link overlap in at least three quarters of either, so a document
   with fewer shared shingles has no link, and linked ones share one of the first
   ``shared - needed + 1`` shared shingles of both in the global order (its *prefix*).
4. For a pair, the overlap is counted in each fragment by itself and summed per pair.

Which pairs: per prefix shingle, first every document with one leader, the document with
the fewest shingles of its own; then, within each leader's group, members that are not in
its largest component with all others, in blocks that a task holds (``links_across``).
Pairs within a component need no count; pairs are never rows there, only links that join
components. Nothing is capped, and every pair that could join two is counted. Documents with equal sets are one member throughout; a
task packs a set it has seen only once, so copies hardly add to the exchange.

Shingles are 64-bit hashes of word sequences, compared by 48 bits and their fragment.

Defined cases: null texts and texts without words have no shingles, link with nothing and
are their own component; a text of fewer words than a shingle is one shingle; repeated
rows give repeated rows; an empty table gives none; other columns take no part. Null ids
are allowed for texts of their own only: such rows are kept as they are, unlinked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import (
    chunks,
    connected,
    fragment_of,
    fragments_for,
    from_planes,
    known_words,
    planes,
    shingles,
    stored,
    utf8,
    worker,
)

SHINGLE = 5
#: Linked: 100 * intersection >= 75 * union, that is 7 * intersection >= 3 * sum of sizes.
FRAGMENT_BYTES = 24 << 20
PACK_BYTES = 8 << 20
#: Fragments are put together to so many for counting overlaps of pairs.
COUNTED_IN = 8
#: Members of a group, of either side, that are compared in one task.
BLOCK = 512
#: Sets that a task remembers, to pack equal ones once.
REMEMBERED = 100_000
PACKED = "fragment int, docs binary, counts binary, data binary"
SEGMENT = "doc_id long, fragment int, n long, tokens array<long>, freqs array<int>"

def linked(overlap: Column, n: Column, m: Column) -> Column:
    return 7 * overlap >= 3 * (n + m)


def needed(n: Column) -> Column:
    """Smallest overlap with which a set of ``n`` can link with any other."""
    return F.ceil(n * 3 / 4)


def shingle_set(text: bytes, size: int = SHINGLE) -> np.ndarray:
    return np.unique(shingles(known_words.of(text.lower().split()), size))


def pack_shingles(docs: DataFrame, fragments: int, size: int = SHINGLE) -> DataFrame:
    """Shingle hashes by fragment; rows of a fragment below 0 tell a document's size and set."""

    def packed(ids: list[int], sets: list[np.ndarray]) -> Iterator[dict]:
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        h = np.concatenate(sets)
        f = fragment_of(h, fragments)
        order = np.argsort(f, kind="stable")
        h, f, owner = h[order], f[order], owner[order]
        bounds = np.searchsorted(f, np.arange(fragments + 1))
        all_ids = np.array(ids, np.int64)
        for k in np.flatnonzero(np.diff(bounds)):
            part = slice(bounds[k], bounds[k + 1])
            holders, counts = np.unique(owner[part], return_counts=True)
            yield {
                "fragment": int(k),
                "docs": planes(all_ids[holders], 8),
                "counts": planes(counts.astype(np.uint32), 4),
                "data": planes(h[part], 6),
            }

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.begin("shingles")
        seen: set[bytes] = set()
        for b in batches:
            texts, ids = utf8(b.column(1)), b.column(0).to_pylist()
            for start, stop in chunks(texts, PACK_BYTES):
                known, sets, rows = [], [], []
                own_ids, sizes, keys = [], [], []
                for doc, text in zip(ids[start:stop], texts[start:stop], strict=True):
                    s = shingle_set(text, size)
                    if not len(s):
                        continue
                    key = xxhash.xxh3_128_digest(s.tobytes())
                    new = key not in seen
                    if new:
                        if len(seen) < REMEMBERED:
                            seen.add(key)
                        known.append(doc)
                        sets.append(s)
                    own_ids.append(doc)
                    sizes.append(len(s) * 2 + new)
                    keys.append(key)
                if own_ids:
                    rows.append(
                        {
                            "fragment": -1 - (own_ids[0] % fragments),
                            "docs": planes(np.array(own_ids, np.int64), 8),
                            "counts": planes(np.array(sizes, np.uint64), 8),
                            "data": b"".join(keys),
                        }
                    )
                if sets:
                    rows += packed(known, sets)
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
        worker.give_back()

    schema = pa.schema(
        [("fragment", pa.int32()), ("docs", pa.binary()), ("counts", pa.binary()), ("data", pa.binary())]
    )
    return docs.select(F.col("doc_id").cast("long"), "text").filter("doc_id IS NOT NULL").mapInArrow(pack, PACKED)


def segments(packed: DataFrame) -> DataFrame:
    """Per document and fragment the shingles that another document holds too, and their frequency.

    Rows of a fragment below 0 carry a document's size, its set's key (as two longs) and
    whether its shingles were packed.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("fragment", pa.int32()), ("n", pa.int64()), ("tokens", pa.list_(pa.int64())),
         ("freqs", pa.list_(pa.int32()))]
    )

    def sizes(rows: dict) -> pa.Table:
        docs = np.concatenate([from_planes(d, 8, np.int64) for d in rows["docs"]])
        coded = np.concatenate([from_planes(c, 8, np.uint64) for c in rows["counts"]]).astype(np.int64)
        keys = np.frombuffer(b"".join(rows["data"]), np.int64)
        ends = np.arange(len(docs) + 1, dtype=np.int32)
        return pa.Table.from_arrays(
            [pa.array(docs), pa.array(np.full(len(docs), -1, np.int32)), pa.array(coded // 2),
             pa.ListArray.from_arrays(pa.array(2 * ends), pa.array(keys)),
             pa.ListArray.from_arrays(pa.array(ends), pa.array((coded % 2).astype(np.int32)))],
            schema=schema,
        )

    def shared(key: tuple, table: pa.Table) -> pa.Table:
        worker.begin("shared shingles")
        made = held_twice(key, table)
        worker.give_back()
        return made

    def held_twice(key: tuple, table: pa.Table) -> pa.Table:
        fragment = key[0].as_py()
        rows = table.to_pydict()
        if fragment < 0:
            return sizes(rows)
        docs = np.concatenate([from_planes(d, 8, np.int64) for d in rows["docs"]])
        counts = np.concatenate([from_planes(c, 4, np.uint32) for c in rows["counts"]])
        h = np.concatenate([from_planes(d, 6, np.uint64) for d in rows["data"]])
        known, number = np.unique(docs, return_inverse=True)
        owner = np.repeat(number.astype(np.int32), counts)
        if len(known) < len(docs):
            # A row that is given twice holds its shingles once.
            once = np.unique(np.stack([h, owner.astype(np.uint64)], axis=1), axis=0)
            h, owner = once[:, 0], once[:, 1].astype(np.int32)
        docs = known
        order = np.argsort(h)
        h = h[order]
        starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        freq = np.diff(np.append(starts, len(h)))
        many = np.repeat(freq > 1, freq)
        freq = np.repeat(freq, freq)[many].astype(np.int32)
        h, owner = h[many], owner[order][many]
        by_doc = np.argsort(owner, kind="stable")
        h, owner, freq = h[by_doc], owner[by_doc], freq[by_doc]
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else owner
        ends = np.append(first, len(owner)).astype(np.int32)
        tokens = (h | np.uint64(fragment & 0xFFFF) << np.uint64(48)).view(np.int64)
        return pa.Table.from_arrays(
            [pa.array(docs[owner[first]]), pa.array(np.full(len(first), fragment, np.int32)),
             pa.array(np.diff(ends).astype(np.int64)), pa.ListArray.from_arrays(pa.array(ends), pa.array(tokens)),
             pa.ListArray.from_arrays(pa.array(ends), pa.array(freq))],
            schema=schema,
        )

    return packed.groupBy("fragment").applyInArrow(shared, SEGMENT)


def overlaps(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs (a, b, n, m) that link. Overlaps are counted by fragment and summed per pair."""
    left = parts.select(F.col("doc_id").alias("a"), "part", F.col("tokens").alias("tokens_a"))
    right = parts.select(F.col("doc_id").alias("b"), "part", F.col("tokens").alias("tokens_b"))
    partial = (
        pairs.join(left, "a")
        .join(right, ["b", "part"])
        .select("a", "b", "n", "m", F.size(F.array_intersect("tokens_a", "tokens_b")).cast("long").alias("common"))
    )
    total = partial.groupBy("a", "b", "n", "m").agg(F.sum("common").alias("common"))
    return total.filter(linked(F.col("common"), F.col("n"), F.col("m"))).select("a", "b")


def could_link(n: str, m: str, s: str, t: str) -> Column:
    """What sizes and numbers of shared shingles allow."""
    return linked(F.least(F.col(s), F.col(t), F.col(n), F.col(m)), F.col(n), F.col(m))


def links_across(groups: DataFrame, label: DataFrame, parts: DataFrame) -> DataFrame:
    """Links that join components, within the group of each leader.

    Members outside the group's largest component are compared with all members, in blocks
    of at most about ``BLOCK`` of either, so that a task holds no whole group. Overlaps
    are counted shingle range by shingle range and summed per pair inside the block; of the
    links found a block returns those that join its components, fewer than its members.
    """
    members = groups.join(label.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "leader", "doc_id", F.col("m").alias("n"), F.coalesce("component", "doc_id").alias("component")
    )
    members = stored(members, "members")
    split = (
        members.groupBy("leader", "component")
        .agg(F.count(F.lit(1)).alias("size"))
        .groupBy("leader")
        .agg(F.max(F.struct("size", "component")).alias("top"), F.sum("size").alias("all"))
        .select("leader", F.col("top.component").alias("top"), "all", (F.col("all") - F.col("top.size")).alias("rest"))
        .filter("rest > 0")
    )
    blocks = lambda size: F.ceil(F.col(size) / BLOCK).cast("int")
    dealt = members.join(split, "leader").withColumn("deal", F.xxhash64("doc_id"))
    one = dealt.filter("component <> top").select(
        "leader", "doc_id", "n", "component", F.lit(True).alias("outside"),
        F.pmod("deal", blocks("rest")).cast("int").alias("x"), F.explode(F.sequence(F.lit(0), blocks("all") - 1)).alias("y"),
    )
    all_ = dealt.select(
        "leader", "doc_id", "n", "component", F.lit(False).alias("outside"),
        F.explode(F.sequence(F.lit(0), blocks("rest") - 1)).alias("x"), F.pmod("deal", blocks("all")).cast("int").alias("y"),
    )
    sets = parts.groupBy("doc_id").agg(F.flatten(F.collect_list("tokens")).alias("tokens"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        worker.begin("shared shingles")
        outside = table["outside"].to_numpy()
        sides = [table.filter(pa.array(outside)), table.filter(pa.array(~outside))]
        if not all(t.num_rows for t in sides):
            return schema.empty_table()
        doc, n, component = ([t[c].to_numpy() for t in sides] for c in ("doc_id", "n", "component"))
        common = counted(*([np.asarray(x) for x in t["tokens"].to_numpy()] for t in sides))
        linked_here = (7 * common >= 3 * (n[0][:, None] + n[1][None, :])) & (
            component[0][:, None] != component[1][None, :]
        )
        i, j = np.nonzero(linked_here)
        # One link for each pair of components, and of those no more than join them.
        _, first = np.unique(np.stack([component[0][i], component[1][j]]), axis=1, return_index=True)
        root: dict[int, int] = {}

        def find(c: int) -> int:
            while root.setdefault(c, c) != c:
                root[c] = c = root[root[c]]
            return c

        rows = []
        for k in first.tolist():
            p, q = find(int(component[0][i[k]])), find(int(component[1][j[k]]))
            if p != q:
                root[p] = q
                rows.append((int(doc[0][i[k]]), int(doc[1][j[k]])))
        return pa.Table.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in (0, 1)], schema=schema)

    return one.unionByName(all_).join(sets, "doc_id").groupBy("leader", "x", "y").applyInArrow(compare, "a long, b long")


def counted(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Overlap of every set on the left with every one on the right.

    The tokens that both sides have are cut into ranges of ``width``; the overlaps in each
    are counted by themselves, as a product of two 0/1 matrices, and added up.
    """
    total = np.zeros((len(left), len(right)), np.int64)
    token, owner = [], []
    for sets in (left, right):
        token.append(np.concatenate(sets))
        owner.append(np.repeat(np.arange(len(sets)), [len(x) for x in sets]))
    both = np.intersect1d(*token)
    place = [np.searchsorted(both, t) for t in token]
    held = [(p < len(both)) & (both[np.minimum(p, len(both) - 1)] == t) if len(both) else p < 0 for p, t in zip(place, token, strict=True)]
    place, owner = ([x[h] for x, h in zip(xs, held, strict=True)] for xs in (place, owner))
    order = [np.argsort(p, kind="stable") for p in place]
    place, owner = ([x[o] for x, o in zip(xs, order, strict=True)] for xs in (place, owner))
    for start in range(0, len(both), width):
        size = min(width, len(both) - start)
        matrices = []
        for p, o, sets in zip(place, owner, (left, right), strict=True):
            a, b = np.searchsorted(p, [start, start + size])
            m = np.zeros((len(sets), size), np.float32)
            m[o[a:b], p[a:b] - start] = 1
            matrices.append(m)
        total += (matrices[0] @ matrices[1].T).astype(np.int64)
    return total


def shingle_components(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable by links)."""
    fragments = fragments_for(docs, FRAGMENT_BYTES)
    found = stored(segments(pack_shingles(docs, fragments, size)), "segments")
    info = found.filter("fragment < 0").select(
        "doc_id", "n", F.col("tokens")[0].alias("k1"), F.col("tokens")[1].alias("k2"), (F.col("freqs")[0] == 1).alias("packed")
    )
    classes = stored(
        info.groupBy("n", "k1", "k2").agg(
            F.min("doc_id").alias("first"), F.min(F.when(F.col("packed"), F.col("doc_id"))).alias("member")
        ),
        "classes",
    )
    shared = found.filter("fragment >= 0")
    counts = shared.groupBy("doc_id").agg(F.sum("n").alias("s"))
    able = stored(
        classes.select(F.col("member").alias("doc_id"), "n")
        .join(counts, "doc_id")
        .filter(F.col("s") >= needed(F.col("n")))
        .select("doc_id", "n", "s"),
        "able",
    )
    held = shared.select("doc_id", "fragment", "tokens", "freqs").join(able, "doc_id")
    parts = stored(
        held.groupBy("doc_id", F.pmod("fragment", F.lit(COUNTED_IN)).alias("part")).agg(
            F.flatten(F.collect_list("tokens")).alias("tokens")
        ),
        "parts",
    )
    ordered = F.sort_array(F.flatten(F.collect_list(F.arrays_zip("freqs", "tokens"))))
    length = (F.col("s") - needed(F.col("n")) + 1).cast("int")
    prefix = stored(
        held.groupBy("doc_id", "n", "s")
        .agg(ordered.alias("order"))
        .select("doc_id", "n", "s", F.explode(F.slice("order", F.lit(1), length)).alias("token"))
        .select("doc_id", "n", "s", F.col("token.tokens").alias("token")),
        "prefixes",
    )
    # The leader of a shingle: the document with the fewest shingles that no other has.
    lead = F.min(F.struct((F.col("n") - F.col("s")).alias("own"), "doc_id", "n", "s"))
    leaders = prefix.groupBy("token").agg(lead.alias("lead"), F.count(F.lit(1)).alias("holders")).filter("holders > 1")
    # Two documents that share a prefix shingle share its leader's group, with it.
    groups = stored(
        prefix.join(leaders, "token")
        .select(F.col("lead.doc_id").alias("leader"), F.col("lead.n").alias("n"), F.col("lead.s").alias("s"),
                "doc_id", F.col("n").alias("m"), F.col("s").alias("t"))
        .distinct(),
        "groups",
    )
    stars = stored(
        groups.filter((F.col("leader") != F.col("doc_id")) & could_link("n", "m", "s", "t")).select(
            F.col("leader").alias("a"), F.col("doc_id").alias("b"), "n", "m"
        ),
        "stars",
    )
    links = stored(overlaps(stars, parts), "links")
    more = stored(links_across(groups, connected(links), parts), "links-across")
    label = connected(links.union(more))
    # Classes of equal sets join their member's component; its id is the smallest of all.
    named = classes.join(label.withColumnRenamed("id", "member"), "member", "left").withColumn(
        "component", F.coalesce("component", "member")
    )
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    by_class = named.join(smallest, "component").select("n", "k1", "k2", "component_id")
    result = stored(
        info.join(by_class, ["n", "k1", "k2"]).groupBy("doc_id").agg(F.max("n").alias("n"), F.min("component_id").alias("component_id")),
        "components",
    )
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"))
        .join(result, "doc_id", "left")
        .select(
            "doc_id", F.coalesce("n", F.lit(0).cast("long")).alias("n_shingles"),
            F.coalesce("component_id", "doc_id").alias("component_id"),
        )
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents with the smallest id of their component, with all their columns."""
    kept = shingle_components(docs).filter("doc_id = component_id").select("doc_id").distinct()
    nameless = docs.filter("doc_id IS NULL")
    return docs.join(kept, "doc_id", "left_semi").select(*docs.columns).unionByName(nameless)
