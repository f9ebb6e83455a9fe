"""Trie of the turns that conversations share from the start, by burst tries.

A turn is known by a digest of its role and text, a conversation by the string of its
turns' digests. Equal strings are one entry with a weight. All entries start in the
container under the root. A container with more than ``CAP`` entries bursts: its node becomes
a trie head and its entries are dealt out by their next turn, until no container is too
large. The containers left are dealt to tasks, sorted, and swept into nodes with a stack.
Heads are what their containers add up to.

A conversation's string is cut into layers of ``LAYER`` turns, so that one with a third of
all turns is many small rows. The entries of a layer are the pieces behind one prefix, which
a fingerprint of 128 bits stands for, and each such shard is a trie of its own below the
node where the prefix ends (its gate). What lies below a gate is summed along conversations
from the back: every shard counts with its smallest member, so nothing counts twice. Deeper
layers are swept once for these sums and once more with them.

Places, sums along conversations and lists of members come from range-sorted rows (see
``ranks``), so that no conversation and no group of copies is one task's rows. The digest of a
node's members is the one thing that has to be read in order: the ids come to it as packed
text, ``PACK`` to a row.

Defined cases: a null role or text is empty, an empty text a turn like any other; null
turns come first; turns of the same number are ordered by their digests, repeated rows are
turns of their own; texts of any length count whole; rows without a conv_id belong to no
conversation; an empty table has no nodes, not even a root; other columns take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import stored
from terrace.llm.ranks import places, range_of, ranged, running

#: Turns of a layer.
LAYER = 64
#: Entries of a container at most.
CAP = 4096
#: Ids in a row of packed text.
PACK = 4096
#: Bytes of a turn's digest.
DIGEST = 16
#: Conversations take their first turns from the one with their id less its remainder by
#: ``EVERY``, as many as the CRC-32 of the id leaves when divided by ``WINDOW``.
EVERY, WINDOW = 5, 9

SHARD = ["layer", "f1", "f2"]
NODE = (
    "layer int, f1 long, f2 long, place int, conv_id long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends string, path binary, sizes array<int>"
)


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest, size (UTF-8 bytes of the text)."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"),
        "turn",
        F.unhex(F.substring(F.sha2(whole, 256), 1, 2 * DIGEST)).alias("digest"),
        F.octet_length(text).alias("size"),
    )


def borrowed(conv: Column | str) -> Column:
    """Turns that a conversation takes from another one at most."""
    return (F.crc32(F.col(conv).cast("string").cast("binary")) % WINDOW).cast("long")


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``turns`` dealt anew: (conv_id, length, place, digest, size), and (conv_id, length) of all conversations."""
    cut = ranged(rows, ["conv_id"], ["turn", "digest"], "trie-turns")
    starts = stored(places(cut, ["conv_id"]), "trie-starts")
    lengths = starts.groupBy("conv_id").agg(F.max("n").alias("n"))
    lent = lengths.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    plan = lengths.withColumns(
        {"base": F.col("conv_id") - F.col("conv_id") % EVERY, "asked": borrowed("conv_id")}
    ).join(lent, "base", "left")
    plan = plan.withColumn("taken", F.least("asked", F.coalesce("base_n", F.lit(0))))
    plan = stored(
        plan.select("conv_id", "asked", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("asked"), F.lit(0))).alias("length")),
        "trie-plan",
    )
    # The plan meets the turns by range and conversation, so that a long one is spread over its ranges.
    known = stored(starts.join(plan, "conv_id"), "trie-starts")
    placed = cut.withColumn("range", range_of()).join(known, ["range", "conv_id"])
    placed = placed.withColumn("k", F.col("at") - F.col("first") + F.col("start"))
    own = placed.filter("k >= asked").select("conv_id", "length", (F.col("taken") + F.col("k") - F.col("asked")).alias("place"), "digest", "size")
    near = F.explode(F.sequence(F.lit(1 - EVERY), F.lit(EVERY - 1)))
    given = (
        placed.filter((F.col("k") < WINDOW - 1) & (F.col("conv_id") % EVERY == 0))
        .select(F.col("conv_id").alias("base"), "k", "digest", "size", near.alias("step"))
        .withColumn("conv_id", F.col("base") + F.col("step"))
        .filter((F.col("conv_id") - F.col("conv_id") % EVERY == F.col("base")) & (F.col("k") < borrowed("conv_id")))
        .join(plan.select("conv_id", "length"), "conv_id")
        .select("conv_id", "length", F.col("k").alias("place"), "digest", "size")
    )
    return own.unionByName(given), plan.select("conv_id", "length")


def layered(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """Rows (conv_id, layer, f1, f2, x1, x2, path, sizes, more): the pieces of every conversation.

    f1, f2 is the fingerprint of what comes before, x1, x2 what the piece adds to it.
    """
    held = F.sort_array(F.collect_list(F.struct("place", "digest", "size")))
    pieces = rows.groupBy("conv_id", "length", F.floor(F.col("place") / F.lit(LAYER)).cast("int").alias("layer")).agg(held.alias("held"))
    pieces = pieces.select(
        "conv_id",
        "length",
        "layer",
        F.unhex(F.array_join(F.transform("held", lambda t: F.hex(t["digest"])), "")).alias("path"),
        F.col("held.size").alias("sizes"),
    )
    silent = lengths.filter("length = 0").select(
        "conv_id", "length", F.lit(0).alias("layer"), F.lit(b"").alias("path"), F.array().cast("array<int>").alias("sizes")
    )
    added = {f"x{k}": F.xxhash64(F.lit(k), F.col("layer"), F.col("path")) for k in (1, 2)}
    whole = stored(pieces.unionByName(silent).withColumns(added), "trie-pieces")
    columns = ["conv_id", "layer", "f1", "f2", "x1", "x2", "path", "sizes", ((F.col("layer") + 1) * LAYER < F.col("length")).alias("more")]
    none = F.lit(0).cast("long")
    short = whole.filter(F.col("length") <= LAYER).withColumns({"f1": none, "f2": none}).select(*columns)
    xor = lambda a, b: a.bitwiseXOR(b)
    long = ranged(whole.filter(F.col("length") > LAYER), ["conv_id"], ["layer"], "trie-long")
    long = running(long, ["conv_id"], {f"f{k}": (F.bit_xor, f"x{k}", xor) for k in (1, 2)})
    # Up to and including a piece, less the piece.
    long = long.withColumns({f"f{k}": xor(F.col(f"f{k}"), F.col(f"x{k}")) for k in (1, 2)})
    return short.unionByName(long.select(*columns))


def members(pieces: DataFrame) -> DataFrame:
    """Digest of the ids that end with each piece, ascending and joined by commas: (layer, f1, f2, x1, x2, ends)."""
    key = [*SHARD, "x1", "x2"]
    cut = ranged(pieces.filter(~F.col("more")).select(*key, "conv_id"), key, ["conv_id"], "trie-members")
    packs = cut.groupBy(*key, F.floor(F.col("at") / F.lit(PACK)).alias("pack")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )
    schema = pa.schema([("layer", pa.int32()), *((c, pa.int64()) for c in key[1:]), ("ends", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, digest = None, None
        for b in batches:
            out = []
            for *own, ids in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if own == last:
                    digest.update(b"," + ids.encode())
                else:
                    if last:
                        out.append((*last, digest.hexdigest()))
                    last, digest = own, hashlib.sha256(ids.encode())
            if out:
                yield made(out, schema)
        if last:
            yield made([(*last, digest.hexdigest())], schema)

    ordered = packs.repartition(*(F.col(c) for c in key)).sortWithinPartitions(*key, "pack")
    return ordered.select(*key, "ids").mapInArrow(read, "layer int, f1 long, f2 long, x1 long, x2 long, ends string")


def made(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(zip(*rows, strict=True), schema.types, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], schema=schema)


def upto(k: Column | int, path: str = "path") -> Column:
    """The first ``k`` turns of a path."""
    return F.substring(F.col(path), F.lit(1), (F.lit(DIGEST) * k).cast("int"))


def n_turns(path: str = "path") -> Column:
    return (F.octet_length(path) / F.lit(DIGEST)).cast("int")


def burst(entries: DataFrame) -> tuple[DataFrame, int]:
    """``entries`` with ``cut``, the depth of each one's container in its shard, and the rounds it took.

    An entry that ends above its container, at a head, has fewer turns than its cut.
    """
    paths = entries.select(*SHARD, "path")
    still, heads = paths, []
    while True:
        k = len(heads)
        sizes = still.groupBy(*SHARD, upto(k).alias("head")).count()
        over = stored(sizes.filter(F.col("count") > CAP).select(*SHARD, "head", F.lit(1).alias("over")), "trie-heads")
        if over.isEmpty():
            break
        heads.append(over)
        still = paths.filter(n_turns() > k).withColumn("head", upto(k)).join(over, [*SHARD, "head"], "left_semi")
    cut = F.lit(0)
    for k, over in enumerate(heads):
        entries = entries.withColumn("head", upto(k)).join(over.withColumnRenamed("over", f"over{k}"), [*SHARD, "head"], "left").drop("head")
        cut = cut + F.coalesce(f"over{k}", F.lit(0))
    return entries.withColumn("cut", cut).drop(*(f"over{k}" for k in range(len(heads)))), len(heads)


class Container:
    """Entries of one container, in order of their paths, made into nodes.

    An entry is (path, sizes, rep, weight, ends, gated, children, leaves, saved): the last
    three are what lies below its gate.
    """

    def __init__(self, key: tuple, cut: int):
        self.key, self.cut, self.entries = key, cut, []

    def nodes(self) -> Iterator[tuple]:
        first = self.entries[0]
        place, size, up = [self.cut], [first[1][self.cut - 1] if self.cut else 0], [-1]
        rep, weight, children, leaves, saved = [first[2]], [0], [0], [0], [0]
        ends: list[str | None] = [None]
        stack, before = [0], b""
        for path, sizes, own, count, digest, gated, below, n, tokens in self.entries:
            shared, most = self.cut, min(len(path), len(before)) // DIGEST
            while shared < most and path[shared * DIGEST : (shared + 1) * DIGEST] == before[shared * DIGEST : (shared + 1) * DIGEST]:
                shared += 1
            del stack[shared - self.cut + 1 :]
            for k in range(shared, len(path) // DIGEST):
                up.append(stack[-1])
                stack.append(len(place))
                place.append(k + 1)
                size.append(sizes[k])
                rep.append(own)
                weight.append(0)
                children.append(0)
                leaves.append(0)
                saved.append(0)
                ends.append(None)
            end = stack[-1]
            rep[end] = min(rep[end], own)
            weight[end] += count
            ends[end] = digest
            children[end] += below or 0
            leaves[end] += n or 0
            saved[end] += tokens or 0
            if gated and not n:
                leaves[end] = -1  # the way down goes on, but is not known yet
            before = path
        # Children come after their parents.
        for k in range(len(place) - 1, -1, -1):
            if leaves[k] <= 0 and not children[k]:
                leaves[k] = leaves[k] + 1
            saved[k] += (weight[k] - 1) * size[k]
            p = up[k]
            if p >= 0:
                weight[p] += weight[k]
                rep[p] = min(rep[p], rep[k])
                children[p] += 1
                leaves[p] += leaves[k]
                saved[p] += saved[k]
        for k in range(len(place)):
            p = up[k]
            top = k == 0
            yield (
                *self.key, place[k], rep[k], None if top else rep[p], weight[k], children[k], leaves[k], saved[k], ends[k],
                first[0][: self.cut * DIGEST] if top else None, first[1][: self.cut] if top else None,
            )


NODE_SCHEMA = pa.schema(
    [
        ("layer", pa.int32()), ("f1", pa.int64()), ("f2", pa.int64()), ("place", pa.int32()), ("conv_id", pa.int64()),
        ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
        ("saved_tokens", pa.int64()), ("ends", pa.string()), ("path", pa.binary()), ("sizes", pa.list_(pa.int32())),
    ]
)


def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of containers whose entries come in order; a container is whole in one task."""
    now, out = None, []
    for b in batches:
        for layer, f1, f2, cut, path, *rest in zip(*(c.to_pylist() for c in b.columns), strict=True):
            key, head = (layer, f1, f2), path[: cut * DIGEST]
            if now is None or (key, cut) != (now.key, now.cut) or head != now.entries[0][0][: cut * DIGEST]:
                if now:
                    out.extend(now.nodes())
                now = Container(key, cut)
            now.entries.append((path, *rest))
            if len(out) >= 10_000:
                yield made(out, NODE_SCHEMA)
                out = []
    if now:
        out.extend(now.nodes())
    if out:
        yield made(out, NODE_SCHEMA)


def swept(entries: DataFrame) -> DataFrame:
    """Nodes of all shards, with the shards' own roots (place 0)."""
    cut, rounds = burst(entries)
    inside = cut.filter(n_turns() >= F.col("cut")).withColumn("head", upto(F.col("cut")))
    dealt = inside.repartition(*(F.col(c) for c in [*SHARD, "head"])).sortWithinPartitions(*SHARD, "path")
    columns = [*SHARD, "cut", "path", "sizes", "conv_id", "weight", "ends", "gated", "below_children", "below_leaves", "below_saved"]
    nodes = stored(dealt.select(*columns).mapInArrow(sweep, NODE), "trie-nodes")
    if not rounds:
        return nodes
    tops = nodes.filter("path IS NOT NULL AND place > 0")
    ended = cut.filter(n_turns() < F.col("cut"))
    heads = head_nodes(tops, ended)
    # Children of a head learn its smallest member.
    parents = heads.select(*SHARD, F.col("path").alias("head"), F.col("conv_id").alias("above"))
    with_parent = tops.unionByName(heads).withColumn("head", upto(F.greatest(F.col("place") - 1, F.lit(0))))
    with_parent = with_parent.join(parents, [*SHARD, "head"], "left")
    known = with_parent.withColumn("parent_conv_id", F.expr("CASE WHEN place > 0 THEN above END")).select(*nodes.columns)
    return nodes.filter("path IS NULL OR place = 0").unionByName(known)


def head_nodes(tops: DataFrame, ended: DataFrame) -> DataFrame:
    """Nodes of the heads above the containers with roots ``tops`` and above entries that end at a head."""
    below = tops.select(
        *SHARD, "path", "sizes", "conv_id", "n_convs", "n_leaves", "saved_tokens", F.lit(None).cast("string").alias("ends"),
        F.sequence(F.lit(0), F.col("place") - 1).alias("heads"), (F.col("place") - 1).alias("parent"),
    )
    none = F.lit(0).cast("long")
    own = ended.select(
        *SHARD, "path", "sizes", "conv_id", F.col("weight").alias("n_convs"), none.alias("n_leaves"), none.alias("saved_tokens"),
        "ends", F.sequence(F.lit(0), n_turns()).alias("heads"), F.lit(-1).alias("parent"),
    )
    each = below.unionByName(own).withColumn("place", F.explode("heads"))
    at_end = (F.col("parent") < 0) & (F.col("place") == n_turns())
    last = F.when(F.col("place") > 0, F.try_element_at("sizes", F.greatest(F.col("place"), F.lit(1)))).otherwise(F.lit(0))
    summed = each.groupBy(*SHARD, "place", upto(F.col("place")).alias("head")).agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"),
        F.count_if(F.col("parent") == F.col("place")).alias("containers"),
        F.max(F.when(at_end, F.col("ends"))).alias("ends"),
        F.max(last).alias("size"),
    )
    summed = stored(summed, "trie-heads")
    value = ((F.col("n_convs") - 1) * F.col("size")).alias("value")
    up = summed.select(*SHARD, F.col("place").alias("low"), F.col("head").alias("path"), value, F.explode(F.sequence(F.lit(0), "place")).alias("place"))
    up = up.groupBy(*SHARD, "place", upto(F.col("place")).alias("head")).agg(
        F.sum("value").alias("heads_saved"), F.count_if(F.col("low") == F.col("place") + 1).alias("heads")
    )
    return stored(
        summed.join(up, [*SHARD, "place", "head"]).select(
            *SHARD, "place", "conv_id", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs",
            (F.col("containers") + F.col("heads")).alias("n_children"), "n_leaves",
            (F.col("saved_tokens") + F.col("heads_saved")).alias("saved_tokens"), "ends", F.col("head").alias("path"),
            F.lit(None).cast("array<int>").alias("sizes"),
        ),
        "trie-heads",
    )


def below_gates(entries: DataFrame, pieces: DataFrame) -> DataFrame:
    """What lies below the gate of each shard of the deeper layers: (layer, f1, f2, below_children, below_leaves, below_saved)."""
    roots = stored(
        swept(entries.filter("layer > 0")).filter("place = 0").select(
            *SHARD, F.col("conv_id").alias("rep"), F.col("n_children").alias("below_children"), "n_leaves", "saved_tokens"
        ),
        "trie-shards",
    )
    deep = pieces.filter("layer > 0").select(*SHARD, "conv_id").join(roots, SHARD)
    counts = F.col("rep") == F.col("conv_id")
    deep = deep.withColumns({c: F.when(counts, F.col(c)).otherwise(F.lit(0)) for c in ("n_leaves", "saved_tokens")})
    cut = ranged(deep.withColumn("back", -F.col("layer")), ["conv_id"], ["back"], "trie-deep")
    both = lambda a, b: a + b
    summed = running(cut, ["conv_id"], {"below_leaves": (F.sum, "n_leaves", both), "below_saved": (F.sum, "saved_tokens", both)})
    return stored(
        summed.groupBy(*SHARD).agg(
            F.first("below_children").alias("below_children"), F.sum("below_leaves").alias("below_leaves"), F.sum("below_saved").alias("below_saved")
        ),
        "trie-gates",
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows, lengths = rebuilt(turns(conversations))
    pieces = layered(rows, lengths)
    key = [*SHARD, "x1", "x2"]
    entries = pieces.groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("weight"),
        F.max("more").alias("gated"),
        F.first("path").alias("path"),
        F.first("sizes").alias("sizes"),
    )
    entries = stored(entries.join(members(pieces), key, "left"), "trie-entries")
    unknown = {c: F.lit(None).cast("long") for c in ("below_children", "below_leaves", "below_saved")}
    if entries.filter("layer > 0").isEmpty():
        nodes = swept(entries.withColumns(unknown))
    else:
        gates = below_gates(entries.withColumns(unknown), pieces)
        # The shard behind a piece, where conversations go on.
        behind = {f"g{k}": F.when(F.col("gated"), F.col(f"f{k}").bitwiseXOR(F.col(f"x{k}"))) for k in (1, 2)}
        entries = entries.withColumns(behind | {"g0": F.col("layer") + 1})
        gates = gates.withColumnsRenamed({"layer": "g0", "f1": "g1", "f2": "g2"})
        whole = stored(entries.join(gates, ["g0", "g1", "g2"], "left"), "trie-entries")
        nodes = swept(whole)
        # A gate's smallest member may end there, so its shard does not know it.
        doors = whole.filter("gated").select(
            F.col("g0").alias("layer"), F.col("g1").alias("f1"), F.col("g2").alias("f2"), F.col("conv_id").alias("door")
        )
        first = (F.col("layer") > 0) & (F.col("place") == 1)
        entered = nodes.filter(first).join(doors, SHARD).withColumn("parent_conv_id", F.col("door")).select(*nodes.columns)
        nodes = nodes.filter(~first).unionByName(entered)
    nothing = hashlib.sha256(b"").hexdigest()
    return nodes.filter("layer = 0 OR place > 0").select(
        "conv_id",
        (F.col("layer").cast("long") * LAYER + F.col("place")).alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends", F.lit(nothing)).alias("ends_sha256"),
    )
