"""Merkle manifest of a dataset: one tree per source, one tree over the sources' roots, and proofs.

H is the lowercase hex SHA-256 of its inputs one after the other, digests as hex text. A
leaf is H of a row's fields, each as ``-`` if null, else its UTF-8 length, ``:`` and its
value. Leaves of a source ascend by id; every ``FAN`` consecutive nodes of a level, the
last ones perhaps fewer, become their H until one is left.

Building: leaves get their places from range-sorted rows, so that a source with a third of
all rows is many ranges. ``ROUND`` levels at a time, Spark groups at most FAN ** ROUND
neighbours, in as many rounds as the largest tree has such steps.

Proving is an octopus multiproof. A leaf partition is a run of at most ``RUN`` leaves in
order. It computes which nodes its paths to the root need and its own leaves do not give,
each once for all of them; one join fetches these from the stored nodes; the partition
derives the inner nodes its leaves share and reads each leaf's own proof off them. Nothing
but the root, 64 characters, comes to the driver.

Defined cases: null fields are hashed as such, a null id comes first; a null source is a
source of its own, the first; rows with the same id are leaves in order of their hash,
repeated rows repeated leaves; an empty text is a value of length 0; texts of any length
are hashed whole; an empty table has no root and no proofs; other columns take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import stored
from terrace.llm.ranks import places, range_of, ranged

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 3
#: Levels that one grouping builds: groups of 3 ** 7 = 2,187 nodes.
ROUND = 7
#: Leaves of a leaf partition at most.
RUN = 8192
#: The key of the tree over the sources; keys of sources are not empty.
TOP = ""


def leaf_hash(**fields: Column | str) -> Column:
    """H of the fields in the order given."""
    shown = []
    for f in fields.values():
        value = (F.col(f) if isinstance(f, str) else f).cast("string")
        shown.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*shown), 256)


def tree_key(source: str = "source") -> Column:
    """A source as the key of its tree. Keys sort like sources by their bytes, null first."""
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("-"))


def depth(n: Column | str) -> Column:
    """Levels above the leaves of a tree with ``n`` leaves."""
    powers = F.array(*(F.lit(FAN**k) for k in range(40)))
    return F.size(F.filter(powers, lambda p: p < F.col(n)))


@dataclass
class Manifest:
    """Written tables: ``leaves`` (tree, place, n, top_place, part, doc_id, leaf, claim), ``nodes``
    (tree, level, place, hash) of all levels from the leaves up, ``trees`` (tree, n, top_place, subroot);
    and the number of trees and the root."""

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame
    n_trees: int
    root: str | None


def level_above(nodes: Column) -> Column:
    """H of every ``FAN`` consecutive nodes of an array."""
    runs = F.sequence(F.lit(0), F.ceil(F.size(nodes) / F.lit(FAN)).cast("int") - 1)
    return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(nodes, i * FAN + 1, F.lit(FAN)), ""), 256))


def grown(leaves: DataFrame, label: str) -> DataFrame:
    """All nodes (tree, n, level, place, hash) of trees with leaves (tree, n, place, hash)."""
    most = leaves.agg(F.max(depth("n"))).first()[0] or 0
    base = leaves.select("tree", "n", F.lit(0).alias("level"), "place", "hash")
    written = [base]
    for low in range(0, most, ROUND):
        block = F.floor(F.col("place") / F.lit(FAN**ROUND)).alias("block")
        here = F.struct("place", "hash")
        # Trees that end below this level take no part.
        groups = (
            base.filter(depth("n") > low).groupBy("tree", "n", block).agg(F.sort_array(F.collect_list(here)).alias("held"))
        )
        groups = groups.select("tree", "n", "block", depth("n").alias("depth"), F.col("held.hash").alias("h0"))
        for k in range(ROUND):
            above = level_above(F.col(f"h{k}"))
            none = F.array().cast("array<string>")
            groups = groups.withColumn(f"h{k + 1}", F.when(F.col("depth") > low + k, above).otherwise(none))
        levels = F.array(
            *(
                F.struct(F.lit(low + k).alias("level"), (F.col("block") * FAN ** (ROUND - k)).alias("start"), F.col(f"h{k}").alias("h"))
                for k in range(1, ROUND + 1)
            )
        )
        made = groups.select("tree", "n", F.explode(levels).alias("l")).select(
            "tree", "n", "l.level", "l.start", F.posexplode("l.h").alias("i", "hash")
        )
        made = stored(made.select("tree", "n", "level", (F.col("start") + F.col("i")).alias("place"), "hash"), label)
        base = made.filter(F.col("level") == low + ROUND)
        written.append(made)
    out = written[0]
    for made in written[1:]:
        out = out.unionByName(made)
    return out


def build(docs: DataFrame, claim: Column | None = None) -> Manifest:
    """The manifest of ``docs``. ``claim`` is the text that is later presented for each row, by default its own."""
    ids = {f: f for f in FIELDS}
    own = leaf_hash(**ids)
    presented = own if claim is None else leaf_hash(**ids | {"text": claim})
    hashed = stored(
        docs.select(tree_key().alias("tree"), F.col("doc_id").cast("long"), own.alias("leaf"), presented.alias("claim")),
        "merkle-hashed",
    )
    cut = ranged(hashed, ["tree"], ["doc_id", "leaf", "claim"], "merkle-leaves")
    # Trees in order of their keys: a tree's place is the number of trees that begin before.
    starts = stored(places(cut, ["tree"]), "merkle-starts")
    keys = ranged(starts.filter("start = 0").select("tree", "n"), [], ["tree"], "merkle-trees")
    n_trees = keys.count()
    tops = keys.withColumn("range", range_of()).join(places(keys, []).select("range", "first", "start"), "range")
    tops = stored(tops.select("tree", (F.col("at") - F.col("first") + F.col("start")).alias("top_place")), "merkle-tops")
    starts = stored(starts.join(tops, "tree"), "merkle-starts")
    leaves = (
        cut.withColumn("range", range_of())
        .join(starts, ["range", "tree"])
        .select(
            "tree", "n", "top_place", (F.col("at") - F.col("first") + F.col("start")).alias("place"), "doc_id", "leaf", "claim",
            F.floor(F.col("at") / F.lit(RUN)).alias("part"),
        )
    )
    leaves = stored(leaves, "merkle-leaves")
    below = grown(leaves.select("tree", "n", "place", F.col("leaf").alias("hash")), "merkle-nodes")
    subroots = stored(below.filter(F.col("level") == depth("n")).select("tree", "n", F.col("hash").alias("subroot")), "merkle-subroots")
    trees = stored(subroots.join(tops, "tree"), "merkle-trees")
    above = grown(
        trees.select(F.lit(TOP).alias("tree"), F.lit(n_trees).cast("long").alias("n"), F.col("top_place").alias("place"), F.col("subroot").alias("hash")),
        "merkle-nodes",
    )
    root = above.filter(F.col("level") == depth("n")).select("hash").first()
    return Manifest(leaves, below.unionByName(above).drop("n"), trees, n_trees, root[0] if root else None)


def runs_above(known: list[int], n: int) -> Iterator[tuple[int, list[int], list[int]]]:
    """Per level below the top of a tree with ``n`` leaves: level, known places, places that are missing.

    What is known on the next level are the parents; each needs all of its run.
    """
    level = 0
    while n > 1:
        parents = sorted({i // FAN for i in known})
        held = set(known)
        missing = [i for p in parents for i in range(p * FAN, min(p * FAN + FAN, n)) if i not in held]
        yield level, known, missing
        known, n, level = parents, -(-n // FAN), level + 1


def needed(tree: list[str], n: list[int], top_place: list[int], place: list[int], n_trees: int) -> Iterator[tuple[str, int, int]]:
    """Coordinates (tree, level, place) of the nodes that some leaves' proofs need from elsewhere."""
    own: dict[tuple[str, int], set[int]] = {}
    for t, size, p in zip(tree, n, place, strict=True):
        own.setdefault((t, size), set()).add(p)
    own[TOP, n_trees] = set(top_place)
    for (t, size), known in own.items():
        for level, _, missing in runs_above(sorted(known), size):
            yield from ((t, level, i) for i in missing)


class Paths:
    """Nodes of a tree around some known leaves, and the siblings on the way from each up."""

    def __init__(self, leaves: dict[int, str], n: int, fetched: dict[tuple[int, int], str]):
        """``leaves`` by place, ``fetched`` by (level, place)."""
        self.sides: list[dict[int, tuple[str, str]]] = []
        here = dict(leaves)
        for level, known, missing in runs_above(sorted(leaves), n):
            here |= {i: fetched[level, i] for i in missing}
            sides, above = {}, {}
            for p in sorted({i // FAN for i in known}):
                run = [here[i] for i in range(p * FAN, min(p * FAN + FAN, n))]
                above[p] = digest("".join(run))
                for k in range(len(run)):
                    if p * FAN + k in here:
                        sides[p * FAN + k] = "".join(run[:k]), "".join(run[k + 1 :])
            self.sides.append(sides)
            here, n = above, -(-n // FAN)
        self.root = next(iter(here.values()))
        self.proofs: dict[tuple[int, int], str] = {}

    def proof(self, place: int, level: int = 0) -> str:
        """Siblings from a node up, left to right on each level."""
        if level == len(self.sides):
            return ""
        known = self.proofs.get((level, place))
        if known is None:
            known = self.proofs[level, place] = "".join(self.sides[level][place]) + self.proof(place // FAN, level + 1)
        return known

    def folded(self, place: int, leaf: str) -> str:
        """The root that ``leaf`` gives in this place with its siblings."""
        for sides in self.sides:
            left, right = sides[place]
            leaf, place = digest(left + leaf + right), place // FAN
        return leaf


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


PROOF = "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string"


def prove(manifest: Manifest, which: Column | None = None, lists: bool = False) -> DataFrame:
    """One row per leaf: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``which`` picks leaves by the columns of ``manifest.leaves``; ``lists`` adds the siblings
    themselves as ``proof``, 64 characters each. ``folded_root`` is what the claimed leaf
    gives with the original siblings.
    """
    n_trees, root = manifest.n_trees, manifest.root
    leaves = manifest.leaves if which is None else manifest.leaves.filter(which)
    wanted = pa.schema([("part", pa.int64()), ("tree", pa.string()), ("level", pa.int32()), ("place", pa.int64())])
    schema = pa.schema([(c.split()[0], pa.int64() if " long" in c else pa.string()) for c in PROOF.split(", ")])
    if lists:
        schema = schema.append(pa.field("proof", pa.list_(pa.string())))

    def missing(key: tuple, rows: pa.Table) -> pa.Table:
        part = key[0].as_py()
        found = list(needed(*(rows.column(c).to_pylist() for c in ("tree", "n", "top_place", "place")), n_trees))
        columns = list(zip(*found, strict=True)) if found else [[], [], []]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip([[part] * len(found), *columns], wanted.types, strict=True)], schema=wanted)

    def expand(own: pa.Table, nodes: pa.Table) -> pa.Table:
        fetched: dict[str, dict[tuple[int, int], str]] = {}
        for tree, level, place, h in zip(*(nodes.column(c).to_pylist() for c in ("tree", "level", "place", "hash")), strict=True):
            fetched.setdefault(tree, {})[level, place] = h
        columns = [own.column(c).to_pylist() for c in ("tree", "n", "top_place", "place", "doc_id", "leaf", "claim")]
        by_tree: dict[str, tuple[int, int, dict[int, str]]] = {}
        for tree, n, top_place, place, _, leaf, _ in zip(*columns, strict=True):
            by_tree.setdefault(tree, (n, top_place, {}))[2][place] = leaf
        paths = {t: Paths(held, n, fetched.get(t, {})) for t, (n, _, held) in by_tree.items()}
        top = Paths({at: paths[t].root for t, (_, at, _) in by_tree.items()}, n_trees, fetched.get(TOP, {}))
        out = []
        for tree, _, top_place, place, doc, leaf, claim in zip(*columns, strict=True):
            own_paths = paths[tree]
            siblings = own_paths.proof(place) + top.proof(top_place)
            folded = top.folded(top_place, own_paths.folded(place, claim))
            listed = [[siblings[k : k + 64] for k in range(0, len(siblings), 64)]] if lists else []
            out.append((doc, leaf, own_paths.root, digest(siblings), folded, *listed))
        made = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)] if out else schema.empty_table().columns
        return pa.Table.from_arrays(made, schema=schema)

    union = leaves.groupBy("part").applyInArrow(missing, "part long, tree string, level int, place long")
    nodes = union.join(manifest.nodes, ["tree", "level", "place"])
    kept = leaves.select("part", "tree", "n", "top_place", "place", "doc_id", "leaf", "claim")
    ddl = PROOF + (", proof array<string>" if lists else "")
    proved = kept.groupBy("part").cogroup(nodes.groupBy("part")).applyInArrow(expand, ddl)
    return proved.withColumn("root", F.lit(root)).withColumn("verified", F.col("folded_root") == F.col("root"))
