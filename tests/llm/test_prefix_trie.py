"""Nodes of the trie against every prefix counted plainly."""

import random
import zlib

import pytest

from terrace.llm import catalog, prefix_trie
from tests.llm import brute

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
SCHEMA = "conv_id long, turn long, role string, text string, path binary, layer int, cut int, weight string, head string"


def make(spark, rows):
    """Conversations with other columns of clashing names."""
    return spark.createDataFrame([(*r, bytearray(b"p"), 1, 2, "w", "h") for r in rows], SCHEMA)


def nodes(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def same(spark, rows):
    got = nodes(prefix_trie.prefix_trie(make(spark, rows)))
    assert got == sorted(brute.conversation_trie(rows), key=str)
    return got


def some(r, n, words, longest, first=0):
    """Conversations that often start alike."""
    rows = []
    for c in range(first, first + n):
        text = [f"é{r.randrange(words)}" for _ in range(r.randrange(1, longest))]
        rows += [(c, k, "user" if k % 2 else "assistant", t) for k, t in enumerate(text)]
    r.shuffle(rows)
    return rows


@pytest.fixture
def small(monkeypatch):
    """Few turns in a layer, few entries in a container, few ids in a row."""
    monkeypatch.setattr(prefix_trie, "LAYER", 3)
    monkeypatch.setattr(prefix_trie, "CAP", 4)
    monkeypatch.setattr(prefix_trie, "PACK", 2)


def test_nulls_ties_repeats_gaps_and_empty_texts(spark):
    rows = [
        (0, 0, "user", "hello"), (0, 1, "assistant", None), (0, None, "system", "first"), (0, 1, None, "tie"),
        (1, 0, "user", "hello"), (1, 5, "user", "a"), (1, 5, "user", "a"), (2, 0, None, None), (2, 1, "", ""),
        (7, 3, "user", "hello"), (7, 9, "user", ""), (None, 0, "user", "no conversation"), (10, 0, "x", "é" * 5000),
        (-7, 0, "user", "minus"), (-5, 0, "user", "base"), (-5, 1, "user", "two"), (23, 0, "user", "alone"),
    ]
    got = same(spark, rows)
    # 23 has no conversation 20 to start from, and skips its only turn: no turns, it ends at the root.
    assert zlib.crc32(b"23") % 9 > 0
    root = next(r for r in got if r[1] == 0)
    assert root[2] is None and root[-1] != brute.hashlib.sha256(b"").hexdigest()


def test_empty_table(spark):
    assert nodes(prefix_trie.prefix_trie(make(spark, []))) == []


def test_one_layer_of_containers(spark):
    same(spark, some(random.Random(1), 60, 3, 9))


def test_bursts_layers_and_packed_ids(spark, small):
    r = random.Random(2)
    rows = some(r, 40, 2, 12) + [(100 + c, k, "user", f"{k % 2}") for c in range(25) for k in range(10)]
    same(spark, rows)


def test_a_long_conversation_and_its_copies(spark, small):
    """A third of all turns in one conversation; others share parts of it across many layers."""
    long = [(5, k, "user", f"t{k % 3}") for k in range(100)]
    rows = long + [(c, k, "user", t) for c in (6, 7, 8, 9, 15) for _, k, _, t in long[: 10 * c]]
    same(spark, rows + some(random.Random(3), 20, 2, 6, first=30))


def test_prefixes_of_each_other(spark, small):
    same(spark, [(5 * c, k, "user", "same") for c in range(14) for k in range(c + 1)])


def test_containers_stay_small(spark, monkeypatch):
    """No task's container holds more than the limit, though all conversations start alike."""
    monkeypatch.setattr(prefix_trie, "CAP", 5)
    sizes = []
    whole = prefix_trie.burst

    def watched(entries):
        cut, rounds = whole(entries)
        inside = cut.filter(prefix_trie.n_turns() >= cut["cut"])
        sizes.append(inside.groupBy(*prefix_trie.SHARD, prefix_trie.upto(cut["cut"])).count().agg({"count": "max"}).first()[0])
        return cut, rounds

    monkeypatch.setattr(prefix_trie, "burst", watched)
    rows = [(5 * c, k, "user", "system prompt" if k < 3 else f"{c % (k * 7)}") for c in range(60) for k in range(6)]
    same(spark, rows)
    assert sizes and max(sizes) <= 5


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert nodes(catalog.op12_prefix_trie(spark, folder)) == sorted(brute.conversation_trie(rows), key=str)
