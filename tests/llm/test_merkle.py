"""Manifest and multiproofs against plain trees."""

import random

import pytest
from pyspark.sql import functions as F

from terrace.llm import catalog, merkle
from tests.llm import brute
from tests.llm.conftest import make

COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def shown(text):
    return None if text is None else text.replace("\n", "")


def proved(docs, claim=None, **options):
    found = merkle.prove(merkle.build(docs, claim), **options)
    return sorted((tuple(r) for r in found.select(*COLUMNS).collect()), key=str)


def expected(rows, claim=lambda i, t: t):
    full = [(i, s, "xx", -1, t, claim(i, t)) for i, t, s in rows]
    return sorted(brute.merkle(full), key=str)


def test_awkward_rows_with_tampered_texts(spark, awkward):
    from tests.llm.conftest import awkward_rows

    rows = awkward_rows()
    got = proved(awkward, F.when(F.col("doc_id") % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text")))
    assert got == expected(rows, lambda i, t: shown(t) if i % 2 == 0 else t)
    assert {r[-1] for r in got} == {True, False}


def test_empty_table(none):
    manifest = merkle.build(none)
    assert manifest.root is None and manifest.nodes.isEmpty()
    found = merkle.prove(manifest)
    assert found.isEmpty() and set(COLUMNS) <= set(found.columns)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28])
def test_one_source_of_every_awkward_size(spark, n):
    rows = [(k * 7, f"text {k}\n", None) for k in range(n)]
    assert proved(make(spark, rows), F.upper("text")) == expected(rows, lambda i, t: t.upper())


def test_many_rounds_ranges_and_partitions(spark, monkeypatch):
    """Small rounds and partitions: a hot source, many sources of one row, null ids, repeated rows."""
    monkeypatch.setattr(merkle, "ROUND", 2)
    monkeypatch.setattr(merkle, "RUN", 7)
    r = random.Random(5)
    rows = [(k, f"t{k}", "hot") for k in range(90)] + [(1000 + k, "t", f"é{k}") for k in range(40)]
    rows += [(None, "x", "hot"), (None, None, "hot"), (3, "t3", "hot"), (3, "t3", "hot"), (5, "other", "hot"), (7, "n", "")]
    r.shuffle(rows)
    assert proved(make(spark, rows)) == expected(rows)


def test_proofs_of_a_few_leaves_fetch_what_is_missing(spark, monkeypatch):
    monkeypatch.setattr(merkle, "RUN", 40)
    rows = [(k, f"t{k}", "ab"[k % 7 == 0]) for k in range(200)]
    manifest = merkle.build(make(spark, rows))
    few = merkle.prove(manifest, F.col("doc_id").isin(3, 4, 77, 199), lists=True).collect()
    whole = {r[0]: r for r in brute.merkle([(i, s, "xx", -1, t, t) for i, t, s in rows])}
    assert sorted(r.doc_id for r in few) == [3, 4, 77, 199]
    for r in few:
        assert tuple(r[c] for c in COLUMNS) == whole[r.doc_id]
        assert brute.H(*r.proof) == r.proof_sha256


def test_what_a_partition_needs_is_minimal():
    """No node is fetched that the partition's own leaves give, and none twice."""
    n, leaves = 81, [0, 1, 2, 3, 40]
    found = list(merkle.needed(["="] * 5, [n] * 5, [0] * 5, leaves, 1))
    assert len(found) == len(set(found))
    given = set()
    for level in range(5):
        given |= {(level, i // 3**level) for i in leaves}
    assert not {(level, p) for _, level, p in found} & given
    # Level 0: 4, 5 beside 3 and 39, 41 beside 40; the run of 0, 1, 2 needs none.
    assert {p for _, level, p in found if level == 0} == {4, 5, 39, 41}


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    import zlib

    rows = [
        (d.doc_id, d.source, d.lang, d.n_chars, d.text, shown(d.text) if zlib.crc32(str(d.doc_id).encode()) % 2 == 0 else d.text)
        for d in docs
    ]
    got = catalog.op11_merkle_manifest(spark, folder).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(brute.merkle(rows), key=str)
