"""Byte-level BPE: blocks against the library on whole texts, round trips, awkward tables."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from terrace.llm import byte_bpe, catalog
from tests.llm.conftest import awkward_rows, make

CODER = byte_bpe.coder(byte_bpe.ranks(), public_tokenizers.PATTERN)
LETTERS = ["a", "b", " ", "  ", "\n", "\t", "　", "\xa0", "\x1c", "1", "²", "'s", "é", "世", "!", "$$", "\x85", "😀", "don't", " \n "]


def whole(text):
    """Ids by the library, the text in one piece."""
    return np.array(CODER.split.encode_ordinary(text or ""), "<u4").tobytes()


@pytest.mark.parametrize("block", [1, 3, 17])
def test_blocks_give_the_ids_of_the_whole_text(monkeypatch, block):
    monkeypatch.setattr(byte_bpe, "BLOCK", block)
    monkeypatch.setattr(byte_bpe, "LONG_RUN", 2)
    monkeypatch.setattr(byte_bpe, "_long", re.compile(f"[{byte_bpe.SPACE}]{{2,}}"))
    r = random.Random(block)
    for _ in range(2000):
        text = "".join(r.choice(LETTERS) for _ in range(r.randrange(60)))
        assert CODER.ids(text) == whole(text), text
        assert "".join(part for _, part in byte_bpe.blocks(text)) == text


@pytest.mark.parametrize(
    "text", [" " * 1_000_000, "a" + "\n" * 1_000_000 + "b", "x " * 500_000, "世" * 300_000, "a" * 1_000_000, "\t" * 5000 + " x"]
)
def test_very_long_texts(text):
    ids = CODER.ids(text)
    assert CODER.decoded(ids) == text.encode()
    run = text.strip()
    if len(run) > 1 and "\n" not in run:
        assert ids == whole(text)


def test_a_long_run_is_one_match():
    """What the pattern makes of a run short enough for it, a longer one gives as well."""
    for before, after in (("", ""), ("a", ""), ("", "b"), ("a", "b"), ("a", " b"[1:])):
        for space in (" ", "\n", "\t", "　"):
            text = before + space * (byte_bpe.LONG_RUN + 3) + after
            assert CODER.ids(text) == whole(text)


def test_white_space_is_what_the_library_calls_so():
    """All characters but surrogates, split by the library itself."""
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    ranks = {bytes([b]): b for b in range(256)}
    space = tiktoken.Encoding("space", pat_str=r"\s", mergeable_ranks=ranks, special_tokens={})
    assert space.decode(space.encode_ordinary(every)) == "".join(re.findall(f"[{byte_bpe.SPACE}]", every))


def test_awkward_rows(spark, awkward):
    encoded = byte_bpe.encode(awkward)
    decoded = byte_bpe.decode(encoded, keep=("doc_id", "n_tokens", "ids"))
    got = sorted((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.data)) for r in decoded.collect())
    want = sorted((i, len(whole(t)) // 4, whole(t), (t or "").encode()) for i, t, _ in awkward_rows())
    assert got == want


def test_null_ids_empty_tables_and_bytes_that_are_no_text(spark, none):
    assert byte_bpe.encode(none).isEmpty() and byte_bpe.decode(byte_bpe.encode(none)).isEmpty()
    rows = byte_bpe.encode(make(spark, [(None, "a b", "x")])).collect()
    assert [(r.doc_id, bytes(r.ids)) for r in rows] == [(None, whole("a b"))]
    half = whole("世")[:4]
    ids = spark.createDataFrame([(1, bytearray(half)), (2, None), (3, bytearray())], "doc_id long, ids binary")
    got = {r.doc_id: r.data for r in byte_bpe.decode(ids).collect()}
    assert got == {1: bytearray("世".encode()[: len(CODER.decoded(half))]), 2: None, 3: bytearray()}


def test_other_ranks_and_pattern(spark):
    """The rank file and the pattern are parameters."""
    path = byte_bpe.ranks("byte_bpe_multi_50k.tiktoken")
    other = byte_bpe.coder(path, r"\S+|\s+")
    docs = make(spark, [(1, "Straße, été  ok", "x")])
    row = byte_bpe.encode(docs, path, r"\S+|\s+").first()
    assert bytes(row.ids) == np.array(other.split.encode_ordinary("Straße, été  ok"), "<u4").tobytes()
    back = byte_bpe.decode(byte_bpe.encode(docs, path, r"\S+|\s+"), path, r"\S+|\s+").first()
    assert bytes(back.data).decode() == "Straße, été  ok"


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    rows = catalog.op13_byte_bpe(spark, folder).collect()
    assert len(rows) == len(texts)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for r in rows:
        ids = whole(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids) // 4, sha(ids), sha((texts[r.doc_id] or "").encode()))


def test_one_pass_without_a_shuffle(spark, awkward):
    encoded = byte_bpe.encode(awkward).withColumn("h", F.sha2("ids", 256))
    assert "Exchange" not in byte_bpe.decode(encoded, keep=("doc_id", "h"))._jdf.queryExecution().executedPlan().toString()
