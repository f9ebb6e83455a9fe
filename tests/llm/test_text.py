"""Mixing, token counts, quality, archives, packing and license scans."""

import base64
import collections
import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from terrace.llm import license_scan, mixing, packing, quality, token_counts, tokens, warc
from tests.llm import brute
from tests.llm.conftest import awkward_rows, make

ROWS = awkward_rows()
TABLE = tokens.table(token_counts.vocabulary())


# --- mixing -----------------------------------------------------------------


def test_mix_meets_its_targets(awkward):
    rows = mixing.mix(awkward).collect()
    assert len(rows) == len(ROWS)
    sizes, largest = collections.Counter(), collections.Counter()
    for i, t, s in ROWS:
        sizes[s] += len(brute.words(t))
        largest[s] = max(largest[s], len(brute.words(t)))
    expected = brute.shares(sizes)
    taken = collections.Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and brute.close(r.target, expected[r.source])
        assert 0 <= r.taken <= 3 * r["size"] and r.taken == r.copies * r["size"]
        taken[r.source] += r.taken
    for s, t in expected.items():
        assert abs(taken[s] - t) <= largest[s]
    again = {(r.doc_id, r.taken) for r in mixing.mix(awkward.repartition(3)).collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}


def test_mixed_documents_keep_their_columns(awkward):
    out = mixing.mixed(awkward)
    assert out.columns == awkward.columns
    copies = {}
    for r in mixing.mix(awkward).collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + r.copies
    assert collections.Counter(r.doc_id for r in out.collect()) == {i: n for i, n in copies.items() if n}


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=9))
def test_targets_are_the_shares(spark, sizes):
    rows = [(f"s{k}" if k else None, n) for k, n in enumerate(sizes)]
    got = mixing.targets(spark.createDataFrame(rows, "source string, source_size long")).collect()
    expected = brute.shares(dict(rows))
    assert all(brute.close(r.target, expected[r.source]) for r in got) and len(got) == len(rows)


# --- tokens -----------------------------------------------------------------


def test_token_counts_are_the_librarys(awkward):
    rows = token_counts.token_counts(awkward, limit=100).collect()
    texts = {i: t or "" for i, t, _ in ROWS}
    assert len(rows) == len(ROWS)
    for r in rows:
        n = len(TABLE.tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 100)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=6), st.sampled_from(["'s", "'LL", "<|endoftext|>", " ", "don't", "é", "é", "Σ", "½"])), max_size=12))
def test_ids_are_the_librarys(parts):
    text = "".join(parts)
    assert np.frombuffer(TABLE.ids(text), "<u4").tolist() == TABLE.library_ids(text)


def test_every_character_is_split_as_the_library_does():
    for code in [*range(1, 0x3000), *range(0x1F600, 0x1F610)]:
        c = chr(code)
        for text in (c, f"a{c}b", f"it's{c}12{c} {c}", f"A{c}{c}_{c}."):
            assert TABLE.count(text) == len(TABLE.library_ids(text)), hex(code)


def test_proved_strings_encode_alone():
    assert len(TABLE.proved) > 20_000
    for piece in random.Random(1).sample(sorted(TABLE.proved), 500):
        assert TABLE.library_ids(piece) == [TABLE.proved[piece]]


def test_a_piece_is_merged_once_whatever_words_it_is_in(monkeypatch):
    text = "qzxvbk qzxvbk, (qzxvbk) qzxvbk-wjfgpq wjfgpq; wjfgpq-qzxvbk."
    fresh = tokens.TokenTable(token_counts.vocabulary())
    merged, merge = [], fresh.merge
    monkeypatch.setattr(fresh, "merge", lambda letters: merged.append(letters) or merge(letters))
    assert np.frombuffer(fresh.ids(text), "<u4").tolist() == fresh.library_ids(text)
    assert merged and len(merged) == len(set(merged))
    merged.clear()
    assert fresh.count(text) == len(fresh.library_ids(text))
    assert merged and len(merged) == len(set(merged))


def test_ids_outlive_forgetting_in_the_middle_of_a_word(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 2)
    fresh = tokens.TokenTable(token_counts.vocabulary())
    for text in ("qzx-vbk.(wjf) a1b2 vbk-qzx", "x", "qzx,vbk,qzx,wjf", "12:34:56 it's"):
        assert np.frombuffer(fresh.ids(text), "<u4").tolist() == fresh.library_ids(text)
        assert fresh.count(text) == len(fresh.library_ids(text))


# --- packing ----------------------------------------------------------------


def check_packing(rows, texts, length):
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for doc, text in texts.items():
        ids = np.array([*TABLE.library_ids(text or ""), 2], "<u4")
        times = sum(1 for r in by_doc[doc] if r.start == 0)
        assert sum(r.length for r in by_doc[doc]) == times * len(ids)
        for r in by_doc[doc]:
            assert r.doc_tokens == len(ids) and 0 < r.length <= length
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    for parts in by_sequence.values():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert end <= length
    return by_sequence


def test_packing_round_trip(awkward):
    rows = packing.pack(awkward, length=256, group=16).collect()
    sequences = check_packing(rows, {i: t for i, t, _ in ROWS}, 256)
    assert sum(1 for r in rows if r.start == 0) == len(ROWS)
    padding = 1 - sum(r.length for r in rows) / (256 * len(sequences))
    assert padding < 0.1


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_first_fit_decreasing(lengths):
    bins, offsets = packing.first_fit_decreasing(np.array(lengths, np.int64), 50)
    room, expected = [], {}
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        at = next((b for b, free in enumerate(room) if free >= lengths[k]), len(room))
        if at == len(room):
            room.append(50)
        expected[k] = (at, 50 - room[at])
        room[at] -= lengths[k]
    assert [(int(b), int(o)) for b, o in zip(bins, offsets, strict=True)] == [expected[k] for k in range(len(lengths))]


# --- quality ----------------------------------------------------------------


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "é", " ", "\n", "#", "c d e f", "a b a b a b", " \x0b", "\x85", "|"]), max_size=40))
def test_measures(parts):
    text = "".join(parts)
    assert quality.measures(text.encode()) == brute.measures(text)


def test_quality_on_awkward_rows(awkward, labels):
    model = quality.fit(awkward, labels)
    rows = quality.score(awkward, model).collect()
    assert len(rows) == len(ROWS)
    texts = {i: t for i, t, _ in ROWS}
    for r in rows:
        m = brute.measures(texts[r.doc_id])
        assert tuple(r[name] for name in quality.MEASURES) == m
        assert r.base_failed == (m[0] < 10 or 100 * m[4] > 20 * m[0])
        data = (texts[r.doc_id] or "").encode()
        grams = [quality.gram_buckets([data[k : k + 4]])[0][0] for k in range(len(data) - 3)]
        score = int(model.weights[grams].sum()) // max(1, len(grams)) if grams else 0
        assert r.score == score and r.kept == (not r.base_failed and score >= model.threshold)
    kept = quality.keep(awkward, model)
    assert kept.columns == awkward.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in rows if r.kept)


def test_counts_cover_all_documents(awkward):
    raw, good = quality.count_grams(awkward.repartition(5), {6, 12})
    data = [(i, (t or "").encode()) for i, t, _ in ROWS]
    assert raw.sum() == sum(max(0, len(b) - 3) for _, b in data)
    assert good.sum() == sum(max(0, len(b) - 3) for i, b in data if i in (6, 12))


def test_junk_goes_and_prose_stays(spark):
    r = random.Random(4)
    rows, known = [], []
    for k in range(400):
        words = ["".join(r.choice(["an", "er", "th", "on", "ing"]) for _ in range(3)) for _ in range(40)]
        junk = k % 4 == 0
        rows.append((k, " ".join(f"{w.upper()}!!" if junk else w for w in words), "s"))
        known.append((k, int(not junk), 0))
    held_out = known[:200]
    labels = spark.createDataFrame(held_out, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.kept for r in quality.rate_documents(make(spark, rows), labels).collect()}
    assert all(got[k] == bool(q) for k, q, _ in known)


def test_without_labels_only_the_base_rules_reject(spark, awkward, labels):
    none = labels.limit(0)
    rows = quality.rate_documents(awkward, none).collect()
    assert all(r.kept != r.base_failed and r.score == 0 for r in rows)


def test_best_cut():
    assert quality.best_cut([1, 2, 8, 9], [False, False, True, True]) == 5
    lowest = quality.best_cut([1, 2], [True, True])
    assert lowest == quality.best_cut([], []) == quality.best_cut([3], [False]) and lowest < -(10**15)


# --- archives ---------------------------------------------------------------


def pages_of(spark, rows):
    schema = "page_id long, url string, html string, sha1 string, shard int, payload string"
    return spark.createDataFrame([(*r, "s", 1, "p") for r in rows], schema)


def test_warc_round_trip(spark):
    r = random.Random(9)
    rows = [(k, f"http://h/{k}", f"<p>{r.random()}é</p>" * r.randrange(1, 40)) for k in range(1000, 1600)]
    rows += [(k, "http://same/", "<b>same</b>") for k in range(300)]
    rows += [(700, None, None), (701, "http://x/\r\nWARC-Type: fake y", ""), (1, "u", "\r\n\r\nWARC/1.1\r\n"), (1, "u", "again")]
    rows += [(None, "u", "<b>same</b>"), (None, "u", "nameless")]
    pages = pages_of(spark, rows)
    folders = [warc.new_folder(spark) for _ in range(2)]
    manifests = [
        {r.final: (r.sha256, r.records, r.bytes) for r in warc.write_warc(p, f, shard_bytes=40_000, file_bytes=9_000).collect()}
        for p, f in zip((pages, pages.repartition(7)), folders, strict=True)
    ]
    assert manifests[0] == manifests[1] and len(manifests[0]) > 10
    assert sum(n for _, n, _ in manifests[0].values()) == len(rows)
    got = warc.read_warc(spark, folders[0]).collect()
    largest = {}
    for i, _, h in rows:
        if i is not None:
            largest[h or ""] = max(largest.get(h or "", i), i)
    expected = collections.Counter()
    for i, _, h in rows:
        data = (h or "").encode()
        to = largest.get(h or "")
        to = None if to == i else to
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        expected[i, len(data), digest, "response" if to is None else "revisit", to] += 1
    assert collections.Counter(tuple(r) for r in got) == expected


def test_warc_files_are_plain_gzip_members_without_leftovers(spark):
    import gzip
    import os

    folder = warc.new_folder(spark)
    warc.write_warc(pages_of(spark, [(2, "u", "b"), (1, "u", "a")]), folder)
    names = sorted(os.listdir(folder.removeprefix("file://")))
    assert names == ["manifest", "pages-000000-00000.warc.gz"]
    data = gzip.open(f"{folder.removeprefix('file://')}/{names[1]}").read()
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and data.count(b"WARC/1.1") == 2
    assert data.index(b"WARC-Page-ID: 1\r\n") < data.index(b"WARC-Page-ID: 2\r\n")


def test_warc_of_no_pages(spark):
    folder = warc.new_folder(spark)
    assert warc.write_warc(pages_of(spark, []), folder).count() == 0
    assert warc.read_warc(spark, folder).count() == 0


def test_payloads_below_the_least_size_are_all_responses(spark):
    folder = warc.new_folder(spark)
    warc.write_warc(pages_of(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]), folder, least=3)
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in warc.read_warc(spark, folder).collect()}
    assert kinds == {1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}


# --- licenses ---------------------------------------------------------------


def test_notices_are_found_wherever_they_are(spark):
    r = random.Random(6)
    filler = lambda n: " ".join(f"the of license {r.randrange(999)} software" for _ in range(n))
    mit = license_scan.TEMPLATES["MIT-text"]
    changed = mit.split()
    changed[10:14] = ["these", "words", "differ"]
    rows = [
        (1, f"{filler(900)} {mit.upper()} {filler(50)}", "s"),
        (2, f"{mit}\n\n{' '.join(changed)}", "s"),
        (3, "Released under the MIT License.", "s"),
        (4, " ".join(mit.split()[:50]), "s"),
        (5, None, "s"),
        (6, "", "s"),
        (7, filler(400), "s"),
        (3, "Released under the MIT License.", "s"),
    ]
    got = sorted((r.doc_id, r.license, r.n_aligned) for r in license_scan.license_scan(make(spark, rows)).collect())
    n = len(mit.split())
    assert got == [(1, "MIT-text", n), (2, "MIT-text", n - 4), (2, "MIT-text", n), (3, "MIT", 5), (3, "MIT", 5)]


def licenses(text):
    found = license_scan.Scanner(license_scan.TEMPLATES, license_scan.COVERAGE, license_scan.NAMES).scan(text.encode())
    return {m[0] for m in found}


def test_near_misses_are_not_the_license():
    for text in (
        "Released under the BSD License.",
        "The figures were released under the license of the house.",
        "Licensed under CC BY 4.0.",
        "Licensed under CC BY-SA 4.0",
        "Licensed under the Apache License, Version 1.1",
        "This work is licensed under the GNU General Public License, version 2.",
        "This work is licensed under the GNU Lesser General Public License, version 3.",
    ):
        assert not licenses(text) & {"MIT", "CC-BY-NC-4.0", "Apache-2.0", "GPL-3.0"}, text
    assert "MIT" in licenses("This project is licensed under the MIT License")
    assert "GPL-3.0" in licenses("# This work is licensed under the GNU General\n# Public License, version 3")


def test_spread_notices_are_found():
    assert "MIT" in licenses("Released under the terms of the well-known and very permissive MIT License")
    mit = license_scan.TEMPLATES["MIT-text"]
    spread = " ".join(f"{w} <br/> x{k}" for k, w in enumerate(mit.split()))
    filler = "the of license software to " * 200
    assert licenses(spread) == {"MIT-text"}
    assert licenses(f"{filler} {spread} {filler} {mit}") == {"MIT-text"}
    assert "MIT-text" not in licenses(filler)


def test_common_licenses_are_known():
    for name, text in license_scan.TEMPLATES.items():
        found = licenses(f"some words {text} and more")
        assert name in found and {n.split("-")[0] for n in found} == {name.split("-")[0]}, (name, found)
    for text, name in (
        ("Released under the BSD License.", "BSD"),
        ("Licensed under CC BY-SA 4.0", "CC-BY-SA-4.0"),
        ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
        ("This work is licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0"),
        ("// SPDX-License-Identifier: MPL-2.0\n", "MPL-2.0-tag"),
    ):
        assert licenses(text) == {name}


@settings(max_examples=200, deadline=None)
@given(st.permutations(range(9)))
def test_longest_increasing(values):
    chain = license_scan.longest_increasing(values)
    picked = [values[k] for k in chain]
    best = [1] * len(values)
    for k in range(len(values)):
        best[k] = 1 + max((best[j] for j in range(k) if values[j] < values[k]), default=0)
    assert picked == sorted(picked) and len(picked) == max(best) and chain == sorted(chain)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=30), st.lists(st.integers(0, 9), max_size=15))
def test_alignments_are_common_subsequences(text, template):
    pairs = license_scan.align(text, template)
    assert all(text[a] == template[c] for a, c in pairs)
    assert all(a < b and c < d for (a, c), (b, d) in zip(pairs, pairs[1:], strict=False))
    assert license_scan.align(template, template) == [(k, k) for k in range(len(template))]


def test_an_empty_template_is_an_error():
    with pytest.raises(ValueError, match="no words"):
        license_scan.Scanner({"x": " . "}, 0.75)


# --- empty tables -----------------------------------------------------------


@pytest.mark.parametrize(
    "run",
    [
        mixing.mix,
        mixing.mixed,
        token_counts.token_counts,
        packing.pack,
        license_scan.license_scan,
    ],
)
def test_an_empty_table_gives_no_rows(none, run):
    assert run(none).count() == 0


def test_quality_of_an_empty_table(none, labels):
    assert quality.rate_documents(none, labels).count() == 0


def test_very_many_notices_in_one_text():
    """Matches are compared with their neighbours alone."""
    notice = "Licensed under the Apache License, Version 2.0 (the License). " + "own words here " * 3
    scanner = license_scan.Scanner(license_scan.TEMPLATES, license_scan.COVERAGE, license_scan.NAMES)
    few = len(scanner.scan((notice * 20).encode()))
    found = [(f"t{k % 3}", k * 7, k * 7 + 5, 6, 6 + k % 2 * 30) for k in range(50_000)]
    began = time.time()
    assert few > 0 and len(license_scan.Scanner.fullest(found)) == 50_000
    assert time.time() - began < 10


def test_fullest_against_all_pairs():
    r = random.Random(3)

    def plain(found):
        def same(m, o):
            if m[4] < license_scan.LONG or o[4] < license_scan.LONG:
                return m[2] == o[2] and m[4] < license_scan.LONG and o[4] < license_scan.LONG
            return 2 * (min(m[2], o[2]) - max(m[1], o[1]) + 1) > m[2] - m[1] + 1

        kept = []
        for m in sorted(found, key=lambda m: (-m[3], m[2] - m[1])):
            if not any(same(m, o) for o in kept):
                kept.append(m)
        return [m for m in found if m in kept]

    for _ in range(300):
        found = []
        for _ in range(r.randrange(60)):
            start = r.randrange(600)
            found.append((r.choice("ab"), start, start + r.randrange(1, 400), r.randrange(1, 9), r.choice([5, 19, 20, 90])))
        assert license_scan.Scanner.fullest(found) == plain(found)


def test_null_ids_stay_null_and_others_exact(spark):
    """An id that no floating-point number holds is the same in every result, beside null ids."""
    large = 2**60 + 1
    rows = [(None, "Released under the MIT License.", "a"), (None, None, "a"), (large, "other words " * 30, "b"), (3, "x y z " * 20, None)]
    docs = make(spark, rows)
    labels = spark.createDataFrame([(large, 1, 0), (3, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    expected = sorted((i for i, _, _ in rows), key=str)
    for of in (mixing.mix, token_counts.token_counts, packing.pack, lambda d: quality.rate_documents(d, labels)):
        assert sorted((r.doc_id for r in of(docs).collect()), key=str) == expected
    assert [r.doc_id for r in license_scan.license_scan(docs).collect()] == [None]
