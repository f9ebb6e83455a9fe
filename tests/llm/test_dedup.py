"""Exact copies, shingle links, repeated bytes and lines, against brute force and on awkward rows."""

import hashlib
import os
import random
import time
import re
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from terrace import session
from terrace.llm import common, exact_dedup, line_dedup, shingle_join, suffix_dedup
from tests.llm import brute
from tests.llm.conftest import awkward_rows, make

ROWS = [(i, t) for i, t, _ in awkward_rows()]


def by_id(df, *columns):
    return {r[0]: tuple(r)[1:] for r in df.select("doc_id", *columns).collect()}


# --- exact ------------------------------------------------------------------


def test_exact_dedup(spark, awkward):
    got = exact_dedup.exact_dedup(awkward, exact_dedup.new_index(spark, 4)).collect()
    assert len(got) == len(ROWS)
    body = {i: re.sub(brute.SPACE, " ", t or "") for i, t in ROWS}
    for r in got:
        same = [i for i, t in ROWS if re.sub(brute.SPACE, " ", t or "") == body[r.doc_id]]
        assert (r.keep_id, r.group_size) == (min(same), len(same))
        assert r.text_sha256 == hashlib.sha256(body[r.doc_id].encode()).hexdigest()
    assert sum(r.kept for r in got) == len(set(body.values()))


def test_index_outlives_its_session_and_drops_what_it_knows(spark):
    first = make(spark, [(1, "a  b", "s"), (2, "c", "s")])
    second = make(spark, [(3, "a b", "s"), (4, "d", "s"), (5, "d", "s")])
    index = exact_dedup.new_index(spark, 4)
    exact_dedup.keep_first(first, index)
    again = exact_dedup.DigestIndex(spark, index.path, 4)
    assert [r.doc_id for r in exact_dedup.keep_first(second, again).collect()] == [4]
    assert again.rows().count() == 3
    known = exact_dedup.exact_dedup(second, again)
    assert {(r.doc_id, r.keep_id, r.kept) for r in known.collect()} == {(3, 1, False), (4, 4, False), (5, 4, False)}


def test_a_repeated_row_stays_once(spark):
    docs = make(spark, [(1, "a", "s"), (1, "a", "s"), (None, "b", "s"), (None, "b", "s"), (2, "b", "s")])
    kept = exact_dedup.keep_first(docs, exact_dedup.new_index(spark, 4))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert kept.columns == docs.columns
    rows = exact_dedup.exact_dedup(docs, exact_dedup.new_index(spark, 4)).collect()
    assert sorted(r.kept for r in rows) == [False, False, False, True, True]


# --- shingles ---------------------------------------------------------------


def test_shingle_components(awkward):
    got = shingle_join.shingle_components(awkward).collect()
    assert len(got) == len(ROWS)
    expected = brute.components(ROWS)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected
    assert len({c for _, c in expected.values()}) < len(ROWS) - 30


def test_links_across_chains_and_stragglers(spark):
    """Near copies of each other that link only through others, and ones just outside."""
    r = random.Random(3)
    rows, base = [], [f"w{k}" for k in range(100)]
    for k in range(60):
        text = list(base)
        for _ in range(k // 12):
            text[r.randrange(100)] = f"x{r.random()}"
        rows.append((k * 7 % 61, " ".join(text), "s"))
        if k % 20 == 19:
            base = text
    docs = make(spark, rows)
    expected = brute.components([(i, t) for i, t, _ in rows])
    assert by_id(shingle_join.shingle_components(docs), "n_shingles", "component_id") == expected
    kept = {r.doc_id for r in shingle_join.one_of_each(docs).collect()}
    assert kept == {c for _, c in expected.values()}


def test_rows_without_an_id_stay(spark):
    docs = make(spark, [(None, "a b c d e f", "s"), (1, "a b c d e f", "s"), (None, None, "s")])
    rows = shingle_join.shingle_components(docs).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in rows) == [(0, 0), (0, 0), (1, 1)]
    assert shingle_join.one_of_each(docs).count() == 3


def test_connected_names_the_smallest(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40, 0, -1)] + [(100, 90), (100, 95)], "a long, b long")
    assert {r.id: r.component for r in common.connected(edges).collect()} == {
        **dict.fromkeys(range(1, 42), 1),
        **dict.fromkeys((90, 95, 100), 90),
    }


# --- bytes ------------------------------------------------------------------


def test_repeated_bytes(awkward):
    got = suffix_dedup.remove_repeats(awkward).collect()
    assert len(got) == len(ROWS)
    expected = brute.removed(ROWS)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == expected[r.doc_id], r.doc_id
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.spans) == r.n_spans


def test_repeated_bytes_at_every_edge(spark, monkeypatch):
    """Shared parts just below and above the length, at both ends of texts, with few letters and NUL bytes."""
    r = random.Random(11)
    part = "".join(r.choice("ab") for _ in range(400))
    rows = []
    for k in range(120):
        size = r.choice([30, 49, 50, 51, 60, 80, 120])
        at = r.randrange(300)
        own = ["".join(r.choice("ab\0") for _ in range(r.choice([0, 0, 1, 30, 70]))) for _ in range(2)]
        rows.append((k * 37 % 127, own[0] + part[at : at + size] + own[1], "s"))
    got = suffix_dedup.remove_repeats(make(spark, rows))
    assert by_id(got, "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.removed([(i, t) for i, t, _ in rows])


def test_a_hot_gram_splits_by_its_surroundings(spark, monkeypatch):
    """A phrase of 20 to 49 bytes in all documents: no group of one task holds more than a few of its edges."""
    r = random.Random(13)
    phrase = "licensed under the terms that all of them hold"
    sides = ["".join(r.choice("abc ") for _ in range(60)) for _ in range(6)]
    own = lambda: "".join(r.choice("defg") for _ in range(r.choice([0, 20, 60])))
    rows = [(k * 37 % 127, own() + r.choice(sides)[r.randrange(60) :] + phrase + r.choice(["", own(), *sides]), "s") for k in range(120)]
    sizes = []
    whole = suffix_dedup.refine_edges

    def watched(around):
        sizes.append(around.groupBy("part").count().agg({"count": "max"}).first()[0])
        return whole(around)

    monkeypatch.setattr(suffix_dedup, "HOT_EDGES", 20)
    monkeypatch.setattr(suffix_dedup, "refine_edges", watched)
    got = suffix_dedup.remove_repeats(make(spark, rows))
    assert by_id(got, "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.removed([(i, t) for i, t, _ in rows])
    assert sizes and sizes[0] <= 60  # the hot gram has 97 edges


@pytest.mark.parametrize("together", [20, 1000])
def test_strings_of_a_hot_gram_are_rows_only_where_a_task_cannot_hold_them(spark, monkeypatch, together):
    r = random.Random(17)
    phrase = "licensed under the terms that all of them hold"
    sides = ["".join(r.choice("abc ") for _ in range(60)) for _ in range(6)]
    own = lambda: "".join(r.choice("defg") for _ in range(r.choice([0, 10, 20, 60])))
    rows = [(k * 37 % 127, r.choice(sides)[r.randrange(61) :] + phrase + r.choice(["", own(), *sides]) + own(), "s") for k in range(120)]
    split, whole = [], suffix_dedup.hot_starts
    monkeypatch.setattr(suffix_dedup, "HOT_EDGES", 20)
    monkeypatch.setattr(suffix_dedup, "edges_per_task", lambda around: together)
    monkeypatch.setattr(suffix_dedup, "hot_starts", lambda around: split.append(around) or whole(around))
    got = suffix_dedup.remove_repeats(make(spark, rows))
    assert by_id(got, "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.removed([(i, t) for i, t, _ in rows])
    assert bool(split) == (together == 20)


def test_what_steps_shuffled_and_stored_is_deleted(spark, monkeypatch):
    """Disk holds what a step needs, not what all steps before left."""
    r = random.Random(19)
    part = "".join(r.choice("abcdefgh") for _ in range(20_000))
    docs = make(spark, [(k, "".join(r.choice("abcdefgh") for _ in range(9_000)) + part[k * 300 :], "s") for k in range(40)]).repartition(4)
    docs = docs.localCheckpoint()
    files = lambda: list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n"))
    shuffled = lambda: {f for f in files() if "/shuffle_" in f and f.endswith(".data")}
    work = Path(urlparse(session.work_root(spark)).path)
    made, new = [], session.new_work_dir
    monkeypatch.setattr(session, "new_work_dir", lambda spark, label: made.append(new(spark, label)) or made[-1])
    at_first = shuffled()
    got = suffix_dedup.remove_repeats(docs)
    assert sum(os.path.getsize(f) for f in shuffled() - at_first if os.path.exists(f)) < 10_000
    left = [path for path in made if (work / path.rsplit("/", 1)[-1]).exists()]
    assert len(made) == 7 and [path.rsplit("/", 1)[-1].split("-")[0] for path in left] == ["repeats"]
    assert sum(r.n_removed for r in got.collect()) > 100_000


def test_long_texts_are_cut_without_a_seam(monkeypatch):
    r = random.Random(2)
    text = bytes(r.randrange(97, 101) for _ in range(5000))
    whole = suffix_dedup.anchors(list(suffix_dedup.slices(text)))
    monkeypatch.setattr(suffix_dedup, "SLICE", 512)
    cut = suffix_dedup.anchors(list(suffix_dedup.slices(text)))
    as_set = lambda a: set(zip(*(x.tolist() for x in a[1:]), strict=True))
    assert as_set(whole) == as_set(cut)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", max_size=90), min_size=1, max_size=8))
def test_refined_buckets_are_exact(texts):
    found = suffix_dedup.repeated_strings(np.arange(len(texts)), [t.encode() for t in texts])
    first, expected = {}, set()
    for k, t in enumerate(texts):
        for p in range(len(t) - 49):
            if first.setdefault(t[p : p + 50], k) < k:
                expected.add((k, p))
    assert set(map(tuple, found.tolist())) == expected


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.text("ab", max_size=30), st.text("ab", max_size=30)), min_size=1, max_size=12))
def test_strings_of_a_hot_gram_are_compared_where_they_hold_it(rows):
    gram = b"c" * suffix_dedup.GRAM
    inner = np.array([len(left) for _, left, _ in rows])
    doc = np.array([d for d, _, _ in rows])
    texts = [left.encode() + gram + right.encode() for _, left, right in rows]
    found = suffix_dedup.repeated_keys(doc, inner, pa.array([b"x", *texts], pa.binary())[1:])
    strings = [(k, p, t[p : p + 50]) for k, t in enumerate(texts) for p in range(len(t) - 49)]
    first = {}
    for k, p, s in strings:
        first[s] = min(first.get(s, doc[k]), doc[k])
    assert sorted(map(tuple, found.tolist())) == [(k, p) for k, p, s in strings if first[s] < doc[k]]


# --- lines ------------------------------------------------------------------


def test_repeated_lines(spark, awkward):
    got = line_dedup.drop_repeated_lines(awkward)
    rows = got.collect()
    assert len(rows) == len(ROWS)
    expected = brute.lines_removed(ROWS)
    assert {r.doc_id: (r.n_lines, r.n_removed, r.n_runs, r.kept) for r in rows} == expected
    assert expected[15][1] == 8
    r = random.Random(5)
    more = [(k, "\n".join(r.choice(["p", "q", "", " ", "s", "t"]) for _ in range(r.randrange(12))), "s") for k in range(80)]
    got = line_dedup.drop_repeated_lines(make(spark, more))
    assert by_id(got, "n_lines", "n_removed", "n_runs", "kept") == brute.lines_removed([(i, t) for i, t, _ in more])


def long_lines_removed(rows, run=3, words=50):
    """doc_id: kept, where fewer lines than a run count too if they have so many words."""
    own = {i: [(k, x) for k, x in enumerate((t or "").split("\n")) if brute.words(x)] for i, t in rows}
    first, strings = {}, []
    for i in sorted(own):
        for s in range(len(own[i])):
            for e in range(s + 1, min(s + run, len(own[i])) + 1):
                part = tuple(x for _, x in own[i][s:e])
                if e - s == run or sum(len(brute.words(x)) for x in part) >= words:
                    strings.append((i, s, e, part))
                    first.setdefault(part, (i, s))
    gone = {(i, own[i][k][0]) for i, s, e, part in strings if first[part] < (i, s) for k in range(s, e)}
    return {i: "\n".join(x for k, x in enumerate((t or "").split("\n")) if (i, k) not in gone) for i, t in rows}


def test_long_lines_are_runs_too(spark):
    r = random.Random(8)
    lines = [" ".join(f"w{r.randrange(999)}" for _ in range(n)) for n in (168, 50, 49, 49, 30, 25, 1, 1)] + ["", " "]
    rows = [(1, lines[0]), (2, lines[0]), (3, lines[2]), (4, lines[2]), (5, f"a\n{lines[4]}\n\n{lines[5]}"), (6, f"{lines[4]}\n{lines[5]}\nb")]
    rows += [(k, "\n".join(r.choice(lines) for _ in range(r.randrange(6)))) for k in range(7, 60)]
    got = line_dedup.drop_repeated_lines(make(spark, [(i, t, "s") for i, t in rows]), words=50)
    kept = {i: t for i, (t,) in by_id(got, "kept").items()}
    assert kept == long_lines_removed(rows)
    assert (kept[2], kept[4], kept[6]) == ("", lines[2], "b")


def test_very_many_lines_in_one_text(spark):
    """Two equal texts of 100,000 lines: the work per line does not grow with their number."""
    text = "\n".join(f"line {k}" for k in range(100_000))
    began = time.time()
    got = line_dedup.drop_repeated_lines(make(spark, [(1, text, "s"), (2, "own\n" + text + "\nlast", "s")]), words=50)
    rows = {r.doc_id: (r.n_lines, r.n_removed, r.n_runs, r.kept) for r in got.collect()}
    assert rows == {1: (100_000, 0, 0, text), 2: (100_002, 100_000, 1, "own\nlast")}
    assert time.time() - began < 60


def test_a_hot_fingerprint_is_joined_with_a_stored_table(spark, awkward):
    """Both sides of the joins are plain exchanges, which Spark splits where a key is hot."""
    joined = line_dedup.repeated_lines(awkward, words=50)._jdf.queryExecution().executedPlan().toString()
    assert joined.count("Scan parquet") >= 2 and joined.count("Aggregate") <= 2


def test_lines_run_on_dataframe_functions_alone(awkward):
    plan = line_dedup.drop_repeated_lines(awkward)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- empty tables -----------------------------------------------------------


@pytest.mark.parametrize(
    "run",
    [
        lambda s, d: exact_dedup.exact_dedup(d, exact_dedup.new_index(s, 4)),
        lambda s, d: exact_dedup.keep_first(d, exact_dedup.new_index(s, 4)),
        lambda s, d: shingle_join.shingle_components(d),
        lambda s, d: shingle_join.one_of_each(d),
        lambda s, d: suffix_dedup.remove_repeats(d),
        lambda s, d: line_dedup.drop_repeated_lines(d),
    ],
)
def test_an_empty_table_gives_no_rows(spark, none, run):
    assert run(spark, none).count() == 0
