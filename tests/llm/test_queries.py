"""The registered queries over a small folder of tables: against SQL where it can, else brute force."""

import collections
import os

import pytest

import __spark_entry__ as entry
import check
import corpus_pipeline
from terrace.llm import catalog, license_scan, quality, token_counts, tokens
from tests.llm import brute
from tests.llm.test_text import check_packing

FOLDER = "/root/testdata/sf0.001"
TABLE = tokens.table(token_counts.vocabulary())

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def db():
    return check.database(FOLDER)


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


def test_one_query_per_operator_and_the_pipeline():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert entry.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in entry.oracle_sql()


@pytest.mark.parametrize("name", catalog.oracle_sql())
def test_query_equals_its_answer(spark, db, name):
    _, differences = check.compare(spark, db, FOLDER, name)
    assert not differences


def test_suffix_dedup(spark, documents):
    rows = catalog.op3_suffix_dedup(spark, FOLDER).collect()
    expected = brute.removed(documents)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == expected


def test_token_counts(spark, documents):
    rows = catalog.op4_token_counts(spark, FOLDER).collect()
    expected = {i: (len((t or "").encode()), len(TABLE.library_ids(t or ""))) for i, t in documents}
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in rows} == expected
    assert all(r.over_limit == (r.n_tokens > 2048) for r in rows)


def test_quality(spark, documents):
    rows = catalog.op5_quality_rules(spark, FOLDER).collect()
    texts = dict(documents)
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[m] for m in quality.MEASURES) == brute.measures(texts[r.doc_id])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    judged = [(labels[r.doc_id] == 1, r.kept) for r in rows if r.doc_id in labels and not r.base_failed]
    assert sum(a == b for a, b in judged) >= 0.95 * len(judged)


def test_packing(spark, documents):
    rows = catalog.op8_pack(spark, FOLDER).collect()
    sequences = check_packing(rows, dict(documents), 4096)
    assert sum(r.length for r in rows) > 0.97 * 4096 * (len(sequences) - 1)


def test_license_scan(spark, documents):
    rows = collections.Counter((r.doc_id, r.license) for r in catalog.op9_license_scan(spark, FOLDER).collect())
    short = {n: t for n, t in license_scan.TEMPLATES.items() if len(t) < 100}
    expected = collections.Counter({(i, n): t.count(w) for i, t in documents for n, w in short.items() if w in (t or "")})
    assert rows == expected


def test_pipeline_against_brute_force(spark, documents):
    """Every stage's rows, from the rows of the stage before."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    texts, sources = dict(documents), {r.doc_id: r.source for r in docs.collect()}
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, FOLDER), "test")
        steps[name] = docs
        if name != "pack":
            assert docs.columns == columns
    ids = {name: sorted(r.doc_id for r in df.collect()) for name, df in steps.items() if name != "pack"}

    model = quality.fit(spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet"))
    good = []
    for i, t in documents:
        m = brute.measures(t)
        score = int(model.scores([(t or "").encode()])[0])
        if m[0] >= 10 and 100 * m[4] <= 20 * m[0] and score >= model.threshold:
            good.append(i)
    assert ids["quality_rules"] == sorted(good)

    first = {}
    for i in sorted(good):
        first.setdefault(" ".join(brute.re.split(brute.SPACE, texts[i])), i)
    assert ids["exact_dedup"] == sorted(first.values())

    groups = brute.components([(i, texts[i]) for i in ids["exact_dedup"]])
    assert ids["shingle_join"] == sorted({c for _, c in groups.values()})

    sizes = collections.Counter()
    for i in ids["shingle_join"]:
        sizes[sources[i]] += len(brute.words(texts[i]))
    taken = collections.Counter()
    for i in ids["mix_sources"]:
        taken[sources[i]] += len(brute.words(texts[i]))
    for s, target in brute.shares(sizes).items():
        largest = max(len(brute.words(texts[i])) for i in ids["shingle_join"] if sources[i] == s)
        assert abs(taken[s] - target) <= largest
    assert max(collections.Counter(ids["mix_sources"]).values()) <= 3

    rows = steps["pack"].collect()
    check_packing(rows, {i: texts[i] for i in set(ids["mix_sources"])}, 4096)
    assert sorted(r.doc_id for r in rows if r.start == 0) == ids["mix_sources"]
    lengths = {i: len(TABLE.library_ids(texts[i])) + 1 for i in set(ids["mix_sources"])}
    assert sum(r.length for r in rows) == sum(lengths[i] for i in ids["mix_sources"])


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_awkward_and_empty_tables(spark, awkward, none, labels, tmp_path, stage):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (awkward, none):
        out = stage(spark, docs, str(tmp_path))
        assert (out.columns == docs.columns) == (stage is not corpus_pipeline.pack_sequences)
        assert (out.count() > 0) == (docs is awkward)
