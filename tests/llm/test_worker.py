"""What a Python worker holds from task to task."""

import pickle

import pyarrow as pa
from pyspark import cloudpickle

from terrace.llm import packing, shingle_join
from terrace.llm.common import Forgetful, slices, worker


def sent_functions(monkeypatch, docs, make) -> list:
    """Functions that an operator hands to ``mapInArrow``, as a worker gets them."""
    found = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, schema: found.append(f) or self)
    make(docs)
    return [pickle.loads(cloudpickle.dumps(f)) for f in found]


def test_a_task_meets_the_keeper_of_its_process(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    for make in (packing.pieces, lambda d: shingle_join.pack_shingles(d, 4)):
        (function,) = sent_functions(monkeypatch, docs, make)
        assert function.__globals__["worker"] is worker


def test_tasks_of_one_operator_share_what_they_remember(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    batch = pa.RecordBatch.from_pylist([{"doc_id": 1, "text": "a b c d e f"}])
    forgotten, given_back = [], []
    monkeypatch.setattr(worker, "owner", "")
    monkeypatch.setattr(worker, "memories", [lambda: forgotten.append(1)])
    monkeypatch.setattr(Forgetful, "give_back", lambda self: given_back.append(1))
    for _ in range(3):
        (function,) = sent_functions(monkeypatch, docs, lambda d: shingle_join.pack_shingles(d, 4))
        assert list(function(iter([batch])))
    # Forgets once, as the operator takes over; gives back then and at the end of every task.
    assert len(forgotten) == 1 and len(given_back) == 4


def test_slices_lose_no_row():
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
    batches = [pa.RecordBatch.from_pylist([{"doc_id": i, "text": None if i % 3 else str(i)} for i in range(n)], schema=schema)
               for n in (0, 1, 7, 20)]
    cut = list(slices(iter(batches), 7))
    assert max(b.num_rows for b in cut) == 7
    assert pa.Table.from_batches(cut).to_pylist() == pa.Table.from_batches(batches).to_pylist()
