"""One Python worker for a task of packing or of the quality rules, and long documents cut as plain arithmetic cuts them."""

import pytest

from vellumflow.llm import packing, quality, queries


def maps(df):
    """Python maps in the plan, each of which keeps a worker of its own in every task."""
    return df._jdf.queryExecution().executedPlan().toString().count("MapInArrow")


def test_a_task_keeps_one_worker(spark, monkeypatch):
    docs, stored = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id int, text string"), []
    monkeypatch.setattr(packing, "written", lambda df, name, f=packing.written: stored.append(df) or f(df, name))
    pieces = packing.pack(docs, queries.WORDS)
    assert [maps(df) for df in stored] == [1]
    assert maps(pieces) == 0 and maps(packing.digests(pieces)) == 1
    assert "text" not in stored[0].columns and "_text" not in stored[0].columns


def test_texts_are_judged_by_the_worker_that_counts(spark):
    docs = spark.createDataFrame([(1, "a b", 5), (2, None, 6)], "doc_id int, text string, _apart int")
    judged = quality.judged(docs, spark.createDataFrame([(1, 1)], "doc_id int, quality int"))
    assert maps(judged) == 1
    assert judged.columns == [*docs.columns, *(x.split()[0] for x in quality.COUNTS.split(", ")), "base_failed", "kept"]
    assert [(r["doc_id"], r["_apart"], r["kept"]) for r in judged.orderBy("doc_id").collect()] == [(1, 5, False), (2, 6, False)]


@pytest.mark.parametrize("length", [1, 7, 4096])
def test_long_documents(spark, length):
    texts = ["a " * 5000, "", "b c " * 3000, None, "d"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").coalesce(1)
    rows = sorted(packing.pack(df, queries.WORDS, length=length).collect(), key=lambda r: (r["sequence_id"], r["offset"]))
    stream = [(r["doc_id"], r["start"] + i, x) for r in rows for i, x in enumerate(r["piece"])]
    assert [(d, s) for d, s, _ in stream] == [(i, s) for i, n in enumerate((5001, 1, 6001, 1, 2)) for s in range(n)]
    at = 0
    for r in rows:
        assert (r["sequence_id"], r["offset"], r["length"]) == (at // length, at % length, len(r["piece"]))
        assert r["doc_tokens"] == (5001, 1, 6001, 1, 2)[r["doc_id"]] and r["offset"] + r["length"] <= length
        at += r["length"]
    assert len({x for d, s, x in stream if d == 0 and s < 5000}) == 1 and [x for d, s, x in stream if d == 3] == [packing.END]
