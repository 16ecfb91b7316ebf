"""Benchmark passages in documents against a plain search."""

import hashlib
import re

import duckdb
import pytest

from vellumflow.llm import contamination, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS, ITEMS = "doc_id long, text string, row long, words string, item string", "item_id long, text string, phrase string, m int"


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def plain(docs, items):
    windows = {}
    for item, text in items:
        own = words(text)
        m = min(10, len(own))
        for i in range(len(own) - m + 1 if own else 0):
            windows.setdefault(tuple(own[i : i + m]), set()).add(item)
    out = []
    for doc, text in docs:
        own, hit, names = words(text), set(), set()
        for m in {len(w) for w in windows}:
            for i in range(len(own) - m + 1):
                held = windows.get(tuple(own[i : i + m]))
                if held is not None:
                    hit |= set(range(i, i + m))
                    names |= held
        listed = sorted(str(n) for n in names if n is not None)
        out.append((doc, len(own), len(hit), len(listed), hashlib.sha256(",".join(listed).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


LONG = " ".join(f"w{i % 97}x{i % 89}" for i in range(2000))
ITEM_ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away"), (2, "quick BROWN fox, jumps over the lazy dog and runs"),
    (10, "One"), (11, "two words"), (12, "three little words"), (13, "exactly four words here"), (3, None), (4, ""), (5, "..."), (None, "an item of no name has ten or more words in it too"),
    (6, "a a a a a a a a a a a a"), (7, " ".join(LONG.split()[500:530])), (7, "second row of item seven with quite enough words in it yes"), (8, "Éa öü été ñandú straße naïve Ünï çok güzel şey İki"),
]
DOC_ROWS = [
    (1, "so THE quick-brown fox jumps over the lazy dog and runs far away again"), (2, "quick brown fox jumps over the lazy dog and"), (3, None), (4, ""), (5, "one"), (6, "two  words two words"),
    (7, "three little words, exactly four words here"), (8, "a " * 50), (9, LONG * 20), (10, "an item of no name has ten or more words in it too"), (None, "one two words"), (11, "one"), (11, "one"),
    (12, "éa öü été ñandú straße naïve ünï çok güzel şey iki"), (13, "Éa öü été ñandú straße naïve Ünï çok güzel şey İki"), (14, "x" * 100_000), (15, "a a a a a a a a a"), (16, "brown fox jumps over the lazy dog and runs far"),
]


def rows_of(df):
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def stored(spark, path, docs, items):
    spark.createDataFrame([(*d, 1, "x", "y") for d in docs], DOCS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(*i, "x", 1) for i in items], ITEMS).repartition(2).write.parquet(f"{path}/benchmark.parquet")


@pytest.mark.parametrize("items", [ITEM_ROWS, ITEM_ROWS[:2], []])
@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_hard_rows(spark, tmp_path, monkeypatch, items, limit):
    monkeypatch.setattr(contamination, "BROADCAST_BYTES", limit)
    stored(spark, tmp_path, DOC_ROWS, items)
    got = rows_of(queries.op12_contamination(spark, str(tmp_path)))
    assert got == plain(DOC_ROWS, items)
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    assert got == sorted(con.execute(queries.ORACLE["op12_contamination"]).fetchall(), key=repr)


def test_given_rows(spark, sf_dir):
    read = lambda name, id: [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").select(id, "text").collect()]
    got = rows_of(queries.op12_contamination(spark, sf_dir))
    assert got == plain(read("documents", "doc_id"), read("benchmark", "item_id")) and any(r[-1] for r in got)


def test_spans_and_no_documents(spark):
    items = spark.createDataFrame([(1, "b c"), (2, "c d"), (3, "z")], "item_id int, text string")
    docs = spark.createDataFrame([(1, "a b c d e z")], "doc_id int, text string")
    rows, sets = contamination.decontaminate(docs, items)
    row = rows.first()
    assert [tuple(s) for s in row["spans"]] == [(1, 4), (5, 6)] and sets.first()["items"] == ["1", "2", "3"]
    rows, sets = contamination.decontaminate(docs.limit(0), items)
    assert rows.count() == 0 and sets.count() == 0


def test_no_python_in_plan(spark, sf_dir):
    plan = queries.op12_contamination(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan
