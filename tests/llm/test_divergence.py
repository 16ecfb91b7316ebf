"""The source audit against plain Python."""

import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from vellumflow.llm import divergence, queries

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, term string, n long, value string"


def plain(rows):
    docs = [(lang or "", source or "", Counter(TERM.findall((text or "").translate(UPPER)))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        often = Counter(t for _, _, found in own for t in found)
        kept = [t for t, n in often.items() if n >= 3]
        counts = {s: Counter() for _, s, _ in own}
        for _, source, found in own:
            counts[source].update({t: n for t, n in found.items() if often[t] >= 3})
        total = sum(counts.values(), Counter())

        def share(held, lang_kept=kept):
            n = sum(held.values())
            return {t: 1 + 1_000_000_000 * (held[t] + 1) // (n + len(lang_kept)) for t in lang_kept}

        p, q = {s: share(c) for s, c in counts.items()}, share(total)
        f = lambda a, b: (a - b) * (a - b) // b
        for s in counts:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in counts if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                for rank, (value, item) in enumerate(sorted(found, key=lambda r: (-r[0], r[1].encode())), 1):
                    if part == "pair" or rank <= 200:
                        out.append((lang, s, part, item, value, rank))
    return sorted(out)


LONG = "ab" * 60_000
ROWS = [
    ("The the THE cat", "en", "a"), ("the dog, the Cat; cats", "en", "b"), ("the cat's cap", "en", "a"), ("catalogue catalogues", "en", None), ("catalogue the", "en", "c"), ("Catalogue cap", "en", "c"),
    (None, "en", "d"), ("", None, None), ("Éa éa", "fr", "a"), ("éa Éa x", "fr", "b"), ("éa x", "fr", ""), ("x y", "fr", "b"), ("abcd abcde", "de", "a"), ("abcd abcde", "de", "a"), ("abcd abcde abcdef", "de", "b"),
    ("abcde", "de", "c"), ("one two", "es", "a"), ("three", "es", "b"), (LONG, "en", "z"), (LONG + " " + LONG + "x", "en", "z"), (LONG, "en", "y"), ("日本語 abc", "ja", "a"), ("日本語", "ja", "b"), ("日本 日本語", "ja", "b"),
]


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def sql(path):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    return sorted(con.execute(queries.ORACLE["op11_divergence"]).fetchall())


@pytest.mark.parametrize("first, limit, cells", [(4, 64 << 20, 1 << 20), (1, 0, 4)])
def test_hard_rows(spark, tmp_path, monkeypatch, first, limit, cells):
    monkeypatch.setattr(divergence, "FIRST_PREFIX", first)
    monkeypatch.setattr(divergence, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(divergence, "CELLS", cells)
    monkeypatch.setattr(divergence, "HELD", cells)
    spark.createDataFrame([(i, *r, "x", 1, "y") for i, r in enumerate(ROWS)], SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = rows_of(queries.op11_divergence(spark, str(tmp_path)))
    assert got == plain(ROWS) and got == sql(f"{tmp_path}/documents.parquet/*.parquet")


def test_given_rows(spark, sf_dir):
    got = rows_of(queries.op11_divergence(spark, sf_dir))
    assert got == sql(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang", "source").collect()]
    assert got == plain(rows)


def test_no_documents(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0


def test_large_counts():
    counts = np.array([0, 7, 1 << 40])
    assert divergence.shares(counts, 3 << 40).tolist() == [1 + 1_000_000_000 * (int(c) + 1) // (3 << 40) for c in counts]
