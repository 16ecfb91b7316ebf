"""The conversation trie against a plain one."""

import hashlib
import zlib

import duckdb
import pytest

from vellumflow.llm import queries, trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, s0 string, block long"


def plain(rows):
    own = {}
    for conv, turn, role, text in sorted(((r[0], r[1], r[2] or "", r[3] or "") for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3])):
        own.setdefault(conv, []).append((role, text))
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        made = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(made) + 1):
            members.setdefault(made[:d], []).append(c)
        ends.setdefault(made, []).append(c)
    out = []
    for node, ids in members.items():
        below = [n for n in members if n[: len(node)] == node]
        out.append((
            min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids),
            sum(len(n) == len(node) + 1 for n in below),
            sum(not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in below) for n in below),
            sum((len(members[n]) - 1) * (len(n[-1][1]) if n else 0) for n in below),
            hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def hard_rows():
    rows = []
    for c in [0, 1, 2, 3, 99, 100, 101, 155, 205, 250, 300, 301, 302, -1, -5, -100, -101, 65536, 65537, 65600, 131100, 70000]:
        for t in range(abs(c) % 9):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"hé{min(t, abs(c) % 3)}" * (1 + t % 3), 1, "x", 2))
    rows += [(7, None, None, None, 1, None, None), (7, None, "a", "b", 1, None, None), (7, 1, "ab", "", 1, None, None), (7, 1, "a", "b", 1, None, None)]
    rows += [(8, 1, "u", "again", 1, None, None)] * 3 + [(None, 1, "u", "x", 1, None, None), (9, 0, "", "", 1, None, None)]
    rows += [(400, 0, "u", "x" * 300_000, 1, None, None), (401, 0, "u", "x" * 300_000, 1, None, None)]
    return rows


def as_rows(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


@pytest.mark.parametrize("block, bits", [(4096, 16), (3, 2)])
def test_hard_conversations(spark, tmp_path, monkeypatch, block, bits):
    monkeypatch.setattr(trie, "BLOCK", block)
    monkeypatch.setattr(trie, "ID_BITS", bits)
    spark.createDataFrame(hard_rows(), SCHEMA).repartition(3).coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    got = as_rows(queries.op13_trie(spark, str(tmp_path)))
    assert got == plain(hard_rows())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert got == sorted(con.execute(queries.ORACLE["op13_trie"]).fetchall(), key=repr)


def test_given_conversations(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert as_rows(queries.op13_trie(spark, sf_dir)) == plain(rows)


def test_one_conversation_over_many_partitions(spark, monkeypatch):
    """A third of all rows is one conversation, and many are equal."""
    monkeypatch.setattr(trie, "BLOCK", 16)
    rows = [(500, t, "u", f"t{t}") for t in range(400)] + [(c, t, "u", "same") for c in range(600, 700) for t in range(6)] + [(510, t, "u", f"t{t}") for t in range(200)]
    made = trie.build(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5))
    nodes = made.nodes.join(trie.end_digests(made.ends), trie.KEY, "left").fillna(hashlib.sha256(b"").hexdigest(), "ends_sha256")
    assert as_rows(nodes) == plain(rows)
    texts = {r["turn"]: (r["role"], r["text"]) for r in made.texts.collect()}
    assert all(texts[r["turn"]][0] == "u" and len(texts[r["turn"]][1]) == r["chars"] for r in made.nodes.where("depth > 0").collect())


def test_no_conversations(spark):
    made = trie.build(spark.createDataFrame([], SCHEMA))
    assert made.nodes.count() == 0 and trie.end_digests(made.ends).count() == 0
