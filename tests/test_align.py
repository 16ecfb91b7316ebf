"""Alignment of chunks of two versions against plain rules."""

import random

import pytest
from pyspark.sql import functions as F

from vellumflow.operators import align, sync

SCHEMA = "input_hash string, position long, id string, text string"


def rows_of(name, texts):
    return [(name, i, f"{name}-{i}", t) for i, t in enumerate(texts)]


def frame(spark, documents):
    return spark.createDataFrame([r for name, texts in documents.items() for r in rows_of(name, texts)], SCHEMA).repartition(4)


def common(a, b):
    """Length of the longest common subsequence of two lists without repeats."""
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def numbered(texts):
    seen = {}
    out = []
    for t in texts:
        seen[t] = seen.get(t, 0) + 1
        out.append((t, seen[t]))
    return out


def test_random_versions(spark):
    rng = random.Random(3)
    old, new = {}, {}
    for d in range(25):
        texts = [rng.choice(["a", "b", None]) if rng.random() < 0.2 else f"t{rng.randrange(40)}" for _ in range(rng.randrange(30))]
        changed = [t for t in texts if rng.random() > 0.15]
        for _ in range(rng.randrange(4)):
            changed.insert(rng.randrange(len(changed) + 1), f"new{rng.randrange(9)}")
        if changed and rng.random() < 0.5:
            a = rng.randrange(len(changed))
            changed = changed[a:] + changed[:a]
        old[f"d{d}"], new[f"d{d}"] = texts, changed
    new["fresh"], old["gone"] = ["x", "x"], ["y"]
    made = align.align(frame(spark, old), frame(spark, new)).collect()
    for name in {*old, *new}:
        before, after = numbered(old.get(name, [])), numbered(new.get(name, []))
        rows = [r for r in made if r["document"] == name]
        count = {c: [r for r in rows if r["change"] == c] for c in align.CHANGES}
        both = set(before) & set(after)
        assert len(count["keep"]) == common(before, after)
        assert len(count["keep"]) + len(count["move"]) == len(both)
        assert {r["position"] for r in count["insert"]} == {i for i, x in enumerate(after) if x not in both}
        assert {r["old_position"] for r in count["delete"]} == {i for i, x in enumerate(before) if x not in both}
        for r in count["keep"] + count["move"]:
            assert before[r["old_position"]] == after[r["position"]] and r["id"] == f"{name}-{r['old_position']}"
        kept = sorted((r["position"], r["old_position"]) for r in count["keep"])
        assert [o for _, o in kept] == sorted(o for _, o in kept)
        ids = [r["id"] for r in rows if r["change"] != "delete"]
        assert len(set(ids)) == len(ids)


def test_one_insertion_into_a_long_document(spark):
    texts = [f"chunk {i}" for i in range(1000)]
    old, new = frame(spark, {"d": texts}), frame(spark, {"d": [*texts[:10], "inserted", *texts[10:]]})
    plain = sync.change_set(old.drop("input_hash", "position"), new.drop("input_hash", "position"))
    assert plain.count() == 991
    held = align.with_ids(new, align.align(old, new))
    changes = sync.change_set(old.select("id", "text"), held.select("id", "text"))
    assert [r["change"] for r in changes.collect()] == ["insert"] and held.count() == 1001
    again = align.with_ids(new, align.align(held, new))
    assert sync.change_set(held.select("id", "text"), again.select("id", "text")).count() == 0


@pytest.mark.parametrize("empty", ["old", "new"])
def test_empty_version_and_no_document(spark, empty):
    some, none = spark.createDataFrame([(None, 0, "i", "a"), (None, 1, "j", None)], SCHEMA), spark.createDataFrame([], SCHEMA)
    made = align.align(none if empty == "old" else some, none if empty == "new" else some)
    assert {r["change"] for r in made.collect()} == {"insert" if empty == "old" else "delete"} and made.count() == 2
    same = align.align(some, some)
    assert {(r["id"], r["change"]) for r in same.collect()} == {("i", "keep"), ("j", "keep")}
    assert align.with_ids(some, same).agg(F.count("id")).first()[0] == 2
