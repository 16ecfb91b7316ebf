"""Search over learned cells and codes, and the table that is kept in step."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellumflow.operators import cells, coded, retrieve

SCHEMA = "id string, embedding array<float>"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in rows], SCHEMA).repartition(5)


def clustered(seed, n, groups=12, width=20):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(groups, width))
    own = rng.integers(0, groups, n)
    return middles[own] + 0.3 * rng.normal(size=(n, width))


@pytest.fixture(scope="module")
def rows():
    vectors = clustered(1, 900).astype(np.float32)
    vectors[300:600] = vectors[0]  # a third of all rows are equal
    return [(f"id-{i:04d}", v) for i, v in enumerate(vectors)] + [("id-null", None)]


def content(table):
    return sorted((r["id"], r["cell"], tuple(r["code"])) for r in table.collect())


def test_recall_and_share(spark, rows, tmp_path):
    corpus = frame(spark, rows)
    questions = frame(spark, [(f"q{i}", v) for i, v in enumerate(clustered(1, 40))] + [("q-null", None)]).withColumnRenamed("id", "qid")
    model = coded.fit(corpus, 12)
    path = f"{tmp_path}/coded"
    coded.save(coded.encode(corpus, model), path)
    table = coded.load(spark, path)
    assert table.count() == 900
    probes, short = coded.tuned(table, model, questions, 5, 0.95, qid="qid")
    found = coded.search(questions, table, model, 5, probes, short)
    exact = retrieve.exact_hits(questions, corpus, 5)
    assert cells.recall(found, exact).first()["recall"] >= 0.95
    assert probes < 12 and coded.scored_share(questions, table, model, probes) < 0.9
    every = coded.search(questions, table, model, 5, len(model.cells), 900)
    shown = lambda df: sorted((r["qid"], r["id"], round(r["score"], 6), r["rank"]) for r in df.collect())
    assert shown(every) == shown(exact)


def test_codes_estimate_cosines(spark, rows):
    corpus = frame(spark, rows)
    model = coded.fit(corpus, 12)
    unit = np.stack([v for _, v in rows if v is not None]).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = model.order(unit)[0][:, 0]
    codes = model.codes(unit, near)
    for cell in set(near.tolist()):
        got = model.scores(unit[:30], cell, codes[near == cell])
        assert np.abs(got - unit[:30] @ unit[near == cell].T).mean() < 0.1


@pytest.mark.parametrize("most", [60, 10_000])
def test_table_in_step(spark, rows, tmp_path, most):
    path = f"{tmp_path}/coded"
    now = dict(rows)
    model = coded.fit(frame(spark, rows), 10)
    coded.save(coded.encode(frame(spark, rows), model), path)
    random = np.random.default_rng(4)
    empty_cell = int(model.cells[0])
    for step in range(3):
        ids = sorted(now)
        gone = [ids[i] for i in random.choice(len(ids), 40, replace=False)]
        if step == 1:  # one whole cell goes
            gone += [r["id"] for r in coded.load(spark, path).where(F.col("cell") == empty_cell).collect()]
        moved = [(i, v) for i, v in zip([x for x in ids if x not in gone][:30], clustered(7 + step, 30))]
        fresh = [(f"new-{step}-{i}", v) for i, v in enumerate(np.r_[clustered(20 + step, 100), np.tile(clustered(50, 1), (80, 1))])]
        changes = moved + fresh + [("id-none", None)]
        if step == 2:
            changes.append((fresh[0][0], None))
            changes = [c for c in changes if c[1] is None or c[0] != fresh[0][0]]
        now = {i: v for i, v in now.items() if i not in gone} | dict(changes)
        model = coded.apply_changes(spark, path, model, frame(spark, changes), frame(spark, [(g, None) for g in gone]).select("id"), most)
        anew = coded.encode(frame(spark, list(now.items())), model)
        held = coded.load(spark, path)
        assert content(held) == content(anew)
        assert set(model.cells.tolist()) == {r["cell"] for r in held.select("cell").distinct().collect()}
        if most == 60:
            large = held.groupBy("cell").agg(F.count("*").alias("n"), F.countDistinct("embedding").alias("kinds")).where("n > 60").collect()
            assert all(r["kinds"] <= 2 for r in large)
        else:
            assert len(model.cells) <= 10


def test_nothing_to_learn_from(spark):
    with pytest.raises(ValueError, match="empty"):
        coded.fit(frame(spark, [("a", None)]), 4)
    with pytest.raises(ValueError, match="at least one"):
        coded.fit(frame(spark, [("a", [1, 2])]), 0)


def test_long_lists_are_not_written(spark, rows, tmp_path, monkeypatch):
    """The table passes by the questions where lists would be longer than it: the same hits, and no list is made."""
    corpus = frame(spark, rows)
    questions = frame(spark, [(f"q{i}", v) for i, v in enumerate(clustered(1, 60))] + [("q-null", None), ("q-zero", [0] * 20)]).withColumnRenamed("id", "qid")
    model = coded.fit(corpus, 12)
    path = f"{tmp_path}/coded"
    coded.save(coded.encode(corpus, model), path)
    table = coded.load(spark, path)
    shown = lambda df: sorted((r["qid"], r["id"], round(r["score"], 6), r["rank"]) for r in df.collect())
    few, some = coded.search(questions.limit(2), table, model, 5, 4, 20), coded.search(questions, table, model, 5, 4, 20, 0.2)
    listed = coded.short_lists(questions, table, model, 4, 20)
    unit = {i: np.asarray(v, float) / (np.linalg.norm(v) or 1) for i, v in rows if v is not None}
    asked = {r["qid"]: coded._unit(np.asarray(r["embedding"]), 1)[0] for r in questions.collect() if r["embedding"] is not None}
    wanted = []
    for qid in asked:
        mine = [(-round(float(asked[qid] @ unit[r["id"]]), 9), r["id"]) for r in listed.where(F.col("qid") == qid).collect()] if qid in ("q3", "q-zero") else []
        wanted += [(qid, i, round(-s, 6), n + 1) for n, (s, i) in enumerate(sorted(m for m in mine if -m[0] >= 0.2)[:5])]
    assert [h for h in shown(some) if h[0] in ("q3", "q-zero")] == sorted(wanted)
    assert few.count() == 10
    monkeypatch.setattr(coded, "short_lists", None)
    monkeypatch.setattr(cells, "TILE", 7)
    monkeypatch.setattr(cells, "QUESTION_BLOCK", 4)
    every = coded.search(questions, table, model, 5, len(model.cells), 900)
    assert shown(every) == shown(retrieve.exact_hits(questions, corpus, 5))
    assert shown(coded.search(questions, table, model, 5, len(model.cells), 899)) == shown(every)
    pivots = cells.choose_pivots(corpus, 6)
    placed = cells.cell_table(corpus, pivots)
    assert shown(cells.cell_hits(questions, placed, pivots, 5, 6)) == shown(every)


@pytest.mark.parametrize("k, short, threshold", [(5, 20, 0.3), (20, 15, -1.0), (2, 40, -1.0)])
def test_rows_move_once_for_any_length_of_lists(spark, rows, tmp_path, monkeypatch, k, short, threshold):
    """What the rows of long lists are: the best by estimate, ties to the smaller id. Rows are not moved for each block of questions."""
    vectors = clustered(1, 900).astype(np.float32)
    vectors[600:] += np.random.default_rng(6).normal(size=(300, 20))  # codes tell these badly
    corpus = frame(spark, [(i, v if v is None or i < "id-0600" else vectors[n]) for n, (i, v) in enumerate(rows)])
    asked = [(f"q{i}", v) for i, v in enumerate(clustered(1, 60))] + [("q-null", None), ("q-zero", [0] * 20), ("q7", clustered(3, 1)[0]), (None, clustered(4, 1)[0])]
    questions = frame(spark, asked).withColumnRenamed("id", "qid")
    model = coded.fit(corpus, 12)
    coded.save(coded.encode(corpus, model), f"{tmp_path}/coded")
    table = coded.load(spark, f"{tmp_path}/coded")
    near = {r["id"]: (r["cell"], coded._unit(np.asarray(r["embedding"]), 1)[0], model.decoded(r["cell"], np.asarray([r["code"]]))[0]) for r in table.collect()}
    want: dict = {}
    for r in questions.where("embedding is not null").collect():
        unit = coded._unit(np.asarray(r["embedding"]), 1)
        probed = set(model.cells[model.order(unit, 4)[0][0]].tolist())
        best = sorted((-round(float(unit[0] @ about), 9), i) for i, (cell, _, about) in near.items() if cell in probed)[:short]
        want.setdefault(r["qid"], []).extend(s for s in ((-round(float(unit[0] @ near[i][1]), 9), i) for _, i in best) if -s[0] >= threshold)
    want = {(q, i, n + 1) for q, hits in want.items() for n, (_, i) in enumerate(sorted(hits)[:k])}
    seen, kind = [], type(corpus)
    made = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, *a: seen.append(self.count()) or made(self, *a))
    monkeypatch.setattr(cells, "LIST_BYTES", 1 << 12)
    monkeypatch.setattr(cells, "SENT_BYTES", 8 << 10, raising=False)
    monkeypatch.setattr(cells, "TILE", 7)
    got = coded.search(questions, table, model, k, 4, short, threshold).collect()
    assert {(r["qid"], r["id"], r["rank"]) for r in got} == want
    assert max(seen) <= 900
