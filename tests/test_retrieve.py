import numpy as np
import pytest
from pyspark.sql import functions as F

from vellumflow.operators import cells, retrieve


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(300, 8)).astype(np.float32)
    rows[100:200] = rows[0]  # a third of all rows are copies of one
    data = [(f"id-{i:03d}", [float(x) for x in v], i % 5) for i, v in enumerate(rows)]
    data.append(("id-null", None, 0))
    return spark.createDataFrame(data, "id string, embedding array<float>, label int").repartition(7).cache()


@pytest.fixture(scope="module")
def questions(vectors):
    return vectors.where("label = 1").select(F.col("id").alias("qid"), "embedding").cache()


def brute(questions, corpus, k, threshold=-1.0):
    ids, mat = zip(*sorted((r.id, r.embedding) for r in corpus.collect() if r.embedding is not None))
    unit = np.asarray(mat, np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    out = set()
    for r in questions.collect():
        if r.embedding is None:
            continue
        q = np.asarray(r.embedding, np.float64)
        scores = np.round(unit @ (q / np.linalg.norm(q)), 9)
        best = sorted(((-s, i) for s, i in zip(scores, ids) if s >= threshold))[:k]
        out |= {(r.qid, i, rank + 1) for rank, (_, i) in enumerate(best)}
    return out


def found(hits):
    return {(r.qid, r.id, r["rank"]) for r in hits.collect()}


@pytest.mark.parametrize("size", [retrieve.BROADCAST_BYTES, 0])
def test_exact_hits_with_ties(questions, vectors, size, monkeypatch):
    monkeypatch.setattr(retrieve, "QUESTION_BLOCK", 16)
    monkeypatch.setattr(retrieve, "CORPUS_BLOCK", 20)
    monkeypatch.setattr(retrieve, "TILE", 7)
    assert found(retrieve.exact_hits(questions, vectors, 4, broadcast_bytes=size)) == brute(questions, vectors, 4)


def test_threshold_is_inclusive_and_filter_comes_first(questions, vectors):
    hits = retrieve.exact_hits(questions, vectors, 500, threshold=1.0)
    assert found(hits) == brute(questions, vectors, 500, 1.0)
    only = vectors.where("label = 2")
    assert found(retrieve.exact_hits(questions, vectors, 3, where=F.col("label") == 2)) == brute(questions, only, 3)


def test_no_questions_no_corpus(questions, vectors):
    assert retrieve.exact_hits(questions.where("false"), vectors, 3).isEmpty()
    assert retrieve.exact_hits(questions, vectors.where("false"), 3).isEmpty()


def test_probing_every_cell_is_exact(questions, vectors, monkeypatch):
    monkeypatch.setattr(cells, "CORPUS_BLOCK", 16)
    monkeypatch.setattr(cells, "QUESTION_BLOCK", 16)
    pivots = cells.choose_pivots(vectors, 10)
    table = cells.cell_table(vectors, pivots)
    sizes = table.groupBy("cell", "slot").count().collect()
    assert sum(r["count"] for r in sizes) == 300
    # The cell of the copies is spread over several blocks.
    assert max(r.slot for r in sizes) >= 6 and max(r["count"] for r in sizes) < 60
    every = cells.cell_hits(questions, table, pivots, 4, probes=10)
    assert found(every) == brute(questions, vectors, 4)
    few = cells.cell_hits(questions, table, pivots, 4, probes=3)
    assert 0 < cells.recall(few, every).first().recall <= 1


def test_plan_has_no_pairs_join_and_reads_two_columns(questions, vectors, spark, sf_dir, capsys):
    corpus = spark.read.parquet(f"{sf_dir}/embeddings.parquet").withColumnRenamed("vec_id", "id")
    asked = corpus.select(F.col("id").alias("qid"), "embedding")
    retrieve.exact_hits(asked, corpus, 3, where=F.col("label") == 2).explain("formatted")
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "WindowGroupLimit" in plan and "EqualTo(label,2)" in plan


def test_documents_carry_score_and_metadata(questions, vectors):
    hits = retrieve.exact_hits(questions, vectors, 1)
    rows = retrieve.with_rows(hits, vectors.withColumn("text", F.lit("t")), ["text", "label"])
    far = retrieve.with_rows(hits, vectors.withColumn("text", F.lit("t")), ["text", "label"], broadcast_bytes=0)
    assert sorted(map(str, rows.collect())) == sorted(map(str, far.collect()))
    doc = retrieve.as_documents(rows, "text", others=["label"]).first().document
    assert doc.page_content == "t" and set(doc.metadata) == {"similarity_score", "label"}


def test_more_pairs_make_more_tasks(questions, vectors, monkeypatch):
    asked, rows = questions.count(), vectors.count()
    monkeypatch.setattr(retrieve, "TILE", 7)
    monkeypatch.setattr(retrieve, "PRODUCT", 16)
    monkeypatch.setattr(retrieve, "TASK_PAIRS", asked * rows // 50)
    passes = retrieve._one_pass(questions, vectors, 4, -1.0, "qid", "id", "embedding")
    assert passes.rdd.getNumPartitions() >= 50
    assert found(retrieve.ranked(passes, 4)) == brute(questions, vectors, 4)
    monkeypatch.setattr(cells, "QUESTION_BLOCK", 16)
    pivots = cells.choose_pivots(vectors, 10)
    near = cells.near_lists(questions, pivots, 10, "qid")
    met = []
    ranked = cells.ranked
    monkeypatch.setattr(cells, "ranked", lambda hits, k: met.append(hits.rdd.getNumPartitions()) or ranked(hits, k))
    hits = cells.passed(near, cells.cell_table(vectors, pivots), asked, 4, -1.0)
    assert found(hits) == brute(questions, vectors, 4) and met[0] >= 50


def test_a_row_that_is_not_a_number_hides_no_hit():
    rng = np.random.default_rng(3)
    unit = retrieve._unit(rng.normal(size=20 * 6), 20)
    corpus = retrieve._unit(rng.normal(size=60 * 6), 60)
    corpus[5] = np.nan
    q, c, scores = retrieve._reaching(unit, corpus, corpus.astype(np.float32), np.full(20, 0.5), np.zeros(20, bool), 3)
    good = ~np.isnan(scores) & (scores >= 0.5)
    assert set(zip(q[good], c[good])) == set(zip(*np.nonzero(np.nan_to_num(unit @ corpus.T) >= 0.5)))
