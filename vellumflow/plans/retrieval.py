"""Registered queries over vectors: search, embedding, sync."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumflow.functions import stubs
from vellumflow.operators import align, cells, coded, embed, pruned, retrieve, sync
from vellumflow.plans.common import letters_sql, table, texts
from vellumflow.session import few, new_folder, settled, stored

K = 3
PIVOTS = 32
# Cells of 32 that a search looks into: 20 find 0.92 of the exact hits on the test vectors, which are close to random.
PROBES = 20
# Share of the exact hits that an approximate search must find.
RECALL = 0.9


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "id")


def _questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector is a question."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("qid"), "embedding")


def shown(hits: DataFrame) -> DataFrame:
    return hits.select("qid", "id", F.col("rank").cast("bigint").alias("rank"), F.round("score", 4).alias("score"))


def topk_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(retrieve.exact_hits(_questions(spark, sf_dir), _vectors(spark, sf_dir), K))


def topk_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(retrieve.exact_hits(_questions(spark, sf_dir), _vectors(spark, sf_dir), 5, threshold=0.4))


def topk_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = retrieve.exact_hits(
        _questions(spark, sf_dir), _vectors(spark, sf_dir), K, where=F.col("label").isin(1, 3, 5)
    )
    return shown(hits)


def topk_striped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact search as for more questions than fit a broadcast."""
    return shown(pruned.pruned_hits(_questions(spark, sf_dir), _vectors(spark, sf_dir), K))


def topk_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _vectors(spark, sf_dir)
    pivots = cells.choose_pivots(vectors, PIVOTS)
    path = new_folder(spark, "cells")
    cells.cell_table(vectors, pivots).write.partitionBy("cell").parquet(path)
    return shown(cells.cell_hits(_questions(spark, sf_dir), spark.read.parquet(path), pivots, K, PROBES))


def ann_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors, questions = _vectors(spark, sf_dir), _questions(spark, sf_dir)
    pivots = cells.choose_pivots(vectors, PIVOTS)
    near = cells.cell_hits(questions, cells.cell_table(vectors, pivots), pivots, K, PROBES)
    return enough(cells.recall(near, retrieve.exact_hits(questions, vectors, K)))


def enough(found: DataFrame) -> DataFrame:
    """``found``, or an error where its recall is below RECALL."""
    low = F.raise_error(F.concat(F.lit("recall is only "), F.col("recall").cast("string")))
    return found.withColumn("recall", F.when(F.col("recall") >= RECALL, F.col("recall")).otherwise(low))


def coded_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search over learned cells and codes, with probes and lists chosen by measurement: an error where it finds less than it must."""
    vectors, questions = _vectors(spark, sf_dir), _questions(spark, sf_dir)
    model = coded.fit(vectors, PIVOTS)
    path = new_folder(spark, "coded")
    coded.save(coded.encode(vectors, model), path)
    held = coded.load(spark, path)
    probes, short = coded.tuned(held, model, questions, K, RECALL, qid="qid")
    found = cells.recall(coded.search(questions, held, model, K, probes, short), retrieve.exact_hits(questions, vectors, K))
    share = coded.scored_share(questions, held, model, probes)
    n = held.count()
    return enough(found).select("n_exact", (F.col("recall") >= RECALL).alias("enough"), F.lit(share <= 1 and short < n).alias("pruned"))


def kept_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A coded table built on some vectors, then brought in step by inserts, changes and deletes; searched through all its cells."""
    vectors = _vectors(spark, sf_dir).select("id", "embedding", "label")
    before = vectors.where("label <> 3").withColumn("embedding", F.when(F.col("id") % 5 == 0, F.reverse("embedding")).otherwise(F.col("embedding")))
    model = coded.fit(before, PIVOTS)
    path = new_folder(spark, "coded")
    coded.save(coded.encode(before, model), path)
    now = vectors.where("label <> 1")
    upserts = now.where((F.col("label") == 3) | (F.col("id") % 5 == 0))
    model = coded.apply_changes(spark, path, model, upserts.select("id", "embedding"), vectors.where("label = 1").select("id"), most=max(8, vectors.count() // 16))
    held = coded.load(spark, path)
    return shown(coded.search(_questions(spark, sf_dir), held, model, K, len(model.cells), held.count()))


def retrieved_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits as documents: the text of a vector is its label."""
    vectors = _vectors(spark, sf_dir).withColumn("text", F.concat(F.lit("label "), F.col("label")))
    hits = retrieve.exact_hits(_questions(spark, sf_dir), vectors, K)
    rows = retrieve.with_rows(hits.withColumn("score", F.round("score", 4)), vectors, ["text", "label"])
    docs = retrieve.as_documents(rows, "text", "id", ["label"])
    return docs.select(
        "qid",
        F.col("rank").cast("bigint").alias("rank"),
        "document.id",
        "document.page_content",
        F.col("document.metadata")["label"].alias("label"),
        F.col("document.metadata")["similarity_score"].cast("double").alias("similarity_score"),
    )


# --- embedded texts -------------------------------------------------------------------------


def embedded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = embed.embed(texts(spark, sf_dir, "documents", "doc_id").select("doc_id", "text"), stubs.letter_embedder)
    total = lambda at: F.get("embedding", F.lit(at)).cast("bigint")
    return docs.select("doc_id", total(0).alias("a"), total(4).alias("e"), total(25).alias("z"))


def text_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their embedding, kept so that the embedder runs once."""
    docs = texts(spark, sf_dir, "documents", "doc_id").select(F.col("doc_id").alias("id"), "text")
    return stored(embed.embed(docs, stubs.letter_embedder).select("id", "embedding"), "corpus")


def text_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), "text")
    questions = settled(embed.embed(asked, stubs.letter_embedder).select("qid", "embedding"))
    return shown(retrieve.exact_hits(questions, text_corpus(spark, sf_dir), K))


# --- two versions of a table -------------------------------------------------------------------


def _old(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Before: no Spanish documents yet."""
    return table(spark, sf_dir, "documents").where("lang <> 'es'").select(F.col("doc_id").alias("id"), "text", "source")


def _new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After: Spanish came, German went, and the text of what is labelled toxic was revised."""
    docs = table(spark, sf_dir, "documents").where("lang <> 'de'")
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id", F.lit(True).alias("_toxic"))
    revised: Column = F.when(F.col("_toxic"), F.concat("text", F.lit(" (revised)"))).otherwise(F.col("text"))
    return docs.join(toxic, "doc_id", "left").select(F.col("doc_id").alias("id"), revised.alias("text"), "source")


def change_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sync.change_set(_old(spark, sf_dir), _new(spark, sf_dir))


def upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _old(spark, sf_dir), _new(spark, sf_dir)
    changes = few(settled(sync.change_set(old, new)))
    return sync.upsert(old, changes, sync.changed_rows(new, changes)).select("id", F.md5("text").alias("text_md5"), "source")


def synced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create, then bring in step: the result embeds the new version."""
    folder, columns = new_folder(spark, "embedded"), ["id", "text", "source"]
    sync.sync(_old(spark, sf_dir), folder, stubs.letter_embedder, columns)
    now = sync.sync(_new(spark, sf_dir), folder, stubs.letter_embedder, columns)
    return now.select("id", F.md5("text").alias("text_md5"), F.get("embedding", F.lit(4)).cast("bigint").alias("e"))


def _lines(docs: DataFrame, lines: Column) -> DataFrame:
    """Every line of a document as a chunk whose id tells its place."""
    rows = docs.select(F.col("doc_id").cast("string").alias("input_hash"), F.posexplode(lines).alias("position", "text"))
    return rows.withColumn("id", F.md5(F.concat_ws("/", "input_hash", F.col("position").cast("string")).cast("binary")))


def aligned_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents before and after a new first line and, in every third document, the loss of the last one."""
    docs = table(spark, sf_dir, "documents")
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    left = F.when(F.col("doc_id") % 3 == 0, F.slice(lines, F.lit(1), F.size(lines) - 1)).otherwise(lines)
    old, new = _lines(docs, lines), _lines(docs, F.concat(F.array(F.lit("A line that no document had.")), left))
    found = align.align(old, new)
    count = lambda *kinds: F.count(F.when(F.col("change").isin(*kinds), True))
    moved = F.count(F.when(F.col("change") == "move", True)).alias("moved")
    return found.groupBy("document").agg(
        count("keep").alias("kept"), moved, count("insert").alias("inserted"), count("delete").alias("deleted"), F.countDistinct("id").alias("ids")
    )


QUERIES = {
    "topk_exact": topk_exact,
    "topk_threshold": topk_threshold,
    "topk_filtered": topk_filtered,
    "topk_striped": topk_striped,
    "topk_ann": topk_ann,
    "ann_recall": ann_recall,
    "coded_recall": coded_recall,
    "kept_cells": kept_cells,
    "retrieved_documents": retrieved_documents,
    "embedded_documents": embedded_documents,
    "text_search": text_search,
    "change_set": change_set,
    "aligned_chunks": aligned_chunks,
    "upserted": upserted,
    "synced": synced,
}

_VECTORS = "v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, label FROM embeddings)"


def _topk(k: int, where: str = "true", threshold: float = -1.0) -> str:
    return f"""WITH {_VECTORS}, scored AS (
        SELECT q.vec_id AS qid, c.vec_id AS id, c.label, round(list_cosine_similarity(q.e, c.e), 9) AS s
        FROM v q, v c WHERE {where.replace('label', 'c.label')}
    ), best AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY s DESC, id) AS rank FROM scored WHERE s >= {threshold})
    SELECT qid, id, rank, round(s, 4) AS score FROM best WHERE rank <= {k}"""


_ANN = f"""{_VECTORS}, pivots AS (
        SELECT vec_id AS pv, e FROM v ORDER BY md5(CAST(vec_id AS VARCHAR)), vec_id LIMIT {PIVOTS}
    ), near AS (
        SELECT vec_id, pv, row_number() OVER (
            PARTITION BY vec_id ORDER BY round(list_cosine_similarity(v.e, p.e), 9) DESC, pv) AS nth
        FROM v, pivots p
    ), annscored AS (
        SELECT q.vec_id AS qid, c.vec_id AS id, round(list_cosine_similarity(qv.e, cv.e), 9) AS s
        FROM near q JOIN near c ON q.pv = c.pv AND q.nth <= {PROBES} AND c.nth = 1
        JOIN v qv ON qv.vec_id = q.vec_id JOIN v cv ON cv.vec_id = c.vec_id
    ), annbest AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY s DESC, id) AS rank FROM annscored)"""

_VERSIONS = """old AS (SELECT doc_id AS id, text, source FROM documents WHERE lang <> 'es'), new AS (
        SELECT doc_id AS id, CASE WHEN toxic = 1 THEN text || ' (revised)' ELSE text END AS text, source
        FROM documents LEFT JOIN (SELECT doc_id, toxic FROM labels WHERE toxic = 1) USING (doc_id) WHERE lang <> 'de')"""

ORACLE = {
    "topk_exact": _topk(K),
    "topk_threshold": _topk(5, threshold=0.4),
    "topk_filtered": _topk(K, "label IN (1, 3, 5)"),
    "topk_striped": _topk(K),
    "topk_ann": f"WITH {_ANN} SELECT qid, id, rank, round(s, 4) AS score FROM annbest WHERE rank <= {K}",
    "ann_recall": f"""WITH {_ANN}, exact AS (
        SELECT qid, id FROM (SELECT q.vec_id AS qid, c.vec_id AS id, row_number() OVER (PARTITION BY q.vec_id
            ORDER BY round(list_cosine_similarity(q.e, c.e), 9) DESC, c.vec_id) AS rank FROM v q, v c) WHERE rank <= {K})
        SELECT count(*) AS n_exact, count(a.id) AS n_found, round(count(a.id) / count(*), 4) AS recall
        FROM exact x LEFT JOIN (SELECT * FROM annbest WHERE rank <= {K}) a USING (qid, id)""",
    "coded_recall": f"SELECT {K} * count(*) AS n_exact, true AS enough, true AS pruned FROM embeddings",
    "kept_cells": _topk(K, "label <> 1"),
    "retrieved_documents": f"""SELECT qid, rank, CAST(id AS VARCHAR) AS id, 'label ' || label AS page_content,
        CAST(label AS VARCHAR) AS label, score AS similarity_score
        FROM ({_topk(K)}) t JOIN (SELECT vec_id, label FROM embeddings) l ON l.vec_id = t.id""",
    "embedded_documents": f"""SELECT doc_id, CAST(l[1] AS BIGINT) AS a, CAST(l[5] AS BIGINT) AS e, CAST(l[26] AS BIGINT) AS z
        FROM (SELECT doc_id, {letters_sql('text')} AS l FROM documents)""",
    "text_search": f"""WITH q AS (SELECT item_id, {letters_sql('text')} AS e FROM benchmark),
        d AS (SELECT doc_id, {letters_sql('text')} AS e FROM documents), best AS (
        SELECT item_id AS qid, doc_id AS id, round(list_cosine_similarity(q.e, d.e), 9) AS s,
            row_number() OVER (PARTITION BY item_id ORDER BY round(list_cosine_similarity(q.e, d.e), 9) DESC, doc_id) AS rank
        FROM q, d) SELECT qid, id, rank, round(s, 4) AS score FROM best WHERE rank <= {K}""",
    "change_set": f"""WITH {_VERSIONS} SELECT coalesce(o.id, n.id) AS id,
        CASE WHEN o.id IS NULL THEN 'insert' WHEN n.id IS NULL THEN 'delete' ELSE 'update' END AS change
        FROM old o FULL JOIN new n ON o.id = n.id
        WHERE o.id IS NULL OR n.id IS NULL OR o.text IS DISTINCT FROM n.text OR o.source IS DISTINCT FROM n.source""",
    "aligned_chunks": r"""SELECT CAST(doc_id AS VARCHAR) AS document, n - lost AS kept, 0 AS moved, 1 AS inserted, lost AS deleted, n + 1 AS ids
        FROM (SELECT doc_id, len(string_split(coalesce(text, ''), chr(10))) AS n, CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END AS lost FROM documents)""",
    "upserted": f"WITH {_VERSIONS} SELECT id, md5(text) AS text_md5, source FROM new",
    "synced": f"""WITH {_VERSIONS} SELECT id, md5(text) AS text_md5,
        length(lower(text)) - length(replace(lower(text), 'e', '')) AS e FROM new""",
}
