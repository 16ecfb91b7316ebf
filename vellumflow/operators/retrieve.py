"""Similarity search for a whole table of questions.

A few questions go to all tasks as one matrix, and the corpus passes by once.
More go to stripes of the corpus, which is shuffled once (``pruned``). Either way
a task keeps only the best ``k`` per question while it reads, so no table of
pairs ever exists.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellumflow.session import BROADCAST_BYTES, SPLITS_PER_CORE, few, settled

# Questions that a block of the corpus meets at once, and rows of one matrix product.
QUESTION_BLOCK = 16384
TILE = 1024
CORPUS_BLOCK = 4096
# Rows of the corpus in one matrix product: with a tile of questions they stay in a core's cache.
PRODUCT = 1024
# New hits are sorted in with the best when they are one for so many questions.
MERGED = 8
# Pairs that a task judges: a search of more makes more tasks, not longer ones.
TASK_PAIRS = 1 << 34
# Pairs scored one by one at a time.
PAIRS = 65536
# Upper estimate of a hit row in memory, keys of 100 characters included.
HIT_BYTES = 400
SCORE_DIGITS = 9


def _packed(rows: DataFrame, keys: list[str], id_col: str, vec: str, ids: str, vecs: str) -> DataFrame:
    """One block row per key; the caller's keys keep blocks bounded."""
    got = rows.groupBy(*keys).agg(F.collect_list(F.struct(F.col(id_col).alias("i"), F.col(vec).alias("v"))).alias("_b"))
    return got.select(
        *keys,
        F.transform("_b", lambda b: b.i).alias(ids),
        F.flatten(F.transform("_b", lambda b: b.v)).alias(vecs),
    )


def _unit(flat: np.ndarray, n: int) -> np.ndarray:
    rows = flat.astype(np.float64).reshape(n, -1)
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norms == 0, 1.0, norms)


def _best(q: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int):
    """Keep the best ``k`` per question; equal scores go to the smaller id."""
    order = np.lexsort((ids, -scores, q))
    q, ids, scores = q[order], ids[order], scores[order]
    first = np.r_[True, q[1:] != q[:-1]] if len(q) else np.zeros(0, bool)
    starts = np.flatnonzero(first)
    rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)]))
    keep = rank < k
    return q[keep], ids[keep], scores[keep]


def _hit_schema(qid: T.DataType, id: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("qid", qid), T.StructField("id", id), T.StructField("score", T.DoubleType())])


def _slack(corpus: np.ndarray) -> float:
    """More than a product of single precision with rows of ``corpus`` is off."""
    squares = (corpus**2).sum(1)
    longest = np.sqrt(squares.max(initial=1.0, where=~np.isnan(squares)))
    return (corpus.shape[1] + 8) * 2.0**-23 * longest + 2 * 10.0**-SCORE_DIGITS


def _reaching(unit: np.ndarray, corpus: np.ndarray, rough: np.ndarray, floor: np.ndarray, more: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(question, row, score) of all pairs whose score may reach the question's ``floor``; where ``more``, at least the best ``k``.

    A product of single precision tells which pairs are worth it: it is off by less than ``slack``.
    Scores are of double precision.
    """
    slack, known = _slack(corpus), ~np.isnan(corpus).any(1)
    near = unit.astype(np.float32) @ rough.T
    n = near.shape[1]
    # A row that holds no number is near to nothing, and hides no other.
    near[:, ~known] = -np.inf
    if n > k and more.any():
        short = np.flatnonzero(more)
        floor = floor.copy()
        floor[short] = np.maximum(floor[short], np.partition(near[short], n - k, axis=1)[:, n - k] - slack)
    least = np.maximum((floor - slack).astype(np.float32), np.finfo(np.float32).min)
    # Of most questions not even the best row reaches the floor: one pass tells, and the others are looked at pair by pair.
    some = np.flatnonzero(~(near.max(axis=1) < least)) if n else np.zeros(0, np.int64)
    at = np.flatnonzero(near[some] >= least[some, None])
    q, c = np.divmod(at, max(n, 1))
    q = some[q]
    if len(at) * 16 > near.size:
        return q, c, np.round((unit @ corpus.T)[q, c], SCORE_DIGITS)
    scores = [(unit[q[a : a + PAIRS]] * corpus[c[a : a + PAIRS]]).sum(1) for a in range(0, len(at), PAIRS)]
    return q, c, np.round(np.concatenate(scores) if scores else np.zeros(0), SCORE_DIGITS)


class _Running:
    """The best ``k`` so far for some questions, in tiles that keep each matrix product bounded."""

    def __init__(self, qids: np.ndarray, unit: np.ndarray, k: int, threshold: float) -> None:
        self.qids, self.unit, self.k, self.threshold = qids, unit, k, threshold
        tiles = -(-len(qids) // TILE)
        # Of each tile the hits, the best first and then what came since, and what the k-th hit of each question scores.
        self.hits: list[list[tuple]] = [[] for _ in range(tiles)]
        self.waiting = [0] * tiles
        self.floor = [np.full(len(unit[t * TILE : (t + 1) * TILE]), threshold, np.float64) for t in range(tiles)]
        self.full = [np.zeros(len(f), bool) for f in self.floor]

    def meet(self, ids: np.ndarray, corpus: np.ndarray) -> None:
        for a in range(0, len(ids), PRODUCT):
            self._meet(ids[a : a + PRODUCT], corpus[a : a + PRODUCT])

    def _meet(self, ids: np.ndarray, corpus: np.ndarray) -> None:
        rough = corpus.astype(np.float32)
        for tile in range(len(self.hits)):
            unit = self.unit[tile * TILE : (tile + 1) * TILE]
            q, c, scores = _reaching(unit, corpus, rough, self.floor[tile], ~self.full[tile], self.k)
            kept = scores >= self.threshold
            if kept.any():
                self.hits[tile].append((q[kept], ids[c[kept]], scores[kept]))
                self.waiting[tile] += int(kept.sum())
                if self.waiting[tile] * MERGED >= len(unit) or not self.full[tile].all():
                    self._merge(tile)

    def _merge(self, tile: int) -> None:
        q, ids, scores = _best(*(np.concatenate(x) for x in zip(*self.hits[tile])), self.k)
        self.hits[tile], self.waiting[tile] = [(q, ids, scores)], 0
        full = np.bincount(q, minlength=len(self.floor[tile])) >= self.k
        lowest = np.full(len(full), np.inf)
        np.minimum.at(lowest, q, scores)
        self.floor[tile][full], self.full[tile] = np.maximum(lowest[full], self.threshold), full

    def out(self) -> Iterator[pa.RecordBatch]:
        for tile, hits in enumerate(self.hits):
            if hits:
                self._merge(tile)
                q, ids, scores = self.hits[tile][0]
                yield pa.RecordBatch.from_arrays([pa.array(self.qids[tile * TILE + q]), pa.array(ids), pa.array(scores)], ["qid", "id", "score"])


def _block_hits(pairs: DataFrame, k: int, threshold: float) -> DataFrame:
    """Best ``k`` hits per question of the block pairs seen by each task.

    Pairs come sorted by question block, so a task holds one block's results at a time.
    """
    schema = _hit_schema(pairs.schema["qids"].dataType.elementType, pairs.schema["ids"].dataType.elementType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: _Running | None = None
        for batch in batches:
            for row in range(batch.num_rows):
                qids = batch.column(0)[row].values.to_numpy(zero_copy_only=False)
                ids = batch.column(2)[row].values.to_numpy(zero_copy_only=False)
                if not len(qids) or not len(ids):
                    continue
                if held is None or not np.array_equal(held.qids, qids):
                    if held is not None:
                        yield from held.out()
                    held = _Running(qids, _unit(batch.column(1)[row].values.to_numpy(), len(qids)), k, threshold)
                held.meet(ids, _unit(batch.column(3)[row].values.to_numpy(), len(ids)))
        if held is not None:
            yield from held.out()

    return pairs.select("qids", "qvecs", "ids", "vecs").mapInArrow(run, schema)


def tasks_for(n: int, rows: int) -> int:
    """Tasks that keep ``n`` questions against ``rows`` rows within TASK_PAIRS each."""
    return max(1, -(-n * rows // TASK_PAIRS))


def _one_pass(questions: DataFrame, corpus: DataFrame, k: int, threshold: float, qid: str, id_col: str, vec: str) -> DataFrame:
    """Best ``k`` of each task's corpus rows for all of a few questions, which go to the tasks once as one matrix."""
    asked = questions.where(F.col(vec).isNotNull()).select(qid, vec).toArrow()
    source = corpus.where(F.col(vec).isNotNull()).select(id_col, vec)
    if asked.num_rows > TILE:
        # Many questions make long tasks: the corpus is dealt to several of them a core, and to more where these still had too many pairs.
        parts = max(SPLITS_PER_CORE * corpus.sparkSession.sparkContext.defaultParallelism, tasks_for(asked.num_rows, corpus.count()))
        source = source.repartition(parts, id_col)
    schema = _hit_schema(questions.schema[qid].dataType, source.schema[id_col].dataType)
    qids = asked.column(0).to_numpy()
    flat = asked.column(1).combine_chunks()
    flat = flat.flatten() if isinstance(flat, pa.Array) else pa.concat_arrays([c.flatten() for c in flat.chunks]) if flat.num_chunks else pa.array([], pa.float32())
    shared = questions.sparkSession.sparkContext.broadcast((qids, _unit(flat.to_numpy(), len(qids)) if len(qids) else np.zeros((0, 1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Running(*shared.value, k, threshold)
        if not len(held.qids):
            return
        for batch in batches:
            for at in range(0, batch.num_rows, CORPUS_BLOCK):
                part = batch.slice(at, CORPUS_BLOCK)
                held.meet(part.column(0).to_numpy(zero_copy_only=False), _unit(part.column(1).flatten().to_numpy(), part.num_rows))
        yield from held.out()

    return source.mapInArrow(run, schema)


def ranked(hits: DataFrame, k: int) -> DataFrame:
    """Top ``k`` per question by score, then id; Spark limits each group before the shuffle."""
    order = Window.partitionBy("qid").orderBy(F.desc("score"), F.asc("id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _width(questions: DataFrame, vec: str) -> tuple[int, int]:
    """Number of questions and length of their vectors."""
    row = questions.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vec)).alias("d")).first()
    return row["n"], max(row["d"] or 0, 1)


def exact_hits(
    questions: DataFrame,
    corpus: DataFrame,
    k: int = 5,
    threshold: float = -1.0,
    where: Column | None = None,
    qid: str = "qid",
    id_col: str = "id",
    vec: str = "embedding",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Exact top ``k`` by cosine: ``(qid, id, score, rank)``.

    ``where`` filters the corpus before scoring and reaches its scan. While the
    questions are small they go to every task as one matrix: the corpus is read
    once, nothing of it is moved, and a task gives ``k`` rows for each question.
    Beyond that the corpus is shuffled once, to stripes that only those questions reach which can have a hit there.
    """
    n, width = _width(questions, vec)
    if where is not None:
        corpus = corpus.where(where)
    if n * (width * 4 + 16) <= broadcast_bytes:
        return ranked(_one_pass(questions, corpus, k, threshold, qid, id_col, vec), k)
    from vellumflow.operators.pruned import pruned_hits  # it builds on this module

    return pruned_hits(questions, corpus, k, threshold, qid=qid, id_col=id_col, vec=vec)


def with_rows(
    hits: DataFrame,
    corpus: DataFrame,
    columns: list[str],
    id_col: str = "id",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Fetch columns of the hit rows, last of all.

    Hits are few next to the corpus. They are kept and counted; while they fit
    they go to the corpus, whose rows then stay where they are.
    """
    rows = corpus.select(F.col(id_col).alias("id"), *[c for c in columns if c != id_col])
    return rows.join(few(settled(hits), HIT_BYTES, broadcast_bytes), "id")


def as_documents(hits: DataFrame, text_col: str, id_col: str = "id", others: list[str] | None = None) -> DataFrame:
    """Hit rows as retrieved documents: text, key, and the rest as metadata with the score."""
    metadata = F.map_from_arrays(
        F.array(F.lit("similarity_score"), *[F.lit(c) for c in others or []]),
        F.array(F.col("score").cast("string"), *[F.col(c).cast("string") for c in others or []]),
    )
    return hits.select(
        "qid",
        "rank",
        F.struct(
            F.col(id_col).cast("string").alias("id"),
            F.col(text_col).alias("page_content"),
            metadata.alias("metadata"),
        ).alias("document"),
    )
