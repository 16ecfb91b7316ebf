"""Approximate search over learned cells and coded vectors, in a table that is kept in step with changes.

Cells are means found by rounds of Spark jobs over a bounded sample. A vector is
stored with its cell, with a short code of what lies between it and the middle of the cell, and
whole. A search reads the codes of the nearest cells, keeps a short list by
distance tables, and scores that list exactly. How many cells and how long a list are
measured against exact answers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellumflow.operators.cells import listed, passed, passed_short
from vellumflow.operators.retrieve import CORPUS_BLOCK, HIT_BYTES, QUESTION_BLOCK, TILE, _best, _hit_schema, _packed, _unit, exact_hits, ranked
from vellumflow.session import BROADCAST_BYTES, few, settled

# Rows that cells and codes are learned from, by cell or code, and questions that a search is measured with.
SAMPLE_ROWS, ASKED = 256, 200
SHORT_ROWS = 512
DIGITS = 9


@dataclass(frozen=True)
class Model:
    """Names and middles of cells, and the code books: one for each part of a vector."""

    cells: np.ndarray
    centres: np.ndarray
    books: np.ndarray

    def order(self, unit: np.ndarray, n: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """The ``n`` nearest cells of each vector, nearest first and ties to the first, and their squared distances."""
        far = np.round((unit**2).sum(1)[:, None] + (self.centres**2).sum(1)[None] - 2 * unit @ self.centres.T, DIGITS)
        near = np.argsort(far, axis=1, kind="stable")[:, :n]
        return near, np.maximum(np.take_along_axis(far, near, 1), 0)

    def codes(self, unit: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """For each part of what is left of a vector beyond its cell's middle, the nearest entry of the part's book."""
        left = _parts(unit - self.centres[cell], len(self.books))
        far = np.round((self.books**2).sum(2)[None] - 2 * np.einsum("npd,pcd->npc", left, self.books), DIGITS)
        return far.argmin(2).astype(np.int16)

    def decoded(self, cell: int, codes: np.ndarray) -> np.ndarray:
        """The vectors that codes of one cell stand for; their products with questions are the estimated cosines."""
        parts = self.books[np.arange(len(self.books))[None], codes].reshape(len(codes), -1)
        return self.centres[list(self.cells).index(cell)] + parts[:, : self.centres.shape[1]]

    def scores(self, unit: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Estimated cosines of questions with coded vectors of one cell, from one table of products for each question."""
        tables = np.einsum("qpd,pcd->qpc", _parts(unit, len(self.books)), self.books)
        out = np.repeat((unit @ self.centres[cell])[:, None], len(codes), 1)
        for part in range(len(self.books)):
            out += tables[:, part, codes[:, part]]
        return np.round(out, DIGITS)


def _parts(rows: np.ndarray, n: int) -> np.ndarray:
    """Rows cut in ``n`` parts of equal length, filled with zeros."""
    width = -(-rows.shape[1] // n)
    return np.pad(rows, ((0, 0), (0, n * width - rows.shape[1]))).reshape(len(rows), n, width)


def _vectors(batch: pa.RecordBatch, at: int) -> np.ndarray:
    return _unit(batch.column(at).flatten().to_numpy(), batch.num_rows)


def first_rows(corpus: DataFrame, n: int, id_col: str, vec: str) -> DataFrame:
    """``n`` rows, those first in the order of a hash of their id: the same on every run."""
    order = F.md5(F.col(id_col).cast("string").cast("binary"))
    rows = corpus.where(F.col(vec).isNotNull()).select(F.col(id_col).alias("id"), F.col(vec).alias("embedding"), order.alias("_o"))
    return rows.orderBy("_o", "id").limit(n).drop("_o")


def _means(sample: DataFrame, place: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], old: np.ndarray) -> np.ndarray:
    """One round: every row goes to a key, and the mean of each key's rows replaces its old one. Tasks hand on sums, at most one row per key."""
    n, width = old.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((n, width)), np.zeros(n, np.int64)
        for batch in batches:
            if batch.num_rows:
                key, rows = place(_vectors(batch, 0))
                np.add.at(sums, key, rows)
                counts += np.bincount(key, minlength=n)
        own = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(counts[own]), pa.array(list(sums[own]), pa.list_(pa.float64()))], ["key", "n", "sums"])

    def add(part: pa.Table) -> pa.Table:
        rows = part.column("sums").combine_chunks().flatten().to_numpy().reshape(part.num_rows, width)
        total = pa.array([rows.sum(0)], pa.list_(pa.float64()))
        return pa.table({"key": part.column("key")[:1], "n": pa.array([sum(part.column("n").to_pylist())]), "sums": total})

    schema = "key long, n long, sums array<double>"
    made = sample.select("embedding").mapInArrow(run, schema).groupBy("key").applyInArrow(add, schema).collect()
    new = old.copy()
    for row in made:
        new[row["key"]] = np.array(row["sums"]) / row["n"]
    return new


def fit(corpus: DataFrame, n_cells: int, parts: int = 16, codes: int = 64, rounds: int = 5, id_col: str = "id", vec: str = "embedding") -> Model:
    """Cells and code books, learned from at most ``SAMPLE_ROWS`` rows for each cell or code. Middles and books must fit a broadcast."""
    if n_cells < 1:
        raise ValueError("at least one cell is needed")
    rows = first_rows(corpus, SAMPLE_ROWS * max(n_cells, codes), id_col, vec)
    spark = corpus.sparkSession
    sample = settled(rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "id"))
    first = first_rows(sample, max(n_cells, codes), "id", "embedding").toArrow()
    if not first.num_rows:
        raise ValueError("no vectors: the corpus is empty")
    unit = _unit(first.column("embedding").combine_chunks().flatten().to_numpy(), first.num_rows)
    if n_cells * unit.shape[1] * 8 > BROADCAST_BYTES:
        raise ValueError(f"{n_cells} middles do not fit {BROADCAST_BYTES} bytes")
    centres = unit[:n_cells]
    none = np.zeros((parts, 1, -(-unit.shape[1] // parts)))
    for _ in range(rounds):
        now = Model(np.arange(len(centres)), centres, none)
        centres = _means(sample, lambda x, now=now: (now.order(x)[0][:, 0], x), centres)
    model = Model(np.arange(len(centres)), centres, none)
    near = model.order(unit)[0][:, 0]
    books = _parts(unit - centres[near], parts).transpose(1, 0, 2)[:, :codes]
    offset = np.arange(parts) * books.shape[1]
    for _ in range(rounds):
        now = Model(model.cells, centres, books)

        def place(x: np.ndarray, now: Model = now) -> tuple[np.ndarray, np.ndarray]:
            cell = now.order(x)[0][:, 0]
            return (now.codes(x, cell) + offset).ravel(), _parts(x - now.centres[cell], parts).reshape(-1, books.shape[2])

        books = _means(sample, place, books.reshape(-1, books.shape[2])).reshape(books.shape)
    return Model(model.cells, centres, books)


def encode(corpus: DataFrame, model: Model, id_col: str = "id", vec: str = "embedding") -> DataFrame:
    """(id, embedding, code, far, cell): every vector that is there, with its nearest cell, its code and its squared distance."""
    source = corpus.where(F.col(vec).isNotNull()).select(F.col(id_col).alias("id"), F.col(vec).alias("embedding"))
    schema = T.StructType([source.schema["id"], source.schema["embedding"], *T._parse_datatype_string("code array<smallint>, far double, cell long").fields])
    shared = corpus.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for a in range(0, batch.num_rows, CORPUS_BLOCK):
                part = batch.slice(a, CORPUS_BLOCK)
                unit = _vectors(part, 1)
                near, far = known.order(unit)
                codes = known.codes(unit, near[:, 0])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1) * codes.shape[1], pa.int32()), pa.array(codes.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists, pa.array(far[:, 0]), pa.array(known.cells[near[:, 0]])], schema.fieldNames())

    return source.mapInArrow(run, schema)


def _sized(table: DataFrame) -> DataFrame:
    """(cell, n, slots): one row per cell."""
    return table.groupBy("cell").agg(F.count("*").alias("n")).withColumn("slots", F.ceil(F.col("n") / CORPUS_BLOCK).cast("int"))


def _slotted(table: DataFrame, sizes: DataFrame) -> DataFrame:
    """A cell of any size lies in as many slots as keep each bounded. Sizes are at most one row per middle of the model."""
    return table.join(F.broadcast(sizes.select("cell", "slots")), "cell").withColumn("slot", F.pmod(F.xxhash64("id"), "slots").cast("int")).drop("slots")


def save(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write rows of a coded table by cell; with ``overwrite`` only the cells that they have."""
    placed = _slotted(rows, settled(_sized(rows))).repartition("cell", "slot").drop("slot")
    placed.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("cell").parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a coded table. A cell that was emptied keeps one row without an id, which is left out."""
    found = spark.read.parquet(path)
    return found.withColumn("cell", F.col("cell").cast("long")).where(F.col("id").isNotNull())


def probing_lists(questions: DataFrame, model: Model, probes: int, qid: str = "qid", vec: str = "embedding") -> DataFrame:
    """(qid, embedding, cells): each question with the list of its ``probes`` nearest cells."""
    source = questions.where(F.col(vec).isNotNull()).select(F.col(qid).alias("qid"), F.col(vec).alias("embedding"))
    schema = T.StructType([*source.schema.fields, *T._parse_datatype_string("cells array<long>").fields])
    shared = questions.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            if batch.num_rows:
                near = known.order(_vectors(batch, 1), probes)[0]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), listed(pa.array(known.cells[near.ravel()]), *near.shape)], schema.fieldNames())

    return source.mapInArrow(run, schema)


def probing(questions: DataFrame, model: Model, probes: int, qid: str = "qid", vec: str = "embedding") -> DataFrame:
    """(qid, embedding, cell, nth): the ``probes`` nearest cells of each question."""
    found = probing_lists(questions, model, probes, qid, vec).select("qid", "embedding", F.posexplode("cells").alias("nth", "cell"))
    return found.select("qid", "embedding", "cell", "nth")


def short_lists(questions: DataFrame, table: DataFrame, model: Model, probes: int, short: int, qid: str = "qid", vec: str = "embedding") -> DataFrame:
    """The ``short`` best of each question by estimated cosine (qid, id, score, rank), from the codes of its nearest cells alone."""
    sizes = settled(_sized(table))
    asked = probing(questions, model, probes, qid, vec)
    blocks = max(1, -(-questions.count() // QUESTION_BLOCK))
    asked = asked.withColumn("qblock", F.pmod(F.xxhash64("qid"), F.lit(blocks)).cast("int"))
    wanted = _slotted(table.select("id", "code", "cell"), sizes).join(F.broadcast(asked.select("cell").distinct()), "cell", "left_semi")
    slots = sizes.select("cell", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot"))
    sides = _packed(asked, ["cell", "qblock"], "qid", "embedding", "qids", "qvecs").join(slots, "cell")
    pairs = sides.join(_packed(wanted, ["cell", "slot"], "id", "code", "ids", "codes"), ["cell", "slot"])
    schema = _hit_schema(asked.schema["qid"].dataType, table.schema["id"].dataType)
    shared = questions.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        place = {int(c): i for i, c in enumerate(known.cells)}
        for batch in batches:
            for row in range(batch.num_rows):
                qids, ids = (batch.column(i)[row].values.to_numpy(zero_copy_only=False) for i in (1, 3))
                unit = _unit(batch.column(2)[row].values.to_numpy(), len(qids))
                codes = batch.column(4)[row].values.to_numpy().reshape(len(ids), -1)
                for a in range(0, len(qids), TILE):
                    scores = known.scores(unit[a : a + TILE], place[batch.column(0)[row].as_py()], codes)
                    n = scores.shape[1]
                    floor = np.partition(scores, n - short, axis=1)[:, n - short] if n > short else np.full(len(scores), -np.inf)
                    q, c = np.nonzero(scores >= floor[:, None])
                    q, found, score = _best(q, ids[c], scores[q, c], short)
                    yield pa.RecordBatch.from_arrays([pa.array(qids[a + q]), pa.array(found), pa.array(score)], schema.fieldNames())

    return ranked(pairs.select("cell", "qids", "qvecs", "ids", "codes").mapInArrow(run, schema), short)


def search(
    questions: DataFrame, table: DataFrame, model: Model, k: int = 5, probes: int = 8, short: int = 64, threshold: float = -1.0, qid: str = "qid", vec: str = "embedding"
) -> DataFrame:
    """Top ``k`` by exact cosine of each question's short list: ``(qid, id, score, rank)``, ties to the smaller id.

    Lists that together are longer than the table are not written: the table passes by the questions instead, and what is estimated higher is counted. A
    list as long as the table leaves out nothing, so the rows of the cells are scored exactly without one.
    """
    n, rows = questions.count(), table.count()
    if n * short > rows:
        asked = probing_lists(questions, model, probes, qid, vec)
        if short >= rows:
            return passed(asked, table, n, k, threshold)
        shared = questions.sparkSession.sparkContext.broadcast(model)
        return passed_short(asked, table, n, k, threshold, short, lambda cell, codes: shared.value.decoded(cell, codes))
    short_list = few(settled(short_lists(questions, table, model, probes, short, qid, vec).select("qid", "id")), HIT_BYTES)
    met = table.select("id", F.col("embedding").alias("found")).join(short_list, "id")
    asked = questions.where(F.col(vec).isNotNull()).select(F.col(qid).alias("qid"), F.col(vec).alias("asked"))
    rows = met.join(asked, "qid").select("qid", "id", "asked", "found")
    schema = _hit_schema(rows.schema["qid"].dataType, rows.schema["id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = np.round((_vectors(batch, 2) * _vectors(batch, 3)).sum(1), DIGITS)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score)], schema.fieldNames())

    return ranked(rows.mapInArrow(run, schema).where(F.col("score") >= threshold), k)


def tuned(table: DataFrame, model: Model, questions: DataFrame, k: int, target: float = 0.9, margin: float = 0.04, qid: str = "qid", vec: str = "embedding") -> tuple[int, int]:
    """(probes, short): the fewest cells and the shortest list with which ``target`` plus ``margin`` of the true hits are found.

    Measured on at most ASKED questions, which are searched exactly once: the place of each true hit's
    cell among the question's cells, and its place by estimated cosine.
    """
    asked = settled(first_rows(questions, ASKED, qid, vec).withColumnRenamed("id", "qid"))
    true = settled(exact_hits(asked, table.select("id", "embedding"), k).select("qid", "id"))
    cells = len(model.cells)
    held = true.join(table.select("id", "cell"), "id")
    at = probing(asked, model, cells).select("qid", "cell", "nth").join(held, ["qid", "cell"]).select("nth").collect()
    # Half of what may be missed is given to the cells, the other half to the lists.
    share = 1 - (1 - min(target + margin, 1.0)) / 2
    places = sorted(r["nth"] for r in at)
    probes = places[min(len(places) - 1, int(np.ceil(share * len(places))) - 1)] + 1 if places else cells
    rows, n = table.count(), SHORT_ROWS
    while True:
        listed = short_lists(asked, table, model, probes, n).join(F.broadcast(true), ["qid", "id"]).select("rank").collect()
        seen = sorted(r["rank"] for r in listed)
        wanted = int(np.ceil(min(target + margin, 1.0) * len(places)))
        if len(seen) >= wanted or n >= rows:
            return probes, (seen[wanted - 1] if len(seen) >= wanted else rows)
        n *= 4


def scored_share(questions: DataFrame, table: DataFrame, model: Model, probes: int, qid: str = "qid", vec: str = "embedding") -> float:
    """Share of all pairs of question and row whose code a search looks at."""
    sizes = _sized(table)
    seen = probing(questions, model, probes, qid, vec).join(F.broadcast(sizes), "cell").agg(F.sum("n")).first()[0] or 0
    return seen / max(1, questions.where(F.col(vec).isNotNull()).count() * table.count())


# --- a table in step with changes ----------------------------------------------------------


def _halves(rows: DataFrame, cell: int) -> np.ndarray | None:
    """Two middles for a cell that has grown too large, from at most SHORT_ROWS of its rows; none if these are all equal."""
    first = first_rows(rows.where(F.col("cell") == cell), SHORT_ROWS, "id", "embedding").toArrow()
    unit = _unit(first.column("embedding").combine_chunks().flatten().to_numpy(), first.num_rows)
    far = ((unit - unit[0]) ** 2).sum(1)
    if far.max() < 1e-9:
        return None
    middles = np.stack([unit[0], unit[far.argmax()]])
    for _ in range(8):
        side = ((unit[:, None] - middles[None]) ** 2).sum(2).argmin(1)
        if len(set(side.tolist())) < 2:
            break
        middles = np.stack([unit[side == i].mean(0) for i in (0, 1)])
    return middles


def apply_changes(spark: SparkSession, path: str, model: Model, upserts: DataFrame, deletes: DataFrame, most: int, rounds: int = 16) -> Model:
    """Bring the coded table at ``path`` in step and return its model.

    ``upserts`` (id, embedding) are new or changed rows, ``deletes`` (id) go. Only cells that lose or
    gain a row are written again. A cell of more than ``most`` rows gets two
    middles; then all rows that are nearer to one of them move, also from those other cells
    that can have any by the triangle inequality: a cell whose rows lie within r of its middle has none if the new middle
    is more than 2r away. Empty cells leave the model. So the table always is what ``encode`` gives for its rows, and a
    search over it equals one over a table built anew. A cell of equal rows is not
    split; its slots keep blocks bounded.

    A null embedding takes its row out. The new contents are written beside the table before any
    of its cells is replaced, so that a run that failed can be repeated.
    """
    table = load(spark, path)
    gone = settled(upserts.select("id").union(deletes.select("id")).distinct())
    few_gone = few(gone)
    new = settled(encode(upserts, model))
    old_cells = table.join(few_gone, "id", "left_semi").select("cell").distinct()
    touched = {r["cell"] for r in old_cells.union(new.select("cell").distinct()).distinct().collect()}  # at most one per middle
    kept = table.where(F.col("cell").isin(sorted(touched))).join(few_gone, "id", "left_anti")
    rows = settled(kept.select(*new.columns).union(new))
    whole: set[int] = set()
    for _ in range(rounds):
        rest = table.where(~F.col("cell").isin(sorted(touched))).select(*rows.columns)
        shape = rows.union(rest).groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()  # one per middle
        large = [r["cell"] for r in shape if r["n"] > most and r["cell"] not in whole]
        if not large:
            break
        cells, centres, changed = list(model.cells), model.centres.copy(), []
        for cell in large:
            halves = _halves(rows.union(rest), cell)
            if halves is None:
                whole.add(cell)
                continue
            centres[cells.index(cell)] = halves[0]
            centres = np.concatenate([centres, halves[1:]])
            cells.append(max(cells) + 1)
            changed += [cell, cells[-1]]
        if not changed:
            break
        before, model = model, Model(np.array(cells), centres, model.books)
        fresh = model.centres[[cells.index(c) for c in changed]]
        reach = {r["cell"]: np.sqrt(r["far"]) for r in shape}
        near = {c for c, r in reach.items() if (np.sqrt(((fresh - before.centres[list(before.cells).index(c)]) ** 2).sum(1)) <= 2 * r + 1e-6).any()}
        near = sorted(near | set(large))
        inside = F.col("cell").isin(near)
        moved = settled(encode(rows.where(inside).union(rest.where(inside)), model))
        reached = {r["cell"] for r in moved.select("cell").distinct().collect()}
        # The other rows of cells that were not read so far and now get some come along.
        more = rest.where(F.col("cell").isin(sorted(reached - touched - set(near))))
        rows = settled(rows.where(~inside).union(moved).union(more))
        touched |= reached | set(near) | set(changed)
    live = {r["cell"] for r in rows.select("cell").distinct().collect()}
    stored = {r["cell"] for r in table.select("cell").distinct().collect()}
    emptied = sorted(touched & stored - live)
    marks = spark.createDataFrame([(c,) for c in emptied], "cell long").select(*(F.col(f.name) if f.name == "cell" else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema))
    save(rows.union(marks), path, "overwrite")
    keep = np.array([c in live or c in stored - touched for c in model.cells.tolist()], bool)
    return Model(model.cells[keep], model.centres[keep], model.books) if keep.any() else model
