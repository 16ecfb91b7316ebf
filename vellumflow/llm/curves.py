"""Nearest neighbours along shifted space-filling curves."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellumflow.llm.common import fan_out, hashed_share, small_batches, written


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of whole numbers below 2**bits; columns times bits must be under 64.

    The transform between axes and the transposed index goes from the highest
    bit to the lowest, over all rows at once.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            up = (x[i] & q) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(up, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


class Curves:
    """Several Hilbert orders of the same vectors, each of another projection and shifted against the grid."""

    def __init__(self, sample: np.ndarray, dim: int, curves: int, axes: int = 8, bits: int = 7, seed: int = 42):
        random, axes = np.random.default_rng(seed), min(axes, dim)
        self.bits, self.turn, self.low, self.step = bits, [], [], []
        for _ in range(curves):
            turn = np.linalg.qr(random.normal(size=(dim, axes)))[0]
            shown = sample @ turn if len(sample) else np.zeros((1, axes))
            low, high = np.quantile(shown, [0.001, 0.999], axis=0)
            wide = np.maximum(high - low, 1e-12) * 1.5
            self.turn.append(turn)
            self.low.append(low - random.random(axes) * (wide - (high - low)))
            self.step.append((1 << bits) / wide)

    def keys(self, x: np.ndarray) -> np.ndarray:
        """One row of keys for each curve. Beyond the sample's range a vector lies at the border of the grid."""
        top = (1 << self.bits) - 1
        return np.stack([hilbert_keys(np.clip((x @ t - a) * s, 0, top), self.bits) for t, a, s in zip(self.turn, self.low, self.step)])


def _packed(vectors: DataFrame, id: str, embedding: str) -> tuple[DataFrame, int, str]:
    """(vec_id, packed) of the distinct vectors that take part, their dimension and number type."""
    kind = "<f4" if isinstance(vectors.schema[embedding].dataType.elementType, T.FloatType) else "<f8"
    own = F.col("_v")
    rows = vectors.select(F.col(id).cast("long").alias("vec_id"), F.col(embedding).alias("_v")).where(
        F.col("vec_id").isNotNull()
        & own.isNotNull()
        & F.forall(own, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(own, lambda x: x != 0)
    )
    sizes = rows.groupBy(F.size(own).alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    dim = sizes[0]["n"] if sizes else 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(kind) + 0.0
            data = pa.FixedSizeBinaryArray.from_buffers(pa.binary(dim * values.itemsize), batch.num_rows, [None, pa.py_buffer(values)])
            yield pa.RecordBatch.from_arrays([batch.column(0), data.cast(pa.binary())], names=["vec_id", "packed"])

    return rows.where(F.size(own) == dim).mapInArrow(pack, "vec_id long, packed binary").distinct(), dim, kind


def _matrix(column: pa.Array, dim: int, kind: str) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, kind).reshape(-1, dim).astype(np.float64)


def _best(distance: np.ndarray, least: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k smallest distances, ties to the smaller id."""
    if len(distance) > k:
        own = np.flatnonzero(distance <= np.partition(distance, k - 1)[k - 1])
    else:
        own = np.arange(len(distance))
    return own[np.lexsort((least[own], distance[own]))[:k]]


def _distances(rows: np.ndarray, one: np.ndarray) -> np.ndarray:
    apart = rows - one
    return np.sqrt(np.einsum("ij,ij->i", apart, apart))


def nearest(
    vectors: DataFrame,
    k: int = 10,
    every: int = 100,
    id: str = "vec_id",
    embedding: str = "embedding",
    curves: int = 16,
    wanted: float = 0.97,
    sample: int = 2000,
    probes: int = 64,
    block: int = 4096,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row whose id is divisible by ``every``, by Euclidean distance.

    Distinct vectors are the points, each with its k + 1 smallest ids, which is
    all that a search can return of them. Every point is placed on ``curves``
    Hilbert curves of projections to a few axes; the grids come from a bounded
    ``sample``, the points are range partitioned by curve and key, and prefix
    sums of partitions number them. A query looks at all points at most a window
    away on any curve. The points lie in blocks of ``block`` places; a query
    goes to the blocks that its window touches, where exact distances on the
    original vectors keep its best k + 1; these are merged over the curves.

    The window follows the data: an exact scan for ``probes`` query points gives
    their true neighbours, and the window is as wide as the share ``wanted`` of
    these needs on the best of the curves. It is small where vectors form
    clusters, and a large part of the table where they are close to random.

    Vectors that are null, zero, or hold a null or a number that is not finite
    take no part, nor do those of another dimension than the most frequent one,
    nor null ids. Repeated rows count once; a row is no neighbour of any row of
    its own id. Ties go to the smaller id. With fewer candidates all are given.
    No rows: no rows. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    packed, dim, kind = _packed(vectors, id, embedding)
    rows = written(packed.withColumn("uid", F.md5("packed")), "vectors")
    first = Window.partitionBy("uid").orderBy("vec_id")
    few = rows.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1)
    queries = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.col("uid").alias("quid"))
    asked = queries.select(F.col("quid").alias("uid")).distinct().withColumn("asked", F.lit(True))
    points = written(
        few.groupBy("uid").agg(F.any_value("packed").alias("packed"), F.array_sort(F.collect_list("vec_id")).alias("ids"))
        .join(asked, "uid", "left")
        .select("uid", "packed", "ids", F.col("ids")[0].alias("least"), F.coalesce("asked", F.lit(False)).alias("asked")),
        "points",
    )
    fitted = points.where(hashed_share(F.col("uid"), points.count(), sample)).orderBy("uid").limit(sample).select("packed").toArrow()
    model = Curves(_matrix(fitted["packed"], dim, kind), dim, curves)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for curve, keys in enumerate(model.keys(_matrix(batch.column(1), dim, kind))):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), curve, np.int32)), pa.array(keys), *batch.columns], names=["curve", "key", *batch.schema.names])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            yield batch.append_column("place", pa.array(np.arange(at, at + batch.num_rows)))
            at += batch.num_rows

    columns = "uid string, packed binary, least long, asked boolean"
    order = ["curve", "key", "uid"]
    line = (
        points.select("uid", "packed", "least", "asked")
        .mapInArrow(keyed, f"curve int, key long, {columns}")
        .repartitionByRange(fan_out(spark), *order)
        .sortWithinPartitions(*order)
        .mapInArrow(placed, f"curve int, key long, {columns}, place long")
        .withColumn("part", F.spark_partition_id())
    )
    line = written(line, "curves")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = line.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    line = line.join(F.broadcast(base), "part").select("curve", (F.col("base") + F.col("place")).alias("at"), "uid", "packed", "least", "asked")

    window = _window(points, line, k, wanted, probes, dim, kind)
    candidates = line.select(F.expr(f"at div {block}").alias("block"), "at", "uid", "packed", "least", F.lit(False).alias("query"))
    reach = F.expr(f"sequence(greatest(at - {window}, 0L) div {block}, (at + {window}) div {block})")
    sent = line.where("asked").select(F.explode(reach).alias("block"), "at", "uid", "packed", "least", F.lit(True).alias("query"))

    def search(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("query", "ascending"), ("at", "ascending")])
        asks = table["query"].to_numpy()
        n = int((~asks).sum())
        at, least, x = table["at"].to_numpy(), table["least"].to_numpy(), _matrix(table["packed"], dim, kind)
        uid = table["uid"].combine_chunks()
        who, found, scores = [], [], []
        for i in range(n, len(at)):
            a, b = np.searchsorted(at[:n], at[i] - window), np.searchsorted(at[:n], at[i] + window, "right")
            if a < b:
                distance = _distances(x[a:b], x[i])
                best = _best(distance, least[a:b], k + 1)
                who.append(np.full(len(best), i))
                found.append(a + best)
                scores.append(distance[best])
        none = np.empty(0, np.int64)
        who, found = np.concatenate([none, *who]), np.concatenate([none, *found])
        return pa.table(
            {"quid": uid.take(pa.array(who)), "uid": uid.take(pa.array(found)), "least": least[found], "score": np.concatenate([np.empty(0), *scores])}
        )

    hits = candidates.union(sent).groupBy("block").applyInArrow(search, "quid string, uid string, least long, score double").distinct()
    best = Window.partitionBy("quid").orderBy("score", "least", "uid")
    hits = hits.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1)
    listed = hits.join(points.select("uid", "ids"), "uid").select("quid", "score", F.explode("ids").alias("vec_id"))
    ranked = Window.partitionBy("query_id").orderBy("score", "vec_id")
    answers = queries.join(listed, "quid").where("query_id != vec_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return answers.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _window(points: DataFrame, line: DataFrame, k: int, wanted: float, probes: int, dim: int, kind: str) -> int:
    """The distance along the best curve within which the share ``wanted`` of the true neighbours of some query points lie."""
    asked = points.where("asked")
    asked = asked.where(hashed_share(F.col("uid"), asked.count(), probes)).orderBy("uid").limit(probes).select("uid", "packed").toArrow()
    if not len(asked):
        return k + 1
    x, names = _matrix(asked["packed"], dim, kind), asked["uid"].to_pylist()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, least, uid = _matrix(batch.column(1), dim, kind), batch.column(2).to_numpy(), batch.column(0)
            for name, one in zip(names, x):
                distance = _distances(rows, one)
                best = _best(distance, least, k + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(best)), uid.take(pa.array(best)), pa.array(distance[best]), pa.array(least[best])], names=["quid", "uid", "score", "least"]
                )

    near = points.select("uid", "packed", "least").mapInArrow(scan, "quid string, uid string, score double, least long")
    nth = F.row_number().over(Window.partitionBy("quid").orderBy("score", "least"))
    truth = near.withColumn("nth", nth).where((F.col("nth") <= k + 1) & (F.col("quid") != F.col("uid"))).select("quid", "uid").toArrow().to_pylist()
    if not truth:
        return k + 1
    wanted_uids = sorted({*names, *(t["uid"] for t in truth)})
    chosen = points.sparkSession.createDataFrame([(u,) for u in wanted_uids], "uid string")
    places: dict[str, dict[int, int]] = {}
    for r in line.select("uid", "curve", "at").join(F.broadcast(chosen), "uid").collect():
        places.setdefault(r["uid"], {})[r["curve"]] = r["at"]
    gaps = sorted(min(abs(at - places[t["uid"]][c]) for c, at in places[t["quid"]].items()) for t in truth)
    return max(k + 1, int(1.1 * gaps[min(len(gaps) - 1, int(wanted * len(gaps)))]) + 1)
