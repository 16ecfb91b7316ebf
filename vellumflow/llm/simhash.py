"""SimHash fingerprints, and links between near ones by a grid join over bit counts of segments."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellumflow.llm.common import by_text, fan_out, unused, written
from vellumflow.llm.components import components

SHINGLE, SEED, SEGMENT, DISTANCE = 3, 42, 4, 2
# Members of one cell beyond which its links are found by shared values one bit away.
DENSE = 512
PRIME = np.uint64(0x9E3779B97F4A7C15)
BITS = np.array([np.uint64(1) << np.uint64(i) for i in range(64)])


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits; one is set if it is set in over half of the hashes of the word shingles."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, seed)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lens + 1) - 1
    starts = (ends - lens)[: len(words) - shingle + 1].tolist()
    one = xxhash.xxh64_intdigest
    hashes = np.array([one(line[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :].tolist())], "<u8")
    counts = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 16):
        part = hashes[a : a + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the fingerprint of each whole text (null: empty) as a signed 64-bit number."""

    def make(texts: pa.Array) -> list[pa.Array]:
        made = [fingerprint(x, shingle) for x in texts.cast(pa.binary()).to_pylist()]
        return [pa.array(np.array(made, np.uint64).view(np.int64))]

    return by_text(docs, text, f"{out} long", make)


def _cells(fps: np.ndarray, segment: int = SEGMENT) -> tuple[np.ndarray, np.ndarray]:
    """The cells in which each fingerprint stands: that of its bit counts by segment, and all one step away.

    The Manhattan distance of the counts of two fingerprints is at most the
    number of bits in which they differ. At two steps or fewer both stand in a
    common cell. A cell is named by a hash of its counts; cells that share a
    name only add candidates.
    """
    parts = 64 // segment
    bits = np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    counts = bits.reshape(len(fps), parts, segment).sum(2)
    weights = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i in range(parts)], np.uint64)
    home = (counts.astype(np.uint64) * weights).sum(1, dtype=np.uint64)
    cells, whose = [home], [np.arange(len(fps))]
    for i in range(parts):
        up, down = np.flatnonzero(counts[:, i] < segment), np.flatnonzero(counts[:, i] > 0)
        cells += [home[up] + weights[i], home[down] - weights[i]]
        whose += [up, down]
    return np.concatenate(cells), np.concatenate(whose)


def _near(fps: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one cell, verified to be near, that connect all near ones of each cell. Rows are sorted by cell."""
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    begin = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    size = np.diff(np.r_[begin, len(cell)])
    last = np.repeat(begin + size, size)
    at, step = np.flatnonzero(np.repeat((size > 1) & (size <= DENSE), size)), 1
    while len(at):  # all pairs that lie ``step`` rows apart
        at = at[at + step < last[at]]
        near = at[np.bitwise_count(fps[at] ^ fps[at + step]) <= DISTANCE]
        left.append(near)
        right.append(near + step)
        step += 1
    for i in np.flatnonzero(size > DENSE):
        a, b = _dense(fps[begin[i] : begin[i] + size[i]])
        left.append(begin[i] + a)
        right.append(begin[i] + b)
    return np.concatenate(left), np.concatenate(right)


def _dense(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for one cell of any size, in linear work: near ones share a value at most one bit from either, and all that share one are near.

    The shared values are taken in as many passes as keep each of them small.
    """
    left, right, passes = [], [], -(-len(fps) // (1 << 14))
    for k in range(passes):
        values, whose = [], []
        for flip in (np.uint64(0), *BITS):
            value = fps ^ flip
            own = np.flatnonzero((value * PRIME >> np.uint64(32)) % np.uint64(passes) == k)
            values.append(value[own])
            whose.append(own)
        value, row = np.concatenate(values), np.concatenate(whose)
        order = np.argsort(value, kind="stable")
        value, row = value[order], row[order]
        first = np.r_[True, value[1:] != value[:-1]]
        head = row[np.flatnonzero(first)][np.cumsum(first) - 1]
        left.append(head[~first])
        right.append(row[~first])
    return np.concatenate(left), np.concatenate(right)


def _labels(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least row that each row is connected with."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        np.minimum.at(new, label[left], least)
        np.minimum.at(new, label[right], least)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held_cell, held = np.empty(0, np.int64), np.empty(0, np.uint64)

    def made(cell: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        label = _labels(len(fps), *_near(fps, cell))
        own = np.flatnonzero(label != np.arange(len(fps)))
        pairs = np.unique(np.stack([fps[own], fps[label[own]]]), axis=1).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    for batch in batches:
        held_cell = np.concatenate([held_cell, batch.column(0).to_numpy()])
        held = np.concatenate([held, batch.column(1).to_numpy().view(np.uint64)])
        if len(held) and held_cell[0] != held_cell[-1]:
            cut = int(np.searchsorted(held_cell, held_cell[-1]))
            yield made(held_cell[:cut], held[:cut])
            held_cell, held = held_cell[cut:], held[cut:]
    if len(held):
        yield made(held_cell, held)


def links(fps: DataFrame, fp: str = "fp") -> DataFrame:
    """(a, b): links that connect all distinct fingerprints that differ in two bits or fewer.

    Every fingerprint goes to its cell of the grid of segment counts and the
    neighbouring ones, at most 33 rows for each; cells meet in sorted partitions
    and candidates are verified on all 64 bits. A cell gives fewer links than
    it has members. No cell is cut: dense ones are worked on in another way.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for a in range(0, len(values), 4096):
                part = values[a : a + 4096]
                cell, whose = _cells(part)
                yield pa.RecordBatch.from_arrays([pa.array(cell.view(np.int64)), pa.array(part[whose].view(np.int64))], names=["cell", "fp"])

    cells = fps.select(fp).where(F.col(fp).isNotNull()).distinct().mapInArrow(spread, "cell long, fp long")
    met = cells.repartition(fan_out(fps.sparkSession), "cell").sortWithinPartitions("cell")
    return met.mapInArrow(_links, "a long, b long").distinct()


def classes(known: DataFrame) -> DataFrame:
    """(fp, root, least, component_id) of each distinct fingerprint in ``known(doc_id, fp)``.

    Equal fingerprints meet first, with their least id, so copies cost one row
    each however many there are. ``root`` names the component.
    """
    least = written(known.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = components(links(least))
    rows = least.join(roots, least.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    return rows.join(rows.groupBy("root").agg(F.min("least").alias("component_id")), "root")


def near_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id): each row with its fingerprint and the smallest id reachable over links of at most two bits.

    Texts are read once and never shuffled.
    Nulls: a null text is empty, and empty texts have fingerprint 0, linked like
    any other; a null id is a component's name only where there is no other.
    Repeated rows come as often as given. No rows: no rows. Other columns are
    not looked at.
    """
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("_text"))
    known = written(fingerprints(rows, "_text", "fp", shingle).drop("_text"), "fingerprints")
    return known.join(classes(known).select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` without near-duplicates: of each component the row of smallest id stays, with all its columns.

    Which rows stay is settled on ids and fingerprints alone; texts then meet
    these by id and fingerprint, so that large groups are spread. Of several rows
    of that id and fingerprint one stays. Nulls as in ``near_groups``.
    """
    fp, stay_id, stay_fp, nth = (unused(docs, c) for c in ("_fp", "_stay", "_stay_fp", "_nth"))
    known = written(fingerprints(docs, text, fp, shingle), "fingerprints")
    found = classes(known.select(F.col(id).alias("doc_id"), F.col(fp).alias("fp")))
    first = found.groupBy("root").agg(F.min(F.struct(F.isnull("least").alias("last"), "least", "fp")).alias("first"))
    stay = first.select(F.col("first.least").alias(stay_id), F.col("first.fp").alias(stay_fp))
    rows = known.join(stay, F.col(fp).eqNullSafe(F.col(stay_fp)) & F.col(id).eqNullSafe(F.col(stay_id)), "left_semi")
    at = F.row_number().over(Window.partitionBy(id, fp).orderBy(*(F.xxhash64(F.col(c)) for c in docs.columns)))
    return rows.withColumn(nth, at).where(F.col(nth) == 1).drop(nth, fp)


def hex_of(fp: str = "fp") -> object:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
