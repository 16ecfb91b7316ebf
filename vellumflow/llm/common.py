"""What several of these operators need: settings, table reading, Arrow maps over text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellumflow.session import new_folder, shared_dir

__all__ = ["Gather", "arrow_list", "by_text", "fan_out", "new_folder", "shared_dir", "table", "written"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fan_out(spark: SparkSession) -> int:
    """Partitions that the session wants after a shuffle."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a Parquet table in the shared folder, and read from there: lineage is cut, executors may go."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def whole(text: str) -> Column:
    """A text column, null as the empty text."""
    return F.coalesce(F.col(text), F.lit(""))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let Arrow batches hold at most ``rows`` rows and 8 MB, or one row, where the session has no such limits of its own: whole texts are long."""
    for name, usual, value in (("maxRecordsPerBatch", "10000", rows), ("maxBytesPerBatch", "67108864b", "8m")):
        if spark.conf.get(f"spark.sql.execution.arrow.{name}", usual) == usual:
            spark.conf.set(f"spark.sql.execution.arrow.{name}", value)


def hashed_share(key: Column, n: int, wanted: int) -> Column:
    """A condition that about ``8 * wanted`` of ``n`` rows meet, by a hash of ``key``; all do where there are fewer.

    Before a bounded sample is taken in the order of a hash: without it every task
    would hand on a sample of its own.
    """
    share = min(1.0, 8 * wanted / max(n, 1))
    return F.lit(True) if share == 1.0 else F.pmod(F.xxhash64(key, F.lit(1)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))


def by_text(
    df: DataFrame, text: str, added: str, make: Callable[[pa.Array], list[pa.Array]], most: int = 4 << 20, then: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None, stays: bool = True
) -> DataFrame:
    """``df`` with further columns that ``make`` builds from an array of texts (null: empty).

    ``make`` gets slices of at most ``most`` bytes, or one text, so what it
    holds is bounded by the largest single text. Nothing is shuffled. A column that
    has the name of an added one gives way to it. ``then`` appends the last of the added
    columns to a partition's batches in the same worker, where a second map would keep a
    second worker for each task. The text itself goes unless it ``stays``.
    """
    small_batches(df.sparkSession)
    kinds = T._parse_datatype_string(added)
    names = {f.name.lower() for f in kinds}
    at = df.columns.index(text)
    kept = [i for i, c in enumerate(df.columns) if c.lower() not in names and (stays or i != at)]
    schema = T.StructType([*(df.schema[i] for i in kept), *kinds.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = pc.fill_null(batch.column(at), "")
            for a, b in _slices(pc.binary_length(values).to_pylist(), most):
                made = make(values.slice(a, b - a))
                old = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*(old.column(i) for i in kept), *made], names=schema.names[: len(kept) + len(made)])
                del made, old
                pa.default_memory_pool().release_unused()

    return df.mapInArrow(run if then is None else lambda batches: then(run(batches)), schema)


def _slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    a, held = 0, 0
    for i, n in enumerate(sizes):
        if i > a and held + n > most:
            yield a, i
            a, held = i, 0
        held += n
    if sizes:
        yield a, len(sizes)


def arrow_list(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Lists of int32 of the given lengths."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32, copy=False)))


class Gather:
    """A growing table of number sequences with vectorised look-up by row.

    ``most`` bounds the numbers held: beyond it the owner starts a new table.
    """

    def __init__(self, most: int = 8 << 20):
        self.most, self.rows, self.flat, self.offsets = most, 0, np.empty(1 << 16, np.int32), np.zeros(1 << 14, np.int64)

    def full(self) -> bool:
        return self.offsets[self.rows] + 2 * self.rows > self.most

    def add(self, flat: np.ndarray, lens: np.ndarray) -> None:
        begin, n = int(self.offsets[self.rows]), len(lens)
        if begin + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty(max(len(self.flat), len(flat)), np.int32)])
        if self.rows + n + 1 > len(self.offsets):
            self.offsets = np.concatenate([self.offsets, np.empty(max(len(self.offsets), n), np.int64)])
        self.flat[begin : begin + len(flat)] = flat
        self.offsets[self.rows + 1 : self.rows + 1 + n] = begin + np.cumsum(lens)
        self.rows += n

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All numbers of the rows in order, and how many each row has."""
        begin = self.offsets[rows]
        lens = self.offsets[rows + 1] - begin
        ends = np.cumsum(lens)
        at = np.arange(int(ends[-1]) if len(ends) else 0)
        return self.flat[at + np.repeat(begin - (ends - lens), lens)], lens


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts end to end, and the length of each."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2] if len(texts) else None
    return (np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8))[offsets[0] : offsets[-1]], np.diff(offsets)


def joined(flat: np.ndarray, lens: np.ndarray, rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequences put together from ``rows`` of a table of sequences, ``counts`` rows for each."""
    table = Gather()
    table.add(flat, lens)
    ids, n = table.take(rows)
    ends = np.zeros(len(n) + 1, np.int64)
    np.cumsum(n, out=ends[1:])
    at = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=at[1:])
    return ids, np.diff(ends[at])
