"""Concatenate-and-cut packing: two passes of prefix sums give every token its place."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellumflow.llm.common import arrow_list, by_text, fan_out, written
from vellumflow.llm.tokens import library

END, LENGTH = 1, 2048
# Bytes of text that a worker encodes at once.
SLICE = 1 << 20


def tokenized(docs: DataFrame, tokenizer: str, end: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, place): the ids of each whole text (null: empty), then ``end``, and how many ids the partition has before them."""

    def make(texts: pa.Array) -> list[pa.Array]:
        ids, lens = library(tokenizer)(texts)
        ends = np.cumsum(lens)
        return [arrow_list(np.insert(ids, ends, end), lens + 1)]

    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("_text"))
    return by_text(rows, "_text", "ids array<int>, place long", make, SLICE, _with_places, stays=False)


def _with_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at = 0
    for batch in batches:
        lens = np.diff(batch.column(1).offsets.to_numpy())
        ends = at + np.cumsum(lens)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends - lens, pa.int64())], names=["doc_id", "ids", "place"])
        at = int(ends[-1]) if len(ends) else at


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end: int = END, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of documents in sequences of ``length`` tokens; only the last sequence has padding.

    First pass: texts are encoded where they are read, and each row is stored
    with its partition and its place in it. The partitions' totals, as many as
    partitions, are summed up; partition plus place is then the global offset
    of a document, and windows of fixed length are cut by arithmetic alone. A
    sequence over a border of two partitions gets records from both, with its
    number and their offsets in it; ``sequences`` puts them together. No text
    or token is shuffled. Only encoding is done in Python, one worker a task.

    Columns: doc_id, start, length, doc_tokens, sequence_id, offset, piece (the
    ids). Nulls: a null text is empty and gives one piece, the end id; a null
    id stays. Repeated rows are packed as often as they come. No rows: no rows.
    Other columns are not looked at.
    """
    stored = written(tokenized(docs, tokenizer, end, id, text).withColumn("part", F.spark_partition_id()), "packed")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = stored.groupBy("part").agg(F.sum(F.size("ids")).alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = stored.join(F.broadcast(totals), "part").select("doc_id", "ids", (F.col("base") + F.col("place")).alias("at"), F.size("ids").cast("long").alias("doc_tokens"))
    cut = placed.withColumn("sequence_id", F.explode(F.expr(f"sequence(at div {length}, (at + doc_tokens - 1) div {length})")))
    cut = cut.withColumn("start", F.greatest(F.col("sequence_id") * length - F.col("at"), F.lit(0)))
    cut = cut.withColumn("length", F.least((F.col("sequence_id") + 1) * length - F.col("at"), F.col("doc_tokens")) - F.col("start"))
    return cut.select(
        "doc_id", "start", "length", "doc_tokens", "sequence_id", (F.col("at") + F.col("start") - F.col("sequence_id") * length).alias("offset"),
        F.slice("ids", (F.col("start") + 1).cast("int"), F.col("length").cast("int")).alias("piece"),
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token sequences themselves. A group is one sequence, so it is bounded by its length."""
    gathered = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "piece"))).alias("parts"))
    return gathered.select("sequence_id", F.flatten(F.col("parts.piece")).alias("ids"))


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with the crc32 of their ids as little-endian unsigned 32-bit integers in place of the ids."""
    names = [f.name for f in pieces.schema if f.name != "piece"]
    kinds = T.StructType([*(pieces.schema[n] for n in names), T.StructField("ids_crc32", T.LongType())])
    rows = pieces.select(*names, "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            piece = batch.column(len(names))
            offsets, data = piece.offsets.to_pylist(), memoryview(np.ascontiguousarray(piece.values.to_numpy(), "<u4")).cast("B")
            crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(crc, pa.int64())], names=[*names, "ids_crc32"])

    return rows.mapInArrow(run, kinds)
