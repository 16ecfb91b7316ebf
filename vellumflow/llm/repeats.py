"""Removal of long byte strings that documents repeat, by distributed sorting of sampled suffixes.

Only the first ``WINDOW`` bytes of a suffix matter, so sorting is bounded in
depth. Equal windows hold equal sampled strings: of the strings of ``GRAM`` bytes
in a window the one of least hash is sampled, so all occurrences of a window
sample the same one. First the sampled strings of all documents are sorted and
named; a window whose sampled string no other document has is discarded, which
loses nothing. Then the windows that remain are sorted, and neighbours in that
order with equal prefixes are one group; all but those of its first document go.

Documents lie in blocks, in the order of their ids. Rows of one id may fill many
blocks. Only hashes leave a block, sorted and packed by bucket, each once for a
block however often it comes there, and one bit for each comes back. So no string
is too frequent. With each hash go two bits: whether its least document is the
first or the last of the block, whose ids go with the block; only these can be
documents of other blocks too.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellumflow.llm.common import fan_out, new_folder, small_batches, unused, written

WINDOW, GRAM = 50, 24
BLOCK_BYTES = 2 << 20
# What a row counts besides its text.
ROW_BYTES = 64
# Bytes of text for each bucket of hashes.
BUCKET_BYTES = 16 << 20
A, B, C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one number; short at the end."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    out = np.empty(len(data) + 8, np.uint64)
    for k in range(8):
        part = padded[k : k + (len(padded) - k) // 8 * 8].view("<u8")
        own = out[k::8]
        own[:] = part[: len(own)]
    return out[: len(data)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(29)
    x *= B
    x ^= x >> np.uint64(32)
    return x


def _samples(words: np.ndarray) -> np.ndarray:
    """The least hash of the strings of ``GRAM`` bytes in the window from each position; short arrays give none."""
    n = len(words) - WINDOW + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    least = words[: n + WINDOW - GRAM].copy()
    for k in range(8, GRAM, 8):
        least *= A
        least ^= words[k : k + len(least)]
    least = _mixed(least * A)
    width, reach = 1, WINDOW - GRAM + 1
    while 2 * width <= reach:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    return np.minimum(least[:n], least[reach - width : reach - width + n])


def _window_hashes(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the windows from the given positions: 64 bits, and eight more."""
    one, two = words[at], np.full(len(at), C)
    for k in (*range(8, WINDOW - 8, 8), WINDOW - 8):
        part = words[at + k]
        one *= A
        one ^= part
        one ^= one >> np.uint64(31)
        two += part
        two *= B
    return _mixed(one * A), (_mixed(two ^ words[at]) >> np.uint64(56)).astype(np.uint8)


class _Hashes:
    """Distinct hashes of one block in order, which of them each given one is, and the least document of each."""

    def __init__(self, value: np.ndarray, doc: np.ndarray, more: np.ndarray | None = None):
        self.more = np.zeros(len(value), np.uint8) if more is None else more
        order = np.lexsort((doc, self.more, value)) if more is not None else np.lexsort((doc, value))
        v, m, d = value[order], self.more[order], doc[order]
        new = np.ones(len(v), bool)
        new[1:] = (v[1:] != v[:-1]) | (m[1:] != m[:-1])
        begin = np.flatnonzero(new)
        self.value, self.more, self.least = v[begin], m[begin], d[begin]
        nth = np.cumsum(new) - 1
        self.row = np.empty(len(v), np.int64)
        self.row[order] = nth
        self.shared = np.zeros(len(begin), bool)  # in two documents of this block
        self.shared[nth[d != self.least[nth]]] = True

    def packed(self, bits: int, first: int, last: int) -> Iterator[tuple[int, bytes, bytes]]:
        """For each bucket, by the highest bits, the hashes' remaining bytes, one place of all after another, and their two bits."""
        if not len(self.value):
            return
        bucket = (self.value >> np.uint64(64 - bits)).astype(np.int64)
        planes = np.concatenate([self.value.astype(">u8").view(np.uint8).reshape(-1, 8)[:, bits // 8 :], self.more[:, None]], axis=1)
        begin = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        for a, b in zip(begin, [*begin[1:], len(bucket)]):
            edges = np.packbits(np.stack([self.least[a:b] == first, self.least[a:b] == last]), axis=1)
            yield int(bucket[a]), np.ascontiguousarray(planes[a:b].T).tobytes(), edges.tobytes()


def _met(earlier_only: bool, width: int) -> Callable[[pa.Table], pa.Table]:
    """For the hashes that blocks have in one bucket: a bit for each that another block, or an earlier document of one, has too."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        blobs = table["packed"].to_pylist()
        sizes = [len(x) // width for x in blobs]
        rows = np.concatenate([np.frombuffer(x, np.uint8).reshape(width, n).T for x, n in zip(blobs, sizes)])
        value = np.zeros((len(rows), 8), np.uint8)
        value[:, 9 - width :] = rows[:, :-1]
        key, more = value.view(">u8").reshape(-1).astype(np.uint64), rows[:, -1]
        order = np.argsort(key, kind="stable")  # runs of blocks in order, merged
        k, m = key[order], more[order]
        same = (k[1:] == k[:-1]) & (m[1:] == m[:-1])
        hit = np.zeros(len(k), bool)
        hit[1:] = same
        if earlier_only:  # blocks, and so the documents of a run, are in order: the first is the least
            rank = _ranks(table, sizes)[order]
            begin = np.maximum.accumulate(np.where(hit, 0, np.arange(len(k))))
            hit &= rank > rank[begin]
        else:
            hit[:-1] |= same
        found = np.empty(len(k), bool)
        found[order] = hit
        ends = np.cumsum(sizes)
        bits = [np.packbits(found[b - n : b]).tobytes() for b, n in zip(ends, sizes)]
        return pa.table({"block": table["block"], "bucket": table["bucket"], "bits": pa.array(bits, pa.binary())})

    return run


def _ranks(table: pa.Table, sizes: list[int]) -> np.ndarray:
    """A number for the least document of each hash, in the order of ids, and equal for equal ids.

    Ids inside a block, between its first and last one, are in no other block and share a number.
    """
    ids = np.stack([table["first"].to_numpy(), table["last"].to_numpy()])
    nth = 2 * np.unique(ids, return_inverse=True)[1].reshape(2, -1)
    out = np.repeat(nth[0] + 1, sizes)
    a = 0
    for i, (n, edges) in enumerate(zip(sizes, table["edges"].to_pylist())):
        first, last = np.unpackbits(np.frombuffer(edges, np.uint8).reshape(2, -1), axis=1, count=n).astype(bool)
        out[a : a + n][last] = nth[1, i]
        out[a : a + n][first] = nth[0, i]
        a += n
    return out


class _Block:
    """Documents of one block: their bytes end to end, and what is known of them so far."""

    def __init__(self, data: bytes, ends: np.ndarray, ids: list, digests: np.ndarray, bits: int):
        self.data, self.ends, self.bits = np.frombuffer(data, np.uint8), ends, bits
        null = np.array([x is None for x in ids], bool)
        rank = np.array([0 if x is None else x for x in ids], np.int64)
        self.doc = np.unique(rank, return_inverse=True)[1].astype(np.int64)
        self.size = np.diff(ends, prepend=0)
        self.live = ~null & (self.size >= WINDOW)
        # The first and the last document that asks, and their ids.
        self.edges = [f(x[self.live], initial=y) for x in (self.doc, rank) for f, y in ((np.min, np.iinfo(np.int64).max), (np.max, np.iinfo(np.int64).min))]
        self.asking = np.flatnonzero(self.live)
        self.texts = _Hashes(digests[self.asking], self.doc[self.asking])

    def drop_copies(self, found: np.ndarray) -> None:
        """Mark documents whose whole text an earlier one has; their windows are all in that one."""
        row = self.texts.row
        copy = np.zeros(len(self.live), bool)
        copy[self.asking] = found[row] | (self.doc[self.asking] > self.texts.least[row])
        self.copy = copy
        self.live &= ~copy

    def sample(self) -> None:
        self.words = _words(self.data)
        sampled = _samples(self.words)
        use = np.repeat(self.live, self.size)[: len(sampled)]
        # No window begins in the last bytes of a document.
        for end, size in zip(self.ends.tolist(), self.size.tolist()):
            use[max(0, end - min(size, WINDOW - 1)) : end] = False
        self.at = np.flatnonzero(use)
        value = sampled[self.at]
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (np.diff(self.at) != 1)
        self.run = np.cumsum(new) - 1
        begin = np.flatnonzero(new)
        self.whose = np.searchsorted(self.ends, self.at, "right")
        # Least hashes are small numbers: mixed once more, they fill all buckets alike.
        self.names = _Hashes(_mixed(value[begin] * C), self.doc[self.whose[begin]])

    def discard(self, found: np.ndarray) -> None:
        """Keep windows whose sampled string another document has."""
        alive = (found | self.names.shared)[self.names.row][self.run]
        self.at, self.whose = self.at[alive], self.whose[alive]
        value, more = _window_hashes(self.words, self.at)
        self.windows = _Hashes(value, self.doc[self.whose], more)

    def removed(self, found: np.ndarray) -> np.ndarray:
        """Which bytes go."""
        row = self.windows.row
        at = self.at[found[row] | (self.doc[self.whose] > self.windows.least[row])]
        cover = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + WINDOW, -1)
        return (np.cumsum(cover[:-1]) > 0) | np.repeat(self.copy, self.size)


def _bits_of(hashes: _Hashes, bits: int, given: list | None) -> np.ndarray:
    """The bits that came back, in the order of the hashes."""
    out = np.zeros(len(hashes.value), bool)
    if len(out) and given:
        bucket = (hashes.value >> np.uint64(64 - bits)).astype(np.int64)
        for x in given:
            a, b = np.searchsorted(bucket, [x["bucket"], x["bucket"] + 1])
            out[a:b] = np.unpackbits(np.frombuffer(x["bits"], np.uint8), count=b - a).astype(bool)
    return out


def _blocks(rows: DataFrame, id: str, text: str) -> DataFrame:
    """Rows in ascending order of id, gathered to blocks: a table bucketed by block, so that joins with it do not move it.

    Rows of one id, or of none, are dealt over partitions and blocks like all others.
    """
    spark = rows.sparkSession
    names = rows.columns
    at_text = names.index(text)
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(fan_out(spark), F.col(id), F.col("_tie"))
    dealt = dealt.drop("_tie").sortWithinPartitions(F.col(id))
    kinds = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("data", T.BinaryType()),
            *T._parse_datatype_string("ends array<long>, digests array<long>").fields,
            *(T.StructField(f"c{i}", T.ArrayType(f.dataType)) for i, f in enumerate(rows.schema) if i != at_text),
        ]
    )
    out = kinds.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, nth = TaskContext.get().partitionId() << 32, 0
        held: list[pa.RecordBatch] = []
        size = 0

        def block() -> pa.RecordBatch:
            nonlocal nth
            table = pa.Table.from_batches(held).combine_chunks()
            texts = [b"" if x is None else x for x in table.column(at_text).cast(pa.binary()).to_pylist()]
            digests = [int.from_bytes(hashlib.blake2b(x, digest_size=8).digest(), "little", signed=True) for x in texts]
            lists = [table.column(i).combine_chunks() for i in range(len(names)) if i != at_text]
            lists = [x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in lists]
            lists = [pa.array(np.cumsum([len(x) for x in texts]), pa.int64()), pa.array(digests, pa.int64()), *lists]
            nth += 1
            span = pa.array([0, len(texts)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array([first + nth - 1], pa.int64()), pa.array([b"".join(texts)], pa.binary()), *(pa.ListArray.from_arrays(span, x) for x in lists)], names=out
            )

        for batch in batches:
            lens = [0 if x is None else len(x) for x in batch.column(at_text).cast(pa.binary()).to_pylist()]
            a = 0
            for i, n in enumerate(lens):
                if size >= BLOCK_BYTES:
                    held.append(batch.slice(a, i - a))
                    yield block()
                    held, size, a = [], 0, i
                size += n + ROW_BYTES
            held.append(batch.slice(a))
        if held and sum(len(b) for b in held):
            yield block()

    name = f"blocks_{uuid.uuid4().hex}"
    packed = dealt.mapInArrow(run, kinds)
    packed.write.option("compression", "zstd").option("path", new_folder(spark, "blocks")).bucketBy(fan_out(spark), "block").saveAsTable(name)
    _forget_shuffles(spark)
    return spark.table(name)


def _forget_shuffles(spark: SparkSession) -> None:
    """Spark deletes the files of a shuffle when its plan is garbage: make it look for garbage."""
    spark.sparkContext._jvm.System.gc()


def _answers(blocks: DataFrame, known: DataFrame | None, step: int, bits: int) -> DataFrame:
    """(block, b0, b1, ...): with the answers known so far, those of the next step.

    Steps: whole texts, sampled strings, windows. The first and last ask which
    hashes a document of smaller id in another block has, the second which any other block has.
    """
    need = ["ends", "digests", "c_id"] + (["data"] if step else [])
    source = blocks.select("block", *need)
    if known is not None:
        source = source.join(known.hint("shuffle_hash"), "block", "left")
    names = source.columns

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch, names):
                hashes, (first, last, first_id, last_id) = _worked(row, bits, step)
                made = list(hashes.packed(bits, first, last))
                columns = [[x[0] for x in made], *([x] * len(made) for x in (row["block"], first_id, last_id))]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x, pa.int64()) for x in columns), *(pa.array([x[i] for x in made], pa.binary()) for i in (1, 2))],
                    names=["bucket", "block", "first", "last", "packed", "edges"],
                )

    asked = source.mapInArrow(ask, "bucket long, block long, first long, last long, packed binary, edges binary")
    width = 9 - bits // 8
    met = asked.groupBy("bucket").applyInArrow(_met(step != 1, width), "block long, bucket long, bits binary")
    new = met.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias(f"b{step}"))
    if known is not None:
        new = known.join(new, "block", "full")
    out = written(new, "answers")
    _forget_shuffles(blocks.sparkSession)
    return out


def _rows(batch: pa.RecordBatch, names: list[str]) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield {n: batch.column(j)[i] for j, n in enumerate(names)} | {"block": batch.column(names.index("block"))[i].as_py()}
        pa.default_memory_pool().release_unused()


def _worked(row: dict, bits: int, step: int) -> tuple[_Hashes, list] | _Block:
    """The hashes that a block asks for in this step and its first and last documents, or the block after all steps."""
    data = row["data"].as_buffer() if "data" in row else b""
    made = _Block(data, row["ends"].values.to_numpy(), row["c_id"].values.to_pylist(), row["digests"].values.to_numpy().view(np.uint64), bits)
    given = lambda k: row[f"b{k}"].as_py()
    if step == 0:
        return made.texts, made.edges
    made.drop_copies(_bits_of(made.texts, bits, given(0)))
    made.sample()
    if step == 1:
        return made.names, made.edges
    made.discard(_bits_of(made.names, bits, given(1)))
    if step == 2:
        return made.windows, made.edges
    made.gone = made.removed(_bits_of(made.windows, bits, given(2)))
    return made


def dedup(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``kept`` (bytes) in place of the text, and n_bytes, n_removed and n_spans.

    Every byte goes that lies in a string of 50 bytes which also starts in a row
    of a smaller id; strings are judged on the input. Texts are shuffled once,
    to their blocks. A block holds about 2 MB, more only for one
    longer text. Windows are told apart by 72 bits of hashes.

    Nulls: a null text is empty; rows of a null id lose nothing and make no other
    row lose anything. Rows of one id take nothing from each other. Empty and
    short texts stay. No rows: no rows. Columns named like an added one are
    replaced; all others stay.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.drop(*({"kept", "n_bytes", "n_removed", "n_spans"} - {id, text}))
    key = unused(rows, "_key")
    rows = rows.withColumn(key, F.col(id).cast("long"))
    names = rows.columns
    at_text = names.index(text)
    total = docs.select(F.sum(F.octet_length(text))).first()[0] or 0
    bits = max(6, (total // BUCKET_BYTES).bit_length())
    blocks = _blocks(rows, key, text).withColumnRenamed(f"c{names.index(key)}", "c_id")
    known = None
    for step in range(3):
        known = _answers(blocks, known, step, bits)
    source = blocks.join(known.hint("shuffle_hash"), "block", "left")
    inside, others = source.columns, [i for i, n in enumerate(names) if i != at_text and n != key]
    schema = T.StructType([*(rows.schema[i] for i in others), *T._parse_datatype_string("n_bytes long, n_removed long, n_spans long, kept binary").fields])
    out = schema.names

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch, inside):
                block = _worked(row, bits, 3)
                made: list[list] = [[], [], [], []]
                begin = 0
                for end in block.ends.tolist():
                    gone = block.gone[begin:end]
                    starts = gone.copy()
                    starts[1:] &= ~gone[:-1]
                    for column, x in zip(made, (end - begin, int(gone.sum()), int(starts.sum()), block.data[begin:end][~gone].tobytes())):
                        column.append(x)
                    begin = end
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([*(row[f"c{i}"].values for i in others), *(pa.array(c, k) for c, k in zip(made, kinds))], names=out)

    return source.mapInArrow(cut, schema)


def valid_text(kept: str) -> Column:
    """Bytes as text; what is left of a character that was cut shows as the replacement character."""
    return F.make_valid_utf8(F.col(kept).cast("string"))
