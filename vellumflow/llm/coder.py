"""Token ids in compressed files: a range coder driven by ids predicted from the last two, the last one, and none.

The ids of a group are dealt to lanes of consecutive ids that are worked on in
step, one array element each. All lanes share one model: a table of the id that
lately followed each pair of ids, and each single id, with a number that says how
sure it is, and how often each id came unforeseen. How sure both are, and
whether they agree, chooses the chances of three cases: the id is that of order
2, that of order 1, or neither. In the last case it is coded by the order-0
frequencies. The model learns after stretches of steps, which grow to
``LEARN``, from the ids of all lanes, and chances are made of its counts after up to ``RECKON`` steps;
so both directions know the same, and whatever does not hang on the id before is done for a stretch at once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellumflow.llm.common import fan_out, new_folder, small_batches
from vellumflow.llm.tokens import library

# Lanes of a group, the least and the most ids of a lane, the most steps after which the tables learn, and the chances.
LANES, FEWEST, BLOCK, LEARN, RECKON = 4096, 64, 1024, 8, 64
IDS = 1 << 16
TWO = 18  # bits of the table of order 2
SURE = 7
CHANCE, CHANCE_BITS = 1 << 12, np.uint64(12)
COUNTS, COUNTS_BITS = 1 << 18, np.uint64(18)
LOW = np.uint64(0xFFFFFFFF)
TOP, FEW = np.uint64((1 << 48) - 1), np.uint64(1 << 32)
U16, U32 = np.uint64(16), np.uint64(32)
END = 2


def _packed(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    return (begin.astype(np.uint64) << U32) | size.astype(np.uint64)


class _Model:
    """What all lanes share."""

    def __init__(self):
        # The id foreseen in each context in the lower 16 bits, and above them how sure that is.
        self.one, self.two = np.zeros(IDS, np.int32), np.zeros(1 << TWO, np.int32)
        # How often each case came in each context, and each id in the last case; and the chances made of that.
        self.cases = np.ones((2 * (SURE + 1) ** 2, 3), np.int64)
        self.seen = np.zeros(IDS, np.int64)
        self._sum_up()

    def _sum_up(self) -> None:
        share = 1 + self.cases * (CHANCE - 3) // self.cases.sum(1, keepdims=True)
        share[:, 2] = CHANCE - share[:, 0] - share[:, 1]
        begin = np.concatenate([0 * share[:, 0], share[:, 0], share[:, 0] + share[:, 1]])
        self.share = _packed(begin, share.T.reshape(-1))
        self.second, self.third = (begin[i * len(share) : (i + 1) * len(share)].astype(np.uint64) for i in (1, 2))
        room, total = COUNTS - IDS, max(int(self.seen.sum()), 1)
        count = 1 + self.seen * room // total
        count[int(self.seen.argmax())] += COUNTS - count.sum()
        self.count, self.of = _packed(np.cumsum(count) - count, count), None

    def lookup(self) -> np.ndarray:
        """The id at each place of the order-0 counts."""
        if self.of is None:
            self.of = np.repeat(np.arange(IDS, dtype=np.int32), (self.count & LOW).astype(np.int64))
        return self.of

    @staticmethod
    def slot(last: np.ndarray, before: np.ndarray) -> np.ndarray:
        mixed = (last.astype(np.uint32) * np.uint32(0x9E3779B1)) ^ (before.astype(np.uint32) * np.uint32(0x85EBCA6B))
        return ((mixed * np.uint32(0xC2B2AE35)) >> np.uint32(32 - TWO)).astype(np.int64)

    @staticmethod
    def context(two: np.ndarray, one: np.ndarray) -> np.ndarray:
        return (((two >> 16) << 4) | ((one >> 16) << 1) | ((two ^ one) & 0xFFFF == 0)).astype(np.int64)

    def learn(self, t: int, slot: np.ndarray, last: np.ndarray, ids: np.ndarray, context: np.ndarray, case: np.ndarray, two: np.ndarray, one: np.ndarray) -> None:
        """From all ids of a stretch that ends before step ``t``. In each context the latest one counts: it makes what was foreseen more or less sure, or takes its place."""
        for table, at, old in ((self.two, slot, two), (self.one, last, one)):
            surer = np.minimum(old + (1 << 16), (SURE << 16) | 0xFFFF)
            table[at] = np.where(old & 0xFFFF == ids, np.where(surer & 0xFFFF == ids, surer, old), np.where(old >> 16 > 0, old - (1 << 16), ids))
        self.cases += 4 * np.bincount(context * 3 + case, minlength=self.cases.size).reshape(-1, 3)
        np.add.at(self.seen, ids[case == 2], 1)
        if t & (t - 1) == 0 or t % RECKON == 0:
            self._sum_up()


def _stretches(longest: int) -> Iterator[tuple[int, int]]:
    begin, size = 0, 1
    while begin < longest:
        yield begin, min(begin + size, longest)
        begin, size = begin + size, min(LEARN, max(1, begin + size))


def _ordered(sizes: list[int]) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Lanes by falling length, their lengths, and how many lanes have each step."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    lens = np.array([sizes[i] for i in order], np.int64)
    return order, lens, np.searchsorted(-lens, -np.arange(int(lens.max(initial=0))), "left")


def encode_blocks(rows: list[np.ndarray]) -> list[bytes]:
    """The payloads of blocks of ids below 65,536, which share a model: only together can they be decoded."""
    order, lens, wide_at = _ordered([len(r) for r in rows])
    longest, lanes = len(wide_at), len(rows)
    ids = np.zeros((longest + 2, lanes), np.int32)  # two steps before the first one, of id 0
    for lane, i in enumerate(order):
        ids[2 : 2 + lens[lane], lane] = rows[i]
    model = _Model()
    low, wide = np.zeros(lanes, np.uint64), np.full(lanes, TOP)
    out, filled = np.zeros((lanes, 2 * longest + 8), np.uint32), np.zeros(lanes, np.int64)

    def put(own, share: np.ndarray, bits: np.uint64) -> None:
        part = wide[own] >> bits
        value, room = low[own] + part * (share >> U32), part * (share & LOW)
        small = np.flatnonzero(room < FEW)
        if len(small):
            lane = small if isinstance(own, slice) else own[small]
            moved, to = value[small], filled[lane]
            out[lane, to] = moved >> U32
            filled[lane] = to + 1
            value[small] = (moved & LOW) << U16
            room[small] <<= U16
        low[own], wide[own] = value, room

    for a, b in _stretches(longest):
        # All ids of the stretch, step by step: where its lanes have ended there are none.
        counts = wide_at[a:b]
        if counts[-1] == lanes:
            flat = lambda x: x.reshape(-1)
        else:
            inside = np.arange(lanes) < counts[:, None]
            flat = lambda x, inside=inside: x[inside]
        now, last, before = flat(ids[a + 2 : b + 2]), flat(ids[a + 1 : b + 1]), flat(ids[a:b])
        slot = model.slot(last, before)
        two, one = model.two[slot], model.one[last]
        context = model.context(two, one)
        other = two & 0xFFFF != now
        case = other.view(np.int8) + (other & (one & 0xFFFF != now))
        share, missed = model.share[case * np.int64(len(model.cases)) + context], np.flatnonzero(case == 2)
        count = model.count[now[missed]]
        ends = np.r_[0, np.cumsum(counts)]
        misses = np.searchsorted(missed, ends)
        for t, m in enumerate(counts.tolist()):
            x, y, u, v = ends[t], ends[t + 1], misses[t], misses[t + 1]
            put(slice(0, m), share[x:y], CHANCE_BITS)
            if v > u:
                put(missed[u:v] - x, count[u:v], COUNTS_BITS)
        model.learn(b, slot, last, now, context, case, two, one)
    every = np.arange(lanes)
    for shift in (32, 16, 0):
        out[every, filled] = (low >> np.uint64(shift)) & np.uint64(0x1FFFF if shift == 32 else 0xFFFF)
        filled += 1
    # A number may hold a carry for the one before it.
    for column in range(int(filled.max(initial=0)) - 1, 0, -1):
        out[:, column - 1] += out[:, column] >> np.uint32(16)
    done: list = [b""] * lanes
    for lane, i in enumerate(order):
        done[i] = (out[lane, : filled[lane]] & np.uint32(0xFFFF)).astype("<u2").tobytes()
    return done


def decode_blocks(payloads: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    """The ids of blocks that were encoded together, whose numbers are known."""
    order, lens, wide_at = _ordered(sizes)
    longest, lanes = len(wide_at), len(payloads)
    width = max(map(len, payloads), default=0) // 2 + 4
    digits = np.zeros((lanes, width), np.uint16)
    for lane, i in enumerate(order):
        own = np.frombuffer(payloads[i], "<u2")
        digits[lane, : len(own)] = own
    model = _Model()
    ids = np.zeros((longest + 2, lanes), np.int32)
    code = (digits[:, 0].astype(np.uint64) << U32) | (digits[:, 1].astype(np.uint64) << U16) | digits[:, 2]
    wide, at, ends_at = np.full(lanes, TOP), np.arange(lanes) * width + 3, np.arange(1, lanes + 1) * width - 1
    digits = digits.reshape(-1)

    def take(own, value: np.ndarray, part: np.ndarray, share: np.ndarray) -> None:
        value, room = value - part * (share >> U32), part * (share & LOW)
        small = np.flatnonzero(room < FEW)
        if len(small):
            lane = small if isinstance(own, slice) else own[small]
            next_ = at[lane]
            value[small] = (value[small] << U16) | digits[np.minimum(next_, ends_at[lane])]
            at[lane] = next_ + 1
            room[small] <<= U16
        code[own], wide[own] = value, room

    for a, b in _stretches(longest):
        counts = wide_at[a:b]
        full = lanes * (b - a)
        slots, contexts, cases = np.empty(full, np.int64), np.empty(full, np.int64), np.empty(full, np.int8)
        twos, ones = np.empty(full, np.int32), np.empty(full, np.int32)
        of, state2, state1, x = model.lookup(), model.two, model.one, 0
        places = np.int64(len(model.cases))
        for t, m in enumerate(counts.tolist(), a + 2):
            own, y = slice(0, m), x + m
            last = ids[t - 1, :m]
            slot = slots[x:y] = model.slot(last, ids[t - 2, :m])
            two, one = state2[slot], state1[last]
            context = model.context(two, one)
            held = code[own]
            part = wide[own] >> CHANCE_BITS
            # Where the code lies, without a division: in the first, the second or the last part.
            case = (held >= part * model.second[context]).view(np.int8) + (held >= part * model.third[context])
            take(own, held, part, model.share[case * places + context])
            now = np.where(case == 0, two, one) & 0xFFFF
            miss = np.flatnonzero(case == 2)
            if len(miss):
                held = code[miss]
                part = wide[miss] >> COUNTS_BITS
                got = of[np.minimum(held // part, np.uint64(COUNTS - 1)).astype(np.int64)]
                take(miss, held, part, model.count[got])
                now[miss] = got
            ids[t, :m] = now
            twos[x:y], ones[x:y], contexts[x:y], cases[x:y] = two, one, context, case
            x = y
        if counts[-1] == lanes:
            now, last = ids[a + 2 : b + 2].reshape(-1), ids[a + 1 : b + 1].reshape(-1)
        else:
            inside = np.arange(lanes) < counts[:, None]
            now, last = ids[a + 2 : b + 2][inside], ids[a + 1 : b + 1][inside]
        model.learn(b, slots[:x], last, now, contexts[:x], cases[:x], twos[:x], ones[:x])
    done: list = [None] * lanes
    for lane, i in enumerate(order):
        done[i] = ids[2 : 2 + lens[lane], lane].copy()
    return done


# One row of a file is a group: where its ids lie in the partition, how many a lane has, their checksum, the documents in it, and the lanes' payloads.
FORMAT = "place long, n_ids int, lane int, crc32 long, started long, doc_ids array<long>, lengths array<int>, sizes array<int>, payload binary"
KINDS = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary()]
NAMES = [x.split()[0] for x in FORMAT.split(", ")]


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())


def write_ids(docs: DataFrame, path: str, tokenizer: str, end: int = END, id: str = "doc_id", text: str = "text") -> None:
    """Write the ids of all texts (null: empty), each with ``end`` behind it, in ascending order of id.

    Texts are range partitioned by id; equal ids are spread by digest and a
    number of their own, so no id is too frequent. A task holds the ids of one
    group of ``LANES`` times ``BLOCK`` ids, and of one batch. Files are Parquet tables of groups (``FORMAT``), so they
    lie wherever Spark can write.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order, most = ["doc_id", "digest", "tie"], LANES * BLOCK
    rows = rows.withColumn("digest", F.xxhash64("text")).withColumn("tie", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(fan_out(spark), *order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, names, sizes, place, started = np.empty(0, np.int32), [], [], 0, 0

        def groups(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, names, sizes, place, started
            n = len(held) if last else len(held) // most * most
            i = 0
            for a in range(0, n, most):
                cut = held[a : min(a + most, n)]
                room, own, parts, before = len(cut), [], [], started
                while room:
                    took = min(room, sizes[i])
                    own.append(names[i])
                    parts.append(took)
                    room -= took
                    sizes[i] -= took
                    started = 0 if not sizes[i] else (before if len(own) == 1 else 0) + took
                    i += not sizes[i]
                lane = max(FEWEST, -(-len(cut) // LANES))
                made = encode_blocks([cut[b : b + lane] for b in range(0, len(cut), lane)])
                row = (place + a, len(cut), lane, _crc(cut), before, own, parts, [len(x) for x in made], b"".join(made))
                yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, KINDS)], names=NAMES)
            held, names, sizes, place = held[n:], names[i:], sizes[i:], place + n

        for batch in batches:
            if not batch.num_rows:
                continue
            ids, lens = library(tokenizer)(batch.column(1))
            held = np.concatenate([held, np.insert(ids, np.cumsum(lens), end).astype(np.int32)])
            names += batch.column(0).to_pylist()
            sizes += (lens + 1).tolist()
            if len(held) >= most:
                yield from groups(False)
        yield from groups(True)

    rows.mapInArrow(run, FORMAT).withColumn("part", F.spark_partition_id()).write.option("compression", "none").parquet(path)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            r = batch.slice(i, 1).to_pylist()[0]
            ends = np.cumsum(r["sizes"]).tolist()
            sizes = [min(r["lane"], r["n_ids"] - a) for a in range(0, r["n_ids"], r["lane"])]
            found = np.concatenate(decode_blocks([r["payload"][a:b] for a, b in zip([0, *ends], ends)], sizes))
            if _crc(found) != r["crc32"]:
                raise ValueError(f"group at {r['place']} of partition {r['part']} is damaged")
            at, data, out = 0, memoryview(np.ascontiguousarray(found, "<u4")).cast("B"), []
            for j, (doc, n) in enumerate(zip(r["doc_ids"], r["lengths"])):
                begin = r["base"] + r["place"] + at - (r["started"] if j == 0 else 0)
                whole = j + 1 < len(r["lengths"]) and not (j == 0 and r["started"])
                out.append((doc, begin, r["base"] + r["place"] + at, n, zlib.crc32(data[4 * at : 4 * (at + n)]), whole))
                at += n
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["doc_id", "start", "at", "n", "crc", "whole"])


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo that of crc32, bits reflected."""
    out, bit = 0, 1 << 31
    while bit:
        if a & bit:
            out ^= b
        bit >>= 1
        b = (b >> 1) ^ 0xEDB88320 if b & 1 else b >> 1
    return out


def joined_crc(parts: list[tuple[int, int]]) -> int:
    """The crc32 of bytes end to end, from the crc32 and number of bytes of each part."""
    total = 0
    for crc, size in parts:
        power, step, n = 1 << 31, 1 << 23, size  # 1, and x to the 8th
        while n:
            if n & 1:
                power = _times(power, step)
            step = _times(step, step)
            n >>= 1
        total = _times(power, total) ^ crc
    return total


def read_ids(stored: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from files of ``write_ids`` read as a table.

    Every group is decoded and its checksum verified. Documents inside one group
    are done there; of those over several groups only lengths and checksums meet.
    """
    small_batches(stored.sparkSession, 500)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = stored.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    pieces = stored.join(F.broadcast(totals), "part").mapInArrow(_pieces, "doc_id long, start long, at long, n long, crc long, whole boolean")
    pieces = pieces.groupBy("doc_id", "start").agg(
        F.sum("n").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("at", "crc", "n"))).alias("parts")
    )

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column(3).to_pylist()
            crc = [p[0]["crc"] if len(p) == 1 else joined_crc([(x["crc"], 4 * x["n"]) for x in p]) for p in parts]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return pieces.mapInArrow(join_up, "doc_id long, start long, n_tokens long, ids_crc32 long")


def stored_ids(docs: DataFrame, tokenizer: str, end: int = END, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write ids to files in the shared folder and read them back: (doc_id, start, n_tokens, ids_crc32).

    Nulls: a null text is empty and has the end id alone; null ids come first.
    Repeated rows are written as often as they come. No rows: no rows. Other
    columns are not looked at.
    """
    path = new_folder(docs.sparkSession, "ids")
    write_ids(docs, path, tokenizer, end, id, text)
    return read_ids(docs.sparkSession.read.schema(f"{FORMAT}, part int").parquet(path))
