"""Byte-pair encoding and decoding with padded matrices.

Pieces of about equal length lie as rows of one matrix. In every round each row
merges its leftmost pair of lowest rank, so all rows lose one column and the
matrix stays dense; rows without a pair leave it. Pairs are found in an
open-addressing table that is itself made of arrays.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellumflow.llm.common import arrow_list, by_text, joined, text_bytes
from vellumflow.llm.tokens import Encoder, stretches

NONE = np.int32(2**31 - 1)
PAD = 0xFFFF
# Rows longer than this merge all equal pairs of lowest rank in one round, where that is the same.
LONG = 512
PRIME = np.uint64(0x9E3779B97F4A7C15)


class Pairs:
    """Look-up of ordered pairs of ids below 65,535: their rank, and the id they merge to."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray):
        keys = self._key(left, right)
        self.bits = max(8, int(np.ceil(np.log2(max(1, len(keys)) * 3))))
        size = 1 << self.bits
        self.keys = np.full(size, np.uint64(2**63), np.uint64)
        self.rank, self.merged = np.full(size, NONE, np.int32), np.zeros(size, np.int32)
        rest, at, self.probes = np.arange(len(keys)), self._slot(keys), 0
        while len(rest):
            self.probes += 1
            free = self.keys[at] == np.uint64(2**63)
            _, won = np.unique(at[free], return_index=True)
            won = np.flatnonzero(free)[won]
            slot, own = at[won], rest[won]
            self.keys[slot], self.rank[slot], self.merged[slot] = keys[own], rank[own], merged[own]
            left_over = np.ones(len(rest), bool)
            left_over[won] = False
            rest, at = rest[left_over], (at[left_over] + 1) & (size - 1)

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint64) << np.uint64(16)) | right.astype(np.uint64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * PRIME) >> np.uint64(64 - self.bits)).astype(np.int64)

    def slots(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Where each pair lies; a slot of rank NONE if nowhere."""
        keys = self._key(left, right)
        at = self._slot(keys)
        empty = np.uint64(2**63)
        found = self.keys[at]
        wrong = (found != keys) & (found != empty)
        flat, keys = at.reshape(-1), keys.reshape(-1)
        rest = np.flatnonzero(wrong.reshape(-1))
        while len(rest):
            flat[rest] = (flat[rest] + 1) & ((1 << self.bits) - 1)
            found = self.keys[flat[rest]]
            rest = rest[(found != keys[rest]) & (found != empty)]
        return at

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        at = self.slots(left, right)
        return np.where(self.keys[at] == self._key(left, right), self.rank[at], NONE)


def merge_all(flat: np.ndarray, lens: np.ndarray, pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
    """The merged ids of rows of start ids, both given end to end with the length of each row."""
    begin = np.cumsum(lens) - lens
    made: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # rows, their ids end to end, their lengths
    own = np.flatnonzero(lens < 2)
    made.append((own, flat[begin[own[lens[own] == 1]]], lens[own]))
    low = 1
    while low < LONG:
        own, most = np.flatnonzero((lens > low) & (lens <= 2 * low)), max(1, (1 << 20) // (2 * low))
        for a in range(0, len(own), most):
            part = own[a : a + most]
            n = lens[part]
            columns = np.arange(int(n.max()))
            inside = columns < n[:, None]
            ids = np.full(inside.shape, PAD, np.int32)
            ids[inside] = flat[(begin[part][:, None] + columns)[inside]]
            _merge_bucket(ids, part, pairs, made)
        low *= 2
    for i in np.flatnonzero(lens > LONG):
        ids = _merge_long(flat[begin[i] : begin[i] + lens[i]], pairs)
        made.append((np.array([i]), ids, np.array([len(ids)])))
    count = np.zeros(len(lens), np.int64)
    for rows, _, n in made:
        count[rows] = n
    to = np.cumsum(count) - count
    out = np.empty(int(count.sum()), np.int32)
    for rows, ids, n in made:
        out[np.arange(len(ids)) + np.repeat(to[rows] - (np.cumsum(n) - n), n)] = ids
    return out, count


def _merge_bucket(ids: np.ndarray, to: np.ndarray, pairs: Pairs, made: list) -> None:
    rank = pairs.ranks(ids[:, :-1], ids[:, 1:])
    while len(to):
        at = rank.argmin(1) if rank.shape[1] else np.zeros(len(to), np.int64)
        row = np.arange(len(to))
        going = rank[row, at] != NONE if rank.shape[1] else np.zeros(len(to), bool)
        if not going.all():
            done = ids[~going]
            has = done != PAD
            made.append((to[~going], done[has], has.sum(1)))
            ids, rank, to, at = ids[going], rank[going], to[going], at[going]
            row = np.arange(len(to))
        if not len(to):
            return
        merged = pairs.merged[pairs.slots(ids[row, at], ids[row, at + 1])]
        columns = np.arange(ids.shape[1] - 1)
        ids = np.take_along_axis(ids, columns + (columns > at[:, None]), 1)
        ids[row, at] = merged
        columns = columns[:-1]
        rank = np.take_along_axis(rank, columns + (columns >= at[:, None]), 1)
        has = at > 0
        rank[row[has], at[has] - 1] = pairs.ranks(ids[row[has], at[has] - 1], merged[has])
        has = at < ids.shape[1] - 1
        rank[row[has], at[has]] = pairs.ranks(merged[has], ids[row[has], at[has] + 1])


def _merge_long(ids: np.ndarray, pairs: Pairs) -> np.ndarray:
    """One long row. All pairs of the lowest rank merge at once, left to right,
    unless a pair made on the way had a lower rank: then only the leftmost does."""
    ids = ids.astype(np.int32)
    while len(ids) > 1:
        rank = pairs.ranks(ids[:-1], ids[1:])
        least = rank.min()
        if least == NONE:
            break
        hits = np.flatnonzero(rank == least)
        # Of overlapping hits, every second of a run of neighbours counts.
        run = np.cumsum(np.r_[True, np.diff(hits) > 1])
        first = hits[np.flatnonzero(np.r_[True, np.diff(run) > 0])][run - 1]
        hits = hits[(hits - first) % 2 == 0]
        merged = pairs.merged[pairs.slots(ids[hits], ids[hits + 1])]
        if len(hits) > 1:
            before, after = hits[hits > 0] - 1, hits[hits < len(ids) - 2] + 2
            made = [
                pairs.ranks(ids[before], merged[hits > 0]),
                pairs.ranks(merged[hits < len(ids) - 2], ids[after]),
                pairs.ranks(merged[:-1], merged[1:]),
                pairs.ranks(merged[:-1], ids[hits[1:]]),
            ]
            if min((int(x.min()) for x in made if len(x)), default=int(NONE)) <= least:
                hits, merged = hits[:1], merged[:1]
        ids = ids.copy()
        ids[hits] = merged
        keep = np.ones(len(ids), bool)
        keep[hits + 1] = False
        ids = ids[keep]
    return ids


class Vocabulary:
    """Ranks of byte strings, and what they give for pieces of text."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if len(ranks) >= PAD or max(ranks.values(), default=0) >= PAD:
            raise ValueError("at most 65,535 ids")
        self.ranks, self.split = ranks, regex.compile(pattern).findall
        self.start = np.array([ranks.get(bytes([b]), PAD) for b in range(256)], np.int32)
        if (self.start == PAD).any():
            raise ValueError("every single byte must have a rank")
        made = [(ranks[a], ranks[b], r) for t, r in ranks.items() for i in range(1, len(t)) if (a := t[:i]) in ranks and (b := t[i:]) in ranks]
        left, right, rank = np.array(made, np.int64).reshape(-1, 3).T
        self.pairs = Pairs(left, right, rank, rank)

    def encode_pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each piece. A piece that is itself a token is that token, whatever merges would give."""
        data, lens = text_bytes(pieces)
        own = np.fromiter((self.ranks.get(x, -1) for x in pieces.cast(pa.binary()).to_pylist()), np.int64, len(pieces))
        token = own >= 0
        keep = np.repeat(~token, lens)
        ids, count = merge_all(self.start[data[keep]], np.where(token, 0, lens), self.pairs)
        return np.insert(ids, (np.cumsum(count) - count)[token], own[token]), count + token

    def encode_stretches(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        parts = [self.split(x) for x in texts.to_pylist()]
        coded = pa.array([x for p in parts for x in p], pa.string()).dictionary_encode()
        return joined(*self.encode_pieces(coded.dictionary), coded.indices.to_numpy(), np.fromiter(map(len, parts), np.int64, len(parts)))


_LOADED: dict[tuple[str, str], Encoder] = {}
_BYTES: dict[str, list[bytes]] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base64 and its rank in each line. It must be there on every machine."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def load(path: str, pattern: str) -> Encoder:
    """The encoder of a rank file, made once per worker."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Encoder(Vocabulary(read_ranks(path), pattern).encode_stretches, stretches)
    return _LOADED[path, pattern]


def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id of a rank file, read once per worker."""
    if path not in _BYTES:
        by_id = {r: t for t, r in read_ranks(path).items()}
        _BYTES[path] = [by_id.get(i, b"") for i in range(max(by_id, default=-1) + 1)]
    return _BYTES[path]


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text (null: empty, so no ids), without special tokens.

    Each match of ``pattern`` is encoded by itself, as the tiktoken library does.
    ``pattern`` must be one whose matches never go from a character that is no
    white space to white space, and that looks at nothing before a match.
    Row by row, no shuffle; repeated rows, null ids and other columns stay as
    they are. No rows: no rows. A column named ``out`` is replaced.
    """

    def make(texts: pa.Array) -> list[pa.Array]:
        ids, lens = load(path, pattern)(texts)
        return [arrow_list(ids, lens)]

    return by_text(docs, text, f"{out} array<int>", make)


def decode(rows: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with the bytes of their ids (null: null), from the ids alone."""
    rows = rows.drop(out)
    at = rows.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = token_bytes(path).__getitem__
        for batch in batches:
            column = batch.column(at)
            values, ends, null = column.values.to_numpy(), column.offsets.to_pylist(), column.is_null().to_pylist()
            made = [None if n else b"".join(map(known, values[a:b].tolist())) for a, b, n in zip(ends, ends[1:], null)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], names=[*batch.schema.names, out])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(out, T.BinaryType())]))


def ids_text(ids) -> object:
    """Decimal ids joined by commas, as a column."""
    return F.array_join(F.col(ids) if isinstance(ids, str) else ids, ",")
