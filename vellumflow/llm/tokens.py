"""Token ids of whole texts, each distinct stretch between white space encoded once.

A piece of the tokenizers used here never goes from a character that is no
white space to white space, and none looks back, so a text may be cut there and
the ids of the stretches joined. Texts repeat their words a great deal, so the
encoder itself sees only stretches it has not seen lately.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from vellumflow.llm.common import Gather, joined, text_bytes

# The characters with the property White_Space, as the tokenizers read \s.
SPACE = r"\t-\r \x85\xa0  -     　"
STRETCH = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
SPACE_RE2 = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# A noncharacter; texts that hold it are cut by STRETCH instead.
CUT = "\uffff"


def stretches(texts: pa.Array) -> pa.ListArray:
    """Each text cut before every white space that follows something else."""
    rare = pc.match_substring(texts, CUT)
    if pc.any(rare).as_py():
        return pa.array([STRETCH.findall(x) or [""] for x in texts.to_pylist()], pa.list_(pa.string()))
    cut = pc.replace_substring_regex(texts, f"([^{SPACE_RE2}])([{SPACE_RE2}])", f"\\1{CUT}\\2")
    return pc.split_pattern(cut, CUT)


def words(texts: pa.Array) -> pa.ListArray:
    """Each text cut at ASCII white space, which is dropped."""
    return pc.ascii_split_whitespace(texts)


HEADS = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


class Memory:
    """``strings -> (ids, number of ids of each)``, as ``encode`` gives them, which sees each string only if it was not seen lately.

    Short strings are found by two numbers that hold their bytes and length; a newer string takes the slot of an older
    one. Those of more than ``SHORT`` bytes are never known. At most ``most`` numbers are remembered, with those of one call beyond them;
    then those strings stay that were asked for again since, or none where these are more than half of it.
    """

    SHORT, BITS, MANY = 15, 20, 1 << 15

    def __init__(self, encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], most: int):
        self.encode, self.most = encode, most
        self._clear()

    def _clear(self) -> None:
        self.low, self.high = np.zeros(1 << self.BITS, np.uint64), np.zeros(1 << self.BITS, np.uint64)
        self.row, self.used = np.full(1 << self.BITS, -1, np.int32), np.zeros(1 << self.BITS, bool)
        self.table = Gather(self.most)

    def _forget(self) -> None:
        self.row[~self.used] = -1
        held, kept = np.flatnonzero(self.row >= 0), Gather(self.most)
        kept.add(*self.table.take(self.row[held]))
        if 2 * (kept.offsets[kept.rows] + 2 * kept.rows) > self.most:
            self._clear()
        else:
            self.row[held], self.table = np.arange(len(held)), kept
            self.used[:] = False

    def _keys(self, data: np.ndarray, begin: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Both numbers and the slot of each short string. ``data`` goes on for 16 bytes after the last one."""
        wide = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
        low = wide[begin] & HEADS[np.minimum(lens, 8)]
        high = (wide[begin + 8] & HEADS[np.maximum(lens, 8) - 8]) | (lens.astype(np.uint64) << np.uint64(56))
        mixed = (low ^ (high * MIX[0])) * MIX[1]
        return low, high, (((mixed ^ (mixed >> np.uint64(32))) * MIX[0]) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def _rows(self, data: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """The row of each string of ``data``, -1 where it is not known."""
        out, begin = np.full(len(lens), -1, np.int64), np.cumsum(lens) - lens
        for a in range(0, len(lens), self.MANY):
            n = lens[a : a + self.MANY]
            low, high, slot = self._keys(data, begin[a : a + self.MANY], np.minimum(n, self.SHORT))
            found = (self.low[slot] == low) & (self.high[slot] == high) & (n <= self.SHORT)
            out[a : a + self.MANY] = np.where(found, self.row[slot], -1)
            self.used[slot[found]] = True
        return out

    def _put(self, data: np.ndarray, lens: np.ndarray, first: int) -> None:
        """From now on the strings have the rows from ``first`` on."""
        short = np.flatnonzero(lens <= self.SHORT)
        low, high, slot = self._keys(data, (np.cumsum(lens) - lens)[short], lens[short])
        self.row[slot], self.used[slot] = first + short, False
        won = np.flatnonzero(self.row[slot] == first + short)  # of those that share a slot
        self.low[slot[won]], self.high[slot[won]] = low[won], high[won]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if self.table.full():
            self._forget()
        rows = self._rows(*_padded(texts))
        rest = np.flatnonzero(rows < 0)
        if len(rest):
            coded, first = texts.take(pa.array(rest)).dictionary_encode(), self.table.rows
            self.table.add(*self.encode(coded.dictionary))
            self._put(*_padded(coded.dictionary), first)
            rows[rest] = first + coded.indices.to_numpy()
        return self.table.take(rows)


def _padded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, lens = text_bytes(texts)
    return np.concatenate([data, np.zeros(16, np.uint8)]), lens


def _sums(lens: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of ``lens`` between each two places of ``at``."""
    ends = np.zeros(len(lens) + 1, np.int64)
    np.cumsum(lens, out=ends[1:])
    return np.diff(ends[at])


class Encoder:
    """``texts -> (ids, number of ids of each)``; ``encode`` gives ids and lengths of an array of stretches.

    What is remembered is bounded by ``most`` numbers.
    """

    def __init__(self, encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], cut: Callable[[pa.Array], pa.ListArray], most: int = 6 << 20):
        self.cut, self.memory = cut, Memory(encode, most)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        parts = self.cut(texts)
        at = parts.offsets.to_numpy().astype(np.int64)
        ids, lens = self.memory(parts.flatten())
        return ids, _sums(lens, at - at[0])


# Characters that normalisation only changes to lower case, one by one.
PLAIN = "^[!-~À-ÖØ-öø-ÿ]+$"
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
# The same by bytes, where there is no quote: such a letter of two bytes has the second one from 0x80 to 0xBF.
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[[*range(ord("A"), ord("Z") + 1), *range(0x80, 0x9F)]] += 32
LETTER, DIGIT = 1, 2
KIND = np.zeros(256, np.uint8)
KIND[[*range(ord("a"), ord("z") + 1), *range(0x80, 0xC0), 0xC3]] = LETTER
KIND[ord("0") : ord("9") + 1] = DIGIT


class Library:
    """Ids as the tokenizers library gives them for a BPE with word ends over bytes.

    Stretches of plain Latin characters are merged in matrices with the file's own
    merges, which is some ten times as fast as a call for each; all others, and
    those that might hold a special token, go to the library.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        from vellumflow.llm.bpe import Pairs

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right, made = (np.array([vocab[x] for x in part], np.int64) for part in ((m[0] for m in merges), (m[1] for m in merges), (m[0] + m[1] for m in merges)))
        self.pairs = Pairs(left, right, np.arange(len(made)), made)
        shown = _byte_characters()
        self.inner = np.array([vocab[c] for c in shown], np.int32)
        self.last = np.array([vocab[c + end] for c in shown], np.int32)
        self.pieces = Memory(self._merged, 3 << 20)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        plain = pc.and_(pc.match_substring_regex(texts, PLAIN), pc.invert(pc.match_substring(texts, "<|"))).to_numpy(zero_copy_only=False)
        odd = [x.ids for x in self.tokenizer.encode_batch(texts.filter(pa.array(~plain)).to_pylist(), add_special_tokens=False)] if not plain.all() else []
        ids, lens = self._plain(texts.filter(pa.array(plain)))
        out = np.empty(len(texts), np.int64)
        out[plain], out[~plain] = lens, np.fromiter(map(len, odd), np.int64, len(odd))
        flat, whose = np.empty(int(out.sum()), np.int32), np.repeat(plain, out)
        flat[whose] = ids
        flat[~whose] = np.concatenate([*map(np.array, odd), np.empty(0)])
        return flat, out

    def _plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        quoted = pc.match_substring(texts, "'").to_numpy(zero_copy_only=False)
        parts = [PIECE.findall(x.lower()) for x in texts.filter(pa.array(quoted)).to_pylist()]
        data, lens = text_bytes(texts.filter(pa.array(~quoted)))
        data, begin = LOWERED[data], np.cumsum(lens) - lens
        kind = KIND[data]
        new = np.r_[True, kind[1:] != kind[:-1]] | (kind == DIGIT) if len(data) else np.zeros(0, bool)
        new[begin] = True
        offsets = np.r_[np.flatnonzero(new), len(data)].astype(np.int32)
        pieces = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data))
        count = np.empty(len(texts), np.int64)
        count[~quoted], count[quoted] = np.diff(np.searchsorted(offsets, np.r_[begin, len(data)])), [len(p) for p in parts]
        ids, n = self.pieces(pa.concat_arrays([pieces, pa.array([x for p in parts for x in p], pa.string())]))
        # Those with quotes come last; put all in order.
        order = np.r_[np.flatnonzero(~quoted), np.flatnonzero(quoted)]
        n = _sums(n, np.r_[0, np.cumsum(count[order])])
        return joined(ids, n, np.argsort(order), np.ones(len(order), np.int64)) if len(parts) else (ids, n)

    def _merged(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        from vellumflow.llm.bpe import merge_all

        data, lens = text_bytes(pieces)
        ids, last = self.inner[data], np.cumsum(lens) - 1
        ids[last] = self.last[data[last]]
        return merge_all(ids, lens, self.pairs)


def _byte_characters() -> list[str]:
    """The printable character that stands for each byte in such files: itself, or the next free one from 256 on."""
    own = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    free = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(free)) for b in range(256)]


_LOADED: dict[str, Encoder] = {}


def library(path: str) -> Encoder:
    """An encoder by the file of a tokenizers BPE, loaded once per worker. Strings of special tokens are read as that library reads them by default."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(Library(path), words)
    return _LOADED[path]
