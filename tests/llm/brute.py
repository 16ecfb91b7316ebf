"""Plain Python for what the operators compute, and rows that are hard for them."""

import hashlib
import re
import zlib

import numpy as np
import xxhash

LONG = "the quick brown fox jumps over the lazy dog and runs far away from here " * 400
PASSAGE = "This passage of well over fifty bytes stands in several of the documents, word for word."

HARD = [
    (1, "Plain words, one after another, as in any text."),
    (1, "Plain words, one after another, as in any text."),
    (2, None),
    (3, ""),
    (None, "A row without an id. " + PASSAGE),
    (4, "   \n\t \n"),
    (5, LONG),
    (6, LONG + "and a little more"),
    (7, "héé naïve ßtraße 中文字 \U0001f600 ́x <|endoftext|> don't I'LL  two  spaces\r\n　end "),
    (8, "Before. " + PASSAGE + " After."),
    (9, "Other. " + PASSAGE + " Rest."),
    (10, "a" * 3000),
    (11, "x"),
    (12, "a" * 2990 + "b" * 60),
    (5, "another text of an id that comes twice"),
    (-3, "a negative id " + PASSAGE),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def hard_rows():
    return [(i, t, "en", "src", None if t is None else len(t)) for i, t in HARD]


def fingerprint(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_groups(rows, shingle=3):
    fps = [fingerprint(t, shingle) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 2:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [(doc, f"{fps[i]:016x}", least.get(find(i))) for i, (doc, _) in enumerate(rows)]


def repeats(rows):
    texts = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, t in texts:
        for p in range(len(t) - 49):
            if i is not None:
                w = t[p : p + 50]
                first[w] = min(i, first.get(w, i))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - 49):
            if i is not None and first[t[p : p + 50]] < i:
                gone[p : p + 50] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = {}
    for w in windows:
        count[w] = count.get(w, 0) + 1
    inside = {j for i, w in enumerate(windows) if count[w] > 1 for j in (i, i + 1, i + 2)}
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), failed


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())
