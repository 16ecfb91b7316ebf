"""Quality rules: counts of each text, fixed rules on them, and an isolation forest for what stands apart."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumflow.llm.common import by_text, hashed_share, unused

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
UPPER, DIGITS = bytes(range(65, 91)), b"0123456789"
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long, n_digits long, n_shouts long"
# Rules and forest are fitted on at most so many labelled rows of each label, chosen by a hash of their id.
SAMPLE = 5_000
# Of the rows the forest grows on, at most this share is labelled bad: what is common cannot be isolated.
BAD_SHARE = 0.08
TREES, LEAF_SAMPLE = 200, 256
# A rule's bounds hold all but this share of good labelled rows at either end.
OUTSIDE = 0.001
# Of good labelled rows, at most this share may be lost to the forest.
LOST = 0.002


def _repeats(words: np.ndarray, distinct: int) -> int:
    """Words inside three-word windows that come twice or more."""
    if len(words) < 4:
        return 0
    a, b, c = words[:-2], words[1:-1], words[2:]
    if distinct < 1 << 21:
        key = (a * distinct + b) * distinct + c
    else:
        key = np.unique(a * distinct + b, return_inverse=True)[1] * distinct + c
    _, which, count = np.unique(key, return_inverse=True, return_counts=True)
    again = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(count[which] > 1)
    np.add.at(again, at, 1)
    np.add.at(again, np.minimum(at + 3, len(words)), -1)
    return int((np.cumsum(again[:-1]) > 0).sum())


def _counts(texts: pa.Array) -> list[pa.Array]:
    parts = pc.ascii_split_whitespace(texts)
    flat = parts.flatten()
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    at = np.r_[0, np.cumsum(real)][parts.offsets.to_numpy() - parts.offsets[0].as_py()]
    coded = flat.filter(pa.array(real)).dictionary_encode()
    words, distinct = coded.indices.to_numpy().astype(np.int64), max(1, len(coded.dictionary))
    made = []
    for i, text in enumerate(texts.to_pylist()):
        data = text.encode()
        without = lambda drop: len(data) - len(data.translate(None, drop))
        lines = [x for x in data.split(b"\n") if x.strip(SPACES)]
        made.append(
            (
                at[i + 1] - at[i],
                len(text) - without(SPACES),
                without(SYMBOLS),
                len(lines) - len(set(lines)),
                _repeats(words[at[i] : at[i + 1]], distinct),
                len(lines),
                without(UPPER),
                without(DIGITS),
                without(b"!"),
            )
        )
    columns = np.array(made, np.int64).reshape(len(made), 9).T
    return [pa.array(np.ascontiguousarray(c)) for c in columns]


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts of each whole text (null: empty), where it is read."""
    return by_text(docs, text, COUNTS, _counts)


def base_failed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Shares that do not depend on a text's length, from its counts."""
    words = np.maximum(counts["n_words"], 1)
    chars = np.maximum(counts["word_chars"], 1)
    return np.stack(
        [
            np.sqrt(counts["n_symbols"] / words),
            np.sqrt(counts["n_shouts"] / words),
            np.sqrt(counts["n_upper"] / chars),
            np.sqrt(counts["n_digits"] / chars),
            counts["n_repeat_words"] / words,
            counts["n_dup_lines"] / np.maximum(counts["n_lines"], 1),
            np.minimum(chars / words, 40.0),
        ],
        axis=1,
    ).astype(np.float64)


@dataclass
class Forest:
    """Random splits, one complete binary tree in each row of the arrays; ``limit`` is the score beyond which a row is out."""

    feature: np.ndarray
    split: np.ndarray
    depth: np.ndarray
    norm: float
    limit: float = 1.0

    def scores(self, x: np.ndarray) -> np.ndarray:
        """From 0 to 1, high for rows that few random splits set apart."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for f, s, d in zip(self.feature, self.split, self.depth):
            node = np.zeros(len(x), np.int64)
            while True:
                going = f[node] >= 0
                if not going.any():
                    break
                right = x[rows, np.maximum(f[node], 0)] >= s[node]
                node = np.where(going, 2 * node + 1 + right, node)
            total += d[node]
        return np.exp2(-total / len(self.feature) / self.norm)


def _expected(n: np.ndarray | float) -> np.ndarray:
    """Mean path length among n rows."""
    n = np.maximum(np.asarray(n, float), 1.0)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649015329) - 2 * (n - 1) / n, np.where(n > 1, 1.0, 0.0))


def grow(x: np.ndarray, trees: int = TREES, sample: int = LEAF_SAMPLE, seed: int = 42) -> Forest:
    random, n = np.random.default_rng(seed), min(sample, len(x))
    height = max(1, int(np.ceil(np.log2(max(n, 2)))))
    nodes = 2 ** (height + 1) - 1
    feature, split, depth = np.full((trees, nodes), -1), np.zeros((trees, nodes)), np.zeros((trees, nodes))
    for t in range(trees):
        todo = [(0, random.choice(len(x), n, replace=False), 0)]
        while todo:
            node, own, level = todo.pop()
            low, high = x[own].min(0), x[own].max(0)
            varied = np.flatnonzero(high > low)
            if level == height or len(own) < 2 or not len(varied):
                depth[t, node] = level + _expected(len(own))
                continue
            f = random.choice(varied)
            s = random.uniform(low[f], high[f])
            s = s if s > low[f] else high[f]
            right = x[own, f] >= s
            feature[t, node], split[t, node] = f, s
            todo += [(2 * node + 1, own[~right], level + 1), (2 * node + 2, own[right], level + 1)]
    return Forest(feature, split, depth, max(float(_expected(n)), 1e-9))


@dataclass
class Rules:
    """What a good text's shares lie between, the scale beyond, and the forest over what exceeds the bounds."""

    low: np.ndarray
    high: np.ndarray
    scale: np.ndarray
    forest: Forest | None

    def broken(self, x: np.ndarray) -> np.ndarray:
        """By how much each share leaves its bounds: zero for most good texts, so these lie together in one point."""
        return np.concatenate([np.maximum(x - self.high, 0), np.maximum(self.low - x, 0)], axis=1) / np.tile(self.scale, 2)

    def out(self, x: np.ndarray) -> np.ndarray:
        return np.zeros(len(x), bool) if self.forest is None or not len(x) else self.forest.scores(self.broken(x)) > self.forest.limit


def fit(x: np.ndarray, good: np.ndarray, seed: int = 42) -> Rules:
    """Bounds from good rows, a forest over good and a few bad ones, and the limit of its score.

    The limit lies midway in a gap of scores: of all limits that lose at most
    ``LOST`` of the good rows, one that finds the most bad ones. Without good
    rows, or where no row breaks a rule, nothing is out.
    """
    ok = x[good]
    if not len(ok):
        return Rules(np.full(x.shape[1], -np.inf), np.full(x.shape[1], np.inf), np.ones(x.shape[1]), None)
    low, high = np.quantile(ok, [OUTSIDE, 1 - OUTSIDE], axis=0)
    rules = Rules(low, high, np.maximum(high - low, 0.05), None)
    bad = x[~good][: max(1, int(len(ok) * BAD_SHARE / (1 - BAD_SHARE)))]
    grown = rules.broken(np.concatenate([ok, bad]))
    if not grown.any():
        return rules
    forest = grow(grown, seed=seed)
    fine, poor = np.sort(forest.scores(rules.broken(ok))), np.sort(forest.scores(rules.broken(x[~good])))
    levels = np.unique(np.concatenate([fine, poor]))
    limits = np.append((levels[1:] + levels[:-1]) / 2, 1.0)
    lost = 1 - np.searchsorted(fine, limits, "right") / len(fine)
    found = len(poor) - np.searchsorted(poor, limits, "right")
    allowed = np.flatnonzero(lost <= LOST)
    best = allowed[found[allowed] == found[allowed].max()]
    gap = np.append(np.diff(levels), 0)[best]
    forest.limit = float(limits[best[gap.argmax()]]) if len(poor) else 1.0
    rules.forest = forest
    return rules


def _names() -> list[str]:
    return [x.split()[0] for x in COUNTS.split(", ")]


def trained(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", most: int = SAMPLE) -> Rules:
    """Rules from labelled rows that pass the fixed ones: at most ``most`` of each label, by a hash of their id.

    Only these few rows' texts are counted. Rows without a label take no part.
    """
    marked = labels.where(F.col(label).isNotNull() & F.col(id).isNotNull()).groupBy(F.col(id).alias("_id")).agg(F.max(label).alias("_good"))
    sizes = {r["_good"]: r["count"] for r in marked.where(F.col("_good").isin(0, 1)).groupBy("_good").count().collect()}
    picked = None
    for good in (0, 1):
        part = marked.where((F.col("_good") == good) & hashed_share(F.col("_id"), sizes.get(good, 0), 2 * most)).orderBy(F.xxhash64("_id"), "_id").limit(2 * most)
        picked = part if picked is None else picked.union(part)
    rows = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(picked), "_id")
    few = base_failed(counted(rows, "_text").drop("_text")).where(~F.col("base_failed"))
    few = few.orderBy(F.xxhash64("_id"), *_names()).limit(4 * most).toArrow()
    counts = {n: few[n].to_numpy() for n in _names()}
    good = few["_good"].to_numpy() == 1 if len(few) else np.zeros(0, bool)
    keep = np.sort(np.concatenate([np.flatnonzero(good)[:most], np.flatnonzero(~good)[:most]]))
    return fit(features(counts)[keep], good[keep])


def judged(docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``docs`` with counts, ``base_failed`` and ``kept``.

    ``kept`` is false where a fixed rule fails (under 50 words, or over half of
    them in repeated three-word windows) or the forest finds the text standing
    apart. The model is a few arrays of a size fixed by parameters and goes with
    the tasks; texts are counted and judged where they are read, in one worker a task, and nothing is shuffled.

    Nulls: a null text is empty, so it has no words and fails. Empty labels: only
    the fixed rules hold. Repeated rows, null ids and further columns stay; a
    column with the name of an added one is replaced. No rows: no rows.
    """
    rules = trained(docs, labels, id, text)
    docs = docs.drop("kept", "base_failed")
    apart = unused(docs, "_apart")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = {n: x.to_numpy() for n, x in zip(_names(), batch.columns[-len(_names()) :])}
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rules.out(features(counts)))], names=[*batch.schema.names, apart])

    rows = base_failed(by_text(docs, text, f"{COUNTS}, {apart} boolean", _counts, then=run))
    return rows.withColumn("kept", ~(F.col(apart) | F.col("base_failed"))).drop(apart)
