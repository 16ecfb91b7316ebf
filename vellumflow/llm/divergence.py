"""How far the words of sources differ within a language: frequent terms by iceberg prefixes, then exact divergences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellumflow.llm.common import small_batches, text_bytes, written
from vellumflow.session import BROADCAST_BYTES

AT_LEAST, SCALE, TOP = 3, 1_000_000_000, 200
# Length in bytes of the first prefixes; every level doubles it.
FIRST_PREFIX = 4
# Occurrences of terms, and bytes of text, that a task counts before it hands its counts on.
HELD, HELD_BYTES = 4 << 20, 32 << 20
# Counts that one task holds at once when sources are compared.
CELLS = 1 << 20
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
LETTER = np.zeros(256, bool)
LETTER[ord("a") : ord("z") + 1] = LETTER[0x80:] = True


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of the terms of all texts end to end, the length of each term, and how many each text has."""
    data, size = text_bytes(texts)
    data, ends = LOWER[data], np.cumsum(size)
    inside = LETTER[data]
    border = ends[(ends > 0) & (ends < len(data))]
    starts, stops = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    starts[border], stops[border - 1] = inside[border], inside[border - 1]
    first = np.flatnonzero(starts)
    return data[inside], np.flatnonzero(stops) - first + 1, np.diff(np.searchsorted(first, np.r_[0, ends]))


def _distinct(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers in order, and how often each comes. ``numbers`` are sorted in place."""
    numbers.sort()
    first = np.flatnonzero(np.r_[len(numbers) > 0, numbers[1:] != numbers[:-1]])
    return numbers[first], np.diff(np.r_[first, len(numbers)])


class _Tally:
    """Some documents, and the counts of them: by language the documents of each term, and those it stands for at each level; by source its occurrences."""

    def __init__(self, shortest: int):
        self.shortest = shortest
        self.groups: dict[tuple[str, str], int] = {}
        self.group: list[int] = []
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.entries = self.size = 0

    def add(self, langs: list[str], sources: list[str], texts: pa.Array) -> None:
        self.group += [self.groups.setdefault(g, len(self.groups)) for g in zip(langs, sources)]
        self.parts.append(_terms(texts))
        self.entries += len(self.parts[-1][1])
        self.size += len(self.parts[-1][0])

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.entries:
            return
        letters, lens, counts = map(np.concatenate, zip(*self.parts))
        self.parts = []
        offsets = np.r_[0, np.cumsum(lens)].astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(lens), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
        terms, code, n = coded.dictionary, coded.indices.to_numpy(), len(coded.dictionary)
        del letters, lens, offsets, coded
        names: dict[str, int] = {}
        lang_of = np.array([names.setdefault(lang, len(names)) for lang, _ in self.groups], np.int64)
        group = np.array(self.group, np.int64)
        # A key is the number of a document, language or group times the number of terms, and the number of the term.
        doc, pair = np.divmod(_distinct(np.repeat(np.arange(len(counts)) * n, counts) + code)[0], n)
        of_pair = lang_of[group[doc]] * n + pair
        keys, docs = _distinct(of_pair.copy())
        row_term, sizes = keys % n, pc.binary_length(terms).to_numpy().astype(np.int64)
        length, firsts, high = sizes[row_term], [], self.shortest
        while (longer := sizes > high).any():
            prefix = np.zeros(n, np.int64)
            cut = pc.binary_slice(terms.filter(pa.array(longer)), 0, high).dictionary_encode()
            prefix[longer] = cut.indices.to_numpy()
            own = np.flatnonzero(longer[pair])
            # One term of the document stands for all that go on from the same prefix, so a document counts once.
            one = np.unique(doc[own] * len(cut.dictionary) + prefix[pair[own]], return_index=True)[1]
            firsts.append(_distinct(of_pair[own[one]]))
            high *= 2
        levels = sum(((length > (self.shortest << i)).astype(np.int64) for i in range(len(firsts))), np.zeros(len(keys), np.int64))
        at = np.r_[0, np.cumsum(levels)]
        first = np.zeros(at[-1], np.int32)
        for i, (own, found) in enumerate(firsts):
            first[at[np.searchsorted(keys, own)] + i] = found
        used, uses = _distinct(np.repeat(group * n, counts) + code)
        whose, term = np.divmod(used, n)
        row = np.searchsorted(keys, lang_of[whose] * n + term)
        order = np.argsort(row, kind="stable")
        of = np.r_[0, np.cumsum(np.bincount(row, minlength=len(keys)))].astype(np.int32)
        sources = pa.array([source for _, source in self.groups], pa.string())
        uses = pa.StructArray.from_arrays([sources.take(pa.array(whose[order])), pa.array(uses[order], pa.int64())], names=["source", "n"])
        made = pa.RecordBatch.from_arrays(
            [
                pa.array(list(names), pa.string()).take(pa.array(keys // n)), terms.take(pa.array(row_term)).cast(pa.string()), pa.array(docs, pa.int32()),
                pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(first)), pa.ListArray.from_arrays(pa.array(of), uses),
            ],
            names=["lang", "term", "docs", "firsts", "uses"],
        )
        yield from (made.slice(i, 1 << 15) for i in range(0, len(keys), 1 << 15))


def document_terms(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, term, docs, firsts, uses): the terms of some documents of a task at a time, with the number of documents that hold each and its occurrences by source.

    ``firsts`` has a number for each level whose prefixes the term goes on from: the documents in
    which it stands for its prefix. Added up over the terms of a prefix these are the documents
    of the prefix, each counted once.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))))

    shortest, held, held_bytes = FIRST_PREFIX, HELD, HELD_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally(shortest)
        for batch in batches:
            if tally.size + batch.column(2).nbytes >= 1 << 31:  # places of bytes are 32 bits wide
                yield from tally.rows()
                tally = _Tally(shortest)
            tally.add(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2))
            if tally.entries >= held or tally.size >= held_bytes:
                yield from tally.rows()
                tally = _Tally(shortest)
        yield from tally.rows()

    return rows.mapInArrow(run, "lang string, term string, docs int, firsts array<int>, uses array<struct<source: string, n: bigint>>")


def _fits(df: DataFrame, row_bytes: int) -> DataFrame:
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def kept_terms(found: DataFrame, at_least: int = AT_LEAST) -> DataFrame:
    """(lang, term) of all terms in ``at_least`` documents of a language.

    Level by level, longer prefixes: one that is in too few documents is
    discarded with all terms that begin with it, so the next level counts only what goes on from the
    others. A term that ends within a level is whole, and is kept if it is in enough documents
    itself. The last level is the one beyond which no prefix goes on.
    """
    rows = found.select("lang", F.col("term").cast("binary").alias("term"), "docs", "firsts").withColumn("size", F.octet_length("term"))
    alive, step, low, high, kept = None, 0, 0, FIRST_PREFIX, []
    while True:
        level = rows.where(F.col("size") > low)
        if alive is not None:
            level = level.withColumn("prefix", F.substring("term", 1, low)).join(alive, ["lang", "prefix"], "left_semi")
        goes_on = F.col("size") > high
        counted = level.groupBy("lang", F.substring("term", 1, high).alias("prefix"), goes_on.alias("goes_on"))
        counted = counted.agg(F.sum(F.when(goes_on, F.get("firsts", F.lit(step))).otherwise(F.col("docs"))).alias("docs"))
        counted = written(counted.where(F.col("docs") >= at_least).drop("docs"), "prefixes")
        kept.append(counted.where(~F.col("goes_on")).select("lang", F.col("prefix").cast("string").alias("term")))
        alive = counted.where("goes_on").select("lang", "prefix")
        n = alive.count()
        if not n:
            break
        alive = F.broadcast(alive) if n * (high + 60) <= BROADCAST_BYTES else alive
        step, low, high = step + 1, high, 2 * high
    out = kept[0]
    for more in kept[1:]:
        out = out.union(more)
    return out


def _share(n: str, total: str) -> F.Column:
    """1 + floor(SCALE * (n + 1) / (total + V)), whole numbers throughout."""
    return (F.expr(f"cast({n} + 1 as decimal(20, 0)) * cast({SCALE} as decimal(10, 0)) div ({total} + v)") + 1).cast("long")


def pair_sums(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): for each two sources of a language the sum of their divergence over all kept terms.

    Terms are dealt to slices that hold all sources of a language. A slice is one matrix of bounded size, and gives one partial
    sum for each two sources; no rows of pairs of documents or terms are made. Work is terms times
    sources squared, as the sum runs over all terms, those without occurrences too.
    """
    per_lang = groups.groupBy("lang").agg(F.count("*").alias("sources"), F.max("v").alias("v"))
    slices = _fits(written(per_lang.withColumn("slices", F.expr(f"1 + sources * v div {CELLS}")), "slices"), 100)
    terms = counts.join(slices, "lang").select("lang", F.pmod(F.xxhash64("id"), "slices").alias("slice"), "id", "source", "n")
    heads = groups.join(slices.drop("v"), "lang").select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"), "source", "total", "v")
    none = lambda kind: F.lit(None).cast(kind)
    both = terms.withColumn("total", none("long")).withColumn("v", none("long")).union(
        heads.select("lang", "slice", none("long"), "source", none("long"), "total", "v")
    )

    def compare(part: pa.Table) -> pa.Table:
        head = np.asarray(part.column("total").is_valid())
        sources = part.column("source").filter(pa.array(head)).to_pylist()
        total = part.column("total").filter(pa.array(head)).to_numpy()
        v = int(part.column("v").drop_null()[0].as_py()) if len(sources) else 0
        place = {s: i for i, s in enumerate(sources)}
        rows = part.filter(pa.array(~head))
        term = rows.column("id").combine_chunks().dictionary_encode()
        count = np.zeros((len(sources), len(term.dictionary)), np.int64)
        row = np.array([place[s] for s in rows.column("source").to_pylist()], np.int64)
        np.add.at(count, (row, term.indices.to_numpy(zero_copy_only=False)), rows.column("n").to_numpy())
        made = [shares(count[i], int(total[i]) + v) for i in range(len(sources))]
        p = np.stack(made) if made else count
        sums = np.empty((len(sources), len(sources)), np.int64)
        for i in range(len(sources)):
            gap = p[i] - p
            sums[i] = (gap * gap // p).sum(1)
        a, b = np.nonzero(~np.eye(len(sources), dtype=bool))
        names = pa.array(sources, pa.string())
        lang = pa.array([part.column("lang")[0].as_py()] * len(a), pa.string())
        return pa.table({"lang": lang, "source": names.take(pa.array(a)), "item": names.take(pa.array(b)), "value": pa.array(sums[a, b])})

    parts = both.toDF("lang", "slice", "id", "source", "n", "total", "v").groupBy("lang", "slice").applyInArrow(compare, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("long").alias("value"))


def shares(count: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total) without overflow: in Python's own numbers where 64 bits are too few."""
    if len(count) and int(count.max()) < (1 << 62) // SCALE:
        return 1 + SCALE * (count + 1) // max(total, 1)
    return np.array([1 + SCALE * (int(c) + 1) // max(total, 1) for c in count], np.int64)


def audit(docs: DataFrame, at_least: int = AT_LEAST, top: int = TOP, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): the divergence of each source from the others of its language, and its most telling terms.

    Part ``pair``: every other source of the language by the summed divergence. Part
    ``term``: the ``top`` terms that the source has more often than its language. Counts
    of kept terms are added up by language, source and term before anything meets.

    Nulls: null text, lang and source are empty strings, and these are a language and a
    source like any other. Repeated documents count as often as they come. Ties are
    ordered by the bytes of the item. A source without terms is compared too; a language without kept
    terms has values of 0. No rows: no rows. Other columns are not looked at.
    """
    found = written(document_terms(docs, text, lang, source), "terms")
    kept = written(kept_terms(found, at_least).withColumn("id", F.monotonically_increasing_id()), "kept")
    kept_few = _fits(kept, 60)
    used = found.join(kept_few, ["lang", "term"]).select("lang", "id", F.explode("uses").alias("u"))
    counts = written(used.groupBy("lang", "id", F.col("u.source").alias("source")).agg(F.sum("u.n").alias("n")), "counts")
    named = docs.select(F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.coalesce(F.col(source), F.lit("")).alias("source")).distinct()
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    v = kept.groupBy("lang").agg(F.count("*").alias("v"))
    zero = F.lit(0).cast("long")
    groups = named.join(totals, ["lang", "source"], "left").join(v, "lang", "left")
    groups = written(groups.select("lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("v", zero).alias("v")), "groups")

    pairs = pair_sums(counts, groups)
    whole = counts.groupBy("lang", "id").agg(F.sum("n").alias("all_n"))
    whole = whole.join(groups.groupBy("lang").agg(F.sum("total").alias("all_total")), "lang").drop("lang")
    terms = counts.join(whole, "id").join(groups, ["lang", "source"])
    terms = terms.select("lang", "source", "id", _share("n", "total").alias("p"), _share("all_n", "all_total").alias("q")).where("p > q")
    terms = terms.select("lang", "source", "id", F.expr("(p - q) * (p - q) div q").alias("value"))
    terms = terms.join(kept_few.select("id", F.col("term").alias("item")), "id").select("lang", "source", "item", "value")
    ranked = lambda part, rows: rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))).select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", "rank"
    )
    return ranked("pair", pairs).union(ranked("term", terms).where(F.col("rank") <= top))
