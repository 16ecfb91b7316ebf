"""Mark the words of a text whose stem is among the stems of a query."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumflow.functions.porter import porter_stem
from vellumflow.functions.text import clean, mark, words

Stemmer = Callable[[str], str]
CACHED_STEMS = 200_000
# Rows whose words are Python objects at a time.
ROWS = 64


def _cached(stemmer: Stemmer) -> Stemmer:
    known: dict[str, str] = {}

    def stem(word: str) -> str:
        got = known.get(word)
        if got is None:
            if len(known) >= CACHED_STEMS:
                known.clear()
            got = known[word] = stemmer(word)
        return got

    return stem


def _by_rows(made: Callable[..., list[str] | None], *columns: pa.Array) -> pa.Array:
    """Lists of words made row by row; of a batch only a few rows are Python objects at a time."""
    kind = pa.list_(pa.string())
    parts = [
        pa.array([made(*row) for row in zip(*(c.slice(a, ROWS).to_numpy(zero_copy_only=False) for c in columns))], kind)
        for a in range(0, len(columns[0]), ROWS)
    ]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def stems(of: Column, stemmer: Stemmer = porter_stem) -> Column:
    """Stem of each word in an array of words."""

    @F.arrow_udf("array<string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        stem = _cached(stemmer)
        for batch in batches:
            yield _by_rows(lambda ws: None if ws is None else [stem(w) for w in ws], batch)

    return run(of)


def matching_words(text_words: Column, query_words: Column, stemmer: Stemmer | None = porter_stem) -> Column:
    """The words of the text that share a stem with a word of the query. Without a stemmer: equal words.

    Only distinct words travel to Python, and only the few that match come back.
    """
    if stemmer is None:
        return F.array_intersect(text_words, query_words)

    @F.arrow_udf("array<string>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        stem = _cached(stemmer)

        def matching(ws: list[str] | None, qs: list[str] | None) -> list[str]:
            wanted = set() if qs is None else {stem(q) for q in qs}
            return [] if ws is None or not wanted else [w for w in ws if stem(w) in wanted]

        for texts, queries in batches:
            yield _by_rows(matching, texts, queries)

    return run(text_words, query_words)


def highlight(
    rows: DataFrame,
    text: str,
    query: str,
    into: str = "highlighted",
    stemmer: Stemmer | None = porter_stem,
    cleaned: bool = False,
) -> DataFrame:
    """Add ``into``: the text with matching words in mark tags. ``cleaned`` cleans the text first."""
    source = clean(F.col(text)) if cleaned else F.col(text)
    # Python sees the two word lists; splitting and joining the text stay in the JVM.
    prepared = rows.withColumn("_text", source).withColumn(
        "_match",
        matching_words(
            F.array_distinct(words(F.lower("_text"))), F.array_distinct(words(F.lower(F.col(query)))), stemmer
        ),
    )
    unmarked = F.coalesce(F.size("_match"), F.lit(0)) <= 0
    return prepared.withColumn(
        into, F.when(unmarked, F.col("_text")).otherwise(mark(F.col("_text"), F.col("_match")))
    ).drop("_text", "_match")
