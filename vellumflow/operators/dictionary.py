"""Stems through a table of words: each distinct word is stemmed once in a whole job."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumflow.functions.porter import porter_stem
from vellumflow.functions.text import mark, words
from vellumflow.session import few, stored

Stemmer = Callable[[str], str]


WORDS = "_words_of_{}"


def _words(rows: DataFrame, column: str) -> Column:
    """Distinct words of a column: those kept beside it, or else made now."""
    kept = WORDS.format(column)
    return F.col(kept) if kept in rows.columns else F.array_distinct(words(F.lower(F.col(column))))


def with_words(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows``, written once with the distinct words of some columns beside them.

    Given these, ``stem_table`` and ``highlight`` read the words instead of cutting, and before that making, each text again.
    """
    return stored(rows.withColumns({WORDS.format(c): _words(rows, c) for c in columns}), "rows")


def stem_table(rows: DataFrame, columns: list[str], stemmer: Stemmer = porter_stem) -> DataFrame:
    """(word, stem) of the distinct words in small letters of some columns, written once: the stemmer is called once for each.

    Words are made distinct within their row and task before they are shuffled.
    Null texts have no words.
    """

    @F.pandas_udf("string")
    def stem(batch: pd.Series) -> pd.Series:
        return batch.map(stemmer)

    found = None
    for column in columns:
        own = rows.select(F.explode(_words(rows, column)).alias("word"))
        found = own if found is None else found.unionByName(own)
    distinct = stored(found.distinct(), "words")
    return stored(distinct.select("word", stem("word").alias("stem")), "stems")


def highlight(rows: DataFrame, key: str, text: str, query: str, stems: DataFrame, into: str = "highlighted") -> DataFrame:
    """Add ``into``: the text with those words in mark tags whose stem is one of its query's.

    ``key`` tells rows apart and ``stems`` is their ``stem_table``. Only words
    that share a stem with a word of any query leave their task: the table is
    cut to these first, and broadcast if, counted, it fits. What meets by a
    shuffle are keys, stems and these words; texts meet their few words last.

    A null text stays null; a null query or one without words marks nothing. No rows: no rows.
    """
    asked = rows.select(F.col(key).alias("_key"), F.explode(_words(rows, query)).alias("word"))
    asked = stored(asked.join(stems, "word").select("_key", "stem").distinct(), "asked")
    wanted = stored(stems.join(asked.select("stem").distinct(), "stem", "left_semi"), "wanted")
    said = rows.select(F.col(key).alias("_key"), F.explode(_words(rows, text)).alias("word")).join(few(wanted), "word")
    match = said.join(asked, ["_key", "stem"], "left_semi").groupBy("_key").agg(F.collect_set("word").alias("_match"))
    plain = rows.drop(WORDS.format(text), WORDS.format(query))
    joined = plain.join(match, F.col(key).eqNullSafe(F.col("_key")), "left")
    marked = F.when(F.col("_match").isNull(), F.col(text)).otherwise(mark(F.col(text), F.col("_match")))
    return joined.withColumn(into, marked).drop("_match", "_key")
