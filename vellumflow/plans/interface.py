"""Registered queries over displayed text: cleaning, tokens, stems, highlights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumflow.functions import porter, text
from vellumflow.operators import dictionary
from vellumflow.operators import highlight as marks
from vellumflow.plans.common import L, W, table, texts


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir, "documents", "doc_id").select("doc_id", text.clean(F.col("text")).alias("cleaned"))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = texts(spark, sf_dir, "documents", "doc_id").select("doc_id", "text", text.tokens(F.col("text")).alias("t"))
    return found.select(
        "doc_id",
        F.size("t").cast("bigint").alias("n_tokens"),
        F.size(F.array_distinct("t")).cast("bigint").alias("n_distinct"),
        (F.array_join("t", "") == F.col("text")).alias("lossless"),
    )


def query_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = table(spark, sf_dir, "benchmark")
    return asked.select("item_id", F.array_join(text.query_terms(F.col("text")), "|").alias("terms"))


def stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = text.words(F.lower("text"))
    found = texts(spark, sf_dir, "documents", "doc_id").select("doc_id", marks.stems(words).alias("s"))
    return found.select("doc_id", F.size("s").cast("bigint").alias("n_words"), F.md5(F.array_join("s", " ")).alias("stems_md5"))


def _paired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the listed question whose turn it is."""
    n = table(spark, sf_dir, "benchmark").count()
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("_q"), F.col("text").alias("query"))
    return texts(spark, sf_dir, "documents", "doc_id").withColumn("_q", F.pmod("doc_id", F.lit(n))).join(asked, "_q").drop("_q")


def highlight(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = marks.highlight(_paired(spark, sf_dir), "text", "query", cleaned=True)
    return done.select("doc_id", "highlighted")


def highlight_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a stemmer: equal words are marked."""
    done = marks.highlight(_paired(spark, sf_dir), "text", "query", stemmer=None)
    return done.select("doc_id", "highlighted")


def highlighted_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same marks, with each distinct word stemmed once."""
    cleaned = _paired(spark, sf_dir).withColumn("text", text.clean(F.col("text")))
    rows = dictionary.with_words(cleaned.select("doc_id", "text", "query"), ["text", "query"])
    done = dictionary.highlight(rows, "doc_id", "text", "query", dictionary.stem_table(rows, ["text", "query"]))
    return done.select("doc_id", "highlighted")


QUERIES = {
    "highlighted_by_table": highlighted_by_table,
    "clean_text": clean_text,
    "tokens": tokens,
    "query_terms": query_terms,
    "stems": stems,
    "highlight": highlight,
    "highlight_words": highlight_words,
}

_TOKEN = rf"[{L}]+|[^{L}{W}]|[{W}]+"

# --- stems in SQL: the same rules as steps over distinct words -------------------------------

_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"


def _fits(word: str, pattern: str) -> str:
    """A first y counts as a consonant."""
    return f"regexp_matches(regexp_replace({word}, '^y', 'Y'), '{pattern}')"


def _over(word: str, least: int) -> str:
    """Has at least so many vowel-consonant pairs."""
    return _fits(word, f"^({_C})?" + f"{_V}{_C}" * least)


def _cut_off(n: int) -> str:
    return f"left(s, length(s) - {n})"


def _short(word: str) -> str:
    """One pair, and an end that is short."""
    return f"({_fits(word, f'^({_C})?{_V}{_C}({_V})?$')} AND ({_fits(word, f'^{_C}[aeiouy][^aeiouwxy]$')} OR {_fits(word, '^[aeiou][^aeiou]$')}))"


def _swaps(rules, least: int) -> str:
    whens = [
        f"WHEN ends_with(s, '{old}') THEN CASE WHEN {_over(_cut_off(len(old)), least)} THEN {_cut_off(len(old))} || '{new}' ELSE s END"
        for old, new in rules
    ]
    return f"CASE {' '.join(whens)} ELSE s END"


def _stem_steps() -> list[str]:
    one = f"{_fits('t', f'^({_C})?{_V}{_C}({_V})?$')}"
    drops = [
        f"WHEN ends_with(s, '{end}') THEN CASE WHEN {_over(_cut_off(len(end)), 2)}"
        + (f" AND right({_cut_off(3)}, 1) IN ('s', 't')" if end == "ion" else "")
        + f" THEN {_cut_off(len(end))} ELSE s END"
        for end in porter.DROPPED
    ]
    tense = f"""CASE WHEN t IS NULL THEN s
        WHEN ends_with(t, 'at') OR ends_with(t, 'bl') OR ends_with(t, 'iz') THEN t || 'e'
        WHEN length(t) > 1 AND right(t, 1) = right(left(t, length(t) - 1), 1) AND NOT {_fits('t', f'^({_C})?({_V}{_C})*{_V}$')}
        THEN CASE WHEN right(t, 1) IN ('l', 's', 'z') THEN t ELSE left(t, length(t) - 1) END
        WHEN {one} AND {_short('t')} THEN t || 'e' ELSE t END"""
    return [
        f"CASE WHEN ends_with(s, 'ies') THEN CASE WHEN length(s) = 4 THEN {_cut_off(1)} ELSE {_cut_off(2)} END "
        f"WHEN ends_with(s, 'sses') THEN {_cut_off(2)} WHEN ends_with(s, 's') AND NOT ends_with(s, 'ss') THEN {_cut_off(1)} ELSE s END",
        "(SELECT " + tense + f""" FROM (SELECT CASE
            WHEN ends_with(s, 'ed') AND NOT ends_with(s, 'ied') AND NOT ends_with(s, 'eed') AND {_fits(_cut_off(2), f'^({_C})?{_V}')} THEN {_cut_off(2)}
            WHEN ends_with(s, 'ing') AND {_fits(_cut_off(3), f'^({_C})?{_V}')} THEN {_cut_off(3)} END AS t) AS cut)""",
        f"CASE WHEN length(s) > 2 AND ends_with(s, 'y') AND NOT {_fits(_cut_off(1), f'^({_C})?({_V}{_C})*{_V}$')} THEN {_cut_off(1)} || 'i' ELSE s END",
        f"CASE WHEN ends_with(s, 'alli') AND {_over(_cut_off(4), 1)} THEN {_cut_off(2)} ELSE s END",
        f"CASE WHEN ends_with(s, 'logi') THEN CASE WHEN {_over(_cut_off(3), 1)} THEN {_cut_off(1)} ELSE s END ELSE {_swaps(porter.DOUBLE_SUFFIXES, 1)} END",
        _swaps(porter.SINGLE_SUFFIXES, 1),
        f"CASE {' '.join(drops)} ELSE s END",
        f"CASE WHEN ends_with(s, 'e') AND ({_over(_cut_off(1), 2)} OR ({_over(_cut_off(1), 1)} AND NOT {_short(_cut_off(1))})) THEN {_cut_off(1)} ELSE s END",
        f"CASE WHEN ends_with(s, 'll') AND {_over(_cut_off(1), 2)} THEN {_cut_off(1)} ELSE s END",
    ]


def _stems_sql(words: str) -> str:
    """CTEs up to ``stemmed(w, s)`` for the distinct words that a query ``words(w)`` gives."""
    steps = _stem_steps()
    # Past tense of -ied and -eed goes before the other endings, on the same word.
    ied = (f"CASE WHEN ends_with(s, 'ied') THEN CASE WHEN length(s) = 4 THEN {_cut_off(1)} ELSE {_cut_off(2)} END "
           f"WHEN ends_with(s, 'eed') THEN CASE WHEN {_over(_cut_off(3), 1)} THEN {_cut_off(1)} ELSE s END ELSE NULL END")
    parts = [f"st0 AS (SELECT DISTINCT w, w AS s FROM ({words}))", f"st1 AS (SELECT w, {steps[0]} AS s FROM st0)"]
    parts.append(f"st2 AS (SELECT w, coalesce({ied}, {steps[1]}) AS s FROM st1)")
    for i, step in enumerate(steps[2:], 3):
        parts.append(f"st{i} AS (SELECT w, {step} AS s FROM st{i - 1})")
    irregular = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in porter.IRREGULAR.items())
    last = f"st{len(steps)}"
    parts.append(f"stemmed AS (SELECT w, CASE w {irregular} ELSE CASE WHEN length(w) <= 2 THEN w ELSE s END END AS s FROM {last})")
    return ", ".join(parts)


_STEMS_SQL = f"""WITH said AS (SELECT doc_id, regexp_extract_all(lower(text), '[{L}]+') AS ws FROM documents),
        {_stems_sql("SELECT unnest(ws) AS w FROM said")}, one AS (
            SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM said
        ), joined AS (SELECT doc_id, string_agg(s, ' ' ORDER BY i) AS t, count(*) AS n FROM one JOIN stemmed USING (w) GROUP BY doc_id)
        SELECT doc_id, coalesce(n, 0) AS n_words, md5(coalesce(t, '')) AS stems_md5 FROM documents LEFT JOIN joined USING (doc_id)"""
_HIGHLIGHT_SQL = f"""WITH n AS (SELECT count(*) AS n FROM benchmark), qs AS (
            SELECT item_id, regexp_extract_all(lower(text), '[{L}]+') AS qw FROM benchmark
        ), paired AS (SELECT doc_id, item_id, trim(regexp_replace(regexp_replace(text, '[^a-zA-Z0-9{W}]', '', 'g'), '[{W}]+', ' ', 'g')) AS t
            FROM documents, n JOIN qs ON qs.item_id = doc_id % n.n
        ), toks AS (SELECT doc_id, item_id, unnest(regexp_extract_all(t, '{_TOKEN}')) AS tok, generate_subscripts(regexp_extract_all(t, '{_TOKEN}'), 1) AS i FROM paired),
        {_stems_sql("SELECT lower(tok) AS w FROM toks UNION SELECT unnest(qw) FROM qs")}, wanted AS (
            SELECT DISTINCT item_id, s FROM (SELECT item_id, unnest(qw) AS w FROM qs) JOIN stemmed USING (w)
        ), marked AS (SELECT doc_id, string_agg(CASE WHEN wanted.s IS NOT NULL AND regexp_matches(tok, '^[{L}]+$')
                THEN '<mark>' || tok || '</mark>' ELSE tok END, '' ORDER BY i) AS m
            FROM toks JOIN stemmed ON stemmed.w = lower(tok) LEFT JOIN wanted ON wanted.item_id = toks.item_id AND wanted.s = stemmed.s GROUP BY doc_id)
        SELECT doc_id, coalesce(m, '') AS highlighted FROM paired LEFT JOIN marked USING (doc_id)"""

ORACLE = {
    "stems": _STEMS_SQL,
    "highlight": _HIGHLIGHT_SQL,
    "highlighted_by_table": _HIGHLIGHT_SQL,
    "clean_text": rf"""SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[^a-zA-Z0-9{W}]', '', 'g'), '[{W}]+', ' ', 'g'))
        AS cleaned FROM documents""",
    "tokens": f"""SELECT doc_id, len(t) AS n_tokens, len(list_distinct(t)) AS n_distinct, array_to_string(t, '') = text AS lossless
        FROM (SELECT doc_id, text, regexp_extract_all(text, '{_TOKEN}') AS t FROM documents)""",
    "query_terms": f"""SELECT item_id, array_to_string(regexp_extract_all(lower(text), '[^{W}]+'), '|') AS terms FROM benchmark""",
    "highlight_words": f"""WITH n AS (SELECT count(*) AS n FROM benchmark), qs AS (
            SELECT item_id, regexp_extract_all(lower(text), '[{L}]+') AS qw FROM benchmark
        ), paired AS (SELECT doc_id, text, qw FROM documents, n JOIN qs ON qs.item_id = doc_id % n.n)
        SELECT doc_id, array_to_string(list_transform(regexp_extract_all(text, '{_TOKEN}'), lambda t:
            CASE WHEN list_contains(qw, lower(t)) THEN '<mark>' || t || '</mark>' ELSE t END), '') AS highlighted FROM paired""",
}
