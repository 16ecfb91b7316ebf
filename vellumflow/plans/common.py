"""What the registered queries share: reading tables, and flat result columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellumflow.session import spread
from vellumflow.sources.text_layout import text_layout

# The same character classes as in ``functions.text``, for SQL.
W = r"\t-\r\x1c-\x20\x85\p{Z}"
L = r"\p{L}\p{N}_"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table whose rows cost much to work on, over all cores."""
    return spread(table(spark, sf_dir, name), key)


def flat(df: DataFrame) -> DataFrame:
    """Arrays as text, so that results compare as plain columns."""
    out = []
    for field in df.schema.fields:
        column: Column = F.col(field.name)
        if isinstance(field.dataType, T.ArrayType):
            column = F.array_join(F.transform(column, lambda x: x.cast("string")), "|")
        out.append(column.alias(field.name))
    return df.select(*out)


def document_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir, "documents", "doc_id")
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    return text_layout(docs, F.md5(F.concat(F.lit("/documents/"), name)), name, size="n_chars")


# --- SQL for the same things --------------------------------------------------------------

# Items of the documents; ``blk`` keeps a final line break that ``text`` has not.
ITEMS_SQL = rf"""
blocks AS (
  SELECT doc_id, list_filter(regexp_extract_all(text, '(?:[^\n|]*\|[^\n]*(?:\n|\z))+|[^\n]+'),
                             lambda b: regexp_matches(b, '[^{W}]')) AS bl
  FROM documents
), rawitems AS (
  SELECT doc_id, unnest(bl) AS blk, generate_subscripts(bl, 1) - 1 AS seq FROM blocks
), items AS (
  SELECT doc_id, md5('/documents/' || doc_id || '.txt') AS input_hash, doc_id || '.txt' AS filename, seq,
         CASE WHEN contains(blk, '|') THEN 'table' ELSE 'text' END AS label,
         CASE WHEN contains(blk, '|') THEN '#/tables/' ELSE '#/texts/' END || seq AS ref,
         seq // 40 + 1 AS page,
         regexp_replace(blk, '\n\z', '') AS text
  FROM rawitems
)"""

TEXT_CHUNKS_SQL = rf"""
counted AS (
  SELECT *, regexp_extract_all(text, '[{W}]*[^{W}]+') AS terms FROM items WHERE label = 'text'
), cutup AS (
  SELECT *, unnest(range(CAST(ceil(len(terms) / 200.0) AS BIGINT))) AS j FROM counted
), pieces AS (
  SELECT doc_id, input_hash, filename, seq, page, ref, j, least(200, len(terms) - j * 200) AS n,
         CASE WHEN len(terms) <= 200 THEN text
              ELSE regexp_replace(array_to_string(terms[j * 200 + 1 : j * 200 + 200], ''), '^[{W}]+|[{W}]+$', '', 'g')
         END AS text,
         row_number() OVER (PARTITION BY doc_id ORDER BY seq, j) - 1 AS i
  FROM cutup
), packed AS (
  SELECT doc_id, i, n AS open, i AS start FROM pieces WHERE i = 0
  UNION ALL
  SELECT p.doc_id, p.i, CASE WHEN k.open + p.n > 200 THEN p.n ELSE k.open + p.n END,
         CASE WHEN k.open + p.n > 200 THEN p.i ELSE k.start END
  FROM packed k JOIN pieces p ON p.doc_id = k.doc_id AND p.i = k.i + 1
), textchunks AS (
  SELECT any_value(filename) AS filename, input_hash,
         array_to_string(list_sort(list_distinct(list(page))), '|') AS pages,
         array_to_string(list_transform(list_sort(list_distinct(list(seq))), lambda s: '#/texts/' || s), '|') AS doc_refs,
         string_agg(text, chr(10) ORDER BY i) AS text,
         md5(input_hash || '/text/' || arg_min(ref, i) || '/' || arg_min(j, i)) AS id
  FROM packed JOIN pieces USING (doc_id, i) GROUP BY doc_id, input_hash, start
)"""

LETTERS_SQL = "['" + "','".join("abcdefghijklmnopqrstuvwxyz") + "']"


def letters_sql(text: str) -> str:
    """Letter counts of a text, as the stand-in embedder makes them."""
    return (
        f"list_transform({LETTERS_SQL}, lambda c: "
        f"CAST(length(lower({text})) - length(replace(lower({text}), c, '')) AS DOUBLE))"
    )
