"""One query for each operator, over whole tables and with production parameters, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumflow.llm import bpe, coder, contamination, curves, divergence, licenses, main_text, packing, quality, repeats, sharding, simhash, trie
from vellumflow.llm.common import table, written
from vellumflow.session import few

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"), 40)


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.nearest(table(spark, sf_dir, "embeddings"), k=10, every=100)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = bpe.decode(bpe.encode(docs, MULTI, public_tokenizers.PATTERN).drop("text"), MULTI)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(bpe.ids_text("ids").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.digests(packing.pack(table(spark, sf_dir, "documents"), WORDS))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repeats.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "digest", "license", "n_notices", F.array_join("notices", "|").alias("notices"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_of().alias("fingerprint"), "component_id")


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("html")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = quality.judged(docs, table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_coder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coder.stored_ids(table(spark, sf_dir, "documents"), WORDS)


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, sets = contamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digests = sets.select("item_set", F.size("items").cast("long").alias("n"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("digest"))
    digests = few(written(digests, "digests"))
    return rows.join(digests, "item_set", "left").select(
        "doc_id", "n_words", "n_hit", F.coalesce("n", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("digest", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = trie.build(table(spark, sf_dir, "conversations"))
    rows = made.nodes.join(trie.end_digests(made.ends), trie.KEY, "left")
    return rows.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


QUERIES = {f.__name__: f for f in (op1_sharding, op2_neighbours, op3_bpe, op4_packing, op5_repeats, op6_licenses, op7_simhash, op8_main_text, op9_quality, op10_coder, op11_divergence, op12_contamination, op13_trie)}

# The crc32 of bytes by its table of 256 remainders, which the fixed polynomial gives.
REMAINDERS = """remainders AS (
  SELECT list(r ORDER BY b) AS rem FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS r
    FROM range(256) t(b))
)"""
OP1_SQL = f"""
WITH {REMAINDERS}, sized AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 16 AS size,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT)) AS bytes
  FROM documents
), rows_ AS (
  SELECT doc_id, CAST(size AS BIGINT) AS size,
         CASE WHEN len(bytes) = 0 THEN 0
              ELSE xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes), lambda c, b: xor(c >> 8, rem[1 + xor(c, b) % 256])), 4294967295)
         END AS text_crc32
  FROM sized, remainders
), placed AS (
  SELECT *, 2 * sum(size) OVER upto - size AS middle, 2 * sum(size) OVER () AS all2
  FROM rows_ WINDOW upto AS (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING)
), cut AS (
  SELECT *, CAST(least(39, middle * 40 // all2) AS INTEGER) AS shard FROM placed
)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM cut"""


def _canonical_sql(text: str) -> str:
    out = f"translate({text}, '{licenses.UPPER}', '{licenses.LOWER}')"
    lines = rf"(?m)^{licenses.MARGIN}(?:{licenses.OWNER}[^\n]*|{licenses.TITLE})$".replace("'", "''")
    out = f"regexp_replace({out}, '{lines}', '', 'g')"
    out = f"' ' || regexp_replace({out}, '{licenses.SIGNS}', ' ', 'g') || ' '"
    for old, new in licenses.SAME:
        out = f"replace({out}, ' {old} ', ' {new} ')"
    return f"trim(regexp_replace({out}, ' +', ' ', 'g'))"


_DIGESTS_SQL = ", ".join(f"({len(licenses.KNOWN) + i}, '{a}', '{b}')" for i, (a, b) in enumerate(licenses.DIGESTS))
_KNOWN_SQL = ", ".join("({}, '{}', '{}')".format(i, a, b.replace("'", "''")) for i, (a, b) in enumerate(licenses.KNOWN))
OP6_SQL = f"""
WITH known AS (
  SELECT digest, arg_min(name, i) AS license FROM (
    SELECT i, name, md5({_canonical_sql("t")}) AS digest FROM (VALUES {_KNOWN_SQL}) v(i, name, t)
    UNION ALL SELECT * FROM (VALUES {_DIGESTS_SQL}) w(i, name, digest)
  ) GROUP BY 1
), lines AS (
  SELECT doc_id, md5({_canonical_sql("line")}) AS digest FROM (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents
  ) WHERE length(line) > 0
), found AS (
  SELECT doc_id, count(*) AS n_notices, array_to_string(list_sort(list_distinct(list(license))), '|') AS notices
  FROM lines JOIN known USING (digest) GROUP BY doc_id
), texts AS (
  SELECT doc_id, md5({_canonical_sql("coalesce(text, '')")}) AS digest FROM documents
)
SELECT t.doc_id, t.digest, k.license, coalesce(f.n_notices, 0) AS n_notices, coalesce(f.notices, '') AS notices
FROM texts t LEFT JOIN known k ON k.digest = t.digest LEFT JOIN found f ON f.doc_id IS NOT DISTINCT FROM t.doc_id"""

OP11_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), found AS (
  SELECT r, lang, source, term, count(*) AS n FROM (SELECT r, lang, source, unnest(terms) AS term FROM docs) GROUP BY ALL
), kept AS (
  SELECT lang, term FROM found GROUP BY lang, term HAVING count(*) >= 3
), sizes AS (
  SELECT l.lang, count(k.term) AS v FROM (SELECT DISTINCT lang FROM docs) l LEFT JOIN kept k ON k.lang = l.lang GROUP BY l.lang
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), counts AS (
  SELECT lang, source, term, CAST(sum(n) AS HUGEINT) AS n FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL
), full_ AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, v,
         sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total,
         sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, k.term) AS all_n,
         sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang) AS all_total
  FROM groups g JOIN kept k ON k.lang = g.lang JOIN sizes s ON s.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), shares AS (
  SELECT lang, source, term, n, 1 + 1000000000 * (n + 1) // (total + v) AS p, 1 + 1000000000 * (all_n + 1) // (all_total + v) AS q FROM full_
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL
), rows_ AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(p.value, 0) AS value
  FROM groups g JOIN groups h ON h.lang = g.lang AND h.source <> g.source LEFT JOIN pairs p ON p.lang = g.lang AND p.source = g.source AND p.item = h.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM rows_
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, rank FROM ranked WHERE part = 'pair' OR rank <= 200"""

OP13_SQL = f"""
WITH {REMAINDERS}, turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL
), lists AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, left(role, 64), left(text, 64), md5(octet_length(encode(role)) || ':' || role || text)) AS own
  FROM turns GROUP BY conv_id
), bytes AS (
  SELECT *, list_transform(regexp_extract_all(hex(encode(CAST(conv_id AS VARCHAR))), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS bytes FROM lists
), heads AS (
  SELECT conv_id, own, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes), lambda c, b: xor(c >> 8, rem[1 + xor(c, b) % 256])), 4294967295) % 6 AS h
  FROM bytes, remainders
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.own[1:c.h], []), c.own[c.h + 1:]) AS turns
  FROM heads c LEFT JOIN lists b ON b.conv_id = c.conv_id - c.conv_id % 100
), members AS (
  SELECT conv_id, d, turns[1:d] AS node, len(turns) = d AS ends, CASE WHEN d > 0 THEN length(turns[d].text) ELSE 0 END AS chars
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY node, d
), children AS (
  SELECT node[1:d - 1] AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1
), known AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c USING (node)
), under AS (
  SELECT node[1:k] AS node, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * chars) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM known) GROUP BY 1
)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, u.n_leaves, CAST(u.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM known n JOIN under u USING (node) LEFT JOIN nodes p ON n.d > 0 AND p.node = n.node[1:n.d - 1]"""

_WORDS_SQL = f"list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{contamination.UPPER}', '{contamination.LOWER}'), '{contamination.GAPS}'), lambda w: w <> '')"
OP12_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS_SQL} AS words FROM documents
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS_SQL} AS words FROM benchmark
), windows AS (
  SELECT DISTINCT item, m, array_to_string(words[i + 1:i + m], ' ') AS phrase
  FROM (SELECT *, unnest(range(0, len(words) - m + 1)) AS i FROM (SELECT *, least(10, len(words)) AS m FROM items) WHERE m > 0)
), sizes AS (
  SELECT DISTINCT m FROM windows
), placed AS (
  SELECT r, i, list(w) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS following
  FROM (SELECT r, unnest(words) AS w, unnest(range(0, len(words))) AS i FROM docs)
), places AS (
  SELECT r, m, i, array_to_string(following[1:m], ' ') AS phrase FROM placed, sizes WHERE len(following) >= m
), found AS (
  SELECT DISTINCT p.r, p.m, p.i, w.item FROM places p JOIN windows w ON w.m = p.m AND w.phrase = p.phrase
), hit AS (
  SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS place FROM found) GROUP BY r
), named AS (
  SELECT r, count(item) AS n_items, sha256(coalesce(string_agg(item, ',' ORDER BY item), '')) AS items_sha256 FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
)
SELECT d.doc_id, len(d.words) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(n.n_items, 0) AS n_items,
       coalesce(n.items_sha256, sha256('')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit h USING (r) LEFT JOIN named n USING (r)"""

ORACLE = {"op1_sharding": OP1_SQL, "op6_licenses": OP6_SQL, "op11_divergence": OP11_SQL, "op12_contamination": OP12_SQL, "op13_trie": OP13_SQL}
