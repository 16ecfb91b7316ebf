"""Benchmark passages in documents: a prefix-filtered join of word shingles, verified over whole windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumflow.llm.common import whole, written
from vellumflow.session import BROADCAST_BYTES

WINDOW, SHINGLE = 10, 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAPS = r"[\x00-/:-@\[-`{-\x7f]+"


def words(text: str) -> Column:
    """The words of a text, A-Z as small letters; null has none."""
    return F.filter(F.split(F.translate(whole(text), UPPER, LOWER), GAPS), lambda w: F.length(w) > 0)


def _phrase(at: str, k: str, most: int) -> Column:
    """``k`` words from place ``at``, joined by spaces."""
    parts = [F.when(F.col(k) > i, F.get("words", F.col(at) + i)) for i in range(most)]
    return F.concat_ws(" ", *parts)


def _fits(df: DataFrame, row_bytes: int) -> DataFrame:
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def item_windows(benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, id: str = "item_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Distinct windows (window_id, phrase, m, k) of all items, and which items hold them (window_id, item).

    ``m`` words to a window, ``k`` of them to a shingle: all words of items that are shorter.
    """
    items = benchmark.select(F.col(id).cast("string").alias("item"), words(text).alias("words")).withColumn("n", F.size("words")).where("n > 0")
    items = items.withColumn("m", F.least(F.lit(window), "n"))
    rows = items.select("item", "m", F.explode(F.expr("transform(sequence(0, n - m), i -> array_join(slice(words, i + 1, m), ' '))")).alias("phrase"))
    # Two digests of 64 bits and the length name a window.
    name = F.concat_ws(":", "m", F.md5(F.col("phrase").cast("binary")))
    rows = written(rows.withColumn("window_id", name).distinct(), "windows")
    known = rows.groupBy("window_id").agg(F.min("phrase").alias("phrase"), F.min("m").alias("m")).withColumn("k", F.least(F.lit(shingle), "m"))
    return written(known, "windows"), rows.select("window_id", "item").distinct()


def shingles(windows: DataFrame) -> DataFrame:
    """(window_id, m, k, offset, phrase): every run of ``k`` words in each window."""
    at = windows.withColumn("words", F.split("phrase", " ")).select("window_id", "m", "k", "words", F.explode(F.expr("sequence(0, m - k)")).alias("offset"))
    return at.select("window_id", "m", "k", "offset", F.array_join(F.expr("slice(words, offset + 1, k)"), " ").alias("phrase"))


def shingle_hits(docs: DataFrame, tokens: DataFrame, sizes: list[int], text: str = "text") -> DataFrame:
    """(row, id, n_words, at, k, token): one row for each place of a document where a known shingle stands, and one with a null ``token`` for each document.

    Texts are read once. A shingle is looked up by a hash of its words and taken where the words themselves
    are equal. Tokens go to every task if they fit; else shingles are shuffled, each with its own words only.
    """
    few = tokens.count() * 100 <= BROADCAST_BYTES
    known = tokens.select(F.col("hash").alias("h"), "token", F.col("phrase").alias("known"))
    rows = docs.select("id", words(text).alias("words")).withColumn("row", F.monotonically_increasing_id()).withColumn("n_words", F.size("words"))
    c = len(sizes)
    last = F.greatest(F.lit(-1), F.col("n_words") * c - 1)
    spread = rows.select("row", "id", "n_words", "words", F.explode(F.sequence(F.lit(-1), last)).alias("i"))
    size = F.lit(sizes[0] if sizes else 0)
    for j, k in list(enumerate(sizes))[1:]:
        size = F.when(F.col("i") % c == j, k).otherwise(size)
    spread = spread.withColumn("at", F.when(F.col("i") < 0, -1).otherwise(F.expr(f"cast(i div {max(c, 1)} as int)"))).withColumn("k", size)
    spread = spread.where((F.col("at") < 0) | (F.col("at") + F.col("k") <= F.col("n_words")))
    phrase = F.when(F.col("at") >= 0, _phrase("at", "k", max(sizes, default=1)))
    # A document's own row has a key that spreads it and no phrase that could be equal to one.
    key = F.when(F.col("at") >= 0, F.xxhash64(phrase)).otherwise(F.col("row"))
    spread = spread.select("row", "id", "n_words", "at", "k", key.alias("key"), phrase.alias("phrase"))
    met = spread.join(F.broadcast(known) if few else known, (F.col("key") == F.col("h")) & F.col("phrase").eqNullSafe(F.col("known")), "left")
    return met.where("token is not null or at < 0").select("row", "id", "n_words", "at", "k", "token")


def occurrences(hits: DataFrame, windows: DataFrame, parts: DataFrame, tokens: DataFrame) -> DataFrame:
    """(row, start, m, window_id): every place where a whole window stands.

    A window can only stand where its rarest shingle does: with all of its
    shingles needed, a prefix of one is enough. Shingles are ordered by how often
    they occur in the documents, windows with a shingle that never occurs are out. A candidate
    must lie within its document by place and length; then those shingles of it that cover
    all its words are looked up at their places.
    """
    places = hits.where("token is not null").select("row", "n_words", "at", "token")
    often = _fits(written(places.groupBy("token").agg(F.count("*").alias("often")), "often"), 40)
    ranked = parts.join(tokens, "phrase").select("window_id", "m", "k", "offset", "token").join(often, "token")
    full = ranked.groupBy("window_id", "m", "k").agg(
        F.count("*").alias("known"), F.min(F.struct("often", "token", "offset")).alias("rarest"), F.collect_list(F.struct("offset", "token")).alias("shingles")
    )
    full = full.where("known = m - k + 1")
    # Every k-th shingle and the last one cover the window.
    cover = F.filter("shingles", lambda s: (s["offset"] % F.col("k") == 0) | (s["offset"] == F.col("m") - F.col("k")))
    full = written(full.select("window_id", "m", F.col("rarest.token").alias("token"), F.col("rarest.offset").alias("offset"), cover.alias("cover")), "rarest")
    found = places.join(_fits(full, 300), "token").withColumn("start", F.col("at") - F.col("offset"))
    found = found.where("start >= 0 and start + m <= n_words")
    checks = found.select("row", "start", "m", "window_id", F.size("cover").alias("needed"), F.explode("cover").alias("c"))
    checks = checks.select("row", "start", "m", "window_id", "needed", (F.col("start") + F.col("c.offset")).alias("at"), F.col("c.token").alias("token"))
    right = checks.join(places.select("row", "at", "token"), ["row", "at", "token"])
    return right.groupBy("row", "start", "m", "window_id").agg(F.count("*").alias("n"), F.min("needed").alias("needed")).where("n = needed").drop("n", "needed")


def spans(found: DataFrame) -> DataFrame:
    """(row, n_hit, spans): the words under any occurrence, and the maximal runs of them as (start, end)."""
    by_row = Window.partitionBy("row").orderBy("start", "end")
    ends = found.select("row", "start", (F.col("start") + F.col("m")).alias("end")).distinct()
    reach = F.max("end").over(by_row.rowsBetween(Window.unboundedPreceding, -1))
    opened = ends.withColumn("new", (reach.isNull() | (F.col("start") > reach)).cast("int"))
    runs = opened.withColumn("run", F.sum("new").over(by_row)).groupBy("row", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return runs.groupBy("row").agg(F.sum(F.col("end") - F.col("start")).cast("long").alias("n_hit"), F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, n_words, n_hit, spans, item_set) and item sets (item_set, items): where windows of benchmark items stand in each document.

    Documents that hold the same windows share one set of items, so a passage
    that many items and many documents have costs neither their product. ``items`` is sorted as
    strings. Work on one document is bounded by its words.

    Nulls: a null text has no words; a null id is a document like any other; the words of an
    item of null id count, but it has no name to be listed by. An item of several rows
    is listed once. Repeated documents come as often as given. An item without
    words has no window. No items: no hits. No documents: no rows. Other columns are not looked at.
    """
    windows, holders = item_windows(benchmark, window, shingle, item, item_text)
    parts = shingles(windows)
    sizes = sorted(r["k"] for r in windows.select("k").distinct().collect())  # at most ``shingle`` values
    phrases = parts.select("phrase").distinct().withColumn("token", F.monotonically_increasing_id()).withColumn("hash", F.xxhash64("phrase"))
    tokens = written(phrases, "tokens")
    hits = written(shingle_hits(docs.select(F.col(id).alias("id"), F.col(text).alias("text")), tokens, sizes), "hits")
    found = written(occurrences(hits, windows, parts, tokens), "occurrences")
    sets = found.groupBy("row").agg(F.sort_array(F.collect_set("window_id")).alias("ids"))
    sets = written(sets.withColumn("item_set", F.sha2(F.array_join("ids", ",").cast("binary"), 256)), "sets")
    one = sets.groupBy("item_set").agg(F.any_value("ids").alias("ids")).select("item_set", F.explode("ids").alias("window_id"))
    items = one.join(holders, "window_id").where(F.col("item").isNotNull()).groupBy("item_set").agg(F.sort_array(F.collect_set("item")).alias("items"))
    rows = hits.where("at < 0").select("row", F.col("id").alias("doc_id"), F.col("n_words").cast("long").alias("n_words"))
    made = rows.join(spans(found), "row", "left").join(sets.select("row", "item_set"), "row", "left")
    return made.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), "spans", "item_set"), items
