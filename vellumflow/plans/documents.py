"""Registered queries over documents and pages: ingest, layout, chunks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumflow.functions import refs, stubs, templates
from vellumflow.operators import chunking, enrich, graph
from vellumflow.plans.common import ITEMS_SQL, TEXT_CHUNKS_SQL, W, document_layout, flat, table, texts
from vellumflow.session import new_folder, settled
from vellumflow.sources import conversions, drivers, files, landing, store, structure
from vellumflow.sources.html_layout import html_layout, html_seconds, register_html_items
from vellumflow.sources.text_layout import flat_items, nested_items, text_layout

MODEL = "size-describer"


# --- ingest ----------------------------------------------------------------------------


def _driver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("document_name"),
        F.col("url").alias("document_url"),
    )


def driver_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "driver-list")
    _driver_rows(spark, sf_dir).write.option("header", True).csv(path)
    return drivers.read_driver_list(spark, path)


def fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = drivers.fetch_bytes(_driver_rows(spark, sf_dir), lambda: stubs.url_fetcher(), tasks=spark.sparkContext.defaultParallelism)
    path = new_folder(spark, "bronze")
    store.write_bronze(got.select("document_name", "document_url", "status", "bytes"), path)
    return store.read_bronze(spark, path).select(
        "document_name", F.col("status").cast("bigint").alias("status"), F.md5("bytes").alias("body_md5")
    )


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "landing").removeprefix("file:")
    got = drivers.fetch_bytes(_driver_rows(spark, sf_dir), lambda: stubs.url_fetcher(), tasks=spark.sparkContext.defaultParallelism)
    written = drivers.write_files(got, drivers.landing_path(folder, F.col("document_name")), F.col("bytes"))
    return settled(written.select("document_name", "downloaded"))


def landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page landed through the sink, on a path with a scheme, and read back."""
    folder = new_folder(spark, "landing")
    folder = folder if "://" in folder else "file://" + folder.removeprefix("file:")
    name = F.concat(F.lit("pages/"), F.col("page_id").cast("string"), F.lit(".html"))
    landing.land(texts(spark, sf_dir, "pages", "page_id").select(name.alias("name"), F.col("html").cast("binary").alias("bytes")), folder)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return found.select(F.regexp_extract("path", "pages/[0-9]+[.]html$", 0).alias("name"), F.md5("content").alias("body_md5"))


def folder_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "scan").removeprefix("file:")
    suffix = F.when(F.startswith("url", F.lit("https")), F.lit(".pdf")).otherwise(F.lit(".PDF"))
    path = F.concat(F.lit(folder + "/"), F.col("page_id").cast("string"), suffix)
    pages = texts(spark, sf_dir, "pages", "page_id")
    settled(drivers.write_files(pages, path, F.col("html").cast("binary")).select("page_id", "downloaded"))
    return files.scan_folder(spark, folder, with_bytes=True).select("filename", "size", "content_md5")


def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    key = refs.path_key(F.concat(F.lit("file:/volumes/bronze/"), F.col("page_id").cast("string"), F.lit(".pdf")))
    return pages.select(
        key.alias("input_hash"),
        refs.output_path("/volumes/silver", key).alias("output_path"),
        refs.image_path("/volumes/silver", key, F.lit("tables"), F.concat(F.lit("#/tables/"), F.col("page_id"))).alias("image_path"),
    )


def _keyed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, sf_dir, name).select("doc_id", F.md5(F.col("doc_id").cast("string")).alias("input_hash"))


def pending_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.pending(_keyed(spark, sf_dir, "documents"), _keyed(spark, sf_dir, "labels"))


def reused_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.reused(_keyed(spark, sf_dir, "documents"), _keyed(spark, sf_dir, "labels"))


def _convert_text(docs: DataFrame) -> DataFrame:
    return text_layout(docs, F.col("input_hash"), F.col("filename"), size="n_chars")


def _convert_late(docs: DataFrame) -> DataFrame:
    return _convert_text(docs.withColumn("filename", F.concat(F.lit("late "), "filename")))


def converted_or_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents are converted first; then all are asked for, and only the others are converted."""
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    docs = texts(spark, sf_dir, "documents", "doc_id").withColumn("filename", name)
    docs = docs.withColumn("input_hash", F.md5(F.concat(F.lit("/documents/"), "filename")))
    path = new_folder(spark, "conversions")
    labelled = docs.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    conversions.convert_or_load(labelled, path, _convert_text)
    items = flat_items(conversions.convert_or_load(docs, path, _convert_late))
    return items.select("input_hash", "filename", F.col("seq").cast("bigint").alias("seq"), "ref", "label", "text")


# --- layout ------------------------------------------------------------------------------


def text_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = flat_items(document_layout(spark, sf_dir))
    return flat(items.select("input_hash", "filename", F.col("seq").cast("bigint").alias("seq"), "ref", "label",
                             F.get("page_nos", F.lit(0)).cast("bigint").alias("page"), "text"))


def page_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = texts(spark, sf_dir, "pages", "page_id")
    name = F.concat(F.col("page_id").cast("string"), F.lit(".html"))
    return html_layout(pages, F.md5(F.concat(F.lit("/pages/"), name)), name)


def stored_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layout of the pages, written once and read back: the reader of HTML runs once."""
    path = new_folder(spark, "layout")
    store.save_layout(page_layout(spark, sf_dir), path)
    return store.load_layout(spark, path)


def html_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = flat_items(page_layout(spark, sf_dir))
    return items.select("input_hash", "filename", F.col("seq").cast("bigint").alias("seq"), "ref", "label",
                        F.array_join("headings", "|").alias("headings"), "text")


def html_text_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(chunking.text_chunks(stored_layout(spark, sf_dir)).select(
        "filename", "pages", "doc_refs", "headings", "text", "enriched_text", "id"))


def heading_in_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = flat_items(page_layout(spark, sf_dir)).select("input_hash", "seq", "label", "text")
    return enrich.heading_in_force(items).select("input_hash", F.col("seq").cast("bigint").alias("seq"), "heading")


def _structured(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir, "documents", "doc_id")
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    path = new_folder(spark, "structured")
    laid = structure.structured_layout(docs, F.md5(F.concat(F.lit("/documents/"), name)), name, size="n_chars")
    store.save_layout(laid, path)
    return store.load_layout(spark, path)


def structured_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of the documents with the headings that the shape of their lines tells."""
    items = flat_items(_structured(spark, sf_dir))
    return items.select("filename", F.col("seq").cast("bigint").alias("seq"), "ref", "label", F.col("level").cast("bigint").alias("level"),
                        F.array_join("headings", "|").alias("headings"), F.col("run").cast("bigint").alias("run"), "text")


def structured_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(chunking.text_chunks(_structured(spark, sf_dir)).select("filename", "pages", "doc_refs", "headings", "text", "id"))


def markdown_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as Markdown, read back as plain text: headings are the same as in the page."""
    texts_of = store.markdown(stored_layout(spark, sf_dir))
    laid = structure.structured_layout(texts_of, F.col("input_hash"), F.col("filename"), text="markdown")
    return flat_items(laid).select("filename", F.col("seq").cast("bigint").alias("seq"), F.array_join("headings", "|").alias("headings"), "text")


def markdown_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.markdown(document_layout(spark, sf_dir)).select("filename", F.md5("markdown").alias("markdown_md5"),
                                                                 F.length("markdown").cast("bigint").alias("n_chars"))


# --- chunks -----------------------------------------------------------------------------------


def text_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(chunking.text_chunks(document_layout(spark, sf_dir)))


def captioned_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.describe_tables(document_layout(spark, sf_dir), lambda: stubs.size_describer())


def table_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(chunking.table_chunks(captioned_layout(spark, sf_dir)))


def table_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = flat_items(captioned_layout(spark, sf_dir)).where("label = 'caption'")
    return items.select("input_hash", "ref", F.get("page_nos", F.lit(0)).cast("bigint").alias("page"), "text")


def _described(layout: DataFrame) -> DataFrame:
    return enrich.describe_pages(chunking.page_table(layout), lambda: stubs.size_describer(), MODEL)


def page_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _described(document_layout(spark, sf_dir)).select(
        "input_hash", F.col("page").cast("bigint").alias("page"), "description", "provenance", "error"
    )


def page_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(chunking.page_chunks(_described(document_layout(spark, sf_dir))))


def all_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "layout")
    store.save_layout(document_layout(spark, sf_dir), path)
    layout = store.load_layout(spark, path)
    chunks = chunking.all_chunks(layout, _described(layout))
    wanted = store.retrieval_columns("text", "filename", "id", ["chunk_type", "input_hash", "pages", "enriched_text"])
    return flat(chunking.in_output_order(store.scan_chunks(chunks, wanted)))


def picture_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector as a picture of the document of its label."""
    vectors = table(spark, sf_dir, "embeddings")
    none = F.array().cast("array<string>")
    items = vectors.select(
        F.md5(F.concat(F.lit("label/"), F.col("label"))).alias("input_hash"),
        F.concat(F.lit("label-"), F.col("label")).alias("filename"),
        F.col("vec_id").cast("int").alias("seq"),
        F.concat(F.lit("#/pictures/"), F.col("vec_id")).alias("ref"),
        F.lit("picture").alias("label"),
        F.lit(1).alias("level"),
        F.array(F.lit(2), F.floor(F.col("vec_id") / 100).cast("int") + 1, F.lit(2)).alias("page_nos"),
        F.array(F.concat(F.lit("#/texts/"), F.col("vec_id"))).alias("children"),
        none.alias("caption_refs"),
        F.array().cast(f"array<{enrich.ANNOTATION}>").alias("annotations"),
        none.alias("headings"),
        F.lit(-1).alias("run"),
        F.concat(F.lit("picture "), F.col("vec_id"), F.lit(" of "), F.col("label")).alias("text"),
    )
    return nested_items(items)


def _pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = enrich.describe_pictures(picture_layout(spark, sf_dir), lambda: stubs.size_describer(), MODEL)
    return enrich.classify_pictures(described)


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image bytes for the pictures whose vector begins above zero; the others have none."""
    vectors = table(spark, sf_dir, "embeddings")
    return vectors.select(
        F.md5(F.concat(F.lit("label/"), F.col("label"))).alias("input_hash"),
        F.lit("pictures").alias("kind"),
        F.col("vec_id").cast("string").alias("ref"),
        F.when(F.get("embedding", F.lit(0)) > 0, F.concat(F.lit("image "), F.col("vec_id")).cast("binary")).alias("bytes"),
    )


def picture_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = store.image_paths(images(spark, sf_dir), "/volumes/silver")
    return flat(chunking.picture_chunks(_pictures(spark, sf_dir), located))


def picture_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = flat_items(_pictures(spark, sf_dir))
    return items.select("input_hash", "ref", F.posexplode("annotations").alias("no", "a")).select(
        "input_hash",
        "ref",
        F.col("no").cast("bigint").alias("no"),
        "a.kind",
        "a.text",
        "a.provenance",
        F.get("a.predicted_classes", F.lit(0)).class_name.alias("class_name"),
        F.get("a.predicted_classes", F.lit(0)).confidence.alias("confidence"),
    )


def chunk_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = store.image_paths(images(spark, sf_dir), "/volumes/silver")
    chunks = chunking.picture_chunks(picture_layout(spark, sf_dir), located).select("id", "image_path")
    known = located.where("path is not null").select("path", "bytes")
    return files.with_images(chunks, known, strict=True).select("id", "image_path", F.md5("image").alias("image_md5"))


def image_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.array(*[F.lit(t) for t in templates.IMAGE_TYPES])
    return images(spark, sf_dir).where("bytes is not null").select("ref", "bytes", F.explode(kinds).alias("image_type")).select(
        "ref",
        "image_type",
        templates.image_request(F.col("image_type"), F.lit(200)).alias("request"),
        refs.data_url(F.col("bytes"), F.lit("image/png")).alias("url"),
    )


def single_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.single_values(table(spark, sf_dir, "documents"), "doc_id", "n_chars")


def longest_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    longest = docs.agg(F.max_by("doc_id", F.struct("n_chars", "doc_id")).alias("doc_id"))
    return files.single_value(docs.join(F.broadcast(longest), "doc_id", "left_semi"), "n_chars", F.lit(True))


def page_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", F.create_map(F.lit("url"), F.col("url")).alias("metadata"), "url")
    added = store.add_metadata(pages, "size", F.length("url"))
    again = store.add_metadata(added, "size", F.length("url") + 1)
    size = store.get_metadata(again, "size", "size")
    return store.get_metadata(size, "absent", "absent").select("page_id", "size", "absent", F.col("metadata")["url"].alias("url"))


def metadata_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.to_json(F.struct(
        F.when(F.col("toxic") == 1, F.lit("description")).otherwise(F.lit("entity")).alias("kind"),
        F.when(F.col("toxic") == 1, F.concat(F.lit("quality "), F.col("quality"))).alias("text"),
        F.when(F.col("toxic") == 0, F.col("doc_id").cast("string")).alias("id"),
    ))
    rows = table(spark, sf_dir, "labels").select("doc_id", text.alias("json"))
    both = [store.metadata_of_kind(rows, "json", kind) for kind in ("description", "entity")]
    return both[0].unionByName(both[1]).select("doc_id", "metadata.kind", "metadata.text", "metadata.id")


def _connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document is part of its source and has its language as a property."""
    docs = table(spark, sf_dir, "documents")

    def node(id_col, kind):
        return F.struct(id_col.alias("id"), F.upper(id_col).alias("label"), F.lit(kind).alias("type"),
                        F.create_map(F.lit("kind"), F.lit(kind)).alias("properties"))

    doc = node(F.concat(F.lit("doc-"), F.col("doc_id")), "document")
    parts = docs.select(doc.alias("subject"), F.lit("part_of").alias("predicate"), node(F.col("source"), "source").alias("object"))
    langs = docs.select(doc.alias("subject"), F.lit("has_property").alias("predicate"), node(F.col("lang"), "language").alias("object"))
    return parts.unionByName(langs)


def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.graph_nodes(_connections(spark, sf_dir)).select("id", "label", "type", F.col("properties")["kind"].alias("kind"))


def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.graph_edges(_connections(spark, sf_dir))


def conversion_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times taken while pages are converted; they differ from run to run, so only what must hold is shown."""
    pages = texts(spark, sf_dir, "pages", "page_id")
    timed = settled(html_seconds(pages, F.md5(F.concat(F.lit("/pages/"), F.col("page_id"))), "html"))
    told = store.seconds_per_document(timed)
    return told.select("documents", (F.col("avg_seconds") >= 0).alias("timed"), (F.col("median_seconds") > 0).alias("measured"))


# --- further forms -----------------------------------------------------------------------------


def html_page_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page chunks of web pages, whose headings are real."""
    return flat(chunking.page_chunks(_described(page_layout(spark, sf_dir)))).select(
        "filename", "input_hash", "pages", "doc_refs", "headings", "text", "enriched_text", "id"
    )


def captioned_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Picture and table chunks of pages with a captioned figure, a table with two captions, and a bare picture."""
    number = F.col("page_id").cast("string")
    page = F.concat(
        F.lit("<body><figure><img alt=chart><figcaption>Figure "), number, F.lit("</figcaption></figure><table><caption>Table "),
        number, F.lit("</caption><caption>continued<tr><th>a<th>b<tr><td>"), number, F.lit("<br>x<td></table>tail <img alt=photo>"),
    )
    pages = texts(spark, sf_dir, "pages", "page_id").select("page_id", page.alias("html"))
    layout = html_layout(pages, F.md5(F.concat(F.lit("/pages/"), number)), number)
    described = enrich.describe_pictures(layout, lambda: stubs.size_describer(), MODEL)
    chunks = chunking.picture_chunks(described).unionByName(chunking.table_chunks(described))
    return flat(chunks.select("filename", "chunk_type", "doc_refs", "captions", "text", "enriched_text", "id"))


def chunk_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text chunks written as a named table and read again."""
    name = f"chunks_{uuid.uuid4().hex}"
    store.write_chunks(chunking.text_chunks(document_layout(spark, sf_dir)), name)
    return flat(store.scan_chunks(spark.table(name), ["input_hash", "pages", "text", "id"]))


def saved_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images written to the shared folder, and where they lie below it."""
    folder = new_folder(spark, "images").removeprefix("file:").replace("//", "/")
    saved = settled(store.save_images(images(spark, sf_dir), folder))
    return saved.select("input_hash", "kind", "ref", F.replace("path", F.lit(folder), F.lit("")).alias("path"))


def html_items_in_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layout reader as a table function of SQL."""
    register_html_items(spark)
    pages = texts(spark, sf_dir, "pages", "page_id")
    return spark.sql(
        "SELECT page_id, CAST(i.seq AS BIGINT) AS seq, i.ref, i.label, i.text FROM {pages}, LATERAL html_items(html) i", pages=pages
    )


def stored_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page chunks from descriptions kept apart from the pages; those of every other page are missing."""
    pages = chunking.page_table(document_layout(spark, sf_dir))
    kept = settled(enrich.describe_pages(pages, lambda: stubs.size_describer(), MODEL).select("input_hash", "page", "description"))
    found = chunking.with_descriptions(pages, kept.where("page % 2 = 1"))
    return flat(chunking.page_chunks(found)).select("id", "text", "enriched_text")


def metadata_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classifications, relationships and connections read from JSON."""
    name = F.concat(F.lit("doc-"), F.col("doc_id"))
    node = lambda label: F.struct(name.alias("id"), label.alias("label"))
    text = F.to_json(F.struct(
        F.element_at(F.array(*map(F.lit, ("classification", "relationship", "connection"))), (F.col("doc_id") % 3 + 1).cast("int")).alias("kind"),
        F.when(F.col("doc_id") % 3 == 0, F.array(F.struct(F.col("lang").alias("class_name"), F.lit(0.5).alias("confidence")))).alias("predicted_classes"),
        F.when(F.col("doc_id") % 3 > 0, F.lit("PART_OF")).alias("predicate"),
        F.when(F.col("doc_id") % 3 == 2, node(F.col("lang"))).alias("subject"),
        F.when(F.col("doc_id") % 3 == 2, node(F.col("source"))).alias("object"),
    ))
    rows = table(spark, sf_dir, "documents").select("doc_id", text.alias("json"))
    parts = [store.metadata_of_kind(rows, "json", kind) for kind in ("classification", "relationship", "connection")]
    made = parts[0].unionByName(parts[1]).unionByName(parts[2])
    first = F.get("metadata.predicted_classes", F.lit(0))
    return made.select(
        "doc_id", "metadata.kind", first.class_name.alias("class_name"), first.confidence.alias("confidence"), "metadata.predicate",
        F.col("metadata.subject.label").alias("subject"), F.col("metadata.object.label").alias("object"),
    )


QUERIES = {
    "driver_list": driver_list,
    "fetched": fetched,
    "landed": landed,
    "landed_files": landed_files,
    "folder_scan": folder_scan,
    "paths": paths,
    "pending_documents": pending_documents,
    "reused_documents": reused_documents,
    "converted_or_loaded": converted_or_loaded,
    "text_items": text_items,
    "structured_items": structured_items,
    "structured_chunks": structured_chunks,
    "markdown_structure": markdown_structure,
    "html_items": html_items,
    "html_text_chunks": html_text_chunks,
    "heading_in_force": heading_in_force,
    "markdown_documents": markdown_documents,
    "text_chunks": text_chunks,
    "table_chunks": table_chunks,
    "table_captions": table_captions,
    "page_descriptions": page_descriptions,
    "page_chunks": page_chunks,
    "all_chunks": all_chunks,
    "picture_chunks": picture_chunks,
    "picture_annotations": picture_annotations,
    "chunk_images": chunk_images,
    "image_requests": image_requests,
    "single_values": single_values,
    "longest_document": longest_document,
    "page_metadata": page_metadata,
    "metadata_union": metadata_union,
    "graph_nodes": graph_nodes,
    "graph_edges": graph_edges,
    "conversion_summary": conversion_summary,
    "html_page_chunks": html_page_chunks,
    "captioned_chunks": captioned_chunks,
    "chunk_table": chunk_table,
    "saved_images": saved_images,
    "html_items_in_sql": html_items_in_sql,
    "stored_descriptions": stored_descriptions,
    "metadata_kinds": metadata_kinds,
}

_NL = "chr(10)"
_HTML_SQL = rf"""
articles AS (
  SELECT page_id, regexp_extract(html, '(?s)<article>(.*)</article>', 1) AS body FROM pages
), parts AS (
  SELECT page_id, 'title' AS label, 0 AS n, regexp_extract(body, '(?s)<h1>(.*?)</h1>', 1) AS raw FROM articles
  UNION ALL
  SELECT page_id, 'text', unnest(range(1, len(ps))) AS n, ps[n + 1] AS raw
  FROM (SELECT page_id, string_split(regexp_replace(body, '(?s)^.*</h1>', ''), '<p>') AS ps FROM articles)
), plain AS (
  SELECT page_id, label, n,
         trim(regexp_replace(regexp_replace(replace(replace(replace(replace(regexp_replace(regexp_replace(replace(raw, '<br>', ' '), '(?s)</p>.*$', ''),
              '<[^>]*>', '', 'g'), '&quot;', '"'), '&#x27;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'),
              '[{W}]+', ' ', 'g')) AS text
  FROM parts
), htmlitems AS (
  SELECT page_id, md5('/pages/' || page_id || '.html') AS input_hash, page_id || '.html' AS filename, label, text,
         row_number() OVER (PARTITION BY page_id ORDER BY n) - 1 AS seq
  FROM plain WHERE text <> ''
)"""

_BLOCK_RE = structure.BLOCK.replace("++", "+").replace("*+", "*")
_LEVELS = range(1, 7)


def _sql_re(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _newest(level: int) -> str:
    return f"max(CASE WHEN kind = 'head' AND level = {level} THEN {{'seq': seq, 'text': text}} END) OVER before AS h{level}"


def _still_open(level: int) -> str:
    above = ", ".join(f"h{n}.seq" for n in range(1, level)) or "NULL"
    return f"CASE WHEN h{level}.seq > coalesce(greatest({above}, -1), -1) THEN h{level} END"


# A heading is in force until one of its level or a smaller one comes: of each level the newest counts.
_STRUCTURED_SQL = f"""
cutblocks AS (
  SELECT doc_id, list_filter(regexp_extract_all(text, {_sql_re(_BLOCK_RE)}), lambda b: regexp_matches(b, '[^{W}]')) AS bl FROM documents
), lined AS (
  SELECT doc_id, unnest(bl) AS b, generate_subscripts(bl, 1) - 1 AS seq FROM cutblocks
), matched AS (
  SELECT *, contains(b, '|') AND NOT regexp_matches(b, {_sql_re('^' + structure.MARKED)}) AS is_table, length(b) <= {structure.HEADING_CHARS} AS short,
         regexp_replace(b, {_sql_re(structure.ENDS)}, '', 'g') AS trimmed, regexp_replace(b, '\\n\\z', '') AS whole,
         regexp_matches(b, {_sql_re(structure.UNDERLINED)}) AS underlined,
         regexp_extract(b, {_sql_re(structure.HASHED)}, 2) <> '' AS hashed,
         regexp_matches(b, {_sql_re(structure.NUMBERED)}) AS numbered,
         regexp_matches(b, {_sql_re(structure.NAMED)}) OR (regexp_matches(b, {_sql_re(structure.FOUR_CAPITALS)})
             AND regexp_matches(b, {_sql_re(structure.NO_SMALL)})) AS named,
         regexp_matches(b, {_sql_re(structure.LISTED)}) AS listed
  FROM lined
), shaped AS (
  SELECT doc_id, seq, CASE WHEN is_table THEN 'table' WHEN short AND (underlined OR hashed OR numbered OR named) THEN 'head'
              WHEN listed THEN 'list_item' ELSE 'text' END AS kind,
         CASE WHEN is_table THEN 1
              WHEN short AND underlined THEN CASE WHEN regexp_extract(b, {_sql_re(structure.UNDERLINED)}, 2) = '=' THEN 1 ELSE 2 END
              WHEN short AND hashed THEN length(regexp_extract(b, {_sql_re(structure.HASHED)}, 1))
              WHEN short AND numbered THEN least(6, len(string_split(regexp_extract(b, {_sql_re(structure.NUMBERED)}, 1), '.')))
              WHEN short AND named THEN 1
              WHEN listed THEN length(replace(regexp_extract(b, {_sql_re(structure.LISTED)}, 1), chr(9), '    ')) // {structure.INDENT} + 1
              ELSE 1 END AS level,
         CASE WHEN is_table THEN whole
              WHEN short AND underlined THEN regexp_extract(b, {_sql_re(structure.UNDERLINED)}, 1)
              WHEN short AND hashed THEN regexp_extract(b, {_sql_re(structure.HASHED)}, 2)
              WHEN short AND (numbered OR named) THEN trimmed
              WHEN listed THEN regexp_extract(b, {_sql_re(structure.LISTED)}, 2)
              ELSE whole END AS text
  FROM matched
), newest AS (
  SELECT *, {", ".join(_newest(n) for n in _LEVELS)} FROM shaped
  WINDOW before AS (PARTITION BY doc_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), paths AS (
  SELECT *, list_filter([{", ".join(_still_open(n) for n in _LEVELS)}], lambda h: h IS NOT NULL) AS path FROM newest
), structured AS (
  SELECT doc_id, md5('/documents/' || doc_id || '.txt') AS input_hash, doc_id || '.txt' AS filename, seq,
         CASE WHEN kind = 'table' THEN '#/tables/' ELSE '#/texts/' END || seq AS ref,
         CASE WHEN kind <> 'head' THEN kind WHEN level = 1 THEN 'title' ELSE 'section_header' END AS label, level,
         CASE WHEN len(path) > 0 THEN array_to_string(list_transform(path, lambda h: h.text), '|') END AS headings,
         coalesce(path[-1].seq, -1) AS run, seq // 40 + 1 AS page, text
  FROM paths
)"""
# The packing rule where headings part the chunks.
_HEADED_CHUNKS_SQL = (
    TEXT_CHUNKS_SQL.replace("FROM items WHERE label = 'text'", "FROM structured WHERE label IN ('text', 'list_item')")
    .replace("SELECT doc_id, input_hash, filename, seq, page, ref, j,", "SELECT doc_id, input_hash, filename, headings, run, seq, page, ref, j,")
    .replace("SELECT doc_id, i, n AS open, i AS start FROM", "SELECT doc_id, i, n AS open, i AS start, run FROM")
    .replace("CASE WHEN k.open + p.n > 200", "CASE WHEN k.run <> p.run OR k.open + p.n > 200")
    .replace("ELSE k.start END\n", "ELSE k.start END, p.run\n")
    .replace("any_value(filename) AS filename,", "any_value(filename) AS filename, any_value(headings) AS headings,")
)

_DESCRIBED_SQL = f"""
described AS (
  SELECT input_hash, any_value(filename) AS filename, page, string_agg(text, {_NL} ORDER BY seq) AS payload,
         array_to_string(list(ref ORDER BY seq), '|') AS doc_refs,
         array_to_string(list(CAST(seq AS VARCHAR) ORDER BY seq) FILTER (label = 'table'), '|') AS tables
  FROM items GROUP BY input_hash, page
  UNION ALL
  SELECT md5('/documents/' || doc_id || '.txt'), doc_id || '.txt', 0, NULL, '', NULL
  FROM blocks WHERE len(bl) = 0
), described2 AS (
  SELECT *, CASE WHEN page = 0 THEN 'No pages in document'
            ELSE length(payload) || ' characters in ' ||
                 (length(payload) - length(replace(payload, {_NL}, '')) + 1) || ' lines' END AS description
  FROM described
)"""


def _sql(text: str) -> str:
    """Line breaks in a template, as SQL."""
    return "'" + text.replace("'", "''") + "'"


def _filled(template: str, **values: str) -> str:
    out = _sql(template)
    for name, value in values.items():
        out = out.replace("{" + name + "}", f"' || {value} || '")
    return out


_TABLE_TEXT = _filled(templates.TABLE_TEXT, captions="caption", text="text")
_PICTURE_TEXT = _filled(templates.PICTURE_TEXT, captions="''", text="text")
_PAGE_TEXT = _filled(templates.PAGE_TEXT, headings="''", text="description")
_BODY_TEXT = _filled(templates.BODY_TEXT, headings="''", captions="''", text="text")
_HTML_BODY_TEXT = _filled(templates.BODY_TEXT, headings="heading", captions="''", text="text")
_CAPTION = f"length(text) || ' characters in ' || (length(text) - length(replace(text, {_NL}, '')) + 1) || ' lines'"

ORACLE = {
    "driver_list": "SELECT 'page-' || page_id AS document_name, url AS document_url FROM pages",
    "fetched": """SELECT 'page-' || page_id AS document_name, CASE WHEN contains(url, '#') THEN 404 ELSE 200 END AS status,
        CASE WHEN contains(url, '#') THEN NULL ELSE md5('body of ' || url) END AS body_md5 FROM pages""",
    "landed": "SELECT 'page-' || page_id AS document_name, NOT contains(url, '#') AS downloaded FROM pages",
    "landed_files": "SELECT 'pages/' || page_id || '.html' AS name, md5(html) AS body_md5 FROM pages WHERE html IS NOT NULL",
    "folder_scan": """SELECT page_id || '.pdf' AS filename, octet_length(encode(html)) AS size, md5(html) AS content_md5
        FROM pages WHERE url LIKE 'https%'""",
    "paths": """SELECT h AS input_hash, '/volumes/silver/' || h AS output_path,
        '/volumes/silver/' || h || '/tables/' || page_id || '.webp' AS image_path
        FROM (SELECT page_id, md5('/volumes/bronze/' || page_id || '.pdf') AS h FROM pages)""",
    "pending_documents": """SELECT doc_id, md5(CAST(doc_id AS VARCHAR)) AS input_hash FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "reused_documents": """SELECT doc_id, md5(CAST(doc_id AS VARCHAR)) AS input_hash FROM documents
        WHERE doc_id IN (SELECT doc_id FROM labels)""",
    "converted_or_loaded": f"""WITH {ITEMS_SQL} SELECT input_hash,
        CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN '' ELSE 'late ' END || filename AS filename, seq, ref, label, text FROM items""",
    "text_items": f"WITH {ITEMS_SQL} SELECT input_hash, filename, seq, ref, label, page, text FROM items",
    "structured_items": f"WITH {_STRUCTURED_SQL} SELECT filename, seq, ref, label, level, headings, run, text FROM structured",
    "structured_chunks": f"""WITH RECURSIVE {_STRUCTURED_SQL}, {_HEADED_CHUNKS_SQL}
        SELECT filename, pages, doc_refs, headings, text, id FROM textchunks""",
    "markdown_structure": f"""WITH {_HTML_SQL} SELECT filename, seq,
        first_value(text) OVER (PARTITION BY page_id ORDER BY seq) AS headings, text FROM htmlitems""",
    "html_items": f"""WITH {_HTML_SQL} SELECT input_hash, filename, seq, '#/texts/' || seq AS ref, label,
        first_value(text) OVER (PARTITION BY page_id ORDER BY seq) AS headings, text FROM htmlitems""",
    "html_text_chunks": f"""WITH RECURSIVE {_HTML_SQL}, items AS (
        SELECT page_id AS doc_id, input_hash, filename, seq, label, '#/texts/' || seq AS ref, 1 AS page, text FROM htmlitems
        ), heads AS (SELECT filename, text AS heading FROM htmlitems WHERE seq = 0), {TEXT_CHUNKS_SQL}
        SELECT filename, pages, doc_refs, heading AS headings, text, {_HTML_BODY_TEXT} AS enriched_text, id
        FROM textchunks JOIN heads USING (filename)""",
    "heading_in_force": f"""WITH {_HTML_SQL} SELECT input_hash, seq,
        first_value(text) OVER (PARTITION BY page_id ORDER BY seq) AS heading FROM htmlitems""",
    "markdown_documents": f"""WITH {ITEMS_SQL}, md AS (
        SELECT doc_id || '.txt' AS filename, coalesce(string_agg(items.text, {_NL} || {_NL} ORDER BY seq), '') AS markdown
        FROM documents LEFT JOIN items USING (doc_id) GROUP BY doc_id)
        SELECT filename, md5(markdown) AS markdown_md5, length(markdown) AS n_chars FROM md""",
    "text_chunks": f"""WITH RECURSIVE {ITEMS_SQL}, {TEXT_CHUNKS_SQL}
        SELECT filename, input_hash, pages, doc_refs, false AS has_table, false AS has_picture, '' AS tables, '' AS pictures,
        CAST(NULL AS VARCHAR) AS headings, CAST(NULL AS VARCHAR) AS captions, 'text' AS chunk_type, '' AS image_path, text,
        {_BODY_TEXT} AS enriched_text, id FROM textchunks""",
    "table_chunks": f"""WITH {ITEMS_SQL}, tab AS (SELECT *, {_CAPTION} AS caption FROM items WHERE label = 'table')
        SELECT filename, input_hash, CAST(page AS VARCHAR) AS pages, ref AS doc_refs, true AS has_table, false AS has_picture,
        CAST(seq AS VARCHAR) AS tables, '' AS pictures, '' AS headings, caption AS captions, 'table' AS chunk_type,
        '' AS image_path, text, {_TABLE_TEXT} AS enriched_text, md5(input_hash || '/table/' || ref) AS id FROM tab""",
    "table_captions": f"""WITH {ITEMS_SQL} SELECT input_hash, '#/texts/caption-' || seq AS ref, page, {_CAPTION} AS text
        FROM items WHERE label = 'table'""",
    "page_descriptions": f"""WITH {ITEMS_SQL}, {_DESCRIBED_SQL} SELECT input_hash, page, description,
        CASE WHEN page = 0 THEN '' ELSE '{MODEL}' END AS provenance, CAST(NULL AS VARCHAR) AS error FROM described2""",
    "page_chunks": f"""WITH {ITEMS_SQL}, {_DESCRIBED_SQL}
        SELECT filename, input_hash, CAST(page AS VARCHAR) AS pages, doc_refs, tables IS NOT NULL AS has_table,
        false AS has_picture, coalesce(tables, '') AS tables, '' AS pictures, '' AS headings, '' AS captions,
        'page' AS chunk_type, '' AS image_path, description AS text, {_PAGE_TEXT} AS enriched_text,
        md5(input_hash || '/page/' || page) AS id FROM described2""",
    "all_chunks": f"""WITH RECURSIVE {ITEMS_SQL}, {TEXT_CHUNKS_SQL}, {_DESCRIBED_SQL}, tab AS (
        SELECT *, '' AS caption FROM items WHERE label = 'table')
        SELECT text, filename, id, 'text' AS chunk_type, input_hash, pages, {_BODY_TEXT} AS enriched_text FROM textchunks
        UNION ALL SELECT text, filename, md5(input_hash || '/table/' || ref), 'table', input_hash, CAST(page AS VARCHAR),
        {_TABLE_TEXT} FROM tab
        UNION ALL SELECT description, filename, md5(input_hash || '/page/' || page), 'page', input_hash,
        CAST(page AS VARCHAR), {_PAGE_TEXT} FROM described2""",
    "picture_chunks": f"""WITH pics AS (SELECT *, md5('label/' || label) AS h, 'picture ' || vec_id || ' of ' || label AS t,
        vec_id // 100 + 1 AS page FROM embeddings), texts AS (SELECT *, length(t) || ' characters in 1 lines' AS text FROM pics)
        SELECT 'label-' || label AS filename, h AS input_hash,
        CASE WHEN page = 2 THEN '2' WHEN page < 2 THEN page || '|2' ELSE '2|' || page END AS pages,
        '#/pictures/' || vec_id || '|#/texts/' || vec_id AS doc_refs, false AS has_table, true AS has_picture, '' AS tables,
        CAST(vec_id AS VARCHAR) AS pictures, '' AS headings, '' AS captions, 'picture' AS chunk_type,
        CASE WHEN embedding[1] > 0 THEN '/volumes/silver/' || h || '/pictures/' || vec_id || '.webp' ELSE '' END AS image_path,
        text, {_PICTURE_TEXT} AS enriched_text, md5(h || '/picture/#/pictures/' || vec_id) AS id FROM texts""",
    "picture_annotations": f"""WITH pics AS (SELECT *, md5('label/' || label) AS h,
        'picture ' || vec_id || ' of ' || label AS t FROM embeddings)
        SELECT h AS input_hash, '#/pictures/' || vec_id AS ref, 0 AS no, 'description' AS kind,
        length(t) || ' characters in 1 lines' AS text, '{MODEL}' AS provenance, CAST(NULL AS VARCHAR) AS class_name,
        CAST(NULL AS DOUBLE) AS confidence FROM pics
        UNION ALL SELECT h, '#/pictures/' || vec_id, 1, 'classification', NULL, 'example_classifier-0.0.1', 'dummy', 0.42 FROM pics""",
    "chunk_images": """WITH pics AS (SELECT *, md5('label/' || label) AS h FROM embeddings)
        SELECT md5(h || '/picture/#/pictures/' || vec_id) AS id,
        CASE WHEN embedding[1] > 0 THEN '/volumes/silver/' || h || '/pictures/' || vec_id || '.webp' ELSE '' END AS image_path,
        CASE WHEN embedding[1] > 0 THEN md5('image ' || vec_id) END AS image_md5 FROM pics""",
    "image_requests": """SELECT CAST(vec_id AS VARCHAR) AS ref, image_type,
        'Describe the contents of this ' || image_type || '. Keep the response within 200 words' AS request,
        'data:image/png;base64,' || base64(encode('image ' || vec_id)) AS url
        FROM (SELECT vec_id, unnest(['page', 'table', 'picture']) AS image_type FROM embeddings WHERE embedding[1] > 0)""",
    "single_values": "SELECT doc_id, n_chars FROM documents",
    "longest_document": "SELECT max(n_chars) AS n_chars FROM documents",
    "page_metadata": """SELECT page_id, CAST(length(url) + 1 AS VARCHAR) AS size, CAST(NULL AS VARCHAR) AS absent, url FROM pages""",
    "metadata_union": """SELECT doc_id, CASE WHEN toxic = 1 THEN 'description' ELSE 'entity' END AS kind,
        CASE WHEN toxic = 1 THEN 'quality ' || quality END AS text,
        CASE WHEN toxic = 0 THEN CAST(doc_id AS VARCHAR) END AS id FROM labels""",
    "graph_nodes": """SELECT DISTINCT id, upper(id) AS label, type, type AS kind FROM (
        SELECT 'doc-' || doc_id AS id, 'document' AS type FROM documents
        UNION ALL SELECT source, 'source' FROM documents UNION ALL SELECT lang, 'language' FROM documents)""",
    "graph_edges": """SELECT DISTINCT 'doc-' || doc_id AS src, 'part_of' AS predicate, source AS dst, true AS known_predicate
        FROM documents UNION ALL SELECT DISTINCT 'doc-' || doc_id, 'has_property', lang, true FROM documents""",
    "conversion_summary": "SELECT count(*) AS documents, true AS timed, true AS measured FROM pages",
    "html_page_chunks": f"""WITH {_HTML_SQL}, paged AS (SELECT input_hash, any_value(filename) AS filename,
        string_agg(text, {_NL} ORDER BY seq) AS payload, array_to_string(list('#/texts/' || seq ORDER BY seq), '|') AS doc_refs,
        any_value(text) FILTER (label = 'title') AS headings FROM htmlitems GROUP BY input_hash
        ), told AS (SELECT *, length(payload) || ' characters in ' ||
        (length(payload) - length(replace(payload, {_NL}, '')) + 1) || ' lines' AS description FROM paged)
        SELECT filename, input_hash, '1' AS pages, doc_refs, headings, description AS text,
        {_filled(templates.PAGE_TEXT, headings="headings", text="description")} AS enriched_text,
        md5(input_hash || '/page/1') AS id FROM told""",
    "captioned_chunks": f"""WITH p AS (SELECT CAST(page_id AS VARCHAR) AS n, md5('/pages/' || page_id) AS h FROM pages
        ), made AS (
        SELECT n, h, 'picture' AS chunk_type, '#/pictures/0' AS ref, 'Figure ' || n AS captions, '5 characters in 1 lines' AS text FROM p
        UNION ALL SELECT n, h, 'picture', '#/pictures/1', '', '5 characters in 1 lines' FROM p
        UNION ALL SELECT n, h, 'table', '#/tables/0', 'Table ' || n || 'continued',
        '| a | b |' || {_NL} || '| --- | --- |' || {_NL} || '| ' || n || ' x |  |' FROM p)
        SELECT n AS filename, chunk_type, ref AS doc_refs, captions, text, CASE WHEN chunk_type = 'table'
        THEN {_filled(templates.TABLE_TEXT, captions="captions", text="text")}
        ELSE {_filled(templates.PICTURE_TEXT, captions="captions", text="text")} END AS enriched_text,
        md5(h || '/' || chunk_type || '/' || ref) AS id FROM made""",
    "chunk_table": f"WITH RECURSIVE {ITEMS_SQL}, {TEXT_CHUNKS_SQL} SELECT input_hash, pages, text, id FROM textchunks",
    "saved_images": """SELECT md5('label/' || label) AS input_hash, 'pictures' AS kind, CAST(vec_id AS VARCHAR) AS ref,
        '/' || md5('label/' || label) || '/pictures/' || vec_id || '.webp' AS path FROM embeddings WHERE embedding[1] > 0""",
    "html_items_in_sql": f"WITH {_HTML_SQL} SELECT page_id, seq, '#/texts/' || seq AS ref, label, text FROM htmlitems",
    "stored_descriptions": f"""WITH {ITEMS_SQL}, {_DESCRIBED_SQL}, kept AS (SELECT * REPLACE (
        CASE WHEN page % 2 = 1 THEN description ELSE '' END AS description) FROM described2)
        SELECT md5(input_hash || '/page/' || page) AS id, description AS text, {_PAGE_TEXT} AS enriched_text FROM kept""",
    "metadata_kinds": """SELECT doc_id, ['classification', 'relationship', 'connection'][doc_id % 3 + 1] AS kind,
        CASE WHEN doc_id % 3 = 0 THEN lang END AS class_name, CASE WHEN doc_id % 3 = 0 THEN CAST(0.5 AS DOUBLE) END AS confidence,
        CASE WHEN doc_id % 3 > 0 THEN 'PART_OF' END AS predicate, CASE WHEN doc_id % 3 = 2 THEN lang END AS subject,
        CASE WHEN doc_id % 3 = 2 THEN source END AS object FROM documents""",
}
