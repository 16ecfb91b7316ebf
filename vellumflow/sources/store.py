"""Stored conversions and chunk tables: what is written is read back instead of made again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumflow import schemas
from vellumflow.functions import refs
from vellumflow.sources.drivers import write_files
from vellumflow.sources.text_layout import flat_items


# --- what is still to convert ------------------------------------------------------------


def pending(docs: DataFrame, stored: DataFrame, overwrite: bool = False) -> DataFrame:
    """Documents without a stored conversion, or all of them when overwriting."""
    return docs if overwrite else docs.join(stored.select("input_hash").distinct(), "input_hash", "left_anti")


def reused(docs: DataFrame, stored: DataFrame, overwrite: bool = False) -> DataFrame:
    """Documents whose stored conversion is used again."""
    kept = docs.join(stored.select("input_hash"), "input_hash", "left_semi")
    return kept.limit(0) if overwrite else kept


# --- layout ---------------------------------------------------------------------------------


def save_layout(layout: DataFrame, path: str, mode: str = "append", form: str = "parquet") -> None:
    """Keep the layout as Parquet, or as JSON lines for readers outside Spark."""
    layout.write.mode(mode).format(form).save(path)


def load_layout(
    spark: SparkSession, path: str, docs: DataFrame | None = None, form: str = "parquet"
) -> DataFrame:
    """Stored layout, of all documents or only of those in ``docs``."""
    stored = spark.read.schema(schemas.layout).format(form).load(path)
    return stored if docs is None else stored.join(docs.select("input_hash"), "input_hash", "left_semi")


def segment_markdown(layout: DataFrame) -> DataFrame:
    """Markdown of each segment; a long document is several parts, in order of ``seg``."""

    def line(it):
        head = F.concat(F.repeat(F.lit("#"), F.greatest(it.level, F.lit(1))), F.lit(" "), it.text)
        return (
            F.when(it.label.isin("title", "section_header"), head)
            .when(it.label == "list_item", F.concat(F.lit("- "), it.text))
            .when(it.label == "picture", F.lit("<!-- image -->"))
            .otherwise(it.text)
        )

    body = F.array_join(F.transform("items", line), "\n\n")
    return layout.select("input_hash", "filename", "seg", "n_segs", body.alias("markdown"))


def markdown(layout: DataFrame) -> DataFrame:
    """One Markdown text per document, its segments joined in order."""
    parts = segment_markdown(layout)
    whole = parts.where(F.col("n_segs") == 1).select("input_hash", "filename", "markdown")
    ordered = F.array_sort(F.collect_list(F.struct("seg", "markdown")))
    joined = (
        parts.where(F.col("n_segs") > 1)
        .groupBy("input_hash", "filename")
        .agg(F.array_join(F.transform(ordered, lambda p: p.markdown), "\n\n").alias("markdown"))
    )
    return whole.unionByName(joined)


# --- images -----------------------------------------------------------------------------------


def image_paths(images: DataFrame, out_dir: str) -> DataFrame:
    """Set the path of each image that exists; the others have none."""
    path = refs.image_path(out_dir, F.col("input_hash"), F.col("kind"), F.col("ref"))
    return images.withColumn("path", F.when(F.col("bytes").isNotNull(), path))


def save_images(images: DataFrame, out_dir: str) -> DataFrame:
    """Write the image bytes and return the location table ``(input_hash, kind, ref, path)``."""
    placed = image_paths(images, out_dir).where(F.col("bytes").isNotNull())
    written = write_files(placed, F.col("path"), F.col("bytes"), "written")
    return written.where("written").select("input_hash", "kind", "ref", "path")


# --- tables ---------------------------------------------------------------------------------------


def write_bronze(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").parquet(path)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Files of different age may have different columns."""
    return spark.read.option("mergeSchema", True).parquet(path)


def write_chunks(chunks: DataFrame, name: str) -> None:
    chunks.withColumn("input_hash", F.col("input_hash").cast("string")).write.mode("overwrite").saveAsTable(name)


def scan_chunks(chunks: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Only the columns the embedded table keeps; the scan reads no others."""
    return chunks.select(*(columns or schemas.synced_columns))


def retrieval_columns(text: str, uri: str, key: str, others: list[str]) -> list[str]:
    """Columns a search returns: text, uri, key, then the others."""
    return [text, uri, key, *others]


# --- page metadata ------------------------------------------------------------------------------------


def add_metadata(pages: DataFrame, key: str, value, column: str = "metadata") -> DataFrame:
    """Set ``key`` in the free metadata of each page; a later value replaces an earlier one."""
    extra = F.create_map(F.lit(key), value.cast("string"))
    rest = F.map_filter(F.coalesce(column, F.create_map().cast("map<string,string>")), lambda k, _: k != key)
    return pages.withColumn(column, F.map_concat(rest, extra))


def get_metadata(pages: DataFrame, key: str, into: str, column: str = "metadata") -> DataFrame:
    return pages.withColumn(into, F.try_element_at(column, F.lit(key)))


def metadata_of_kind(rows: DataFrame, column: str, kind: str) -> DataFrame:
    """Metadata given as JSON, read by the shared schema and told apart by ``kind``."""
    return rows.withColumn("metadata", F.from_json(column, schemas.metadata_union)).where(F.col("metadata.kind") == kind)


def seconds_per_document(timed: DataFrame) -> DataFrame:
    """Summary of conversion times ``(input_hash, seconds)``."""
    return timed.agg(
        F.count(F.lit(1)).alias("documents"),
        F.round(F.avg("seconds"), 1).alias("avg_seconds"),
        F.percentile_approx("seconds", 0.5).alias("median_seconds"),
    )
