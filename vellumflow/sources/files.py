"""File scans: documents of a folder, and images by path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumflow.functions import refs

# The document types that are converted.
SUFFIXES = [".xlsx", ".docx", ".pptx", ".pdf"]


def local_path(path: Column) -> Column:
    """Path without the scheme that a file scan puts before it."""
    return F.regexp_replace(path, r"^file:(?://(?=/))?", "")


def scan_folder(spark: SparkSession, folder: str, with_bytes: bool = False) -> DataFrame:
    """Documents directly in ``folder``: ``(path, filename, input_hash, size)``, and bytes when asked for.

    Without bytes only the listing is read. The suffix is case-sensitive.
    """
    kinds = ",".join(s[1:] for s in SUFFIXES)
    found = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{{{kinds}}}").load(folder)
    columns = [
        local_path(F.col("path")).alias("path"),
        F.substring_index("path", "/", -1).alias("filename"),
        refs.path_key(F.col("path")).alias("input_hash"),
        F.col("length").alias("size"),
    ]
    return found.select(*columns, *([F.col("content").alias("bytes"), F.md5("content").alias("content_md5")] if with_bytes else []))


def scan_images(spark: SparkSession, folder: str, suffix: str = "webp") -> DataFrame:
    """``(path, bytes)`` of all images below ``folder``."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*.{suffix}")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select(local_path(F.col("path")).alias("path"), F.col("content").alias("bytes"))
    )


def with_images(rows: DataFrame, images: DataFrame, path: str = "image_path", strict: bool = False) -> DataFrame:
    """Join image bytes by path, last of all. An empty path has no image.

    ``strict`` fails on a path that is named but not found; otherwise the bytes are null.
    Paths are unique among ``images``; rows without a path are not shuffled to one task.
    """
    found = images.select(F.col("path").alias("_path"), F.col("bytes").alias("image"), F.lit(True).alias("_found"))
    named = rows.where(F.coalesce(F.col(path), F.lit("")) != "")
    bare = rows.where(F.coalesce(F.col(path), F.lit("")) == "").withColumn("image", F.lit(None).cast("binary"))
    joined = named.join(found, F.col(path) == F.col("_path"), "left")
    if strict:
        missing = F.raise_error(F.concat(F.lit("image not found: "), F.col(path)))
        joined = joined.withColumn("image", F.when(F.col("_found"), F.col("image")).otherwise(missing.cast("binary")))
    return joined.drop("_path", "_found").unionByName(bare)


def single_value(table: DataFrame, column: str, where: Column | str | None = None) -> DataFrame:
    """The one value of ``column`` that meets the condition; none or several is an error.

    Without a condition any one row is taken.
    """
    if where is None:
        rows = table.select(column).limit(1)
    else:
        rows = table.where(where).select(column).limit(2)
    counted = rows.agg(F.count(F.lit(1)).alias("_n"), F.first(column).alias(column))
    wrong = F.raise_error(F.format_string("expected one row, found %s", F.when(F.col("_n") > 1, F.lit("more")).otherwise(F.lit("none"))))
    kind = table.schema[column].dataType
    return counted.select(F.when(F.col("_n") == 1, F.col(column)).otherwise(wrong.cast(kind)).alias(column))


def single_values(table: DataFrame, key: str, column: str) -> DataFrame:
    """The same for every key at once; ``(key, column)``."""
    counted = table.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.min(column).alias(column))
    kind = table.schema[column].dataType
    wrong = F.raise_error(F.concat(F.lit("more than one row for "), F.col(key).cast("string"))).cast(kind)
    return counted.select(key, F.when(F.col("_n") == 1, F.col(column)).otherwise(wrong).alias(column))
