"""A table of conversions that is filled as documents come: what it holds is read again, only the rest is converted."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellumflow import schemas
from vellumflow.session import few, settled

# Stored layout lies in so many folders by hash of the document, so that replacing some documents writes only theirs.
BUCKETS = 64
BUCKET = "bucket"
STORED = T.StructType([*schemas.layout.fields, T.StructField(BUCKET, T.IntegerType())])

# Makes the layout of documents ``(input_hash, filename, ...)``.
Converter = Callable[[DataFrame], DataFrame]


def _bucketed(layout: DataFrame) -> DataFrame:
    return layout.withColumn(BUCKET, F.pmod(F.xxhash64("input_hash"), F.lit(BUCKETS)).cast("int"))


def stored_layout(spark: SparkSession, path: str) -> DataFrame:
    """All stored layout, with its bucket; no rows where nothing was stored yet."""
    try:
        spark.read.schema(STORED).parquet(path)
    except AnalysisException as failed:
        if failed.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STORED)
    return spark.read.schema(STORED).option("basePath", path).parquet(path)


def convert_or_load(docs: DataFrame, path: str, convert: Converter, overwrite: bool = False) -> DataFrame:
    """Layout of all ``docs``: stored conversions are read again, only the others are converted, and kept.

    With ``overwrite`` all are converted, and replace what is stored of them;
    documents of other batches stay. Documents of equal ``input_hash`` are
    converted once, under the smallest file name; a document stored before keeps
    the name it had. New layout is appended by bucket; only replacing reads and
    writes stored rows, those of the buckets it touches.

    Documents of a null hash cannot be found again: they are left out. Documents
    that a converter gives no rows for are converted again each time. No
    documents: no rows, and nothing is written.
    """
    spark = docs.sparkSession
    known = docs.where(F.col("input_hash").isNotNull())
    if not overwrite:
        ids = stored_layout(spark, path).select("input_hash").distinct()
        known = known.join(ids, "input_hash", "left_anti")
    first = known.groupBy("input_hash").agg(F.min("filename").alias("_first"))
    one = known.join(first, "input_hash").where(F.col("filename").eqNullSafe(F.col("_first"))).drop("_first").dropDuplicates(["input_hash"])
    made = _bucketed(convert(one).select(*schemas.layout.names))
    if overwrite:
        _replace(spark, settled(made), path)
    elif not first.isEmpty():
        _write(made, path, "append")
    wanted = few(settled(docs.select("input_hash").where("input_hash IS NOT NULL").distinct()))
    return stored_layout(spark, path).join(wanted, "input_hash", "left_semi").select(*schemas.layout.names)


def _replace(spark: SparkSession, made: DataFrame, path: str) -> None:
    touched = [r[0] for r in made.select(BUCKET).distinct().collect()]
    if touched:
        old = stored_layout(spark, path).where(F.col(BUCKET).isin(sorted(touched)))
        others = settled(old.join(made.select("input_hash").distinct(), "input_hash", "left_anti"))
        _write(made.unionByName(others), path, "overwrite")


def _write(rows: DataFrame, path: str, mode: str) -> None:
    # Rebalanced: a bucket of any size is cut into as many files as it needs, and a task writes few buckets. Rows are made and moved once.
    dealt = rows.hint("rebalance", BUCKET)
    dealt.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
