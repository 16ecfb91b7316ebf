"""Contiguous shards of near equal size, by global prefix sums of bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellumflow.llm.common import fan_out, whole, written

ROW_BYTES = 16


def sized(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32) of each row: UTF-8 bytes of its text (null: none) plus 16."""
    return docs.select(
        F.col(id).alias("doc_id"),
        (F.octet_length(whole(text)) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(whole(text).cast("binary")).alias("text_crc32"),
    )


def shards(docs: DataFrame, n: int = 40, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Law ``bytes``: rows in the order of doc_id (then digest, then size), cut at equal targets of bytes.

    A row belongs to the shard in which its middle byte lies, so a shard is off
    its target by at most half a row at either end. The rows are range
    partitioned once, without their texts; only totals of partitions and first
    rows of shards, both bounded by settings, go to every task.

    Nulls: a null text has no bytes; null ids come first. Equal rows are
    interchangeable, and rows of one id are spread over partitions by digest and
    a number of their own, so no id is too frequent. No rows: no rows.
    Other columns are not looked at.
    """
    few = fan_out(docs.sparkSession)
    order = ["doc_id", "text_crc32", "size"]
    dealt = sized(docs, id, text).withColumn("tie", F.monotonically_increasing_id())
    rows = written(dealt.repartitionByRange(few, *order, "tie").drop("tie").withColumn("part", F.spark_partition_id()), "shards")

    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(everything).alias("all_bytes"),
    )
    running = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        rows.withColumn("bytes_to", F.sum("size").over(running))
        .withColumn("rows_to", F.row_number().over(Window.partitionBy("part").orderBy(*order)))
        .join(F.broadcast(totals), "part")
        .withColumn("middle", 2 * (F.col("bytes_before") + F.col("bytes_to")) - F.col("size"))
        .withColumn("shard", F.least(F.lit(n - 1), F.expr(f"cast(middle * {n} div (2 * all_bytes) as int)")))
        .withColumn("row", F.col("rows_before") + F.col("rows_to") - 1)
    )
    first = placed.groupBy("shard").agg(F.min("row").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("row") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
