"""Chunks of two versions of a document brought in line, so that an insertion renames and embeds nothing but itself."""

from __future__ import annotations

from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHANGES = ("keep", "move", "insert", "delete")


def _numbered(rows: DataFrame, document: str, position: str, columns: list[str], *others: str) -> DataFrame:
    """(document, position, digest, nth, ...): equal chunks of a document are counted in their order."""
    made = rows.select(
        F.col(document).alias("document"), F.col(position).alias("position"), F.md5(F.to_json(F.struct(*columns)).cast("binary")).alias("digest"), *others
    )
    nth = F.row_number().over(Window.partitionBy("document", "digest").orderBy("position", *others))
    return made.withColumn("nth", nth)


def longest_rising(places: list[int], weights: list[int]) -> list[int]:
    """Indexes of a rising sequence of the greatest weight; the places differ from each other."""
    # Least places by the weight of the best sequence that ends there: both rise along the list.
    ends: list[int] = []
    best: list[tuple[int, int]] = []
    before = [-1] * len(places)
    for i, (place, weight) in enumerate(zip(places, weights)):
        at = bisect_left(ends, place)
        total, before[i] = (best[at - 1][0], best[at - 1][1]) if at else (0, -1)
        total += weight
        while at < len(ends) and best[at][0] <= total:
            del ends[at], best[at]
        ends.insert(at, place)
        best.insert(at, (total, i))
    out, i = [], best[-1][1] if best else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def _kept_blocks(blocks: DataFrame) -> DataFrame:
    """(document, block): of each document's blocks those that keep their order and hold the most chunks."""

    def choose(part: pa.Table) -> pa.Table:
        order = part.sort_by("block")
        kept = longest_rising(order.column("first").to_pylist(), order.column("n").to_pylist())
        return pa.table({"document": order.column("document").take(kept), "kept": order.column("block").take(kept)})

    kind = blocks.schema["document"].dataType.simpleString()
    return blocks.groupBy("document").applyInArrow(choose, f"document {kind}, kept long")


def align(old: DataFrame, new: DataFrame, document: str = "input_hash", position: str = "position", id: str = "id", columns: list[str] | None = None) -> DataFrame:
    """(document, position, old_position, id, change) of every chunk of either version.

    A chunk that has the same ``columns`` as one of the old version keeps that one's id, the n-th of several equal
    ones that of the n-th. Of these ``keep`` are the longest common subsequence of the matched chunks, and ``move`` the others.
    What has no partner is ``insert``, with an id made of its document, contents and number, or
    ``delete``, with its old id.

    Chunks that follow each other in both versions are one block, which either keeps its place whole or
    moves whole, so the subsequence is found on blocks: an untouched document is one block, whatever its length.
    Matching is a join on digests. Nulls in the columns are a value like any other, and so is a null document. An empty version gives only inserts or deletes.
    """
    compared = columns or ["text"]
    before = _numbered(old, document, position, compared, id).select(
        F.col("document").alias("_d"), F.col("digest").alias("_g"), F.col("nth").alias("_n"), F.col("position").alias("old_position"), F.col(id).alias("_id")
    )
    after = _numbered(new, document, position, compared)
    same = after["document"].eqNullSafe(before["_d"]) & (after["digest"] == before["_g"]) & (after["nth"] == before["_n"])
    met = after.join(before, same, "full_outer")
    document_ = F.when(F.col("digest").isNotNull(), F.col("document")).otherwise(F.col("_d"))
    made = F.md5(F.concat_ws("/", F.coalesce(F.col("document").cast("string"), F.lit("")), "digest", F.col("nth").cast("string")).cast("binary"))
    rows = met.select(
        document_.alias("document"), "position", "old_position",
        F.when(F.col("_g").isNotNull(), F.col("_id").cast("string")).otherwise(made).alias("id"),
        F.when(F.col("digest").isNull(), F.lit("delete")).when(F.col("_g").isNull(), F.lit("insert")).alias("change"),
    )
    paired = rows.where(F.col("change").isNull())
    by_old, by_new = Window.partitionBy("document").orderBy("old_position", "id"), Window.partitionBy("document").orderBy("position", "id")
    ranked = paired.withColumn("old_at", F.row_number().over(by_old).cast("long"))
    begins = (F.col("old_at") != F.coalesce(F.lag("old_at").over(by_new) + 1, F.lit(0))).cast("long")
    blocked = ranked.withColumn("begins", begins).withColumn("block", F.sum("begins").over(by_new.rowsBetween(Window.unboundedPreceding, 0)))
    blocks = blocked.groupBy("document", "block").agg(F.min("old_at").alias("first"), F.count("*").alias("n"))
    kept = _kept_blocks(blocks).select(F.col("document").alias("_d"), "kept")
    placed = blocked.join(kept, F.col("document").eqNullSafe(F.col("_d")) & (F.col("block") == F.col("kept")), "left")
    change = F.when(F.col("kept").isNotNull(), F.lit("keep")).otherwise(F.lit("move"))
    columns_out = ["document", "position", "old_position", "id", "change"]
    return placed.withColumn("change", change).select(*columns_out).union(rows.where(F.col("change").isNotNull()).select(*columns_out))


def with_ids(new: DataFrame, alignment: DataFrame, document: str = "input_hash", position: str = "position", id: str = "id") -> DataFrame:
    """``new`` with the ids of its alignment in place of its own: a change set of it names only what was inserted or deleted."""
    known = alignment.where("change <> 'delete'").select(F.col("document").alias("_d"), F.col("position").alias("_p"), F.col("id").alias("_id"))
    met = new.drop(id).join(known, F.col(document).eqNullSafe(F.col("_d")) & F.col(position).eqNullSafe(F.col("_p")))
    return met.drop("_d", "_p").withColumnRenamed("_id", id)
