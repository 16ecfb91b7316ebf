"""Layout of plain text documents, built inside each row: no shuffle, no Python."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumflow import schemas
from vellumflow.functions.text import SPACE

ITEMS_PER_PAGE = 40
SEGMENT_ITEMS = 4096
# Items added to the end of a body after extraction are numbered from here.
ADDED_SEQ = 1 << 30

# An item is a run of lines with a pipe sign (a table) or any other single line.
ITEM = r"(?:[^\n|]*\|[^\n]*(?:\n|\z))++|[^\n]+"


def _empty(kind) -> Column:
    return F.array().cast(kind)


def _item(block: Column, seq: Column, per_page: int) -> Column:
    is_table = F.contains(block, F.lit("|"))
    kind = F.when(is_table, F.lit("#/tables/")).otherwise(F.lit("#/texts/"))
    return F.struct(
        seq.cast("int").alias("seq"),
        F.concat(kind, seq.cast("string")).alias("ref"),
        F.when(is_table, F.lit("table")).otherwise(F.lit("text")).alias("label"),
        F.lit(1).alias("level"),
        F.array(F.floor(seq / per_page).cast("int") + 1).alias("page_nos"),
        _empty(schemas.STRINGS).alias("children"),
        _empty(schemas.STRINGS).alias("caption_refs"),
        _empty("array<" + schemas.annotation.simpleString() + ">").alias("annotations"),
        F.lit(None).cast(schemas.STRINGS).alias("headings"),
        F.lit(-1).alias("run"),
        F.regexp_replace(block, r"\n\z", "").alias("text"),
    )


def text_layout(
    docs: DataFrame,
    key: Column,
    filename: Column,
    text: str = "text",
    size: str | None = None,
    items_per_page: int = ITEMS_PER_PAGE,
    segment_items: int = SEGMENT_ITEMS,
    pattern: str = ITEM,
    shape: Callable[[Column, Column, int], Column] = _item,
) -> DataFrame:
    """One layout row per segment of at most ``segment_items`` items of each document in ``docs``.

    ``pattern`` cuts a text into blocks, ``shape`` makes an item of a block, its number and the items of a page.

    A text too short for more items than one segment holds needs no look at its
    items to tell. ``size`` may name a stored length column: that split is then
    pushed down to the file scan.
    """
    length = F.col(size) if size else F.length(text)
    blocks = F.filter(
        F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)),
        lambda b: F.regexp_like(b, F.lit(rf"[^{SPACE}]")),
    )

    def laid(part: DataFrame) -> DataFrame:
        return part.select(
            key.alias("input_hash"),
            filename.alias("filename"),
            F.transform(blocks, lambda b, i: shape(b, i, items_per_page)).alias("items"),
        )

    # Every item has a character and, but for the last, a line break.
    few = 2 * segment_items
    short = laid(docs.where((length <= few) | length.isNull())).select(
        "input_hash", "filename", F.lit(0).alias("seg"), F.lit(1).alias("n_segs"), "items"
    )
    n_segs = F.greatest(F.ceil(F.size("items") / segment_items).cast("int"), F.lit(1))
    cut = F.transform(
        F.sequence(F.lit(0), F.col("n_segs") - 1),
        lambda s: F.slice("items", s * segment_items + 1, F.lit(segment_items)),
    )
    long = (
        laid(docs.where(length > few))
        .withColumn("n_segs", n_segs)
        .select("input_hash", "filename", "n_segs", F.posexplode(cut).alias("seg", "items"))
        .select("input_hash", "filename", "seg", "n_segs", "items")
    )
    return short.unionByName(long)


def flat_items(layout: DataFrame) -> DataFrame:
    """One row per layout item."""
    return layout.select("input_hash", "filename", F.inline("items"))


def nested_items(items: DataFrame, segment_items: int = SEGMENT_ITEMS) -> DataFrame:
    """Layout rows from flat items; groups are bounded by the segment length."""
    names = schemas.item.fieldNames()
    place = F.floor(F.pmod("seq", F.lit(ADDED_SEQ)) / segment_items).cast("int")
    keyed = items.select(
        "input_hash",
        "filename",
        place.alias("seg"),
        F.struct(*names).alias("_item"),
    )
    segs = keyed.groupBy("input_hash", "seg").agg(
        F.first("filename").alias("filename"),
        F.array_sort(
            F.collect_list("_item"), lambda a, b: F.when(a.seq < b.seq, -1).when(a.seq > b.seq, 1).otherwise(0)
        ).alias("items"),
    )
    sizes = items.groupBy("input_hash").agg((F.max(place) + 1).alias("n_segs"))
    return segs.join(sizes, "input_hash").select("input_hash", "filename", "seg", "n_segs", "items")
