"""Descriptions and classes for pages, pictures and tables, made by model calls."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumflow import schemas
from vellumflow.functions import templates
from vellumflow.operators.models import ModelFactory, Retry, model_replies, model_reply
from vellumflow.sources.text_layout import ADDED_SEQ

ANNOTATION = "struct<" + schemas.annotation.simpleString()[len("struct<") :]
# The placeholder class of the default picture classifier.
DEFAULT_CLASS = ("example_classifier-0.0.1", "dummy", 0.42)


def describe_pages(
    pages: DataFrame,
    factory: ModelFactory | None,
    model: str,
    enabled: bool = True,
    retry: Retry = Retry(),
) -> DataFrame:
    """Add ``description, provenance, error`` to a page table; a failed call gives an empty text.

    The model is given ``payload``: the texts of the page, or whatever the caller puts there. A document without pages has page 0 with a fixed text and is not sent to the
    model. Without a model every description is empty; when not enabled there are none.
    """
    if not enabled:
        pages = pages.where(F.lit(False))
    bare = F.col("page") == 0
    asked = F.when(~bare, F.coalesce("payload", F.lit("")))
    if factory is None:
        reply = F.struct(F.lit("").alias("text"), F.lit("no model").alias("error"))
    else:
        reply = model_reply(asked, factory, retry)
    return (
        pages.withColumn("_r", reply)
        .withColumn(
            "description", F.when(bare, F.lit(templates.NO_PAGES)).otherwise(F.coalesce("_r.text", F.lit("")))
        )
        .withColumn("provenance", F.when(bare, F.lit("")).otherwise(F.lit(model)))
        .withColumn("error", F.when(~bare, F.col("_r.error")))
        .drop("_r", "payload")
    )


def _replied(layout: DataFrame, label: str, factory: ModelFactory, payload, retry: Retry) -> DataFrame:
    """Layout rows with ``_by_ref``: the reply for each item of one kind. Nothing is shuffled."""
    mine = F.filter("items", lambda it: it.label == label)
    inputs = F.when(F.size(mine) > 0, F.transform(mine, payload))
    # Kept apart from its use below, so that the model is asked once per segment.
    asked = layout.withColumn("_replies", model_replies(inputs, factory, retry))
    refs = F.transform(mine, lambda it: it.ref)
    return asked.withColumn(
        "_by_ref", F.when(F.size(mine) > 0, F.map_from_arrays(refs, F.col("_replies")))
    )


def _annotate(layout: DataFrame, label: str, made: Callable[[Column], Column]) -> DataFrame:
    def touch(it: Column) -> Column:
        more = F.concat(it.annotations, F.array(made(it).cast(ANNOTATION)))
        return F.when(it.label == label, it.withField("annotations", more)).otherwise(it)

    return layout.withColumn("items", F.transform("items", touch)).select(*schemas.layout.fieldNames())


def _annotation(kind: str, text: Column, provenance: Column, classes: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("kind"), text.alias("text"), provenance.alias("provenance"), classes.alias("predicted_classes")
    )


def describe_pictures(
    layout: DataFrame,
    factory: ModelFactory | None,
    model: str,
    enabled: bool = True,
    payload: Callable[[Column], Column] = lambda it: F.coalesce(it.text, F.lit("")),
    retry: Retry = Retry(),
) -> DataFrame:
    """Append a description to the annotations of every picture; skipped without a model."""
    if not enabled or factory is None:
        return layout
    no_classes = F.lit(None).cast("array<struct<class_name:string,confidence:double>>")
    return _annotate(
        _replied(layout, "picture", factory, payload, retry),
        "picture",
        lambda it: _annotation(
            "description", F.coalesce(F.col("_by_ref")[it.ref].text, F.lit("")), F.lit(model), no_classes
        ),
    )


def classify_pictures(
    layout: DataFrame,
    factory: ModelFactory | None = None,
    provenance: str = DEFAULT_CLASS[0],
    enabled: bool = True,
    payload: Callable[[Column], Column] = lambda it: F.coalesce(it.text, F.lit("")),
    retry: Retry = Retry(),
) -> DataFrame:
    """Append a classification to every picture; without a model it is the default class.

    A classifier's reply is a JSON list of ``{"class_name", "confidence"}``.
    """
    if not enabled:
        return layout
    classes = "array<struct<class_name:string,confidence:double>>"
    no_text = F.lit(None).cast("string")
    if factory is None:
        fixed = F.array(F.struct(F.lit(DEFAULT_CLASS[1]).alias("class_name"), F.lit(DEFAULT_CLASS[2]).alias("confidence")))
        return _annotate(layout, "picture", lambda it: _annotation("classification", no_text, F.lit(provenance), fixed))
    return _annotate(
        _replied(layout, "picture", factory, payload, retry),
        "picture",
        lambda it: _annotation(
            "classification", no_text, F.lit(provenance), F.from_json(F.col("_by_ref")[it.ref].text, classes)
        ),
    )


def describe_tables(
    layout: DataFrame,
    factory: ModelFactory | None,
    enabled: bool = True,
    payload: Callable[[Column], Column] = lambda it: F.coalesce(it.text, F.lit("")),
    retry: Retry = Retry(),
) -> DataFrame:
    """Give every table one more caption: a new caption item at the end of the body, on its first page."""
    if not enabled or factory is None:
        return layout
    caption_ref = lambda it: F.concat(F.lit("#/texts/caption-"), F.substring_index(it.ref, "/", -1))

    def caption(it: Column) -> Column:
        made = F.struct(
            (F.lit(ADDED_SEQ) + it.seq).alias("seq"),
            caption_ref(it).alias("ref"),
            F.lit("caption").alias("label"),
            F.lit(1).alias("level"),
            F.slice(it.page_nos, 1, 1).alias("page_nos"),
            F.array().cast(schemas.STRINGS).alias("children"),
            F.array().cast(schemas.STRINGS).alias("caption_refs"),
            F.array().cast(f"array<{ANNOTATION}>").alias("annotations"),
            F.lit(None).cast(schemas.STRINGS).alias("headings"),
            it.run.alias("run"),
            F.coalesce(F.col("_by_ref")[it.ref].text, F.lit("")).alias("text"),
        )
        return made.cast(schemas.item)

    def touch(it: Column) -> Column:
        named = it.withField("caption_refs", F.array_append(it.caption_refs, caption_ref(it)))
        return F.when(it.label == "table", named).otherwise(it)

    asked = _replied(layout, "table", factory, payload, retry)
    added = F.transform(F.filter("items", lambda it: it.label == "table"), caption)
    return asked.withColumn("items", F.concat(F.transform("items", touch), added)).select(
        *schemas.layout.fieldNames()
    )


def heading_in_force(items: DataFrame, bucket: int = 4096) -> DataFrame:
    """Nearest heading at or before each item, over flat items without ``run``.

    The running value is worked out inside buckets of a document and carried over
    bucket borders through one small row per bucket, so no document is one sort.
    """
    from pyspark.sql import Window

    head = F.when(F.col("label").isin("section_header", "title"), F.struct("seq", "text"))
    placed = items.withColumn("_b", F.floor(F.col("seq") / bucket)).withColumn("_h", head)
    ends = placed.groupBy("input_hash", "_b").agg(F.max("_h").alias("_last"))
    before = Window.partitionBy("input_hash").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("input_hash", "_b", F.max("_last").over(before).alias("_in"))
    inside = Window.partitionBy("input_hash", "_b").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.withColumn("_own", F.max("_h").over(inside))
        .join(carried, ["input_hash", "_b"])
        .withColumn("heading", F.coalesce("_own.text", "_in.text"))
        .drop("_b", "_h", "_own", "_in")
    )
