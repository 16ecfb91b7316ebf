"""Table contracts shared by all operators."""

from __future__ import annotations

from pyspark.sql import types as T

STRINGS = T.ArrayType(T.StringType())
INTS = T.ArrayType(T.IntegerType())
VECTOR = T.ArrayType(T.FloatType())


def fields(**columns: T.DataType) -> T.StructType:
    """A struct of nullable fields, in the order given."""
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


driver_list = fields(document_name=T.StringType(), document_url=T.StringType())

annotation = fields(
    kind=T.StringType(),
    text=T.StringType(),
    provenance=T.StringType(),
    predicted_classes=T.ArrayType(fields(class_name=T.StringType(), confidence=T.DoubleType())),
)

# One layout item. ``run`` is the ``seq`` of the heading in force, -1 before any heading.
item = fields(
    seq=T.IntegerType(),
    ref=T.StringType(),
    label=T.StringType(),
    level=T.IntegerType(),
    page_nos=INTS,
    children=STRINGS,
    caption_refs=STRINGS,
    annotations=T.ArrayType(annotation),
    headings=STRINGS,
    run=T.IntegerType(),
    text=T.StringType(),
)

# A document is stored as one row per bounded segment of consecutive items.
layout = fields(
    input_hash=T.StringType(),
    filename=T.StringType(),
    seg=T.IntegerType(),
    n_segs=T.IntegerType(),
    items=T.ArrayType(item),
)

chunk = fields(
    filename=T.StringType(),
    input_hash=T.StringType(),
    pages=INTS,
    doc_refs=STRINGS,
    has_table=T.BooleanType(),
    has_picture=T.BooleanType(),
    tables=STRINGS,
    pictures=STRINGS,
    headings=STRINGS,
    captions=STRINGS,
    chunk_type=T.StringType(),
    image_path=T.StringType(),
    text=T.StringType(),
    enriched_text=T.StringType(),
)

# Columns the embedded table keeps in step with the chunk table.
synced_columns = [
    "filename",
    "input_hash",
    "pages",
    "chunk_type",
    "image_path",
    "text",
    "enriched_text",
    "id",
]

images = fields(
    input_hash=T.StringType(),
    kind=T.StringType(),
    ref=T.StringType(),
    path=T.StringType(),
    bytes=T.BinaryType(),
)

message = fields(role=T.StringType(), content=T.StringType())

graph_node = fields(
    id=T.StringType(),
    label=T.StringType(),
    type=T.StringType(),
    properties=T.MapType(T.StringType(), T.StringType()),
)

# The metadata union, told apart by ``kind``; fields of other kinds stay null.
metadata_union = fields(
    kind=T.StringType(),
    provenance=T.StringType(),
    text=T.StringType(),
    predicted_classes=T.ArrayType(fields(class_name=T.StringType(), confidence=T.DoubleType())),
    id=T.StringType(),
    label=T.StringType(),
    type=T.StringType(),
    properties=T.MapType(T.StringType(), T.StringType()),
    subject=graph_node,
    predicate=T.StringType(),
    object=graph_node,
)
