"""Hand-made layouts: A to F of FIXTURES.md."""

from vellumflow import schemas
from vellumflow.sources.text_layout import nested_items


def item(doc, seq, label, text, pages=(1,), kind=None, no=None, children=(), captions=(), notes=(), headings=None, run=-1):
    kind = kind or {"table": "tables", "picture": "pictures"}.get(label, "texts")
    no = seq if no is None else no
    return (
        doc, f"{doc}.pdf", seq, f"#/{kind}/{no}", label, 1, list(pages), list(children), list(captions),
        [(k, t, "test", None) for k, t in notes], headings, run, text,
    )


def layout(spark, rows, segment_items=4096):
    fields = [("input_hash", "string"), ("filename", "string")]
    schema = ", ".join(f"{n} {t}" for n, t in fields) + ", " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in schemas.item.fields
    )
    return nested_items(spark.createDataFrame(rows, schema), segment_items)


DOCS = [
    # A: all kinds on three pages
    item("A", 0, "title", "Guide", (1,), headings=["Guide"], run=0),
    item("A", 1, "text", "one two three", (1,), headings=["Guide"], run=0),
    item("A", 2, "text", "four five", (1,), headings=["Guide"], run=0),
    item("A", 3, "section_header", "Setup", (2,), headings=["Guide", "Setup"], run=3),
    item("A", 4, "table", "| a |\n| b |", (2,), no=0, children=["#/texts/90"], captions=["#/texts/5"]),
    item("A", 5, "caption", "Sizes", (2,)),
    item("A", 6, "text", "six seven", (2,), headings=["Guide", "Setup"], run=3),
    item("A", 7, "picture", "", (3,), no=0, notes=[("description", "a pump"), ("classification", None)]),
    item("A", 8, "text", "eight", (3,), headings=["Guide", "Setup"], run=3),
    # B: pages out of order and repeated; a table over two pages
    item("B", 0, "text", "spread", (2, 1, 2)),
    item("B", 1, "table", "| t |", (1, 2), no=0),
    # C: no pages at all
    item("C", 0, "text", "nowhere", ()),
    item("C", 1, "text", "at all", ()),
    # D: descriptions two, none, empty; a table without caption
    item("D", 0, "picture", "", no=0, notes=[("description", "red"), ("description", "blue")]),
    item("D", 1, "picture", "", no=1),
    item("D", 2, "picture", "", no=2, notes=[("description", "")]),
    item("D", 3, "table", "| x |", no=0),
    # E: limits, with four tokens to a chunk
    item("E", 0, "text", "a b c d"),
    item("E", 1, "text", "e f"),
    item("E", 2, "text", "g h"),
    item("E", 3, "text", "i j k l m n o p q r"),
    item("E", 4, "text", "s"),
    item("E", 5, "section_header", "Empty", headings=["Empty"], run=5),
    item("E", 6, "section_header", "Next", headings=["Next"], run=6),
    item("E", 7, "text", "t", headings=["Next"], run=6),
    # F: headings twice and out of order
    item("F", 0, "section_header", "Zeta", headings=["Zeta"], run=0),
    item("F", 1, "section_header", "Alpha", headings=["Alpha"], run=1),
    item("F", 2, "section_header", "Zeta", headings=["Zeta"], run=2),
    item("F", 3, "text", "end", headings=["Zeta"], run=2),
]
