"""Structure of plain text against the rules in plain Python."""

import random

from pyspark.sql import functions as F

from vellumflow.operators import chunking
from vellumflow.sources.structure import structured_layout
from vellumflow.sources.text_layout import flat_items

TEXT = """ANNUAL REPORT
Some words first.

1.1 Scope of work
The scope is small.
- one
  - two
3) three
# Marked ##
### Deep
text under deep
## Less deep
a | b
c | d
Under line
==========
last words
Not a head
---
| solo
Chapter 4 The end
1.2 This one ends like a sentence.
SHOUTED! 
A.
#hash
----
# With | sign
x | y
# in | table
"""

EXPECTED = [
    ("title", 1, "ANNUAL REPORT", ["ANNUAL REPORT"]),
    ("text", 1, "Some words first.", ["ANNUAL REPORT"]),
    ("section_header", 2, "1.1 Scope of work", ["ANNUAL REPORT", "1.1 Scope of work"]),
    ("text", 1, "The scope is small.", ["ANNUAL REPORT", "1.1 Scope of work"]),
    ("list_item", 1, "one", ["ANNUAL REPORT", "1.1 Scope of work"]),
    ("list_item", 2, "two", ["ANNUAL REPORT", "1.1 Scope of work"]),
    ("list_item", 1, "three", ["ANNUAL REPORT", "1.1 Scope of work"]),
    ("title", 1, "Marked", ["Marked"]),
    ("section_header", 3, "Deep", ["Marked", "Deep"]),
    ("text", 1, "text under deep", ["Marked", "Deep"]),
    ("section_header", 2, "Less deep", ["Marked", "Less deep"]),
    ("table", 1, "a | b\nc | d", ["Marked", "Less deep"]),
    ("title", 1, "Under line", ["Under line"]),
    ("text", 1, "last words", ["Under line"]),
    ("section_header", 2, "Not a head", ["Under line", "Not a head"]),
    ("table", 1, "| solo", ["Under line", "Not a head"]),
    ("title", 1, "Chapter 4 The end", ["Chapter 4 The end"]),
    ("text", 1, "1.2 This one ends like a sentence.", ["Chapter 4 The end"]),
    ("text", 1, "SHOUTED! ", ["Chapter 4 The end"]),
    ("text", 1, "A.", ["Chapter 4 The end"]),
    ("section_header", 2, "#hash", ["Chapter 4 The end", "#hash"]),
    ("title", 1, "With | sign", ["With | sign"]),
    ("table", 1, "x | y\n# in | table", ["With | sign"]),
]


def laid(spark, rows, **options):
    docs = spark.createDataFrame(rows, "name string, text string")
    return structured_layout(docs, F.md5("name"), F.col("name"), **options)


def items(layout, name):
    found = flat_items(layout.where(F.col("filename") == name)).orderBy("seq").collect()
    return [(r.label, r.level, r.text, r.headings) for r in found]


def test_rules(spark):
    layout = laid(spark, [("a", TEXT), ("b", None), ("c", ""), ("d", "plain\n" + "LONG " * 30)])
    assert items(layout, "a") == EXPECTED
    assert items(layout, "b") == items(layout, "c") == []
    assert [x[0] for x in items(layout, "d")] == ["text", "text"]


def test_addresses_are_no_headings(spark):
    lines = ["71.175.131.116 Atat and more", "10.2.4.64. Next words", "1.2.3.4 Deep part", "4.12.31 Part", "300.400.500.600 Lots"]
    found = items(laid(spark, [("a", "\n".join(lines))]), "a")
    assert [x[0] for x in found] == ["text", "text", "section_header", "section_header", "section_header"]


def test_segments_do_not_change_headings(spark):
    """Random headings, cut into segments of a few items and scanned in blocks of two."""
    random.seed(5)
    rows, expected = [], {}
    for d in range(6):
        lines, path, told = [], [], []
        for n in range(random.randint(1, 60)):
            level = random.choice([0, 0, 0, 1, 2, 3, 4])
            lines.append(f"{'#' * level} head {n}" if level else f"words {n}")
            if level:
                path = [(lv, t, s) for lv, t, s in path if lv < level] + [(level, f"head {n}", n)]
            told.append((n, [t for _, t, _ in path] or None, path[-1][2] if path else -1))
        rows.append((f"doc{d}", "\n".join(lines)))
        expected[f"doc{d}"] = told
    whole, cut = laid(spark, rows), laid(spark, rows, segment_items=3, block=2)
    assert cut.where("n_segs > 1").count() > 8
    for layout in (whole, cut):
        got = {}
        for r in flat_items(layout).orderBy("seq").collect():
            got.setdefault(r.filename, []).append((r.seq, r.headings, r.run))
        assert got == expected
    one, two = (sorted(map(str, chunking.text_chunks(x, 4).collect())) for x in (whole, cut))
    assert one == two


def test_very_long_lines(spark):
    """Lines of a megabyte are read in linear time, as text."""
    line = "word " * 200_000
    found = items(laid(spark, [("a", f"# Head\n{line}\n{'-' * 1_000_000}\n{'A' * 1_000_000}")]), "a")
    assert [(x[0], len(x[2])) for x in found] == [("title", 4), ("text", 2_000_001), ("text", 1_000_000)]
    assert all(x[3] == ["Head"] for x in found)
