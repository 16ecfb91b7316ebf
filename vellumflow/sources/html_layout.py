"""Layout of web pages. HTML in the wild is malformed, so a small tolerant reader is used per row."""

from __future__ import annotations

import time
from collections.abc import Iterator
from functools import partial
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from vellumflow import schemas

SEGMENT_ITEMS = 4096

# A page of the result holds at most so many items.
PAGE_ITEMS = 4096
# Items that a task gathers before it hands them on.
HELD_ITEMS = 8192

# Which elements are furniture, which begin a block, and which label a block gets.
FURNITURE = frozenset({"head", "title", "script", "style", "nav", "footer", "template", "noscript"})
FURNITURE_CLASSES = frozenset({"ad"})
LABELS = {
    "h1": "title",
    "h2": "section_header",
    "h3": "section_header",
    "h4": "section_header",
    "h5": "section_header",
    "h6": "section_header",
    "p": "text",
    "li": "list_item",
    "pre": "code",
    "caption": "caption",
    "figcaption": "caption",
}
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figure footer form header hgroup hr html"
    " legend main menu nav ol option optgroup search section select summary table tbody td tfoot th thead tr ul".split()
) | LABELS.keys()
KINDS = {"table": "tables", "picture": "pictures"}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# What a start tag ends, if it stands open in the same list or table.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"},
    "tbody": {"tr", "td", "th", "tbody", "thead", "tfoot"}, "tfoot": {"tr", "td", "th", "tbody", "thead", "tfoot"},
}
LISTS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}}
CELLS = {"td", "th"}


class _Reader(HTMLParser):
    """Collects blocks of text in reading order; every visible word lands in some item.

    Text outside labelled blocks is text too. An end tag ends all that stands open
    inside its element, so what is never closed ends with its parent.
    """

    def __init__(self, furniture_classes: frozenset[str] = FURNITURE_CLASSES) -> None:
        super().__init__(convert_charrefs=True)
        self.furniture_classes = furniture_classes
        self.items: list[dict] = []
        self.counts: dict[str, int] = {}
        self.open: list[tuple[str, bool]] = []  # tag, and whether it is or lies in furniture
        self.text: list[str] = []
        self.tables: list[dict] = []
        self.figures: list[dict] = []
        self.headings: list[tuple[int, str]] = []
        self.run = -1

    def add(self, label: str, level: int, text: str) -> dict:
        kind = KINDS.get(label, "texts")
        number = self.counts.get(kind, 0)
        self.counts[kind] = number + 1
        found = {
            "seq": len(self.items),
            "ref": f"#/{kind}/{number}",
            "label": label,
            "level": level,
            "page_nos": [len(self.items) // PAGE_ITEMS + 1],
            "children": [],
            "caption_refs": [],
            "annotations": [],
            "headings": [t for _, t in self.headings] or None,
            "run": self.run,
            "text": text,
        }
        self.items.append(found)
        return found

    def hidden(self) -> bool:
        return bool(self.open) and self.open[-1][1]

    def inside(self) -> str:
        """The innermost open element that labels text or holds cells."""
        for tag, _ in reversed(self.open):
            if tag in LABELS or tag in CELLS or tag == "table":
                return tag
        return ""

    def flush(self) -> None:
        """Turn the text read so far into an item, or a part of the open cell."""
        raw, self.text = "".join(self.text), []
        tag = self.inside()
        cell = self.tables[-1]["cell"] if self.tables else None
        if cell is not None and tag != "caption":
            cell.append(raw)
            return
        text = raw.strip("\n").rstrip() if tag == "pre" else " ".join(raw.split())
        if not text.strip():
            return
        label, level = LABELS.get(tag, "text"), int(tag[1]) if tag[:1] == "h" and tag in LABELS else 1
        if label in ("title", "section_header"):
            self.headings = [(lv, t) for lv, t in self.headings if lv < level]
            self.run = len(self.items)
            self.headings.append((level, text))
        found = self.add(label, level, text)
        if label == "caption":
            owner = self.tables[-1]["item"] if self.tables else self.figures[-1]["last"] if self.figures else None
            if owner is not None:
                owner["caption_refs"].append(found["ref"])
            elif self.figures:
                self.figures[-1]["captions"].append(found["ref"])

    def own(self, item: dict) -> None:
        """A picture or table of the open figure takes its captions."""
        if self.figures:
            item["caption_refs"] += self.figures[-1]["captions"]
            self.figures[-1].update(last=item, captions=[])

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in BLOCKS:
            self.pop_to("head")
        self.end_implied(tag)
        known = dict(attrs)
        furniture = tag in FURNITURE or bool(set((known.get("class") or "").split()) & self.furniture_classes)
        if self.hidden() or furniture:
            if not self.hidden() and tag in BLOCKS:
                self.flush()
            if tag not in VOID:
                self.open.append((tag, True))
            return
        if tag == "br":
            self.text.append("\n" if self.inside() == "pre" else " ")
        elif tag == "img":
            if self.tables and self.tables[-1]["cell"] is not None:
                self.text.append(" ")
            else:
                self.flush()
            self.own(self.add("picture", 1, known.get("alt") or ""))
        elif tag in BLOCKS:
            self.flush()
        if tag not in VOID:
            self.open.append((tag, False))
        if tag == "figure":
            self.figures.append({"last": None, "captions": []})
        elif tag == "table":
            item = self.add("table", 1, "")
            self.own(item)
            self.tables.append({"item": item, "rows": [], "cell": None})
        elif self.tables and tag == "tr":
            self.tables[-1]["rows"].append([])
        elif self.tables and tag in CELLS:
            self.tables[-1]["cell"] = []
        elif tag in BLOCKS and self.tables and self.tables[-1]["cell"] is not None:
            self.text.append(" ")

    def end_implied(self, tag: str) -> None:
        ended = set(ENDS.get(tag, ()))
        if tag in BLOCKS and tag not in ("body", "html", "option"):
            ended |= {"p"}
        border = LISTS.get(tag, {"table"} if tag in ENDS else set())
        for i in range(len(self.open) - 1, -1, -1):
            held = self.open[i][0]
            if held in border or held == "table" or held in CELLS and held not in ended or held in ("caption", "figcaption", "button"):
                return
            if held in ended:
                self.pop_to(held)
                if tag not in ("tr", "tbody", "tfoot"):
                    return
                self.end_implied(tag)
                return

    def pop_to(self, tag: str) -> None:
        """End the innermost such element and all inside it; nothing if there is none."""
        if all(held != tag for held, _ in self.open):
            return
        while True:
            held, furniture = self.open[-1]
            if not furniture and (held in BLOCKS):
                self.flush()
            self.open.pop()
            if not furniture:
                self.ended(held)
            if held == tag:
                return

    def ended(self, tag: str) -> None:
        if tag in CELLS and self.tables and self.tables[-1]["cell"] is not None:
            table = self.tables[-1]
            if not table["rows"]:
                table["rows"].append([])
            table["rows"][-1].append(" ".join("".join(table["cell"]).split()))
            table["cell"] = None
        elif tag == "table" and self.tables:
            table = self.tables.pop()
            table["item"]["text"] = markdown_table(table["rows"])
            if self.tables and self.tables[-1]["cell"] is not None:
                self.text.append(" ")
        elif tag == "figure" and self.figures:
            self.figures.pop()
        elif tag in BLOCKS and self.tables and self.tables[-1]["cell"] is not None:
            self.text.append(" ")

    def handle_endtag(self, tag: str) -> None:
        if tag not in VOID:
            self.pop_to(tag)

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_data(self, data: str) -> None:
        if not self.hidden():
            self.text.append(data)

    def finish(self) -> list[dict]:
        self.close()
        while self.open:
            self.pop_to(self.open[-1][0])
        self.flush()
        return self.items


def markdown_table(rows: list[list[str]]) -> str:
    rows = [r for r in rows if r]
    if not rows:
        return ""
    width = max(map(len, rows))
    lines = ["| " + " | ".join(r + [""] * (width - len(r))) + " |" for r in rows]
    return "\n".join([lines[0], "|" + " --- |" * width, *lines[1:]])


def read_html(html: str, furniture_classes: frozenset[str] = FURNITURE_CLASSES) -> list[dict]:
    """Layout items of one page, in reading order; elements of ``furniture_classes`` are left out."""
    reader = _Reader(frozenset(furniture_classes))
    reader.feed(html or "")
    return reader.finish()


class HtmlItems:
    """Table function for SQL: ``SELECT ... FROM pages, LATERAL html_items(html)``."""

    def eval(self, html: str):
        for found in read_html(html):
            yield tuple(found[name] for name in schemas.item.fieldNames())


def register_html_items(spark: SparkSession, name: str = "html_items") -> None:
    spark.udtf.register(name, F.udtf(HtmlItems, returnType=schemas.item))


def _layout_rows(batches: Iterator[pa.RecordBatch], extract, segment_items: int) -> Iterator[pa.RecordBatch]:
    """Layout of ``(input_hash, filename, html)``. One page at a time becomes a string, and its items leave by the thousand, however large a batch is."""
    names, made = schemas.layout.fieldNames(), to_arrow_schema(schemas.layout)
    rows, held = [], 0
    for batch in batches:
        for at in range(batch.num_rows):
            input_hash, name, body = (batch.column(i)[at].as_py() for i in range(3))
            items = extract(body)
            n_segs = max(1, -(-len(items) // segment_items))
            for seg in range(n_segs):
                part = items[seg * segment_items : (seg + 1) * segment_items]
                rows.append((input_hash, name, seg, n_segs, part))
                held += len(part) + 1
                if held >= HELD_ITEMS:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in rows], schema=made)
                    rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in rows], schema=made)


def html_layout(
    pages: DataFrame,
    key: Column,
    filename: Column,
    html: str = "html",
    segment_items: int = SEGMENT_ITEMS,
    extract=read_html,
    furniture_classes: frozenset[str] | None = None,
) -> DataFrame:
    """One layout row per segment of each page; ``extract`` may be swapped for another format."""
    if furniture_classes is not None:
        extract = partial(read_html, furniture_classes=frozenset(furniture_classes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _layout_rows(batches, extract, segment_items)

    source = pages.select(key.alias("input_hash"), filename.alias("filename"), F.col(html).alias("html"))
    return source.mapInArrow(run, schemas.layout)


def html_seconds(pages: DataFrame, key: Column, html: str = "html", extract=read_html) -> DataFrame:
    """(input_hash, n_items, seconds): how long each page took to read, measured where it is read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for input_hash, body in zip(batch["input_hash"], batch["html"]):
                begin = time.perf_counter()
                n = len(extract(body))
                rows.append((input_hash, n, time.perf_counter() - begin))
            yield pd.DataFrame(rows, columns=["input_hash", "n_items", "seconds"])

    source = pages.select(key.alias("input_hash"), F.col(html).alias("html"))
    return source.mapInPandas(run, "input_hash string, n_items long, seconds double")
