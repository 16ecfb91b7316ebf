"""Structure of plain text: headings, lists and tables told from the shape of the lines, all in the JVM.

Rules, tried in this order on each block of lines:

- ``#`` to ``######`` before a text is a heading of that level, unless the line stands inside a table;
- a run of lines with a pipe sign is a table;
- a line underlined with ``===`` or ``---`` is a heading of level 1 or 2;
- ``1.2 Text`` is a heading as deep as its number unless that is an IP address, ``Chapter 3`` (also part, section, appendix) one of level 1;
- letters all upper-case, four at least, are a heading of level 1;
- ``-``, ``*``, ``+``, a bullet, or one number with ``.`` or ``)`` before a text is a list item, its level by its indent;
- any other line is text.

Headings of the last two kinds end without a punctuation mark, and no heading is
longer than ``HEADING_CHARS``; such lines are text. A heading of level 1 is a ``title``,
a deeper one a ``section_header``. Each item carries the headings in force.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumflow import schemas
from vellumflow.functions.text import SPACE
from vellumflow.operators import scan
from vellumflow.operators.chunking import HEADERS
from vellumflow.sources import text_layout as plain

HEADING_CHARS = 120
INDENT = 2

# A line and the rule below it are one block. Repeats never give back what they took, so a line is read twice at most.
_GAP = r"\t\x0b-\r\x1c-\x20\x85\p{Z}"
_RULED = rf"[{_GAP}]*+[^\n|{SPACE}][^\n|]*+\n(?:={{3,}}|-{{3,}})[ \t]*(?:\n|\z)"
MARKED = r"[ \t]*#{1,6}[ \t][^\n]*(?:\n|\z)"
BLOCK = rf"{MARKED}|(?:[^\n|]*\|[^\n]*(?:\n|\z))++|{_RULED}|[^\n]+"

# No pattern but ``ADDRESS`` looks ahead or behind, so that SQL engines with plain regular expressions take them too.
UNDERLINED = rf"^[{SPACE}]*([^\n]*[^\n{SPACE}])[{SPACE}]*\n([=-])[=-]*[ \t]*\n?\z"
HASHED = rf"^[{SPACE}]*(#{{1,6}})[ \t]+([^\n]*?)(?:[ \t]+#+)?[{SPACE}]*\z"
NUMBERED = rf"^[{SPACE}]*([0-9]+(?:\.[0-9]+)+)\.?[ \t]+\p{{L}}[^\n]*[^\n{SPACE}.!?:;,][{SPACE}]*\z"
# Four numbers up to 255, one of them beyond what headings count to, are an IP address. Not part of ``NUMBERED``, as it looks ahead.
_UP_TO_255 = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
ADDRESS = rf"^[{SPACE}]*(?=[0-9.]*(?:3[2-9]|[4-9][0-9]|[0-9]{{3}})){_UP_TO_255}(?:\.{_UP_TO_255}){{3}}\.?[ \t]"
NAMED = (
    rf"^[{SPACE}]*(?i:chapter|part|section|appendix)[ \t]+(?:[0-9]+|[A-Z]|[IVXLC]+)"
    rf"(?:[.:]?[ \t]+[^\n]*[^\n{SPACE}.!?:;,])?[{SPACE}]*\z"
)
FOUR_CAPITALS = r"^(?:[^\p{L}]*\p{Lu}){4}"
NO_SMALL = rf"^[^\p{{Ll}}\p{{Lt}}]*[\p{{Lu}}\p{{N}})][{SPACE}]*\z"
LISTED = rf"^([ \t]*)(?:[-*+•]|[0-9]+[.)])[ \t]+([^\n]*?[^\n{SPACE}])[{SPACE}]*\z"
ENDS = rf"^[{SPACE}]+|[{SPACE}]+\z"


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _shape(block: Column) -> Column:
    """Kind, level and text of one block."""
    is_like = lambda pattern: F.regexp_like(block, F.lit(pattern))
    part = lambda pattern, n: F.regexp_extract(block, pattern, n)
    found = lambda kind, level, shown: F.struct(
        F.lit(kind).alias("kind"), level.cast("int").alias("level"), shown.alias("text")
    )
    trimmed = F.regexp_replace(block, ENDS, "")
    whole = F.regexp_replace(block, r"\n\z", "")
    head = (
        F.when(is_like(UNDERLINED), found("head", F.when(part(UNDERLINED, 2) == "=", 1).otherwise(2), part(UNDERLINED, 1)))
        .when(is_like(HASHED) & (part(HASHED, 2) != ""), found("head", F.length(part(HASHED, 1)), part(HASHED, 2)))
        .when(is_like(NUMBERED) & ~is_like(ADDRESS), found("head", F.least(F.size(F.split(part(NUMBERED, 1), "[.]")), F.lit(6)), trimmed))
        .when(is_like(NAMED) | (is_like(FOUR_CAPITALS) & is_like(NO_SMALL)), found("head", F.lit(1), trimmed))
    )
    indent = F.length(F.regexp_replace(part(LISTED, 1), "\t", "    "))
    is_table = F.contains(block, F.lit("|")) & ~is_like("^" + MARKED)
    return F.when(is_table, found("table", F.lit(1), whole)).otherwise(
        F.coalesce(
            F.when(F.length(block) <= HEADING_CHARS, head),
            F.when(is_like(LISTED), found("list_item", F.floor(indent / INDENT) + 1, part(LISTED, 2))),
            found("text", F.lit(1), whole),
        )
    )


def _shaped(block: Column, seq: Column, per_page: int) -> Column:
    """The item of one block; headings are put in force later."""
    item = plain._item(block, seq, per_page)

    def use(shape: Column) -> Column:
        label = (
            F.when(shape.kind != "head", shape.kind)
            .when(shape.level == 1, F.lit("title"))
            .otherwise(F.lit("section_header"))
        )
        kind = F.when(shape.kind == "table", F.lit("#/tables/")).otherwise(F.lit("#/texts/"))
        ref = F.concat(kind, seq.cast("string"))
        return item.withField("ref", ref).withField("label", label).withField("level", shape.level).withField("text", shape.text)

    return _bound(_shape(block), use)


# --- headings in force -----------------------------------------------------------------------
#
# The state is the path of open headings: the newest of each level that no later
# heading of the same or a smaller level has closed. A segment closes all of its
# smallest level and deeper, and leaves its own path open.

_NAMES = ", ".join(f"'{label}'" for label in HEADERS)
_OPEN = "slice(array(named_struct('level', 1, 'seq', 0, 'text', '')), 1, 0)"
_PUSH = "concat(filter({s}, h -> h.level < {h}.level), array({h}))"
_CLOSED = "concat(filter({s}, h -> h.level < {m}.closes), {m}.path)"
_HEADS = (
    f"transform(filter(items, it -> it.label IN ({_NAMES})),"
    " it -> named_struct('level', it.level, 'seq', it.seq, 'text', it.text))"
)
_OWN_PATH = f"aggregate(heads, {_OPEN}, (s, x) -> {_PUSH.format(s='s', h='x')})"
# One stretch of items for each heading, and one before the first; each with the path in force.
_STRETCHES = f"""
    aggregate(heads,
      named_struct('path', path, 'seen', array(named_struct('seq', -1, 'path', path))),
      (t, x) -> named_struct('path', {_PUSH.format(s="t.path", h="x")},
        'seen', concat(t.seen, array(named_struct('seq', x.seq, 'path', {_PUSH.format(s="t.path", h="x")})))),
      t -> t.seen)"""


def _in_force(layout: DataFrame) -> DataFrame:
    """Every item with the path that it stands under; ``path`` is the one before the segment.

    Items are cut at their headings, so the work is items plus headings.
    """
    names = schemas.item.fieldNames()
    told = {
        "headings": "IF(size(st.path) > 0, transform(st.path, h -> h.text), CAST(NULL AS ARRAY<STRING>))",
        "run": "IF(size(st.path) > 0, element_at(st.path, -1).seq, -1)",
    }
    rebuilt = ", ".join(f"'{n}', {told.get(n, f'it.{n}')}" for n in names)
    # Seq is dense inside a segment, so the place of a heading is its distance from the first item.
    begins = "IF(st.seq < 0, 0, st.seq - items[0].seq)"
    ends = "IF(k + 1 < size(stretches), stretches[k + 1].seq - items[0].seq, size(items))"
    cut = f"""flatten(transform(stretches, (st, k) ->
        transform(slice(items, {begins} + 1, {ends} - {begins}), it -> named_struct({rebuilt}))))"""
    return (
        layout.withColumn("stretches", F.expr(_STRETCHES))
        .withColumn("items", F.when(F.size("items") > 0, F.expr(cut)).otherwise(F.col("items")))
        .select(*schemas.layout.fieldNames())
    )


def with_headings(layout: DataFrame, block: int = scan.BLOCK) -> DataFrame:
    """Put headings in force over a layout whose items have dense ``seq``: ``headings`` and ``run`` are set anew.

    Nothing moves for documents of one segment. For longer ones only the open
    headings of each segment are scanned along the document. Give it a stored
    layout, as long documents are read twice.
    """
    headed = layout.withColumn("heads", F.expr(_HEADS))
    short = _in_force(headed.where("n_segs = 1").withColumn("path", F.expr(_OPEN)))
    most = scan.longest(layout)
    if most <= 1:
        return short
    long = headed.where("n_segs > 1")
    maps = long.select(
        "input_hash",
        F.col("seg").alias("at"),
        F.expr(f"named_struct('closes', coalesce(array_min(heads.level), {1 << 30}), 'path', {_OWN_PATH})").alias("m"),
    )
    states = scan.states_before(
        maps,
        "input_hash",
        start=_OPEN,
        after=_CLOSED,
        compose=f"named_struct('closes', least({{a}}.closes, {{b}}.closes), 'path', {_CLOSED.format(s='{a}.path', m='{b}')})",
        block=block,
        levels=scan.levels_for(most, block),
    )
    entered = long.join(states.select("input_hash", F.col("at").alias("seg"), F.col("s").alias("path")), ["input_hash", "seg"])
    return short.unionByName(_in_force(entered))


def structured_layout(
    docs: DataFrame,
    key: Column,
    filename: Column,
    text: str = "text",
    size: str | None = None,
    items_per_page: int = plain.ITEMS_PER_PAGE,
    segment_items: int = plain.SEGMENT_ITEMS,
    block: int = scan.BLOCK,
) -> DataFrame:
    """Layout of plain texts with headings, list items and tables; parameters as in ``text_layout``."""
    laid = plain.text_layout(
        docs, key, filename, text, size, items_per_page, segment_items, pattern=BLOCK, shape=_shaped
    )
    return with_headings(laid, block)
