"""Chunk builders: text, table, picture and page chunks, and their union."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumflow import schemas
from vellumflow.functions import refs, templates
from vellumflow.functions.text import SPACED_TERMS_SQL, TRIMMED_SQL
from vellumflow.operators import scan

# Labels that never become body text.
NOT_BODY = [
    "title",
    "section_header",
    "caption",
    "page_header",
    "page_footer",
    "table",
    "picture",
]
HEADERS = ["section_header", "title"]
TYPE_ORDER = ["text", "picture", "table", "page"]
DEFAULT_MAX_TOKENS = 200


# --- text chunks -----------------------------------------------------------------
#
# Written as SQL text: one expression each, where the column API would need
# hundreds of calls to the JVM to build the same.

_NAMES = ", ".join(f"'{label}'" for label in NOT_BODY)


def _pieces(max_tokens: int, terms: str) -> Column:
    """Body items in order; an item over the limit becomes consecutive slices of it."""
    m = max_tokens

    def piece(part: str, n: str, text: str) -> str:
        return f"""named_struct('n', {n}, 'part', {part}, 'run', c.it.run, 'ref', c.it.ref,
            'page_nos', c.it.page_nos, 'headings', c.it.headings, 'text', {text})"""

    sliced = f"array_join(slice(c.terms, j * {m} + 1, {m}), '')"
    return F.expr(f"""
        transform(
          filter(
            flatten(transform(
              transform(filter(items, it -> it.label NOT IN ({_NAMES})),
                        it -> named_struct('it', it, 'terms', {terms.format(text="it.text")})),
              c -> CASE WHEN size(c.terms) <= {m} THEN array({piece("0", "size(c.terms)", "c.it.text")})
                   ELSE transform(
                     sequence(0, CAST(floor((size(c.terms) - 1) / {m}) AS INT)),
                     j -> {piece("j", f"least({m}, size(c.terms) - j * {m})", TRIMMED_SQL.format(text=sliced))})
                   END)),
            p -> p.n > 0),
          (p, i) -> named_struct('i', i, 'n', p.n, 'part', p.part, 'run', p.run, 'ref', p.ref,
                                 'page_nos', p.page_nos, 'headings', p.headings, 'text', p.text))""")


def _opens(max_tokens: int) -> str:
    """Does piece ``p`` open a new chunk after state ``s``?"""
    return f"(s.run <> p.run OR s.n + p.n > {max_tokens})"


def _cuts(max_tokens: int) -> Column:
    """Indexes of the pieces that open a new chunk, given the chunk that is open before them."""
    opens = _opens(max_tokens)
    return F.expr(f"""
        aggregate(pieces, named_struct('n', open_n, 'run', open_run, 'cuts', CAST(array() AS ARRAY<INT>)),
          (s, p) -> named_struct('n', IF({opens}, p.n, s.n + p.n), 'run', p.run,
                                 'cuts', IF({opens}, concat(s.cuts, array(p.i)), s.cuts)),
          s -> s.cuts)""")


def _exits(max_tokens: int) -> Column:
    """For every possible size of the chunk open at entry: its size at exit and the last cut (-1: none)."""
    opens = _opens(max_tokens)
    return F.expr(f"""
        transform(sequence(0, {max_tokens}), v -> aggregate(
          pieces, named_struct('n', v, 'run', pieces[0].run, 'cut', -1),
          (s, p) -> named_struct('n', IF({opens}, p.n, s.n + p.n), 'run', p.run, 'cut', IF({opens}, p.i, s.cut)),
          s -> named_struct('n', s.n, 'cut', s.cut)))""")


# A row of the scan over segments holds at most so many bytes of maps.
SCAN_BYTES = 1 << 20


def _entries(pieced: DataFrame, max_tokens: int, block: int, levels: int) -> DataFrame:
    """State in which each segment of a long document is entered.

    Each segment is first reduced to a small map from entry to exit state, so
    that only these maps, never the texts, are composed along a document.
    """
    maps = (
        pieced.where(F.size("pieces") > 0)
        .select("input_hash", "seg", "pieces", _exits(max_tokens).alias("exits"))
        .select(
            "input_hash",
            F.col("seg").alias("at"),
            F.expr("""named_struct('first_run', pieces[0].run, 'last_run', element_at(pieces, -1).run,
                'n', transform(exits, e -> e.n), 'seg', transform(exits, e -> IF(e.cut >= 0, seg, -1)),
                'i', transform(exits, e -> e.cut))""").alias("m"),
        )
    )
    # A chunk of other headings cannot go on, which is the same as a full one.
    gone = f"IF({{s}}.run = {{m}}.first_run, {{s}}.n, {max_tokens}) + 1"
    met = f"IF({{a}}.last_run = {{b}}.first_run, v, {max_tokens}) + 1"
    later = lambda name: (
        f"transform({{a}}.n, (v, j) -> IF(element_at({{b}}.i, {met}) >= 0, element_at({{b}}.{name}, {met}), {{a}}.{name}[j]))"
    )
    opened = lambda name: f"IF(element_at({{m}}.i, {gone}) >= 0, element_at({{m}}.{name}, {gone}), {{s}}.open_{name})"
    states = scan.states_before(
        maps,
        "input_hash",
        start=f"named_struct('n', {max_tokens}, 'run', -2, 'open_seg', -1, 'open_i', -1)",
        after=f"named_struct('n', element_at({{m}}.n, {gone}), 'run', {{m}}.last_run,"
        f" 'open_seg', {opened('seg')}, 'open_i', {opened('i')})",
        compose=f"named_struct('first_run', {{a}}.first_run, 'last_run', {{b}}.last_run,"
        f" 'n', transform({{a}}.n, v -> element_at({{b}}.n, {met})), 'seg', {later('seg')}, 'i', {later('i')})",
        block=block,
        levels=levels,
    )
    return states.selectExpr(
        "input_hash", "at AS seg", "s.n AS open_n", "s.run AS open_run", "s.open_seg AS open_seg", "s.open_i AS open_i"
    )


_IN_ORDER = "array_sort({rows}, (a, b) -> a.seg - b.seg)"


def _parts(cut: DataFrame) -> DataFrame:
    """One row per chunk (or part of a chunk that crosses a segment border)."""
    first = "coalesce(get(cuts, 0), size(pieces))"
    own = """transform(cuts, (c, j) -> named_struct('open_seg', seg, 'open_i', c,
        'ps', slice(pieces, c + 1, coalesce(get(cuts, j + 1), size(pieces)) - c)))"""
    carried = f"array(named_struct('open_seg', open_seg, 'open_i', open_i, 'ps', slice(pieces, 1, {first})))"
    return cut.selectExpr(
        "input_hash", "filename", "seg", f"inline(CASE WHEN {first} > 0 THEN concat({carried}, {own}) ELSE {own} END)"
    )


def text_chunks(
    layout: DataFrame, max_tokens: int = DEFAULT_MAX_TOKENS, terms: str = SPACED_TERMS_SQL, block: int | None = None
) -> DataFrame:
    """Pack body items under one heading into chunks of at most ``max_tokens`` tokens.

    ``terms`` is the token counter: SQL that turns ``{text}`` into an array of
    tokens, which joined give the text back.

    A document of one segment is packed inside its row. A longer one is packed
    per segment, after the state at each segment border has been worked out by a
    scan over blocks of ``block`` segments (by default as many as fit a row of 1 MB),
    in as many levels as the longest document needs. Give it a stored layout: a
    first small job looks at ``n_segs`` of long documents.
    """
    pieced = layout.select("input_hash", "filename", "seg", "n_segs", _pieces(max_tokens, terms).alias("pieces"))

    fresh = [f"{max_tokens} AS open_n", "-2 AS open_run", "-1 AS open_seg", "-1 AS open_i"]
    short = pieced.where("n_segs = 1").selectExpr("*", *fresh).withColumn("cuts", _cuts(max_tokens))
    short_chunks = _parts(short).select("input_hash", "filename", "open_seg", "open_i", "ps")
    most = scan.longest(layout)
    if most <= 1:
        return _as_text_chunk(short_chunks)

    block = block or max(2, min(scan.BLOCK, SCAN_BYTES // (12 * (max_tokens + 1))))
    long = pieced.where("n_segs > 1")
    entered = long.join(_entries(long, max_tokens, block, scan.levels_for(most, block)), ["input_hash", "seg"])
    long_chunks = (
        _parts(entered.withColumn("cuts", _cuts(max_tokens)))
        .groupBy("input_hash", "filename", "open_seg", "open_i")
        .agg(F.expr(f"flatten(transform({_IN_ORDER.format(rows='collect_list(struct(seg, ps))')}, x -> x.ps)) AS ps"))
    )
    return _as_text_chunk(short_chunks.unionByName(long_chunks))


def _as_text_chunk(parts: DataFrame) -> DataFrame:
    none = F.array().cast(schemas.STRINGS)
    made = parts.selectExpr(
        "filename",
        "input_hash",
        "array_sort(array_distinct(flatten(transform(ps, p -> p.page_nos)))) AS pages",
        "array_distinct(transform(ps, p -> p.ref)) AS doc_refs",
        "ps[0].headings AS headings",
        "array_join(transform(ps, p -> p.text), '\n') AS text",
        # A key that is the same on every run: where the chunk begins.
        "md5(concat_ws('/', input_hash, 'text', ps[0].ref, ps[0].part)) AS id",
    )
    return made.select(
        "filename",
        "input_hash",
        "pages",
        "doc_refs",
        F.lit(False).alias("has_table"),
        F.lit(False).alias("has_picture"),
        none.alias("tables"),
        none.alias("pictures"),
        "headings",
        F.lit(None).cast(schemas.STRINGS).alias("captions"),
        F.lit("text").alias("chunk_type"),
        F.lit("").alias("image_path"),
        "text",
        templates.fill(
            templates.BODY_TEXT,
            headings=templates.listed(F.col("headings")),
            captions=F.lit(""),
            text=F.col("text"),
        ).alias("enriched_text"),
        "id",
    )


def _element_id(kind: str, ref: Column) -> Column:
    return F.md5(F.concat_ws("/", "input_hash", F.lit(kind), ref))


# --- table and picture chunks ----------------------------------------------------------


def _owners(layout: DataFrame, kind: str) -> DataFrame:
    """Items of one kind, one row each; nothing else of the layout leaves its row."""
    mine = F.filter("items", lambda it: it.label == kind)
    return layout.select("input_hash", "filename", F.inline(mine))


def _captioned(layout: DataFrame, kind: str) -> DataFrame:
    """Items of one kind with ``caption``: their caption texts, in the order of the references.

    A document of one segment holds its captions in its own row. Only longer
    ones look them up across segments.
    """
    short = layout.where(F.col("n_segs") == 1)
    # A reference met twice stands for both texts, as in the join of longer documents.
    told = F.filter("items", lambda it: it.label == "caption")
    near = (
        short.withColumn("_told", F.transform(told, lambda it: F.struct(it.ref.alias("k"), it.text.alias("v"))))
        .select("input_hash", "filename", "_told", F.inline(F.filter("items", lambda it: it.label == kind)))
        .withColumn(
            "caption",
            F.array_join(
                F.flatten(
                    F.transform("caption_refs", lambda r: F.transform(F.filter("_told", lambda c: c.k == r), lambda c: c.v))
                ),
                "",
            ),
        )
        .drop("_told")
    )
    long = layout.where(F.col("n_segs") > 1)
    far = _owners(long, kind)
    return near.unionByName(far.join(caption_texts(long, far), ["input_hash", "ref"], "left"))


def caption_texts(layout: DataFrame, owners: DataFrame) -> DataFrame:
    """Caption text of each owner by joining its references to the caption items."""
    wanted = owners.select("input_hash", "ref", F.posexplode("caption_refs").alias("_pos", "_cap"))
    named = _owners(layout, "caption").select("input_hash", F.col("ref").alias("_cap"), F.col("text").alias("_text"))
    return (
        wanted.join(named, ["input_hash", "_cap"])
        .groupBy("input_hash", "ref")
        .agg(F.array_sort(F.collect_list(F.struct("_pos", "_text"))).alias("_caps"))
        .select("input_hash", "ref", F.array_join(F.transform("_caps", lambda c: c._text), "").alias("caption"))
    )


def _with_image(chunks: DataFrame, images: DataFrame | None, kind: str, ref: Column) -> DataFrame:
    """Add the image path, empty where there is no image."""
    if images is None:
        return chunks.withColumn("image_path", F.lit(""))
    found = images.where(F.col("kind") == kind).select("input_hash", F.col("ref").alias("_ref"), "path")
    return (
        chunks.withColumn("_ref", ref)
        .join(found, ["input_hash", "_ref"], "left")
        .withColumn("image_path", F.coalesce("path", F.lit("")))
        .drop("path", "_ref")
    )


def _element_chunks(layout: DataFrame, images: DataFrame | None, kind: str, text: Column, template: str) -> DataFrame:
    placed = _with_image(_captioned(layout, kind), images, kind + "s", refs.ref_tail(F.col("ref")))
    none = F.array().cast(schemas.STRINGS)
    own = F.array(refs.ref_tail(F.col("ref")))
    made = placed.select(
        "filename",
        "input_hash",
        refs.unique_pages(F.col("page_nos")).alias("pages"),
        F.concat(F.array("ref"), "children").alias("doc_refs"),
        (own if kind == "table" else none).alias("tables"),
        (own if kind == "picture" else none).alias("pictures"),
        none.alias("headings"),
        F.array(F.coalesce("caption", F.lit(""))).alias("captions"),
        F.lit(kind).alias("chunk_type"),
        "image_path",
        text.alias("text"),
        _element_id(kind, F.col("ref")).alias("id"),
    )
    return made.select(
        *["filename", "input_hash", "pages", "doc_refs"],
        refs.not_empty(F.col("tables")).alias("has_table"),
        refs.not_empty(F.col("pictures")).alias("has_picture"),
        *["tables", "pictures", "headings", "captions", "chunk_type", "image_path", "text"],
        templates.fill(template, captions=templates.listed(F.col("captions")), text=F.col("text")).alias("enriched_text"),
        "id",
    )


def table_chunks(layout: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """One chunk per table; its text is the table as Markdown."""
    return _element_chunks(layout, images, "table", F.col("text"), templates.TABLE_TEXT)


def picture_chunks(layout: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """One chunk per picture; its text is the descriptions among the annotations."""
    described = F.array_join(
        F.transform(F.filter("annotations", lambda a: a.kind == "description"), lambda a: a.text), ", "
    )
    return _element_chunks(layout, images, "picture", described, templates.PICTURE_TEXT)


# --- page chunks -----------------------------------------------------------------------


def page_table(layout: DataFrame) -> DataFrame:
    """One row per page: references in reading order, distinct headings and captions, and the texts.

    An item counts for its first page. A document without any page gets page 0,
    with nothing on it.
    """
    paged = F.filter("items", lambda it: F.size(it.page_nos) > 0)
    bare = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.item])
    listed = layout.select(
        "input_hash",
        "filename",
        F.inline(F.when((F.size(paged) == 0) & (F.col("n_segs") == 1), F.array(bare)).otherwise(paged)),
    ).select("input_hash", "filename", F.coalesce(F.get("page_nos", F.lit(0)), F.lit(0)).alias("page"), "seq", "ref", "label", "text")
    # A long document may have segments without a page, so it has none only if no segment has one.
    long_bare = (
        layout.where(F.col("n_segs") > 1)
        .groupBy("input_hash", "filename")
        .agg(F.max(F.size(paged)).alias("_n"))
        .where(F.col("_n") == 0)
        .select("input_hash", "filename", F.lit(0).alias("page"), *[
            F.lit(None).cast(schemas.item[c].dataType).alias(c) for c in ("seq", "ref", "label", "text")
        ])
    )
    on_page = F.when(F.col("ref").isNotNull(), F.struct("seq", "ref", "text"))
    rows = listed.unionByName(long_bare).groupBy("input_hash", "filename", "page").agg(
        F.array_sort(F.collect_list(on_page)).alias("_rows"),
        F.array_sort(F.collect_set(F.when(F.col("label").isin(HEADERS), F.col("text")))).alias("headings"),
        F.array_sort(F.collect_set(F.when(F.col("label") == "caption", F.col("text")))).alias("captions"),
    )
    return rows.select(
        "input_hash",
        "filename",
        "page",
        F.transform("_rows", lambda r: r.ref).alias("doc_refs"),
        "headings",
        "captions",
        F.array_join(F.transform("_rows", lambda r: r.text), "\n").alias("payload"),
    )


def with_descriptions(pages: DataFrame, descriptions: DataFrame) -> DataFrame:
    """The page table with descriptions kept elsewhere; a page without one reads empty."""
    found = descriptions.select("input_hash", "page", "description")
    return pages.join(found, ["input_hash", "page"], "left").withColumn(
        "description", F.coalesce("description", F.lit(""))
    )


def page_chunks(described: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """One chunk per row of a described page table; its text is the description."""
    placed = _with_image(described, images, "pages", F.col("page").cast("string"))
    made = placed.select(
        "filename",
        "input_hash",
        F.array("page").alias("pages"),
        "doc_refs",
        refs.tails_under(F.col("doc_refs"), "tables").alias("tables"),
        refs.tails_under(F.col("doc_refs"), "pictures").alias("pictures"),
        "headings",
        "captions",
        F.lit("page").alias("chunk_type"),
        "image_path",
        F.col("description").alias("text"),
        _element_id("page", F.col("page").cast("string")).alias("id"),
    )
    return made.select(
        *["filename", "input_hash", "pages", "doc_refs"],
        refs.not_empty(F.col("tables")).alias("has_table"),
        refs.not_empty(F.col("pictures")).alias("has_picture"),
        *["tables", "pictures", "headings", "captions", "chunk_type", "image_path", "text"],
        templates.fill(
            templates.PAGE_TEXT, headings=templates.listed(F.col("headings")), text=F.col("text")
        ).alias("enriched_text"),
        "id",
    )


# --- all kinds ---------------------------------------------------------------------------


def all_chunks(
    layout: DataFrame,
    described: DataFrame,
    images: DataFrame | None = None,
    max_tokens: int = DEFAULT_MAX_TOKENS,
) -> DataFrame:
    """The chunk table: text, picture, table and page chunks of all documents.

    Give it a stored layout: it is read once for each kind of chunk.
    """
    return (
        text_chunks(layout, max_tokens)
        .unionByName(picture_chunks(layout, images))
        .unionByName(table_chunks(layout, images))
        .unionByName(page_chunks(described, images))
    )


def in_output_order(chunks: DataFrame) -> DataFrame:
    """Order at the sink: by kind, then by document."""
    rank = F.array_position(F.array(*[F.lit(t) for t in TYPE_ORDER]), F.col("chunk_type"))
    return chunks.orderBy(rank, "input_hash", "id")
