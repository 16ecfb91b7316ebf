import random

import pytest
from pyspark.sql import functions as F

from layouts import DOCS, item, layout
from vellumflow import schemas
from vellumflow.functions import stubs
from vellumflow.operators import chunking, enrich
from vellumflow.sources.text_layout import flat_items, nested_items, text_layout


def rows(df, *keys):
    return sorted((r.asDict(True) for r in df.collect()), key=lambda r: tuple(str(r[k]) for k in keys))


@pytest.fixture(scope="module")
def docs(spark):
    return layout(spark, DOCS).cache()


def texts(spark, docs, name, limit=4):
    found = rows(chunking.text_chunks(docs.where(F.col("input_hash") == name), limit), "doc_refs", "text")
    return sorted(r["text"] for r in found)


def test_columns_are_the_contract(docs):
    described = enrich.describe_pages(chunking.page_table(docs), stubs.size_describer, "m")
    chunks = chunking.all_chunks(docs, described)
    assert set(chunks.columns) == {*schemas.chunk.fieldNames(), "id"}
    for field in schemas.chunk:
        assert chunks.schema[field.name].dataType.simpleString() == field.dataType.simpleString()
    assert {r.chunk_type for r in chunks.select("chunk_type").distinct().collect()} == {"text", "table", "picture", "page"}
    assert chunks.count() == chunks.select("id").distinct().count()


def test_packing_rule(spark, docs):
    assert texts(spark, docs, "E") == sorted(["a b c d", "e f\ng h", "i j k l", "m n o p", "q r\ns", "t"])


def test_text_chunks_keep_headings_and_pages(spark, docs):
    found = rows(chunking.text_chunks(docs.where("input_hash = 'A'"), 100), "text")
    assert [(r["text"], r["headings"], r["pages"]) for r in found] == [
        ("one two three\nfour five", ["Guide"], [1]),
        ("six seven\neight", ["Guide", "Setup"], [2, 3]),
    ]
    assert found[0]["image_path"] == "" and found[0]["captions"] is None
    assert found[0]["enriched_text"] == (
        "\n            Headings:Guide\n\n            Captions:\n\n            Text:one two three\nfour five\n        "
    )


def test_pages_are_sorted_and_distinct(docs):
    found = rows(chunking.text_chunks(docs.where("input_hash = 'B'")), "text")
    assert found[0]["pages"] == [1, 2]


def test_table_chunk(docs):
    found = rows(chunking.table_chunks(docs), "input_hash")
    by_doc = {r["input_hash"]: r for r in found}
    assert by_doc["A"]["captions"] == ["Sizes"]
    assert by_doc["A"]["doc_refs"] == ["#/tables/0", "#/texts/90"]
    assert (by_doc["A"]["has_table"], by_doc["A"]["has_picture"], by_doc["A"]["tables"]) == (True, False, ["0"])
    assert by_doc["B"]["pages"] == [1, 2]
    assert by_doc["D"]["captions"] == [""]
    assert by_doc["A"]["enriched_text"] == (
        "\n                Captions:Sizes\n\n                Content:| a |\n| b |\n            "
    )


def test_picture_chunk(spark, docs):
    images = spark.createDataFrame([("D", "pictures", "1", "/out/D/pictures/1.webp")], "input_hash string, kind string, ref string, path string")
    found = rows(chunking.picture_chunks(docs, images), "input_hash", "pictures")
    assert [(r["input_hash"], r["text"], r["image_path"]) for r in found] == [
        ("A", "a pump", ""),
        ("D", "red, blue", ""),
        ("D", "", "/out/D/pictures/1.webp"),
        ("D", "", ""),
    ]


def test_page_chunks(docs):
    described = enrich.describe_pages(chunking.page_table(docs), stubs.size_describer, "m")
    found = {(r["input_hash"], r["pages"][0]): r for r in rows(chunking.page_chunks(described), "input_hash")}
    assert set(k for k in found if k[0] == "A") == {("A", 1), ("A", 2), ("A", 3)}
    two = found["A", 2]
    assert two["doc_refs"] == ["#/texts/3", "#/tables/0", "#/texts/5", "#/texts/6"]
    assert (two["tables"], two["headings"], two["captions"]) == (["0"], ["Setup"], ["Sizes"])
    assert found["B", 2]["doc_refs"] == ["#/texts/0"] and found["B", 1]["doc_refs"] == ["#/tables/0"]
    assert found["F", 1]["headings"] == ["Alpha", "Zeta"]
    bare = found["C", 0]
    assert bare["text"] == "No pages in document" and bare["doc_refs"] == [] and not bare["has_table"]
    assert found["A", 1]["enriched_text"].startswith("Headings:Guide\nPage Description:")


def test_segments_do_not_change_the_chunks(spark):
    """Whatever the cut of a document into segments, all kinds of chunk stay the same."""
    whole, cut = layout(spark, DOCS), layout(spark, DOCS, segment_items=2)
    assert cut.where("n_segs > 1").count() > 5
    for make in (
        lambda l: chunking.text_chunks(l, 4),
        chunking.table_chunks,
        chunking.picture_chunks,
        lambda l: chunking.page_chunks(enrich.describe_pages(chunking.page_table(l), stubs.size_describer, "m")),
    ):
        one, two = rows(make(whole), "id"), rows(make(cut), "id")
        assert one == two


def pack(counts, limit):
    """The rule, plainly: runs of (run, tokens) to lists of indexes."""
    out, open_n, open_run = [], None, None
    for i, (run, n) in enumerate(counts):
        if open_n is None or run != open_run or open_n + n > limit:
            out.append([i])
            open_n = n
        else:
            out[-1].append(i)
            open_n += n
        open_run = run
    return out


def test_packing_against_the_plain_rule(spark):
    random.seed(7)
    limit, made, expected = 9, [], {}
    for d in range(12):
        run, counts = -1, []
        for seq in range(random.randint(1, 60)):
            if random.random() < 0.1:
                run = seq
            counts.append((run, random.randint(1, limit)))
            words = " ".join(f"w{seq}" for _ in range(counts[-1][1]))
            made.append(item(f"doc{d}", seq, "text", words, run=run))
        expected[f"doc{d}"] = sorted([f"#/texts/{i}" for i in c] for c in pack(counts, limit))
    for segment_items, block in ((4096, None), (7, None), (1, 3)):
        chunks = chunking.text_chunks(layout(spark, made, segment_items), limit, block=block).collect()
        got = {}
        for c in chunks:
            got.setdefault(c.input_hash, []).append(list(c.doc_refs))
        assert {k: sorted(v) for k, v in got.items()} == expected


def test_text_layout_cut_and_whole(spark):
    text = "\n".join(["alpha beta"] * 7 + ["a | b", "c | d", "", "   ", "omega"] + ["| solo"])
    docs = spark.createDataFrame([("x", text), ("y", ""), ("z", None)], "name string, text string")
    make = lambda **k: text_layout(docs, F.md5("name"), F.col("name"), **k)
    whole, cut = flat_items(make()).collect(), flat_items(make(segment_items=3)).collect()
    assert sorted(whole) == sorted(cut)
    tables = [r.text for r in whole if r.label == "table"]
    assert sorted(tables) == ["a | b\nc | d", "| solo"]
    assert len([r for r in whole if r.label == "text"]) == 8


def test_nested_items_give_the_items_back(docs):
    items = flat_items(docs)
    assert sorted(map(str, flat_items(nested_items(items, 3)).collect())) == sorted(map(str, items.collect()))


def test_no_chunk_over_the_limit_and_no_item_lost(spark, sf_dir):
    from vellumflow.plans.common import document_layout

    laid = document_layout(spark, sf_dir)
    chunks = chunking.text_chunks(laid, 50)
    assert chunks.where(F.size(F.split(F.trim("text"), r"\s+")) > 50).isEmpty()
    body = flat_items(laid).where("label = 'text'").select("input_hash", "ref")
    kept = chunks.select("input_hash", F.explode("doc_refs").alias("ref"))
    assert body.join(kept, ["input_hash", "ref"], "left_anti").isEmpty()
