import os

import pytest
from pyspark.sql import functions as F

from layouts import DOCS, layout
from vellumflow import schemas
from vellumflow.operators import chunking
from vellumflow.session import new_folder
from vellumflow.sources import drivers, files, store
from vellumflow.sources.html_layout import html_layout, read_html, register_html_items
from vellumflow.sources.text_layout import flat_items


def test_driver_list(spark, tmp_path):
    path = tmp_path / "list.csv"
    path.write_text("document_name,document_url\nb,https://x.org/$FILE/a/b.pdf\nc,https://x.org/c\n")
    rows = drivers.read_driver_list(spark, str(path))
    assert rows.schema == schemas.driver_list
    assert rows.first().document_url == "https://x.org/$FILE/a/b.pdf"


def test_fetch_and_land(spark, tmp_path):
    def fetcher():
        def fetch(url):
            if url == "boom":
                raise OSError("unreachable")
            return (200, url.encode()) if url.startswith("ok") else (404, b"not found")

        return fetch

    docs = spark.createDataFrame([("a", "ok-1"), ("b", "gone"), ("c", "boom")], schemas.driver_list)
    got = drivers.fetch_bytes(docs, fetcher, tasks=2)
    folder = str(tmp_path / "bronze")
    landed = drivers.write_files(got, drivers.landing_path(folder, F.col("document_name")), F.col("bytes"))
    rows = {r.document_name: (r.status, r.downloaded, r.error) for r in landed.collect()}
    assert rows == {"a": (200, True, None), "b": (404, False, None), "c": (None, False, "OSError: unreachable")}
    assert os.listdir(folder) == ["a.pdf"] and open(f"{folder}/a.pdf").read() == "ok-1"


def test_folder_scan(spark, tmp_path):
    for name in ("a.pdf", "b.docx", "c.txt", "D.PDF", "sub/e.pdf"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(name.encode())
    rows = {r.filename: r for r in files.scan_folder(spark, str(tmp_path)).collect()}
    assert set(rows) == {"a.pdf", "b.docx"}
    assert rows["a.pdf"].path == str(tmp_path / "a.pdf")
    assert rows["a.pdf"].input_hash == spark.range(1).select(F.md5(F.lit(str(tmp_path / "a.pdf")))).first()[0]


def test_images_are_saved_scanned_and_joined(spark, tmp_path):
    images = spark.createDataFrame(
        [("h", "pages", "1", None, b"one"), ("h", "tables", "0", None, None)], schemas.images
    )
    located = store.save_images(images, str(tmp_path)).collect()
    assert [(r.kind, r.path) for r in located] == [("pages", f"{tmp_path}/h/pages/1.webp")]
    found = files.scan_images(spark, str(tmp_path))
    rows = spark.createDataFrame([(1, located[0].path), (2, ""), (3, "/absent.webp")], "id int, image_path string")
    lenient = {r.id: r.image for r in files.with_images(rows, found).collect()}
    assert lenient == {1: b"one", 2: None, 3: None}
    with pytest.raises(Exception, match="image not found: /absent.webp"):
        files.with_images(rows, found, strict=True).collect()


def test_single_value(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k int, v string")
    assert files.single_value(rows, "v", "k = 1").first().v == "a"
    assert files.single_value(rows, "v").count() == 1
    for condition in ("k = 2", "k = 3"):
        with pytest.raises(Exception, match="expected one row"):
            files.single_value(rows, "v", condition).collect()
    with pytest.raises(Exception, match="more than one row for 2"):
        files.single_values(rows, "k", "v").collect()


def test_html_reading():
    page = """<head><title>x</title></head><body><nav><p>menu</p></nav><h1>Top &amp; more</h1><p>one<br>two
      <p>three</p><h2>Sub</h2><ul><li>item</li></ul><div class="box ad"><div>buy</div><p>now</p></div>
      <figure><img src=a.png alt="a pump"><figcaption>Fig 1</figcaption></figure>
      <table><caption>Sizes</caption><tr><th>a<th>b</tr><tr><td>1<td>2</table><footer>end</footer>"""
    items = read_html(page)
    assert [(i["label"], i["text"]) for i in items] == [
        ("title", "Top & more"), ("text", "one two"), ("text", "three"), ("section_header", "Sub"), ("list_item", "item"),
        ("picture", "a pump"), ("caption", "Fig 1"), ("table", "| a | b |\n| --- | --- |\n| 1 | 2 |"), ("caption", "Sizes"),
    ]
    by_label = {i["label"]: i for i in items}
    assert by_label["picture"]["caption_refs"] == ["#/texts/5"]
    assert by_label["table"]["caption_refs"] == ["#/texts/6"]
    assert by_label["list_item"]["headings"] == ["Top & more", "Sub"]


def test_html_layout_in_segments(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    whole = html_layout(pages, F.md5("url"), F.col("url"))
    cut = html_layout(pages, F.md5("url"), F.col("url"), segment_items=3)
    assert sorted(flat_items(whole).collect()) == sorted(flat_items(cut).collect())
    one, two = (chunking.text_chunks(x, 60).select("id", "text", "doc_refs") for x in (whole, cut))
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def test_html_items_in_sql(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    pages.createOrReplaceTempView("pages_for_sql")
    register_html_items(spark)
    got = spark.sql("SELECT url AS input_hash, i.seq, i.label, i.text FROM pages_for_sql, LATERAL html_items(html) i")
    want = flat_items(html_layout(pages, F.col("url"), F.col("url"))).select("input_hash", "seq", "label", "text")
    assert sorted(got.collect()) == sorted(want.collect())


def test_stored_conversions(spark, tmp_path):
    laid = layout(spark, DOCS)
    path = str(tmp_path / "layout")
    store.save_layout(laid.where("input_hash in ('A', 'B')"), path)
    docs = laid.select("input_hash").distinct()
    stored = store.load_layout(spark, path)
    assert {r[0] for r in store.pending(docs, stored).collect()} == {"C", "D", "E", "F"}
    assert {r[0] for r in store.reused(docs, stored).collect()} == {"A", "B"}
    assert store.pending(docs, stored, overwrite=True).count() == 6 and store.reused(docs, stored, overwrite=True).isEmpty()
    assert store.load_layout(spark, path, docs.where("input_hash = 'B'")).count() == 1
    store.save_layout(laid, path + "-json", form="json")
    assert store.load_layout(spark, path + "-json", form="json").count() == laid.count()
    assert sorted(flat_items(stored).collect()) == sorted(flat_items(laid.where("input_hash in ('A', 'B')")).collect())


def test_markdown(spark):
    whole = {r.input_hash: r.markdown for r in store.markdown(layout(spark, DOCS)).collect()}
    cut = {r.input_hash: r.markdown for r in store.markdown(layout(spark, DOCS, 2)).collect()}
    assert whole == cut
    assert whole["B"] == "spread\n\n| t |" and whole["A"].startswith("# Guide\n\none two three")


def test_tables_may_grow(spark, tmp_path):
    path = str(tmp_path / "bronze")
    spark.createDataFrame([(1,)], "a int").write.parquet(path)
    spark.createDataFrame([(2, "x")], "a int, b string").write.mode("append").parquet(path)
    assert set(store.read_bronze(spark, path).columns) == {"a", "b"}
    store.write_bronze(spark.createDataFrame([(3, "y")], "a int, b string"), path)
    assert store.read_bronze(spark, path).collect() == [(3, "y")]


def test_chunk_table_scan_reads_only_synced_columns(spark, capsys):
    chunks = chunking.text_chunks(layout(spark, DOCS))
    store.write_chunks(chunks, "chunks_for_scan")
    store.scan_chunks(spark.table("chunks_for_scan")).explain("formatted")
    schema = next(line for line in capsys.readouterr().out.splitlines() if line.startswith("ReadSchema"))
    assert "enriched_text" in schema and "doc_refs" not in schema


def test_metadata(spark):
    rows = spark.createDataFrame([(1, {"a": "1"}), (2, None)], "id int, metadata map<string,string>")
    added = store.add_metadata(store.add_metadata(rows, "a", F.lit(5)), "b", F.col("id"))
    got = {r.id: (r.a, r.b, r.c) for r in store.get_metadata(store.get_metadata(store.get_metadata(added, "a", "a"), "b", "b"), "c", "c").collect()}
    assert got == {1: ("5", "1", None), 2: ("5", "2", None)}


def test_new_folders_differ(spark):
    assert new_folder(spark, "x") != new_folder(spark, "x")


LOSSY = [
    ("<div>bare</div>", ["bare"]),
    ("<blockquote>q</blockquote><dl><dt>t<dd>d</dl><article>a<section>s</section>b</article>", ["q", "t", "d", "a", "s", "b"]),
    ("<p>before <img alt=pic> after</p>", ["before", "pic", "after"]),
    ("<ul><li>a<ul><li>b</ul>c</ul>", ["a", "b", "c"]),
    ("<head><title>no</title><body><p>yes", ["yes"]),
    ("<div><p class=ad>buy</div><p>kept</p>", ["kept"]),
    ("<div><nav>menu<a>x</a></div>text", ["text"]),
    ("<table><tr><td>o<table><tr><td>in</table>p</td></tr></table>", ["| o p |\n| --- |", "| in |\n| --- |"]),
    ("<table><tr><td>a<br>b</td></tr></table>", ["| a b |\n| --- |"]),
    ("<pre>x\n  y\n</pre>", ["x\n  y"]),
    ("<p>one<p>two<div>three", ["one", "two", "three"]),
    ("<figure><figcaption>cap</figcaption><img alt=z></figure>", ["cap", "z"]),
]


@pytest.mark.parametrize("page,want", LOSSY)
def test_html_keeps_all_text(page, want):
    assert [i["text"] for i in read_html(page)] == want


def test_html_words_are_all_in_items():
    import random
    import re

    rng, tags = random.Random(5), "p div li ul table tr td b img figure figcaption h2 blockquote caption pre section dl dd".split()
    for _ in range(300):
        parts, word = [], 0
        for _ in range(rng.randrange(30)):
            if rng.random() < 0.4:
                parts.append(f" w{word} ")
                word += 1
            else:
                parts.append(f"<{rng.choice(['', '/'])}{rng.choice(tags)}>")
        page = "".join(parts)
        found = sorted(re.findall(r"w\d+", " ".join(i["text"] for i in read_html(page))))
        assert found == sorted(f"w{i}" for i in range(word)), page


def test_furniture_classes_are_a_parameter():
    page = "<p class=ad>a</p><p class=menu>b</p>"
    assert [i["text"] for i in read_html(page, frozenset({"menu"}))] == ["a"]


def test_captions_of_figures_and_tables():
    items = read_html("<figure><img alt=x><figcaption>one</figcaption></figure><table><caption>two</caption><tr><td>c</table>")
    refs = {i["text"]: i["ref"] for i in items}
    assert items[0]["caption_refs"] == [refs["one"]]
    assert next(i for i in items if i["label"] == "table")["caption_refs"] == [refs["two"]]


def test_items_of_many_pages_leave_in_bounded_batches():
    import pyarrow as pa

    from vellumflow.sources import html_layout as module

    page = "<h1>Head</h1>" + "<p>Some text</p>" * 9
    batch = pa.RecordBatch.from_pydict({"input_hash": [str(i) for i in range(3000)], "filename": ["a"] * 3000, "html": [page] * 2999 + [None]})
    found = list(module._layout_rows(iter([batch]), module.read_html, module.SEGMENT_ITEMS))
    items = [sum(len(row) for row in b.column("items").to_pylist()) for b in found]
    assert sum(items) == 29990 and max(items) <= module.HELD_ITEMS and sum(b.num_rows for b in found) == 3000
