import json

from pyspark.sql import functions as F

from layouts import DOCS, layout
from vellumflow.functions import stubs
from vellumflow.operators import chunking, enrich
from vellumflow.operators.models import RateLimited, Retry, model_reply
from vellumflow.sources.text_layout import flat_items, nested_items


def test_failed_calls_give_empty_texts_and_an_error(spark):
    def picky():
        def call(texts):
            if any("bad" in t for t in texts):
                raise ValueError("no")
            return [t.upper() for t in texts]

        return call

    rows = spark.createDataFrame([(1, "good"), (2, "bad"), (3, None), (4, "fine")], "id int, t string").coalesce(1)
    got = {r.id: (r.r.text, r.r.error) for r in rows.select("id", model_reply(F.col("t"), picky).alias("r")).collect()}
    assert got == {1: ("GOOD", None), 2: ("", "ValueError: no"), 3: (None, None), 4: ("FINE", None)}


def test_rate_limits_are_waited_out():
    waits, left = [], [3]

    def model(texts):
        if left[0]:
            left[0] -= 1
            raise RateLimited()
        return texts

    assert Retry(attempts=5, first_wait=0.5, sleep=waits.append).call(model, ["x"]) == ["x"]
    assert waits == [0.5, 1.0, 2.0]


def test_pictures_get_descriptions_and_classes(spark):
    docs = layout(spark, DOCS)
    pictures = {
        (r.input_hash, r.ref): r.annotations
        for r in flat_items(enrich.classify_pictures(enrich.describe_pictures(docs, stubs.size_describer, "m")))
        .where("label = 'picture'")
        .collect()
    }
    notes = pictures["D", "#/pictures/1"]
    assert [(n.kind, n.provenance) for n in notes] == [("description", "m"), ("classification", "example_classifier-0.0.1")]
    assert notes[1].predicted_classes[0].class_name == "dummy" and notes[1].predicted_classes[0].confidence == 0.42
    assert len(pictures["D", "#/pictures/0"]) == 4


def test_without_a_model_nothing_is_described(spark):
    docs = layout(spark, DOCS)
    assert enrich.describe_pictures(docs, None, "m") is docs
    assert enrich.describe_tables(docs, stubs.size_describer, enabled=False) is docs
    empty = enrich.describe_pages(chunking.page_table(docs), None, "m")
    assert {r.description for r in empty.collect()} == {"", "No pages in document"}
    assert enrich.describe_pages(chunking.page_table(docs), stubs.size_describer, "m", enabled=False).isEmpty()


def test_a_classifier_may_be_plugged_in(spark):
    def clf():
        return lambda texts: [json.dumps([{"class_name": "chart", "confidence": 0.9}]) for _ in texts]

    docs = enrich.classify_pictures(layout(spark, DOCS), clf, "mine")
    found = flat_items(docs).where("label = 'picture' and input_hash = 'A'").first().annotations[-1]
    assert (found.provenance, found.predicted_classes[0].class_name) == ("mine", "chart")


def test_table_descriptions_become_captions(spark):
    docs = enrich.describe_tables(layout(spark, DOCS), stubs.size_describer)
    chunks = {r.input_hash: r for r in chunking.table_chunks(docs).collect()}
    assert chunks["A"].captions == ["Sizes11 characters in 2 lines"]
    assert chunks["D"].captions == ["5 characters in 1 lines"]
    added = flat_items(docs).where("input_hash = 'B' and label = 'caption'").first()
    assert added.page_nos == [1]
    # Added items stay with their segment when the layout is nested again.
    again = chunking.table_chunks(nested_items(flat_items(docs), 3))
    assert {r.input_hash: r.captions for r in again.collect()} == {k: r.captions for k, r in chunks.items()}


def test_headings_cross_buckets(spark):
    items = flat_items(layout(spark, DOCS)).where("input_hash in ('A', 'F')")
    got = {(r.input_hash, r.seq): r.heading for r in enrich.heading_in_force(items, bucket=2).collect()}
    assert [got["A", i] for i in range(9)] == ["Guide"] * 3 + ["Setup"] * 6
    assert [got["F", i] for i in range(4)] == ["Zeta", "Alpha", "Zeta", "Zeta"]
