from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
import re

from vellumflow.functions import refs, templates, text
from vellumflow.functions.porter import porter_stem
from vellumflow.operators.highlight import highlight


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column.alias("r")).first().r


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8", exclude_characters="\x00"), max_size=40), min_size=1, max_size=20))
def test_tokens_join_back(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "v string").select("v", F.array_join(text.tokens(F.col("v")), "").alias("r"))
    assert all(r.v == r.r for r in rows.collect())


def test_tokens_follow_the_unicode_rule(spark):
    sample = "Étude 2 – l'été_x,  no break\tend… ½ ٣"
    assert one(spark, sample, text.tokens(F.col("v"))) == re.findall(r"\b\w+\b|[^\w\s]|\s+", sample)


def test_clean(spark):
    sample = " Über\n\nc'est  50% — ok now\x1fend "
    want = " ".join(re.sub(r"[^a-zA-Z0-9\s]", "", sample.replace("\n", " ")).split())
    assert one(spark, sample, text.clean(F.col("v"))) == want


def test_stems():
    # Published examples.
    known = {
        "caresses": "caress", "ponies": "poni", "ties": "tie", "agreed": "agre", "plastered": "plaster", "motoring": "motor",
        "conflated": "conflat", "hopping": "hop", "falling": "fall", "filing": "file", "happy": "happi", "sky": "sky",
        "relational": "relat", "digitizer": "digit", "vietnamization": "vietnam", "operator": "oper", "hopefulness": "hope",
        "triplicate": "triplic", "electrical": "electr", "goodness": "good", "adoption": "adopt", "probate": "probat",
        "controll": "control", "dying": "die", "spied": "spi", "died": "die", "enjoy": "enjoy", "maintenance": "mainten",
    }
    assert {w: porter_stem(w) for w in known} == known


def test_highlight(spark):
    rows = spark.createDataFrame(
        [
            (1, "Running pumps ran; the PUMP_1 pumped.", "pump running"),
            (2, "", "x"),
            (3, "words here", ""),
            (4, "?! ...", "?"),
            (5, "Élan  élans", "élan"),
            (6, None, "x"),
            (7, "no question", None),
        ],
        "id int, text string, query string",
    )
    got = {r.id: r.highlighted for r in highlight(rows, "text", "query").collect()}
    assert got[1] == "<mark>Running</mark> <mark>pumps</mark> ran; the PUMP_1 <mark>pumped</mark>."
    assert (got[2], got[3], got[4], got[6], got[7]) == ("", "words here", "?! ...", None, "no question")
    assert got[5] == "<mark>Élan</mark>  <mark>élans</mark>"


def test_highlight_changes_nothing_else(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("query", F.lit("the of and leaux"))
    done = highlight(docs, "text", "query")
    bare = F.replace(F.replace("highlighted", F.lit("<mark>"), F.lit("")), F.lit("</mark>"), F.lit(""))
    assert done.where(bare != F.col("text")).isEmpty()
    assert not done.where(F.contains("highlighted", F.lit("<mark>"))).isEmpty()


def test_paths_and_urls(spark):
    assert one(spark, "file:/a/b.pdf", refs.path_key(F.col("v"))) == one(spark, "/a/b.pdf", F.md5("v"))
    assert one(spark, "file:///a/b.pdf", refs.path_key(F.col("v"))) == one(spark, "/a/b.pdf", F.md5("v"))
    assert one(spark, "#/tables/12", refs.ref_tail(F.col("v"))) == "12"
    url = one(spark, bytearray(b"x" * 200), refs.data_url(F.col("v"), F.lit("image/png")), "binary")
    assert url.startswith("data:image/png;base64,eHh4") and "\n" not in url and "\r" not in url


def test_image_request(spark):
    import pytest

    assert one(spark, "page", templates.image_request(F.col("v"), F.lit(200))) == (
        "Describe the contents of this page. Keep the response within 200 words"
    )
    with pytest.raises(Exception, match="not a describable image type"):
        one(spark, "video", templates.image_request(F.col("v"), F.lit(200)))
