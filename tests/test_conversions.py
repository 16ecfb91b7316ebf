"""Conversions that are kept: what is stored is read again, what is new is converted, what is replaced is gone."""

from pyspark.sql import functions as F

from vellumflow.sources import conversions
from vellumflow.sources.text_layout import text_layout


def batch(spark, rows):
    return spark.createDataFrame(rows, "input_hash string, filename string, text string")


def counting(spark, prefix=""):
    """A converter and the hashes it was given."""
    seen = []

    def convert(docs):
        seen.append(sorted(r[0] for r in docs.select("input_hash").collect()))
        return text_layout(docs.withColumn("text", F.concat(F.lit(prefix), "text")), F.col("input_hash"), F.col("filename"))

    return convert, seen


def found(layout):
    return sorted((r["input_hash"], r["filename"], " ".join(i["text"] for i in r["items"])) for r in layout.collect())


def test_only_new_documents_are_converted(spark, tmp_path):
    path = str(tmp_path / "layout")
    convert, seen = counting(spark)
    first = batch(spark, [("a", "a.txt", "one"), ("b", "b.txt", "two")])
    assert found(conversions.convert_or_load(first, path, convert)) == [("a", "a.txt", "one"), ("b", "b.txt", "two")]
    second = batch(spark, [("b", "other.txt", "two"), ("c", "c.txt", "three")])
    assert found(conversions.convert_or_load(second, path, convert)) == [("b", "b.txt", "two"), ("c", "c.txt", "three")]
    assert found(conversions.convert_or_load(second, path, convert)) == [("b", "b.txt", "two"), ("c", "c.txt", "three")]
    assert seen == [["a", "b"], ["c"], []]
    assert conversions.stored_layout(spark, path).count() == 3


def test_overwriting_replaces_only_its_documents(spark, tmp_path):
    path = str(tmp_path / "layout")
    many = [(f"h{i}", f"{i}.txt", f"text {i}") for i in range(200)]
    conversions.convert_or_load(batch(spark, many), path, counting(spark)[0])
    convert, seen = counting(spark, "new ")
    again = conversions.convert_or_load(batch(spark, many[:70]), path, convert, overwrite=True)
    assert found(again) == sorted((h, f, "new " + t) for h, f, t in many[:70]) and len(seen[0]) == 70
    everything = conversions.stored_layout(spark, path).drop("bucket")
    assert found(everything) == sorted((h, f, ("new " if i < 70 else "") + t) for i, (h, f, t) in enumerate(many))


def test_repeated_null_and_no_documents(spark, tmp_path):
    path = str(tmp_path / "layout")
    convert, seen = counting(spark)
    assert conversions.convert_or_load(batch(spark, []), path, convert).count() == 0
    odd = batch(spark, [("a", "z.txt", "one"), ("a", "b.txt", "one"), ("a", "b.txt", "one"), (None, "n.txt", "none"), ("e", None, "two")])
    assert found(conversions.convert_or_load(odd, path, convert))[0] == ("a", "b.txt", "one")
    assert seen[-1] == ["a", "e"]
    assert conversions.stored_layout(spark, path).where("input_hash = 'a'").count() == 1


def test_new_layout_is_made_once_and_moved_once(spark, tmp_path, monkeypatch):
    """No copy of it is kept beside the table."""
    kept = []
    settled = conversions.settled
    monkeypatch.setattr(conversions, "settled", lambda df: kept.append(df.columns) or settled(df))
    convert, _ = counting(spark)
    path = str(tmp_path / "layout")
    many = [(f"h{i}", f"{i}.txt", f"text {i}") for i in range(100)]
    assert len(found(conversions.convert_or_load(batch(spark, many), path, convert))) == 100
    assert kept == [["input_hash"]]
    assert conversions.convert_or_load(batch(spark, []), str(tmp_path / "none"), convert).count() == 0
    assert not (tmp_path / "none").exists()
