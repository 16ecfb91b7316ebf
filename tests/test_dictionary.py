"""Stems by a table of words give what stems in each row give, with one call for each distinct word."""

from pyspark.sql import functions as F

from vellumflow.functions.porter import porter_stem
from vellumflow.operators import dictionary
from vellumflow.operators import highlight as by_row

ROWS = [
    (1, "Running runs; the RUNNER ran", "run"),
    (2, "no words of it", "running tests"),
    (3, None, "run"),
    (4, "tests tested testing", None),
    (5, "", "test"),
    (6, "Études étude of running", "étude run"),
    (7, "tests tested testing", "tester tests"),
]


def counted(folder):
    def stem(word):
        open(f"{folder}/calls", "a").write(word + "\n")
        return porter_stem(word)

    return stem


def test_same_marks_as_row_by_row(spark, tmp_path):
    rows = spark.createDataFrame(ROWS, "id int, t string, q string").repartition(3)
    stems = dictionary.stem_table(rows, ["t", "q"], counted(tmp_path))
    made = {r["id"]: r["highlighted"] for r in dictionary.highlight(rows, "id", "t", "q", stems).collect()}
    want = {r["id"]: r["highlighted"] for r in by_row.highlight(rows, "t", "q").collect()}
    assert made == want and "<mark>" in made[1]
    calls = open(tmp_path / "calls").read().split("\n")[:-1]
    assert len(calls) == len(set(calls)) == stems.count()


def test_no_rows_and_no_words(spark, tmp_path):
    none = spark.createDataFrame([], "id int, t string, q string")
    assert dictionary.highlight(none, "id", "t", "q", dictionary.stem_table(none, ["t", "q"])).count() == 0
    blank = spark.createDataFrame([(1, "!!", "??"), (2, None, None)], "id int, t string, q string")
    made = dictionary.highlight(blank, "id", "t", "q", dictionary.stem_table(blank, ["t", "q"])).orderBy("id").collect()
    assert [r["highlighted"] for r in made] == ["!!", None]


def test_whole_table_as_row_by_row(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", F.substring("text", 5, 60).alias("asked"))
    stems = dictionary.stem_table(docs, ["text", "asked"])
    made = dictionary.highlight(docs, "doc_id", "text", "asked", stems)
    assert sorted(made.select("doc_id", "highlighted").collect(), key=repr) == sorted(by_row.highlight(docs, "text", "asked").select("doc_id", "highlighted").collect(), key=repr)


def test_each_text_is_cut_once(spark, tmp_path):
    rows = spark.createDataFrame(ROWS, "id int, t string, q string").repartition(3)

    @F.udf("string")
    def seen(text):
        open(f"{tmp_path}/texts", "a").write(f"{text!r}\n")
        return text

    kept = dictionary.with_words(rows.withColumn("t", seen.asNondeterministic()("t")), ["t", "q"])
    made = dictionary.highlight(kept, "id", "t", "q", dictionary.stem_table(kept, ["t", "q"]))
    want = by_row.highlight(rows, "t", "q")
    assert made.columns == want.columns and sorted(made.collect(), key=lambda r: r.id) == sorted(want.collect(), key=lambda r: r.id)
    assert len(open(f"{tmp_path}/texts").read().split("\n")) == len(ROWS) + 1
