"""Files landed on paths with and without a scheme, with commit and abort."""

import os

import pytest
from pyspark.sql import functions as F

from vellumflow.sources import drivers, landing, store

SCHEMA = "name string, bytes binary"


def files(folder):
    return {os.path.relpath(os.path.join(at, n), folder): open(os.path.join(at, n), "rb").read() for at, _, names in os.walk(folder) for n in names if landing.LISTS not in at}


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_land(spark, tmp_path, scheme):
    folder = f"{scheme}{tmp_path}/landed"
    rows = [(f"a/{i}.bin", bytes([i]) * 10) for i in range(20)] + [("none", None), (None, b"x"), ("empty", b"")]
    landing.land(spark.createDataFrame(rows, SCHEMA).repartition(4), folder)
    want = {n: b for n, b in rows if n is not None and b is not None}
    assert files(f"{tmp_path}/landed") == want
    landing.land(spark.createDataFrame([("a/0.bin", b"again")], SCHEMA), folder)
    assert files(f"{tmp_path}/landed") == want | {"a/0.bin": b"again"}
    assert sorted(r["files"] for r in landing.landed_jobs(spark, folder).collect()) == [1, 21]


def test_a_failed_job_leaves_no_new_files(spark, tmp_path):
    folder = f"file://{tmp_path}/landed"
    landing.land(spark.createDataFrame([("old", b"1")], SCHEMA), folder)
    rows = spark.createDataFrame([("old", b"2"), ("new", b"3"), ("../out", b"4")], SCHEMA).coalesce(1)
    with pytest.raises(Exception, match="not below the landing folder"):
        landing.land(rows, folder)
    assert set(files(f"{tmp_path}/landed")) == {"old"} and not os.path.exists(f"{tmp_path}/out")
    assert landing.landed_jobs(spark, folder).count() == 1
    with pytest.raises(Exception, match="append"):
        spark.createDataFrame([("x", b"1")], SCHEMA).write.format("landing").mode("overwrite").save(folder)


def test_paths_with_a_scheme(spark, tmp_path):
    folder = f"file://{tmp_path}"
    docs = spark.createDataFrame([("one", b"1"), ("two", None)], "title string, bytes binary")
    made = drivers.write_files(docs, drivers.landing_path(f"{folder}/docs", F.col("title")), F.col("bytes"))
    assert {r["title"]: r["downloaded"] for r in made.collect()} == {"one": True, "two": False}
    assert files(f"{tmp_path}/docs") == {"one.pdf": b"1"}
    images = spark.createDataFrame([("h", "pages", "#/pages/1", b"p")], "input_hash string, kind string, ref string, bytes binary")
    path = store.save_images(images, f"{folder}/images").first()["path"]
    assert path.startswith("file://") and open(path.removeprefix("file://"), "rb").read() == b"p"
    with pytest.raises(Exception, match="Unrecognized filesystem type"):
        drivers.write_files(docs, F.lit("nowhere:/x/y"), F.col("bytes")).collect()
