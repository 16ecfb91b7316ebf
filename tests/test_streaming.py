import pytest
from pyspark.sql import functions as F

from vellumflow.functions import stubs
from vellumflow.operators import chunking, sync
from vellumflow.sources.text_layout import text_layout
from vellumflow.streaming import jobs

DOC = "input_hash string, filename string, text string"


def to_layout(rows):
    return text_layout(rows, F.col("input_hash"), F.col("filename"))


def convert(spark, base, ledger="ledger"):
    docs = spark.readStream.schema(DOC).parquet(f"{base}/in")
    jobs.convert_stream(docs, to_layout, chunking.text_chunks, f"{base}/layout", f"{base}/chunks", f"{base}/{ledger}").awaitTermination()
    return {(r.filename, r.text) for r in spark.read.option("basePath", f"{base}/chunks").parquet(f"{base}/chunks").collect()}


def test_conversion_sees_each_document_once(spark, tmp_path):
    base = str(tmp_path)
    spark.createDataFrame([("1", "a.txt", "alpha"), ("2", "b.txt", "beta")], DOC).write.parquet(f"{base}/in")
    first = convert(spark, base)
    assert first == {("a.txt", "alpha"), ("b.txt", "beta")}
    assert convert(spark, base) == first
    # A known document that arrives again is not converted again; a new one is.
    spark.createDataFrame([("1", "a.txt", "changed"), ("3", "c.txt", "gamma")], DOC).write.mode("append").parquet(f"{base}/in")
    assert convert(spark, base) == first | {("c.txt", "gamma")}


def test_sync_applies_changes_only(spark, tmp_path):
    calls = []
    base, columns = str(tmp_path), ["id", "text"]
    schema = "id long, text string"

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(schema).parquet(f"{base}/in")
        jobs.sync_stream(stream, f"{base}/table", stubs.letter_embedder, columns, f"{base}/ledger").awaitTermination()
        calls.append(sync.versions(spark, f"{base}/table")[-1])
        return {r.id: (r.text, r.embedding[0]) for r in sync.read_latest(spark, f"{base}/table").collect()}

    assert arrive([(1, "aa"), (2, "b")]) == {1: ("aa", 2.0), 2: ("b", 0.0)}
    assert arrive([(2, "ba"), (3, "aaa")]) == {1: ("aa", 2.0), 2: ("ba", 1.0), 3: ("aaa", 3.0)}
    arrive([(3, "aaa")])
    assert calls == [1, 2, 2]


def test_sync_deletes_and_leaves_the_rest(spark, tmp_path):
    folder = str(tmp_path / "t")
    make = lambda rows: spark.createDataFrame(rows, "id long, text string")
    assert not sync.table_exists(spark, folder)
    sync.sync(make([(1, "a"), (2, None), (3, "c")]), folder, stubs.letter_embedder, ["id", "text"])
    now = sync.sync(make([(2, None), (3, "cc"), (4, "d")]), folder, stubs.letter_embedder, ["id", "text"])
    assert {(r.id, r.text) for r in now.collect()} == {(2, None), (3, "cc"), (4, "d")}
    again = sync.sync(make([(2, None), (3, "cc"), (4, "d")]), folder, stubs.letter_embedder, ["id", "text"])
    assert again.count() == 3 and sync.versions(spark, folder) == [1, 2]


def test_changes_applied_to_old_give_new(spark):
    old = spark.createDataFrame([(1, "a", [1]), (2, None, None), (3, "c", [3]), (4, "d", [])], "id long, t string, p array<int>")
    new = spark.createDataFrame([(1, "a", [1]), (2, "b", None), (3, "c", [3, 4]), (5, None, [])], "id long, t string, p array<int>")
    changes = sync.change_set(old, new)
    assert {(r.id, r.change) for r in changes.collect()} == {(2, "update"), (3, "update"), (4, "delete"), (5, "insert")}
    made = sync.upsert(old, changes, sync.changed_rows(new, changes))
    assert sorted(map(str, made.collect())) == sorted(map(str, new.collect()))


def test_conversation_state_over_batches(spark, tmp_path):
    base, schema = str(tmp_path), "conv_id long, turn long, role string, content string"

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(schema).parquet(f"{base}/in")
        jobs.conversation_stream(stream, f"{base}/state", f"{base}/ledger").awaitTermination()
        jobs.history_stream(stream, f"{base}/full", f"{base}/ledger2").awaitTermination()
        out = spark.read.option("basePath", f"{base}/state").parquet(f"{base}/state")
        full = spark.read.option("basePath", f"{base}/full").parquet(f"{base}/full")
        last = out.agg(F.max("batch")).first()[0]
        state = {r.conv_id: (r.n_messages, r.last_turn, r.question) for r in out.where(F.col("batch") == last).collect()}
        history = {r.conv_id: [m.content for m in r.messages] for r in full.where(F.col("batch") == last).collect()}
        return state, history

    state, history = arrive([(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, "system", "s")])
    assert state == {1: (2, 1, "a"), 2: (1, 0, None)} and history == {1: ["a", "b"], 2: ["s"]}
    state, history = arrive([(1, 2, "human", "c")])
    assert state == {1: (3, 2, "c")} and history == {1: ["a", "b", "c"]}
    held = {(r.conv_id, r.turn, r.role, r.content) for r in jobs.kept_histories(spark, f"{base}/ledger2").collect()}
    assert held == {(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "human", "c"), (2, 0, "system", "s")}
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"


def test_sync_leaves_untouched_buckets_alone(spark, tmp_path):
    import glob
    import os

    folder = str(tmp_path / "buckets")
    make = lambda texts: spark.createDataFrame(list(texts.items()), "id long, text string")
    texts = {i: f"text {i}" for i in range(300)}
    sync.sync(make(texts), folder, stubs.letter_embedder, ["id", "text"])
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{folder}/version=1/bucket=*/*.parquet")}
    now = sync.sync(make({**texts, 7: "changed"}), folder, stubs.letter_embedder, ["id", "text"])
    assert {r.id: r.text for r in now.collect()} == {**texts, 7: "changed"}
    assert {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{folder}/version=1/bucket=*/*.parquet")} == before
    assert len(glob.glob(f"{folder}/version=2/bucket=*")) == 1 < len(before)
    del texts[9]
    sync.sync(make({**texts, 7: "changed"}), folder, stubs.letter_embedder, ["id", "text"])
    assert sync.forget_versions(spark, folder) == [1] and sync.versions(spark, folder) == [2, 3]
    assert {r.id for r in sync.read_latest(spark, folder).collect()} == set(texts)
    sync.sync(make({1: "only"}), folder, stubs.letter_embedder, ["id", "text"])
    assert [tuple(r)[:2] for r in sync.read_latest(spark, folder).collect()] == [(1, "only")]


def test_sync_stream_takes_the_newest_and_deletes(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "table")
    schema = "id long, text string, v int, gone boolean"
    for n, rows in enumerate([[(1, "a", 1, False), (1, "b", 3, False), (1, "c", 2, False), (2, "x", 1, False)], [(2, "x", 2, True), (3, "y", 1, None)]]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        jobs.sync_stream(stream, folder, stubs.letter_embedder, ["id", "text"], str(tmp_path / "ledger"), version="v", deleted="gone").awaitTermination()
    assert sorted((r.id, r.text) for r in sync.read_latest(spark, folder).collect()) == [(1, "b"), (3, "y")]


def test_histories_of_late_empty_and_null_messages(spark, tmp_path):
    """Late turns find their place, nulls stay nulls, and no batch reads what an earlier one wrote."""
    import shutil

    base, schema = str(tmp_path), "conv_id long, turn long, role string, content string"

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(schema).parquet(f"{base}/in")
        jobs.history_stream(stream, f"{base}/out", f"{base}/ledger").awaitTermination()
        out = spark.read.schema(jobs.HISTORY).parquet(f"{base}/out/*").collect()
        return {r.conv_id: [tuple(m) for m in r.messages] for r in out}

    assert arrive([(1, 5, "user", "later"), (None, 0, "user", "nobody")]) == {1: [(5, "user", "later")], None: [(0, "user", "nobody")]}
    shutil.move(f"{base}/out", f"{base}/gone")
    long = "x" * 300_000
    got = arrive([(1, 2, None, None), (1, None, "user", long), (1, 2, "user", "")])
    assert got == {1: [(None, "user", long), (2, None, None), (2, "user", ""), (5, "user", "later")]}


def test_silent_conversations_are_closed(spark, tmp_path):
    import time

    base, schema = str(tmp_path), "conv_id long, turn long, role string, content string"

    def arrive(rows, idle_ms):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(schema).parquet(f"{base}/in")
        jobs.history_stream(stream, f"{base}/out", f"{base}/ledger", idle_ms).awaitTermination()
        out = spark.read.option("basePath", f"{base}/out").parquet(f"{base}/out")
        last = out.agg(F.max("batch")).first()[0]
        return {(r.conv_id, r.event): [m.content for m in r.messages] for r in out.where(F.col("batch") == last).collect()}

    assert arrive([(1, 0, "user", "a")], 1000) == {(1, "history"): ["a"]}
    time.sleep(2)
    assert arrive([(2, 0, "user", "b")], 1000) == {(1, "closed"): ["a"], (2, "history"): ["b"]}
    assert {r.conv_id for r in jobs.kept_histories(spark, f"{base}/ledger").collect()} == {2}


def test_tables_of_many_files_and_of_one_as_streams(spark, sf_dir, tmp_path):
    from vellumflow.plans import streams

    tables = str(tmp_path)
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows.repartition(3).write.parquet(f"{tables}/conversations.parquet")
    spark.range(3).write.parquet(f"{tables}/other.parquet")
    wanted = sorted(map(str, streams.conversation_state(spark, sf_dir).collect()))
    assert len(wanted) == rows.select("conv_id").distinct().count()
    assert sorted(map(str, streams.conversation_state(spark, tables).collect())) == wanted
