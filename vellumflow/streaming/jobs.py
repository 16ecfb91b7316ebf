"""The same operators under Structured Streaming: conversion, sync, search, events, history."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from vellumflow.operators.embed import EmbedderFactory, embed
from vellumflow.operators.retrieve import exact_hits
from vellumflow.operators.sync import (
    apply_changes,
    change_set,
    changed_rows,
    read_latest,
    table_exists,
    touched,
    write_version,
)
from vellumflow.session import few, settled
from vellumflow.sources.store import pending

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
# Expiry by time would ask for ever more empty batches, and a drained stream would never stop.
NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _started_with(
    spark: SparkSession, settings: dict[str, str], start: Callable[[], StreamingQuery]
) -> StreamingQuery:
    """Start a query under settings it takes a copy of, then put the session's own back."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        return start()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _drain(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Work through everything that is there, then stop. The checkpoint remembers what was seen."""
    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def convert_stream(
    documents: DataFrame,
    to_layout: Callable[[DataFrame], DataFrame],
    to_chunks: Callable[[DataFrame], DataFrame],
    layout_path: str,
    chunk_path: str,
    checkpoint: str,
) -> StreamingQuery:
    """Convert only documents without a stored conversion.

    A document that comes twice in one batch is converted once, from the first
    of its rows in the order of their digest. Each batch writes its own folder, so a batch that is run again after a
    failure replaces what it wrote before.
    """

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        first = f"{layout_path}/batch={number}"
        stored = _stored_before(spark, layout_path, number)
        once = batch.groupBy("input_hash").agg(F.min_by(F.struct(*batch.columns), F.xxhash64(*batch.columns)).alias("_d")).select("_d.*")
        fresh = once if stored is None else pending(once, stored)
        to_layout(fresh).write.mode("overwrite").parquet(first)
        to_chunks(spark.read.parquet(first)).write.mode("overwrite").parquet(f"{chunk_path}/batch={number}")

    return _drain(documents, checkpoint, each)


def _stored_before(spark: SparkSession, path: str, number: int) -> DataFrame | None:
    """What earlier batches stored."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return None
    stored = spark.read.option("basePath", path).parquet(path)
    return stored.where(F.col("batch") < number)


def sync_stream(
    chunks: DataFrame,
    folder: str,
    embedder: EmbedderFactory,
    columns: list[str],
    checkpoint: str,
    key: str = "id",
    version: str | None = None,
    deleted: str | None = None,
) -> StreamingQuery:
    """Apply each batch of new, changed or deleted chunk rows to the embedded table.

    Of several rows of one key in a batch the one with the largest ``version``
    counts, of equal ones the last in the order of their digest. A row with
    ``deleted`` true removes its key. Rows that a batch does not name are kept. A
    batch that is run again finds nothing to change.
    """

    def each(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        mark = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
        newest = F.struct(*([F.col(version).alias("_v")] if version else []), F.xxhash64(*columns).alias("_h"))
        row = F.struct(*columns, mark.alias("_gone"))
        named_rows = settled(batch.groupBy(F.col(key).alias("_key")).agg(F.max_by(row, newest).alias("_r")).select("_r.*"))
        rows = named_rows.where("NOT _gone").drop("_gone")
        if not table_exists(spark, folder):
            # The rows are kept already, so they are not stored once more.
            write_version(embed(rows.select(*columns), embedder), folder, key)
            return
        old = read_latest(spark, folder, touched(spark, folder, named_rows, key))
        # Digests move, not rows: of the keys that the batch has no row for, only those it deletes go.
        changes = change_set(old, rows, key, [c for c in columns if c != key])
        gone = named_rows.where("_gone").select(key)
        gone = changes.where("change = 'delete'").join(gone, key, "left_semi")
        changes = few(settled(changes.where("change <> 'delete'").unionByName(gone)))
        if not changes.isEmpty():
            apply_changes(spark, folder, changes, embed(changed_rows(rows, changes, key), embedder), key)

    return _drain(chunks, checkpoint, each)


def search_stream(questions: DataFrame, corpus: DataFrame, out: str, checkpoint: str, k: int = 3, **search) -> StreamingQuery:
    """Hits for each batch of questions, one folder per batch."""

    def each(batch: DataFrame, number: int) -> None:
        exact_hits(batch, corpus, k, **search).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return _drain(questions, checkpoint, each)


def step_events(answered: DataFrame) -> DataFrame:
    """Two events per question: its documents, then its message.

    ``answered`` is ``(qid, context, documents, messages)``. Documents are kept in
    the first event also when there is no history.
    """
    documents = F.struct(
        F.lit(1).alias("step"),
        F.lit("documents").alias("event"),
        F.to_json(F.struct(F.col("context").alias("answer"), "documents")).alias("payload"),
    )
    message = F.struct(
        F.lit(2).alias("step"),
        F.lit("message").alias("event"),
        F.to_json(
            F.struct(F.element_at("messages", -1).content.alias("answer"), F.col("messages").alias("message_history"))
        ).alias("payload"),
    )
    return answered.select("qid", F.inline(F.array(documents, message)))


def event_stream(
    questions: DataFrame, answer: Callable[[DataFrame], DataFrame], out: str, checkpoint: str
) -> StreamingQuery:
    """Answer each batch and write its events in step order, one folder per batch."""

    def each(batch: DataFrame, number: int) -> None:
        step_events(answer(batch)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return _drain(questions, checkpoint, each)


# --- conversation state ------------------------------------------------------------------------

CONVERSATION = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("n_messages", T.LongType()),
        T.StructField("last_turn", T.LongType()),
        T.StructField("question_turn", T.LongType()),
        T.StructField("question", T.StringType()),
    ]
)
KEPT = T.StructType(CONVERSATION.fields[1:])


class _Conversation(StatefulProcessor):
    """Per conversation: how many messages, the last turn, and the last user message.

    None of it depends on the order in which rows of a batch arrive, so a long
    conversation is folded slice by slice and the state stays one small row.
    """

    def __init__(self, ttl_ms: int | None) -> None:
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("conversation", KEPT, self.ttl_ms)

    def handleInputRows(self, key, rows, timer_values) -> Iterator[pd.DataFrame]:
        n, last, asked, question = self.kept.get() if self.kept.exists() else (0, -1, -1, None)
        for part in rows:
            n += len(part)
            last = max(last, int(part["turn"].max()))
            users = part[part["role"].isin(["user", "human"])]
            if len(users) and users["turn"].max() > asked:
                newest = users.loc[users["turn"].idxmax()]
                asked, question = int(newest["turn"]), newest["content"]
        self.kept.update((n, last, asked, question))
        found = (key[0], n, last, asked if asked >= 0 else None, question)
        frame = pd.DataFrame([found], columns=CONVERSATION.fieldNames())
        yield frame.astype({"question_turn": "Int64"})

    def close(self) -> None:
        pass


def conversation_stream(
    messages: DataFrame, out: str, checkpoint: str, ttl_ms: int | None = None
) -> StreamingQuery:
    """Update form: the state of every conversation that got messages in a batch.

    A conversation is remembered for ever, or with ``ttl_ms`` until it was silent for so long.
    """
    spark = messages.sparkSession
    states = (
        messages.select("conv_id", "turn", "role", "content")
        .groupBy("conv_id")
        .transformWithStateInPandas(
            statefulProcessor=_Conversation(ttl_ms),
            outputStructType=CONVERSATION,
            outputMode="Update",
            timeMode="ProcessingTime" if ttl_ms else "None",
        )
    )

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    def start() -> StreamingQuery:
        return (
            states.writeStream.foreachBatch(each)
            .option("checkpointLocation", checkpoint)
            .outputMode("update")
            .trigger(availableNow=True)
            .start()
        )

    return _started_with(spark, {STATE_STORE: ROCKSDB, NO_DATA_BATCHES: "false"}, start)


# --- histories held in state --------------------------------------------------------------------

TURN = T.StructType([T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
HISTORY = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("event", T.StringType()),
        T.StructField("messages", T.ArrayType(TURN)),
    ]
)


class _History(StatefulProcessor):
    """Per conversation: the list of its messages, appended to as they arrive, and a timer where it may fall silent.

    The list lies in the state store message by message, so a batch adds only its
    own; it is read whole only where the history is shown.
    """

    def __init__(self, idle_ms: int | None) -> None:
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.turns = handle.getListState("turns", TURN)
        self.due = handle.getValueState("due", T.StructType([T.StructField("at", T.LongType())]))

    def _shown(self, key, event: str) -> pd.DataFrame:
        kept = sorted(self.turns.get(), key=lambda t: (t[0] is not None, t[0] or 0))
        messages = [dict(zip(TURN.fieldNames(), t)) for t in kept]
        return pd.DataFrame({"conv_id": [key[0]], "event": [event], "messages": [messages]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for part in rows:
            plain = part[TURN.fieldNames()].astype(object).where(part[TURN.fieldNames()].notna(), None)
            self.turns.appendList([(None if t is None else int(t), r, c) for t, r, c in plain.itertuples(index=False)])
        if self.idle_ms:
            if self.due.exists():
                self.handle.deleteTimer(self.due.get()[0])
            at = timerValues.getCurrentProcessingTimeInMs() + self.idle_ms
            self.handle.registerTimer(at)
            self.due.update((at,))
        yield self._shown(key, "history")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last = self._shown(key, "closed")
        self.turns.clear()
        self.due.clear()
        yield last

    def close(self) -> None:
        pass


def history_stream(messages: DataFrame, out: str, checkpoint: str, idle_ms: int | None = None) -> StreamingQuery:
    """Rewrite form: the whole history of every conversation that got messages in a batch, as ``(conv_id, event, messages)``.

    Messages are kept in the state store; no batch reads what an earlier one
    wrote. Messages are in order of ``turn`` (null first), those of equal turns in the order they came.
    With ``idle_ms`` a conversation that was silent for so long is shown once more with the event ``closed`` and forgotten,
    in the next batch that has rows. A checkpoint stays with or without ``idle_ms``, as it was begun.
    """
    spark = messages.sparkSession
    histories = (
        messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "content")
        .groupBy("conv_id")
        .transformWithStateInPandas(
            statefulProcessor=_History(idle_ms),
            outputStructType=HISTORY,
            outputMode="Update",
            timeMode="ProcessingTime" if idle_ms else "None",
        )
    )

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    def start() -> StreamingQuery:
        return (
            histories.writeStream.foreachBatch(each)
            .option("checkpointLocation", checkpoint)
            .outputMode("update")
            .trigger(availableNow=True)
            .start()
        )

    return _started_with(spark, {STATE_STORE: ROCKSDB, NO_DATA_BATCHES: "false"}, start)


def kept_histories(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Messages that a stopped ``history_stream`` holds, one row each, read from its state alone."""

    def read() -> DataFrame:
        state = (
            spark.read.format("statestore").option("stateVarName", "turns").option("flattenCollectionTypes", True).load(checkpoint)
        )
        return state.select("key.conv_id", "list_element.turn", "list_element.role", "list_element.content")

    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        return settled(read())
    finally:
        spark.conf.unset(STATE_STORE) if before is None else spark.conf.set(STATE_STORE, before)
