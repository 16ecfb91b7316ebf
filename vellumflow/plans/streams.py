"""Registered queries that run as streams: each is drained, then its result is read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumflow.functions import stubs
from vellumflow.operators import answer, chunking, sync
from vellumflow.plans.chats import K, letters_sql
from vellumflow.plans.common import ITEMS_SQL, TEXT_CHUNKS_SQL, flat, table
from vellumflow.plans.retrieval import _VERSIONS, _new, _old, _topk, shown, text_corpus
from vellumflow.session import new_folder, spread
from vellumflow.sources.text_layout import text_layout
from vellumflow.streaming import jobs


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream of its files, whether it is one file or a folder of them.

    A pattern of one alternative names the table: a path that is no pattern must be a folder.
    """
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{{{name}.parquet}}")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path).drop("batch")


def streamed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = new_folder(spark, "convert")
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    docs = stream(spark, sf_dir, "documents").select(
        F.md5(F.concat(F.lit("/documents/"), name)).alias("input_hash"), name.alias("filename"), "text", "n_chars"
    )
    to_layout = lambda rows: text_layout(spread(rows, "input_hash"), F.col("input_hash"), F.col("filename"), size="n_chars")
    # The second pass starts without a ledger and finds every document converted.
    for checkpoint in ("ledger", "second-ledger"):
        number = "" if checkpoint == "ledger" else "-again"
        jobs.convert_stream(
            docs, to_layout, chunking.text_chunks, f"{base}/layout", f"{base}/chunks{number}", f"{base}/{checkpoint}"
        ).awaitTermination()
    return flat(read_batches(spark, f"{base}/chunks").select("filename", "pages", "doc_refs", "text", "id"))


def streamed_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The old version arrives, then changes: rows of the new one, an older state of each of them, and deletes."""
    base, columns = new_folder(spark, "sync"), ["id", "text", "source"]
    source = f"{base}/source"
    old, new = _old(spark, sf_dir), _new(spark, sf_dir)
    marked = lambda rows, version, gone: rows.select(*columns, F.lit(version).alias("version"), F.lit(gone).alias("deleted"))
    stale = marked(new.withColumn("text", F.concat("text", F.lit(" stale"))), 2, False)
    removed = marked(old.join(new.select("id"), "id", "left_anti").where("id % 5 = 0"), 3, True)
    for rows in (marked(old, 1, False), marked(new, 3, False).union(stale).union(removed)):
        rows.write.mode("append").parquet(source)
        arrived = spark.readStream.schema(rows.schema).parquet(source)
        jobs.sync_stream(
            arrived, f"{base}/embedded", stubs.letter_embedder, columns, f"{base}/ledger", version="version", deleted="deleted"
        ).awaitTermination()
    now = sync.read_latest(spark, f"{base}/embedded")
    return now.select("id", F.md5("text").alias("text_md5"), F.get("embedding", F.lit(4)).cast("bigint").alias("e"))


def streamed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = new_folder(spark, "search")
    questions = stream(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("qid"), "embedding")
    corpus = table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "id")
    jobs.search_stream(questions, corpus, f"{base}/hits", f"{base}/ledger", K).awaitTermination()
    return shown(read_batches(spark, f"{base}/hits"))


def streamed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = new_folder(spark, "events")
    corpus = text_corpus(spark, sf_dir)
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), "text", F.concat(F.col("doc_id"), F.lit(".txt")).alias("filename")
    )

    user = F.array(F.struct(F.lit("user").alias("role"), F.col("question").alias("content")))

    def reply(batch: DataFrame) -> DataFrame:
        chats = batch.select(F.col("qid").alias("conv_id"), user.alias("messages"))
        done = answer.answer_chats(chats, corpus, stubs.letter_embedder, stubs.prompt_echo, answer.Retriever(k=K), rows=docs)
        return done.withColumnRenamed("conv_id", "qid")

    questions = stream(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("question"))
    jobs.event_stream(questions, reply, f"{base}/out", f"{base}/ledger").awaitTermination()
    return read_batches(spark, f"{base}/out").select(
        "qid", F.col("step").cast("bigint").alias("step"), "event", F.md5(F.get_json_object("payload", "$.answer")).alias("answer_md5")
    )


def _message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream(spark, sf_dir, "conversations").withColumnRenamed("text", "content")


def conversation_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = new_folder(spark, "state")
    jobs.conversation_stream(_message_stream(spark, sf_dir), f"{base}/out", f"{base}/ledger").awaitTermination()
    return read_batches(spark, f"{base}/out")


def streamed_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = new_folder(spark, "histories")
    jobs.history_stream(_message_stream(spark, sf_dir), f"{base}/out", f"{base}/ledger").awaitTermination()
    shown = F.transform("messages", lambda m: F.struct(m.role.alias("role"), m.content.alias("content")))
    return read_batches(spark, f"{base}/out").select("conv_id", F.to_json(shown).alias("messages"))


def histories_in_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages read back from the state of a stream that has stopped."""
    base = new_folder(spark, "histories")
    jobs.history_stream(_message_stream(spark, sf_dir), f"{base}/out", f"{base}/ledger").awaitTermination()
    return jobs.kept_histories(spark, f"{base}/ledger")


QUERIES = {
    "streamed_chunks": streamed_chunks,
    "streamed_sync": streamed_sync,
    "streamed_search": streamed_search,
    "streamed_events": streamed_events,
    "conversation_state": conversation_state,
    "streamed_histories": streamed_histories,
    "histories_in_state": histories_in_state,
}

ORACLE = {
    "streamed_chunks": f"WITH RECURSIVE {ITEMS_SQL}, {TEXT_CHUNKS_SQL} SELECT filename, pages, doc_refs, text, id FROM textchunks",
    "streamed_sync": f"""WITH {_VERSIONS}, now AS (SELECT * FROM new UNION ALL SELECT * FROM old WHERE id NOT IN (SELECT id FROM new) AND id % 5 <> 0)
        SELECT id, md5(text) AS text_md5, length(lower(text)) - length(replace(lower(text), 'e', '')) AS e FROM now""",
    "streamed_search": _topk(K),
    "streamed_events": f"""WITH qs AS (SELECT item_id, text, {letters_sql('text')} AS e FROM benchmark),
        ds AS (SELECT doc_id, text, {letters_sql('text')} AS e FROM documents), hits AS (
            SELECT item_id, doc_id, ds.text, row_number() OVER (PARTITION BY item_id
                ORDER BY round(list_cosine_similarity(qs.e, ds.e), 9) DESC, doc_id) AS rank FROM qs, ds QUALIFY rank <= {K})
        SELECT item_id AS qid, 1 AS step, 'documents' AS event, md5(string_agg('Passage: ' || text || chr(10) ||
            ' Document URI: ' || doc_id || '.txt' || chr(10), '' ORDER BY rank)) AS answer_md5 FROM hits GROUP BY item_id
        UNION ALL SELECT item_id, 2, 'message', md5('So, yeah. 2 messages, the last has ' || length(text) || ' characters') FROM benchmark""",
    "conversation_state": """SELECT conv_id, count(*) AS n_messages, max(turn) AS last_turn,
        max(turn) FILTER (role = 'user') AS question_turn, arg_max(text, turn) FILTER (role = 'user') AS question
        FROM conversations GROUP BY conv_id""",
    "streamed_histories": """SELECT conv_id, CAST(to_json(list({'role': role, 'content': text} ORDER BY turn)) AS VARCHAR) AS messages
        FROM conversations GROUP BY conv_id""",
    "histories_in_state": "SELECT conv_id, CAST(turn AS BIGINT) AS turn, role, text AS content FROM conversations",
}
