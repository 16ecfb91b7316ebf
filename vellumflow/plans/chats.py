"""Registered queries over conversations: histories, prompts, answers, rounds."""

from __future__ import annotations

import json
import random
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumflow.functions import stubs, templates
from vellumflow.operators import answer, cells, chat, deferred, embed, retrieve, rounds
from vellumflow.operators.models import RateLimited, Retry
from vellumflow.plans.common import letters_sql, table
from vellumflow.plans.retrieval import text_corpus
from vellumflow.session import new_folder, settled

K = 3
CELLS = 16


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.normalised(table(spark, sf_dir, "conversations"), "text")


def _chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.conversations(messages(spark, sf_dir))


def last_user_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.last_user_message(messages(spark, sf_dir))


def role_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages with the other names of roles, in the other field."""
    other = F.when(F.col("role") == "user", F.lit("human")).when(F.col("role") == "assistant", F.lit("ai"))
    raw = table(spark, sf_dir, "conversations").withColumn("type", other)
    raw = raw.withColumn("role", F.when(F.col("type").isNull(), F.col("role")))
    return chat.normalised(raw, "text", kind="type").select("conv_id", "turn", "role")


def chat_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chats(spark, sf_dir).select("conv_id", F.to_json(chat.as_request(F.col("messages"))).alias("messages"))


def chat_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = chat.answer_and_history(_chats(spark, sf_dir).withColumn("context", F.lit("the context")), "context")
    no_docs = F.array().cast("array<struct<id:string,page_content:string>>")
    made = chat.response(F.col("answer"), F.col("history"), no_docs)
    return parts.select("conv_id", F.to_json(made).alias("response"))


def message_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = F.create_map(
        F.lit("role"), F.col("role"), F.lit("name"), F.when(F.col("role") == "system", F.lit("setup")),
        F.lit("refusal"), F.lit(None).cast("string"),
    )
    kept = chat.without_nulls(fields)
    return messages(spark, sf_dir).select("conv_id", "turn", F.array_join(F.array_sort(F.map_keys(kept)), ",").alias("fields"))


def appended_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = messages(spark, sf_dir)
    new = old.select("conv_id").distinct().select("conv_id", F.lit("user").alias("role"), F.lit("And then?").alias("content"))
    return chat.append_rows(old, new)


def question_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = chat.last_user_message(messages(spark, sf_dir)).select(
        F.concat(F.lit("chat-"), F.col("conv_id")).alias("qid"), "question"
    )
    listed = table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("list-"), F.col("item_id")).alias("qid"), F.col("text").alias("question")
    )
    return listed.unionByName(asked)


def rewritten_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = chat.last_user_message(messages(spark, sf_dir))
    return asked.select("conv_id", chat.rewritten_notice(F.col("question")).alias("notice"))


def simple_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _chats(spark, sf_dir).join(chat.last_user_message(messages(spark, sf_dir)), "conv_id")
    done = chat.generate(rows, chat.simple_prompt(F.col("question")), stubs.prompt_echo)
    return done.select("conv_id", "reply", F.size("messages").cast("bigint").alias("n_messages"))


def rephrased_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = chat.generate(_chats(spark, sf_dir), chat.rephrase_prompt(F.col("messages")), stubs.prompt_echo, role="user")
    last = F.element_at("messages", -1)
    return done.select("conv_id", last.role.alias("role"), last.content.alias("question"))


# --- retrieve and answer -------------------------------------------------------------------


HOW = answer.Retriever(k=K, others=("chunk_type",), score_digits=4)


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), "text", name.alias("filename"), F.lit("text").alias("chunk_type")
    )


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents nearest to the last question of each conversation."""
    asked = chat.last_user_message(messages(spark, sf_dir)).where("has_question")
    questions = asked.select(F.col("conv_id").alias("qid"), "question")
    return answer.find_documents(
        questions, text_corpus(spark, sf_dir), stubs.letter_embedder, HOW, rows=_rows(spark, sf_dir)
    )


def contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.contexts(_hits(spark, sf_dir)).select("qid", F.md5("context").alias("context_md5"), F.length("context").cast("bigint").alias("n_chars"))


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards = chat.joined_cards(F.col("documents"))
    return chat.contexts(_hits(spark, sf_dir)).select("qid", F.md5(cards).alias("cards_md5"), F.length(cards).cast("bigint").alias("n_chars"))


def rag_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain over all conversations."""
    done = answer.answer_chats(
        _chats(spark, sf_dir), text_corpus(spark, sf_dir), stubs.letter_embedder, stubs.prompt_echo, HOW,
        rows=_rows(spark, sf_dir),
    )
    made = F.col("response")
    return done.select(
        F.col("conv_id").alias("qid"),
        F.get(made.choices, F.lit(0)).message.content.alias("answer"),
        F.size(made.custom_outputs.message_history).cast("bigint").alias("n_history"),
        F.array_join(F.transform(made.custom_outputs.documents, lambda d: d.id), ",").alias("document_ids"),
    )


def cell_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the chain answers from when it searches through cells, all of them probed."""
    corpus = text_corpus(spark, sf_dir)
    pivots = cells.choose_pivots(corpus, CELLS)
    path = new_folder(spark, "cells")
    cells.cell_table(corpus, pivots).write.partitionBy("cell").parquet(path)
    how = replace(HOW, query_type="ann", probes=CELLS)
    done = answer.answer_chats(
        _chats(spark, sf_dir), corpus, stubs.letter_embedder, stubs.prompt_echo, how,
        cells=answer.Cells(spark.read.parquet(path), pivots), rows=_rows(spark, sf_dir),
    )
    documents = F.col("response").custom_outputs.documents
    return done.select(F.col("conv_id").alias("qid"), F.array_join(F.transform(documents, lambda d: d.id), ",").alias("document_ids"))


def refusing_echo():
    """Refuses prompts whose last message has a length divisible by three."""
    echo = stubs.prompt_echo()

    def reply(prompts: list[str]) -> list[str]:
        if any(len(json.loads(p)[-1]["content"]) % 3 == 0 for p in prompts):
            raise ValueError("refused")
        return echo(prompts)

    return reply


def failed_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain where the model refuses some questions, and users of every seventh conversation said nothing."""
    heard = messages(spark, sf_dir).where(~((F.col("conv_id") % 7 == 0) & F.col("role").isin("user", "human")))
    done = answer.answer_chats(
        chat.conversations(heard), text_corpus(spark, sf_dir), stubs.letter_embedder, refusing_echo, HOW,
        rows=_rows(spark, sf_dir),
    )
    made = F.col("response")
    return done.select(
        F.col("conv_id").alias("qid"),
        F.get(made.choices, F.lit(0)).message.content.alias("answer"),
        "error",
        F.size(made.custom_outputs.message_history).cast("bigint").alias("n_history"),
    )


def rephrased_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain with the question first put in the light of the history."""
    done = answer.answer_chats(
        _chats(spark, sf_dir), text_corpus(spark, sf_dir), stubs.letter_embedder, stubs.prompt_echo, HOW,
        rephraser=stubs.prompt_echo, rows=_rows(spark, sf_dir),
    )
    made = F.col("response")
    return done.select(
        F.col("conv_id").alias("qid"), "question", F.get(made.choices, F.lit(0)).message.content.alias("answer"),
        F.size(made.custom_outputs.message_history).cast("bigint").alias("n_history"),
    )


def busy_echo():
    """Is rate limited at every first call for the same prompts."""
    echo, seen = stubs.prompt_echo(), set()

    def reply(prompts: list[str]) -> list[str]:
        key = tuple(prompts)
        if key not in seen:
            seen.add(key)
            raise RateLimited("later")
        return echo(prompts)

    return reply


def no_wait(seconds: float) -> None:
    """Waits for nothing."""


def retried_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _chats(spark, sf_dir).join(chat.last_user_message(messages(spark, sf_dir)), "conv_id").where("has_question")
    done = chat.generate(rows, chat.simple_prompt(F.col("question")), busy_echo, retry=Retry(attempts=2, sleep=no_wait))
    return done.select("conv_id", "reply", "error", F.size("messages").cast("bigint").alias("n_messages"))


def crowded_describer():
    """Describes texts by their size, but refuses every twentieth call, as a busy service would."""
    describe = stubs.size_describer()

    def call(texts: list[str]) -> list[str]:
        if random.random() < 0.05:
            raise RateLimited("busy")
        return describe(texts)

    return call


def replies_in_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions of all documents; what is refused comes back in a later round."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = deferred.replies(docs, F.col("text"), crowded_describer, deferred.Rounds(attempts=10, first_wait=0.01, patience=1000), most=64)
    return done.select("doc_id", F.col("reply.text").alias("description"), F.col("reply.error").alias("error"))


# --- rounds -----------------------------------------------------------------------------------


def planner():
    """Calls for a search while fewer than (messages mod 3) results are there; a chat that begins
    with a system message asks for a tool that does not exist."""

    def decide(prompts: list[str]) -> list[str]:
        out = []
        for prompt in prompts:
            talk = json.loads(prompt)
            given = [m for m in talk if m["role"] != "tool" and not m["content"].startswith('[{"id"')]
            results = sum(m["role"] == "tool" for m in talk)
            if results >= len(given) % 3:
                out.append(json.dumps({"content": f"after {results} results"}))
                continue
            name = "forecast" if given[0]["role"] == "system" else "retrieve_docs"
            call = {"id": f"call-{results}", "function": {"name": name, "arguments": json.dumps({"query": given[-1]["content"]})}}
            out.append(json.dumps({"tool_calls": [call]}))
        return out

    return decide


def search_tool(corpus: DataFrame, k: int = K):
    """The search over ``corpus`` as a tool: all calls of a round are one search."""

    def run(calls: DataFrame) -> DataFrame:
        asked = calls.withColumn("qid", F.xxhash64("conv_id", "call_no")).withColumn(
            "query", F.from_json("arguments", "struct<query:string>").query
        )
        embedded = settled(embed.embed(asked, stubs.letter_embedder, "query").select("qid", "conv_id", "call_no", "embedding"))
        hits = retrieve.exact_hits(embedded.select("qid", "embedding"), corpus, k)
        found = hits.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("rank", "id"))).alias("_h"))
        return embedded.join(found, "qid", "left").select(
            "conv_id", "call_no", F.to_json(F.transform(F.coalesce("_h", F.array().cast("array<struct<rank:int,id:bigint>>")), lambda h: h.id)).alias("result")
        )

    return run


def bounded_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    tool = search_tool(text_corpus(spark, sf_dir))
    done = rounds.tool_rounds(_chats(spark, sf_dir), planner, {"retrieve_docs": tool}, max_rounds=2)
    results = F.filter("messages", lambda m: m.role == "tool")
    return done.select(
        "conv_id", "answer", F.col("rounds").cast("bigint").alias("rounds"), "error",
        F.get(results, F.lit(0)).content.alias("first_result"),
    )


def writer():
    return lambda prompts: [f"draft of {len(json.loads(p))} messages" for p in prompts]


def critic():
    return lambda texts: [f"shorten these {len(t)} characters" for t in texts]


def critique_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = rounds.critique_rounds(_chats(spark, sf_dir), writer, critic)
    last = F.element_at("messages", -1)
    return done.select(
        "conv_id", F.col("rounds").cast("bigint").alias("rounds"), F.size("messages").cast("bigint").alias("n_messages"),
        last.role.alias("role"), last.content.alias("content"),
    )


QUERIES = {
    "last_user_message": last_user_message,
    "role_names": role_names,
    "chat_requests": chat_requests,
    "chat_responses": chat_responses,
    "message_fields": message_fields,
    "appended_messages": appended_messages,
    "question_sets": question_sets,
    "rewritten_notices": rewritten_notices,
    "simple_answers": simple_answers,
    "rephrased_questions": rephrased_questions,
    "contexts": contexts,
    "cards": cards,
    "rag_answers": rag_answers,
    "cell_answers": cell_answers,
    "replies_in_rounds": replies_in_rounds,
    "failed_answers": failed_answers,
    "rephrased_answers": rephrased_answers,
    "retried_answers": retried_answers,
    "bounded_rounds": bounded_rounds,
    "critique_rounds": critique_rounds,
}

_LAST = """lasts AS (SELECT conv_id, max(turn) FILTER (role = 'user') AS turn,
        arg_max(text, turn) FILTER (role = 'user') AS question FROM conversations GROUP BY conv_id)"""
_CHATS = """chats AS (SELECT conv_id, list({'role': role, 'content': text} ORDER BY turn) AS m, count(*) AS n,
        arg_max(text, turn) AS last_text, arg_min(role, turn) AS first_role FROM conversations GROUP BY conv_id)"""
HITS_SQL = f"""{_LAST}, qs AS (SELECT conv_id, {letters_sql('question')} AS e FROM lasts WHERE question IS NOT NULL),
    ds AS (SELECT doc_id, text, {letters_sql('text')} AS e FROM documents), scored AS (
        SELECT conv_id, doc_id, text, round(list_cosine_similarity(qs.e, ds.e), 9) AS s FROM qs, ds
    ), hits AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY s DESC, doc_id) AS rank FROM scored QUALIFY rank <= {K}),
    passages AS (SELECT conv_id, string_agg('Passage: ' || text || chr(10) || ' Document URI: ' || doc_id || '.txt' || chr(10), ''
        ORDER BY rank) AS context, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY rank) AS ids FROM hits GROUP BY conv_id)"""

ORACLE = {
    "last_user_message": f"WITH {_LAST} SELECT conv_id, turn, question, question IS NOT NULL AS has_question FROM lasts",
    "role_names": "SELECT conv_id, turn, role FROM conversations",
    "chat_requests": f"WITH {_CHATS} SELECT conv_id, CAST(to_json(m) AS VARCHAR) AS messages FROM chats",
    "chat_responses": f"""WITH {_CHATS} SELECT conv_id, '{{"choices":[{{"message":{{"role":"assistant","content":' ||
        to_json(last_text) || '}}}}],"custom_outputs":{{"message_history":' ||
        to_json(list_append(m[1 : n - 1], {{'role': 'tool', 'content': 'the context'}})) || ',"documents":[]}}}}' AS response FROM chats""",
    "message_fields": """SELECT conv_id, turn, CASE WHEN role = 'system' THEN 'name,role' ELSE 'role' END AS fields FROM conversations""",
    "appended_messages": """SELECT conv_id, turn, role, text AS content FROM conversations
        UNION ALL SELECT conv_id, max(turn) + 1, 'user', 'And then?' FROM conversations GROUP BY conv_id""",
    "question_sets": f"""WITH {_LAST} SELECT 'list-' || item_id AS qid, text AS question FROM benchmark
        UNION ALL SELECT 'chat-' || conv_id, question FROM lasts""",
    "rewritten_notices": f"""WITH {_LAST} SELECT conv_id, 'To incorporate context from our conversation, I''ve rewritten your question as:'
        || chr(10) || chr(10) || '        ''' || coalesce(question, '') || '''' || chr(10) || '        ' AS notice FROM lasts""",
    "simple_answers": f"""WITH {_LAST}, {_CHATS} SELECT conv_id,
        'So, yeah. 2 messages, the last has ' || length(question) || ' characters' AS reply, n + 1 AS n_messages
        FROM lasts JOIN chats USING (conv_id)""",
    "rephrased_questions": f"""WITH {_CHATS} SELECT conv_id, 'user' AS role,
        'So, yeah. ' || (n + 1) || ' messages, the last has ' || length(last_text) || ' characters' AS question FROM chats""",
    "contexts": f"WITH {HITS_SQL} SELECT conv_id AS qid, md5(context) AS context_md5, length(context) AS n_chars FROM passages",
    "cards": f"""WITH {HITS_SQL}, made AS (SELECT conv_id, string_agg(chr(10) || 'Source: ' || doc_id || '.txt' || chr(10) ||
        'Type: text' || chr(10) || 'ID: ' || doc_id || chr(10) || chr(10) || 'Content:' || chr(10) || text || chr(10),
        chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS c FROM hits GROUP BY conv_id)
        SELECT conv_id AS qid, md5(c) AS cards_md5, length(c) AS n_chars FROM made""",
    "rag_answers": f"""WITH {HITS_SQL}, {_CHATS} SELECT conv_id AS qid,
        'So, yeah. 2 messages, the last has ' || length(question) || ' characters' AS answer,
        n + 1 AS n_history, ids AS document_ids
        FROM lasts JOIN chats USING (conv_id) JOIN passages USING (conv_id)""",
    "cell_answers": f"""WITH {HITS_SQL}, {_CHATS} SELECT conv_id AS qid, ids AS document_ids
        FROM lasts JOIN chats USING (conv_id) JOIN passages USING (conv_id)""",
    "failed_answers": f"""WITH heard AS (SELECT * FROM conversations WHERE NOT (conv_id % 7 = 0 AND role = 'user')),
        said AS (SELECT conv_id, count(*) AS n, arg_max(text, turn) FILTER (role = 'user') AS question FROM heard GROUP BY conv_id)
        SELECT conv_id AS qid, CASE WHEN length(question) % 3 > 0 THEN
            'So, yeah. 2 messages, the last has ' || length(question) || ' characters' END AS answer,
        CASE WHEN length(question) % 3 = 0 THEN 'ValueError: refused' END AS error,
        n + CASE WHEN question IS NULL THEN 0 ELSE 1 END AS n_history FROM said""",
    "rephrased_answers": f"""WITH {_CHATS}, asked AS (SELECT conv_id, n,
        'So, yeah. ' || (n + 1) || ' messages, the last has ' || length(last_text) || ' characters' AS question FROM chats)
        SELECT conv_id AS qid, question, 'So, yeah. 2 messages, the last has ' || length(question) || ' characters' AS answer,
        n + 2 AS n_history FROM asked""",
    "replies_in_rounds": """SELECT doc_id, length(text) || ' characters in ' || (length(text) - length(replace(text, chr(10), '')) + 1) || ' lines' AS description,
        CAST(NULL AS VARCHAR) AS error FROM documents""",
    "retried_answers": f"""WITH {_LAST}, {_CHATS} SELECT conv_id,
        'So, yeah. 2 messages, the last has ' || length(question) || ' characters' AS reply, CAST(NULL AS VARCHAR) AS error,
        n + 1 AS n_messages FROM lasts JOIN chats USING (conv_id) WHERE question IS NOT NULL""",
    "bounded_rounds": f"""WITH {_CHATS}, qs AS (SELECT conv_id, {letters_sql('last_text')} AS e FROM chats),
        ds AS (SELECT doc_id, {letters_sql('text')} AS e FROM documents), scored AS (
            SELECT conv_id, doc_id, round(list_cosine_similarity(qs.e, ds.e), 9) AS s FROM qs, ds
        ), hits AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY s DESC, doc_id) AS rank FROM scored QUALIFY rank <= {K}),
        found AS (SELECT conv_id, '[' || string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY rank) || ']' AS ids FROM hits GROUP BY conv_id)
        SELECT conv_id, CASE WHEN n % 3 = 0 THEN 'after 0 results'
                             WHEN first_role <> 'system' AND n % 3 = 1 THEN 'after 1 results' END AS answer,
        CASE WHEN n % 3 = 0 OR first_role = 'system' THEN 1 ELSE 2 END AS rounds,
        CASE WHEN n % 3 = 0 THEN NULL WHEN first_role = 'system' THEN 'unknown tool'
             WHEN n % 3 = 2 THEN 'max iter reached' END AS error,
        CASE WHEN n % 3 > 0 AND first_role <> 'system' THEN ids END AS first_result
        FROM chats JOIN found USING (conv_id)""",
    "critique_rounds": f"""WITH {_CHATS}, c AS (SELECT conv_id, n, greatest(1, CAST(ceil((8 - n - 1) / 2.0) AS BIGINT) + 1) AS r FROM chats)
        SELECT conv_id, r AS rounds, n + 2 * r - 1 AS n_messages, 'assistant' AS role,
        'draft of ' || (n + 2 * r - 2) || ' messages' AS content FROM c""",
}
