"""Conversations as tables: last questions, histories, contexts, prompts and responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumflow import schemas
from vellumflow.functions import templates
from vellumflow.operators.models import ModelFactory, Retry, model_reply

MESSAGES = "array<struct<role:string,content:string>>"
# Other names of roles.
ROLE_NAMES = {"human": "user", "ai": "assistant"}


# --- messages -----------------------------------------------------------------------------


def role_name(role: Column, kind: Column | None = None) -> Column:
    """Role under its usual name; ``kind`` is the field some writers use in place of role."""
    given = F.coalesce(role, kind) if kind is not None else role
    named = F.when(given == "human", F.lit("user"))
    for other, usual in ROLE_NAMES.items():
        named = named.when(given == other, F.lit(usual))
    return named.otherwise(given)


def normalised(messages: DataFrame, content: str = "content", kind: str | None = None) -> DataFrame:
    """``(conv_id, turn, role, content)`` with usual role names."""
    role = role_name(F.col("role"), F.col(kind) if kind else None)
    return messages.select("conv_id", "turn", role.alias("role"), F.col(content).alias("content"))


def as_request(messages: Column) -> Column:
    """Only role and content of each message."""
    return F.transform(messages, lambda m: F.struct(m.role.alias("role"), m.content.alias("content")))


def without_nulls(fields: Column) -> Column:
    """A message given as a map, without its null fields."""
    return F.map_filter(fields, lambda _, v: v.isNotNull())


def last_user_message(messages: DataFrame) -> DataFrame:
    """One row per conversation; ``question`` is null and ``has_question`` false where no user spoke."""
    asked = F.when(F.col("role").isin("user", "human"), F.struct("turn", "content"))
    return (
        messages.groupBy("conv_id")
        .agg(F.max_by(asked, F.when(asked.isNotNull(), F.col("turn"))).alias("_last"))
        .select(
            "conv_id",
            F.col("_last.turn").alias("turn"),
            F.col("_last.content").alias("question"),
            F.col("_last").isNotNull().alias("has_question"),
        )
    )


def conversations(messages: DataFrame) -> DataFrame:
    """One row per conversation, its messages in order."""
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "content")))
    return messages.groupBy("conv_id").agg(ordered.alias("_m")).select("conv_id", as_request(F.col("_m")).alias("messages"))


def appended(messages: Column, role: str | Column, content: Column) -> Column:
    """The messages and one more."""
    kind = F.lit(role) if isinstance(role, str) else role
    return F.concat(messages, F.array(F.struct(kind.alias("role"), content.alias("content"))))


def append_rows(messages: DataFrame, new: DataFrame) -> DataFrame:
    """Message table with new messages ``(conv_id, role, content)`` after the last turn of each conversation.

    Several new messages of one conversation need a column ``position`` that orders
    them; without one they are ordered by role and content.
    """
    last = messages.groupBy("conv_id").agg(F.max("turn").alias("_last"))
    order = ["position"] if "position" in new.columns else ["role", "content"]
    nth = F.row_number().over(Window.partitionBy("conv_id").orderBy(*order))
    numbered = new.withColumn("_nth", nth).join(last, "conv_id", "left").select(
        "conv_id", (F.coalesce("_last", F.lit(-1)) + F.col("_nth")).cast(messages.schema["turn"].dataType).alias("turn"), "role", "content"
    )
    return messages.unionByName(numbered)


def answer_and_history(chats: DataFrame, context: str | None = None, answered: Column | None = None) -> DataFrame:
    """Answer is the last message, history all before it, with the context as a tool message.

    Where ``answered`` is false the last message is no answer: the answer is null and all messages are history.
    """
    answered = F.lit(True) if answered is None else F.coalesce(answered, F.lit(False))
    before = F.slice("messages", 1, F.greatest(F.size("messages") - 1, F.lit(0)))
    history = F.when(answered, before).otherwise(F.col("messages"))
    if context:
        history = F.when(F.col(context).isNull(), history).otherwise(appended(history, "tool", F.col(context)))
    last = F.try_element_at("messages", F.lit(-1)).content
    return chats.withColumn("answer", F.when(answered, last)).withColumn("history", history)


def response(answer: Column, history: Column, documents: Column, always_documents: bool = True) -> Column:
    """Nested response. ``custom_outputs`` is left out without history, unless documents are to be kept."""
    outputs = F.struct(history.alias("message_history"), documents.alias("documents"))
    kept = outputs if always_documents else F.when(F.coalesce(F.size(history), F.lit(0)) > 0, outputs)
    message = F.struct(F.lit("assistant").alias("role"), answer.alias("content"))
    return F.struct(F.array(F.struct(message.alias("message"))).alias("choices"), kept.alias("custom_outputs"))


# --- contexts and cards -----------------------------------------------------------------------


def passage(chunk_text: Column, document_uri: Column, template: str = templates.PASSAGE) -> Column:
    return templates.fill(template, chunk_text=chunk_text, document_uri=document_uri)


def contexts(documents: DataFrame, uri: str = "filename", template: str = templates.PASSAGE) -> DataFrame:
    """Per question: the retrieved documents in rank order and one string of their passages.

    A question has at most ``k`` documents, so each group is small.
    """
    doc = F.col("document")
    line = passage(doc.page_content, F.try_element_at(doc.metadata, F.lit(uri)), template)
    ordered = F.array_sort(F.collect_list(F.struct("rank", line.alias("line"), doc.alias("document"))),
                           lambda a, b: a["rank"] - b["rank"])
    return documents.groupBy("qid").agg(ordered.alias("_d")).select(
        "qid",
        F.array_join(F.transform("_d", lambda d: d.line), "").alias("context"),
        F.transform("_d", lambda d: d.document).alias("documents"),
    )


def card(document: Column) -> Column:
    """Display text of a document; a missing field reads Unknown."""
    field = lambda name: F.coalesce(F.try_element_at(document.metadata, F.lit(name)), F.lit("Unknown"))
    return templates.fill(
        templates.CARD,
        filename=field("filename"),
        chunk_type=field("chunk_type"),
        id=F.coalesce(document.id, F.lit("Unknown")),
        page_content=document.page_content,
    )


def joined_cards(documents: Column) -> Column:
    return F.array_join(F.transform(documents, card), templates.CARD_RULE)


def rewritten_notice(question: Column) -> Column:
    return templates.fill(templates.REWRITTEN, question=question)


# --- generation -----------------------------------------------------------------------------------


def _prompt(system: Column, messages: Column) -> Column:
    first = F.array(F.struct(F.lit("system").alias("role"), system.alias("content")))
    return F.concat(first, as_request(messages))


def _asking(question: Column) -> Column:
    return F.array(F.struct(F.lit("user").alias("role"), question.alias("content")))


def simple_prompt(question: Column) -> Column:
    return _prompt(F.lit(templates.CHAT_SYSTEM), _asking(question))


def context_prompt(question: Column, context: Column) -> Column:
    """An absent context counts as empty."""
    return _prompt(templates.fill(templates.CONTEXT_SYSTEM, context=context), _asking(question))


def rephrase_prompt(messages: Column) -> Column:
    return _prompt(F.lit(templates.REPHRASE_SYSTEM), messages)


def generate(
    rows: DataFrame,
    prompt: Column,
    factory: ModelFactory,
    role: str = "assistant",
    retry: Retry = Retry(),
) -> DataFrame:
    """Send ``prompt`` as JSON and append the reply to ``messages`` under ``role``.

    With role ``user`` the reply becomes the next last question (a rephrased one).
    A failed call appends nothing and leaves its message in ``error``. A null
    prompt is not sent; reply and error are then null, and nothing is appended.
    """
    asked = rows.withColumn("_r", model_reply(F.when(prompt.isNotNull(), F.to_json(prompt)), factory, retry))
    return (
        asked.withColumn("reply", F.col("_r.text"))
        .withColumn("error", F.col("_r.error"))
        .withColumn(
            "messages",
            F.when(F.col("error").isNull() & F.col("reply").isNotNull(), appended(F.col("messages"), role, F.col("reply"))).otherwise(F.col("messages")),
        )
        .drop("_r")
    )
