"""From conversations to answers: retrieve, assemble the context, generate, respond."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumflow.functions import templates
from vellumflow.operators import chat
from vellumflow.operators.cells import cell_hits
from vellumflow.operators.embed import EmbedderFactory, embed
from vellumflow.operators.models import ModelFactory, Retry
from vellumflow.operators.retrieve import as_documents, exact_hits, with_rows
from vellumflow.session import settled


@dataclass(frozen=True)
class Retriever:
    """How to search: ``exact`` scores every row, ``ann`` the rows of the nearest cells."""

    k: int = 5
    query_type: str = "exact"
    score_threshold: float = 0.0
    probes: int = 8
    text: str = "text"
    uri: str = "filename"
    key: str = "id"
    others: tuple[str, ...] = ()
    template: str = templates.PASSAGE
    score_digits: int = 9

    @property
    def columns(self) -> list[str]:
        """Text, uri, key, then the others."""
        return [self.text, self.uri, self.key, *self.others]


@dataclass(frozen=True)
class Cells:
    """A cell table and its pivots, for ``query_type`` ``ann``."""

    table: DataFrame
    pivots: DataFrame


def find_documents(
    questions: DataFrame,
    corpus: DataFrame,
    embedder: EmbedderFactory,
    how: Retriever = Retriever(),
    where: Column | None = None,
    cells: Cells | None = None,
    rows: DataFrame | None = None,
) -> DataFrame:
    """Documents for each ``(qid, question)``: ``(qid, rank, document)``.

    ``corpus`` is the embedded table. The other columns of the hits come from
    it, or from ``rows`` where vectors are kept apart from texts.
    """
    asked = settled(embed(questions.select("qid", "question"), embedder, "question").select("qid", "embedding"))
    if how.query_type == "ann":
        if cells is None:
            raise ValueError("query type ann needs a cell table")
        if where is not None:
            kept = corpus.where(where).select(F.col(how.key).alias("id"))
            cells = Cells(cells.table.join(kept, "id", "left_semi"), cells.pivots)
        hits = cell_hits(asked, cells.table, cells.pivots, how.k, how.probes, how.score_threshold)
    else:
        hits = exact_hits(asked, corpus, how.k, how.score_threshold, where, id_col=how.key)
    scored = hits.withColumn("score", F.round("score", how.score_digits))
    wanted = [how.text, how.uri, *how.others]
    found = with_rows(scored, rows if rows is not None else corpus, wanted, how.key)
    return as_documents(found, how.text, "id", [how.uri, *how.others])


def answer_chats(
    chats: DataFrame,
    corpus: DataFrame,
    embedder: EmbedderFactory,
    model: ModelFactory,
    how: Retriever = Retriever(),
    rephraser: ModelFactory | None = None,
    retry: Retry = Retry(),
    **search,
) -> DataFrame:
    """Answer every conversation ``(conv_id, messages)`` from its last user message.

    With a rephraser the question is first put in the light of the history. Adds
    ``question, context, documents, reply, error, response``. A conversation
    without a user message is kept, with a null question and nothing retrieved,
    and no model is asked. Where the model failed, or was not asked, the response
    holds no content, ``error`` says why, and all messages stay in the history.
    """
    if rephraser is not None:
        chats = chat.generate(chats, chat.rephrase_prompt(F.col("messages")), rephraser, "user", retry)
        # Rephrased questions are read by the search and by the prompt; the model is asked once.
        chats = settled(chats.drop("reply", "error"))
    last = F.filter("messages", lambda m: m.role.isin("user", "human"))
    asked = chats.withColumn("question", F.try_element_at(last, F.lit(-1)).content)
    questions = asked.where(F.col("question").isNotNull()).select(F.col("conv_id").alias("qid"), "question")
    documents = find_documents(questions, corpus, embedder, how, **search)
    found = chat.contexts(documents, how.uri, how.template).withColumnRenamed("qid", "conv_id")
    joined = asked.join(found, "conv_id", "left")
    prompt = F.when(F.col("question").isNotNull(), chat.context_prompt(F.col("question"), F.col("context")))
    # The reply is read by several columns; the model is asked once.
    done = settled(chat.generate(joined, prompt, model, "assistant", retry))
    parts = chat.answer_and_history(done, "context", F.col("error").isNull() & F.col("reply").isNotNull())
    return parts.withColumn("response", chat.response(F.col("answer"), F.col("history"), F.col("documents"))).drop(
        "answer", "history"
    )
