"""Bounded rounds of model calls over a whole table of conversations.

Every round is one Spark job over the conversations still open. Its result is
checkpointed, so neither lineage nor the number of model calls grows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumflow.operators.chat import MESSAGES, appended
from vellumflow.operators.models import ModelFactory, Retry, model_reply
from vellumflow.session import settled

# A reply either holds ``content`` or asks for tools.
DECISION = (
    "struct<content:string,tool_calls:array<struct<id:string,function:struct<name:string,arguments:string>>>>"
)
LIMIT_REACHED = "max iter reached"
# Messages of these rounds: an answer to a call carries the id of the call.
TOLD = "array<struct<role:string,content:string,tool_call_id:string>>"
NO_RESULT = "null"



def _no_id() -> Column:
    return F.lit(None).cast("string").alias("tool_call_id")


# A tool takes calls ``(conv_id, call_no, arguments)`` and returns ``(conv_id, call_no, result)``, result as JSON.
Tool = Callable[[DataFrame], DataFrame]


def tool_rounds(
    chats: DataFrame,
    factory: ModelFactory,
    tools: dict[str, Tool],
    max_rounds: int = 10,
    retry: Retry = Retry(),
) -> DataFrame:
    """Let the model answer or call tools, at most ``max_rounds`` times.

    ``chats`` is ``(conv_id, messages)``. Returns ``(conv_id, messages, answer,
    rounds, error)``; one row for every conversation, finished or not.
    """
    given = F.transform(F.col("messages").cast(MESSAGES), lambda m: F.struct(m.role.alias("role"), m.content.alias("content"), _no_id()))
    pending = settled(chats.select("conv_id", given.alias("messages")))
    done: list[DataFrame] = []
    for number in range(1, max_rounds + 1):
        replied = pending.withColumn("_r", model_reply(F.to_json("messages"), factory, retry))
        decided = settled(
            replied.withColumn("_d", F.from_json("_r.text", DECISION)).select(
                "conv_id",
                "messages",
                F.col("_r.error").alias("error"),
                F.col("_d.content").alias("content"),
                F.coalesce("_d.tool_calls", F.array().cast("array<struct<id:string,function:struct<name:string,arguments:string>>>")).alias("calls"),
            )
        )
        failed = F.col("error").isNotNull()
        unknown = F.exists("calls", lambda c: F.coalesce(~c.function["name"].isin(*tools), F.lit(True)))
        finished = failed | (F.size("calls") == 0) | unknown
        wrong = F.when(unknown & ~failed, F.lit("unknown tool")).otherwise(F.col("error"))
        answered = F.when(wrong.isNull(), F.col("content"))
        done.append(
            decided.where(finished).select(
                "conv_id",
                F.when(
                    wrong.isNull(),
                    F.concat("messages", F.array(F.struct(F.lit("assistant").alias("role"), F.col("content"), _no_id()))),
                )
                .otherwise(F.col("messages"))
                .alias("messages"),
                answered.alias("answer"),
                F.lit(number).alias("rounds"),
                wrong.alias("error"),
            )
        )
        open_chats = decided.where(~finished)
        if open_chats.isEmpty():
            return _all(done)
        calls = open_chats.select("conv_id", F.posexplode("calls").alias("call_no", "call"))
        results = None
        for name, tool in tools.items():
            mine = calls.where(F.col("call.function.name") == name).select(
                "conv_id", "call_no", F.col("call.function.arguments").alias("arguments")
            )
            got = tool(mine).select("conv_id", "call_no", "result")
            results = got if results is None else results.unionByName(got)
        # A conversation makes a handful of calls per round.
        # Each call gets a message under its id, also one to which no tool returned a row.
        told = calls.join(results, ["conv_id", "call_no"], "left")
        answers = told.groupBy("conv_id").agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("call_no", F.coalesce("result", F.lit(NO_RESULT)).alias("result"), F.col("call.id").alias("id")))),
                lambda r: F.struct(F.lit("tool").alias("role"), r.result.alias("content"), r.id.alias("tool_call_id")),
            ).alias("_tools")
        )
        asked = F.struct(F.lit("assistant").alias("role"), F.to_json("calls").alias("content"), _no_id())
        pending = settled(
            open_chats.join(answers, "conv_id", "left").select(
                "conv_id",
                F.concat("messages", F.array(asked), F.coalesce("_tools", F.array().cast(TOLD))).alias("messages"),
            )
        )
    left_over = pending.select(
        "conv_id",
        "messages",
        F.lit(None).cast("string").alias("answer"),
        F.lit(max_rounds).alias("rounds"),
        F.lit(LIMIT_REACHED).alias("error"),
    )
    return _all([*done, left_over])


def _all(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


NOT_ENDED = "not ended"


def critique_rounds(
    chats: DataFrame,
    writer: ModelFactory,
    critic: ModelFactory,
    stop_above: int = 7,
    max_rounds: int = 10,
    retry: Retry = Retry(),
) -> DataFrame:
    """Write, then criticise, until a conversation has more than ``stop_above`` messages.

    The writer sees all messages; the critic sees the last one and speaks as a user.
    Adds ``rounds`` and ``error``: a failed call ends its conversation as it then
    stands, and what is still open after ``max_rounds`` is marked as not ended.
    """
    pending = settled(chats.select("conv_id", F.col("messages").cast(MESSAGES).alias("messages")))
    done: list[DataFrame] = []
    for number in range(1, max_rounds + 1):
        written = settled(_said(pending, F.to_json("messages"), writer, "assistant", retry))
        ended = (F.size("messages") > stop_above) | F.col("error").isNotNull()
        done.append(written.where(ended).withColumn("rounds", F.lit(number)))
        open_chats = written.where(~ended).drop("error")
        if open_chats.isEmpty():
            return _all(done)
        if number == max_rounds:
            left_over = open_chats.withColumn("error", F.lit(NOT_ENDED)).withColumn("rounds", F.lit(number))
            return _all([*done, left_over])
        criticised = settled(_said(open_chats, F.element_at("messages", -1).content, critic, "user", retry))
        done.append(criticised.where("error IS NOT NULL").withColumn("rounds", F.lit(number)))
        pending = criticised.where("error IS NULL").drop("error")
    raise ValueError("max_rounds must be at least 1")


def _said(chats: DataFrame, prompt: Column, factory: ModelFactory, role: str, retry: Retry) -> DataFrame:
    """The conversations with a reply appended under ``role``, or with the error of the call."""
    replied = chats.withColumn("_r", model_reply(prompt, factory, retry))
    ok = F.col("_r.error").isNull()
    text = F.coalesce("_r.text", F.lit(""))
    return replied.select(
        "conv_id",
        F.when(ok, appended(F.col("messages"), role, text)).otherwise(F.col("messages")).alias("messages"),
        F.col("_r.error").alias("error"),
    )
