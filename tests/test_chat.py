import json

import pytest
from pyspark.sql import functions as F

from vellumflow.functions import templates
from vellumflow.operators import chat, graph, rounds


@pytest.fixture(scope="module")
def messages(spark):
    return spark.createDataFrame(
        [
            (1, 0, "assistant", "hello"),
            (2, 0, "user", "only this"),
            (3, 0, "system", "be kind"),
            (3, 2, "human", "second"),
            (3, 1, "user", "first"),
            (3, 3, "assistant", "answer"),
            (4, 0, "user", None),
        ],
        "conv_id long, turn long, role string, content string",
    )


def test_last_user_message(messages):
    got = {r.conv_id: (r.turn, r.question, r.has_question) for r in chat.last_user_message(messages).collect()}
    assert got == {1: (None, None, False), 2: (0, "only this", True), 3: (2, "second", True), 4: (0, None, True)}


def test_histories(messages):
    chats = chat.conversations(chat.normalised(messages))
    parts = {r.conv_id: r for r in chat.answer_and_history(chats).collect()}
    assert parts[3].answer == "answer"
    assert [(m.role, m.content) for m in parts[3].history] == [("system", "be kind"), ("user", "first"), ("user", "second")]
    assert parts[2].history == [] and parts[2].answer == "only this"
    tool = chat.answer_and_history(chats.withColumn("context", F.lit("ctx")), "context").where("conv_id = 2").first()
    assert [(m.role, m.content) for m in tool.history] == [("tool", "ctx")]


def test_responses(messages):
    chats = chat.answer_and_history(chat.conversations(messages)).withColumn("docs", F.array(F.lit("d")))
    forms = {}
    for always in (True, False):
        made = chat.response(F.col("answer"), F.col("history"), F.col("docs"), always_documents=always)
        forms[always] = {r.conv_id: json.loads(r.r) for r in chats.select("conv_id", F.to_json(made).alias("r")).collect()}
    assert forms[True][2]["custom_outputs"] == {"message_history": [], "documents": ["d"]}
    assert "custom_outputs" not in forms[False][2] and "custom_outputs" in forms[False][3]
    assert forms[True][3]["choices"] == [{"message": {"role": "assistant", "content": "answer"}}]


def test_append(messages):
    new = messages.sparkSession.createDataFrame([(3, "user", "more"), (9, "user", "hi")], "conv_id long, role string, content string")
    got = {(r.conv_id, r.turn) for r in chat.append_rows(messages, new).where("content in ('more', 'hi')").collect()}
    assert got == {(3, 4), (9, 0)}


def test_prompts(spark):
    row = spark.range(1).select(
        chat.context_prompt(F.lit("q?"), F.lit(None).cast("string")).alias("c"), chat.simple_prompt(F.lit("q?")).alias("s")
    ).first()
    assert row.c[0].content == templates.CONTEXT_SYSTEM.replace("{context}", "") and row.c[1].role == "user"
    assert row.s[0].content == templates.CHAT_SYSTEM


def test_generation_errors_append_nothing(messages):
    def broken():
        def call(prompts):
            raise RuntimeError("down")

        return call

    chats = chat.conversations(messages)
    done = chat.generate(chats, chat.rephrase_prompt(F.col("messages")), broken)
    assert all(r.error == "RuntimeError: down" and r.reply == "" for r in done.collect())
    assert done.where(F.size("messages") == 4).count() == 1


def test_contexts_in_rank_order(spark):
    rows = spark.createDataFrame(
        [(1, 2, ("b", "two", {"filename": "f2"})), (1, 1, ("a", "one", {"filename": "f1"})), (2, 1, ("c", "x", {}))],
        "qid int, rank int, document struct<id:string,page_content:string,metadata:map<string,string>>",
    )
    got = {r.qid: r for r in chat.contexts(rows).collect()}
    assert got[1].context == "Passage: one\n Document URI: f1\nPassage: two\n Document URI: f2\n"
    card = chat.contexts(rows).select(chat.joined_cards(F.col("documents")).alias("c"), "qid").where("qid = 2").first().c
    assert "Source: Unknown\nType: Unknown\nID: c\n\nContent:\nx\n" in card


def test_tool_rounds(spark):
    """Chat n wants n searches; every chat comes out, with an answer or an error."""

    def model():
        def decide(prompts):
            out = []
            for prompt in prompts:
                talk = json.loads(prompt)
                wanted, had = int(talk[0]["content"]), sum(m["role"] == "tool" for m in talk)
                if wanted == 99:
                    raise ValueError("broken chat")
                if had >= wanted:
                    out.append(json.dumps({"content": f"done after {had}"}))
                else:
                    name = "missing" if wanted == 50 else "echo"
                    calls = [{"id": str(i), "function": {"name": name, "arguments": f'{{"n":{i}}}'}} for i in range(2)]
                    out.append(json.dumps({"tool_calls": calls}))
            return out

        return decide

    chats = spark.createDataFrame(
        [(i, [("user", str(i))]) for i in (0, 1, 2, 3, 4, 8, 50, 99)],
        "conv_id long, messages array<struct<role:string,content:string>>",
    )
    echo = lambda calls: calls.select("conv_id", "call_no", F.concat(F.lit("got "), "arguments").alias("result"))
    done = {r.conv_id: r for r in rounds.tool_rounds(chats, model, {"echo": echo}, max_rounds=3).collect()}
    assert {k: (r.answer, r.rounds, r.error) for k, r in done.items()} == {
        0: ("done after 0", 1, None),
        1: ("done after 2", 2, None),
        2: ("done after 2", 2, None),
        3: ("done after 4", 3, None),
        4: ("done after 4", 3, None),
        8: (None, 3, "max iter reached"),
        50: (None, 1, "unknown tool"),
        99: (None, 1, "ValueError: broken chat"),
    }
    assert [m.content for m in done[1].messages if m.role == "tool"] == ['got {"n":0}', 'got {"n":1}']


def test_graph(spark):
    node = "struct<id:string,label:string,type:string,properties:map<string,string>>"
    rows = spark.createDataFrame(
        [(("a", "A", "t", {"k": "v"}), "is_a", ("b", "B", "t", None)), (("a", "A", "t", {"k": "v"}), "likes", ("b", "B", "t", None))],
        f"subject {node}, predicate string, object {node}",
    )
    assert {(r.id, r.label) for r in graph.graph_nodes(rows).collect()} == {("a", "A"), ("b", "B")}
    assert {(r.predicate, r.known_predicate) for r in graph.graph_edges(rows).collect()} == {("is_a", True), ("likes", False)}


def test_answers_with_rephrasing_and_cells(spark):
    from vellumflow.functions import stubs
    from vellumflow.operators import answer, cells, embed

    rows = spark.createDataFrame([(i, w * 3, f"{w}.txt") for i, w in enumerate(["aaa", "bbb", "ccc", "abc"])], "id long, text string, filename string")
    corpus = embed.embed(rows, stubs.letter_embedder).cache()
    chats = spark.createDataFrame(
        [(1, [("user", "bb")]), (2, [("assistant", "no question")]), (3, [("user", "c"), ("assistant", "x"), ("user", "a")])],
        "conv_id long, messages array<struct<role:string,content:string>>",
    )
    how = answer.Retriever(k=1)
    done = {r.conv_id: r for r in answer.answer_chats(chats, corpus, stubs.letter_embedder, stubs.prompt_echo, how).collect()}
    assert [d.page_content for d in done[1].documents] == ["bbbbbbbbb"] and done[1].context.startswith("Passage: bbb")
    assert done[2].question is None and done[2].documents is None
    assert [d.page_content for d in done[3].documents] == ["aaaaaaaaa"]
    assert done[1].response.choices[0].message.content.startswith("So, yeah. 2 messages")
    assert [m.role for m in done[3].response.custom_outputs.message_history] == ["user", "assistant", "user", "tool"]
    pivots = cells.choose_pivots(corpus, 4)
    near = answer.Cells(cells.cell_table(corpus, pivots), pivots)
    questions = spark.createDataFrame([(1, "bb"), (2, "cc")], "qid long, question string")
    ann = answer.find_documents(questions, corpus, stubs.letter_embedder, answer.Retriever(k=1, query_type="ann", probes=2), cells=near)
    assert {(r.qid, r.document.page_content) for r in ann.collect()} == {(1, "bbbbbbbbb"), (2, "ccccccccc")}
    only = answer.find_documents(questions, corpus, stubs.letter_embedder, how, where=F.col("filename") == "abc.txt")
    assert {r.document.id for r in only.collect()} == {"3"}
    to_b = lambda: lambda prompts: ["b" for _ in prompts]
    turned = answer.answer_chats(chats, corpus, stubs.letter_embedder, stubs.prompt_echo, how, rephraser=to_b)
    assert {r.question for r in turned.collect()} == {"b"}


def test_rate_limited_model_is_not_asked_row_by_row():
    from vellumflow.operators.models import RateLimited, Retry, _answer

    calls = []

    def model(inputs):
        calls.append(len(inputs))
        raise RateLimited("later")

    got = _answer(model, Retry(attempts=3, sleep=lambda s: None), ["a"] * 50, most=20)
    assert calls == [20, 20, 20] and len(got) == 50 and all(e for _, e in got)


def test_wrong_number_of_replies_is_an_error():
    from vellumflow.operators.models import Retry, _answer

    got = _answer(lambda inputs: ["x"] if len(inputs) == 1 else ["x"], Retry(), ["a", "b", "c"])
    assert got == [("x", None)] * 3
    assert all("replies" in e for _, e in _answer(lambda inputs: [], Retry(), ["a", "b"]))


def test_several_new_messages_get_turns_of_their_own(spark):
    from vellumflow.operators import chat

    old = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, content string")
    new = spark.createDataFrame([(1, 2, "assistant", "z"), (1, 1, "user", "b"), (2, 1, "user", "c")], "conv_id long, position int, role string, content string")
    got = sorted((r["conv_id"], r["turn"], r["content"]) for r in chat.append_rows(old, new).collect())
    assert got == [(1, 0, "a"), (1, 1, "b"), (1, 2, "z"), (2, 0, "c")]


def test_unfinished_critique_is_marked(spark):
    from vellumflow.operators import rounds

    chats = spark.createDataFrame([(1, [("user", "hi")]), (2, [("user", "x")] * 5)], "conv_id long, messages array<struct<role:string,content:string>>")
    writer = lambda: lambda prompts: ["draft"] * len(prompts)
    got = {r["conv_id"]: r["error"] for r in rounds.critique_rounds(chats, writer, writer, stop_above=5, max_rounds=2).collect()}
    assert got == {1: rounds.NOT_ENDED, 2: None}
