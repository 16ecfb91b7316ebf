"""Replies in rounds: refusals, budgets, and what rows may hold."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from vellumflow.operators.deferred import Rounds, replies
from vellumflow.operators.models import RateLimited


class Time:
    """A clock that only moves when someone waits."""

    def __init__(self):
        self.now, self.waits = 1000.0, []

    def sleep(self, seconds):
        self.waits.append(round(seconds, 6))
        self.now += seconds


def refusing_once(folder, every):
    """Refuses each call that holds an input divisible by ``every`` which was not asked before."""

    def factory():
        def call(texts):
            new = [t for t in texts if int(t) % every == 0 and not os.path.exists(f"{folder}/{t}")]
            for t in new:
                open(f"{folder}/{t}", "w").close()
            if new:
                raise RateLimited("later")
            return [f"<{t}>" for t in texts]

        return call

    return factory


def numbers(spark, n):
    return spark.range(n).select("id", F.col("id").cast("string").alias("t")).repartition(4)


def test_refused_rows_come_back(spark, tmp_path):
    clock = Time()
    plan = Rounds(first_wait=2.0, clock=lambda: clock.now, sleep=clock.sleep)
    got = replies(numbers(spark, 400), F.col("t"), refusing_once(tmp_path, 20), plan, most=1).collect()
    assert {r["id"]: (r["reply"]["text"], r["reply"]["error"]) for r in got} == {i: (f"<{i}>", None) for i in range(400)}
    # tasks that were refused three times in a row hold back the rest, so at least the refused ones need a second attempt
    assert {r["id"] for r in got if r["attempts"] == 1}.isdisjoint(range(0, 400, 20)) and len(got) == 400
    assert clock.waits[0] == 2.0 and max(r["attempts"] for r in got) <= 6


def test_always_refused(spark):
    def factory():
        def call(texts):
            raise RateLimited("never")

        return call

    clock = Time()
    plan = Rounds(attempts=3, first_wait=1.0, clock=lambda: clock.now, sleep=clock.sleep)
    got = replies(numbers(spark, 50), F.col("t"), factory, plan, most=4).collect()
    assert len(got) == 50 and {(r["reply"]["text"], r["reply"]["error"], r["attempts"], r["round"]) for r in got} == {("", "RateLimited: never", 3, 3)}
    assert clock.waits == [1.0, 2.0]


def test_one_budget_over_all_tasks(spark, tmp_path):
    folder = tmp_path / str(uuid.uuid4())
    folder.mkdir()
    got = replies(numbers(spark, 200), F.col("t"), refusing_once(folder, 1000), Rounds(first_wait=0.0, per_round=30, tasks=4), most=8).collect()
    rounds = {}
    for r in got:
        rounds[r["round"]] = rounds.get(r["round"], 0) + 1
    assert sorted(r["id"] for r in got) == list(range(200)) and max(rounds.values()) <= 30
    assert all(r["reply"]["text"] == f"<{r['id']}>" for r in got)


def test_odd_rows(spark):
    def picky():
        def call(texts):
            if "bad" in texts:
                raise ValueError("no")
            return [t.upper() for t in texts]

        return call

    rows = spark.createDataFrame([(1, "a", 7), (1, "a", 7), (2, "bad", 7), (None, None, 7), (4, "", 7)], "id int, t string, reply int").coalesce(1)
    rows = rows.selectExpr("*", "1 as round", "2 as attempts", "3 as input", "4 as row", "5 as again", "6 as `due.x`")
    got = replies(rows, F.col("t"), picky)
    assert got.columns == ["id", "t", "input", "row", "again", "due.x", "reply", "attempts", "round"]
    found = sorted(((r["id"], r["reply"]["text"], r["reply"]["error"], r["attempts"]) for r in got.collect()), key=repr)
    assert found == sorted([(1, "A", None, 1), (1, "A", None, 1), (2, "", "ValueError: no", 1), (None, None, None, 0), (4, "", None, 1)], key=repr)
    assert replies(rows.limit(0), F.col("t"), picky).count() == 0
    with pytest.raises(ValueError):
        replies(rows, F.col("t"), picky, Rounds(attempts=0))
