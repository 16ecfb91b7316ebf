"""Model calls in rounds: a refused row waits as data with a due time, not in a sleeping task."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellumflow.operators.models import CALL_INPUTS, ModelFactory, RateLimited, Retry, _replies
from vellumflow.session import new_folder

# What became of a row in a round.
ANSWERED, REFUSED, LEFT = "answered", "refused", "left"
OUTCOME = "struct<text:string,error:string,state:string>"


@dataclass(frozen=True)
class Rounds:
    """How often and how fast a model is asked.

    A row is asked at most ``attempts`` times, after waits that double from
    ``first_wait`` seconds. ``per_round`` bounds the rows sent in one round over
    all tasks: each of ``tasks`` tasks has its share. A task that is refused
    ``patience`` times in a row sends nothing more in that round.
    """

    attempts: int = 6
    first_wait: float = 1.0
    per_round: int | None = None
    tasks: int | None = None
    patience: int = 3
    clock: Callable[[], float] = time.time
    sleep: Callable[[float], None] = time.sleep


def _asked(factory: ModelFactory, share: int | None, patience: int, most: int):
    once = Retry(attempts=1)

    @F.pandas_udf(OUTCOME)
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        model, left, refused, limit = factory(), share, 0, ""
        for inputs, due in batches:
            out = pd.DataFrame({"text": None, "error": None, "state": ANSWERED}, index=range(len(inputs)), dtype=object)
            wanted = (inputs.notna() & due).to_numpy().nonzero()[0]
            out.loc[(inputs.notna() & ~due).to_numpy(), "state"] = LEFT
            for a in range(0, len(wanted), most):
                part = wanted[a : a + most]
                sent = part if left is None else part[:left]
                out.loc[part[len(sent) :], "state"] = LEFT
                if not len(sent):
                    continue
                left = None if left is None else left - len(sent)
                if refused < patience:
                    try:
                        replies = _replies(model, once, inputs.iloc[sent].tolist())
                        out.loc[sent, "text"] = [t for t, _ in replies]
                        out.loc[sent, "error"] = [e for _, e in replies]
                        refused = 0
                        continue
                    except RateLimited as failed:
                        refused, limit = refused + 1, f"{type(failed).__name__}: {failed}"
                out.loc[sent, "state"] = REFUSED
                out.loc[sent, "error"] = limit
            yield out

    return run.asNondeterministic()


def replies(rows: DataFrame, inputs: Column, factory: ModelFactory, plan: Rounds = Rounds(), most: int = CALL_INPUTS, into: str = "reply") -> DataFrame:
    """``rows`` with ``into`` (text, error), the ``attempts`` it took and the ``round`` that ended it.

    Each round is one job over the rows still open. It writes a folder of the
    shared directory: what is answered stays there, and what was refused is read
    again once it is due; the driver waits, tasks never do. Rows do not move but
    where a budget deals them to its tasks, and a round's folder cuts the lineage,
    so a lost executor costs calls of its own round only.

    A null input is not sent and gives null fields after no attempt. Any other
    error costs only its own row. Rows still refused at the last attempt get an
    empty text and the error. Equal rows are asked one by one. Columns named like
    the new ones are replaced. No rows: no rows.
    """
    if plan.attempts < 1 or plan.per_round is not None and plan.per_round < 1:
        raise ValueError("attempts and per_round must be at least 1")
    spark = rows.sparkSession
    share = tasks = None
    if plan.per_round is not None:
        tasks = min(plan.per_round, plan.tasks or spark.sparkContext.defaultParallelism)
        share = plan.per_round // tasks
    taken = {into.lower(), "attempts", "round"}
    kept = [F.col(f"`{c}`") for c in rows.columns if c.lower() not in taken]
    todo = rows.select(F.struct(*kept, F.lit(0).alias("__")).alias("row"), inputs.cast("string").alias("input"), F.lit(0).alias("tried"), F.lit(0.0).alias("due"))
    path, number = new_folder(spark, "rounds"), 0
    ask = _asked(factory, share, plan.patience, most)
    while True:
        number += 1
        now = plan.clock()
        if tasks is not None:
            todo = todo.repartition(tasks, F.xxhash64("input", F.to_json("row")))
        told = todo.withColumn("said", ask(F.col("input"), F.col("due") <= F.lit(now)))
        tried = F.col("tried") + F.when(F.col("input").isNull() | (F.col("said.state") == LEFT), 0).otherwise(1)
        again = (F.col("said.state") == LEFT) | (F.col("said.state") == REFUSED) & (tried < plan.attempts)
        due = F.when(F.col("said.state") == LEFT, F.col("due")).otherwise(F.lit(now) + plan.first_wait * F.pow(F.lit(2.0), tried - 1))
        text = F.when((F.col("said.state") == REFUSED), F.lit("")).otherwise(F.col("said.text"))
        done = told.select(
            "row", F.when(again, F.col("input")).alias("input"), tried.alias("tried"), due.alias("due"),
            F.struct(text.alias("text"), F.col("said.error").alias("error")).alias("answer"), again.alias("again"),
        )
        here = f"{path}/round={number}"
        done.write.parquet(here)
        waiting = spark.read.schema(done.schema).parquet(here).where("again")
        first = waiting.agg(F.min("due")).first()[0]
        if first is None:
            schema = T.StructType([*done.schema.fields, T.StructField("round", T.IntegerType())])
            ended = spark.read.schema(schema).option("basePath", path).parquet(path).where(~F.col("again"))
            return ended.select("row.*", F.col("answer").alias(into), F.col("tried").alias("attempts"), "round").drop("__")
        if first > plan.clock():
            plan.sleep(first - plan.clock())
        todo = waiting.select("row", "input", "tried", "due")
