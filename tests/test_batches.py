"""Of a batch of rows only a few are Python objects at a time, whatever the size of the batch."""

import pyarrow as pa
from pyspark.sql import functions as F

from vellumflow.operators import embed, highlight, models


def test_embedder_is_given_bounded_lists(spark):
    def sizes():
        return lambda texts: [[len(texts), len(t)] for t in texts]

    text = F.when(F.col("id") % 3 > 0, F.concat(F.lit("é"), F.col("id")))
    got = spark.range(2000, numPartitions=1).select("id", embed.embedding(text, sizes).alias("y")).collect()
    assert all((r.y is None) == (r.id % 3 == 0) for r in got)
    assert max(r.y[0] for r in got if r.y) <= embed.CALL_TEXTS
    assert all(r.y[1] == len(f"é{r.id}") for r in got if r.y)


def test_embedder_of_nothing(spark):
    def sizes():
        return lambda texts: [[len(t)] for t in texts]

    nulls = spark.range(3, numPartitions=1).select(embed.embedding(F.lit(None).cast("string"), sizes).alias("y"))
    assert [r.y for r in nulls.collect()] == [None] * 3
    assert spark.range(0).select(embed.embedding(F.lit("a"), sizes).alias("y")).collect() == []


def test_replies_keep_their_rows(spark):
    def shout():
        return lambda texts: [t.upper() for t in texts]

    text = F.when(F.col("id") % 3 > 0, F.concat(F.lit("é"), F.col("id")))
    rows = spark.range(700, numPartitions=1)
    got = rows.select("id", models.model_reply(text, shout).alias("y")).collect()
    assert all(tuple(r.y) == ((f"É{r.id}" if r.id % 3 else None), None) for r in got)
    many = F.when(F.col("id") % 3 > 0, F.transform(F.sequence(F.lit(1), F.col("id") % 3), lambda n: F.concat(F.lit("é"), n)))
    got = rows.select("id", models.model_replies(many, shout).alias("y")).collect()
    assert all([tuple(y) for y in r.y] == [(f"É{n}", None) for n in range(1, r.id % 3 + 1)] for r in got)


def test_words_become_objects_a_few_rows_at_a_time():
    seen = []
    batch = pa.array([["a", "b"], None, []] * 500, pa.list_(pa.string()))

    class Watched:
        def __len__(self):
            return len(batch)

        def slice(self, a, n):
            seen.append(n)
            return batch.slice(a, n)

    made = highlight._by_rows(lambda ws: None if ws is None else [w + w for w in ws], Watched())
    assert made.to_pylist() == [["aa", "bb"], None, []] * 500
    assert max(seen) <= highlight.ROWS and made.type == pa.list_(pa.string())
