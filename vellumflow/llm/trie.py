"""Prefix trie of conversations: equal sequences collapse first, then weighted prefixes are aggregated."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumflow.llm.common import fan_out, small_batches, whole, written

# Turns of one conversation that lie in one group of a join or window.
BLOCK = 4096
# Ids of one list lie in ranges of this many ids.
ID_BITS = 16
SHARED, EVERY = 6, 100
# A prefix is named by its depth and four sums over its turns, each of 32 bits of a hash of a turn and its place.
SUMS = ["s0", "s1", "s2", "s3"]
KEY = ["depth", *SUMS]
LOW = (1 << 32) - 1


@dataclass
class Trie:
    """``nodes``: one row per distinct prefix, named by KEY. ``ends``: KEY, range, sorted ids that end there. ``texts``: role and text by ``turn``."""

    nodes: DataFrame
    ends: DataFrame
    texts: DataFrame


def _bits(value: Column, high: bool) -> Column:
    return F.shiftrightunsigned(value, 32) if high else value.bitwiseAND(F.lit(LOW))


def _hashes(depth: Column, turn: Column) -> list[Column]:
    a, b = F.xxhash64(depth, turn), F.xxhash64(turn, depth, F.lit("b"))
    return [_bits(a, False).alias("s0"), _bits(a, True).alias("s1"), _bits(b, False).alias("s2"), _bits(b, True).alias("s3")]


def turn_digest(role: Column, text: Column) -> Column:
    return F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, role, text, turn, chars, place): null role and text are empty; ``place`` is null where the turn number is."""
    rows = conversations.where(F.col("conv_id").isNotNull())
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("place"), whole("role").alias("role"), whole("text").alias("text"))
    return rows.withColumn("turn", turn_digest(F.col("role"), F.col("text"))).withColumn("chars", F.char_length("text").cast("long"))


def numbered(rows: DataFrame) -> DataFrame:
    """(conv_id, p, turn, chars): every conversation's turns counted from 1 in their order.

    Rows are range partitioned by conversation and order, so a conversation of
    any length is spread. Only conversations that go on over a border of partitions need
    an offset, and there are at most two such rows for each partition.
    """
    order = ["place", "role", "head", "turn"]
    heads = rows.select("conv_id", "place", F.substring("role", 1, 64).alias("role"), F.substring("text", 1, 64).alias("head"), "turn", "chars")
    dealt = heads.withColumn("tie", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(fan_out(rows.sparkSession), "conv_id", *order, "tie").withColumn("part", F.spark_partition_id())
    at = F.row_number().over(Window.partitionBy("part", "conv_id").orderBy(*order))
    parts = written(dealt.withColumn("at", at).select("part", "conv_id", "at", "turn", "chars"), "turns")
    sizes = parts.groupBy("conv_id", "part").agg(F.max("at").cast("long").alias("n"))
    over = Window.partitionBy("conv_id")
    crossing = (
        sizes.withColumn("parts", F.count("*").over(over))
        .withColumn("before", F.sum("n").over(over.orderBy("part")) - F.col("n"))
        .where("parts > 1")
        .select("conv_id", "part", "before")
    )
    placed = parts.join(F.broadcast(crossing), ["conv_id", "part"], "left")
    return placed.select("conv_id", (F.col("at") + F.coalesce("before", F.lit(0))).alias("p"), "turn", "chars")


def _blocks(length: str) -> Column:
    """Every block that a conversation of so many turns can have rows in: joins are on id and block, so long ones are spread."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"{length} div {BLOCK}")))


def rebuilt(own: DataFrame, shared: int = SHARED, every: int = EVERY) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, length) and steps (conv_id, depth, turn, chars) after rebuilding.

    The first h = crc32(id) % ``shared`` turns come from the conversation
    ``id - id % every``, the others are the own ones behind the first h.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).alias("h")
    base = own.where((F.col("conv_id") % every == 0) & (F.col("p") < shared)).groupBy(F.col("conv_id").alias("base"))
    base = base.agg(F.sort_array(F.collect_list(F.struct("p", "turn", "chars"))).alias("first"))  # fewer than ``shared`` turns
    convs = own.groupBy("conv_id").agg(F.max("p").alias("n")).select("conv_id", "n", h, (F.col("conv_id") - F.col("conv_id") % every).alias("base"))
    convs = convs.join(base, "base", "left").withColumn("b", F.least("h", F.coalesce(F.size("first"), F.lit(0))))
    convs = written(
        convs.select(
            "conv_id", "n", "h", "b", (F.col("b") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"),
            F.when(F.col("b") > 0, F.slice("first", 1, F.col("b").cast("int"))).alias("first"),
        ),
        "conversations",
    )
    opening = convs.select("conv_id", F.posexplode("first").alias("i", "t"))
    opening = opening.select("conv_id", (F.col("i") + 1).cast("long").alias("depth"), "t.turn", "t.chars")
    shifts = convs.select("conv_id", "h", "b", _blocks("n").alias("block"))
    rest = own.withColumn("block", F.expr(f"p div {BLOCK}")).join(shifts, ["conv_id", "block"]).where("p > h")
    rest = rest.select("conv_id", (F.col("p") - F.col("h") + F.col("b")).alias("depth"), "turn", "chars")
    return convs.select("conv_id", "length"), opening.union(rest)


def prefixes(steps: DataFrame) -> DataFrame:
    """``steps`` with the name of the prefix that ends in each (KEY), that of the prefix before it (p0..p3), and the code points ``before`` it.

    Running sums within blocks, then totals of blocks for conversations that have several.
    """
    sums = [*SUMS, "chars"]
    hashed = steps.select("conv_id", "depth", F.expr(f"depth div {BLOCK}").alias("block"), "turn", "chars", *_hashes(F.col("depth"), F.col("turn")))
    upto = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    local = hashed.select("conv_id", "depth", "block", "turn", "chars", *(F.col(s).alias(f"e_{s}") for s in sums), *(F.sum(s).over(upto).alias(f"to_{s}") for s in sums))
    local = written(local, "steps")
    totals = local.where(F.col("block") >= 0).groupBy("conv_id", "block").agg(*(F.sum(f"e_{s}").alias(s) for s in sums))
    behind = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("conv_id", "block", *(F.sum(s).over(behind).alias(f"off_{s}") for s in sums)).where("block > 0")
    first = local.where("block = 0").select("*", *(F.lit(0).cast("long").alias(f"off_{s}") for s in sums))
    later = local.where("block > 0").join(offsets, ["conv_id", "block"]).select(*first.columns)
    end = lambda s: F.col(f"to_{s}") + F.coalesce(f"off_{s}", F.lit(0))
    return first.union(later).select(
        "conv_id", "block", "depth", "turn", "chars",
        *(end(s).alias(s) for s in SUMS),
        *((end(s) - F.col(f"e_{s}")).alias(f"p{i}") for i, s in enumerate(SUMS)),
        (end("chars") - F.col("chars")).alias("before"),
    )


def _parents(nodes: DataFrame, heads: DataFrame) -> DataFrame:
    """KEY of ``heads`` with the conv_id of their parents.

    Parents with more than a thousandth of all nodes as children, fewer than a thousand, are broadcast; a shuffle joins the others.
    """
    up = ["up_depth", *(f"p{i}" for i in range(4))]
    above = nodes.select(*(F.col(k).alias(u) for k, u in zip(KEY, up)), F.col("conv_id").alias("parent_conv_id"), "n_children")
    wide = F.col("n_children") > max(nodes.count() // 1000, 1)
    rows = heads.withColumn("up_depth", F.col("depth") - 1).select(*KEY, *up)
    met = rows.join(F.broadcast(above.where(wide).drop("n_children")), up, "left")
    others = met.where(F.col("parent_conv_id").isNull()).drop("parent_conv_id").join(above.where(~wide).drop("n_children"), up)
    return met.where(F.col("parent_conv_id").isNotNull()).select(*KEY, "parent_conv_id").union(others.select(*KEY, "parent_conv_id"))


def build(conversations: DataFrame, shared: int = SHARED, every: int = EVERY) -> Trie:
    """The trie of all rebuilt conversations.

    Each conversation is one sequence of (role, text). Equal whole sequences
    become one, with a weight and a list of the ids that end there. Sequences
    that are proper prefixes of others are found by an anti-join, the rest are
    leaves. Then every distinct sequence gives its prefixes, which are added up
    by name: weights to members, leaves to leaves. A node belongs to its
    smallest member, so along a sequence the nodes of its own are those below
    some depth, and what a subtree saves is the sum, over sequences through its
    top, of the code points at depths where they are not first.

    Nulls: rows of a null conv_id take no part; a null role or text is empty; a
    null turn comes first. Equal turns of a conversation are ordered by the first 64
    characters of role and text, then by digest; repeated rows are turns of their own.
    A conversation that ends up without turns ends at the root. An empty
    table has no nodes, not even a root. Other columns are not looked at.
    """
    rows = turns(conversations)
    convs, steps = rebuilt(numbered(rows), shared, every)
    paths = written(prefixes(steps), "prefixes")

    zero = [F.lit(0).cast("long").alias(c) for c in SUMS]
    last = paths.join(convs.select("conv_id", F.col("length").alias("depth"), F.expr(f"length div {BLOCK}").alias("block")), ["conv_id", "block", "depth"])
    last = last.select("conv_id", *KEY, (F.col("before") + F.col("chars")).alias("total"))
    turnless = convs.where("length = 0").select("conv_id", F.lit(0).cast("long").alias("depth"), *zero, F.lit(0).cast("long").alias("total"))
    last = written(last.union(turnless), "ends")
    sequences = last.groupBy(*KEY).agg(F.count("*").alias("weight"), F.min("conv_id").alias("conv_id"), F.max("total").alias("total"))
    sequences = written(sequences, "sequences")
    ends = last.groupBy(*KEY, F.shiftright("conv_id", ID_BITS).alias("range")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))

    # Prefixes of each distinct sequence once, through the conversation that stands for it.
    of = sequences.select("conv_id", "weight", "total", F.col("depth").alias("length"))
    spread = of.select("conv_id", "weight", "total", "length", _blocks("length").alias("block"))
    none = F.lit(None).cast("long")
    top = of.select("conv_id", "weight", "total", "length", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("string").alias("turn"), F.lit(0).cast("long").alias("chars"),
                    *zero, *(none.alias(f"p{i}") for i in range(4)), F.lit(0).cast("long").alias("before"))
    distinct = written(paths.join(spread, ["conv_id", "block"]).select(*top.columns).union(top), "distinct")
    nodes = distinct.groupBy(*KEY).agg(
        F.sum("weight").alias("n_convs"), F.min("conv_id").alias("conv_id"),
        *(F.max(c).alias(c) for c in ("turn", "chars", "before", "p0", "p1", "p2", "p3")),
    )
    nodes = written(nodes, "nodes")

    inner = distinct.where("depth < length").select(*KEY).distinct()
    leaves = sequences.join(inner, KEY, "left_anti").select(F.col("conv_id").alias("leaf"))
    firsts = nodes.groupBy("conv_id").agg(F.min(F.struct("depth", "before")).alias("first"))
    facts = sequences.join(firsts, "conv_id", "left").join(leaves, F.col("conv_id") == F.col("leaf"), "left")
    facts = facts.select(
        "conv_id", F.col("depth").alias("length"), F.col("leaf").isNotNull().cast("long").alias("is_leaf"), F.coalesce("first.before", "total").alias("not_first"),
    )
    facts = facts.select("conv_id", "is_leaf", "not_first", _blocks("length").alias("block"))
    saved = (F.col("weight") - 1) * (F.col("total") - F.col("before")) + F.greatest(F.col("not_first") - F.col("before"), F.lit(0))
    under = distinct.withColumn("block", F.expr(f"depth div {BLOCK}")).join(facts, ["conv_id", "block"])
    under = under.groupBy(*KEY).agg(F.sum("is_leaf").alias("n_leaves"), F.sum(saved).alias("saved_tokens"))
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), *(F.col(f"p{i}").alias(s) for i, s in enumerate(SUMS)))
    children = children.agg(F.count("*").alias("n_children"))
    nodes = nodes.join(under, KEY).join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = written(nodes, "nodes")

    # Only the first node of a run of nodes with the same smallest member has a parent of another one.
    run = nodes.groupBy("conv_id").agg(F.min("depth").alias("run_depth"))
    heads = nodes.join(run.where("run_depth > 0").select("conv_id", F.col("run_depth").alias("depth")), ["conv_id", "depth"])
    up = _parents(nodes, heads).withColumnRenamed("parent_conv_id", "up")
    parent = F.when(F.col("depth") > 0, F.coalesce("up", "conv_id"))
    nodes = nodes.join(up, KEY, "left").withColumn("parent_conv_id", parent)
    texts = rows.groupBy("turn").agg(F.min_by(F.struct("role", "text"), "conv_id").alias("t")).select("turn", "t.role", "t.text")
    return Trie(
        nodes.select(*KEY, "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "turn", "chars"), ends, texts
    )


def end_digests(ends: DataFrame) -> DataFrame:
    """KEY and the SHA-256 of each list of ids, joined by commas. Ranges of a list come one after another, so none is held whole."""
    small_batches(ends.sparkSession)
    sorted_ = ends.repartition(fan_out(ends.sparkSession), *KEY).sortWithinPartitions(*KEY, "range").select(*KEY, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, digest = None, None
        for batch in batches:
            done = []
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(len(KEY)))))
            for key, ids in zip(keys, batch.column(len(KEY))):
                part = ",".join(map(str, ids.as_py())).encode()
                if key == held:
                    digest.update(b"," + part)
                    continue
                if held is not None:
                    done.append((*held, digest.hexdigest()))
                held, digest = key, hashlib.sha256(part)
            yield table(done)
        if held is not None:
            yield table([(*held, digest.hexdigest())])

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * (len(KEY) + 1)
        kinds = [pa.int64()] * len(KEY) + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[*KEY, "ends_sha256"])

    return sorted_.mapInArrow(run, ", ".join(f"{k} long" for k in KEY) + ", ends_sha256 string")
