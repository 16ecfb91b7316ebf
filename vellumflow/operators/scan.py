"""Prefix scans along a document: the state before each segment, from maps that compose.

A running value of a long document (the chunk that is open, the headings in
force) is a state that each segment maps to the next one. Maps of neighbouring
segments compose to one map of the same size, so the scan goes up and down
levels of blocks: no row ever holds more than ``block`` maps, however long the
document is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 256


def longest(layout: DataFrame) -> int:
    """Segments of the longest document; 1 where none has more."""
    return layout.where("n_segs > 1").agg(F.max("n_segs")).first()[0] or 1


def levels_for(most: int, block: int = BLOCK) -> int:
    """Levels of blocks after which so many maps are one block: none up to 256, two for a million."""
    levels = 0
    while block ** (levels + 1) < most:
        levels += 1
    return levels


def _blocks(maps: DataFrame, key: str, place) -> DataFrame:
    listed = "array_sort(collect_list(struct(at, m)), (x, y) -> x.at - y.at) AS ms"
    return maps.groupBy(key, place.alias("up")).agg(F.expr(listed))


def _states(blocks: DataFrame, key: str, after: str) -> DataFrame:
    """State before each map of a block, from the state ``s`` before the block."""
    passed = F.expr(f"""
        aggregate(ms,
          named_struct('s', s, 'seen', slice(array(named_struct('at', ms[0].at, 's', s)), 1, 0)),
          (t, x) -> named_struct('s', {after.format(s="t.s", m="x.m")},
                                 'seen', concat(t.seen, array(named_struct('at', x.at, 's', t.s)))),
          t -> t.seen)""")
    return blocks.select(key, F.inline(passed))


def states_before(
    maps: DataFrame,
    key: str,
    start: str,
    after: str,
    compose: str,
    block: int = BLOCK,
    levels: int = 2,
) -> DataFrame:
    """The state before each map, as ``(key, at, s)``.

    ``maps`` is ``(key, at, m)``, ``at`` the place of a map along its key (whole
    numbers from 0, gaps allowed, no place twice). ``start`` is SQL for the first
    state, ``after`` for the state that follows ``{s}`` through the map ``{m}``,
    ``compose`` for the map that does ``{a}``, then ``{b}``. The composition must be
    associative. A key without maps gives no row.
    """
    below: list[DataFrame] = []
    rows = maps.select(key, "at", "m")
    for _ in range(levels):
        blocks = _blocks(rows, key, F.floor(F.col("at") / block).cast("int"))
        below.append(blocks)
        one = f"aggregate(slice(ms, 2, size(ms)), ms[0].m, (a, x) -> {compose.format(a='a', b='x.m')})"
        rows = blocks.select(key, F.col("up").alias("at"), F.expr(one).alias("m"))
    top = _blocks(rows, key, F.lit(0)).withColumn("s", F.expr(start))
    states = _states(top, key, after)
    for blocks in reversed(below):
        entered = blocks.join(states.withColumnRenamed("at", "up"), [key, "up"])
        states = _states(entered, key, after)
    return states
