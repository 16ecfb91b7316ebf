"""Prefix scans against a plain fold."""

import random

import pytest

from vellumflow.operators import scan


@pytest.mark.parametrize("block, levels", [(2, 3), (3, 2), (256, 2), (4, 0)])
def test_states_before_each_map(spark, block, levels):
    """Maps ``x -> p * x + q`` modulo 97 compose, but not in any order."""
    random.seed(3)
    rows = []
    for key, n in (("a", 40), ("b", 1), ("c", 17)):
        at = -1
        for _ in range(n):
            at += random.choice([1, 1, 1, 5])
            rows.append((key, at, (random.randint(0, 96), random.randint(0, 96))))
    random.shuffle(rows)
    maps = spark.createDataFrame(rows, "key string, at int, m struct<p: int, q: int>")
    got = scan.states_before(
        maps,
        "key",
        start="1",
        after="({m}.p * {s} + {m}.q) % 97",
        compose="named_struct('p', ({a}.p * {b}.p) % 97, 'q', ({b}.p * {a}.q + {b}.q) % 97)",
        block=block,
        levels=levels,
    )
    expected = set()
    state = {}
    for key, at, (p, q) in sorted(rows):
        s = state.get(key, 1)
        expected.add((key, at, s))
        state[key] = (p * s + q) % 97
    assert {tuple(r) for r in got.select("key", "at", "s").collect()} == expected and got.count() == len(rows)


def test_no_maps(spark):
    maps = spark.createDataFrame([], "key string, at int, m int")
    assert scan.states_before(maps, "key", start="0", after="{s} + {m}", compose="{a} + {b}").isEmpty()


def test_levels():
    assert [scan.levels_for(n, 256) for n in (1, 256, 257, 65536, 1_000_000)] == [0, 0, 1, 1, 2]
