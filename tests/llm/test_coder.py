"""Groups of the coder: lanes share what they learn, and documents go over the borders of lanes and groups."""

import brute
import numpy as np
import pytest
from tokenizers import Tokenizer

from vellumflow.llm import coder, queries


def test_lanes_learn_from_each_other():
    cycle = np.random.default_rng(3).integers(0, 65536, 1500).astype(np.int32)
    rows = [np.roll(cycle, 50 * i) for i in range(30)]
    made = coder.encode_blocks(rows)
    assert all(np.array_equal(a, b) for a, b in zip(coder.decode_blocks(made, [len(r) for r in rows]), rows))
    # With a model for each lane, in which no id comes twice, these took over 16 bits an id.
    assert 8 * sum(map(len, made)) < 4 * 30 * 1500


@pytest.mark.parametrize("sizes", [[], [0, 0], [1], [5, 0, 3], [300, 1, 299, 64, 2]])
def test_lanes_of_any_length(sizes):
    random = np.random.default_rng(4)
    rows = [random.integers(0, 40, n).astype(np.int32) for n in sizes]
    assert [r.tolist() for r in coder.decode_blocks(coder.encode_blocks(rows), sizes)] == [r.tolist() for r in rows]


@pytest.mark.parametrize("lanes, block, fewest", [(1, 7, 1), (4, 16, 5)])
def test_documents_over_many_groups(spark, tmp_path, monkeypatch, lanes, block, fewest):
    for name, value in (("LANES", lanes), ("BLOCK", block), ("FEWEST", fewest)):
        monkeypatch.setattr(coder, name, value)
    texts = [f"Words of document {i}, " * (i % 9 * (i % 4)) for i in range(60)]
    coder.write_ids(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), f"{tmp_path}/ids", queries.WORDS)
    stored = spark.read.parquet(f"{tmp_path}/ids")
    assert stored.where(f"n_ids > {lanes * block}").count() == 0 and stored.count() > 20
    encode = Tokenizer.from_file(queries.WORDS).encode
    want, start = [], 0
    for i, text in enumerate(texts):
        ids = [*encode(text, add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), brute.crc(ids)))
        start += len(ids)
    assert sorted(tuple(r) for r in coder.read_ids(stored).collect()) == want
