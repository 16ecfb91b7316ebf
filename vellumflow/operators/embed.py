"""Embedding jobs: a text column goes through a pluggable embedder, one per task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumflow.schemas import VECTOR

# Makes an embedder: a function from a list of texts to one vector per text.
EmbedderFactory = Callable[[], Callable[[list[str]], "np.ndarray | list"]]


# Texts that are Python objects at a time, of a batch of any size.
CALL_TEXTS = 256


def _embedded(embed: Callable[[list[str]], np.ndarray | list], texts: pa.Array) -> pa.Array:
    """Vectors of the texts, null where a text is."""
    known = texts.is_valid().to_numpy(zero_copy_only=False)
    vectors = np.asarray(embed(texts.drop_null().to_numpy(zero_copy_only=False).tolist()) if known.any() else np.zeros((0, 0)), dtype=np.float32)
    offsets = np.r_[0, np.cumsum(known)] * (vectors.shape[1] if len(vectors) else 0)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(vectors.ravel()), mask=pa.array(~known))


def embedding(text: Column, factory: EmbedderFactory) -> Column:
    """Vector of ``text``; only this column crosses to Python. Null text gives null."""

    @F.arrow_udf(VECTOR)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        embed = factory()
        for texts in batches:
            starts = range(0, max(len(texts), 1), CALL_TEXTS)
            yield pa.concat_arrays([_embedded(embed, texts.slice(a, CALL_TEXTS)) for a in starts])

    return run.asNondeterministic()(text)


def embed(table: DataFrame, factory: EmbedderFactory, source: str = "text", into: str = "embedding") -> DataFrame:
    """Add the embedding of ``source``."""
    return table.withColumn(into, embedding(F.col(source), factory))
