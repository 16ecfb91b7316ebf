"""Model calls as partition-batched jobs. The model is a callable the user plugs in."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Makes a model client in the task: a function from a list of inputs to a list of texts.
ModelFactory = Callable[[], Callable[[list[str]], list[str]]]

REPLY = "struct<text:string,error:string>"


class RateLimited(Exception):
    """Raised by a model callable that wants to be called again later."""


@dataclass(frozen=True)
class Retry:
    attempts: int = 6
    first_wait: float = 1.0
    sleep: Callable[[float], None] = time.sleep

    def call(self, model, inputs: list[str]) -> list[str]:
        """Call with exponentially growing waits while the model is rate limited."""
        for attempt in range(self.attempts):
            try:
                return model(inputs)
            except RateLimited:
                if attempt == self.attempts - 1:
                    raise
                self.sleep(self.first_wait * 2**attempt)
        raise ValueError("attempts must be at least 1")


# A model is sent at most so many inputs in one call.
CALL_INPUTS = 256


def _answer(model, retry: Retry, inputs: list[str] | pa.Array, most: int = CALL_INPUTS) -> list[tuple[str, str | None]]:
    """Replies with errors, asked for in calls of at most ``most`` inputs.

    One bad input costs only its own reply, which becomes empty. A model that is
    still rate limited after the last wait fails the whole call and all later
    ones of this batch: asking it row by row would only wait again for each.
    """
    out: list[tuple[str, str | None]] = []
    limited: str | None = None
    for a in range(0, len(inputs), most):
        part = inputs[a : a + most]
        part = part if isinstance(part, list) else part.to_numpy(zero_copy_only=False).tolist()
        if limited is None:
            try:
                out += _replies(model, retry, part)
                continue
            except RateLimited as failed:
                limited = f"{type(failed).__name__}: {failed}"
        out += [("", limited)] * len(part)
    return out


def _replies(model, retry: Retry, part: list[str]) -> list[tuple[str, str | None]]:
    try:
        texts = list(retry.call(model, part))
        if len(texts) != len(part):
            raise ValueError(f"{len(texts)} replies to {len(part)} inputs")
        return [(text, None) for text in texts]
    except RateLimited:
        raise
    except Exception as failed:
        if len(part) == 1:
            return [("", f"{type(failed).__name__}: {failed}")]
        return [reply for one in part for reply in _replies(model, retry, [one])]


def _replied(replies: list[tuple[str | None, str | None]]) -> pa.StructArray:
    texts, errors = [t for t, _ in replies], [e for _, e in replies]
    return pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(errors, pa.string())], ["text", "error"])


def model_reply(inputs: Column, factory: ModelFactory, retry: Retry = Retry(), most: int = CALL_INPUTS) -> Column:
    """``struct<text, error>`` per row; a null input is not sent and gives null fields.

    Of a batch only the inputs of one call are Python objects at a time.
    """

    @F.arrow_udf(REPLY)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = factory()
        for batch in batches:
            known = batch.is_valid()
            replies = _answer(model, retry, batch.filter(known), most)
            # A null row takes no reply.
            at = np.where(known.to_numpy(zero_copy_only=False), np.cumsum(known.to_numpy(zero_copy_only=False)) - 1, len(replies))
            yield pa.concat_arrays([_replied(replies), _replied([(None, None)])]).take(pa.array(at))

    return run.asNondeterministic()(inputs)


def model_replies(inputs: Column, factory: ModelFactory, retry: Retry = Retry(), most: int = CALL_INPUTS) -> Column:
    """The same for an array of inputs per row; the replies keep their order, and a null array has none."""

    @F.arrow_udf(f"array<{REPLY}>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = factory()
        for batch in batches:
            sizes = batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            offsets = pa.array(np.r_[0, np.cumsum(sizes)], pa.int32())
            yield pa.ListArray.from_arrays(offsets, _replied(_answer(model, retry, batch.flatten(), most)))

    return run.asNondeterministic()(inputs)
