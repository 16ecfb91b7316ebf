"""The memory of the encoders: what is asked for again stays, and ids are those of the library whatever is remembered."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from vellumflow.llm import queries, tokens

ODD = ["", "a", "a\0", "\0a", "a" * 15, "a" * 16, "a" * 8, "a" * 8 + "\0", "ñandú", "ÑANDÚ", "漢字かな", "x" * 3000, "don't", "\"'s", "'re9's", "Ab12cd,,.x", "ÀÞß", "Ÿ×÷", "İK", "<|endoftext|>", "￿"]


def units(texts):
    """Bytes of each text as its ids."""
    return tuple(map(np.array, ([b for x in texts.to_pylist() for b in x.encode()], [len(x.encode()) for x in texts.to_pylist()])))


@pytest.mark.parametrize("bits, most", [(4, 50), (4, 1 << 20), (20, 3000)])
def test_memory_gives_what_encode_gives(monkeypatch, bits, most):
    monkeypatch.setattr(tokens.Memory, "BITS", bits)
    memory, random = tokens.Memory(units, most), np.random.default_rng(1)
    words = ODD + [f"w{i}" for i in range(200)]
    for _ in range(20):
        texts = pa.array([words[i] for i in random.integers(0, len(words), 300)])
        for got, want in zip(memory(texts), units(texts)):
            assert np.array_equal(got, want)


def test_what_is_asked_for_again_is_encoded_once():
    seen = []
    encoder = tokens.Encoder(lambda x: seen.extend(x.to_pylist()) or units(x), tokens.words, 300)
    for i in range(200):
        encoder(pa.array([f"often and once{i}"]))
    assert seen.count("often") == seen.count("and") == 1


def test_a_piece_is_merged_once_in_many_words(monkeypatch):
    library, merged = tokens.Library(queries.WORDS), []
    monkeypatch.setattr(library.pieces, "encode", lambda x, f=library._merged: merged.extend(x.to_pylist()) or f(x))
    for text in ("Heanti", "heanti,", "(heanti)", "HEANTI."):
        library(pa.array([text]))
    assert merged.count("heanti") == 1


def test_ids_of_odd_words():
    plain, encoder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), tokens.Encoder(tokens.Library(queries.WORDS), tokens.words)
    texts = [x.replace("\0", "") for x in ODD] + [" ".join(ODD), "don't Don't DON'T it's' 'tis we'll'll", "É1É2é é\tÀÉ\nñ's"]
    for _ in range(2):
        ids, lens = encoder(pa.array(texts))
        want = [plain.encode(x, add_special_tokens=False).ids for x in texts]
        assert lens.tolist() == [len(x) for x in want] and ids.tolist() == sum(want, [])
