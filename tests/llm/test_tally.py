"""Counts of a buffer of documents: by language, source and prefix, against plain Python."""

import re
from collections import Counter

import pyarrow as pa
import pytest

from vellumflow.llm import divergence

TEXTS = ["", "a", " a", "a ", "aB", "éA é", "A1a", "--", "日本語 abc日", "@[`{a", "abcdefghijklmnopqrstuvwxyz abcdefgx abcdx", "abcdefgh abcd", "\x7fa\x00b", "x" * 100 + " " + "x" * 33]


@pytest.mark.parametrize("texts", [[], [""], ["", ""], TEXTS, TEXTS[::-1], ["a"] * 4, ["a", "", "b", ""]])
def test_terms_end_with_their_text(texts):
    letters, lens, counts = divergence._terms(pa.array(texts, pa.string()))
    found, at = [], 0
    for n in lens:
        found.append(letters[at : at + n].tobytes().decode())
        at += n
    want = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", x.replace("B", "b").replace("A", "a")) for x in texts]
    assert found == sum(want, []) and counts.tolist() == [len(x) for x in want]


def test_counts_of_a_buffer():
    tally, rows = divergence._Tally(4), [(t, lang, s) for i, t in enumerate(TEXTS) for lang in ("en", "fr")[: 1 + i % 2] for s in ("a", "b")]
    for part in (rows[:9], rows[9:]):
        tally.add([r[1] for r in part], [r[2] for r in part], pa.array([r[0] for r in part]))
    docs, uses, prefixes, firsts = Counter(), Counter(), Counter(), Counter()
    for text, lang, source in rows:
        terms = re.findall(rb"[a-z\x80-\xff]+", text.lower().encode())
        uses.update((lang, t.decode(), source) for t in terms)
        docs.update((lang, t.decode()) for t in set(terms))
        prefixes.update({(lang, i, t[: 4 << i]) for t in terms for i in range(8) if len(t) > 4 << i})
    made = [r for batch in tally.rows() for r in batch.to_pylist()]
    assert {(r["lang"], r["term"]): r["docs"] for r in made} == docs and len(made) == len(docs)
    assert {(r["lang"], r["term"], u["source"]): u["n"] for r in made for u in r["uses"]} == uses
    for r in made:
        assert len(r["firsts"]) == sum(len(r["term"].encode()) > 4 << i for i in range(8))
        for i, n in enumerate(r["firsts"]):
            firsts[r["lang"], i, r["term"].encode()[: 4 << i]] += n
    assert firsts == prefixes


def test_many_terms_are_added_up_in_the_task(spark):
    text = " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}{chr(97 + i // 17576)}" for i in range(210_000))
    docs = spark.createDataFrame([(text, "en", s) for s in ("a", "b")] * 2, "text string, lang string, source string").coalesce(1)
    # Two sources have 420,000 terms together.
    assert divergence.document_terms(docs).count() == 210_000
