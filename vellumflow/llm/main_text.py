"""Main text of web pages: the best run of words and tags in one linear scan.

A page is a row of tokens. Words score by the block they stand in, tags score
below zero, both with weights learned from labelled pages; the run of highest
sum is the content region. Elements inside it are left out by the HTML standard
or by what labelled pages hold in elements of their class.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumflow.llm.common import by_text, hashed_share

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
NAMES = ("class", "id", "role", "aria-label")

# Elements by the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp noembed noframes iframe template".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
ENDS_P = BLOCK - {"td", "th", "tr", "caption", "html", "body", "option"}
# Elements that hold no running text of an article; a header does within one.
FURNITURE = set("head nav footer aside form script style noscript iframe template button select textarea input dialog menu".split())
CONTENT = {"article", "main"}
CONTAINER = set("div section ul ol dl table aside span center details".split())
# Words of a class, id or role that mark furniture where labelled pages have not shown what it holds: as a whole
# name, and the first ones also as first or last part of a container's name.
PART_MARKS = set(
    "ad ads advert adverts advertisement adsense sponsored promo promos banner banners nav navbar navigation menu menus breadcrumb breadcrumbs"
    " pagination masthead footer sidebar sidebars widget widgets comment comments disqus cookie cookies popup newsletter related".split()
)
MARKS = PART_MARKS | set(
    "advertising sponsor sponsors promotion pager header asides aside reply replies respond consent gdpr notice notices modal overlay subscribe"
    " subscription signup login search share sharing social recommended recommendations toolbar tags copyright complementary contentinfo".split()
)
WORDS = re.compile(r"[a-z]+")
# Weights of tokens that labelled pages did not show.
UNSEEN_WORD = {"p": 1.0, "li": 0.7, "td": 0.7, "blockquote": 1.0, "pre": 1.0, "dd": 0.7, "figcaption": 0.7, **{f"h{i}": 1.0 for i in range(1, 7)}}
UNSEEN_TAG = {**dict.fromkeys("div section article main body table header ul ol".split(), -2.0), **dict.fromkeys("p li br b i em strong span a".split(), -0.5)}
PLAIN_WORD, PLAIN_TAG = 0.4, -1.0
# What a word and a tag inside furniture cost.
OUT_WORD, OUT_TAG = -0.1, -0.5
# Where a page marks its article, words outside of it and what costs inside of it count so little of their weight.
ELSEWHERE, WITHIN = 0.02, 0.05
# A class shown by labelled pages is furniture below these odds, and only if so many words speak for it.
CLASS_ODDS, CLASS_WORDS = -2.0, 20
# Pages whose own mark-up says where the article is serve as labels; at most so many.
SAMPLE = 500


def _attributes(rest: str) -> tuple[list[str], bool]:
    """Names in class, id and role in small letters, and whether the element is hidden."""
    names: list[str] = []
    hidden = False
    for name, value in ATTRIBUTE.findall(rest):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in NAMES:
            names += value.split()
        hidden = hidden or name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", "")
    return names, hidden


def _furniture(tag: str, names: list[str], hidden: bool, in_content: bool, weights: dict[str, float]) -> bool:
    if tag in FURNITURE or hidden or tag == "header" and not in_content:
        return True
    if tag in CONTENT or tag in ("html", "body"):
        return False
    for name in names:
        odds = weights.get("." + name)
        if odds is not None:
            if odds < CLASS_ODDS:
                return True
            continue
        parts = WORDS.findall(name)
        if name in MARKS or tag in CONTAINER and parts and (parts[0] in PART_MARKS or parts[-1] in PART_MARKS):
            return True
    return False


class _Open:
    """Elements that stand open, with the number of each tag: nothing is searched that is not there."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, bool, bool, str, list[str]]] = []  # tag, furniture, in article, block, names so far
        self.count: Counter = Counter()

    def top(self) -> tuple[str, bool, bool, str, list[str]]:
        return self.stack[-1] if self.stack else ("", False, False, "body", [])

    def push(self, *entry) -> None:
        self.stack.append(entry)
        self.count[entry[0]] += 1

    def cut(self, at: int) -> None:
        for entry in self.stack[at:]:
            self.count[entry[0]] -= 1
        del self.stack[at:]

    def close(self, tag: str) -> None:
        while self.stack:
            last = self.stack[-1][0]
            self.cut(len(self.stack) - 1)
            if last == tag:
                return


def tokens(page: str, weights: dict[str, float]) -> list[tuple[str, str, bool, bool, list[str]]]:
    """(kind, text, furniture, in article, names) of each token: kind ``w:`` with the block around for words, else the tag.

    Tolerant of missing end tags: an end tag closes what stands open inside its
    element, and one without a start does nothing, so furniture that is never
    closed ends with its parent. Time grows with the page, however deep it nests.
    """
    out: list[tuple[str, str, bool, bool, list[str]]] = []
    opened = _Open()
    at, size = 0, len(page)
    while at < size:
        m = TOKEN.match(page, at)
        if m is None:
            break
        at = m.end()
        top = opened.top()
        text = m["text"]
        if text is not None:
            kind = "w:" + top[3] + (":a" if opened.count["a"] else "")
            out.append((kind, html.unescape(text), top[1], top[2], top[4]))
            continue
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if m["close"]:
            if opened.count[tag]:
                opened.close(tag)
                out.append(("/" + tag, "", top[1] and opened.top()[1], top[2], []))
            elif tag in BLOCK:
                out.append(("/" + tag, "", top[1], top[2], []))
            continue
        if tag in BLOCK and opened.count["head"]:  # content ends a head that is still open
            opened.cut(next(i for i, x in enumerate(opened.stack) if x[0] == "head"))
        if tag in ENDS_P or tag in SAME:
            _implied_ends(tag, opened)
        top = opened.top()
        rest = m["rest"]
        names, hidden = _attributes(rest) if rest.strip(" /") else ([], False)
        inside = top[2] or tag in CONTENT
        own = top[1] or _furniture(tag, names, hidden, top[2], weights)
        out.append((tag, "", own, inside, []))
        if tag in RAW:
            end = _raw_end(tag).search(page, at)
            at = end.end() if end else size
            continue
        if tag not in VOID and not rest.endswith("/"):
            opened.push(tag, own, inside, tag if tag in BLOCK else top[3], _with(top[4], names))
    return out


@lru_cache
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}\s*>", re.I)


# Of the names of nested elements the innermost count.
DEPTH = 16


def _with(names: list[str], more: list[str]) -> list[str]:
    return [*names, *more][-DEPTH:] if more else names


SAME = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = set("table ul ol dl div article section main body td th nav aside header footer form blockquote select".split())


def _implied_ends(tag: str, opened: _Open) -> None:
    """Close the paragraph, item or cell that a start tag ends."""
    ended = SAME.get(tag, ()) + (("p",) if tag in ENDS_P else ())
    stack = opened.stack
    for i in range(len(stack) - 1, -1, -1):
        if not any(opened.count[t] for t in ended):
            return
        if stack[i][0] in ended:
            opened.cut(i)
            if tag != "tr":
                return
        elif stack[i][0] in SCOPE and not (tag == "tr" and stack[i][0] in ("td", "th")):
            return


def learn(pages: Iterable[str]) -> dict[str, float]:
    """Weights of tokens: log odds of lying in the content of labelled pages.

    Words count one each, by the block they stand in, and once for each class
    around them. A word is never below a small positive score and a tag never
    above a negative one, so that a region grows by words alone.
    """
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    classes: tuple[Counter, Counter] = (Counter(), Counter())
    for page in pages:
        found = tokens(page, {})
        if not any(inside and kind[:2] == "w:" for kind, _, _, inside, _ in found):
            continue
        for kind, text, out, inside, names in found:
            n = len(text.split()) if kind[:2] == "w:" else 1
            if not out:
                seen[inside][kind] += n
            if kind[:2] == "w:":
                for name in set(names):
                    classes[inside and not out][name] += n
    total = [sum(c.values()) + 1.0 for c in seen]
    words = [sum(n for kind, n in c.items() if kind[:2] == "w:") + 1.0 for c in seen]
    weights = {}
    for name in {*seen[0], *seen[1]}:
        odds = math.log((seen[1][name] + 0.5) / total[1]) - math.log((seen[0][name] + 0.5) / total[0])
        weights[name] = min(max(odds, 0.05), 3.0) if name[:2] == "w:" else min(max(odds - 2.0, -8.0), -0.5)
    for name in {*classes[0], *classes[1]}:
        if classes[0][name] + classes[1][name] >= CLASS_WORDS:
            weights["." + name] = math.log((classes[1][name] + 0.5) / words[1]) - math.log((classes[0][name] + 0.5) / words[0])
    return weights


def _score(kind: str, text: str, out: bool, weights: dict[str, float]) -> float:
    if kind[:2] == "w:":
        n = len(text.split())
        if out:
            return n * OUT_WORD
        got = weights.get(kind)
        return n * (UNSEEN_WORD.get(kind[2:], PLAIN_WORD if kind[-2:] != ":a" else 0.1) if got is None else got)
    if out:
        return OUT_TAG
    got = weights.get(kind)
    return UNSEEN_TAG.get(kind.lstrip("/"), PLAIN_TAG) if got is None else got


def best_run(scores: list[float]) -> tuple[int, int]:
    """The slice of highest sum, the longest of equal ones that come first; empty if no score is positive."""
    best, held, begin, run = 0.0, 0.0, 0, (0, 0)
    for i, score in enumerate(scores):
        if held < 0:
            held, begin = 0.0, i
        held += score
        if held > best or held == best and run[0] == begin and best > 0:
            best, run = held, (begin, i + 1)
    return run


def extract(page: str, weights: dict[str, float]) -> str:
    """The main text: blocks of the best region in page order, one line each."""
    found = tokens(page, weights)
    marked = any(inside and kind[:2] == "w:" and not out and text.strip() for kind, text, out, inside, _ in found)
    scores = [_score(kind, text, out, weights) for kind, text, out, _, _ in found]
    if marked:
        scores = [x * (WITHIN if x < 0 else 1) if t[3] else x * (ELSEWHERE if x > 0 else 1) for x, t in zip(scores, found)]
    a, b = _to_borders(found, *best_run(scores))
    lines, line = [], []
    for kind, text, out, _, _ in found[a:b]:
        if kind[:2] == "w:":
            if not out:
                line.append(text)
        elif kind.lstrip("/") in BLOCK:
            lines.append("".join(line))
            line = []
        elif kind == "br" and not out:
            line.append(" ")
    lines.append("".join(line))
    return "\n".join(x for x in (" ".join(x.split()) for x in lines) if x)


def _to_borders(found: list[tuple[str, str, bool, bool, list[str]]], a: int, b: int) -> tuple[int, int]:
    """The region widened to whole blocks."""
    if a == b:
        return a, b
    while a > 0 and found[a - 1][0].lstrip("/") not in BLOCK:
        a -= 1
    while b < len(found) and found[b][0].lstrip("/") not in BLOCK:
        b += 1
    return a, b


def labelled(pages: DataFrame, html_column: str = "html", most: int = SAMPLE) -> list[str]:
    """Pages that say themselves, by one article or main element, where their content is: the training set, of bounded size."""
    own = F.col(html_column)
    marks = F.regexp_count(own, F.lit("(?i)<(article|main)[ >]"))
    marked = pages.where(own.isNotNull() & (F.length(own) < 50_000) & (marks == 1))
    few = marked.where(hashed_share(own, marked.count(), most))
    return [r[0] for r in few.orderBy(F.xxhash64(own), own).select(own).limit(most).collect()]


def main_text(pages: DataFrame, html_column: str = "html", weights: dict[str, float] | None = None) -> DataFrame:
    """``pages`` with ``text``, the main text of each whole page, and ``n_chars``, its code points.

    Character references are decoded, white space inside a block becomes one
    space, blocks are joined by one line break. Weights are learned from the
    pages that mark their article, unless given. Row by row, no shuffle.

    Null or empty pages and pages without words give an empty text. Broken
    mark-up is read to its end. Repeated rows, null ids and other columns stay;
    columns named text or n_chars are replaced. No rows: no rows.
    """
    known = learn(labelled(pages, html_column)) if weights is None else weights

    def make(texts: pa.Array) -> list[pa.Array]:
        made = [extract(x, known) for x in texts.to_pylist()]
        return [pa.array(made, pa.string()), pa.array(map(len, made), pa.int64())]

    return by_text(pages, html_column, "text string, n_chars long", make)
