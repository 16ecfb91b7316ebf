"""Column functions over text. All run in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The character classes that agree with Unicode-aware word and
# space classes, spelled out because the JVM's short forms are ASCII only.
SPACE = r"\t-\r\x1c-\x20\x85\p{Z}"
WORD = r"\p{L}\p{N}_"

SPACES = rf"[{SPACE}]+"
TOKEN = rf"[{WORD}]+|[^{WORD}{SPACE}]|[{SPACE}]+"
WORD_TOKEN = rf"[{WORD}]+"

# The default chunk token as SQL: a run of non-space with the space before it.
SPACED_TERMS_SQL = f"regexp_extract_all({{text}}, r'[{SPACE}]*[^{SPACE}]+', 0)".replace(r"\p{Z}", r"\p{{Z}}")
TRIMMED_SQL = f"regexp_replace({{text}}, r'^[{SPACE}]+|[{SPACE}]+$', '')".replace(r"\p{Z}", r"\p{{Z}}")


def tokens(text: Column) -> Column:
    """Words, single punctuation marks and space runs; joined they give the text back."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def words(text: Column) -> Column:
    """Only the word tokens."""
    return F.regexp_extract_all(text, F.lit(WORD_TOKEN), F.lit(0))


def clean(text: Column) -> Column:
    """Letters a-z, digits and single spaces; everything else is dropped."""
    kept = F.regexp_replace(text, rf"[^a-zA-Z0-9{SPACE}]", "")
    # A single blank stays as it is.
    return F.trim(F.regexp_replace(kept, rf"[{SPACE}]{{2,}}|[{SPACE}&&[^ ]]", " "))


def query_terms(query: Column) -> Column:
    """Lower-cased terms of a query."""
    return F.regexp_extract_all(F.lower(query), F.lit(rf"[^{SPACE}]+"), F.lit(0))


def mark(text: Column, matching: Column) -> Column:
    """Wrap each word whose lower-cased form is in ``matching``; all else is unchanged.

    Only distinct words are compared. Words hold no sign that a pattern reads otherwise, so those found are one.
    """
    found = F.filter(F.array_distinct(words(text)), lambda w: F.array_contains(matching, F.lower(w)))
    whole = lambda ws: F.concat(F.lit(f"(?<![{WORD}])(?:"), F.array_join(ws, "|"), F.lit(f")(?![{WORD}])"))
    marked: Callable[[Column], Column] = lambda ws: F.when(
        F.size(ws) > 0, F.regexp_replace(text, whole(ws), F.lit("<mark>$0</mark>"))
    ).otherwise(text)
    return F.get(F.transform(F.array(found), marked), F.lit(0))
