"""Word stems after M. F. Porter, "An algorithm for suffix stripping" (1980).

The small additions are those of the widely used extended variant: irregular
forms, short words left alone, and a few changed rules.
"""

from __future__ import annotations

# Irregular forms and suffix rules.
IRREGULAR = {
    "skies": "sky",
    "sky": "sky",
    "dying": "die",
    "lying": "lie",
    "tying": "tie",
    "news": "news",
    "innings": "inning",
    "inning": "inning",
    "outings": "outing",
    "outing": "outing",
    "cannings": "canning",
    "canning": "canning",
    "howe": "howe",
    "proceed": "proceed",
    "exceed": "exceed",
    "succeed": "succeed",
}
DOUBLE_SUFFIXES = [
    ("ational", "ate"),
    ("tional", "tion"),
    ("enci", "ence"),
    ("anci", "ance"),
    ("izer", "ize"),
    ("bli", "ble"),
    ("alli", "al"),
    ("entli", "ent"),
    ("eli", "e"),
    ("ousli", "ous"),
    ("ization", "ize"),
    ("ation", "ate"),
    ("ator", "ate"),
    ("alism", "al"),
    ("iveness", "ive"),
    ("fulness", "ful"),
    ("ousness", "ous"),
    ("aliti", "al"),
    ("iviti", "ive"),
    ("biliti", "ble"),
    ("fulli", "ful"),
]
SINGLE_SUFFIXES = [
    ("icate", "ic"),
    ("ative", ""),
    ("alize", "al"),
    ("iciti", "ic"),
    ("ical", "ic"),
    ("ful", ""),
    ("ness", ""),
]
DROPPED = (
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"
).split()


class _Shapes(dict):
    """v for a vowel, c for any other letter."""

    def __missing__(self, code: int) -> str:
        self[code] = "v" if chr(code) in "aeiou" else "c"
        return self[code]


_SHAPES = _Shapes()


def _shape(word: str) -> str:
    """The word as c (consonant) and v (vowel); y after a consonant is a vowel."""
    shape = word.translate(_SHAPES)
    at = word.find("y", 1)
    while at > 0:
        if shape[at - 1] == "c":
            shape = shape[:at] + "v" + shape[at + 1 :]
        at = word.find("y", at + 1)
    return shape


def _measure(word: str) -> int:
    return _shape(word).count("vc")


def _short_end(word: str) -> bool:
    shape = _shape(word)
    return (shape[-3:] == "cvc" and word[-1] not in "wxy") or shape == "vc"


def _double_end(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _swap(word: str, rules, minimum: int) -> str:
    """The first rule whose suffix fits decides, whether or not it may be applied."""
    for suffix, instead in rules:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            return stem + instead if _measure(stem) >= minimum else word
    return word


def _plural(word: str) -> str:
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("sses"):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def _tense(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        stem = word[: -len(suffix)]
        if word.endswith(suffix) and "v" in _shape(stem):
            break
    else:
        return word
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if _double_end(stem):
        return stem if stem[-1] in "lsz" else stem[:-1]
    return stem + "e" if _measure(stem) == 1 and _short_end(stem) else stem


def _final_y(word: str) -> str:
    ends = len(word) > 2 and word.endswith("y") and _shape(word[:-1])[-1] == "c"
    return word[:-1] + "i" if ends else word


def _double(word: str) -> str:
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        return _double(word[:-2])
    if word.endswith("logi"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    return _swap(word, DOUBLE_SUFFIXES, 1)


def _drop(word: str) -> str:
    for suffix in DROPPED:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            if _measure(stem) > 1 and (suffix != "ion" or stem[-1] in "st"):
                return stem
            return word
    return word


def _final_e(word: str) -> str:
    if word.endswith("e"):
        stem = word[:-1]
        if _measure(stem) > 1 or (_measure(stem) == 1 and not _short_end(stem)):
            word = stem
    return word[:-1] if word.endswith("ll") and _measure(word[:-1]) > 1 else word


def porter_stem(word: str) -> str:
    word = word.lower()
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    word = _double(_final_y(_tense(_plural(word))))
    return _final_e(_drop(_swap(word, SINGLE_SUFFIXES, 1)))
