"""Licence scan: canonical digests of entire texts, joined with those of known licences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumflow.llm.common import whole
from vellumflow.session import few, settled

# Licences and their usual notices, as their authors publish them.
KNOWN = [
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"
        ' files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,'
        " modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software"
        " is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be"
        ' included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,'
        " EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND"
        " NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER"
        " IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER"
        " DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided"
        " that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR"
        " DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT"
        " SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM"
        " LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN"
        " CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any"
        " damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including"
        " commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this"
        " software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a"
        " product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions"
        " must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed"
        " or altered from any source distribution.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
]
# The clauses of the BSD licences, as published; list marks differ between copies.
BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
)
BSD_CLAUSES = [
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the"
    " documentation and/or other materials provided with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this"
    " software without specific prior written permission.",
]
BSD_TAIL = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT'
    " LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE"
    " COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING,"
    " BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED"
    " AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT"
    " OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
UNLICENSE = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or"
    " distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any"
    " means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in"
    " the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and"
    " successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software"
    ' under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE'
    " WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM,"
    " DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR"
    " THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to "
)


def _bsd(clauses: int, marks: list[str]) -> str:
    """A BSD licence with its list marked in one way."""
    return " ".join([BSD_HEAD, *(f"{m} {c}" for m, c in zip(marks, BSD_CLAUSES[:clauses])), BSD_TAIL])


KNOWN += [(f"BSD-{n}-Clause", _bsd(n, marks)) for n in (2, 3) for marks in (["1", "2", "3"], ["", "", ""], ["a", "b", "c"])]
KNOWN += [("Unlicense", UNLICENSE + f"<{site}>") for site in ("https://unlicense.org/", "http://unlicense.org")]
KNOWN += [("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"), ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause")]
# Digests of the canonical form of licences too long to hold here, as published; some also without the part on how to apply them.
DIGESTS: list[tuple[str, str]] = [
    ("Apache-2.0", "eee40bd4c063cf00c2e0f1c8de839c22"),
    ("Apache-2.0", "7c15445d5a2c45d0af35bbe238c8e5b3"),
    ("GPL-1.0", "9a6d41337fa0145d93e534071bfae3f8"),
    ("GPL-1.0", "78f3b35da3d393ee93ecfeb7d20907e6"),
    ("GPL-2.0", "8e4925da11f68cc625b11b0a628fdcc5"),
    ("GPL-2.0", "42f2f51f3e726d001525877e3528c3d0"),
    ("GPL-3.0", "b79359b5e391fd47146ff34ae3db7ec0"),
    ("GPL-3.0", "444f95dc767ede978b60cfb20fbd0bca"),
    ("LGPL-2.0", "74cf7fcef3b29a39165a795b2cad3a3a"),
    ("LGPL-2.0", "c396ba2f94537628797123bc12cd2d6e"),
    ("LGPL-2.1", "f998bc436710cfece156aaa84fd26dd4"),
    ("LGPL-2.1", "3054b3781b1af43f906dc753acad15ee"),
    ("LGPL-3.0", "b31b7335bc37919e8cdd79154e04d88d"),
    ("MPL-1.1", "9fa8ae3e869a929215034d82982372b5"),
    ("MPL-2.0", "19a5e4f294773f3e7c4ea17087aaab96"),
    ("CC0-1.0", "d2a76f70ce19809695b7fb93c6241c23"),
    ("GFDL-1.2", "7a0a547ecac612b526676be523eacf80"),
    ("GFDL-1.3", "7132e8380bc59358f27c3129a2136bf1"),
    ("Artistic-1.0-Perl", "a8b0fb0c6e43a3b36bdc159e59dbfd1e"),
    ("BSD-3-Clause", "ddcd765ed0a3236bf96e15f76c36983a"),
]
# Spellings that mean the same.
SAME = [
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sub license", "sublicense"),
    ("acknowledgement", "acknowledgment"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("honour", "honor"),
    ("merchantibility", "merchantability"),
    ("non infringement", "noninfringement"),
    ("noncommercial", "non commercial"),
    ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"),
    ("version 2 0", "version 2"),
    ("v2 0", "version 2"),
    ("v2", "version 2"),
    ("v3", "version 3"),
    ("https", "http"),
]
# Beginnings of lines that name an owner.
OWNER = r"(?:(?:portions )?copyright[ :,]*(?:\(c\)|©|[0-9]{4}|by |[<\[{])|\(c\) *[0-9]{4}|©|all rights reserved)"
# Lines that are only the title of a licence whose text does not hold its name.
TITLE = r"(?:the )?(?:mit|isc|zlib|(?:new |modified |simplified )?bsd(?:[ -][23][ -]clause)?)(?: [\"'“”]*(?:new|revised|simplified)[\"'“”]*)? licen[cs]e(?: *\((?:mit|isc|zlib|bsd)\))?[ \t\r:.*=#-]*"
MARGIN = r"[ \t*#/;=-]*"
SIGNS = r"[\x00-/:-@\[-`{-\x7f\xa0‘’“”–—]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical(text: Column) -> Column:
    """Small letters; lines of owners and titles dropped; what is no letter or digit as one space; one spelling of each word.

    Letters beyond ASCII count as they are, so texts in other languages keep their words.
    """
    out = F.translate(text, UPPER, LOWER)
    out = F.regexp_replace(out, rf"(?md)^{MARGIN}(?:{OWNER}[^\n]*|{TITLE})$", "")
    out = F.concat(F.lit(" "), F.regexp_replace(out, SIGNS, " "), F.lit(" "))
    for old, new in SAME:
        out = F.replace(out, F.lit(f" {old} "), F.lit(f" {new} "))
    return F.trim(F.regexp_replace(out, " +", " "))


def digest(text: Column) -> Column:
    return F.md5(canonical(text).cast("binary"))


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | DataFrame | None = None) -> DataFrame:
    """(known_digest, license) of licence texts, once for each digest; without a list, of those that come with this module.

    Texts may also be a table (license, text), as of a folder of licence files.
    Of two names for a digest the first of the list counts, of a table the smaller.
    """
    if isinstance(known, DataFrame):
        return known.groupBy(digest(F.col("text")).alias("known_digest")).agg(F.min("license").alias("license"))
    texts = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(KNOWN if known is None else known)], "i int, license string, text string")
    rows = texts.select("i", "license", digest(F.col("text")).alias("known_digest"))
    if known is None and DIGESTS:
        rows = rows.unionByName(spark.createDataFrame([(len(KNOWN) + i, a, b) for i, (a, b) in enumerate(DIGESTS)], "i int, license string, known_digest string"))
    return rows.groupBy("known_digest").agg(F.min_by("license", "i").alias("license"))


def scan(docs: DataFrame, known: list[tuple[str, str]] | DataFrame | None = None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest, license, n_notices, notices): each row with the licence whose text its whole text is, and those that single lines of it are.

    Entire texts, and each line as a text of its own, are brought to canonical
    form and joined by digest with the known ones, which are broadcast (a table
    of them only if, counted, it fits; else they are joined by shuffle). Lines
    that match are counted by doc_id before they meet their documents; texts are
    not shuffled.

    Nulls: a null text is empty and has the digest of the empty text; rows of a
    null id meet like any other. Rows of one id share the notices of all of
    them, with repeated rows counted as often as they come. No rows: no rows.
    Other columns are not looked at.
    """
    spark = docs.sparkSession
    digests = known_digests(spark, known)
    digests = few(settled(digests)) if isinstance(known, DataFrame) else F.broadcast(digests)
    rows = docs.select(F.col(id).alias("doc_id"), whole(text).alias("text"))
    line = F.explode(F.split("text", "\n")).alias("line")
    lines = rows.select("doc_id", line).where(F.length("line") > 0)
    hits = lines.select("doc_id", digest(F.col("line")).alias("known_digest")).join(digests, "known_digest")
    found = hits.groupBy(F.col("doc_id").alias("found_id")).agg(
        F.count("*").alias("n_notices"), F.array_sort(F.collect_set("license")).alias("notices")
    )
    named = rows.select("doc_id", digest(F.col("text")).alias("known_digest")).join(digests, "known_digest", "left").withColumnRenamed("known_digest", "digest")
    return named.join(found, F.col("doc_id").eqNullSafe(F.col("found_id")), "left").select(
        "doc_id", "digest", "license", F.coalesce("n_notices", F.lit(0)).alias("n_notices"), F.coalesce("notices", F.array().cast("array<string>")).alias("notices")
    )
