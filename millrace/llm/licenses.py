"""Licence scans: digests of canonical texts, looked up among the digests of known licences."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sizing import is_small

# Texts of licences and their notices, as published.
KNOWN = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ],
    "ISC": [
        """Copyright <year> <owner>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE.""",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS
IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.""",
    ],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0."],
}

# Spellings that licence guidelines hold to be the same. Each is taken at the beginning of a word.
SPELLINGS = [
    ("licenc", "licens"), ("sub licens", "sublicens"), ("authoris", "authoriz"), ("organis", "organiz"), ("favour", "favor"),
    ("merchantabilitie", "merchantability"), ("non infring", "noninfring"), ("https", "http"), ("acknowledgement", "acknowledgment"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[^0-9a-z\x{80}-\x{10FFFF}]+"
COPYRIGHT = r"^ *(copyright|\(c\)|\x{A9})"


def canonical_lines(text: Column) -> Column:
    """The lines of a text in canonical form, without empty ones and without lines that begin with a copyright mark."""

    def spelled(line: Column) -> Column:
        same = line
        for raw, one in SPELLINGS:
            same = F.regexp_replace(same, f"(^| ){raw}", f"$1{one}")
        return F.when(line.rlike("(^| )(" + "|".join(raw for raw, _ in SPELLINGS) + ")"), same).otherwise(line)

    lines = F.split(F.translate(text, UPPER, LOWER), "\n", -1)
    kept = F.filter(lines, lambda line: ~line.rlike(COPYRIGHT))
    plain = F.transform(kept, lambda line: F.trim(F.regexp_replace(line, BETWEEN, " ")))
    return F.array_remove(F.transform(plain, spelled), "")


def canonical(text: str) -> list[str]:
    """The same in Python, for the texts of known licences and for tests."""
    out = []
    for line in text.translate(str.maketrans(UPPER, LOWER)).split("\n"):
        if re.match(" *(copyright|\\(c\\)|\xa9)", line):
            continue
        line = re.sub("[^0-9a-z\x80-\U0010ffff]+", " ", line).strip(" ")
        for raw, same in SPELLINGS:
            line = re.sub(f"(^| ){raw}", lambda m, same=same: m[1] + same, line)
        out.append(line)
    return [line for line in out if line]


def digest(lines: list[str]) -> str:
    return hashlib.sha256(" ".join(lines).encode()).hexdigest()


def known_digests(known: dict[str, list[str]] = KNOWN) -> list[tuple[str, str]]:
    """(digest, licence) of each known text."""
    return sorted({(digest(canonical(t)), name) for name, texts in known.items() for t in texts})


def known_table(spark: SparkSession, known: dict[str, list[str]] = KNOWN) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(d).alias("digest"), F.lit(n).alias("license")) for d, n in known_digests(known)])
    return spark.range(1).select(F.inline(pairs))


def scan_licenses(docs: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, digest, license, notices``.

    ``digest`` is that of the entire canonical text and ``license`` the known licence with that digest, or null. ``notices``
    are the licences, sorted, of which some line of the text is a known notice by itself. A null text, and one without words, have
    the digest of nothing and no licence. Rows of equal id and text have equal results, and each comes back. A digest that is
    known for several licences gives the first by name. Other columns are ignored; an empty table gives no rows.

    ``known`` has ``digest`` and ``license``. It is broadcast if its counted size allows it. The shuffle carries a row per document
    and per known notice, without texts.
    """
    names = known.filter("digest is not null").groupBy("digest").agg(F.min("license").alias("license"))
    if is_small(names):
        names = F.broadcast(names)
    nothing = hashlib.sha256(b"").hexdigest()
    lines = F.coalesce(canonical_lines(F.col(text)), F.array().cast("array<string>"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.md5(F.col(text)).alias("text_key"), lines.alias("lines"))
    parts = F.concat(F.array(F.array_join("lines", " ")), F.col("lines"))
    rows = rows.select("doc_id", "text_key", F.posexplode(parts).alias("place", "part"))
    rows = rows.select("doc_id", "text_key", "place", F.sha2("part", 256).alias("digest")).join(names, "digest", "left")
    rows = rows.filter((F.col("place") == 0) | F.col("license").isNotNull())
    whole = F.col("place") == 0
    return (
        rows.groupBy("doc_id", "text_key")
        .agg(
            F.count_if(whole).alias("_rows"),
            F.max(F.when(whole, F.col("digest"))).alias("digest"),
            F.max(F.when(whole & (F.col("digest") != nothing), F.col("license"))).alias("license"),
            F.array_sort(F.collect_set(F.when(~whole, F.col("license")))).alias("notices"),
        )
        .select("doc_id", "digest", "license", "notices", F.explode(F.sequence(F.lit(1).cast("long"), "_rows")).alias("_copy"))
        .drop("_copy")
    )
