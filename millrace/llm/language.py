"""Language by compression: the language whose dictionary makes a text smallest."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
SAMPLES, EXCERPT = 64, 1_000
SEGMENT = 2_000
NARROW = 0.02
LEVEL = 5
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


@dataclass(frozen=True)
class Dictionaries:
    """Raw-content dictionaries by language."""

    content: dict[str, bytes]


def letters(text: str) -> str:
    """Lower-case words of letters and the marks on them, one blank between. Numbers such as ² or Ⅷ are no letters; what is no letter says
    nothing about the language."""
    return " ".join(WORD.findall(text.lower()))


def learn_dictionaries(
    docs: DataFrame, lang: str = "lang", text: str = "text", samples: int = SAMPLES, excerpt: int = EXCERPT
) -> Dictionaries:
    """One dictionary per language from a bounded sample of the labelled rows.

    The bound: at most ``samples`` texts of each language, and ``excerpt`` characters of each. The rows of a language fall
    into ``samples`` classes by a hash of the text, and the text of the least hash in each is taken, so copies count once
    and no language is gathered anywhere: it is a minimum per class. Rows without language or letters are left out.
    """
    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    hashed = rows.withColumn("h", F.xxhash64("text")).select(
        "lang", F.pmod("h", F.lit(samples)).alias("class"), F.struct("h", F.substr("text", F.lit(1), F.lit(excerpt)).alias("t")).alias("x")
    )
    taken = hashed.groupBy("lang", "class").agg(F.min("x").alias("x")).select("lang", "class", "x.t").collect()
    content: dict[str, list[str]] = {}
    for row in sorted(taken, key=lambda r: (r["lang"], r["class"])):
        content.setdefault(row["lang"], []).append(letters(row["t"]))
    return Dictionaries({k: " ".join(v).encode() for k, v in content.items()})


_compressors: dict[int, dict] = {}


def _ready(model: Dictionaries) -> dict:
    import zstandard

    key = hash(tuple(sorted(model.content.items())))
    if key not in _compressors:
        made = {}
        for name, content in sorted(model.content.items()):
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=LEVEL)
            made[name] = zstandard.ZstdCompressor(
                level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False
            )
        _compressors.clear()
        _compressors[key] = made
    return _compressors[key]


def sizes(text: str, model: Dictionaries) -> dict[str, int]:
    """Compressed size of the whole text by language. It is cut into segments, so that its beginning does not serve its end."""
    data = letters(text).encode()
    parts = [data[i : i + SEGMENT] for i in range(0, len(data), SEGMENT)]
    return {name: sum(len(c.compress(p)) for p in parts) for name, c in _ready(model).items()} if data else {}


def verdict(found: dict[str, int], narrow: float = NARROW) -> tuple[str, float, bool]:
    """Language, score and whether the margin over the second best is too narrow. Equal sizes go to the first in the alphabet."""
    if not found:
        return UNKNOWN, 0.0, True
    ranked = sorted(found.items(), key=lambda x: (x[1], x[0]))
    margin = (ranked[1][1] - ranked[0][1]) / ranked[1][1] if len(ranked) > 1 else 1.0
    return ranked[0][0], 1 - math.exp(-margin / 0.05) / 2, margin < narrow


PREDICTED = "doc_id long, lang_pred string, score double, rejected boolean"


def predict_language(docs: DataFrame, model: Dictionaries, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` for every row.

    ``rejected`` marks a margin under ``NARROW``, where callers should not trust the language. A text that is null, or has no
    letter, is ``und`` with a score of 0 and rejected, and so is every text when no language was learned. Repeated rows come
    back repeated, an empty table gives no rows, and other columns are never read. A very long text is compressed whole, a segment at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [verdict(sizes(t.as_py() or "", model)) for t in batch.column(1)]
            columns = list(zip(*rows, strict=True)) if rows else [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(columns[0], pa.string()),
                    pa.array(columns[1], pa.float64()),
                    pa.array(columns[2], pa.bool_()),
                ],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return given.mapInArrow(run, PREDICTED)
