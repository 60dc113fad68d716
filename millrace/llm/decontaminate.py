"""Benchmark decontamination: a hash set of normalised test n-grams, scanned over the words of every document.

Built-in expressions and joins only. A document's windows are made and looked up inside one stage, so that only windows
that hit leave it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import written
from millrace.sizing import is_small

# What a word is, and the letters that are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The ASCII characters that are in no word once upper-case letters are lower-case ones.
BREAKS = "".join(c for c in map(chr, range(128)) if not (c.isdigit() or c.isalpha()))

WINDOW = 10


def words(text: Column) -> Column:
    """The normalised words of a text; none for a null.

    One pass turns every break into a blank, and the text is split there. Extracting matches of the pattern would give the same
    words, but copies the text for each match.
    """
    blanks = F.translate(text, UPPER + BREAKS, LOWER + " " * len(BREAKS))
    return F.coalesce(F.array_remove(F.split(blanks, " "), ""), F.array().cast("array<string>"))


def _starts(n: Column, size: int | Column) -> Column:
    """1, 2, ... for every window of ``size`` words; none when there are fewer words."""
    return F.when(n >= size, F.sequence(F.lit(1), n - size + 1)).otherwise(F.array().cast("array<int>"))


def _hashes(split: Column, n: Column, size: int) -> Column:
    return F.transform(_starts(n, size), lambda i: F.xxhash64(F.slice(split, i, size)))


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """The windows of test items: ``hash, size, ngram, item_id``, each once per item.

    An item of fewer words than ``window`` is one window of all its words. Items without words have none.
    """
    split = items.select(F.col(item_id).cast("string").alias("item_id"), words(F.col(text)).alias("words"))
    sized = split.withColumn("size", F.least(F.size("words"), F.lit(window))).filter("size > 0")
    starts = sized.select("item_id", "size", "words", F.explode(_starts(F.size("words"), F.col("size"))).alias("start"))
    grams = starts.select("item_id", "size", F.slice("words", F.col("start"), F.col("size")).alias("ngram"))
    return grams.withColumn("hash", F.xxhash64("ngram")).distinct()


def contamination(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """One row per document: ``doc_id, text_key, n_words, n_hit, item_ids, spans``.

    ``spans`` are the hit words as sorted, disjoint ranges ``(first, last)`` of word numbers from 1, and ``item_ids`` the
    items, sorted, of which some window occurs. ``text_key`` is a digest of the text, null for a null text; rows of equal
    id and text have equal results, and each of them comes back. Documents without words have no hits. With no items,
    no document has any. Other columns are ignored.

    Every document meets one marker row in the set besides its hits, so that one pass gives the counts of all documents.
    The shuffle carries a row per document and per hit window, without texts.

    Items without an id count as hits on words but add no id.
    """
    grams = written(item_windows(items, item_id, item_text, window), "ngrams")
    # At most `window` different sizes.
    sizes = sorted(r["size"] for r in grams.select("size").distinct().collect())
    marker = docs.sparkSession.range(1).select(
        F.lit(None).cast("string").alias("item_id"),
        F.lit(0).alias("size"),
        F.array().cast("array<string>").alias("ngram"),
        F.lit(0).cast("long").alias("hash"),
    )
    # One row per window, whatever number of items share it. A window whose hash is the marker's is still told apart by size.
    lookup = grams.groupBy("hash", "size", "ngram").agg(F.collect_set("item_id").alias("items"))
    lookup = lookup.unionByName(marker.select("hash", "size", "ngram", F.array(F.col("item_id")).alias("items")))

    split = docs.select(F.col(doc_id).alias("doc_id"), F.md5(F.col(text)).alias("text_key"), words(F.col(text)).alias("words"))
    split = split.withColumn("n_words", F.size("words"))
    # The marker's hash, then those of all windows, size by size: the place in this array tells which window it is.
    hashes = F.concat(F.array(F.lit(0).cast("long")), *[_hashes(F.col("words"), F.col("n_words"), s) for s in sizes])
    scanned = split.select("doc_id", "text_key", "n_words", "words", F.posexplode(hashes).alias("place", "hash"))
    before = [F.lit(0)]
    for s in sizes:
        before.append(before[-1] + F.greatest(F.col("n_words") - s + 1, F.lit(0)))
    if is_small(lookup):
        # The words stay beside their windows inside the stage; only those of a window whose hash is known are compared.
        start = F.when(F.col("size") == 0, F.col("place"))
        for s, b in zip(sizes, before[:-1], strict=True):
            start = start.when(F.col("size") == s, F.col("place") - b)
        here = F.slice("words", F.greatest(start, F.lit(1)), F.col("size"))
        lookup = F.broadcast(lookup)
    else:
        # The windows are shuffled then, each with its own words instead of those of the whole text.
        start, size = F.when(F.col("place") == 0, 0), F.when(F.col("place") == 0, 0)
        for s, b, until in zip(sizes, before[:-1], before[1:], strict=True):
            start, size = start.when(F.col("place") <= until, F.col("place") - b), size.when(F.col("place") <= until, s)
        here = F.slice("words", F.greatest(start, F.lit(1)), size)
        scanned = scanned.withColumns({"here": here, "start": start}).drop("words")
        start, here = F.col("start"), F.col("here")
    # A conditional, since an equality of words would be taken for a key and worked out for every window.
    same = F.when(F.col("size") == 0, F.col("place") == 0).otherwise((F.col("place") > 0) & (start > 0) & (here == F.col("ngram")))
    hits = (
        scanned.join(lookup, "hash")
        .filter(same)
        .select("doc_id", "text_key", "n_words", start.alias("start"), "size", "items")
    )
    # The items of a window are the same in every document, so sets of them stay small however often a window occurs.
    grouped = hits.groupBy("doc_id", "text_key").agg(
        F.first("n_words").alias("n_words"),
        F.count_if(F.col("size") == 0).alias("_rows"),
        F.collect_set(
            F.when(F.col("size") > 0, F.struct("start", (F.col("start") + F.col("size") - 1).alias("last")))
        ).alias("_ranges"),
        F.collect_set(F.when(F.col("size") > 0, F.col("items"))).alias("_items"),
    )
    merged = grouped.select(
        "doc_id", "text_key", "n_words", "_rows",
        merge_ranges(F.col("_ranges")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten("_items"))).alias("item_ids"),
    )
    return merged.select(
        "doc_id", "text_key",
        F.col("n_words").cast("long").alias("n_words"),
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["start"] + 1).alias("n_hit"),
        "item_ids",
        "spans",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("_rows"))).alias("_copy"),
    ).drop("_copy")


def merge_ranges(ranges: Column) -> Column:
    """Sorted, disjoint ranges that cover the same numbers, from 1 up, as ``ranges`` (struct of ``start`` and ``last``)."""
    kind = "array<struct<start:int,last:int>>"
    ordered = F.array_sort(ranges)
    # Hit windows of one size overlap their neighbours, so a text has far fewer merged ranges than windows.
    return F.aggregate(
        ordered,
        F.struct(F.array().cast(kind).alias("done"), F.lit(0).alias("start"), F.lit(-1).alias("last")),
        lambda a, r: F.when(
            (a["last"] >= 0) & (r["start"] <= a["last"] + 1),
            F.struct(a["done"].alias("done"), a["start"].alias("start"), F.greatest(a["last"], r["last"]).alias("last")),
        ).otherwise(
            F.struct(
                F.when(a["last"] < 0, a["done"])
                .otherwise(F.array_append(a["done"], F.struct(a["start"].alias("start"), a["last"].alias("last"))))
                .alias("done"),
                r["start"].alias("start"),
                r["last"].alias("last"),
            )
        ),
        lambda a: F.when(a["last"] < 0, a["done"]).otherwise(
            F.array_append(a["done"], F.struct(a["start"].alias("start"), a["last"].alias("last")))
        ),
    )


def without_hits(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with the hit words cut out of their texts, and without those of which no word is left.

    ``found`` is what ``contamination`` gave for them. A cut goes from the first character of its first word to the last
    of its last word; what lies around it stays as it is. Documents without hits are unchanged, and keep their nulls. All columns of
    ``docs`` come back. Only the rows of documents with hits are joined, by id and digest of the text.
    """
    cuts = found.filter("n_hit > 0").select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("spans").alias("_spans"),
        (F.col("n_hit") == F.col("n_words")).alias("_all"),
    ).dropDuplicates(["_id", "_key"])
    if is_small(cuts):
        cuts = F.broadcast(cuts)
    # The rows are wrapped, so that no column of theirs is taken for one of these.
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col(doc_id).alias("_at"), F.col(text).alias("_text"))
    same = F.col("_at").eqNullSafe(F.col("_id")) & (F.md5("_text") == F.col("_key"))
    kept = rows.join(cuts, same, "left").filter(~F.coalesce(F.col("_all"), F.lit(False)))
    cut = F.when(F.col("_spans").isNull(), F.col("_text")).otherwise(cut_words(F.col("_text"), F.col("_spans")))
    return kept.select("_row", cut.alias("_text")).select(F.col("_row").withField(text, F.col("_text")).alias("_row")).select("_row.*")


def cut_words(text: Column, spans: Column) -> Column:
    """``text`` without the words numbered in ``spans``, which are sorted and disjoint.

    Words and the pieces between them alternate: piece, word, piece, word, ..., piece. What stays is all pieces but those inside
    a span, and all words outside the spans, so the text is put together from one slice per gap between spans.
    """
    breaks = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    whole = F.array_remove(F.split(text, breaks, -1), "")
    gaps = F.split(text, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", -1)
    # From the end of one span to the start of the next; the piece after a span's last word belongs to the gap.
    firsts = F.concat(F.array(F.lit(1)), F.transform(spans, lambda r: r["last"] + 1))
    lasts = F.concat(F.transform(spans, lambda r: r["start"] - 1), F.array(F.size(whole)))
    bounds = F.zip_with(firsts, lasts, lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    def gap(r: Column) -> Column:
        n = F.greatest(r["b"] - r["a"] + 1, F.lit(0))
        kept = F.zip_with(F.slice(whole, r["a"], n), F.slice(gaps, r["a"] + 1, n), lambda w, p: F.concat(w, F.coalesce(p, F.lit(""))))
        return F.concat(F.element_at(gaps, r["a"]), F.array_join(kept, ""))

    return F.array_join(F.transform(bounds, gap), "")
