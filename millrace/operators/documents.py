"""Parsed documents to pages, and pages to chunks with citations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.markup import html_elements, html_error, html_warning
from millrace.functions.nested import TITLE_TYPES
from millrace.functions.text import let, pii_engine, windows

# Sizes of windows, the columns of chunks and of citations, and the form of ids and citations below.
CHUNK_SIZE = 1000
CHUNK_OVERLAP = 150
MIN_CHUNK_CHARS = 50

CHUNK_SCHEMA = T.StructType(
    [
        T.StructField("chunk_id", T.StringType()),
        T.StructField("chunk_content", T.StringType()),
        T.StructField("chunk_to_embed", T.StringType()),
        T.StructField("chunk_position", T.IntegerType()),
        T.StructField("source_uri", T.StringType()),
        T.StructField("path", T.StringType()),
    ]
)
CITATION_COLUMNS = ["chunk_id", "chunk_content", "source_uri", "chunk_position"]

# Element types that frame a web page rather than say something.
FRAME_TYPES = ("navigation", "footer")


def parse_html(
    df: DataFrame, path: Column, html: Column, elements_per_page: int = 10, keep: tuple[str, ...] = ()
) -> DataFrame:
    """One row per document: ``path``, ``elements`` (page, type, text), ``error_status``, ``warning`` and the columns to ``keep``.

    Only a page without anything is an error. One that was cut off keeps what it has, with a warning. Web pages have no page breaks, so every ``elements_per_page`` elements make a page.
    """
    if elements_per_page < 1:
        raise ValueError("elements_per_page must be at least 1")
    numbered = F.transform(
        html_elements(html),
        lambda e, i: F.struct(
            F.floor(i / elements_per_page).cast("int").alias("page"), e["type"].alias("type"), e["text"].alias("text")
        ),
    )
    return df.select(path.alias("path"), *keep, numbered.alias("elements"), html_error(html).alias("error_status"), html_warning(html).alias("warning"))


def parse_plain(df: DataFrame, path: Column, text: Column) -> DataFrame:
    """Plain text parsed as a single element on page 0."""
    element = F.struct(F.lit(0).alias("page"), F.lit("text").alias("type"), text.alias("text"))
    blank = F.coalesce(F.trim(text), F.lit("")) == ""
    return df.select(
        path.alias("path"),
        F.array(element).alias("elements"),
        F.when(blank, "empty").alias("error_status"),
    )


def readable(parsed: DataFrame) -> DataFrame:
    """Leave out documents that failed to parse; they must not reach retrieval."""
    return parsed.filter(F.col("error_status").isNull())


def elements(parsed: DataFrame) -> DataFrame:
    """One row per element, with its position in the document."""
    return parsed.select("path", F.posexplode("elements").alias("position", "e")).select("path", "position", "e.*")


def assemble_pages(elements: Column) -> Column:
    """``array<struct<page, title, text>>`` ordered by page.

    The text of a page is its elements in order, one per line. Its title is its first title or heading, else the first of
    the document, else empty. Elements are sorted by page once and cut at the page changes, so the cost does not grow with
    pages times elements, and it needs neither a shuffle nor state.
    """
    is_title = lambda e: F.lower(F.trim(e["type"])).isin(TITLE_TYPES)
    placed = F.transform(
        elements,
        lambda e, i: F.struct(
            e["page"].alias("page"), i.alias("i"), is_title(e).alias("is_title"), e["text"].alias("text")
        ),
    )

    def cut(ordered: Column) -> Column:
        size = F.size(ordered)
        firsts = F.filter(
            F.transform(ordered, lambda _, i: i),
            lambda i: (i == 0) | (F.get(ordered, i)["page"] != F.get(ordered, i - 1)["page"]),
        )
        return let(
            firsts,
            lambda starts: F.transform(
                starts,
                lambda start, n: page(F.slice(ordered, start + 1, F.coalesce(F.get(starts, n + 1), size) - start)),
            ),
        )

    def page(members: Column) -> Column:
        return F.struct(
            F.get(members, F.lit(0))["page"].alias("page"),
            F.get(F.filter(members, lambda e: e["is_title"]), F.lit(0))["text"].alias("title"),
            F.array_join(F.transform(members, lambda e: e["text"]), "\n").alias("text"),
        )

    document_title = F.get(F.filter(elements, is_title), F.lit(0))["text"]
    pages = let(
        F.coalesce(document_title, F.lit("")),
        lambda fallback: F.transform(
            let(F.sort_array(placed), cut),
            lambda p: F.struct(
                p["page"].alias("page"), F.coalesce(p["title"], fallback).alias("title"), p["text"].alias("text")
            ),
        ),
    )
    # Plain texts are a single element, which is its own page.
    only = F.get(elements, F.lit(0))
    title = F.when(is_title(only), only["text"]).otherwise("")
    single = F.struct(only["page"].alias("page"), title.alias("title"), only["text"].alias("text"))
    return F.when(F.size(elements) == 1, F.array(single)).otherwise(pages)


def document_pages(parsed: DataFrame, skip_types: tuple[str, ...] = (), engine: str = "regex") -> DataFrame:
    """One row per page of each readable document, with title and text already redacted."""
    mask = pii_engine(engine)
    kept = F.filter("elements", lambda e: ~e["type"].isin(list(skip_types))) if skip_types else F.col("elements")
    return (
        readable(parsed)
        .select("path", F.explode(assemble_pages(kept)).alias("p"))
        .select("path", "p.page", mask(F.col("p.title")).alias("title"), mask(F.col("p.text")).alias("text"))
    )


def chunk_id(path: Column, page: Column, position: Column) -> Column:
    """The same place in the same document always gets the same id."""
    return F.sha1(F.concat_ws("::", path, page.cast("string"), position.cast("string")))


def chunk_pages(
    pages: DataFrame,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    min_chars: int = MIN_CHUNK_CHARS,
    engine: str = "regex",
) -> DataFrame:
    """Redacted pages to the six chunk columns.

    Redaction happened before cutting, so no window can hold half a number. The text to embed joins title and chunk, which
    may form a new number across the line break, so it is redacted again.
    """
    mask = pii_engine(engine)
    cut = pages.select(
        "path",
        "page",
        F.coalesce("title", F.lit("")).alias("title"),
        F.posexplode(windows(F.col("text"), size, overlap, min_chars)).alias("chunk_position", "chunk_content"),
    )
    return cut.select(
        chunk_id(F.col("path"), F.col("page"), F.col("chunk_position")).alias("chunk_id"),
        "chunk_content",
        mask(F.concat_ws("\n", "title", "chunk_content")).alias("chunk_to_embed"),
        "chunk_position",
        F.concat("path", F.lit(" (p."), F.col("page").cast("string"), F.lit(")")).alias("source_uri"),
        "path",
    )


def chunk_documents(parsed: DataFrame, skip_types: tuple[str, ...] = (), engine: str = "regex", **window: int) -> DataFrame:
    """Parsed documents to chunks; rows in, rows out, so it runs on streams as well."""
    return chunk_pages(document_pages(parsed, skip_types, engine), engine=engine, **window)


def prechunked(df: DataFrame, path: Column, contents: Column, source_uri: Column, engine: str = "regex") -> DataFrame:
    """Chunks that arrive ready-made in a VARIANT list, brought to the same six columns and redacted.

    ``contents`` holds objects with chunk_id, chunk_position, chunk_content and chunk_to_embed. Documents with an ``error_status``, if there is such a
    column, give no chunks; neither do items without id, which no index could keep apart.
    """
    mask = pii_engine(engine)
    df = readable(df) if "error_status" in df.columns else df
    items = df.select(
        path.alias("path"), source_uri.alias("source_uri"), F.explode(contents.try_cast("array<variant>")).alias("c")
    )
    get = lambda name, kind: F.try_variant_get("c", f"$.{name}", kind)
    return items.select(
        get("chunk_id", "string").alias("chunk_id"),
        mask(get("chunk_content", "string")).alias("chunk_content"),
        mask(get("chunk_to_embed", "string")).alias("chunk_to_embed"),
        get("chunk_position", "int").alias("chunk_position"),
        "source_uri",
        "path",
    ).filter("chunk_id is not null")
