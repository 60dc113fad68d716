"""Walk of nested parse results of unknown shape, inside the row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import let, strip
from millrace.session import written

# Keys under which parse results keep text and page numbers, and the element types that are titles.
CONTENT_KEYS = ["content", "text"]
PAGE_KEYS = ["page_id", "page_number", "page", "page_no", "pageIndex"]
TITLE_TYPES = ["title", "header", "section_header", "sectionheader", "heading"]

NODE_TYPE = "array<struct<place:array<int>,page:int,fields:map<string,variant>,items:array<variant>>>"


def _node(place: Column, page: Column, value: Column) -> Column:
    """A node with its place in reading order. An object changes the current page for itself and what lies below it."""

    def build(fields: Column) -> Column:
        own_page = F.lit(None).cast("int")
        for key in reversed(PAGE_KEYS):
            # The first page key that is present decides, even when its value is no number.
            found = F.try_variant_get(value, f"$.{key}", "int")
            own_page = F.when(F.map_contains_key(fields, key), found).otherwise(own_page)
        return F.struct(
            place.alias("place"),
            F.coalesce(F.when(fields.isNotNull(), own_page), page).alias("page"),
            fields.alias("fields"),
            F.when(fields.isNull(), value.try_cast("array<variant>")).alias("items"),
        )

    return let(value.try_cast("map<string,variant>"), build)


def _children(node: Column) -> Column:
    values = F.coalesce(node["items"], F.map_values(node["fields"]), F.array().cast("array<variant>"))
    return F.transform(
        values, lambda value, i: _node(F.concat(node["place"], F.array(i)), node["page"], value)
    )


def _is_open(node: Column) -> Column:
    return node["fields"].isNotNull() | node["items"].isNotNull()


def _text(node: Column) -> Column:
    """The first usable text of an object: a string that is not blank."""

    def usable(value: Column) -> Column:
        is_string = F.schema_of_variant(value) == "STRING"
        return let(strip(F.when(is_string, value.try_cast("string"))), lambda text: F.when(text != "", text))

    return F.coalesce(*[let(F.try_element_at(node["fields"], F.lit(key)), usable) for key in CONTENT_KEYS])


def _kind(node: Column) -> Column:
    value = F.try_element_at(node["fields"], F.lit("type"))
    return F.lower(strip(F.coalesce(value.try_cast("string"), F.lit(""))))


ELEMENTS_TYPE = "array<struct<page:int,type:string,text:string>>"
FOUND_TYPE = "array<struct<place:array<int>,page:int,type:string,text:string>>"


def _found(nodes: Column) -> Column:
    """The texts among some nodes, with their place."""
    texts = F.transform(
        F.filter(nodes, lambda n: n["fields"].isNotNull()),
        lambda n: F.struct(n["place"].alias("place"), n["page"].alias("page"), _kind(n).alias("type"), _text(n).alias("text")),
    )
    return F.filter(texts, lambda n: n["text"].isNotNull())


def _in_order(found: Column) -> Column:
    return F.transform(
        F.sort_array(found), lambda n: F.struct(n["page"].alias("page"), n["type"].alias("type"), n["text"].alias("text"))
    )


def _opened(nodes: Column) -> Column:
    """The nodes one level below; only objects and lists have any."""
    return F.flatten(F.transform(F.filter(nodes, _is_open), _children)).cast(NODE_TYPE)


def _levels(df: DataFrame, nodes: Column, depth: int) -> tuple[DataFrame, list[str]]:
    """A column of nodes for each level of nesting from ``nodes`` down to ``depth``."""
    names = [f"_level{n}" for n in range(depth + 1)]
    for name in names:
        df = df.withColumn(name, nodes.cast(NODE_TYPE))
        nodes = _opened(F.col(name))
    return df, names


def _root(parsed: str) -> Column:
    return F.array(_node(F.array().cast("array<int>"), F.lit(0), F.col(parsed))).cast(NODE_TYPE)


def walk_elements(df: DataFrame, parsed: str, out: str = "elements", max_depth: int = 6) -> DataFrame:
    """Add ``array<struct<page, type, text>>`` of all text found in the VARIANT column ``parsed``, depth first, and ``error_status``.

    Objects and lists are opened level by level, one column per level, so neither a shuffle nor state is needed and the
    same code runs on streams. Keys of an object come in VARIANT order, which is by name. A document nested deeper than ``max_depth`` has no
    elements and says so in ``error_status``, and other documents are not affected; :func:`walk_any_depth` walks those too. NULL has no elements, and is
    ``empty``. An ``error_status`` that is there already stays.
    """
    if max_depth < 1:
        raise ValueError("max_depth must be at least 1")
    kept = [c for c in df.columns if c not in (out, "error_status")]
    before = F.col("error_status") if "error_status" in df.columns else F.lit(None).cast("string")
    leveled, names = _levels(df.withColumn("error_status", before), _root(parsed), max_depth)
    too_deep = F.exists(_opened(F.col(names[-1])), _is_open)
    elements = _in_order(F.concat(*[_found(F.col(name)) for name in names]))
    status = F.when(F.col(parsed).isNull(), "empty").when(too_deep, f"nested deeper than {max_depth} levels")
    return leveled.select(
        *kept,
        F.when(F.col(parsed).isNull() | too_deep, F.array().cast(ELEMENTS_TYPE)).otherwise(elements).alias(out),
        F.coalesce("error_status", status).alias("error_status"),
    )


def walk_any_depth(df: DataFrame, parsed: str, out: str = "elements", max_depth: int = 6) -> DataFrame:
    """:func:`walk_elements` for batches, with documents of any depth.

    Those deeper than ``max_depth`` are taken by themselves: each step opens that many levels more, and what is still open below becomes rows of a
    written table, until nothing is left to open. So a deep document costs some steps, and shallow ones nothing.
    """
    deeper = f"nested deeper than {max_depth} levels"
    walked = written(walk_elements(df, parsed, out, max_depth).withColumn("_doc", F.monotonically_increasing_id()), "walked")
    deep = walked.filter(F.col("error_status") == deeper)
    if not deep.head(1):
        return walked.drop("_doc")
    front = written(deep.select("_doc", _root(parsed).alias("nodes")), "nodes")
    found = None
    while front.head(1):
        leveled, names = _levels(front, F.col("nodes"), max_depth)
        texts = F.concat(*[_found(F.col(name)) for name in names]).cast(FOUND_TYPE)
        opened = leveled.select("_doc", texts.alias("_texts"), _opened(F.col(names[-1])).alias("_below"))
        opened = written(opened, "opened")
        texts = opened.select("_doc", F.explode("_texts").alias("e"))
        found = texts if found is None else found.unionByName(texts)
        # One row per node, so that a level with very many is spread.
        front = opened.select("_doc", F.explode("_below").alias("node")).select("_doc", F.array("node").alias("nodes"))
    elements = found.groupBy("_doc").agg(_in_order(F.collect_list("e")).alias("_deep"))
    rest = deep.join(elements, "_doc", "left").select(
        *[F.coalesce("_deep", F.col(out)).alias(out) if c == out else F.lit(None).cast("string").alias(c) if c == "error_status" else F.col(c)
          for c in walked.columns if c != "_doc"]
    )
    shallow = walked.filter(~F.col("error_status").eqNullSafe(deeper)).drop("_doc")
    return shallow.unionByName(rest)
