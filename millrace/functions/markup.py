"""HTML to a list of typed text elements, inside the row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import let, strip

BLOCK_TAGS = "title|h[1-6]|p|li|div|pre|blockquote|td|th"
# Tags that tell what a part of a page is for. What lies inside navigation, or in a footer that belongs to no article, frames the page.
FRAME_TAGS = "nav|footer|article|main"
# An open end counts as the end, so that a page that was cut off shows no script as text.
HIDDEN_BLOCKS = r"(?is)<script.*?(?:</script>|\z)|<style.*?(?:</style>|\z)|<!--.*?(?:-->|\z)"
FRAME_TAG = rf"(?i)<(/?(?:{FRAME_TAGS}))(?:\s[^>]*)?>"
BLOCK_START = rf"(?i)<({BLOCK_TAGS})(\s[^>]*)?>"
BLOCK_END = rf"(?i)</(?:{BLOCK_TAGS})\s*>"
ANY_TAG = r"<[a-zA-Z/!?][^>]*(?:>|\z)"
SPACE_RUN = r"[ \n\t\r]+"

# Marks put in front of each block, between its tag and its text, and in front of each frame tag.
ELEMENT_MARK = "\x01"
TYPE_MARK = "\x02"
FRAME_MARK = "\x03"

# Character names, decoded in this order; the ampersand comes last so that nothing is decoded twice.
CHARACTER_NAMES = {
    "&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&#39;": "'", "&copy;": "\xa9", "&reg;": "\xae", "&middot;": "\xb7",
    "&laquo;": "\xab", "&raquo;": "\xbb", "&ndash;": "\u2013", "&mdash;": "\u2014", "&hellip;": "\u2026", "&euro;": "\u20ac", "&amp;": "&",
}

ELEMENT_TYPE = "array<struct<type:string,text:string>>"
DEPTHS = "struct<nav:int,footer:int,body:int,frames:array<string>>"


def element_type(tag: Column) -> Column:
    name = F.lower(tag)
    return (
        F.when(name == "title", "title")
        .when(name.rlike("^h[1-6]$"), "heading")
        .when(name == "li", "list_item")
        .otherwise("text")
    )


def _frames(tags: Column) -> Column:
    """For each part of a page, what it is part of: ``navigation``, the page's ``footer``, or NULL. ``tags`` are those that the parts begin with.

    Open elements are counted. A closing tag without an opening one counts for nothing, and what is never closed reaches to the end.
    """

    def depth(now: Column, tag: Column, *names: str) -> Column:
        step = F.when(tag.isin(*names), 1).when(tag.isin(*[f"/{n}" for n in names]), -1).otherwise(0)
        return F.greatest(F.lit(0), now + step)

    def step(state: Column, tag: Column) -> Column:
        nav, footer, body = depth(state["nav"], tag, "nav"), depth(state["footer"], tag, "footer"), depth(state["body"], tag, "article", "main")
        frame = F.when(nav > 0, "navigation").when((footer > 0) & (body == 0), "footer")
        return F.struct(
            nav.alias("nav"), footer.alias("footer"), body.alias("body"), F.concat(state["frames"], F.array(frame)).alias("frames")
        ).cast(DEPTHS)

    none = F.struct(F.lit(0), F.lit(0), F.lit(0), F.array().cast("array<string>")).cast(DEPTHS)
    return F.aggregate(tags, none, step)["frames"]


def html_elements(html: Column) -> Column:
    """``array<struct<type, text>>`` in reading order. Text outside of any block counts as a text element.

    A block ends where the next begins, or at its closing tag. All text inside navigation is of type ``navigation``, and all in a footer outside
    of articles and the main part is of type ``footer``.
    """
    clean = F.translate(F.coalesce(html, F.lit("")), ELEMENT_MARK + TYPE_MARK + FRAME_MARK, "")
    visible = F.regexp_replace(clean, HIDDEN_BLOCKS, "")
    parts = F.split(F.concat(F.lit(TYPE_MARK), F.regexp_replace(visible, FRAME_TAG, f"{FRAME_MARK}$1{TYPE_MARK}")), FRAME_MARK)

    def element(block: Column, frame: Column) -> Column:
        text = F.regexp_replace(F.substring_index(block, TYPE_MARK, -1), ANY_TAG, " ")
        for name, char in CHARACTER_NAMES.items():
            text = F.replace(text, F.lit(name), F.lit(char))
        return F.struct(
            F.coalesce(frame, element_type(F.substring_index(block, TYPE_MARK, 1))).alias("type"),
            strip(F.regexp_replace(text, SPACE_RUN, " ")).alias("text"),
        )

    def blocks(part: Column, frame: Column) -> Column:
        marked = F.regexp_replace(F.substring_index(part, TYPE_MARK, -1), BLOCK_START, f"{ELEMENT_MARK}$1{TYPE_MARK}")
        marked = F.regexp_replace(marked, BLOCK_END, f"{ELEMENT_MARK}p{TYPE_MARK}")
        return F.transform(F.split(F.concat(F.lit(f"p{TYPE_MARK}"), marked), ELEMENT_MARK), lambda block: element(block, frame))

    def whole(found: Column) -> Column:
        tags = F.transform(found, lambda part: F.lower(F.substring_index(part, TYPE_MARK, 1)))
        return let(_frames(tags), lambda frames: F.flatten(F.transform(found, lambda part, i: blocks(part, F.get(frames, i)))))

    return F.filter(let(parts, whole), lambda e: e["text"] != "")


def html_error(html: Column) -> Column:
    """Why a page cannot be used, or NULL: ``empty``."""
    return F.when(strip(F.coalesce(html, F.lit(""))) == "", "empty")


def html_warning(html: Column) -> Column:
    """``truncated`` when a page that can be used has no closing tag at its end, or NULL."""
    body = strip(F.coalesce(html, F.lit("")))
    return F.when((body != "") & ~F.endswith(F.lower(body), F.lit("</html>")), "truncated")
