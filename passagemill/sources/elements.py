"""Ordered document elements from text lines, conversations and raw pages.

An element table has one row per item in reading order:
``doc_id, pos, kind, label, level, text, self_ref, page_no`` and, for pages,
``group_ref`` and ``excluded``. ``level`` is null for content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_table_like

HEADING_MAX_CHARS = 40
LINES_PER_PAGE = 20

# Tags that start a new block, and markers that cannot occur in text.
BLOCK_TAGS = (
    "title|h[1-6]|p|li|ul|ol|nav|footer|div|article|section|aside|header|main|"
    "table|tr|td|th|blockquote|pre|body|head|html"
)
DROPPED_MARKUP = (
    r"(?is)<script\b.*?</script\s*>",
    r"(?is)<style\b.*?</style\s*>",
    r"(?s)<!--.*?-->",
)
REGION_TAGS = "nav|footer|div|ul|ol"
#: Regions of a page whose states are carried together.
REGION_GROUP = 256
ADVERTISEMENT = '(?i)class="ad"'
ENTITIES = (
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&apos;", "'"),
    ("&ndash;", "–"),
    ("&mdash;", "—"),
    ("&hellip;", "…"),
    ("&lsquo;", "‘"),
    ("&rsquo;", "’"),
    ("&ldquo;", "“"),
    ("&rdquo;", "”"),
    ("&euro;", "€"),
    ("&amp;", "&"),
)
CUT, MARK = "\x01", "\x02"


def line_elements(documents: DataFrame) -> DataFrame:
    """Elements from the lines of ``documents(doc_id, text)``; short lines are headings."""
    lines = documents.select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "text")
    ).where(F.length("text") > 0)
    heading = F.length("text") < HEADING_MAX_CHARS
    label = (
        F.when(heading, F.lit("SECTION_HEADER"))
        .when(is_table_like("text"), F.lit("TABLE"))
        .otherwise(F.lit("TEXT"))
    )
    with_label = lines.withColumn("label", label)
    folder = F.when(F.col("label") == "TABLE", F.lit("#/tables/")).otherwise(F.lit("#/texts/"))
    return with_label.select(
        "doc_id",
        "pos",
        F.when(heading, F.lit("heading")).otherwise(F.lit("content")).alias("kind"),
        "label",
        F.when(heading, 1 + F.length("text") % 3).alias("level"),
        "text",
        F.concat(folder, F.col("pos").cast("string")).alias("self_ref"),
        (F.floor(F.col("pos") / LINES_PER_PAGE) + 1).cast("int").alias("page_no"),
    )


def turn_elements(conversations: DataFrame) -> DataFrame:
    """Elements from conversation turns: system and user turns are headings."""
    role = F.col("role")
    level = F.when(role == "system", 0).when(role == "user", 1)
    return conversations.select(
        F.col("conv_id").alias("doc_id"),
        F.col("turn").cast("int").alias("pos"),
        F.when(level.isNotNull(), F.lit("heading")).otherwise(F.lit("content")).alias("kind"),
        F.when(level == 0, F.lit("TITLE"))
        .when(level == 1, F.lit("SECTION_HEADER"))
        .otherwise(F.lit("TEXT"))
        .alias("label"),
        level.alias("level"),
        "text",
        F.concat(F.lit("#/texts/"), F.col("turn").cast("string")).alias("self_ref"),
        F.lit(1).alias("page_no"),
    )


def _marked(html: Column, tags: str) -> Column:
    """``html`` cut before each of ``tags``; name and attributes precede the text."""
    return F.regexp_replace(html, rf"(?i)<(/?(?:{tags}))\b([^>]*)>", f"{CUT}$1{MARK}$2{MARK}")


def _regions(html: Column) -> Column:
    """A page cut at the tags that open or close an excluded region or a list."""
    for pattern in DROPPED_MARKUP:
        html = F.regexp_replace(html, pattern, "")
    pieces = F.split(F.concat(F.lit(MARK + MARK), _marked(html, REGION_TAGS)), CUT)
    return F.transform(
        pieces,
        lambda r: F.struct(
            F.lower(F.substring_index(r, MARK, 1)).alias("tag"),
            F.substring_index(F.substring_index(r, MARK, 2), MARK, -1)
            .rlike(ADVERTISEMENT)
            .alias("ad"),
            F.substring_index(r, MARK, -1).alias("body"),
        ),
    )


def _states(regions: Column) -> Column:
    """Whether each region is excluded, and the number of the innermost list open there.

    Depths per tag are carried from region to region, so tags may nest; a closing
    tag without an opening one changes nothing. ``ad`` is the depth of the outermost
    open advertisement among its ``div``s.
    """
    none = F.lit(0)
    depths = ("nav", "footer", "div", "ad", "seen")
    state_type = "struct<excluded: boolean, group_no: int>"

    def step(acc: Column, region: Column) -> Column:
        tag, lists = region["tag"], acc["lists"]

        def depth(name: str) -> Column:
            return (
                F.when(tag == name, acc[name] + 1)
                .when(tag == f"/{name}", F.greatest(acc[name] - 1, none))
                .otherwise(acc[name])
            )

        nav, footer, div = depth("nav"), depth("footer"), depth("div")
        ad = (
            F.when((acc["ad"] == 0) & (tag == "div") & region["ad"], div)
            .when(acc["ad"] > div, none)
            .otherwise(acc["ad"])
        )
        opens = tag.isin("ul", "ol")
        seen = acc["seen"] + opens.cast("int")
        lists = (
            F.when(opens, F.concat(lists, F.array(seen)))
            .when(tag.isin("/ul", "/ol"), F.slice(lists, 1, F.greatest(F.size(lists) - 1, none)))
            .otherwise(lists)
        )
        state = F.struct(
            ((nav > 0) | (footer > 0) | (ad > 0)).alias("excluded"),
            F.try_element_at(lists, F.lit(-1)).alias("group_no"),
        )
        return F.struct(
            nav.alias("nav"),
            footer.alias("footer"),
            div.alias("div"),
            ad.alias("ad"),
            seen.alias("seen"),
            lists.alias("lists"),
            F.concat(acc["out"], F.array(state)).alias("out"),
        )

    # An array that grows by one is copied each time, so regions are taken in groups:
    # only the states of a group are copied per region, and one entry per group per group.
    def group(acc: Column, members: Column) -> Column:
        start = F.struct(
            *[acc[c].alias(c) for c in (*depths, "lists")], F.array().cast(f"array<{state_type}>").alias("out")
        )
        done = F.aggregate(members, start, step)
        return F.struct(
            *[done[c].alias(c) for c in (*depths, "lists")], F.concat(acc["groups"], F.array(done["out"])).alias("groups")
        )

    first = F.struct(
        *[none.alias(c) for c in depths],
        F.array().cast("array<int>").alias("lists"),
        F.array().cast(f"array<array<{state_type}>>").alias("groups"),
    )
    starts = F.sequence(F.lit(1), F.size(regions), F.lit(REGION_GROUP))
    groups = F.transform(starts, lambda s: F.slice(regions, s, REGION_GROUP))
    return F.aggregate(groups, first, group, lambda acc: F.flatten(acc["groups"]))


def _pieces(regions: Column, states: Column) -> Column:
    """Blocks of a page in order, each with its tag, region and list number."""

    def blocks(region: Column, state: Column) -> Column:
        body = F.concat(region["tag"], F.lit(MARK), _marked(region["body"], BLOCK_TAGS))
        return F.transform(
            F.split(body, CUT),
            lambda b: F.struct(
                state["excluded"].alias("excluded"),
                state["group_no"].alias("group_no"),
                F.lower(F.substring_index(b, MARK, 1)).alias("tag"),
                F.substring_index(b, MARK, -1).alias("raw"),
            ),
        )

    return F.flatten(F.zip_with(regions, states, blocks))


def _numeric_entities(text: Column) -> Column:
    """``&#39;`` and ``&#x27;`` resolved; numbers that are no character stay as they are."""

    def resolved(part: Column, at: Column) -> Column:
        digits = F.regexp_extract(part, r"^([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});", 1)
        code = F.when(
            digits.rlike("^[xX]"), F.conv(F.substring(digits, 2, 6), 16, 10).cast("int")
        ).when(digits != "", digits.try_cast("int"))
        valid = ((code > 31) & (code < 0xD800)) | ((code > 0xDFFF) & (code <= 0x10FFFF))
        sign = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code)), 8, "0")), "UTF-32")
        rest = F.substring(part, F.length(digits) + 2, F.length(part))
        return F.when(at == 0, part).otherwise(
            F.coalesce(F.concat(sign, rest), F.concat(F.lit("&#"), part))
        )

    parts = F.transform(F.split(text, "&#"), resolved)
    return F.when(F.contains(text, F.lit("&#")), F.array_join(parts, "")).otherwise(text)


def plain_text(markup: Column) -> Column:
    """Text of a block: inline tags dropped, known entities resolved, spaces squeezed."""
    text = _numeric_entities(F.regexp_replace(markup, r"<[^>]*>", " "))
    for entity, sign in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(sign))
    return F.trim(F.regexp_replace(text, r"[ \t\r\n]+", " "))


def page_elements(pages: DataFrame) -> DataFrame:
    """Elements of ``pages(page_id, html)``, parsed inside the row without a shuffle.

    Items of navigation, footer and advertisement blocks are flagged ``excluded``,
    up to the tag that closes the block; list items carry the reference of their
    innermost list.
    """
    tag = F.col("p.tag")
    level = F.when(tag == "title", 0).when(
        tag.rlike("^h[1-6]$"), F.substring(tag, 2, 1).try_cast("int")
    )
    regions = pages.select(F.col("page_id").alias("doc_id"), _regions(F.col("html")).alias("r"))
    exploded = regions.select("doc_id", "r", _states(F.col("r")).alias("s")).select(
        "doc_id", F.posexplode(_pieces(F.col("r"), F.col("s"))).alias("pos", "p")
    )
    return exploded.select(
        "doc_id",
        "pos",
        F.when(level.isNotNull(), F.lit("heading")).otherwise(F.lit("content")).alias("kind"),
        F.when(level == 0, F.lit("TITLE"))
        .when(level > 0, F.lit("SECTION_HEADER"))
        .when(tag == "li", F.lit("LIST_ITEM"))
        .otherwise(F.lit("TEXT"))
        .alias("label"),
        level.alias("level"),
        plain_text(F.col("p.raw")).alias("text"),
        F.concat(F.lit("#/texts/"), F.col("pos").cast("string")).alias("self_ref"),
        F.lit(1).alias("page_no"),
        F.when(
            tag == "li", F.concat(F.lit("#/groups/"), F.col("p.group_no").cast("string"))
        ).alias("group_ref"),
        F.col("p.excluded").alias("excluded"),
    ).where(F.length("text") > 0)


def collapse_groups(elements: DataFrame) -> DataFrame:
    """One row per list: its items' texts joined by line, at the first item's position."""
    plain = [c for c in elements.columns if c not in ("group_ref",)]
    single = elements.where(F.col("group_ref").isNull()).select(*plain)
    first = [
        F.min_by(c, "pos").alias(c)
        for c in plain
        if c not in ("doc_id", "text", "pos", "kind", "label", "self_ref")
    ]
    merged = (
        elements.where(F.col("group_ref").isNotNull())
        .groupBy("doc_id", "group_ref")
        .agg(
            F.min("pos").alias("pos"),
            F.array_join(
                F.transform(
                    F.sort_array(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]
                ),
                "\n",
            ).alias("text"),
            *first,
        )
        .withColumn("kind", F.lit("content"))
        .withColumn("label", F.lit("LIST"))
        .withColumnRenamed("group_ref", "self_ref")
    )
    return single.unionByName(merged.select(*plain))


def exclude_refs(elements: DataFrame, excluded_refs: DataFrame) -> DataFrame:
    """Elements whose ``(doc_id, self_ref)`` is not in ``excluded_refs``."""
    refs = excluded_refs.select("doc_id", "self_ref")
    return elements.join(refs, ["doc_id", "self_ref"], "left_anti")
