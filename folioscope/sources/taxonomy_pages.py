"""Category taxonomies published as web pages.

A page heads each main category with ``<h2 class="accordion-head">`` and lists
one sub-category per ``<div class="columns divided">``, as
``<h4>code <span>(Description)</span></h4>``.
"""

import json
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions.categories import main_category_of
from folioscope.functions.columns import ColumnLike, as_column
from folioscope.functions.text import strip_parens

# The page's markup, and the code of its column-heading entry.
ENTRY_BLOCK = r'(?i)<div[^>]*\bclass="columns divided"[^>]*>'
ENTRY_HEAD = r"(?is)<h4[^>]*>(.*?)</h4>"
ENTRY_SPAN = r"(?is)<span[^>]*>(.*?)</span>"
LINK = r'(?is)<a\s[^>]*href="([^"]*)"[^>]*>(.*?)</a>'
HEADING = r"(?is)<h1[^>]*>(.*?)</h1>"
MAIN_HEAD = r'(?is)<h2[^>]*\bclass="accordion-head"[^>]*>(.*?)</h2>'
HEADING_CODE = "Category"

# The opening and closing tags of blocks, and a character reference.
BLOCK_TAG = r"(?i)<(/?)div\b[^>]*>"
REFERENCE = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"

#: Names of character references: those of HTML 4, as the standard library lists them, and the apostrophe's. A no-break space reads as a blank.
NAMES = {name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'", "nbsp": " "}

#: What stands for a number that is no character.
NO_CHARACTER = "\ufffd"


def _character(name: Column) -> Column:
    """The character that a reference names, by number or name; an unknown name stays as it is written."""
    digits = F.when(name.rlike("^#[xX]"), F.conv(F.substr(name, F.lit(3)), 16, 10)).otherwise(F.substr(name, F.lit(2)))
    code = F.when(name.startswith("#"), digits.cast("long"))
    valid = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    by_number = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code)), 8, "0")), "UTF-32")
    by_name = F.element_at(F.from_json(F.lit(json.dumps(NAMES)), "map<string,string>"), name)
    return (
        F.when(code.isNull(), F.coalesce(by_name, F.concat(F.lit("&"), name, F.lit(";"))))
        .when(valid, by_number)
        .otherwise(F.lit(NO_CHARACTER))
    )


def decoded(text: ColumnLike) -> Column:
    """A text with its character references resolved, once: ``&amp;lt;`` gives ``&lt;``.

    The text is cut at its references and put together again with a character in each gap.
    """
    text = as_column(text)
    characters = F.transform(F.regexp_extract_all(text, F.lit(REFERENCE), 1), _character)
    between = F.concat(characters, F.array(F.lit("")))
    pieces = F.zip_with(F.split(text, REFERENCE), between, lambda plain, char: F.concat(plain, char))
    return F.when(F.contains(text, F.lit("&")), F.array_join(pieces, "")).otherwise(text)


def own_block(rest: ColumnLike) -> Column:
    """Of the text after a block's opening tag, what lies within that block: up to the closing tag of its own depth.

    Depth rises by one at each opening tag and falls at each closing one. A block that is never closed ends with the text.
    """
    rest = as_column(rest)
    tags = F.regexp_extract_all(rest, F.lit(BLOCK_TAG), 1)

    def step(state: Column, tag: Column) -> Column:
        depth = state["depth"] + F.when(tag == "/", -1).otherwise(1)
        inside = state["depth"] > 0
        return F.struct(F.when(inside, depth).otherwise(0).alias("depth"), (state["pieces"] + inside.cast("int")).alias("pieces"))

    begin = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("pieces"))
    found = F.aggregate(tags, begin, step)
    # a closed block holds as many pieces as tags up to its end; an open one the piece after its last tag too
    pieces = found["pieces"] + (found["depth"] > 0).cast("int")
    return F.array_join(F.slice(F.split(rest, BLOCK_TAG), F.lit(1), pieces), "")


def markup_text(html: ColumnLike) -> Column:
    """Text of an HTML fragment: tags removed, character references resolved."""
    return decoded(F.regexp_replace(as_column(html), r"<[^>]*>", ""))


def taxonomy_entries(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(sub_category, description)`` of every entry on every page.

    Splitting a page at its entry blocks keeps the work linear in its length;
    what follows a block's own end, tags nested within it counted, is no part of it. An entry without a description element has a NULL description.
    """
    blocks = F.split(F.col(html), ENTRY_BLOCK)
    heads = (
        pages.select(*keep, F.explode(F.slice(blocks, 2, F.size(blocks))).alias("_block"))
        .select(*keep, F.regexp_extract(own_block("_block"), ENTRY_HEAD, 1).alias("_head"))
        .where(F.col("_head") != "")
    )
    words = F.split(F.btrim(markup_text("_head"), F.lit(" \t\n\r")), r"\s+")
    described = F.when(
        F.col("_head").rlike(r"(?i)<span[\s>]"),
        strip_parens(markup_text(F.regexp_extract("_head", ENTRY_SPAN, 1))),
    )
    entries = heads.select(
        *keep, F.get(words, F.lit(0)).alias("sub_category"), described.alias("description")
    )
    return entries.where(F.col("sub_category") != HEADING_CODE)


def page_links(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(href, label)`` of every link of every page, in page order."""
    found = F.arrays_zip(
        F.regexp_extract_all(F.col(html), F.lit(LINK), 1).alias("href"), F.regexp_extract_all(F.col(html), F.lit(LINK), 2).alias("label")
    )
    links = pages.select(*keep, F.inline(found))
    return links.withColumn("label", markup_text("label"))


def page_headings(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """The text of every page's first heading; empty if there is none."""
    return pages.select(*keep, markup_text(F.regexp_extract(F.col(html), HEADING, 1)).alias("heading"))


def taxonomy_table(pages: DataFrame, html: str = "html") -> DataFrame:
    """Taxonomy rows with each code under its main category."""
    return taxonomy_entries(pages, html).select(
        main_category_of("sub_category").alias("main_category"), "sub_category", "description"
    )


def main_category_rows(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """One ``(name, 'ArXiv', '')`` row per main-category heading."""
    heads = F.regexp_extract_all(F.col(html), F.lit(MAIN_HEAD), 1)
    return pages.select(*keep, F.explode(heads).alias("_head")).select(
        *keep,
        F.btrim(markup_text("_head"), F.lit(" \t\n\r")).alias("main_category"),
        F.lit("ArXiv").alias("sub_category"),
        F.lit("").alias("description"),
    )
