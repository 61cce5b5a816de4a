"""Nested blocks of HTML pages by intervals of tag tokens.

A page is a row of tokens, the start and end tags of blocks, lists and tables, each with the text up to the next one. Every
block is an interval of tokens: depths that run along the page say which end tag closes which start tag. A block's text is
that of all its tokens, so nested blocks come with their ancestors; its parent is the innermost block around its first token.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clausemill.functions.text import raw_text

#: What is not part of the page's text.
HIDDEN = r"(?is)<!--.*?-->|<script(?!\w).*?</script\s*>|<style(?!\w).*?</style\s*>"
TOKEN = r"(?i)</?(?:p|h[1-6]|div|li|blockquote|table|ul|ol)(?!\w)[^>]*>"


def tag_tokens(pages: DataFrame) -> DataFrame:
    """(doc_id, at, tag, opens, after): the tokens of (doc_id, html) in order and the HTML that follows each."""
    shown = pages.select("doc_id", F.regexp_replace("html", HIDDEN, "").alias("h"))
    pairs = F.arrays_zip(F.regexp_extract_all("h", F.lit(TOKEN), F.lit(0)).alias("token"), F.expr(f"slice(split(h, r'{TOKEN}'), 2, length(h) + 1)").alias("after"))
    rows = shown.select("doc_id", F.posexplode(pairs).alias("at", "x")).where("x.token is not null")
    return rows.select("doc_id", "at", F.lower(F.regexp_extract("x.token", r"^</?(\w+)", 1)).alias("tag"), (~F.startswith("x.token", F.lit("</"))).alias("opens"), F.col("x.after").alias("after"))


def block_intervals(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, end, tag): tokens from start to before end are a block's or a table's.

    Paragraphs and headings hold no blocks, so any token ends them. An item ends with its end tag, the next item of its list
    or the end of the list. Other blocks end with the end tag of their depth; what is never closed ends with the page. End
    tags without start are without effect."""
    page = Window.partitionBy("doc_id").orderBy("at")
    so_far = page.rowsBetween(Window.unboundedPreceding, 0)
    step = F.when(F.col("opens"), 1).otherwise(-1)
    is_list = F.col("tag").isin("ul", "ol")
    own = F.sum(step).over(Window.partitionBy("doc_id", "tag").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    # The depth of a tag is that inside its element.
    inside = lambda depth: depth + F.when(F.col("opens"), 0).otherwise(1)
    lists = F.sum(F.when(is_list, step).otherwise(0)).over(so_far) + F.when(is_list & ~F.col("opens"), 1).otherwise(0)
    rows = tokens.drop("after").withColumns({"depth": inside(own), "lists": lists, "next": F.lead("at").over(page), "n": F.max("at").over(Window.partitionBy("doc_id")) + 1})
    plain = rows.where(F.col("tag").rlike("^(p|h[1-6])$") & F.col("opens")).withColumn("end", F.col("next"))
    item_event = (F.col("tag") == "li") | (is_list & ~F.col("opens"))
    items = rows.where(item_event).withColumn("end", F.lead("at").over(Window.partitionBy("doc_id", "lists").orderBy("at"))).where((F.col("tag") == "li") & F.col("opens"))
    boxes = rows.where(F.col("tag").isin("div", "blockquote", "table")).withColumn("end", F.lead("at").over(Window.partitionBy("doc_id", "tag", "depth").orderBy("at"))).where("opens")
    found = plain.unionByName(items).unionByName(boxes)
    return found.select("doc_id", F.col("at").alias("start"), F.coalesce("end", "n").alias("end"), "tag")


def html_blocks(pages: DataFrame) -> DataFrame:
    """U-1: (doc_id, start, tag, depth, parent, in_table, text) of every block and table of (doc_id, html): how many blocks and
    tables are around it, the start of the innermost one, whether one of them is a table, and its text with that of the
    blocks inside. A null page has none."""
    tokens = tag_tokens(pages)
    blocks = block_intervals(tokens)
    covered = blocks.select("doc_id", "start", "tag", F.explode(F.sequence("start", F.col("end") - 1)).alias("at"))
    text = covered.join(tokens.select("doc_id", "at", "after"), ["doc_id", "at"]).groupBy("doc_id", "start").agg(F.array_sort(F.collect_list(F.struct("at", "after"))).alias("p"))
    text = text.select("doc_id", "start", raw_text(F.array_join(F.transform("p", lambda x: x["after"]), " ")).alias("text"))
    inner = blocks.select("doc_id", F.col("start").alias("at"))
    around = covered.join(inner, ["doc_id", "at"]).where("start < at").groupBy("doc_id", F.col("at").alias("start")).agg(F.count(F.lit(1)).alias("depth"), F.max("start").alias("parent"), F.bool_or(F.col("tag") == "table").alias("in_table"))
    return blocks.join(text, ["doc_id", "start"]).join(around, ["doc_id", "start"], "left").select("doc_id", "start", "tag", F.coalesce("depth", F.lit(0)).alias("depth"), "parent", F.coalesce("in_table", F.lit(False)).alias("in_table"), "text")


def page_blocks(blocks: DataFrame) -> DataFrame:
    """T-6: (doc_id, block_no, start, tag, text): blocks with text that are in no table, numbered in order."""
    own = blocks.where("tag <> 'table' and not in_table and text <> ''")
    return own.select("doc_id", F.row_number().over(Window.partitionBy("doc_id").orderBy("start")).alias("block_no"), "start", "tag", "text")
