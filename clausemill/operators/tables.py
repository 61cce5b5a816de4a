"""Document tables at the grain of cells, and their captions and notes.

HTML is read flat: nested tables and nested blocks are not supported."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clausemill.functions.text import collapse, raw_text, strip
from clausemill.functions.units import clause_ref

CAPTION = r"(?i)^(Table|Tab\.?)\s*(\d+(?:\.\d+)?)(?!\w)(.*)$"
NOTE = r"(?i)^(NOTE|NOTES|Footnote|Footnotes)(?!\w)"
_KEYS = ["doc_id", "table_idx"]
#: Elements of a page in document order: blocks, and tables as a whole. (?is) at the start.
_ELEMENT = r"(?is)<table[^>]*>.*?</table>|<(?:p|h[1-6]|li|div|blockquote)(?!\w)[^>]*>[^<]*(?:<(?!/?(?:p|h[1-6]|li|div|blockquote|table|ul|ol)(?!\w))[^>]*>[^<]*)*"


def html_cells(pages: DataFrame) -> DataFrame:
    """T-1: (doc_id, table_idx, row_idx, col_idx, text, tag, colspan, rowspan) of (doc_id, html)."""
    tables = pages.select("doc_id", F.posexplode(F.regexp_extract_all("html", F.lit(r"(?is)<table[^>]*>(.*?)</table>"), F.lit(1))).alias("table_idx", "t"))
    rows = tables.select(*_KEYS, F.posexplode(F.regexp_extract_all("t", F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))).alias("row_idx", "r"))
    cells = rows.select(*_KEYS, "row_idx", F.posexplode(F.regexp_extract_all("r", F.lit(r"(?is)<t[dh][^>]*>.*?</t[dh]>"), F.lit(0))).alias("col_idx", "c"))
    span = lambda k: F.coalesce(F.nullif(F.regexp_extract("c", rf"""(?i)^<t[dh][^>]*(?<!\w){k}=["']?(\d+)""", 1), F.lit("")).cast("int"), F.lit(1))
    return cells.select(*_KEYS, "row_idx", "col_idx", raw_text(F.col("c")).alias("text"), F.lower(F.regexp_extract("c", r"(?i)^<(t[dh])", 1)).alias("tag"), span("colspan").alias("colspan"), span("rowspan").alias("rowspan"))


def html_elements(pages: DataFrame) -> DataFrame:
    """(doc_id, dom_idx, tag, text) of blocks outside tables and of tables, in document order."""
    found = pages.select("doc_id", F.posexplode(F.regexp_extract_all("html", F.lit(_ELEMENT), F.lit(0))).alias("dom_idx", "e"))
    return found.select("doc_id", "dom_idx", F.lower(F.regexp_extract("e", r"^<(\w+)", 1)).alias("tag"), raw_text(F.col("e")).alias("text"))


def blocks_of(elements: DataFrame) -> DataFrame:
    """T-6: blocks with text, numbered in order."""
    order = Window.partitionBy("doc_id").orderBy("dom_idx")
    return elements.where("tag <> 'table' and text <> ''").withColumn("block_no", F.row_number().over(order))


def encode_cell(text: Column, colspan: Column, rowspan: Column) -> Column:
    """T-3."""
    span = lambda name, c: F.when(c > 1, F.concat(F.lit("{" + name + "="), c.cast("string"), F.lit("}"))).otherwise("")
    return F.concat(F.replace(collapse(text), F.lit("|"), F.lit("\\|")), span("colspan", colspan), span("rowspan", rowspan))


def _row_lines(cells: DataFrame, text: Column) -> DataFrame:
    row = cells.groupBy(*_KEYS, "row_idx").agg(F.array_sort(F.collect_list(F.struct("col_idx", text.alias("t")))).alias("c"))
    line = F.concat(F.lit("| "), F.array_join(F.transform("c", lambda x: x["t"]), " | "), F.lit(" |"))
    return row.select(*_KEYS, "row_idx", F.size("c").alias("n_cells"), line.alias("line"))


def pipe_tables(cells: DataFrame) -> DataFrame:
    """T-2: (doc_id, table_idx, rendered): one line per row, pipes escaped, a separator after the first of several. The
    table's reference is taken off the front of the cell that holds it."""
    return table_texts(cells).select(*_KEYS, "rendered")


def early_refs(cells: DataFrame) -> DataFrame:
    """(doc_id, table_idx, early): the references in the first nine cells of each table."""
    return cells.withColumn("ref", clause_ref(F.col("text"))).groupBy(*_KEYS).agg(_early().alias("early"))


def _early() -> Column:
    return F.collect_set(F.when((F.col("ref") != "") & (F.col("row_idx") < 3) & (F.col("col_idx") < 3), F.col("ref")))


def table_texts(cells: DataFrame) -> DataFrame:
    """(doc_id, table_idx, rendered, ref, early): a table's text as in ``pipe_tables``, the reference of its first cell, row by
    row, that has one, and those of its first nine cells. A table's cells meet once, for all of these."""
    pattern = r"(?i)(?<!\w)([A-Z]\d+[A-Z]\d+[a-z]|[A-Z]\d+[A-Z]\d+|[A-Z]\d+\.\d+|[A-Z]\d+)(?!\w)"
    # One list of cells is all that is gathered; it is sorted once, and the rest is read off it.
    cell = F.struct("row_idx", "col_idx", F.replace(strip(F.col("text")), F.lit("|"), F.lit("\\|")).alias("t"), F.nullif(clause_ref(F.col("text")), F.lit("")).alias("ref"))
    rows = cells.groupBy(*_KEYS).agg(F.sort_array(F.collect_list(cell)).alias("c"))
    with_ref = F.filter("c", lambda x: x["ref"].isNotNull())
    rows = rows.withColumns({"with_ref": with_ref, "holes": F.exists("c", lambda x: x["t"].isNull())})
    # A reference holds no white space or pipe, so it is the same in a cell's trimmed and escaped text.
    front = F.regexp_extract(F.get("with_ref", F.lit(0))["t"], pattern, 1)
    early = F.array_distinct(F.transform(F.filter("with_ref", lambda x: (x["row_idx"] < 3) & (x["col_idx"] < 3)), lambda x: x["ref"]))
    rows = rows.withColumns({"f": F.get("with_ref", F.lit(0)), "front": front, "early": early})

    def bare(x: Column) -> Column:
        t = x["t"]
        holds = (x["row_idx"] == F.col("f.row_idx")) & F.startswith(t, F.col("front"))
        rest = F.substring(t, F.length("front") + 1, F.length(t))
        return F.when(holds, strip(F.regexp_replace(rest, r"^\s*[–—:.-]?\s*", ""))).otherwise(t)

    rows = rows.withColumn("head", F.filter("c", lambda x: x["row_idx"].eqNullSafe(F.element_at("c", 1)["row_idx"])))
    rows = rows.withColumn("c", F.slice("c", F.size("head") + 1, F.size("c")))
    begins = lambda i: (i == 0) | ~F.get("c", i)["row_idx"].eqNullSafe(F.get("c", i - 1)["row_idx"])
    # Cells without text take no place in a line, but for the first, which begins it.
    rows = rows.withColumn("c", F.when(F.col("holes"), F.filter("c", lambda x, i: x["t"].isNotNull() | begins(i))).otherwise(F.col("c")))

    def piece(x: Column, i: Column) -> Column:
        before = F.when(i == 0, "| ").when(begins(i), " |\n| ").when(F.get("c", i - 1)["t"].isNull(), "").otherwise(" | ")
        return F.concat(before, F.coalesce(bare(x), F.lit("")))

    line = F.concat(F.lit("| "), F.array_join(F.transform("head", bare), " | "), F.lit(" |"))
    rows = rows.withColumn("line", line)
    columns = F.length("line") - F.length(F.replace(F.col("line"), F.lit("|"), F.lit(""))) - 1
    rest = F.concat(F.lit("\n|"), F.repeat(F.lit(" --- |"), columns), F.lit("\n"), F.array_join(F.transform("c", piece), ""), F.lit(" |"))
    rendered = F.when(F.size("c") > 0, F.concat("line", rest)).otherwise(F.col("line"))
    return rows.select(*_KEYS, rendered.alias("rendered"), F.col("f.ref").alias("ref"), "early")


def shapes(cells: DataFrame) -> DataFrame:
    """T-5: rows, and most cells in a row."""
    rows = cells.groupBy(*_KEYS, "row_idx").agg(F.count(F.lit(1)).alias("n"))
    return rows.groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("n_rows"), F.max("n").alias("n_cols"))


def lte_blocks(cells: DataFrame, captions: DataFrame) -> DataFrame:
    """T-4: (doc_id, table_idx, lte); ``captions`` has (doc_id, table_idx, table_id, title, notes, paragraph_index)."""
    lines = _row_lines(cells, encode_cell(F.col("text"), F.col("colspan"), F.col("rowspan")))
    grid = lines.groupBy(*_KEYS).agg(F.array_sort(F.collect_list(F.struct("row_idx", "line"))).alias("r"), F.max("n_cells").alias("n_cols"))
    text = F.concat_ws(
        "\n",
        F.lit("[LTE_TABLE]"),
        F.concat(F.lit("id: "), "table_id"),
        F.concat(F.lit("title: "), "title"),
        F.lit("source: docx"),
        F.concat(F.lit("location: paragraphIndex="), F.col("paragraph_index").cast("string")),
        F.concat(F.lit("shape: rows="), F.size("r").cast("string"), F.lit(" cols="), F.col("n_cols").cast("string")),
        F.lit("notes:"),
        F.col("notes"),
        F.lit("grid:"),
        F.array_join(F.transform("r", lambda x: x["line"]), "\n"),
        F.lit("[/LTE_TABLE]"),
    )
    return grid.join(captions, _KEYS).select(*_KEYS, text.alias("lte"))


def grids(cells: DataFrame) -> DataFrame:
    """T-12: header and rows as JSON, and first column = second column pairs of the other rows."""
    rows = cells.groupBy(*_KEYS, "row_idx").agg(F.array_sort(F.collect_list(F.struct("col_idx", "text"))).alias("c"))
    texts = rows.select(*_KEYS, "row_idx", F.transform("c", lambda x: x["text"]).alias("t"))
    grid = texts.groupBy(*_KEYS).agg(F.array_sort(F.collect_list(F.struct("row_idx", "t"))).alias("r"))
    body = F.transform(F.slice("r", F.lit(2), F.greatest(F.size("r") - 1, F.lit(0))), lambda x: x["t"])
    pairs = F.transform(F.filter(body, lambda t: F.size(t) > 1), lambda t: F.concat(F.get(t, F.lit(0)), F.lit("="), F.get(t, F.lit(1))))
    return grid.select(*_KEYS, F.to_json(F.struct(F.element_at("r", 1)["t"].alias("headers"), body.alias("rows"))).alias("table_grid_json"), F.array_join(pairs, "|").alias("table_key_values"))


def row_units(cells: DataFrame) -> DataFrame:
    """T-13: each row as a unit."""
    return _row_lines(cells, F.col("text")).select(*_KEYS, "row_idx", F.lit("TABLE_ROW").alias("unit_type"), F.col("line").alias("text"))


def captions(elements: DataFrame, back: int = 5) -> DataFrame:
    """T-7, J-5: (doc_id, dom_idx, table_id, title, caption_block): for each table the nearest of the ``back`` blocks
    before it that reads like a caption: an as-of lookup in one window, no join."""
    order = Window.partitionBy("doc_id").orderBy("dom_idx").rowsBetween(Window.unboundedPreceding, 0)
    is_block = F.col("tag") != "table"
    rows = elements.where("tag = 'table' or text <> ''").withColumn("block_no", F.sum(is_block.cast("int")).over(order))
    cap = F.when(is_block & F.col("text").rlike(CAPTION), F.struct("block_no", F.concat(F.lit("Table "), F.regexp_extract("text", CAPTION, 2)).alias("id"), strip(F.regexp_extract("text", CAPTION, 3)).alias("title")))
    seen = rows.withColumn("cap", F.last(cap, ignorenulls=True).over(order)).where("tag = 'table'")
    near = F.col("cap.block_no") > F.col("block_no") - back
    return seen.select("doc_id", "dom_idx", F.when(near, F.col("cap.id")).alias("table_id"), F.when(near, F.col("cap.title")).alias("title"), F.when(near, F.col("cap.block_no") - 1).alias("caption_block"))


def auto_ids(tables: DataFrame) -> DataFrame:
    """T-9: tables without a caption are numbered in order, over three digits if need be."""
    nth = F.row_number().over(Window.partitionBy("doc_id", F.col("table_id").isNull()).orderBy("dom_idx"))
    return tables.withColumn("table_id", F.coalesce("table_id", F.format_string("Table-AUTO-%03d", nth))).withColumn("title", F.coalesce("title", F.lit("")))


def nearest_paragraph(elements: DataFrame, paragraphs: DataFrame, back: int = 5) -> DataFrame:
    """T-10: (doc_id, dom_idx, paragraph_index): of the ``back`` blocks before a table the closest one whose text, or
    its first 50 characters, is a paragraph's; -1 if none is."""
    from .alignment import prefix_map

    order = Window.partitionBy("doc_id").orderBy("dom_idx")
    rows = elements.where("tag = 'table' or text <> ''").withColumn("block_no", F.sum((F.col("tag") != "table").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    tables = rows.where("tag = 'table'").select("doc_id", "dom_idx", F.explode(F.sequence(F.greatest(F.col("block_no") - (back - 1), F.lit(1)), F.greatest(F.col("block_no"), F.lit(1)))).alias("block_no"))
    keys = prefix_map(paragraphs)
    blocks = rows.where("tag <> 'table'").select("doc_id", "block_no", "text", F.substring("text", 1, 50).alias("head"))
    hit = blocks.join(keys.withColumnRenamed("key", "text").withColumnRenamed("para_idx", "a"), ["doc_id", "text"], "left").join(keys.withColumnRenamed("key", "head").withColumnRenamed("para_idx", "b"), ["doc_id", "head"], "left")
    found = hit.select("doc_id", "block_no", F.coalesce("a", "b").alias("para_idx")).where("para_idx is not null")
    best = tables.join(found, ["doc_id", "block_no"], "left").groupBy("doc_id", "dom_idx").agg(F.max_by("para_idx", F.when(F.col("para_idx").isNotNull(), F.col("block_no"))).alias("p"))
    return best.select("doc_id", "dom_idx", F.coalesce("p", F.lit(-1)).alias("paragraph_index"))


def nearby_notes(elements: DataFrame, reach: int = 30, window: int = 3, stop_within: int = 50, most: int = 5) -> DataFrame:
    """T-8, J-6: (doc_id, dom_idx, notes): note blocks among the three closest below a table and then the three closest
    above, within ``reach`` steps. The scan stops for good at a heading, or at a block under ``stop_within`` steps from
    another table. A band join on buckets of ``reach`` steps: a table meets three buckets."""
    tables = elements.where("tag = 'table'").select("doc_id", F.col("dom_idx").alias("t"))
    blocks = elements.where("tag <> 'table' and text <> ''").select("doc_id", F.col("dom_idx").alias("b"), "tag", "text")
    bucket = lambda c: F.floor(c / reach)
    left = tables.select("doc_id", "t", F.explode(F.array(*[bucket(F.col("t")) + k for k in (-1, 0, 1)])).alias("k"))
    met = left.join(blocks.withColumn("k", bucket(F.col("b"))), ["doc_id", "k"]).where(F.abs(F.col("b") - F.col("t")) <= reach)
    side = F.when(F.col("b") > F.col("t"), 0).otherwise(1)
    near = met.withColumn("side", side).withColumn("nth", F.row_number().over(Window.partitionBy("doc_id", "t", "side").orderBy(F.abs(F.col("b") - F.col("t"))))).where(F.col("nth") <= window)
    # The closest other table on either side decides whether one is near a block.
    by_table = Window.partitionBy("doc_id").orderBy("t")
    others = tables.withColumn("before", F.lag("t").over(by_table)).withColumn("after", F.lead("t").over(by_table))
    stop = F.col("tag").rlike("^h[1-6]$") | (F.abs(F.col("before") - F.col("b")) < stop_within) | (F.abs(F.col("after") - F.col("b")) < stop_within)
    scan = Window.partitionBy("doc_id", "t").orderBy("side", "nth").rowsBetween(Window.unboundedPreceding, 0)
    open_ = near.join(others, ["doc_id", "t"]).withColumn("stopped", F.max(F.coalesce(stop, F.lit(False)).cast("int")).over(scan)).where((F.col("stopped") == 0) & F.col("text").rlike(NOTE))
    notes = open_.groupBy("doc_id", "t").agg(F.array_sort(F.collect_list(F.struct("side", "nth", "text"))).alias("n"))
    texts = F.slice(F.array_distinct(F.transform("n", lambda x: x["text"])), 1, most)
    return tables.join(notes, ["doc_id", "t"], "left").select("doc_id", F.col("t").alias("dom_idx"), F.coalesce(F.array_join(texts, "\n"), F.lit("")).alias("notes"))


def non_empty_tables(cells: DataFrame, tables: DataFrame) -> DataFrame:
    """T-11: tables that have rows."""
    return tables.join(cells.select(*_KEYS).distinct(), _KEYS, "left_semi")
