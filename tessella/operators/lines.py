"""Blocks to lines, line filters, table masks and reassembly.

Every table carries (doc, page, line_no); filters leave gaps in line_no, and only its order counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessella.functions.text import NOT_WS, WS, clean_text, segment_text, split_lines, strip

# Patterns of lines to keep and to drop.  A look at the first letter spares the other tests at most places.  They bear white space at either end, so that no line is stripped for them.
_EDGE = r"(?<![\p{L}\p{N}_])"
CAPTION_LINE = rf"(?iu)(?=[eftc]){_EDGE}(?:exhibit|figure|table|chart){WS}*\p{{Nd}}+{WS}*[:\-–]{WS}*"
CONTENTS = r"(?iu)(?=[tl])(?<![\p{L}\p{N}_])(table of contents|list of figures|list of tables)(?![\p{L}\p{N}_])"
DOT_LEADER = rf"[._]{{4,}}{WS}*\p{{Nd}}+{WS}*\z"
EXHIBIT_OF = rf"(?iu)(?=e){_EDGE}exhibit{WS}*<?\p{{Nd}}+>?{WS}*of{WS}*<?\p{{Nd}}+>?"
NOISE = (rf"(?iu)\A{WS}*web" + WS + r"*<\p{Nd}{4}>", rf"(?iu)mcKinsey{WS}*&{WS}*company", rf"(?iu)scan{WS}*•{WS}*download{WS}*•{WS}*personalize")
PAGE_NUMBER = rf"\A{WS}*+(?:-{WS}*+)?\p{{Nd}}{{1,4}}{WS}*+(?:-{WS}*+)?\z"
NOT_BLANK = NOT_WS
COLUMN_GAP = rf"\t|{WS}{{2,}}"


def blocks_to_lines(blocks: DataFrame, text: str = "text", keys: Sequence[str] = ("doc", "page"), order: Sequence[str] = ("block_no",)) -> DataFrame:
    """(*keys, line_no, line): the lines of each block that aren't blank, numbered in block order from 0.

    Null texts have no lines.  A key without lines has no rows.
    """
    rows = blocks.select(*keys, *order, F.posexplode(split_lines(F.coalesce(F.col(text), F.lit("")))).alias("_pos", "line")).where(F.col("line").rlike(NOT_BLANK))
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, "_pos")) - 1
    return rows.select(*keys, number.cast("int").alias("line_no"), "line")


def text_lines(docs: DataFrame, text: str = "text", keys: Sequence[str] = ("doc", "page")) -> DataFrame:
    """The same for one text a key: narrow, no window needed; line_no is the place in the text and may have gaps."""
    return docs.select(*keys, F.posexplode(split_lines(F.coalesce(F.col(text), F.lit("")))).alias("line_no", "line")).where(F.col("line").rlike(NOT_BLANK))


def is_caption_line(line: Column) -> Column:
    return line.rlike(CAPTION_LINE)


def keep_by_alpha_ratio(line: Column, least: float = 0.2) -> Column:
    """Captions, and lines of which at least that share is letters; blank lines go."""
    letters = F.length(F.regexp_replace(line, r"\P{L}+", ""))
    return line.rlike(NOT_BLANK) & ((letters / F.nullif(F.length(strip(line)), F.lit(0)) >= F.lit(float(least))) | is_caption_line(line))


def keep_by_contents(line: Column, noise: Sequence[str] = NOISE) -> Column:
    """Not blank, not a contents entry, running head, page number or noise (patterns on the line as it is)."""
    bad = line.rlike(CONTENTS) | line.rlike(DOT_LEADER) | line.rlike(EXHIBIT_OF) | line.rlike(PAGE_NUMBER)
    for pattern in noise:
        bad = bad | line.rlike(pattern)
    return line.rlike(NOT_BLANK) & ~bad


def column_gaps(line: Column) -> Column:
    return F.regexp_count(strip(line), F.lit(COLUMN_GAP))


def mask_text_tables(lines: DataFrame, min_cols: int = 3, min_block: int = 3, keys: Sequence[str] = ("doc", "page")) -> DataFrame:
    """lines with ``masked``: whether a line is part of a run of min_block or more lines with min_cols columns.

    Runs are islands between lines without enough gaps: two windows over one distribution.
    """
    if min_block < 1:
        raise ValueError("min_block must be at least 1")
    wide = (column_gaps(F.col("line")) >= min_cols - 1).cast("int")
    before = Window.partitionBy(*keys).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = lines.withColumn("_wide", wide).withColumn("_island", F.sum(1 - F.col("_wide")).over(before))
    size = F.sum("_wide").over(Window.partitionBy(*keys, "_island"))
    return rows.withColumn("masked", (F.col("_wide") == 1) & (size >= min_block)).drop("_wide", "_island")


def drop_text_tables(lines: DataFrame, min_cols: int = 3, min_block: int = 3, keys: Sequence[str] = ("doc", "page")) -> DataFrame:
    return mask_text_tables(lines, min_cols, min_block, keys).where(~F.col("masked")).drop("masked")


def page_text(lines: DataFrame, keys: Sequence[str] = ("doc", "page")) -> DataFrame:
    """(*keys, text): lines of a page joined by line breaks in order."""
    parts = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    return lines.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda s: s["line"]), "\n").alias("text"))


def clean_pages(pages: DataFrame, keys: Sequence[str] = ("doc", "page"), mode: str = "sentence", max_tokens: int = 512, punkt: bool = False) -> DataFrame:
    """(*keys, cleaned, segments)."""
    return pages.select(*keys, clean_text(F.col("text")).alias("cleaned")).withColumn("segments", segment_text(F.col("cleaned"), mode, max_tokens, punkt))


def segment_records(pages: DataFrame, keys: Sequence[str] = ("doc", "page")) -> DataFrame:
    """(*keys, segment_index, text): a row for each segment.

    The outer form is used as for the inner one the optimiser adds a filter that computes all segments once more.
    """
    return pages.select(*keys, F.posexplode_outer("segments").alias("segment_index", "text")).where("segment_index is not null")


def narrative(pages: DataFrame, doc: str = "doc", page: str = "page") -> DataFrame:
    """(doc, text): the cleaned pages of a document in order, empty ones left out."""
    parts = F.array_sort(F.collect_list(F.struct(page, "cleaned")))
    return pages.where("cleaned <> ''").groupBy(doc).agg(F.array_join(F.transform(parts, lambda s: s["cleaned"]), "\n").alias("text"))
