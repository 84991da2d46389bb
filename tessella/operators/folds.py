"""Line operators within one row: a page is an array of lines, and runs and reassembly are folds over it.

No window and no shuffle, so that they run in a stream in append mode as well as in a batch.  Each step
is linear in the lines of the page.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.text import clean_text, segment_text, split_lines
from tessella.operators.layout import tenth
from tessella.operators.lines import NOT_BLANK, column_gaps, keep_by_alpha_ratio, keep_by_contents


def bound(value: Column, body) -> Column:
    """body(value) with value computed once, as lambdas compute what they capture for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def page_lines(text: Column) -> Column:
    """The lines of a text that aren't blank; null has none."""
    return F.filter(split_lines(F.coalesce(text, F.lit(""))), lambda line: line.rlike(NOT_BLANK))


def block_lines(blocks: Column) -> Column:
    """The lines of blocks (structs with ``text``), in their order."""
    return F.flatten(F.transform(blocks, lambda b: page_lines(b["text"])))


def reading_order(blocks: Column) -> Column:
    """Blocks of a two-column page (structs with block_no, x0, y0, x1) in the order of ``layout.reorder_two_columns``."""
    centre = lambda b: (b["x0"] + b["x1"]) / 2

    def place(pivot: Column) -> Column:
        keyed = F.transform(blocks, lambda b: F.struct((centre(b) > pivot).cast("int").alias("side"), tenth(b["y0"]).alias("y"), tenth(b["x0"]).alias("x"), b["block_no"].alias("n"), b.alias("b")))
        return F.transform(F.array_sort(keyed), lambda s: s["b"])

    centres = F.array_sort(F.filter(F.transform(blocks, centre), lambda c: c.isNotNull()))
    pivot = bound(centres, lambda c: F.get(c, F.floor(F.size(c) / 2).cast("int")))
    return bound(pivot, place)


def table_mask(lines: Column, min_cols: int = 3, min_block: int = 3) -> Column:
    """For each line, whether it is part of a run of min_block or more lines with min_cols columns.

    Runs lie between lines without enough gaps: the mask is put together from one to the next.
    """
    if min_block < 1:
        raise ValueError("min_block must be at least 1")
    narrow = F.filter(F.transform(lines, lambda line, i: F.when(column_gaps(line) < min_cols - 1, i)), lambda i: i.isNotNull())
    ends = F.concat(narrow, F.array(F.size(lines)))

    def masks(ends: Column) -> Column:
        def run(end: Column, k: Column) -> Column:
            length = end - F.when(k > 0, F.get(ends, k - 1)).otherwise(F.lit(-1)) - 1
            return F.concat(F.array_repeat(length >= min_block, length), F.array(F.lit(False)))  # the run, and the line that ends it

        return F.flatten(F.transform(ends, run))

    return F.slice(bound(ends, masks), F.lit(1), F.size(lines))


def without_tables(lines: Column, min_cols: int = 3, min_block: int = 3) -> Column:
    return bound(lines, lambda every: bound(table_mask(every, min_cols, min_block), lambda masked: F.filter(every, lambda line, i: ~F.get(masked, i))))


def filtered(lines: Column, options) -> Column:
    """The line filters that ``options`` asks for (see plans.pipelines), in their fixed order."""
    if options.drop_tables:
        lines = F.filter(lines, lambda line: keep_by_alpha_ratio(line, options.alpha_ratio))
    if options.drop_toc:
        lines = F.filter(lines, lambda line: keep_by_contents(line))
    return without_tables(lines, options.text_table_min_cols, options.text_table_min_block) if options.drop_text_tables else lines


def clean_rows(rows: DataFrame, lines: Column, options, keys: Sequence[str] = ("doc", "page")) -> DataFrame:
    """(*keys, cleaned, segments) of rows that hold a page each: a narrow chain, batch or stream.

    Pages without a line that is kept have no row, as in the pipeline over lines.
    """
    # an outer explode of one element or none keeps the optimiser from computing lines once for a filter and again for each use
    one = bound(filtered(lines, options), lambda x: F.when(F.size(x) > 0, F.array(x)))
    kept = rows.select(*keys, F.explode_outer(one).alias("lines")).where("lines is not null")
    cleaned = kept.select(*keys, clean_text(F.array_join("lines", "\n")).alias("cleaned"))
    return cleaned.withColumn("segments", segment_text(F.col("cleaned"), options.segment_by, options.max_len, options.punkt))
