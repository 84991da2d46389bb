"""Reading order of two-column pages, and captions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessella.functions.text import WS, strip

# The caption pattern (delimiter, white space or the end after the number).
CAPTION = rf"(?iu)(?<![\p{{L}}\p{{N}}_])(exhibit|figure|table|chart){WS}*(\p{{Nd}}+)(?:{WS}*[:\-–]{WS}*|{WS}+|\z)"


#: From here on doubles lie further apart than 0.1, so that the nearest one to any rounding of x is x.
_COARSE = float(1 << 49)


def tenth(c: Column) -> Column:
    """The sort key of a coordinate: tenths, halves up."""
    return F.floor(c * 10 + 0.5)


def rounded_tenth(c: Column) -> Column:
    """c to one decimal, correctly rounded and ties to even, as Python's round(x, 1): the double nearest to the decimal.

    10 c is 8 c + 2 c, both exact, and their sum and its error together are exact (two-sum); the error decides where the
    rounded sum is half-way.
    """
    x = c.cast("double")
    a, b = x * 8, x * 2
    s = a + b
    back = s - a
    error = (a - (s - back)) + (b - back)
    whole = F.rint(s)
    off = s - whole
    whole = whole + F.when((off == 0.5) & (error > 0), 1.0).when((off == -0.5) & (error < 0), -1.0).otherwise(0.0)
    return F.when((F.abs(x) >= _COARSE) | F.isnan(x), x).otherwise(whole / 10)


def reorder_two_columns(blocks: DataFrame, keys: Sequence[str] = ("doc", "page"), exact: bool = False) -> DataFrame:
    """blocks with ``reading_no`` from 0: the left column (centre at or below the upper median), then the right.

    Within a column by y0, then x0, both in tenths (halves up, or correctly rounded if ``exact``), then block_no.  y grows downwards.
    The median is the centre whose rank is half the count: no row holds more than its own block, and one exchange serves all windows.
    Blocks without a centre come first.
    """
    page, key = Window.partitionBy(*keys), rounded_tenth if exact else tenth
    rows = blocks.withColumn("_centre", (F.col("x0") + F.col("x1")) / 2)
    rows = rows.withColumn("_rank", F.row_number().over(page.orderBy(F.col("_centre").asc_nulls_last()))).withColumn("_half", F.floor(F.count("_centre").over(page) / 2) + 1)
    rows = rows.withColumn("_pivot", F.max(F.when(F.col("_rank") == F.col("_half"), F.col("_centre"))).over(page))
    rows = rows.withColumn("_side", (F.col("_centre") > F.col("_pivot")).cast("int"))
    order = page.orderBy("_side", key(F.col("y0")), key(F.col("x0")), "block_no")
    return rows.withColumn("reading_no", (F.row_number().over(order) - 1).cast("int")).drop("_centre", "_rank", "_half", "_pivot", "_side")


def find_captions(blocks: DataFrame, keys: Sequence[str] = ("doc", "page")) -> DataFrame:
    """(*keys, block_no, x0, y0, x1, y1, text, kind, ordinal, caption_no) of caption blocks; caption_no counts a page's from 0 by y0, block_no."""
    s = strip(F.coalesce(F.col("text"), F.lit("")))
    found = blocks.where(s.rlike(CAPTION))
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("y0", "block_no")) - 1
    return found.select(*keys, "block_no", "x0", "y0", "x1", "y1", s.alias("text"), F.lower(F.regexp_extract(s, CAPTION, 1)).alias("kind"), F.regexp_extract(s, CAPTION, 2).cast("int").alias("ordinal"), number.cast("int").alias("caption_no"))
