"""The PDF pipeline over a stream of files: every step is within one row, so that it runs in append mode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessella.operators import folds, lines
from tessella.plans.pipelines import Options
from tessella.sources import pdf
from tessella.streaming import assembly

FILES = "path string, modificationTime timestamp, length long, content binary"


def stream_pages(spark: SparkSession, path: str) -> DataFrame:
    """A stream of pages (``pdf.PAGES``) from PDF files that arrive in a directory."""
    files = spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", "*.pdf").load(path)
    return pdf.parse_pages(files)


def clean_stream(pages: DataFrame, options: Options = Options(), keys: tuple[str, ...] = ("doc", "page")) -> DataFrame:
    """(*keys, cleaned, segments) of ``pdf.PAGES``: the rows of ``plans.pipelines.process_blocks``, without a shuffle."""
    blocks = folds.reading_order(F.col("blocks")) if options.columns == 2 else F.col("blocks")
    return folds.clean_rows(pages, folds.block_lines(blocks), options, keys)


def start(spark: SparkSession, path: str, out_dir: str, checkpoint: str, options: Options = Options()) -> StreamingQuery:
    """Writes the segments of files as they arrive, as JSON lines, each once."""
    records = lines.segment_records(clean_stream(stream_pages(spark, path), options))
    return records.writeStream.format("json").option("ignoreNullFields", "false").option("path", out_dir).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def assembled(pages: DataFrame, options: Options = Options(), **times) -> DataFrame:
    """``assembly.OUTPUT`` of a stream of ``pdf.PAGES`` with an event time ``at``, whose pages may come in different batches."""
    lines_of = folds.block_lines(folds.reading_order(F.col("blocks")) if options.columns == 2 else F.col("blocks"))
    cleaned = F.array_join(folds.filtered(lines_of, options), "\n")
    return assembly.assemble(pages.select("doc", "page", "pages", folds.clean_text(cleaned).alias("cleaned"), "at"), **times)
