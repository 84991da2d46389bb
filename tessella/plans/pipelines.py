"""The two entry points as chains of DataFrame operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tessella.operators import layout, lines, phrases
from tessella.sources import named, pdf, sinks, tabular


@dataclass(frozen=True)
class Options:
    segment_by: str = "sentence"
    max_len: int = 512
    drop_tables: bool = False
    alpha_ratio: float = 0.2
    drop_toc: bool = False
    drop_text_tables: bool = False
    text_table_min_cols: int = 3
    text_table_min_block: int = 3
    columns: int = 1
    punkt: bool = False  #: sentences by the Punkt model where it can be had
    per_document: bool = False  #: outputs as <stem>.txt and <stem>.jsonl in the output folder


def filtered_lines(rows: DataFrame, options: Options, keys: Sequence[str] = ("doc", "page")) -> DataFrame:
    """Line filters in their fixed order: runs of table lines are those that the filters before left."""
    if options.drop_tables:
        rows = rows.where(lines.keep_by_alpha_ratio(rows.line, options.alpha_ratio))
    if options.drop_toc:
        rows = rows.where(lines.keep_by_contents(rows.line))
    if options.drop_text_tables:
        rows = lines.drop_text_tables(rows, options.text_table_min_cols, options.text_table_min_block, keys)
    return rows


def process_blocks(blocks: DataFrame, options: Options = Options()) -> DataFrame:
    """(doc, page, cleaned, segments) from blocks: one distribution by page serves order, runs and reassembly."""
    blocks = blocks.repartition("doc", "page")
    order = ("block_no",)
    if options.columns == 2:
        blocks, order = layout.reorder_two_columns(blocks), ("reading_no",)
    rows = filtered_lines(lines.blocks_to_lines(blocks, order=order), options)
    return lines.clean_pages(lines.page_text(rows), mode=options.segment_by, max_tokens=options.max_len, punkt=options.punkt)


def process_pdfs(spark: SparkSession, path: str, options: Options = Options()) -> DataFrame:
    return process_blocks(pdf.text_blocks(pdf.read_pdf(spark, path)), options)


def run_pdfs(spark: SparkSession, path: str, out_dir: str, options: Options = Options()) -> DataFrame:
    """Writes <out_dir>/pages, and <out_dir>/txt and <out_dir>/jsonl keyed by full path, or <stem>.txt and <stem>.jsonl for each document; returns the pages.

    Files are parsed once, for the pages, which the rest is made from.  Named files of an earlier run are replaced by name, others stay.
    """
    pages = process_pdfs(spark, path, options)
    pages.write.mode("overwrite").parquet(f"{out_dir}/pages")
    pages = spark.read.schema(pages.schema).parquet(f"{out_dir}/pages")
    if options.per_document:
        named.write_documents(pages, out_dir)
    else:
        sinks.write_text(lines.narrative(pages), f"{out_dir}/txt")
        sinks.write_jsonl(lines.segment_records(pages), f"{out_dir}/jsonl")
    return pages


def run_table(spark: SparkSession, path: str, phrase_cols: Sequence[str], out: str | None = None, sheet: str | None = None, id_col: str = "RiskID", summary_col: str = "Summary", expand: Mapping[str, Sequence[str]] | str | None = None, protect: bool = False, csv: str | None = None, tokenizer: str | None = None) -> DataFrame:
    """Rendered records of an attribute table, written if asked; expand is a map or the path of one."""
    mapping = tabular.read_expand_map(expand, spark) if isinstance(expand, str) else expand
    rendered = phrases.render(tabular.read_table(spark, path, sheet), [c.strip() for c in phrase_cols], id_col, summary_col, mapping, protect, tokenizer=tokenizer)
    if out:
        sinks.write_jsonl(rendered, out)
    if csv:
        sinks.write_csv(rendered, csv)
    return rendered
