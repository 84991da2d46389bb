"""Command lines of the two entry points: python -m tessella.plans.cli pdf ... | table ..."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tessella.operators import phrases
from tessella.plans.pipelines import Options, run_pdfs, run_table


# Names, choices and defaults of the options that both command lines share with the tool whose calls they take over.
def _pdf(p: argparse.ArgumentParser) -> None:
    p.add_argument("--input_path", "--input_pdf", dest="input_path", required=True, help="a PDF file or a directory of them")
    p.add_argument("--out_dir", required=True)
    p.add_argument("--segment_by", choices=["sentence", "paragraph"], default="sentence")
    p.add_argument("--max_len", type=int, default=512)
    p.add_argument("--drop_tables", action="store_true")
    p.add_argument("--alpha_ratio", type=float, default=0.2)
    p.add_argument("--drop_toc", action="store_true")
    p.add_argument("--drop_text_tables", action="store_true")
    p.add_argument("--text_table_min_cols", type=int, default=3)
    p.add_argument("--text_table_min_block", type=int, default=3)
    p.add_argument("--columns", type=int, default=1)
    p.add_argument("--punkt", action="store_true", help="sentences by the Punkt model where it can be had")
    p.add_argument("--part_files", dest="per_document", action="store_false", help="directories of part files in place of <stem>.txt and <stem>.jsonl")


def _table(p: argparse.ArgumentParser) -> None:
    p.add_argument("--input_file", required=True, help="a CSV or XLSX table")
    p.add_argument("--sheet")
    p.add_argument("--id_col", default="RiskID")
    p.add_argument("--summary_col", default="Summary")
    p.add_argument("--phrase_cols", required=True, help="columns with phrases, parted by commas")
    p.add_argument("--output_jsonl", required=True)
    p.add_argument("--make_csv", action="store_true", help="also <output>.csv")
    p.add_argument("--protect_mwe", action="store_true")
    p.add_argument("--tokenizer", help="a model whose tokenizer counts, if it can be had")
    p.add_argument("--expand_map", help="JSON of acronyms and their expansions")


def main(args: Sequence[str] | None = None) -> None:
    top = argparse.ArgumentParser(prog="tessella")
    entries = top.add_subparsers(dest="entry", required=True)
    _pdf(entries.add_parser("pdf"))
    _table(entries.add_parser("table"))
    a = vars(top.parse_args(args))
    spark = SparkSession.builder.getOrCreate()
    if a.pop("entry") == "pdf":
        path, out = a.pop("input_path"), a.pop("out_dir")
        run_pdfs(spark, path, out, Options(**a))
        print(f"pages and segments are in {out}")
        return
    out = a["output_jsonl"]
    columns = [c.strip() for c in a["phrase_cols"].split(",") if c.strip()]
    csv = (out[: -len(".jsonl")] if out.endswith(".jsonl") else out) + ".csv" if a["make_csv"] else None
    rendered = run_table(spark, a["input_file"], columns, out, a["sheet"], a["id_col"], a["summary_col"], a["expand_map"], a["protect_mwe"], csv, a["tokenizer"])
    found = phrases.totals(rendered).first()
    print(f"{found.rows} records in {out}" + (f", also as {csv}" if csv else ""))
    print(f"{found.tokens_template} tokens in all templates")


if __name__ == "__main__":
    main()
