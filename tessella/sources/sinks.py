"""Text, JSONL and CSV outputs as directories of part files, written anew each time; ``named`` writes a file for each document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_text(narratives: DataFrame, path: str) -> None:
    """The texts (doc, text) as JSON lines."""
    narratives.select("doc", "text").write.mode("overwrite").json(path)


def write_jsonl(records: DataFrame, path: str) -> None:
    """A JSON object a row; null fields are kept and other scripts aren't escaped."""
    records.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def list_repr(c: Column) -> Column:
    """An array of strings as Python shows a list."""
    quoted = F.transform(c, lambda s: F.when(F.contains(s, F.lit("'")) & ~F.contains(s, F.lit('"')), F.concat(F.lit('"'), s, F.lit('"'))).otherwise(F.concat(F.lit("'"), F.replace(F.replace(s, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")), F.lit("'"))))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def write_csv(rendered: DataFrame, path: str) -> None:
    arrays = {c: list_repr(F.col(c)) for c, kind in rendered.dtypes if kind == "array<string>"}
    rendered.withColumns(arrays).write.mode("overwrite").csv(path, header=True, quote='"', escape='"', lineSep="\r\n")
