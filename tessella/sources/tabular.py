"""CSV and XLSX attribute tables, expansion maps, and tolerant text files; every cell is text."""

from __future__ import annotations

import io
import json
import re
import zipfile
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.sources import files, quoted


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Files of one table, in ranges that are read in parallel whatever line breaks their quoted cells hold.

    Only the names of the columns are read by the multi-line reader, from the first record.
    """
    names = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, quote='"', escape='"').columns
    if not names:
        return spark.createDataFrame([], "value string").drop("value")
    rows = quoted.read(spark, path, names)
    return rows.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in rows.columns])


def _column(cell: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", cell)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def read_xlsx(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """A sheet by name, or the first; its first row has the names.  Read on the driver: a workbook is one small file."""
    tag = lambda x: x.tag.rpartition("}")[2]
    with zipfile.ZipFile(io.BytesIO(files.read_bytes(spark, path))) as z:
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        sheets = [(x.get("name"), next(v for k, v in x.attrib.items() if k.endswith("}id"))) for x in book.iter() if tag(x) == "sheet"]
        targets = {x.get("Id"): x.get("Target") for x in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        known = dict(sheets)
        if sheet is not None and sheet not in known:
            raise ValueError(f"no sheet {sheet!r}")
        target = targets[known[sheet] if sheet is not None else sheets[0][1]]
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in x.iter() if tag(t) == "t") for x in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))]
        rows = []
        for row in (x for x in ElementTree.fromstring(z.read(target.lstrip("/") if target.startswith("/") else f"xl/{target}")).iter() if tag(x) == "row"):
            cells: dict[int, str] = {}
            for c in row:
                value = "".join(t.text or "" for t in c.iter() if tag(t) in ("v", "t"))
                cells[_column(c.get("r")) if c.get("r") else len(cells)] = shared[int(value)] if c.get("t") == "s" else value
            rows.append(cells)
    if not rows:
        return spark.createDataFrame([], "value string")
    names = [rows[0].get(k) or f"_c{k}" for k in range(max(rows[0], default=-1) + 1)]
    return spark.createDataFrame([tuple(r.get(k, "") for k in range(len(names))) for r in rows[1:]], ", ".join(f"`{n}` string" for n in names))


def read_table(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    return read_xlsx(spark, path, sheet) if path.lower().endswith(".xlsx") else read_csv(spark, path)


def read_expand_map(path: str | None, spark: SparkSession | None = None) -> dict[str, list[str]]:
    """A JSON object of lists; a missing file is an empty one."""
    spark = spark or SparkSession.active()
    return json.loads(files.read_bytes(spark, path).decode("utf-8")) if path and files.exists(spark, path) else {}


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of whole files as UTF-8; bytes that aren't are dropped."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("path"), pa.array([(x.as_py() or b"").decode("utf-8", "ignore") for x in b.column("content")], pa.string())], names=["path", "text"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, text string")
