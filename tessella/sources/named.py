"""A sink of many named files: a Python data source whose writer commits in two phases.

Rows are (name, line).  A task writes its files to a folder of its own attempt and reports that folder; the
driver moves the files of the reported folders to their names and drops the rest.  So a failed or
repeated attempt leaves nothing, readers see whole files only, and a second run replaces what the first wrote.
Folders are reached by pyarrow's file systems: mounted ones, HDFS, object stores.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tessella.functions.text import stem

FORMAT = "named_files"


def store(path: str):
    """(file system, path in it) of a path or URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub("^file:/+", "/", path))


@dataclass
class Attempt(WriterCommitMessage):
    folder: str | None
    files: int


class NamedFilesWriter(DataSourceArrowWriter):
    """Rows of one file must come together and in order; a row with a null line only makes the file."""

    def __init__(self, path: str, overwrite: bool, end: str):
        self.path, self.overwrite, self.end = path.rstrip("/"), overwrite, end
        self.staging = f"_staging-{uuid.uuid4().hex}"

    def write(self, batches: Iterator) -> WriterCommitMessage:
        files, top = store(self.path)
        context = TaskContext.get()
        folder, name, out, count = f"{context.partitionId()}-{context.taskAttemptId()}", None, None, 0
        at = f"{top}/{self.staging}/{folder}"
        end = self.end.encode()
        try:
            for b in batches:
                for now, line in zip(b.column("name").to_pylist(), b.column("line").to_pylist(), strict=True):
                    if now != name:
                        if out is not None:
                            out.close()
                        if not count:
                            files.create_dir(at, recursive=True)
                        name, count = now, count + 1
                        out = files.open_output_stream(f"{at}/{name}", compression=None)
                    if line is not None:
                        out.write(line.encode() + end)
        except BaseException:
            if out is not None:
                out.close()
            if count:
                files.delete_dir(at)
            raise
        if out is not None:
            out.close()
        return Attempt(folder if count else None, count)

    def commit(self, messages: list) -> None:
        from pyarrow import fs

        files, top = store(self.path)
        files.create_dir(top, recursive=True)
        moves = [f for m in messages if m is not None and m.folder for f in files.get_file_info(fs.FileSelector(f"{top}/{self.staging}/{m.folder}"))]
        if len(moves) != sum(m.files for m in messages if m is not None) or len({f.base_name for f in moves}) != len(moves):
            self.abort(messages)
            raise RuntimeError("files of a task are missing, or two tasks wrote one name")
        old = [f for f in files.get_file_info(fs.FileSelector(top)) if f.is_file] if self.overwrite else []
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda f: files.move(f.path, f"{top}/{f.base_name}"), moves))
            names = {f.base_name for f in moves}
            list(pool.map(lambda f: files.delete_file(f.path), (f for f in old if f.base_name not in names)))
        self.abort(messages)

    def abort(self, messages: list) -> None:
        """Drop whatever is staged."""
        from pyarrow import fs

        files, top = store(self.path)
        if files.get_file_info(f"{top}/{self.staging}").type != fs.FileType.NotFound:
            files.delete_dir(f"{top}/{self.staging}")


class NamedFiles(DataSource):
    """Option lineSep: what follows each line, a line break by default.  Mode append replaces files by name, overwrite all files of the folder."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "name string, line string"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return NamedFilesWriter(self.options["path"], overwrite, self.options.get("linesep", "\n"))


def file_names(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """(doc, file) of distinct documents: the stem of the path; where stems meet, the first path by code point has it, and the
    others have eight digits of their path's sha256 after it."""
    each = docs.select(F.col(doc).alias("doc")).distinct().withColumn("_stem", stem(F.col("doc")))
    first = each.groupBy("_stem").agg(F.min("doc").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    other = F.concat("_stem", F.lit("-"), F.substring(F.sha2(F.col("doc").cast("binary"), 256), 1, 8))
    return each.join(first, "_stem", "left").select("doc", F.when(F.col("doc") != F.col("_first"), other).otherwise(F.col("_stem")).alias("file"))


def write_named(rows: DataFrame, path: str, order: list[Column], end: str = "\n", overwrite: bool = False) -> None:
    """Files of rows (name, line, and what ``order`` needs): one exchange by name, many files a task, lines in order."""
    rows.sparkSession.dataSource.register(NamedFiles)
    sorted_rows = rows.repartition("name").sortWithinPartitions("name", *order)
    sorted_rows.select("name", "line").write.format(FORMAT).option("lineSep", end).mode("overwrite" if overwrite else "append").save(path)


def write_documents(pages: DataFrame, path: str, overwrite: bool = False) -> None:
    """``<stem>.txt`` with the cleaned pages that aren't empty, a line each, and ``<stem>.jsonl`` with a segment a line, for each document of
    pages (doc, page, cleaned, segments); documents without text have empty files."""
    texts = pages.where("cleaned <> ''").select("doc", F.lit(0).alias("kind"), "page", F.lit(0).alias("at"), F.col("cleaned").alias("line"))
    segments = pages.select("doc", F.lit(1).alias("kind"), "page", F.posexplode("segments").alias("at", "text"))
    encoded = F.to_json(F.struct("page", F.col("at").alias("segment_index"), "text"), {"ignoreNullFields": "false"})
    segments = segments.select("doc", "kind", "page", "at", encoded.alias("line"))
    every = pages.select("doc").distinct().select("doc", F.explode(F.array(F.lit(0), F.lit(1))).alias("kind"), F.lit(-1).alias("page"), F.lit(-1).alias("at"), F.lit(None).cast("string").alias("line"))
    rows = texts.unionByName(segments).unionByName(every).join(file_names(pages), "doc")
    rows = rows.withColumn("name", F.concat("file", F.when(F.col("kind") == 0, ".txt").otherwise(".jsonl")))
    write_named(rows, path, [F.col("page"), F.col("at")], overwrite=overwrite)
