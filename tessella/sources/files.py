"""Files by Hadoop's file systems, so that any store that Spark can read will do."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    context = spark.sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(context._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, store = _at(spark, path)
    return store.exists(at)


def is_file(spark: SparkSession, path: str) -> bool:
    at, store = _at(spark, path)
    return store.exists(at) and store.getFileStatus(at).isFile()


def files_in(spark: SparkSession, path: str) -> list[str]:
    """Full paths of the files of a directory, not below it, by name."""
    at, store = _at(spark, path)
    return sorted(s.getPath().toString() for s in store.listStatus(at) if s.isFile())


def first_named(spark: SparkSession, path: str, suffix: str) -> str | None:
    """The path of some file of a directory whose name ends so: the store is asked page by page, and only that one comes back."""
    at, store = _at(spark, path)
    found = store.listStatusIterator(at)
    while found.hasNext():
        status = found.next()
        if status.isFile() and status.getPath().getName().endswith(suffix):
            return status.getPath().toString()
    return None


def hidden_in(spark: SparkSession, path: str, suffix: str) -> list[str]:
    """The files of a directory that file sources skip, as their names begin with ``.`` or ``_``; the store's pattern picks them."""
    at, store = _at(spark, literal(path.rstrip("/")) + "/[._]*" + suffix)
    return sorted(s.getPath().toString() for s in store.globStatus(at) or [] if s.isFile())


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or in local mode a fresh one where that is unset."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="tessella-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def full_path(spark: SparkSession, path: str) -> str:
    at, store = _at(spark, path)
    return store.makeQualified(at).toString()


def name(path: str) -> str:
    return path.rstrip("/").rpartition("/")[2]


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """A small file, on the driver."""
    at, store = _at(spark, path)
    stream = store.open(at)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def literal(path: str) -> str:
    """The path as a pattern that only it matches."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)
