"""Shared folders, written intermediate tables, private names and connected components."""

from __future__ import annotations

import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local = threading.local()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); where it is unset, a fresh one in local mode and an error on a cluster."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="tessella-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def _open_workspaces() -> list[list[str]]:
    if not hasattr(_local, "stack"):
        _local.stack = []
    return _local.stack


def written(df: DataFrame, tag: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage, and survives the loss of executors.

    The shuffle files of the write go when it has ended.
    """
    spark = df.sparkSession
    ship(spark)
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    if stack := _open_workspaces():
        stack[-1].append(path)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._tessella_path = path
    return out


def folder(spark: SparkSession, tag: str) -> str:
    """The path of a new folder in the shared one, for files of other kinds than tables; it goes with the innermost workspace."""
    ship(spark)
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    if stack := _open_workspaces():
        stack[-1].append(path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def discard(table: DataFrame) -> None:
    """Delete a table of written() that nothing reads any more."""
    for paths in _open_workspaces():
        if table._tessella_path in paths:
            paths.remove(table._tessella_path)
    _delete(table.sparkSession, table._tessella_path)


@contextmanager
def workspace(spark: SparkSession) -> Iterator[None]:
    """Tables that written() makes inside are deleted at the end, but for those that kept() has passed on."""
    stack = _open_workspaces()
    stack.append([])
    try:
        yield
    finally:
        for path in stack.pop():
            _delete(spark, path)


def kept(table: DataFrame) -> DataFrame:
    """A table of written() that outlives the innermost workspace, and belongs to the one around it if there is one."""
    stack = _open_workspaces()
    if stack and table._tessella_path in stack[-1]:
        stack[-1].remove(table._tessella_path)
        if len(stack) > 1:
            stack[-2].append(table._tessella_path)
    return table


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def private(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of df has, whatever the case."""
    taken, mark = {c.lower() for c in df.columns}, "_"
    while any((mark + n).lower() in taken for n in names):
        mark += "_"
    return [mark + n for n in names]


def small(df: DataFrame, row_bytes: int, most: int = 64 << 20) -> DataFrame:
    """df, marked for broadcast if its counted rows of at most ``row_bytes`` prove that it has ``most`` bytes at most."""
    return F.broadcast(df) if df.count() * row_bytes <= most else df


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each context, in case it isn't installed there."""
    context = spark.sparkContext
    if getattr(context, "_tessella_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="tessella-")) / "tessella.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._tessella_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as it is, but documents in fewer splits than cores are dealt out first; large tables never are."""
    ship(spark)
    df, cores = spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark.sparkContext.defaultParallelism
    return df.repartition(cores) if name == "documents" and df.rdd.getNumPartitions() < cores else df


def fold(column: Column, modulus: int) -> Column:
    """crc32 of a column as text, modulo; null counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def sampled(rows: DataFrame, order: str, text: str, most_rows: int, most_bytes: int):
    """Rows as an Arrow table in the order of the long column ``order``: the first ones, as many as fit both bounds.

    Rows that agree in ``order`` are one.  A text that would pass ``most_bytes`` is left out with all after it, unless it is the first.
    """
    spark, take, filled = rows.sparkSession, [], 0
    for key, size in rows.select(order, F.octet_length(text).alias("n")).distinct().orderBy(order).limit(most_rows).collect():
        filled += size or 0
        if take and filled > most_bytes:
            break
        take.append(key)
    (name,) = private(rows, "chosen")
    chosen = spark.createDataFrame([(x,) for x in take], f"{name} long")  # at most most_rows
    return rows.join(F.broadcast(chosen), F.col(order) == F.col(name)).drop(name).dropDuplicates([order]).toArrow().combine_chunks().sort_by(order)


def components(edges: DataFrame, tag: str = "cc", rounds: int = 60) -> DataFrame:
    """(node, root) of every node of the undirected long edges (a, b); root is the smallest node reachable.

    Alternates large-star and small-star steps; each step groups by node, so a hub is
    split only as far as min() needs, which is combined map-side.  The parts of each
    round are written, so that both sides of the joins are dealt anew and adaptive
    execution can split a hub's rows; they are deleted with the round.  Nodes that have no edge are not returned.
    Ends when a round changes nothing; an error if that takes more than ``rounds``.
    """
    spark = edges.sparkSession
    with workspace(spark):
        now = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), tag)
        before = None
        for _ in range(rounds):
            state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
            if state[0] == 0 or state == before:
                break
            before, last = state, now
            with workspace(spark):
                both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
                low = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("x"), F.least("a", "m").alias("m")), tag)
                large = both.join(low, both.a == low.x).where("b > a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
                large = written(large, tag)
                low = written(large.groupBy("b").agg(F.min("a").alias("m")).select(F.col("b").alias("x"), "m"), tag)
                stars = large.join(low, large.b == low.x).select("m", F.explode(F.array("a", "b")).alias("b")).where("m <> b")
                now = kept(written(stars.select(F.col("m").alias("a"), "b").distinct(), tag))
            discard(last)
        else:
            raise RuntimeError(f"{tag}: components still change after {rounds} rounds")
        roots = now.groupBy("b").agg(F.min("a").alias("root")).select(F.col("b").alias("node"), "root")
        return kept(written(roots.unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()), tag))
