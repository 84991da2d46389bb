"""Embedding near-duplicates by product quantisation.

A sample trains a coarse quantiser, of about the square root of the number of rows in cells,
and codebooks for the residuals.  Every vector is coded once; equal vectors of a label are
one class first.  Each (label, cell) is an inverted list of codes, cut into blocks of about
``block`` members.  A vector is a query to the lists of its own cell and of every cell whose
centroid scores within ``margin`` of its best one; queries come in blocks too, and a task has
one block of members and one of queries, however long the list is.  Asymmetric distances come
from lookup tables.  A pair is pruned only if its table distance exceeds the link distance by
more than the coding error of the member, which is stored: the tables themselves lose no link.
All others get the exact cosine in double precision.

Each unordered pair of cells is looked at from one side, counts are added up by class, and
a block reports its links as a spanning forest, never as pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, kept, table, workspace, written


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.93
    subspaces: int = 8
    codes: int = 128
    margin: float = 0.22  #: in inner product with unit centroids
    block: int = 1024
    sample: int = 16_384  #: rows to fit on, or eight for each cell if that is more
    most_sample: int = 262_144  #: but never more than that
    iterations: int = 8


@dataclass(frozen=True)
class Index:
    settings: Settings
    centroids: np.ndarray  #: [cells, dims], unit length
    books: list[np.ndarray]  #: for each subspace [codes, its dims]


def _kmeans(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator, unit: bool) -> np.ndarray:
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = np.argmin((c * c).sum(1) - 2 * x @ c.T, 1)
        n = np.bincount(near, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
        if unit:
            c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def wanted_cells(rows: int) -> int:
    """A power of two of about the square root."""
    return 1 << int(np.log2(max(rows, 1)) / 2)


def train(x: np.ndarray, rows: int, settings: Settings, seed: int = 0) -> Index:
    """x: sampled unit vectors; rows: how many are to be indexed, which sets the number of cells."""
    rng = np.random.default_rng(seed)
    cells = max(1, min(len(x) // 8, wanted_cells(rows)))
    centroids = _kmeans(x, cells, settings.iterations, rng, True)
    residual = x - centroids[np.argmax(x @ centroids.T, 1)]
    parts = np.array_split(np.arange(x.shape[1]), min(settings.subspaces, x.shape[1]))
    return Index(settings, centroids, [_kmeans(residual[:, p], settings.codes, settings.iterations, rng, False) for p in parts])


def encode(index: Index, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell, codes and coding error of each unit vector."""
    cell = np.argmax(x @ index.centroids.T, 1)
    residual = x - index.centroids[cell]
    codes, back, at = np.zeros((len(x), len(index.books)), np.uint8), np.zeros_like(residual), 0
    for m, book in enumerate(index.books):
        part = residual[:, at : at + book.shape[1]]
        codes[:, m] = np.argmin((book * book).sum(1) - 2 * part @ book.T, 1)
        back[:, at : at + book.shape[1]] = book[codes[:, m]]
        at += book.shape[1]
    return cell, codes, np.linalg.norm(residual - back, axis=1)


def table_distances(index: Index, queries: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
    """Asymmetric distances from each query to each coded member of a cell."""
    residual, total, at = queries - index.centroids[cell], np.zeros((len(queries), len(codes))), 0
    for m, book in enumerate(index.books):
        part = residual[:, at : at + book.shape[1]]
        lookup = (part * part).sum(1)[:, None] + (book * book).sum(1) - 2 * part @ book.T
        total += lookup[:, codes[:, m]]
        at += book.shape[1]
    return np.sqrt(np.maximum(total, 0))


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0 to n - 1 and links (a, b), the smallest node that each one reaches."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def block_links(index: Index, cell: int, members: np.ndarray, codes: np.ndarray, error: np.ndarray, queries: np.ndarray | None, step: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """(query, member) numbers of the linked pairs of one block of a cell; without queries its members are, each pair once."""
    # unit vectors at cosine t are sqrt(2 - 2 t) apart
    reach = np.sqrt(2 - 2 * index.settings.threshold) + error + 1e-9
    every, left, right = members if queries is None else queries, [], []
    for s in range(0, len(every), step):
        part = every[s : s + step]
        near = table_distances(index, part, cell, codes) <= reach
        if queries is None:
            near &= np.arange(s, s + len(part))[:, None] > np.arange(len(members))
        if near.mean() > 0.03:
            i, j = np.nonzero(near & (part @ members.T >= index.settings.threshold))
        else:
            i, j = np.nonzero(near)
            ok = np.einsum("ij,ij->i", part[i], members[j]) >= index.settings.threshold
            i, j = i[ok], j[ok]
        left.append(i + s)
        right.append(j)
    none = np.zeros(0, int)
    return np.concatenate(left or [none]), np.concatenate(right or [none])


def _unit(column: pa.Array) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def near_duplicates(vectors: DataFrame, settings: Settings = Settings(), seed: int = 7) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row (vec_id, embedding, label).

    vec_id must be a number.  Rows whose vector or label is null, or whose vector is empty, zero or holds a null or a value that
    isn't finite, link with nothing.  Vectors of different lengths don't link.  Equal vectors of a label
    link with each other; a vec_id that occurs twice counts as two vectors.  Other columns are ignored, and an
    empty table gives an empty result.
    """
    spark = vectors.sparkSession
    e = F.col("embedding")
    fine = F.col("label").isNotNull() & e.isNotNull() & (F.size(e) > 0) & ~F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists(e, lambda v: v != 0)
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label", F.coalesce(fine, F.lit(False)).alias("fine"))
    vectors = vectors.withColumn("node", F.when(F.col("fine"), F.xxhash64("label", "embedding")))
    with workspace(spark):
        classes = vectors.where("fine").groupBy("node").agg(F.count("*").alias("n"), F.min("vec_id").alias("least"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
        classes = written(classes.withColumn("dims", F.size("embedding")), "pq-classes")
        edges = spark.createDataFrame([], "a long, b long")
        counts = spark.createDataFrame([], "node long, links long")
        for dims, rows in sorted((r[0], r[1]) for r in classes.groupBy("dims").count().collect()):
            mine = classes.where(F.col("dims") == dims)
            drawn = min(settings.most_sample, max(settings.sample, 8 * wanted_cells(rows)))
            sample = mine.orderBy(F.xxhash64(F.lit(seed), "node"), "node").limit(drawn).select("embedding").toArrow()["embedding"].combine_chunks()
            found = written(_links(mine, train(_unit(sample), rows, settings), settings), "pq-links")
            edges = edges.unionByName(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
            counts = counts.unionByName(found.groupBy("node").agg(F.sum("links").alias("links")))
        roots = written(components(edges, "pq-cc").select(F.col("node").alias("x"), "root"), "pq-roots")
        labelled = classes.select("node", "n", "least").join(roots, F.col("node") == F.col("x"), "left").withColumn("root", F.coalesce("root", "node"))
        # tables on both sides of the join, so that adaptive execution can split the rows of a hot component
        labelled = written(labelled.select("node", "n", "least", "root"), "pq-labelled")
        ids = written(labelled.groupBy("root").agg(F.min("least").alias("component_id")), "pq-ids")
        labelled = labelled.join(ids, "root").join(counts.select(F.col("node").alias("y"), "links"), F.col("node") == F.col("y"), "left")
        labelled = kept(written(labelled.select("node", "n", "component_id", "links"), "pq-found"))
    out = vectors.select("vec_id", F.col("node").alias("z")).join(labelled, F.col("z") == F.col("node"), "left")
    out = out.select("vec_id", F.coalesce(F.col("n") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _links(classes: DataFrame, index: Index, settings: Settings) -> DataFrame:
    """(node, links, root) by block, for classes (node, n, label, embedding) of one length."""
    spark = classes.sparkSession
    shipped = spark.sparkContext.broadcast(index)  # bounded by the settings

    def assign(batches):
        index = shipped.value
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):  # scores of a piece against all cells at once
                piece = batch.slice(a, 1024)
                x = _unit(piece.column("embedding"))
                score = x @ index.centroids.T
                best = score.argmax(1)
                visit = (score >= score.max(1, keepdims=True) - settings.margin) & (np.arange(score.shape[1]) > best[:, None])
                i, j = np.nonzero(visit)
                cells = pa.ListArray.from_arrays(pa.array(np.searchsorted(i, np.arange(len(x) + 1)), pa.int32()), pa.array(j, pa.int32()))
                _, codes, error = encode(index, x)
                columns = [piece.column(c) for c in ("node", "n", "label", "embedding")] + [pa.array(best, pa.int32()), cells, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error)]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "n", "label", "embedding", "cell", "visits", "codes", "error"])

    kind = classes.schema["embedding"].dataType.simpleString()
    coded = written(classes.select("node", "n", "label", "embedding").mapInArrow(assign, f"node long, n long, label {classes.schema['label'].dataType.simpleString()}, embedding {kind}, cell int, visits array<int>, codes binary, error double"), "pq-coded")
    in_blocks = lambda c: F.ceil(c / settings.block).cast("int")
    members = coded.groupBy("label", F.col("cell").alias("c")).agg(in_blocks(F.count("*")).alias("blocks"))
    queries = coded.select("label", F.explode("visits").alias("c")).groupBy("label", "c").agg(in_blocks(F.count("*")).alias("more"))
    sizes = written(members.join(queries, ["label", "c"], "left").select(F.col("label").alias("l"), "c", "blocks", F.coalesce("more", F.lit(0)).alias("more")), "pq-sizes")
    at = (F.col("label") == F.col("l")) & (F.col("to") == F.col("c"))
    vector, code = ["node", "n", "label", "embedding"], ["codes", "error"]
    none = [F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("double").alias("error")]
    # a task is a pair (i, j): members of block i, and as queries themselves (j = i), a later block of the cell, or a block of visitors
    own = coded.withColumn("to", F.col("cell")).join(sizes, at).withColumn("i", F.pmod("node", F.col("blocks")).cast("int"))
    as_member = own.select(*vector, "to", "i", F.explode(F.sequence(F.col("i"), F.col("blocks") + F.col("more") - 1)).alias("j"), F.lit(True).alias("member"), *code)
    as_query = own.where("i > 0").select(*vector, "to", F.explode(F.sequence(F.lit(0), F.col("i") - 1)).alias("b"), F.col("i").alias("j"), F.lit(False).alias("member"), *none).withColumnRenamed("b", "i")
    visitor = coded.withColumn("to", F.explode("visits")).join(sizes, at).withColumn("j", F.col("blocks") + F.pmod(F.xxhash64("node"), F.col("more")).cast("int"))
    visitor = visitor.select(*vector, "to", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i"), "j", F.lit(False).alias("member"), *none)

    def run(table: pa.Table) -> pa.Table:
        index = shipped.value
        order = np.argsort(~table["member"].to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        x, n, node = _unit(table["embedding"].combine_chunks()), table["n"].to_numpy(), table["node"].to_numpy()
        m = int(table["member"].to_numpy().sum())
        codes = np.frombuffer(b"".join(table["codes"][:m].to_pylist()), np.uint8).reshape(m, -1) if m else np.zeros((0, len(index.books)), np.uint8)
        alone = table["i"][0].as_py() == table["j"][0].as_py()
        a, b = block_links(index, table["to"][0].as_py(), x[:m], codes, table["error"][:m].to_numpy(), None if alone else x[m:])
        a = a if alone else a + m
        links = np.bincount(a, n[b], len(x)) + np.bincount(b, n[a], len(x))
        root, live = forest(len(x), a, b), np.flatnonzero(links)
        return pa.table({"node": node[live], "links": links[live].astype(np.int64), "root": node[root[live]]})

    return as_member.unionByName(as_query).unionByName(visitor).groupBy("label", "to", "i", "j").applyInArrow(run, "node long, links long, root long")


def op10(spark, sf_dir):
    """All rows of ``embeddings``, equal labels only, cosine of 0.93 or more."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


OP10_SQL = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.93
), reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), least AS (SELECT a, min(b) AS b FROM reach GROUP BY a), n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT x.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, coalesce(least(x.vec_id, least.b), x.vec_id) AS component_id, coalesce(least(x.vec_id, least.b), x.vec_id) = x.vec_id AS kept
FROM embeddings x LEFT JOIN n ON x.vec_id = n.a LEFT JOIN least ON x.vec_id = least.a
"""
