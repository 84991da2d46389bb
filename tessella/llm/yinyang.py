"""Centroid clustering with group bounds (Yinyang): exact Lloyd rounds that skip centroids which can't win.

Centroids are put into groups once.  Each vector keeps its cluster, an upper bound of the distance to
its centroid and one lower bound for each group: no other centroid of the group is nearer.  When
centroids have moved, bounds give way by as much.  A vector whose upper bound is below all lower bounds
stays (global filter); of the others, a group whose lower bound is above the exact distance is skipped
(group filter); centroids of the groups that are left are scanned exactly.

Vectors are integers, distances are exact, and bounds err to the safe side, so that the result is that of
plain rounds.  Each round reads and writes one table of vectors and bounds; partitions send sums of their
clusters, and the driver holds only the centroids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, kept, table, workspace, written

#: Components are held to this magnitude, so that squared distances of up to 64 components fit a long.
LIMIT = 1 << 27
#: Up to this magnitude a matrix product in doubles is exact for 64 components.
EXACT = 1 << 22
#: Bounds give way by this share of themselves at each step, far more than the rounding of their sums and roots.
SLACK = 1e-9


def usable(vector: Column, dims: int) -> Column:
    """Whether a vector has exactly ``dims`` components, none of them null, NaN or infinite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce((F.size(vector) == dims) & ~bad, F.lit(False))


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, x as double; values beyond ``LIMIT`` count as that."""
    return F.transform(vector, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(LIMIT))), F.lit(-float(LIMIT)))).cast("int"))


def centroid_groups(centroids: np.ndarray, count: int, rounds: int = 5) -> np.ndarray:
    """The group of each centroid: farthest-first seeds and a few rounds of k-means among the centroids alone."""
    points = centroids.astype(np.float64)
    seeds, far = [0], np.linalg.norm(points - points[0], axis=1)
    while len(seeds) < min(count, len(points)):
        seeds.append(int(far.argmax()))
        far = np.minimum(far, np.linalg.norm(points - points[seeds[-1]], axis=1))
    centres = points[seeds]
    for _ in range(rounds):
        group = ((points[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        centres = np.array([points[group == g].mean(0) if (group == g).any() else centres[g] for g in range(len(centres))])
    return np.unique(group, return_inverse=True)[1].astype(np.int32)


def squared(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances as int64, a row for each vector and a column for each centroid."""
    if not len(vectors):
        return np.zeros((0, len(centroids)), np.int64)
    if vectors.shape[1] <= 64 and max(np.abs(vectors).max(), np.abs(centroids).max()) <= EXACT:
        v, c = vectors.astype(np.float64), centroids.astype(np.float64)
        return ((v * v).sum(1)[:, None] - 2 * (v @ c.T) + (c * c).sum(1)[None]).astype(np.int64)
    out = np.empty((len(vectors), len(centroids)), np.int64)
    for j, c in enumerate(centroids.astype(np.int64)):
        out[:, j] = ((vectors.astype(np.int64) - c) ** 2).sum(1)
    return out


def first_assignment(vectors: np.ndarray, centroids: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(cluster, squared distance, upper, lower) by a full scan; ties go to the smaller number."""
    d = squared(vectors, centroids)
    own = d.argmin(1)
    rows = np.arange(len(vectors))
    exact, roots = d[rows, own], np.sqrt(d.astype(np.float64)) * (1 - SLACK)
    roots[rows, own] = np.inf
    lower = np.stack([roots[:, groups == g].min(1) for g in range(groups.max() + 1)], 1)
    return own.astype(np.int32), exact, np.sqrt(exact.astype(np.float64)) * (1 + SLACK), lower


def next_assignment(vectors, own, upper, lower, before, centroids, groups) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """The same from the bounds against the centroids ``before``; squared distances of vectors that the first filter
    kept are -1.  The last value counts the distances that were computed."""
    drift = np.sqrt(((centroids - before).astype(np.float64) ** 2).sum(1)) * (1 + SLACK)
    own, upper, exact = own.copy(), (upper + drift[own]) * (1 + SLACK), np.full(len(own), -1, np.int64)
    lower = lower - np.array([drift[groups == g].max() for g in range(groups.max() + 1)])[None]
    lower -= SLACK * np.abs(np.where(np.isfinite(lower), lower, 0))
    open_ = np.flatnonzero(lower.min(1) <= upper)  # global filter
    v = vectors[open_]
    best, at = np.empty(len(open_), np.int64), own[open_].copy()
    for c in np.unique(at):
        some = at == c
        best[some] = squared(v[some], centroids[c : c + 1])[:, 0]
    computed, was, was_distance = len(open_), at.copy(), best.copy()
    tight = np.sqrt(best.astype(np.float64)) * (1 + SLACK)
    survive = lower[open_] <= tight[:, None]  # group filter
    scanned = {}
    for g in range(lower.shape[1]):
        rows, members = np.flatnonzero(survive[:, g]), np.flatnonzero(groups == g)
        if not len(rows):
            continue
        d = squared(v[rows], centroids[members])
        computed += d.size
        scanned[g] = rows, members, d
        nearest = d.argmin(1)
        value, number = d[np.arange(len(rows)), nearest], members[nearest]
        better = (value < best[rows]) | ((value == best[rows]) & (number < at[rows]))
        best[rows[better]], at[rows[better]] = value[better], number[better]
    left = np.flatnonzero(at != was)  # the old centroid is now one of the others of its group
    low = lower[open_]
    np.minimum.at(low, (left, groups[was[left]]), np.sqrt(was_distance[left].astype(np.float64)) * (1 - SLACK))
    for g, (rows, members, d) in scanned.items():
        roots = np.sqrt(d.astype(np.float64)) * (1 - SLACK)
        roots[members[None] == at[rows][:, None]] = np.inf
        low[rows, g] = roots.min(1)
    own[open_], exact[open_], lower[open_] = at, best, low
    upper[open_] = np.sqrt(best.astype(np.float64)) * (1 + SLACK)
    return own, exact, upper, lower, computed


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def _lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(rows.reshape(-1), kind), rows.shape[1]).cast(pa.list_(kind))


def _assign(rows: DataFrame, centroids: np.ndarray, groups: np.ndarray, before: np.ndarray | None = None, last: bool = False) -> DataFrame:
    """rows (row, v and, after the first round, own, upper, lower) with clusters and bounds against ``centroids``; at last the distance instead."""
    state = [f for f in rows.schema.fields if f.name in ("row", "v")]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in state if f.name == "row" or not last)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            v = _matrix(b.column("v"), np.int64)
            if before is None:
                own, exact, upper, lower = first_assignment(v, centroids, groups)
            else:
                own, exact, upper, lower, _ = next_assignment(v, b.column("own").to_numpy(), b.column("upper").to_numpy(), _matrix(b.column("lower"), np.float64), before, centroids, groups)
            if not last:
                yield pa.RecordBatch.from_arrays([b.column("row"), b.column("v"), pa.array(own, pa.int32()), pa.array(upper), _lists(lower, pa.float64())], names=["row", "v", "own", "upper", "lower"])
                continue
            for c in np.unique(own[exact < 0]):
                some = (own == c) & (exact < 0)
                exact[some] = squared(v[some], centroids[c : c + 1])[:, 0]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(own, pa.int32()), pa.array(exact)], names=["row", "own", "exact"])

    return rows.mapInArrow(run, f"{kinds}, own int, exact long" if last else f"{kinds}, own int, upper double, lower array<double>")


def _moved(assigned: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids as floor(sum / count) of their vectors, exactly; empty ones stay.  A partition sends a row for each cluster and component."""
    dims = centroids.shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
        for b in batches:
            v, own = _matrix(b.column("v"), np.int64) if len(b) else np.zeros((0, dims), np.int64), b.column("own").to_numpy()
            order = np.argsort(own, kind="stable")
            present, first = np.unique(own[order], return_index=True)
            if len(present):
                total[present] += np.add.reduceat(v[order], first, axis=0)
                count += np.bincount(own, minlength=len(centroids))
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(some, dims), pa.int32()), pa.array(np.tile(np.arange(dims), len(some)), pa.int32()), pa.array(total[some].reshape(-1)), pa.array(np.repeat(count[some], dims))], names=["own", "at", "s", "n"])

    rows = assigned.select("v", "own").mapInArrow(sums, "own int, at int, s long, n long").groupBy("own", "at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
    out = centroids.copy()
    for r in rows.collect():  # a row for each component of the centroids
        out[r.own, r.at] = int(r.s) // r.n
    return out


def cluster(vectors: DataFrame, vector: str, key: Column, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, groups: int | None = None) -> DataFrame:
    """vectors that are ``usable`` without the vector column, with ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid_sha256``.

    Centroids start as the k vectors with the smallest ``key``, in its order (null last, ties by components); with fewer
    vectors there are fewer.  After ``rounds`` rounds of assigning and moving, vectors are assigned once more.
    groups: how many groups of centroids, by default one for each four.
    Vectors that are null, of another length or hold null or non-finite components are left out; without any there are no
    rows.  Repeated rows stay repeated.  Input columns of the names above are replaced.  Sums past a long are null.
    """
    spark, columns = vectors.sparkSession, [c for c in vectors.columns if c != vector]
    usable_rows = vectors.where(usable(F.col(vector), dims)).select(F.struct(*[F.col(f"`{c}`") for c in columns], F.lit(0).alias("_")).alias("row"), quantised(F.col(vector), scale).alias("v"), key.alias("key"))
    chosen = usable_rows.orderBy(F.col("key").asc_nulls_last(), "v").select("v").limit(k).collect()
    names = [c for c in columns if c.lower() not in ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")]
    made = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not chosen:
        return vectors.where("false").select(*[F.col(f"`{c}`") for c in names], *[F.lit(None).cast(x.split()[1]).alias(x.split()[0]) for x in made.split(", ")])
    centroids = np.array([r.v for r in chosen], np.int64)
    group = centroid_groups(centroids, groups or max(1, -(-len(centroids) // 4)))
    with workspace(spark):
        now, before = usable_rows.drop("key"), None
        for _ in range(rounds):
            last = now
            now = written(_assign(now, centroids, group, before), "yinyang")
            if before is not None:
                discard(last)
            before, centroids = centroids, _moved(now, centroids)
        out = kept(written(_assign(now, centroids, group, before, last=True), "yinyang-clusters"))
    sums = {r.own: int(r.s) for r in out.groupBy("own").agg(F.sum(F.col("exact").cast("decimal(38,0)")).alias("s")).collect()}
    fits = lambda n: n if n < 1 << 63 else None
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    known = spark.createDataFrame([(c, fits(s), fits(sum(sums.values())), digest[c]) for c, s in sums.items()], "c int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = out.join(F.broadcast(known), F.col("own") == F.col("c"))  # a row for each cluster
    return out.select(*[F.col(f"row.`{c}`") for c in names], F.col("own").alias("cluster"), F.col("exact").alias("distance"), "cluster_inertia", "inertia", "centroid_sha256")


def op11(spark, sf_dir):
    """All usable ``embeddings``: 16 centroids, three rounds."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return cluster(rows, "embedding", F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")).cast("binary"), 256))


def _sql() -> str:
    nearest = "SELECT vec_id, r, v, c AS cluster, d FROM (SELECT x.vec_id, x.r, x.v, y.c, {d} AS d, row_number() OVER (PARTITION BY x.r ORDER BY {d}, y.c) AS place FROM kept x, {c} y) WHERE place = 1"
    d = "list_sum(list_transform(list_zip(x.v, y.m), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    parts = [
        "given AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings WHERE len(embedding) = 64)",
        "kept AS (SELECT vec_id, row_number() OVER () AS r, list_transform(e, lambda x: CAST(floor(64 * x) AS BIGINT)) AS v FROM given WHERE len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)",
        "c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) - 1 AS c, v AS m FROM kept QUALIFY c < 16)",
    ]
    for k in range(3):
        parts.append(f"a{k} AS ({nearest.format(d=d, c=f'c{k}')})")
        parts.append(f"s{k} AS (SELECT cluster, i, (s - ((s % n) + n) % n) // n AS m FROM (SELECT cluster, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS n FROM a{k}, range(1, 65) t(i) GROUP BY cluster, i))")
        parts.append(f"c{k + 1} AS (SELECT c, coalesce(new, m) AS m FROM c{k} LEFT JOIN (SELECT cluster, list(m ORDER BY i) AS new FROM s{k} GROUP BY cluster) ON c = cluster)")
    parts.append(f"last AS ({nearest.format(d=d, c='c3')})")
    return f"WITH {', '.join(parts)} SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256 FROM last JOIN c3 ON c = cluster"


OP11_SQL = _sql()
