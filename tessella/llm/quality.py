"""Quality by kernel ridge regression on document statistics, with isotonic calibration.

One pass over the texts gives a short vector of statistics for each document, which is
written; everything after it reads that narrow table.  Random Fourier features
approximate a Gaussian kernel on the standardised statistics.  Each partition sums its
part of the normal equations, sums of sums are taken before they reach the driver, and
the calibration fold is reduced to counts by score bin before pool-adjacent-violators.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from .common import fold, private, ship, table, workspace, written
from .common import kept as kept_table
from .kernel import BYTE_CODE, FOLDED_CODE, NON_SPACE, owners, prefix_hash, slices, span_hash, string_buffer, words

_KINDS = {
    "upper": [*range(0x41, 0x5B)],
    "digit": [*range(0x30, 0x3A)],
    "stop": [*b".,;:'\"?"],
    "loud": [*b"!"],
    "symbol": [*b"#$%&*@^~+=<>/\\_"],
    "bar": [*b"|{}[]()"],
    "space": [*b" \t\n\r"],
    "high": [*range(0x80, 0x100)],
}
STATS = ["bytes", "words", "lines", "word_bytes", *_KINDS, "distinct_words", "distinct_lines", "long_words", "short_words", "ended_lines", "line_words"]


def statistics(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of STATS for each document; all are finite, and zero for an empty text."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    starts, ends, first = words(buf, offsets, NON_SPACE)
    count = np.diff(first).astype(float)
    doc = owners(first)
    not_break = np.ones(256, bool)
    not_break[0x0A] = False
    line_starts, line_ends, line_first = words(buf, offsets, not_break)
    line_doc = owners(line_first)
    lines = np.diff(line_first).astype(float)
    many, some, rows = np.maximum(size, 1), np.maximum(count, 1), np.maximum(lines, 1)
    by = lambda who, what: np.bincount(who, what, n)
    out = [np.log1p(size), np.log1p(count), np.log1p(lines), by(doc, ends - starts) / some]
    for members in _KINDS.values():
        inside = np.zeros(256, bool)
        inside[members] = True
        before = np.concatenate(([0], np.cumsum(inside[buf])))
        out.append((before[offsets[1:]] - before[offsets[:-1]]) / many)

    def distinct(who: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        order = np.lexsort((hashes, who))
        new = np.ones(len(who), bool)
        new[1:] = (np.diff(who[order]) != 0) | (np.diff(hashes[order]) != 0)
        return np.bincount(who[order][new], minlength=n)

    out.append(distinct(doc, span_hash(prefix_hash(buf, FOLDED_CODE), starts, ends)) / some)
    out.append(distinct(line_doc, span_hash(prefix_hash(buf, BYTE_CODE), line_starts, line_ends)) / rows)
    out += [by(doc, (ends - starts) >= 12) / some, by(doc, (ends - starts) <= 3) / some]
    out += [by(line_doc, np.isin(buf[line_ends - 1], [*b".!?"])) / rows, np.log1p(count / rows)]
    return np.stack(out, 1) if n else np.zeros((0, len(STATS)))


def document_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns and ``stats`` (array of doubles) of each whole text; null counts as empty."""
    ship(docs.sparkSession)
    schema = docs.select(*keep).schema.add("stats", ArrayType(DoubleType()))
    (hidden,) = private(docs, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = string_buffer(batch.column(hidden))
            parts = [statistics(buf[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in slices(offsets)]
            flat = np.concatenate(parts).ravel() if parts else np.zeros(0)
            arrays = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * len(STATS), pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), arrays], names=[*keep, "stats"])

    return docs.select(*keep, F.col("text").alias(hidden)).mapInArrow(run, schema)


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    frequency: np.ndarray
    phase: np.ndarray
    weight: np.ndarray
    knots: np.ndarray  #: raw scores, rising
    values: np.ndarray  #: calibrated probability at each knot

    def lift(self, x: np.ndarray) -> np.ndarray:
        z = np.cos(((x - self.mean) / self.scale) @ self.frequency + self.phase) * math.sqrt(2 / len(self.phase))
        return np.concatenate((z, np.ones((len(x), 1))), 1)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.lift(x) @ self.weight, self.knots, self.values)


def isotonic(positive: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Pool adjacent violators over bins in rising order of score."""
    blocks: list[list[float]] = []
    for p, c in zip(positive, count, strict=True):
        blocks.append([p, c, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            p2, c2, k2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + p2, blocks[-1][1] + c2, blocks[-1][2] + k2]
    return np.concatenate([np.full(int(k), p / c) for p, c, k in blocks]) if blocks else np.zeros(0)


def _summed(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y over all rows (stats, y): by partition, then by groups of partitions, then on the driver."""
    d = len(model.phase) + 1

    def part(batches):
        a, b = np.zeros((d, d)), np.zeros(d)
        for batch in batches:
            x = batch.column("stats").flatten().to_numpy().reshape(batch.num_rows, -1)
            z = model.lift(x)
            a += z.T @ z
            b += z.T @ batch.column("y").to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array([a.tobytes() + b.tobytes()])], names=["sums"])

    def add(batches):
        total = np.zeros(d * d + d)
        for batch in batches:
            for x in batch.column("sums").to_pylist():
                total += np.frombuffer(x)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], names=["sums"])

    sums = rows.select("stats", "y").mapInArrow(part, "sums binary").repartition(8).mapInArrow(add, "sums binary").collect()
    total = sum((np.frombuffer(r.sums) for r in sums), np.zeros(d * d + d))
    return total[: d * d].reshape(d, d), total[d * d :]


def fit(rows: DataFrame, features: int = 192, ridge: float = 1e-3, gamma: float = 0.05, bins: int = 400, seed: int = 11) -> Model | None:
    """Fit on all rows (doc_id, stats, y): ridge on four folds of five by id, calibration on the fifth.

    Returns None if there is no row to learn from, and a constant model if y never varies.
    """
    k = len(STATS)
    moments = rows.agg(F.count("*"), F.avg("y"), *[f(F.col("stats")[i]) for i in range(k) for f in (F.avg, F.stddev_pop)]).first()
    if not moments[0]:
        return None
    rng = np.random.default_rng(seed)
    mean, scale = np.array(moments[2::2], float), np.array(moments[3::2], float)
    scale = np.where(scale > 1e-9, scale, 1.0)
    model = Model(mean, scale, rng.normal(0, math.sqrt(2 * gamma), (k, features)), rng.uniform(0, 2 * math.pi, features), np.zeros(features + 1), np.array([0.0]), np.array([float(moments[1])]))
    if moments[1] in (0.0, 1.0):
        return model
    fold = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(5))
    a, b = _summed(rows.where(fold != 0), model)
    weight = np.linalg.solve(a + ridge * max(1.0, moments[0] / 1000) * np.eye(len(b)), b)
    model = Model(mean, scale, model.frequency, model.phase, weight, model.knots, model.values)

    def binned(batches):
        for batch in batches:
            x = batch.column("stats").flatten().to_numpy().reshape(batch.num_rows, -1)
            at = np.clip(np.floor((model.lift(x) @ weight + 0.5) * (bins / 2)), 0, bins - 1)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), batch.column("y")], names=["b", "y"])

    counts = rows.where(fold == 0).select("stats", "y").mapInArrow(binned, "b int, y double").groupBy("b").agg(F.sum("y").alias("p"), F.count("*").alias("n")).orderBy("b").collect()
    if not counts:
        return model
    # one document of each label, spread over all bins, keeps small folds away from 0 and 1
    prior = float(moments[1])
    values = isotonic(np.array([r.p for r in counts]) + prior / len(counts), np.array([float(r.n) for r in counts]) + 1 / len(counts))
    knots = (np.array([r.b for r in counts]) + 0.5) * (2 / bins) - 0.5
    return Model(mean, scale, model.frequency, model.phase, weight, knots, values)


def score(stats: DataFrame, model: Model | None, keep: list[str], name: str = "score") -> DataFrame:
    """The kept columns with the calibrated score from 0 to 1; 0.5 for all where there was nothing to learn."""
    schema = stats.select(*keep).schema.add(name, "double")

    def run(batches):
        for batch in batches:
            x = batch.column("stats").flatten().to_numpy().reshape(batch.num_rows, -1)
            y = np.clip(model(x), 0, 1) if model else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(y)], names=[*keep, name])

    return stats.select(*keep, "stats").mapInArrow(run, schema)


def kept(docs: DataFrame, model: Model | None, least: float = 0.3, text: str = "text") -> DataFrame:
    """The rows of docs, all columns as they are, whose text scores ``least`` or more: one narrow pass; null texts count as empty."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            buf, offsets = string_buffer(batch.column(text))
            good = np.ones(batch.num_rows, bool)
            for a, b in slices(offsets) if model else ():
                good[a:b] = np.clip(model(statistics(buf[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])), 0, 1) >= least
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)


def training_rows(stats: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """(doc_id, stats, y) of the documents with a label; ids and labels that are null are left out."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("double").alias("y"))
    return stats.where("doc_id is not null").select("doc_id", "stats").join(known, "doc_id")


def learned(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Model | None:
    """The model of all documents with a label: statistics are taken first, and only they are shuffled."""
    with workspace(docs.sparkSession):
        return fit(written(training_rows(document_statistics(docs, ["doc_id"]), labels, label), "quality-rows"))


def op7(spark, sf_dir):
    """Quality of every whole text of ``documents``, learned from labels outside the held-out fifth."""
    docs, held = table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 5) == 0
    with workspace(spark):
        stats = kept_table(written(document_statistics(docs, ["doc_id"]), "quality-stats"))
        model = fit(written(training_rows(stats, table(spark, sf_dir, "labels").where(~held)), "quality-rows"))
    return score(stats, model, ["doc_id"]).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
