"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Training takes a bounded, seeded sample of labelled rows (``max_rows`` and ``max_bytes``,
parameters) and visits it in a fixed order; per-coordinate rates and the L1 term leave a
few thousand non-zero weights, and only these are shipped to the executors.  Scoring
reads every document whole, in one narrow pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, private, sampled, ship, table
from .kernel import ALNUM, FOLDED_CODE, U64, mix, owners, prefix_hash, slices, span_hash, string_buffer, words


@dataclass(frozen=True)
class Settings:
    bits: int = 20
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 3.0
    l2: float = 1.0
    epochs: int = 3
    skips: tuple[int, ...] = (1, 2)  #: distances of word pairs: 1 is a bigram, 2 skips a word
    heads: tuple[int, ...] = (4, 6)  #: bytes of word beginnings, which inflected forms share
    max_rows: int = 6_000  #: to learn from
    max_bytes: int = 64 << 20  #: of their texts


@dataclass(frozen=True)
class Model:
    settings: Settings
    bias: float
    index: np.ndarray  #: sorted buckets with non-zero weight
    weight: np.ndarray


def features(buf: np.ndarray, offsets: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(document number, bucket) of every n-gram and skip-gram, repeats included."""
    starts, ends, first = words(buf, offsets, ALNUM)
    prefix = prefix_hash(buf, FOLDED_CODE)
    hashes = span_hash(prefix, starts, ends)
    doc, mask = owners(first), U64((1 << settings.bits) - 1)
    docs, buckets = [doc], [hashes & mask]
    for head in settings.heads:
        longer = ends - starts > head
        docs.append(doc[longer])
        buckets.append(mix(span_hash(prefix, starts[longer], starts[longer] + head) + U64(1)) & mask)
    for gap in settings.skips:
        same = doc[gap:] == doc[:-gap]
        docs.append(doc[gap:][same])
        buckets.append((mix(hashes[:-gap] * U64(3) + hashes[gap:] + U64(gap))[same]) & mask)
    return np.concatenate(docs), np.concatenate(buckets).astype(np.int64)


def train(texts: pa.ChunkedArray, labels: np.ndarray, settings: Settings) -> Model:
    """One pass per epoch, a document at a time, over the presence of each feature."""
    buf, offsets = string_buffer(texts)
    rows: list[np.ndarray] = []
    for a, b in slices(offsets):
        doc, bucket = features(buf[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], settings)
        keys = np.unique((doc << settings.bits) | bucket)
        cut = np.searchsorted(keys, np.arange(b - a + 1) << settings.bits)
        rows += [keys[i:j] & ((1 << settings.bits) - 1) for i, j in zip(cut[:-1], cut[1:], strict=True)]
    size = 1 << settings.bits
    z, n, none = np.zeros(size + 1), np.zeros(size + 1), np.zeros(0)
    bias_at = np.array([size])
    rate = settings.alpha
    for _ in range(settings.epochs):
        for x, y in zip(rows, labels, strict=True):
            x = np.concatenate((x, bias_at))
            zx, root = z[x], np.sqrt(n[x])
            w = np.where(np.abs(zx) <= settings.l1, 0.0, (np.sign(zx) * settings.l1 - zx) / ((settings.beta + root) / rate + settings.l2))
            w[-1] = -zx[-1] / ((settings.beta + root[-1]) / rate)  # the bias is not shrunk
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            z[x] = zx + g - (np.sqrt(n[x] + g * g) - root) / rate * w
            n[x] += g * g
    root = np.sqrt(n)
    w = np.where(np.abs(z) <= settings.l1, 0.0, (np.sign(z) * settings.l1 - z) / ((settings.beta + root) / rate + settings.l2))
    index = np.flatnonzero(w[:size])
    return Model(settings, float(-z[size] / ((settings.beta + root[size]) / rate)) if len(rows) else 0.0, index, w[index] if len(index) else none)


def fit(docs: DataFrame, labels: DataFrame, label: str, settings: Settings = Settings(), seed: int = 5) -> Model:
    """Learn from documents with a label: those first in a seeded order, within ``max_rows`` and ``max_bytes``.

    Only labels of ids that the documents have count, and only then the bounds.  Null labels and ids are left out; null
    texts are empty.  Repeated rows count once; an id with both labels counts for both.
    Without any row the model is neutral: every score is 0.5.
    """
    ship(docs.sparkSession)
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("i"), F.col(label).cast("double").alias("y")).distinct()
    known = known.join(docs.select(F.col("doc_id").alias("i")), "i", "left_semi").select("i", "y", F.xxhash64(F.lit(seed), "i").alias("first")).orderBy("first", "i", "y").limit(settings.max_rows)
    rows = docs.select(F.col("doc_id").alias("j"), F.coalesce("text", F.lit("")).alias("t")).join(F.broadcast(known), F.col("i") == F.col("j"))  # bounded by max_rows
    rows = sampled(rows.select(F.xxhash64(F.lit(seed), "i", "y", "t").alias("o"), "y", "t"), "o", "t", settings.max_rows, settings.max_bytes)
    return train(rows["t"], rows["y"].to_numpy(), settings)


def score(docs: DataFrame, model: Model, text: Column, keep: list[str], name: str = "score") -> DataFrame:
    """The kept columns with a score from 0 to 1, for every row; null and empty texts get the score of no features.

    The non-zero weights are broadcast, at most 12 bytes for each of 2**bits buckets.
    """
    ship(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast((model.index.astype(np.uint32), model.weight.astype(np.float32)))
    schema = docs.select(*keep).schema.add(name, "double")
    settings, bias = model.settings, model.bias
    (hidden,) = private(docs, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(1 << settings.bits, np.float32)
        index, weight = shipped.value
        weights[index] = weight
        for batch in batches:
            buf, offsets = string_buffer(batch.column(hidden))
            total = np.full(batch.num_rows, bias)
            for a, b in slices(offsets):
                doc, bucket = features(buf[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], settings)
                live = np.flatnonzero(weights[bucket])
                keys = np.unique((doc[live] << settings.bits) | bucket[live])
                total[a:b] += np.bincount(keys >> settings.bits, weights[keys & ((1 << settings.bits) - 1)], b - a)
            arrays = [batch.column(c) for c in keep] + [pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, name])

    return docs.select(*keep, text.alias(hidden)).mapInArrow(run, schema)


def op2(spark, sf_dir):
    """Toxicity of every whole text of ``documents``, learned from labels outside the held-out quarter."""

    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 4) != 2)
    model = fit(docs, labels, "toxic")
    scored = score(docs, model, F.col("text"), ["doc_id"])
    return scored.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
