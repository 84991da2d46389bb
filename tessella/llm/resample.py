"""Target-distribution importance resampling over hashed word features, with identical texts collapsed.

Texts are grouped in full, so that features of a text are computed once however many documents hold it; bucket
counts of the corpus are those of distinct texts times their copies.  A bucket's gain is the log ratio of its
smoothed share in the target to that in the corpus, and a text's weight the mean gain of its features.  Weights
are joined back to documents by the digest of the text, and only then does each document get its own noise
(Gumbel, from a hash of its id), so that the highest scores are a draw without replacement in proportion to weight.

Copies are added up before the shuffle.  The join back broadcasts weights while they are measured to be small;
beyond that the texts that hold a thousandth of all rows or more, a thousand at most, are broadcast, and the others, none of
which is hot, are joined by a shuffle of ids and digests.  Ranks come from a range-partitioned sort of what may be
drawn and from the counts of its partitions.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernel
from .common import discard, kept, partitions, table, workspace, written

#: Words longer than this have their checksum computed one by one.
LONG_WORD = 48
#: A text with that share of all rows, or more, is hot: one in so many.
HOT = 1000
#: Bytes of a row of weights in a broadcast: 32 of digest, four numbers, and what a hashed relation adds.
WEIGHT_ROW = 160


def _crc_table() -> np.ndarray:
    """The effect of each byte on a CRC-32 (reflected polynomial 0xEDB88320)."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = (out >> np.uint32(1)) ^ np.where(out & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return out


CRC = _crc_table()


def crc32_of_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """CRC-32 of buf[start:end] for each span, going on from the checksums ``before`` if they are given: one step for each place in a word."""
    out = np.zeros(len(starts), np.uint32) if before is None else before.astype(np.uint32)
    state, size = ~out, ends - starts
    active = np.flatnonzero((size > 0) & (size <= LONG_WORD))
    place = 0
    while len(active):
        now = state[active]
        state[active] = CRC[(now ^ buf[starts[active] + place]) & np.uint32(0xFF)] ^ (now >> np.uint32(8))
        place += 1
        active = active[size[active] > place]
    out = ~state
    for i in np.flatnonzero(size > LONG_WORD):
        out[i] = zlib.crc32(buf[starts[i] : ends[i]].tobytes(), int(before[i]) if before is not None else 0)
    return out


def feature_buckets(buf: np.ndarray, offsets: np.ndarray, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each feature, in order by document; features of each document; words of each document).

    Words are runs of ASCII letters, digits and other characters above ASCII, A-Z lower-cased; features are all runs of one to
    ``longest`` words, joined by one space.
    """
    folded = buf.copy()
    upper = (folded >= 0x41) & (folded <= 0x5A)
    folded[upper] += 0x20
    starts, ends, first = kernel.words(folded, offsets, kernel.ALNUM)
    words, owner = np.diff(first), kernel.owners(first)
    found, owners, state = [], [], None
    for run in range(longest):
        n = max(0, len(starts) - run)
        if run:
            space = state[:n] ^ np.uint32(0xFFFFFFFF)
            state = ~(CRC[(space ^ np.uint32(0x20)) & np.uint32(0xFF)] ^ (space >> np.uint32(8)))
        state = crc32_of_spans(folded, starts[run : run + n], ends[run : run + n], state)
        whole = owner[:n] == owner[run : run + n]  # runs don't cross documents
        found.append(state[whole] % np.uint32(buckets)), owners.append(owner[:n][whole])
    bucket, owner = np.concatenate(found), np.concatenate(owners)
    order = np.lexsort((bucket, owner))
    return bucket[order].astype(np.uint16 if buckets <= 1 << 16 else np.uint32), np.bincount(owner, minlength=len(words)), words


def _kind(buckets: int) -> type:
    return np.uint16 if buckets <= 1 << 16 else np.uint32


def text_features(texts: DataFrame, longest: int, buckets: int) -> DataFrame:
    """(digest, copies, words, features, packed) of rows (digest, copies, text): the sorted buckets of each text, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, offsets = kernel.string_buffer(b.column("text"))
            for s, e in kernel.slices(offsets):
                found, features, words = feature_buckets(buf[offsets[s] : offsets[e]], offsets[s : e + 1] - offsets[s], longest, buckets)
                ends = np.cumsum(features)
                packed = pa.array([kernel.planes(found[x - n : x]) for x, n in zip(ends, features, strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column("digest").slice(s, e - s), b.column("copies").slice(s, e - s), pa.array(words, pa.int64()), pa.array(features, pa.int64()), packed], names=["digest", "copies", "words", "features", "packed"])

    return texts.select("digest", "copies", "text").mapInArrow(run, "digest binary, copies long, words long, features long, packed binary")


def collapsed(docs: DataFrame, text: str) -> DataFrame:
    """(digest, copies, text): each distinct text once, null as the empty one; copies are added up before the shuffle."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(whole.alias("text")).groupBy("text").agg(F.count("*").alias("copies")).select(digest(F.col("text")).alias("digest"), "copies", "text")


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _unpacked(b: pa.RecordBatch, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All buckets of a batch, and the number of each row."""
    rows = b.column("packed").to_pylist()
    return np.concatenate([kernel.from_planes(x, kind) for x in rows]) if rows else np.zeros(0, kind), b.column("features").to_numpy()


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket, copies counted: a partition sends at most a row for each bucket."""
    kind = _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            found, n = _unpacked(b, kind)
            if len(found):
                total += np.bincount(found, np.repeat(b.column("copies").to_numpy(), n), buckets).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in features.select("features", "copies", "packed").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(((t + 1) (S + buckets)) / ((s + 1) (T + buckets)))) of each bucket."""
    all_s, all_t, n = int(corpus.sum()), int(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log(float((t + 1) * (all_s + n)) / float((s + 1) * (all_t + n)))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def text_weights(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """(digest, copies, words, features, weight): the floored mean gain of a text's features; without any, 0."""
    kind = _kind(len(gain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, n = _unpacked(b, kind)
            upto = np.concatenate((np.zeros(1, np.int64), np.cumsum(gain[found])))
            ends = np.cumsum(n)
            weight = (upto[ends] - upto[ends - n]) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([b.column("digest"), b.column("copies"), b.column("words"), b.column("features"), pa.array(weight, pa.int64())], names=["digest", "copies", "words", "features", "weight"])

    return features.mapInArrow(run, "digest binary, copies long, words long, features long, weight long")


def joined_back(rows: DataFrame, weights: DataFrame, most: int = 64 << 20) -> DataFrame:
    """rows with the weight of their ``digest``: by broadcast while all weights fit in ``most`` bytes, else hot texts by broadcast and the rest by shuffle."""
    size = weights.agg(F.count("*"), F.sum("copies")).first()
    weights = weights.withColumnRenamed("digest", "_w")
    if size[0] * WEIGHT_ROW <= most:
        return rows.join(F.broadcast(weights), F.col("digest") == F.col("_w")).drop("_w", "copies")
    rows = kept(written(rows, "resample-keys"))
    hot = F.col("copies") * HOT >= size[1]  # at most HOT texts
    few = rows.join(F.broadcast(weights.where(hot)), F.col("digest") == F.col("_w"))
    others = rows.join(F.broadcast(weights.where(hot).select("_w")), F.col("digest") == F.col("_w"), "left_anti")
    return few.unionByName(others.join(weights.where(~hot), F.col("digest") == F.col("_w"))).drop("_w", "copies")


def gumbel(key: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln((h + 0.5) / 2**32))), h being the first 32 bits of sha256("<seed>:<key>"); a null key is the empty one."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("long")


def ranked(scored: DataFrame, key: str, percent: int, least: int) -> DataFrame:
    """scored (written; key, words, score) with ``rank``: 1, 2, 3 ... by falling score, then key, null last, of the first
    ``percent`` % of the rows with ``least`` words; others have none."""
    spark, able = scored.sparkSession, F.col("words") >= least
    histogram = scored.where(able).groupBy("score").agg(F.count("*").alias("n")).collect()  # scores are logarithms of counts and of 32 bits: some ten thousands
    draw, taken, cut = sum(r.n for r in histogram) * percent // 100, 0, None
    for r in sorted(histogram, key=lambda r: -r.score):
        if taken < draw:
            taken, cut = taken + r.n, r.score
    nothing = F.lit(None).cast("long").alias("rank")
    if cut is None:
        return scored.select("*", nothing)
    may = able & (F.col("score") >= cut)
    order = [F.col("score").desc(), F.col(f"`{key}`").asc_nulls_last()]
    rows = scored.where(may).withColumn("_tie", F.monotonically_increasing_id())  # equal rows part by place, so that no range is one key
    rows = rows.repartitionByRange(partitions(spark), *order, "_tie").sortWithinPartitions(*order, "_tie")
    rows = kept(written(rows.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}), "resample-drawn"))
    before, starts = 0, []
    for p, n in sorted(rows.groupBy("_part").agg(F.count("*")).collect()):
        starts.append((p, before))
        before += n
    starts = F.broadcast(spark.createDataFrame(starts, "_p int, _before long"))  # a row for each partition
    place = F.col("_before") + F.col("_at") + 1
    rows = rows.join(starts, F.col("_part") == F.col("_p")).withColumn("rank", F.when(place <= draw, place)).drop("_tie", "_part", "_at", "_p", "_before")
    return rows.unionByName(scored.where(~may).select("*", nothing))


def resample(docs: DataFrame, target: DataFrame, key: str, text: str = "text", target_text: str = "text", longest: int = 1, buckets: int = 10000, seed: int = 2024, percent: int = 10, least: int = 20, most: int = 64 << 20, carry: Sequence[str] = ()) -> DataFrame:
    """(key, *carry, n_features, weight, score, rank) of every row of docs; rows with a rank are drawn.

    key: the column that noise is made of; null makes the noise of the empty text, and equal keys the same.
    target: texts whose distribution is wanted; counts of both tables are over all rows and whole texts.
    percent: of the rows with at least ``least`` words, that share is drawn, floored.
    most: bytes up to which weights are broadcast.
    Null and empty texts, and those without a word, have no features and weight 0.  Rows that tie in score and key take their
    ranks in any order.  Empty tables give no rows; an empty target only smooths.
    """
    spark, names = docs.sparkSession, [key, *carry]
    with workspace(spark):
        features = written(text_features(collapsed(docs, text), longest, buckets), "resample-features")
        gain = gains(bucket_counts(features, buckets), bucket_counts(text_features(collapsed(target, target_text), longest, buckets), buckets))
        weights = written(text_weights(features, gain), "resample-weights")
        discard(features)
        rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), digest(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("digest"))
        rows = joined_back(rows, weights, most).withColumn("score", F.col("weight") + gumbel(F.col(f"row.`{key}`"), seed))
        scored = kept(written(rows.select("row", F.col(f"row.`{key}`").alias("key"), "words", "features", "weight", "score"), "resample-scored"))
        out = ranked(scored, "key", percent, least)
    return out.select(*[F.col(f"row.`{c}`") for c in names], F.col("features").alias("n_features"), "weight", "score", "rank")


def op12(spark, sf_dir):
    """All ``documents`` towards ``benchmark``: single words, 10,000 buckets, a tenth drawn."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample(docs, table(spark, sf_dir, "benchmark").select("text"), "doc_id")


OP12_SQL = r"""
WITH steps AS (SELECT list(list_reduce(list_prepend(b, range(8)), lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)) ORDER BY b) AS t FROM range(256) r(b)),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
e AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
f AS (SELECT r, unnest(w) AS w FROM d),
bytes AS (SELECT w, list_transform(range(1, octet_length(encode(w)) + 1), lambda i: CAST('0x' || substr(hex(encode(w)), 2 * i - 1, 2) AS BIGINT)) AS b FROM (SELECT w FROM f UNION SELECT w FROM e)),
hashed AS (SELECT w, xor(list_reduce(list_prepend(4294967295, b), lambda x, y: xor(x >> 8, t[CAST(xor(x & 255, y) + 1 AS BIGINT)])), 4294967295) % 10000 AS k FROM bytes, steps),
fd AS (SELECT r, k FROM f JOIN hashed USING (w)), ft AS (SELECT k FROM e JOIN hashed USING (w)),
cs AS (SELECT k, count(*) AS s FROM fd GROUP BY k), ct AS (SELECT k, count(*) AS t FROM ft GROUP BY k),
gain AS (SELECT cs.k, floor(1000 * ln(CAST((coalesce(t, 0) + 1) * ((SELECT count(*) FROM fd) + 10000) AS DOUBLE) / CAST((s + 1) * ((SELECT count(*) FROM ft) + 10000) AS DOUBLE))) AS g FROM cs LEFT JOIN ct ON cs.k = ct.k),
mean AS (SELECT r, count(*) AS n, floor(sum(CAST(g AS BIGINT)) / count(*)) AS weight FROM fd JOIN gain USING (k) GROUP BY r),
scored AS (SELECT d.r, doc_id, len(w) AS words, coalesce(n, 0) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight, CAST(coalesce(weight, 0) AS BIGINT) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score FROM d LEFT JOIN mean ON d.r = mean.r),
places AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () * 10 // 100 AS draw FROM scored WHERE words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= draw THEN place END AS rank FROM scored LEFT JOIN places ON scored.r = places.r
"""
