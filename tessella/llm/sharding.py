"""Sharding by sampled splitters.

Keys are (hash of the text, doc_id), so that equal texts stand side by side.  A sample
drawn with probability in proportion to size gives quantile boundaries; records are
put into the ranges between them, and ranges that come out overfull are sampled again
and subdivided.  A group of equal texts that takes more than a range is known by its two
splitters and gets ranges of its own.  Exact range totals then fix where each shard begins,
so shards have near equal bytes whatever the sample was, and only ids, sizes and hashes are
shuffled unless the caller asks for more columns.
"""

from __future__ import annotations

import heapq
import json
import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import private, table, written

_LOW = -(1 << 63)


def _range_of(splitters: list[tuple[int, int]]):
    """A function of the columns (h, i): how many splitters, in order, are at most the key.

    Searched in two levels of about the square root of their number; the arrays are constants of the plan.
    """
    step = max(1, math.isqrt(len(splitters)))
    kind = "struct<h:bigint,i:bigint>"
    as_keys = lambda keys: [{"h": int(h), "i": int(i)} for h, i in keys]
    heads = F.from_json(F.lit(json.dumps(as_keys(splitters[::step]))), f"array<{kind}>")
    blocks = F.from_json(F.lit(json.dumps([as_keys(splitters[a : a + step]) for a in range(0, len(splitters), step)])), f"array<array<{kind}>>")

    def put(h: str, i: str) -> Column:
        key = F.struct(F.col(h).alias("h"), F.col(i).alias("i"))
        upto = lambda keys: F.size(F.filter(keys, lambda x: x <= key))
        before = upto(heads) - 1
        return F.when(before < 0, F.lit(0)).otherwise(before * step + upto(F.get(blocks, F.greatest(before, F.lit(0))))).cast("int")

    return put


def sampled_ranges(rows: DataFrame, ranges: int, seed: int = 29, per_range: int = 16, overfull: float = 3.0, rounds: int = 4) -> list[tuple[int, int]]:
    """Splitters that cut rows (h, i, w) into about ``ranges`` ranges of near equal weight.

    At most ``ranges * per_range`` keys are expected in the sample, by whatever the input's size;
    in later rounds only overfull ranges are sampled, and their splitters added.
    """
    total = rows.agg(F.sum("w")).first()[0] or 0
    if not total or ranges < 2:
        return []
    ideal = float(total) / ranges
    chance = F.pmod(F.xxhash64(F.lit(seed), "h", "i"), F.lit(1 << 30)) / float(1 << 30)
    drawn = rows.where(chance < F.col("w") * per_range / ideal).groupBy("h", "i").agg(F.sum("w").alias("w")).collect()

    def cut(sample: list, parts: int) -> list[tuple[int, int]]:
        """Quantiles of the sample: each key stands for its own weight, or the mean gap if that is more."""
        sample = sorted(sample)
        weight = np.cumsum([max(float(w), ideal / per_range) for _, _, w in sample])
        at = np.searchsorted(weight, weight[-1] * np.arange(1, parts) / parts) if sample else []
        return sorted({sample[k][:2] for k in at if k < len(sample)})

    found = cut([tuple(r) for r in drawn], ranges)
    for turn in range(rounds if found else 0):
        stats = rows.groupBy(_range_of(found)("h", "i").alias("r")).agg(F.sum("w").alias("w"), F.min(F.struct("h", "i")).alias("a"), F.max(F.struct("h", "i")).alias("b")).collect()
        full = [r for r in stats if r.w > overfull * ideal and tuple(r.a) != tuple(r.b)]
        if not full:
            break
        again = rows.withColumn("r", _range_of(found)("h", "i")).where(F.col("r").isin([r.r for r in full]))
        chance = F.pmod(F.xxhash64(F.lit(seed + turn + 1), "h", "i"), F.lit(1 << 30)) / float(1 << 30)
        more = again.where(chance < F.col("w") * per_range / ideal).select("r", "h", "i", "w").collect()
        added = {k for r in full for k in cut([(m.h, m.i, m.w) for m in more if m.r == r.r], int(r.w / ideal) + 1)}
        if added <= set(found):
            break
        found = sorted({*found, *added})
    return found


def _exclusive(splitters: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], set[int]]:
    """Splitters that part no group of equal h, but for groups that had two or more; these get ranges of their own."""
    held: dict[int, int] = {}
    for h, _ in splitters:
        held[h] = held.get(h, 0) + 1
    large = {h for h, n in held.items() if n > 1}
    out = {(h, i if h in large else _LOW) for h, i in splitters} | {(h, _LOW) for h in large} | {(h + 1, _LOW) for h in large if h < -_LOW - 1}
    return sorted(out), large


def _placed(stats: list, splitters: list[tuple[int, int]], large: set[int], shards: int, total: int) -> tuple[list[tuple], list[float]]:
    """(range, first position, shard) of each range, and the positions where the shards of small groups end.

    A shard is fixed for ranges of a large group that fits one; the position is in bytes among the small
    groups or, if the shard is -2, among the groups larger than a shard, which fill shards from the first on.
    """
    ideal = total / shards
    room = [ideal] * shards
    groups: dict[int, list] = {}
    plan, small = [], []
    for r in stats:
        h = splitters[r.r - 1][0] if r.r else None
        if h in large:
            groups.setdefault(h, []).append(r)
        else:
            small.append(r)
    sizes = {h: sum(r.s for r in parts) for h, parts in groups.items()}
    at = 0
    for h in sorted(groups):
        if sizes[h] > ideal:
            for r in groups[h]:
                plan.append((r.r, at, -2))
                at += r.s
    for k in range(shards):
        room[k] -= min(ideal, max(0.0, at - k * ideal))
    free = [(-x, k) for k, x in enumerate(room)]
    heapq.heapify(free)
    for h in sorted((h for h in groups if sizes[h] <= ideal), key=lambda h: (-sizes[h], h)):  # the largest group to the emptiest shard
        most, k = heapq.heappop(free)
        plan += [(r.r, 0, k) for r in groups[h]]
        room[k] -= sizes[h]
        heapq.heappush(free, (most + sizes[h], k))
    at = 0
    for r in small:
        plan.append((r.r, at, -1))
        at += r.s
    # small groups fill what is left; overfull shards get none
    left = np.maximum(0.0, room)
    ends = np.cumsum(left) * (at / left.sum() if left.sum() else 0)
    return plan, ends.tolist()


def shard(docs: DataFrame, shards: int, size: Column, text: Column, doc_id: Column, ranges_per_shard: int = 64, range_bytes: int = 512 << 20, seed: int = 29) -> DataFrame:
    """docs with ``shard`` (0 to shards - 1, near equal bytes) and ``slot`` (gapless from 0 in each shard).

    Rows are cut into ranges by (hash of the text, doc_id), at least ``ranges_per_shard`` for each shard and so many
    that a range has about ``range_bytes``.  Equal texts meet in one shard; only a group larger than a shard is split,
    by doc_id.  Groups of more than a range are placed first, the others fill what is left, group by group.
    Null texts group with empty ones, null ids stand as the smallest long (doc_id must be a number); rows that are equal in all
    columns may swap slots, which changes nothing.  An empty input gives an empty result.
    Input columns named shard or slot are replaced; all others stay, whatever their names.
    """
    spark = docs.sparkSession
    docs = docs.drop("shard", "slot")
    others = [F.col(f"`{c}`") for c, kind in docs.dtypes if not kind.startswith(("map", "variant"))]
    names = private(docs, "size", "h", "i", "r", "x", "at", "to", "upto", "all", "n", "y", "z", "less")
    s, h, i, r, x, at, to, upto, whole, n, y, z, less = names
    docs = docs.withColumns({s: size.cast("long"), h: F.xxhash64(F.coalesce(text, F.lit(""))), i: F.coalesce(doc_id.cast("long"), F.lit(_LOW))})
    known = docs.agg(F.sum(s), F.count("*")).first()
    total, count = int(known[0] or 0), known[1]
    # a range is bounded in bytes and in rows alike: each row also weighs the mean size
    weighed = docs.select(F.col(h).alias("h"), F.col(i).alias("i"), (F.col(s) + F.lit(total // max(1, count))).alias("w"))
    ranges = min(max(shards * ranges_per_shard, total // range_bytes), max(1, count // 8))
    splitters, large = _exclusive(sampled_ranges(weighed, ranges, seed, max(4, min(16, 400_000 // ranges))))
    docs = docs.withColumn(r, _range_of(splitters)(h, i) if splitters else F.lit(0))
    stats = sorted(docs.groupBy(F.col(r).alias("r")).agg(F.sum(s).alias("s")).collect())
    plan, ends = _placed(stats, splitters, large, shards, max(1, total))
    # both tables are bounded by the number of splitters
    docs = docs.join(F.broadcast(spark.createDataFrame(plan, f"{x} int, {at} long, {to} int")), F.col(r) == F.col(x))
    order = Window.partitionBy(r).orderBy(h, i, F.xxhash64(*others) if others else F.lit(0))
    group = Window.partitionBy(r, h)
    docs = docs.withColumns({upto: F.sum(s).over(order.rowsBetween(Window.unboundedPreceding, 0)), n: F.row_number().over(order)})
    split = (F.col(to) == -2) | (F.col(whole) > total / shards)
    docs = docs.withColumns({whole: F.sum(s).over(group), y: F.max(upto).over(group)})
    middle = F.col(at) + F.when(split, F.col(upto) - F.col(s) / 2).otherwise(F.col(y) - F.col(whole) / 2)
    filled = F.size(F.filter(F.array(*[F.lit(float(e)) for e in ends]), lambda e: e <= middle))
    where = F.when(F.col(to) >= 0, F.col(to)).when(F.col(to) == -2, F.floor(middle * shards / max(1, total)).cast("int")).otherwise(filled)
    docs = docs.withColumn("shard", F.least(F.lit(shards - 1), where).cast("int")).drop(y)
    # where the slots of each part of a range begin
    parts = docs.groupBy(F.col(r).alias("r"), "shard").agg(F.min(n).alias("n"), F.count("*").alias("c")).collect()
    begin, rows = [0] * shards, []
    for p in sorted(parts, key=lambda p: (p["shard"], p.r)):
        rows.append((p.r, p["shard"], p.n - begin[p["shard"]]))
        begin[p["shard"]] += p.c
    starts = spark.createDataFrame(rows, f"{y} int, {z} int, {less} long")
    docs = docs.join(F.broadcast(starts), (F.col(r) == F.col(y)) & (F.col("shard") == F.col(z)))
    return docs.withColumn("slot", F.col(n) - F.col(less)).drop(*names)


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 8."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8


def op6(spark, sf_dir):
    """All ``documents`` in 24 shards by the law ``bytes``: only ids, sizes and hashes are moved."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", record_size(F.col("text")).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).cast("string").alias("key"))
    docs = written(docs, "shard-keys")
    out = shard(docs, 24, F.col("size"), F.col("key"), F.col("doc_id"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
