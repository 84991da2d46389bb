"""Exact n-gram Jaccard join: subsets for small sets, inverted lists for large ones.

Sets are the distinct word shingles of a document; equal sets are one node.

Small sets emit a key for each of their subsets of the sizes that a link at this
similarity must share.  Large sets emit a prefix of their shingles in hash order, long
enough that linked sets share several of them; inverted lists over these prefixes say how
many other sets hold each shingle.  A set that shares too few is done.  The others index
only the rarest of the shared ones, so that passages which many documents hold don't
bring their documents together.  The size where the methods meet is chosen by their cost
on the sizes of the input.

Sets that meet under a key become candidate groups (connected components), each of which
is joined exactly: a breadth-first search over rarest-first prefixes compares a set with
the sets that aren't reached yet, so copies by the thousand cost one comparison each, not
one for each pair.  A group too large for a task is cut into blocks, which are joined alone
and then by representatives of their large components; only blocks that still differ in
component are joined in pairs, so one family of copies, however large, costs its blocks once.
Nothing is sampled or capped.

Shingles are 64-bit hashes and nodes 64-bit hashes of sets; lists compare 32 bits of a
shingle within its list partition, which can only add candidates.
"""

from __future__ import annotations

import itertools
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import components, kept, partitions, private, small, table, workspace, written
from .kernel import U64, from_planes, mix, planes, shingle_sets, slices, string_buffer

PERCENT = 80
LIGHT_MOST = 14  #: no set of more shingles is enumerated, whatever the cost


def needed(n: int) -> int:
    """Least overlap with any linked set, for a set of n."""
    return -(-PERCENT * n // 100)


def shared(n: int) -> int:
    """How many shingles of their prefixes linked sets must share; grows with the set."""
    return max(1, n // 5)


def prefix_length(n: int) -> int:
    return min(n, n - needed(n) + shared(n))


def least_shared(n: int) -> int:
    """The same for a set of n and its smallest possible partner."""
    return shared(needed(n))


def subset_sizes(n: int, most: int) -> list[int]:
    """Sizes of common subsets that a set of n shares with linked sets of n to ``most``."""
    return sorted({needed(m) for m in range(n, min(n * 100 // PERCENT, most) + 1)} & set(range(1, n + 1)))


def boundary(sizes: dict[int, int]) -> int:
    """Largest size to enumerate: subsets against prefix entries and the set itself, over the counted sizes."""

    def cost(most: int) -> int:
        light = sum(c * sum(math.comb(n, k) for k in subset_sizes(n, most)) for n, c in sizes.items() if n <= most)
        return light + sum(c * (prefix_length(n) + n) for n, c in sizes.items() if n > most or n >= needed(most + 1))

    return min(range(LIGHT_MOST + 1), key=cost)


def _signatures(one: np.ndarray) -> tuple[int, int]:
    return int(mix(one + U64(0x51ED270B)).sum(dtype=U64)), int(mix(one ^ U64(0x9E3779B97F4A7C15)).sum(dtype=U64) ^ U64(len(one)))


def shingle_table(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, blank, n, hi, node, chunk, ord, entries): one row for each document (doc_id, blank, text).

    ``entries``: the prefix in hash order, or the whole set if it is small; null where the set is empty
    or came before in the same batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = string_buffer(batch.column("text"))[1]
            a = 0
            while a < batch.num_rows:  # a chunk is some megabytes of text
                b = min(batch.num_rows, a + (1 << 16), max(a + 1, int(np.searchsorted(ends, ends[a] + (1 << 23), "right")) - 1))
                piece, a = batch.slice(a, b - a), b
                buf, offsets = string_buffer(piece.column("text"))
                n, hi, lo, entries, seen = [], [], [], [], set()
                for i, j in slices(offsets):
                    for one in shingle_sets(buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], size):
                        x, y = _signatures(one)
                        n.append(len(one)), hi.append(x), lo.append(y)
                        fresh = len(one) and (x, y) not in seen
                        seen.add((x, y))
                        entries.append((one if len(one) <= LIGHT_MOST else one[: prefix_length(len(one))]).tobytes() if fresh else None)
                k, chunk = len(n), uuid.uuid4().int & ((1 << 62) - 1)
                as_long = lambda x: pa.array(np.array(x, U64).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("blank"), pa.array(n, pa.int32()), as_long(hi), as_long(lo), pa.array([chunk] * k, pa.int64()), pa.array(range(k), pa.int32()), pa.array(entries, pa.binary())],
                    names=["doc_id", "blank", "n", "hi", "node", "chunk", "ord", "entries"],
                )

    return docs.select("doc_id", "blank", "text").mapInArrow(run, "doc_id long, blank long, n int, hi long, node long, chunk long, ord int, entries binary")


def _dealt(dest: np.ndarray, columns: dict[str, np.ndarray], extra: dict | None = None) -> pa.RecordBatch | None:
    """One row for each destination with the columns as binary, in planes."""
    if not len(dest):
        return None
    if len(dest) * max(x.itemsize for x in columns.values()) >= 1 << 31:
        raise OverflowError("a batch for one task passes 2 GiB")  # offsets of binary columns have 32 bits
    order = np.argsort(dest, kind="stable")
    dest = dest[order]
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(dest)) + 1, [len(dest)]))
    arrays = {"dest": pa.array(dest[cuts[:-1]].astype(np.int32))}
    for name, value in (extra or {}).items():
        arrays[name] = pa.array([value] * (len(cuts) - 1), pa.int64())
    for name, x in columns.items():
        x = x[order]
        arrays[name] = pa.array([planes(x[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())
    return pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))


def _gathered(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """The values of a column of planes, one after the other."""
    return np.concatenate([from_planes(x, dtype) for x in column.to_pylist()] or [np.zeros(0, dtype)])


def _batched_entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    buf, offsets = string_buffer(batch.column("entries"))
    return np.frombuffer(buf.tobytes(), U64), np.diff(offsets) // 8


def _key_ids(hashes: np.ndarray, dests: int) -> np.ndarray:
    """The list that a shingle belongs to, and 32 bits that tell it from others there."""
    return (hashes >> U64(32)) | ((hashes % U64(dests)) << U64(32))


def list_replies(sets: DataFrame, dests: int) -> DataFrame:
    """(chunk, keys, counts) for the prefix entries that other sets hold too.  A chunk sends and gets each key once, however many of its sets hold it."""

    def send(batches):
        for batch in batches:
            entries, lengths = _batched_entries(batch)
            chunk = np.repeat(batch.column("chunk").to_numpy(), lengths)
            for c in np.unique(chunk):
                keys, counts = np.unique(_key_ids(entries[chunk == c], dests), return_counts=True)
                out = _dealt((keys >> U64(32)).astype(np.int64), {"keys": keys.astype(np.uint32), "counts": counts.astype(np.uint32)}, {"chunk": int(c)})
                if out is not None:
                    yield out

    def answer(table: pa.Table) -> pa.Table:
        keys, counts = _gathered(table["keys"], np.uint32), _gathered(table["counts"], np.uint32).astype(np.int64)
        chunks, where = table["chunk"].to_numpy(), np.repeat(np.arange(table.num_rows), [len(x) // 4 for x in table["keys"].to_pylist()])
        _, which = np.unique(keys, return_inverse=True)
        total = np.bincount(which, counts)[which]
        live = np.flatnonzero(total > 1)
        out = _dealt(where[live], {"keys": keys[live].astype(U64) | (U64(table["dest"][0].as_py()) << U64(32)), "counts": np.minimum(total[live], 0xFFFFFFFF).astype(np.uint32)})
        if out is None:
            return pa.table({"chunk": pa.array([], pa.int64()), **{k: pa.array([], pa.binary()) for k in ("keys", "counts")}})
        return pa.table({"chunk": chunks[out.column("dest").to_numpy()], **{k: out.column(k) for k in ("keys", "counts")}})

    sent = sets.select("chunk", "entries").mapInArrow(send, "dest int, chunk long, keys binary, counts binary")
    return sent.groupBy("dest").applyInArrow(answer, "chunk long, keys binary, counts binary")


_LISTED = "dest int, keys binary, nodes binary, sizes binary"


def _listed(keys: np.ndarray, nodes: np.ndarray, sizes: np.ndarray, dests: int) -> list[pa.RecordBatch]:
    """What goes to the lists: of sets of equal size under a key only the least node; the others are tied to it here (dest -1: nodes to keys)."""
    if not len(keys):
        return []
    order = np.lexsort((nodes, sizes, keys))
    keys, nodes, sizes = keys[order], nodes[order], sizes[order]
    new = np.concatenate(([True], (np.diff(keys) != 0) | (np.diff(sizes) != 0)))
    out = [_dealt((mix(keys[new]) % U64(dests)).astype(np.int64), {"keys": keys[new], "nodes": nodes[new], "sizes": sizes[new].astype(np.int32)})]
    least = nodes[new][np.cumsum(new) - 1]
    tied = np.unique(np.stack((nodes, least), 1)[nodes != least], axis=0)
    if len(tied):
        out.append(_dealt(np.full(len(tied), -1), {"keys": tied[:, 1].view(U64), "nodes": tied[:, 0], "sizes": np.zeros(len(tied), np.int32)}))
    return out


def heavy_keys(sets: DataFrame, replies: DataFrame, dests: int) -> DataFrame:
    """(dest, keys, nodes, sizes): the rarest shared entries of the sets that share enough of them."""

    def choose(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({"dest": pa.array([], pa.int32()), **{k: pa.array([], pa.binary()) for k in ("keys", "nodes", "sizes")}})
        if not left.num_rows or not right.num_rows:
            return empty
        n, node = left["n"].to_numpy(), left["node"].to_numpy()
        buf, offsets = string_buffer(left["entries"])
        ids, at = _key_ids(np.frombuffer(buf.tobytes(), U64), dests), np.repeat(np.arange(len(n)), np.diff(offsets) // 8)
        known, counts = _gathered(right["keys"], U64), _gathered(right["counts"], np.uint32)
        order = np.argsort(known)
        known, counts = known[order], counts[order]
        spot = np.minimum(np.searchsorted(known, ids), len(known) - 1)
        shared_ = known[spot] == ids
        ids, at, counts = ids[shared_], at[shared_], counts[spot[shared_]]
        order = np.lexsort((ids, counts, at))
        ids, at = ids[order], at[order]
        have = np.bincount(at, minlength=len(n))
        least = np.array([least_shared(int(x)) for x in range(int(n.max()) + 1)])[n]
        rank = np.arange(len(at)) - np.concatenate(([0], np.cumsum(have)))[at]
        keep = rank < (have - least + 1)[at]
        found = _listed(ids[keep], node[at[keep]], n[at[keep]], dests)
        return pa.Table.from_batches(found) if found else empty

    return sets.select("chunk", "n", "node", "entries").groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(choose, _LISTED)


def light_keys(sets: DataFrame, most: int, dests: int) -> DataFrame:
    """(dest, keys, nodes, sizes): the fixed-size subsets of small sets."""

    def run(batches):
        for batch in batches:
            entries, lengths = _batched_entries(batch)
            keys, nodes, sizes, at = [], [], [], 0
            for length, node in zip(lengths.tolist(), batch.column("node").to_pylist(), strict=True):
                for k in subset_sizes(length, most):
                    rows = np.array(list(itertools.combinations(entries[at : at + length].tolist(), k)), U64)
                    keys.append(mix(mix(rows).sum(1, dtype=U64) + U64(k)) | U64(1 << 63))
                    nodes += [node] * len(rows)
                    sizes += [length] * len(rows)
                at += length
            if keys:
                yield from _listed(np.concatenate(keys), np.array(nodes, np.int64), np.array(sizes, np.int64), dests)

    return sets.where(F.col("n").between(1, most)).select("node", "entries").mapInArrow(run, _LISTED)


def list_edges(keys: DataFrame) -> DataFrame:
    """(a, b): in each list, sets whose sizes allow a link are tied to the least of them, not to each other."""

    def run(table: pa.Table) -> pa.Table:
        keys, nodes, sizes = _gathered(table["keys"], U64), _gathered(table["nodes"], np.int64), _gathered(table["sizes"], np.int32).astype(np.int64)
        order = np.lexsort((sizes, keys))
        keys, nodes, sizes = keys[order], nodes[order], sizes[order]
        new = np.concatenate(([True], (np.diff(keys) != 0) | (sizes[1:] * PERCENT > sizes[:-1] * 100)))
        group = np.cumsum(new) - 1
        least = np.minimum.reduceat(nodes, np.flatnonzero(new))[group]
        pairs = np.unique(np.stack((nodes, least), 1)[nodes != least], axis=0)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    def tied(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_gathered(batch.column(c), np.int64)) for c in ("nodes", "keys")], names=["a", "b"])

    return keys.where("dest >= 0").groupBy("dest").applyInArrow(run, "a long, b long").unionByName(keys.where("dest = -1").mapInArrow(tied, "a long, b long"))


def joined(sets: list[np.ndarray], known: np.ndarray | None = None) -> np.ndarray:
    """For sorted sets, the number of the first set that each one reaches by links, exactly; sets of equal ``known`` class are taken as linked."""
    m = len(sets)
    n = np.array([len(s) for s in sets], np.int64)
    begin = np.concatenate(([0], np.cumsum(n)))
    entries, inverse = np.unique(np.concatenate(sets), return_inverse=True)
    counts = np.bincount(inverse)
    owner = np.repeat(np.arange(m), n)
    order = np.lexsort((inverse, counts[inverse], owner))
    rank = np.arange(len(order)) - begin[owner[order]]
    prefix = order[rank < (n - -(-PERCENT * n // 100) + 1)[owner[order]]]
    prefix = prefix[counts[inverse[prefix]] > 1]
    del entries
    of, token = owner[prefix], inverse[prefix]
    first = np.searchsorted(of, np.arange(m + 1))
    root, indexed, left = np.full(m, -1), 0, m
    known = np.arange(m) if known is None else np.unique(known, return_inverse=True)[1]
    by_class = np.argsort(known, kind="stable")
    class_at = np.concatenate(([0], np.cumsum(np.bincount(known))))

    def reach(found: np.ndarray) -> list[int]:
        """found and what is in their classes: new members of the component, to be asked for links of their own."""
        nonlocal left
        more = np.concatenate([by_class[class_at[k] : class_at[k + 1]] for k in np.unique(known[found])])
        more = more[root[more] < 0]
        root[more] = s
        left -= len(more)
        return more.tolist()

    for s in range(m):
        if root[s] >= 0:
            continue
        queue = reach(np.array([s]))
        while queue:
            i = queue.pop()
            if not indexed or left < indexed / 2:  # the lists hold the sets not reached yet, and are made anew when half have gone
                live = root[of] < 0
                by = np.argsort(token[live], kind="stable")
                list_token, list_owner = token[live][by], of[live][by]
                indexed = max(1, left)
            mine = token[first[i] : first[i + 1]]
            a, b = np.searchsorted(list_token, mine, "left"), np.searchsorted(list_token, mine, "right")
            if not (b > a).any():
                continue
            near = np.unique(np.concatenate([list_owner[x:y] for x, y in zip(a, b, strict=True) if y > x]))
            near = near[(root[near] < 0) & (n[near] * 100 >= n[i] * PERCENT) & (n[near] * PERCENT <= n[i] * 100)]
            for part in np.array_split(near, max(1, int(n[near].sum()) >> 22)):
                if not len(part):
                    continue
                both = np.concatenate([inverse[begin[j] : begin[j + 1]] for j in part])
                mark = np.zeros(len(counts), bool) if len(both) > len(counts) else None
                me = inverse[begin[i] : begin[i + 1]]
                if mark is not None:
                    mark[me] = True
                    hit = mark[both]
                else:
                    hit = me[np.minimum(np.searchsorted(me, both), len(me) - 1)] == both
                common = np.add.reduceat(hit.astype(np.int64), np.concatenate(([0], np.cumsum(n[part])[:-1])))
                linked = part[100 * common >= PERCENT * (n[i] + n[part] - common)]
                linked = linked[root[linked] < 0]
                if len(linked):
                    queue += reach(linked)
    return root


def _search(key: str | None = None):
    """joined() for a group of (node, entries), with the column ``key`` of known classes if there is one: rows (a, b, n) of node, class and size."""

    def run(table: pa.Table) -> pa.Table:
        node, where = np.unique(table["node"].to_numpy(), return_index=True)
        values = table["entries"].take(pa.array(where)).to_pylist()
        root = joined([np.frombuffer(x, U64) for x in values], table[key].to_numpy()[where] if key else None)
        return pa.table({"a": node, "b": node[root], "n": np.array([len(x) // 8 for x in values], np.int64)})

    return run


_FOUND = "a long, b long, n long"


def _links_of_large(sets: DataFrame, block: int) -> DataFrame:
    """(a, b) that connect all linked sets (root, node, blocks, entries) of groups too large for a task."""
    parts = sets.withColumn("part", F.pmod(F.xxhash64("node"), F.col("blocks")))
    alone = written(parts.select("root", "part", "node", "entries").groupBy("root", "part").applyInArrow(_search(), _FOUND), "jaccard-alone")
    who = sets.select(F.col("node").alias("x"), "root")
    # at most 1024 components of a group are large; two sets speak for each
    whole = alone.join(who, F.col("a") == F.col("x")).groupBy("root", "b").agg(F.sum("n").alias("n"), F.array_distinct(F.array(F.min("a"), F.max("a"))).alias("reps"))
    total = whole.groupBy(F.col("root").alias("r")).agg((F.sum("n") / 1024).alias("least"))
    reps = whole.join(total, F.col("root") == F.col("r")).where((F.col("n") > F.col("least")) & (F.col("n") >= block // 64)).select(F.explode("reps").alias("x"))
    spoken = written(sets.join(reps, F.col("node") == F.col("x")).select("root", "node", "entries").groupBy("root").applyInArrow(_search(), _FOUND), "jaccard-reps")
    known = alone.select("a", "b").unionByName(spoken.select("a", "b"))
    state = components(known, "jaccard-known").select(F.col("node").alias("x"), F.col("root").alias("c"))
    state = sets.join(state, F.col("node") == F.col("x"), "left").select("root", "node", "entries", F.coalesce("c", "node").alias("c"), (F.octet_length("entries") / 8).cast("long").alias("n"))
    state = written(state, "jaccard-state")
    # a large component has blocks of its own, which needn't meet each other; all other sets share blocks
    sizes = state.groupBy("root", "c").agg(F.sum("n").alias("n"))
    sizes = sizes.withColumn("own", F.when(F.col("n") >= block / 2, F.col("c")))
    sizes = sizes.groupBy("root", "own").agg(F.ceil(F.sum("n") / block).cast("int").alias("of"))
    pure = sizes.where("own is not null").select(F.col("root").alias("r"), F.col("own").alias("o"), "of")
    mixed = sizes.where("own is null").select(F.col("root").alias("r2"), F.col("of").alias("of2"))
    placed = state.join(pure, (F.col("root") == F.col("r")) & (F.col("c") == F.col("o")), "left").join(mixed, F.col("root") == F.col("r2"), "left")
    placed = written(placed.select("root", "node", "entries", "c", F.col("o").alias("own"), F.pmod(F.xxhash64("node"), F.coalesce("of", "of2")).cast("int").alias("part")), "jaccard-placed")
    blocks = placed.select("root", "own", "part").distinct()
    blocks = written(blocks.withColumn("k", F.row_number().over(Window.partitionBy("root").orderBy("own", "part"))), "jaccard-blocks")  # a row for each block
    left, right = (blocks.select(F.col("root").alias(f"r{s}"), F.col("own").alias(f"o{s}"), F.col("k").alias(s)) for s in ("i", "j"))
    pairs = left.join(right, F.col("ri") == F.col("rj")).where("(i < j and not (oi <=> oj and oi is not null)) or (i = j and oi is null)").select(F.col("ri").alias("r"), "i", "j")
    to = pairs.select("r", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("at"))
    sent = placed.join(blocks.select(F.col("root").alias("r3"), F.col("own").alias("o3"), F.col("part").alias("p3"), "k"), (F.col("root") == F.col("r3")) & F.col("own").eqNullSafe(F.col("o3")) & (F.col("part") == F.col("p3")))
    sent = sent.join(to, (F.col("root") == F.col("r")) & (F.col("k") == F.col("at"))).select("root", "i", "j", "node", "entries", "c")
    return known.unionByName(sent.groupBy("root", "i", "j").applyInArrow(_search("c"), _FOUND).select("a", "b"))


def jaccard_components(docs: DataFrame, size: int = 5, block: int = 1_000_000) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row (doc_id, text).

    A null or empty text has no shingles and is its own component; equal sets are linked; rows
    that share a doc_id with different texts are kept apart as sets, and each takes the smallest
    doc_id of its own component.  Rows without a doc_id link and tie others together like any row; a
    component's id is null only if none of its rows has one.  doc_id must be a number; other columns are ignored.
    An empty table gives an empty result.  ``block``: shingles that one task holds at most, but for a single set.
    """
    with workspace(docs.sparkSession):
        labelled, ids = _labelled(docs, size, block)
        kept(labelled), kept(ids)
    out = labelled.join(ids, F.col("root") == F.col("r"), "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def _labelled(docs: DataFrame, size: int, block: int) -> tuple[DataFrame, DataFrame]:
    """Written tables (doc_id, n, root) of all rows and (r, least) of the roots."""
    spark = docs.sparkSession
    # rows without an id are found again by the hash of their text
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("blank", F.when(F.col("doc_id").isNull(), F.xxhash64("text")))
    rows = written(shingle_table(docs, size), "shingle-sets")
    sets = rows.where("entries is not null")
    sizes = {r[0]: r[1] for r in sets.where(F.col("n") <= LIGHT_MOST * 2).groupBy("n").count().collect()}
    most = boundary(sizes)
    heavy = sets.where((F.col("n") > most) | (F.col("n") >= needed(most + 1)))
    total = heavy.agg(F.sum(F.octet_length("entries"))).first()[0] or 0
    dests = int(max(4 * partitions(spark), total // 8 // 250_000))
    # small sets keep all their entries in the table; as heavy ones they send their prefix
    cut = F.expr("substring(entries, 1, 8 * least(n, n - cast(ceil(n * 80 / 100) as int) + greatest(1, n div 5)))")
    heavy = heavy.withColumn("entries", F.when(F.col("n") <= LIGHT_MOST, cut).otherwise(F.col("entries")))
    keys = heavy_keys(heavy, list_replies(heavy, dests), dests).unionByName(light_keys(sets, most, dests))
    keys = written(keys, "jaccard-keys")  # read twice: lists, and what is tied before
    candidates = components(list_edges(keys), "jaccard-groups")
    # one document for each candidate set brings its text, one with an id if there is any
    chosen = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("blank").alias("blank"), F.max("n").alias("n"))
    chosen = written(chosen.join(candidates.withColumnRenamed("node", "x"), F.col("node") == F.col("x")).drop("x"), "jaccard-chosen")
    blocks = chosen.groupBy("root").agg(F.ceil(F.sum("n") / block).cast("int").alias("blocks"))
    blocks = written(blocks.select(F.col("root").alias("r"), "blocks"), "jaccard-blocks")
    chosen = chosen.join(blocks, F.col("root") == F.col("r")).drop("r")
    large = blocks.where("blocks > 1").limit(1).count() > 0

    def rebuild(batches):
        for batch in batches:
            buf, offsets = string_buffer(batch.column("text"))
            want, found = batch.column("node").to_numpy(), []
            keep = []
            for a, b in slices(offsets):
                for i, one in enumerate(shingle_sets(buf[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], size), a):
                    if np.array(_signatures(one)[1], U64).view(np.int64) == want[i]:
                        keep.append(i)
                        found.append(one.tobytes())
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("root").take(at), batch.column("node").take(at), batch.column("blocks").take(at), pa.array(found, pa.binary())], names=["root", "node", "blocks", "entries"])

    # few documents are candidates: their ids go to the texts while they are proved to be small
    named = small(written(chosen.where("doc_id is not null").select(F.col("doc_id").alias("d"), "node", "root", "blocks"), "jaccard-named"), 128)
    texts = docs.where("doc_id is not null").join(named, F.col("doc_id") == F.col("d")).select("text", "node", "root", "blocks")
    nameless = chosen.where("doc_id is null").drop("doc_id").withColumnRenamed("blank", "d")
    if nameless.limit(1).count():
        texts = texts.unionByName(docs.where("doc_id is null").join(nameless, F.col("blank") == F.col("d")).select("text", "node", "root", "blocks").distinct())
    whole = texts.mapInArrow(rebuild, "root long, node long, blocks int, entries binary")
    if large:
        whole = written(whole, "jaccard-sets")
    small_groups = whole.where("blocks = 1").select("root", "node", "entries").groupBy("root").applyInArrow(_search(), _FOUND).select("a", "b")
    if large:
        roots = components(written(small_groups.unionByName(_links_of_large(whole.where("blocks > 1"), block)), "jaccard-links"), "jaccard-cc")
    else:
        roots = written(small_groups, "jaccard-links").select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = written(roots.select(F.col("node").alias("x"), "root"), "jaccard-roots")
    # tables on both sides of the joins, so that adaptive execution can split hot sets and components
    labelled = written(rows.select("doc_id", "n", "node").join(roots, F.col("node") == F.col("x"), "left").select("doc_id", "n", F.when(F.col("n") > 0, F.coalesce("root", "node")).alias("root")), "jaccard-labelled")
    ids = written(labelled.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("least")).withColumnRenamed("root", "r"), "jaccard-ids")
    return labelled, ids


def distinct_documents(docs: DataFrame, size: int = 5) -> DataFrame:
    """The rows of docs, all columns as they are, that are the first (smallest doc_id) of their component.

    Of rows that agree in doc_id and text one stays.  Rows without a doc_id can't be told apart and stay.
    """
    (name,) = private(docs, "kept")
    with workspace(docs.sparkSession):
        ids = jaccard_components(docs, size).where(F.col("doc_id") == F.col("component_id")).groupBy("doc_id").agg(F.count("*").alias("rows"))
        ids = kept(written(ids.withColumnRenamed("doc_id", name), "jaccard-kept"))
    named = docs.where("doc_id is not null")
    out = named.join(small(ids.where("rows = 1").select(name), 64), F.col("doc_id") == F.col(name), "left_semi")
    if (many := ids.where("rows > 1")).limit(1).count():
        out = out.unionByName(named.join(many, F.col("doc_id") == F.col(name), "left_semi").dropDuplicates(["doc_id", "text"]))
    return out.unionByName(docs.where("doc_id is null"))


def op8(spark, sf_dir):
    """Components of whole ``documents`` at 80 % of distinct five-word shingles."""
    return jaccard_components(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), link AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)
), reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(least(d.doc_id, least.b), d.doc_id) AS component_id
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN least ON d.doc_id = least.a
"""
