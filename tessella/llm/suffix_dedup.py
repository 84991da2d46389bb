"""Removal of byte strings that already start in an earlier document, by a bounded BWT search.

A string of ``length`` bytes is represented by the least gram inside it (its minimiser), which
equal strings place alike.  Routing by minimiser brings all starts of a string to one task,
wherever they are in the corpus:

1. each document sends two keys for each minimiser, the gram with half of what surrounds it on
   the left and on the right: equal strings agree on one of them.  Lists answer with the keys
   that another document holds too; copies of a key in one batch are sent once;
2. only around these, documents send contexts: where those strings of a minimiser are that a
   shared key covers, with a hash of their bytes.  Where all contexts of a minimiser are equal,
   the least document is known.  Of the others, one document for each sends the bytes;
3. a task builds the suffix array and the Burrows-Wheeler transform of its distinct
   contexts and splits suffix intervals by backward extension, one more byte for each
   round.  The round in which a boundary appears is the length of the common prefix of
   its neighbours, so common prefixes come by increasing value, and the search stops at
   ``length``: what is still together are equal strings, and the least document of each
   interval says which starts of the others go;
4. starts are brought back to their documents, merged to spans and cut out.

Grams that a share of a sample of documents hold come last in the order of minimisers (any order
gives the same result): a string that only touches a frequent passage is routed by a gram of its
own, and those inside the passage have equal contexts.  A minimiser with more contexts than a
search takes at once is split into its strings, which are searched by the hash of their bytes.
Texts are shuffled, never collected; long documents are read in overlapping pieces, and what
repeats from period to period of a text is sent once with a count.
"""

from __future__ import annotations

import functools
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel
from .common import discard, kept, partitions, ship, table, workspace, written
from .jaccard_join import _dealt, _gathered
from .kernel import BYTE_CODE, U64, mix, planes, powers, prefix_hash, slices, span_hash, string_buffer

GRAM = 20
LAST = (1 << 63) - 1  #: where a null doc_id stands in the order
FREQUENT_BITS = 22  #: size of the table that tells frequent grams; a collision moves one more gram to the end
SEARCHED = 1 << 20  #: most bytes of a minimiser's contexts that are searched at once
BUNDLE = 1 << 18  #: bytes of contexts of several minimisers that are searched together; tables of that size stay in the cache
LIST_BYTES, PART_BYTES = 16_000_000, 64_000_000  #: of text for each list of keys and contexts, and for each part that runs are brought back to
MULTI = 1 << 15  #: marks a key that several documents of a batch hold
pieces = functools.partial(kernel.pieces, most=(1 << 18) - 1)  # tables of a piece stay in the cache


def _gram_hashes(buf: np.ndarray, prefix: np.ndarray, gram: int) -> np.ndarray:
    grams = max(0, len(buf) - gram + 1)
    return mix((prefix[gram:] - prefix[:-gram]) * powers(len(prefix))[1][:grams]) if grams else np.zeros(0, U64)


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes & U64((1 << FREQUENT_BITS) - 1)).view(np.int64)


def minimiser_runs(buf: np.ndarray, offsets: np.ndarray, length: int, frequent: np.ndarray | None = None, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Runs of starts that share a minimiser: ``of`` (document), ``first`` and ``last`` start, ``place`` and ``hash``
    of the gram, and ``left`` and ``right``, the hashes of the gram with half of the rest on that side, where a start
    of the run has that much (``has_left``, ``has_right``): those from ``place - half`` back, and the others; and the
    ``prefix`` hashes of buf."""
    window, half, n = length - gram + 1, (length - gram) // 2, len(buf) - length + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return {k: none for k in ("of", "first", "last", "place")} | {k: none.astype(U64) for k in ("hash", "left", "right")} | {k: none.astype(bool) for k in ("has_left", "has_right")} | {"prefix": prefix_hash(buf, BYTE_CODE)}
    prefix = prefix_hash(buf, BYTE_CODE)
    hashes = _gram_hashes(buf, prefix, gram)
    order = hashes >> U64(1)
    if frequent is not None:
        order |= frequent[_slot(hashes)].astype(U64) << U64(63)
    order &= ~U64(0xFFFFFFFF)
    order |= np.arange(len(hashes), dtype=U64)
    least = order
    span = 1
    while 2 * span <= window:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if window > span:
        least = np.minimum(least[: len(least) - (window - span)], least[window - span :])
    place = (least & U64(0xFFFFFFFF)).astype(np.int64)[:n]
    # starts whose string would cross into the next document
    inside = np.ones(n, bool)
    for end in offsets[1:-1]:
        inside[max(0, end - length + 1) : end] = False
    new = np.ones(n, bool)
    new[1:] = (place[1:] != place[:-1]) | ~inside[:-1]
    first = np.flatnonzero(new & inside)
    stop = np.ones(n, bool)
    stop[:-1] = new[1:] | ~inside[1:]
    last = np.flatnonzero(stop & inside)
    place = place[first]
    has_left, has_right = place - first >= half, place - last < half
    left, right = np.zeros(len(first), U64), np.zeros(len(first), U64)
    at = place[has_left]
    left[has_left] = mix(span_hash(prefix, at - half, at + gram) + U64(1))
    at = place[has_right]
    right[has_right] = mix(span_hash(prefix, at, at + gram + half) + U64(2))
    return {"of": np.searchsorted(offsets, first, "right") - 1, "first": first, "last": last, "place": place, "hash": hashes[place], "left": left, "right": right, "has_left": has_left, "has_right": has_right, "prefix": prefix}


def _sorted_with_places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys sorted, the place that each had), for keys of at most 64 - ``bits`` bits and fewer than 2 ** ``bits`` of them; ties by place."""
    packed = np.sort((keys << U64(bits)) | np.arange(len(keys), dtype=U64))  # much faster than argsort
    return packed >> U64(bits), (packed & U64((1 << bits) - 1)).astype(np.int32)


def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(order, rank, known): suffixes in order of their first ``depth`` symbols (uint8; the end is below all), by doubling
    from packed words of four, and the ranks by the first ``known`` symbols, the last step that does not pass ``depth``."""
    n = len(text)
    bits, covered = max(1, n.bit_length()), min(4, depth)
    padded = np.concatenate((text, np.zeros(covered, np.uint8))).astype(U64)
    key = np.zeros(n, U64)
    for j in range(covered):
        key = (key << U64(8)) | padded[j : n + j]
    width, known = 8 * covered, None
    while True:
        if width + bits <= 64:
            ranked, order = _sorted_with_places(key, bits)
        else:
            order = np.argsort(key, kind="stable").astype(np.int32)
            ranked = key[order]
        rank = np.empty(n, np.int32)
        rank[order] = np.cumsum(np.concatenate(([False], ranked[1:] != ranked[:-1])) if n else [], dtype=np.int32)
        if covered <= depth:
            known = rank, covered
        if covered >= depth or (n and rank[order[-1]] == n - 1):
            return order, *known
        key = rank.astype(U64) << U64(bits)
        key[: max(0, n - covered)] += rank[covered:].astype(U64) + U64(1)
        width = 2 * bits
        covered *= 2


def common_intervals(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, interval number of each of its entries): intervals share a prefix of ``length`` symbols.

    What the sort has told apart is known.  From there on only the transform is searched: round l keeps together the
    neighbours that agreed so far and whose next suffixes, one backward step away in the transform, were still together
    in round l - 1.
    """
    n = len(text)
    order, rank, known = suffix_array(text, length)
    transform = text[order - 1]  # the symbol before each suffix; the first suffix is led by the last symbol
    forward = np.argsort(transform, kind="stable").astype(np.int32)  # entry of the suffix one symbol shorter
    apart = np.ones(n, bool)
    ranked = rank[order]
    apart[1:] = ranked[1:] != ranked[:-1]
    block = np.cumsum(apart, dtype=np.int32)
    open_ = np.flatnonzero(~apart)
    here, before = forward[open_], forward[open_ - 1]
    for _ in range(length - known):
        if not len(open_):
            break
        split = block[here] != block[before]
        if split.any():
            apart[open_[split]] = True
            stay = ~split
            open_, here, before = open_[stay], here[stay], before[stay]
            block = np.cumsum(apart, dtype=np.int32)
    return order, block


def repeated_starts(contexts: np.ndarray, where: np.ndarray, length: int) -> np.ndarray:
    """Which of the strings of ``length`` bytes at ``where`` may be equal to another: all that are, by bits of their hashes."""
    prefix = prefix_hash(contexts, BYTE_CODE)
    digest = mix((prefix[where + length] - prefix[where]) * powers(len(prefix))[1][where])
    bits = max(1, len(where).bit_length())
    ranked, place = _sorted_with_places(digest >> U64(bits), bits)
    same = ranked[1:] == ranked[:-1]
    out = np.zeros(len(where), bool)
    out[place[1:][same]] = True
    out[place[:-1][same]] = True
    return out


def least_documents(contexts: np.ndarray, offsets: np.ndarray, document: np.ndarray, length: int) -> np.ndarray:
    """For each start in distinct contexts (laid out one after the other, each with its size - length + 1 starts), the least document that holds its string."""
    sizes = np.diff(offsets)
    text = np.zeros(len(contexts) + len(sizes), np.uint8)  # contexts with a separator after each
    at = np.arange(len(contexts)) + np.repeat(np.arange(len(sizes)), sizes)
    text[at] = np.minimum(contexts, 254) + 1
    order, block = common_intervals(text, length)
    starts = sizes - length + 1
    begin = offsets[:-1] + np.arange(len(sizes))
    who = np.full(len(text), -1, np.int64)
    where = np.repeat(begin, starts) + np.arange(starts.sum()) - np.repeat(np.cumsum(starts) - starts, starts)
    who[where] = np.repeat(np.arange(len(sizes)), starts)
    live = who[order] >= 0
    least = np.full(int(block[-1]) + 1, LAST, np.int64)
    np.minimum.at(least, block[live], document[who[order[live]]])
    at_place = np.empty(len(text), np.int64)
    at_place[order] = least[block]
    return at_place[where]


def frequent_grams(docs: DataFrame, rows: int, sample: int = 1000, share: float = 0.01, most: int = 1 << 18) -> np.ndarray | None:
    """A table of the grams that at least ``share`` of about ``sample`` documents (rid, text) hold, at most ``most``; only their order depends on it."""
    if not rows:
        return None
    picked = docs.where(F.pmod("rid", F.lit(1 << 30)) < F.lit(int(min(1.0, sample / rows) * (1 << 30))))

    def run(batches):
        for batch in batches:
            buf, offsets = string_buffer(batch.column("text"))
            for part, at, _, _ in pieces(buf, offsets, GRAM - 1):
                hashes = _gram_hashes(part, prefix_hash(part, BYTE_CODE), GRAM)
                for a, b in zip(at[:-1], at[1:], strict=True):
                    if b - a >= GRAM:
                        yield pa.RecordBatch.from_arrays([pa.array(np.unique(hashes[a : b - GRAM + 1]).view(np.int64))], names=["gram"])

    held = max(4, int(share * min(rows, sample)))
    found = picked.select("text").mapInArrow(run, "gram long").groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") >= held).orderBy(F.desc("n"), "gram").limit(most).select("gram").toArrow()
    table = np.zeros(1 << FREQUENT_BITS, bool)
    table[_slot(found["gram"].to_numpy().view(U64))] = True
    return table


def _packed(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array([planes(x) for x in arrays], pa.binary())


def _key_ids(hashes: np.ndarray, dests: int) -> np.ndarray:
    """The list that a key belongs to, and 32 bits that tell it from others there."""
    return (hashes >> U64(32)) | ((hashes % U64(dests)) << U64(32))


def _send(docs: DataFrame, length: int, dests: int, frequent) -> DataFrame:
    """Rows of documents (chunk, ord, rid), of the keys that they send (dest, chunk, keys, ords), and of those
    that another document of the batch holds too (dest -1)."""

    def run(batches):
        for batch in batches:
            offsets = string_buffer(batch.column("text"))[1]
            a = 0
            while a < batch.num_rows:  # a chunk is some megabytes of text
                b = min(batch.num_rows, a + MULTI, max(a + 1, int(np.searchsorted(offsets, offsets[a] + (1 << 24), "right")) - 1))
                piece, chunk = batch.slice(a, b - a), uuid.uuid4().int & ((1 << 62) - 1)
                a = b
                k, none = piece.num_rows, pa.nulls
                yield pa.RecordBatch.from_arrays([none(k, pa.int32()), pa.array([chunk] * k, pa.int64()), none(k, pa.binary()), none(k, pa.binary()), piece.column("rid"), pa.array(range(k), pa.int32())], names=["dest", "chunk", "keys", "ords", "rid", "ord"])
                ids, ords = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
                for part, at, doc, _ in pieces(*string_buffer(piece.column("text")), length - 1):
                    runs = minimiser_runs(part, at, length, frequent.value if frequent else None)
                    for side in ("left", "right"):
                        live = runs[f"has_{side}"]
                        ids.append(_key_ids(runs[side][live], dests)), ords.append(runs["of"][live] + doc)
                ids, ords = np.concatenate(ids), np.concatenate(ords)
                if not len(ids):
                    continue
                both = np.sort((ids << U64(15)) | ords.astype(U64))  # ords are less than MULTI, lists less than 2 ** 17
                both = both[np.concatenate(([True], both[1:] != both[:-1]))]
                ids, ords = both >> U64(15), (both & U64(MULTI - 1)).astype(np.int64)
                first = np.flatnonzero(np.concatenate(([True], np.diff(ids) != 0)))
                held = np.diff(np.append(first, len(ids)))
                many = np.repeat(held > 1, held)
                sent = _dealt((ids[first] >> U64(32)).astype(np.int64), {"keys": ids[first].astype(np.uint32), "ords": (ords[first] | np.where(held > 1, MULTI, 0)).astype(np.uint16)}, {"chunk": chunk})
                here = pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([chunk], pa.int64()), _packed([ids[many]]), _packed([ords[many].astype(np.uint16)])], names=["dest", "chunk", "keys", "ords"])
                for out in (sent, here):
                    m = out.num_rows
                    yield pa.RecordBatch.from_arrays([*(out.column(c) for c in ("dest", "chunk", "keys", "ords")), none(m, pa.int64()), none(m, pa.int32())], names=["dest", "chunk", "keys", "ords", "rid", "ord"])

    return docs.select("rid", "text").mapInArrow(run, "dest int, chunk long, keys binary, ords binary, rid long, ord int")


def _answers(sent: DataFrame) -> DataFrame:
    """(chunk, ords, keys): keys that documents of more than one chunk sent, to those that don't know it yet."""
    shape = {"ords": pa.binary(), "keys": pa.binary()}

    def answer(table: pa.Table) -> pa.Table:
        keys, ords = _gathered(table["keys"], np.uint32), _gathered(table["ords"], np.uint16)
        where = np.repeat(np.arange(table.num_rows), [len(x) // 4 for x in table["keys"].to_pylist()])
        order = np.argsort(keys, kind="stable")
        first = np.flatnonzero(np.concatenate(([True], np.diff(keys[order]) != 0)))
        held = np.diff(np.append(first, len(order)))
        live = order[np.repeat(held > 1, held)]
        live = live[ords[live] < MULTI]
        out = _dealt(where[live], {"ords": ords[live], "keys": keys[live].astype(U64) | (U64(table["dest"][0].as_py()) << U64(32))})
        if out is None:
            return pa.table({"chunk": pa.array([], pa.int64()), **{k: pa.array([], t) for k, t in shape.items()}})
        return pa.table({"chunk": table["chunk"].to_numpy()[out.column("dest").to_numpy()], "ords": out.column("ords"), "keys": out.column("keys")})

    return sent.select("dest", "chunk", "keys", "ords").groupBy("dest").applyInArrow(answer, "chunk long, ords binary, keys binary")


def _document_keys(rows: DataFrame, answers: DataFrame) -> DataFrame:
    """(rid, keys) of the documents that have shared keys."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        by = np.argsort(left["ord"].to_numpy())
        rid = left["rid"].to_numpy()[by]
        ords, keys = _gathered(right["ords"], np.uint16).astype(np.int64), _gathered(right["keys"], U64)
        order = np.argsort(ords, kind="stable")
        ords, keys = ords[order], keys[order]
        cuts = np.searchsorted(ords, np.arange(len(rid) + 1))
        some = np.flatnonzero(np.diff(cuts) > 0)
        return pa.table({"rid": rid[some], "keys": pa.array([keys[cuts[i] : cuts[i + 1]].tobytes() for i in some], pa.binary())})

    return rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, "rid long, keys binary")


def _contexts(texts: DataFrame, length: int, dests: int, spread: int, frequent) -> DataFrame:
    """(dest, keys, sizes, digests, ctx, rids, docs, starts, times): distinct contexts of some megabytes of texts (rid, doc, text, keys),
    and where they occur: ``times`` times in a row, each at the first start after the last of the one before."""

    def emit(found: list[dict], rid: np.ndarray, doc: np.ndarray):
        at = {k: np.concatenate([x[k] for x in found]) for k in ("of", "first", "count", "key", "digest")}
        if not len(at["of"]):
            return
        size = at["count"] + length - 1
        _, one, which = np.unique(at["digest"], return_index=True, return_inverse=True)
        # what follows itself in a document is one occurrence with a count
        new = np.ones(len(which), bool)
        new[1:] = (which[1:] != which[:-1]) | (at["of"][1:] != at["of"][:-1]) | (at["first"][1:] != at["first"][:-1] + at["count"][:-1])
        head = np.flatnonzero(new)
        times = np.diff(np.append(head, len(which)))
        dest = (mix(at["key"][one]) % U64(spread)).astype(np.int64)
        by = np.argsort(dest, kind="stable")
        number = np.empty(len(one), np.int64)  # of each context in the order of destinations
        number[by] = np.arange(len(one))
        sorted_dest = dest[by]
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(sorted_dest)) + 1, [len(by)]))
        ctx = number[which[head]]
        order = np.argsort(ctx, kind="stable")
        ctx, head, times = ctx[order], head[order], times[order]
        among = np.searchsorted(ctx, cuts)
        out = {k: [] for k in ("keys", "sizes", "digests", "ctx", "rids", "docs", "starts", "times")}
        for a, b, c, d in zip(cuts[:-1], cuts[1:], among[:-1], among[1:], strict=True):
            mine = one[by[a:b]]
            out["keys"].append((at["key"][mine] >> U64(32)).astype(np.uint32))
            out["sizes"].append(size[mine].astype(np.uint16))
            out["digests"].append(at["digest"][mine])
            who = head[c:d]
            out["ctx"].append((ctx[c:d] - a).astype(np.uint32))
            out["rids"].append(rid[at["of"][who]])
            out["docs"].append(doc[at["of"][who]])
            out["starts"].append(at["first"][who].astype(np.uint32))
            out["times"].append(times[c:d].astype(np.uint32))
        yield pa.RecordBatch.from_arrays([pa.array(sorted_dest[cuts[:-1]].astype(np.int32)), *map(_packed, out.values())], names=["dest", *out])

    def run(batches):
        for batch in batches:
            buf, offsets = string_buffer(batch.column("text"))
            key_buf, key_offsets = string_buffer(batch.column("keys"))
            known = np.frombuffer(key_buf.tobytes(), U64)
            rid, doc = batch.column("rid").to_numpy(), batch.column("doc").to_numpy()
            salt = mix(np.arange(1, batch.num_rows + 1, dtype=U64))
            held = np.diff(key_offsets) // 8
            found, filled = [], 0
            for part, at, top, shift in pieces(buf, offsets, length - 1):
                runs = minimiser_runs(part, at, length, frequent.value if frequent else None)
                mine = slice(key_offsets[top] // 8, key_offsets[top + len(at) - 1] // 8)
                shared = known[mine] ^ np.repeat(salt[top : top + len(at) - 1], held[top : top + len(at) - 1])
                of = runs["of"]
                left, right = (runs[f"has_{s}"] & np.isin(_key_ids(runs[s], dests) ^ salt[of + top], shared) for s in ("left", "right"))
                middle = runs["place"] - (length - GRAM) // 2  # the last start that the left key covers
                first, last = np.where(left, runs["first"], np.maximum(runs["first"], middle + 1)), np.where(right, runs["last"], np.minimum(runs["last"], middle))
                live = np.flatnonzero((left | right) & (first <= last))
                if not len(live):
                    continue
                of, first, last = of[live], first[live], last[live]
                digest = span_hash(runs["prefix"], first, last + length)
                found.append({"of": of + top, "first": first - at[of] + shift, "count": last - first + 1, "key": runs["hash"][live], "digest": digest})
                filled += len(live)
                if filled > 1 << 18:
                    yield from emit(found, rid, doc)
                    found, filled = [], 0
            if found:
                yield from emit(found, rid, doc)

    return texts.mapInArrow(run, "dest int, keys binary, sizes binary, digests binary, ctx binary, rids binary, docs binary, starts binary, times binary")


def _bounded(values: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of whole groups of equal sorted values, of about BUNDLE bytes each."""
    if not len(values):
        return []
    filled = np.cumsum(sizes) // min(BUNDLE, SEARCHED)
    heads = np.flatnonzero(np.concatenate(([True], np.diff(values) != 0)))
    edges = [0, *heads[1:][np.diff(filled[heads]) > 0].tolist(), len(values)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def least_of_starts(data: np.ndarray, begin: np.ndarray, keys: np.ndarray, least: np.ndarray, length: int) -> np.ndarray:
    """For each start of distinct contexts (data[begin[i]:begin[i+1]]), the least document of any context of its key that holds the string."""
    sizes = np.diff(begin)
    count = sizes - length + 1
    first = np.concatenate(([0], np.cumsum(count)))
    out = np.repeat(least, count)
    order = np.argsort(keys, kind="stable")
    _, heads, held = np.unique(keys[order], return_index=True, return_counts=True)
    volume = np.add.reduceat(sizes[order], heads) if len(heads) else np.zeros(0, np.int64)

    def cut(raw: np.ndarray, starts: np.ndarray, span: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(span)))
        return raw[np.repeat(starts - total[:-1], span) + np.arange(total[-1])]

    gathered = functools.partial(cut, data)

    def search(raw: np.ndarray, span: np.ndarray, who: np.ndarray) -> np.ndarray:
        """Of each context only what lies between starts that may be repeated is searched; other starts are their own document's."""
        n = span - length + 1
        ends = np.cumsum(n)
        heads, offsets = ends - n, np.cumsum(span) - span
        found = np.repeat(who, n)
        hit = np.flatnonzero(repeated_starts(raw, np.repeat(offsets - heads, n) + np.arange(len(found)), length))
        a, b = np.searchsorted(hit, heads), np.searchsorted(hit, ends)
        some = np.flatnonzero(a < b)
        if len(some):
            low = hit[a[some]]
            m = hit[b[some] - 1] - low + 1
            size = m + length - 1
            parts = cut(raw, offsets[some] + low - heads[some], size)
            minima = least_documents(parts, np.concatenate(([0], np.cumsum(size))), who[some], length)
            found[np.repeat(low - (np.cumsum(m) - m), m) + np.arange(len(minima))] = minima
        return found

    fits = (held > 1) & (volume <= SEARCHED)
    some = order[np.repeat(fits, held)]
    for a, b in _bounded(keys[some], sizes[some]):
        part = some[a:b]
        n = count[part]
        out[np.repeat(first[part] - (np.cumsum(n) - n), n) + np.arange(n.sum())] = search(gathered(begin[part], sizes[part]), sizes[part], least[part])
    # a key with more contexts: its strings by the hash of their bytes
    some = order[np.repeat((held > 1) & ~fits, held)]
    if len(some):
        n = count[some]
        at = np.repeat(begin[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        to = np.repeat(first[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        prefix = prefix_hash(data, BYTE_CODE)
        digest = (prefix[at + length] - prefix[at]) * powers(len(prefix))[1][at]
        by = np.argsort(digest, kind="stable")
        who = np.repeat(least[some], n)
        for a, b in _bounded(digest[by], np.full(len(by), length)):
            part = by[a:b]
            out[to[part]] = search(gathered(at[part], np.full(len(part), length)), np.full(len(part), length), who[part])
    return out


_RESOLVED = "kind int, dest int, part int, " + ", ".join(f"c{k} binary" for k in range(8))
_RUNS, _OPEN, _WANTED = range(3)  #: kinds of rows


def _grouped(kind: int, dest: int, part: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
    """Columns as rows of one kind, one for each value of part."""
    order = np.argsort(part, kind="stable")
    part = part[order]
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(part)])) if len(part) else np.zeros(1, np.int64)
    m = len(cuts) - 1
    packed = [_packed([c[order][a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]) for c in columns]
    arrays = [pa.array([kind] * m, pa.int32()), pa.array([dest] * m, pa.int32()), pa.array(part[cuts[:-1]].astype(np.int32)), *packed, *[pa.nulls(m, pa.binary())] * (8 - len(columns))]
    return pa.RecordBatch.from_arrays(arrays, names=["kind", "dest", "part", *(f"c{k}" for k in range(8))])


def _part(rids: np.ndarray, groups: int) -> np.ndarray:
    return (rids.view(U64) % U64(groups)).astype(np.int64)


def _resolve(contexts: DataFrame, length: int, groups: int) -> DataFrame:
    """What contexts say by their hashes: a minimiser whose contexts are all equal is done, and gives runs of starts (kind _RUNS).

    Of the others, where they occur is kept (_OPEN), and one document is asked for the bytes of each (_WANTED).
    """

    def run(table: pa.Table) -> pa.Table:
        dest = table["dest"][0].as_py()
        keys, sizes, digests = _gathered(table["keys"], np.uint32), _gathered(table["sizes"], np.uint16).astype(np.int64), _gathered(table["digests"], U64)
        before = np.concatenate(([0], np.cumsum([len(x) // 4 for x in table["keys"].to_pylist()])))[:-1]
        ctx = _gathered(table["ctx"], np.uint32) + np.repeat(before, [len(x) // 4 for x in table["ctx"].to_pylist()])
        rids, docs = _gathered(table["rids"], np.int64), _gathered(table["docs"], np.int64)
        starts, times = _gathered(table["starts"], np.uint32).astype(np.int64), _gathered(table["times"], np.uint32).astype(np.int64)
        _, one, which = np.unique(digests, return_index=True, return_inverse=True)
        which = which[ctx]  # the distinct context of each occurrence
        least = np.full(len(one), LAST, np.int64)
        np.minimum.at(least, which, docs)
        _, key, alike = np.unique(keys[one], return_inverse=True, return_counts=True)
        open_ = alike[key] > 1
        gone = ~open_[which] & (least[which] < docs)
        highs = (starts + (sizes[one][which] - length + 1) * times - 1)[gone]
        out = [_grouped(_RUNS, dest, _part(rids[gone], groups), [rids[gone], starts[gone].astype(np.uint32), highs.astype(np.uint32)])]
        some, number = np.flatnonzero(open_[which]), np.cumsum(open_) - 1
        if len(some):
            place = number[which[some]]
            _, asked = np.unique(place, return_index=True)
            asked = some[asked]
            state = (place.astype(np.uint32), rids[some], docs[some], starts[some].astype(np.uint32), times[some].astype(np.uint32), keys[one][open_], sizes[one][open_].astype(np.uint16), least[open_])
            packed = [_packed([x]) for x in state]
            out.append(pa.RecordBatch.from_arrays([pa.array([_OPEN], pa.int32()), pa.array([dest], pa.int32()), pa.array([dest], pa.int32()), *packed], names=out[0].schema.names))
            out.append(_grouped(_WANTED, dest, _part(rids[asked], groups), [rids[asked], np.arange(len(asked), dtype=np.uint32), starts[asked].astype(np.uint32), sizes[one][open_].astype(np.uint16)]))
        return pa.Table.from_batches(out)

    return contexts.groupBy("dest").applyInArrow(run, _RESOLVED)


def _wanted_bytes(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(dest, idx, data): the bytes that were asked for, as (dest, rids, idx, starts, sizes) in c0 to c3 of wanted."""

    def by_row(table: pa.Table) -> pa.Table:
        dest = np.repeat(table["dest"].to_numpy(), [len(x) // 8 for x in table["c0"].to_pylist()]).astype(np.int32)
        rids, idx, starts, sizes = (_gathered(table[c], kind) for c, kind in (("c0", np.int64), ("c1", np.uint32), ("c2", np.uint32), ("c3", np.uint16)))
        order = np.argsort(rids, kind="stable")
        rids, found = rids[order], [x[order] for x in (dest, idx, starts, sizes)]
        cuts = np.append(np.flatnonzero(np.concatenate(([True], np.diff(rids) != 0))), len(rids))
        return pa.table({"r": rids[cuts[:-1]], **{k: pa.array([x[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()) for k, x in zip(("dests", "idx", "starts", "sizes"), found, strict=True)}})

    def read(batches):
        for batch in batches:
            buf, offsets = string_buffer(batch.column("text"))
            asked = np.array([len(x) // 4 for x in batch.column("dests").to_pylist()])
            dest, idx, starts, sizes = (np.frombuffer(string_buffer(batch.column(c))[0].tobytes(), kind) for c, kind in (("dests", np.int32), ("idx", np.uint32), ("starts", np.uint32), ("sizes", np.uint16)))
            starts, sizes = starts.astype(np.int64) + np.repeat(offsets[:-1], asked), sizes.astype(np.int64)
            for a, b in slices(np.concatenate(([0], np.cumsum(sizes))), 1 << 22):
                order = a + np.argsort(dest[a:b], kind="stable")
                span = sizes[order]
                total = np.concatenate(([0], np.cumsum(span)))
                raw = buf[np.repeat(starts[order] - total[:-1], span) + np.arange(total[-1])]
                cuts = np.concatenate(([0], np.flatnonzero(np.diff(dest[order])) + 1, [len(order)]))
                rows = list(zip(cuts[:-1], cuts[1:], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(dest[order][cuts[:-1]]), _packed([idx[order][x:y] for x, y in rows]), _packed([raw[total[x] : total[y]] for x, y in rows])], names=["dest", "idx", "data"])

    rows = wanted.select("part", "dest", "c0", "c1", "c2", "c3").groupBy("part").applyInArrow(by_row, "r long, dests binary, idx binary, starts binary, sizes binary")
    found = docs.select("rid", "text").join(rows.hint("shuffle_hash"), F.col("rid") == F.col("r")).select("text", "dests", "idx", "starts", "sizes")
    return found.mapInArrow(read, "dest int, idx binary, data binary")


def _searched(state: DataFrame, found: DataFrame, length: int, groups: int) -> DataFrame:
    """(part, c0, c1, c2): runs of starts whose string also starts in an earlier document, for the contexts of state and their bytes."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        which, rids, docs, starts, times, keys, sizes, least = (_gathered(left[f"c{k}"], kind) for k, kind in enumerate((np.uint32, np.int64, np.int64, np.uint32, np.uint32, np.uint32, np.uint16, np.int64)))
        starts, times, span = starts.astype(np.int64), times.astype(np.int64), sizes.astype(np.int64)
        idx, data = _gathered(right["idx"], np.uint32), _gathered(right["data"], np.uint8)
        known, at = np.unique(idx, return_index=True)  # rows of a document that is there twice say the same
        if len(known) != len(span):
            raise RuntimeError("bytes of a context are missing")
        begin = np.concatenate(([0], np.cumsum(span[idx])))[at]
        total = np.concatenate(([0], np.cumsum(span)))
        minima = least_of_starts(data[np.repeat(begin - total[:-1], span) + np.arange(total[-1])], total, keys, least, length)
        count = span - length + 1
        first = np.concatenate(([0], np.cumsum(count)))
        # all starts of an occurrence go, none, or some
        lowest, highest = np.minimum.reduceat(minima, first[:-1]), np.maximum.reduceat(minima, first[:-1])
        n = count[which]
        whole = highest[which] < docs
        rid, low, high = [rids[whole]], [starts[whole]], [(starts + n * times - 1)[whole]]
        some = np.flatnonzero(~whole & (lowest[which] < docs))
        again = np.repeat(some, times[some])
        turn = np.arange(len(again)) - np.repeat(np.cumsum(times[some]) - times[some], times[some])
        n = n[again]
        ends = np.concatenate(([0], np.cumsum(n)))
        gone = minima[np.repeat(first[which[again]] - ends[:-1], n) + np.arange(ends[-1])] < np.repeat(docs[again], n)
        who = np.repeat(np.arange(len(n)), n)
        edge, stop = np.ones(len(gone), bool), np.ones(len(gone), bool)
        edge[1:] = (who[1:] != who[:-1]) | ~gone[:-1]
        stop[:-1] = (who[1:] != who[:-1]) | ~gone[1:]
        lows, highs = np.flatnonzero(edge & gone), np.flatnonzero(stop & gone)
        owner = who[lows]
        shift = starts[again[owner]] + turn[owner] * n[owner] - ends[owner]
        rid.append(rids[again[owner]]), low.append(lows + shift), high.append(highs + shift)
        rid = np.concatenate(rid)
        out = _grouped(_RUNS, 0, _part(rid, groups), [rid, np.concatenate(low).astype(np.uint32), np.concatenate(high).astype(np.uint32)])
        return pa.Table.from_batches([out]).select(["part", "c0", "c1", "c2"])

    kinds = "part int, c0 binary, c1 binary, c2 binary"
    return state.groupBy("dest").cogroup(found.groupBy("dest")).applyInArrow(run, kinds)


def _by_document(runs: DataFrame) -> DataFrame:
    """(r, runs): the runs of each document, by start; those that touch are one."""

    def run(table: pa.Table) -> pa.Table:
        rids, lows, highs = _gathered(table["c0"], np.int64), _gathered(table["c1"], np.uint32).astype(np.int64), _gathered(table["c2"], np.uint32).astype(np.int64)
        order = np.lexsort((lows, rids))
        rids, lows, highs = rids[order], lows[order], highs[order]
        new = np.ones(len(rids), bool)
        new[1:] = (np.diff(rids) != 0) | (lows[1:] > highs[:-1] + 1)  # runs of a document don't overlap but where rows agree
        head = np.flatnonzero(new)
        pairs = np.stack((lows[head], np.maximum.reduceat(highs, head) if len(head) else lows[head]), 1).astype(np.uint32)
        rids = rids[head]
        cuts = np.append(np.flatnonzero(np.concatenate(([True], np.diff(rids) != 0))), len(rids))
        return pa.table({"r": rids[cuts[:-1]], "runs": pa.array([pairs[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())})

    return runs.select("part", "c0", "c1", "c2").groupBy("part").applyInArrow(run, "r long, runs binary")


def spans(runs: bytes | None, length: int) -> np.ndarray:
    """Maximal removed spans [start, end) of sorted runs of starts."""
    if not runs:
        return np.zeros((0, 2), np.int64)
    pairs = np.frombuffer(runs, np.uint32).reshape(-1, 2).astype(np.int64)
    ends = np.maximum.accumulate(pairs[:, 1] + length)
    new = np.concatenate(([True], pairs[1:, 0] > ends[:-1]))
    first = np.flatnonzero(new)
    return np.stack((pairs[first, 0], ends[np.append(first[1:] - 1, len(ends) - 1)]), 1)


def remove_repeated(docs: DataFrame, length: int = 50) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row (doc_id, text); ``kept`` is the rest of the bytes.

    doc_id must be a number.  Null texts are empty, and shorter ones than ``length`` are left as they are.  A null doc_id
    stands after all others.  Rows that agree in doc_id remove nothing from each other; repeated rows have equal results.
    Other columns are ignored.  An empty table gives an empty result.
    """
    if length < GRAM + 2:
        raise ValueError(f"length must be at least {GRAM + 2}")
    spark = docs.sparkSession
    ship(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), text.alias("text"), F.xxhash64("doc_id", text).alias("rid"))
    known = docs.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    dests, groups = (int(max(partitions(spark), (known[0] or 0) // size)) for size in (LIST_BYTES, PART_BYTES))
    dests = min(dests, 1 << 17)
    with workspace(spark):
        grams = frequent_grams(docs, known[1])
        frequent = spark.sparkContext.broadcast(grams) if grams is not None else None  # of fixed size
        sent = written(_send(docs, length, dests, frequent), "suffix-keys")
        answers = _answers(sent.where("dest >= 0")).unionByName(sent.where("dest = -1").select("chunk", "ords", "keys"))
        keys = written(_document_keys(sent.where("dest is null").select("rid", "chunk", "ord"), answers), "suffix-shared")
        discard(sent)
        some = keys.groupBy(F.col("rid").alias("r")).agg(F.max("keys").alias("keys"))
        found = docs.select("rid", "doc", "text").join(some.hint("shuffle_hash"), F.col("rid") == F.col("r")).select("rid", "doc", "text", "keys")
        resolved = written(_resolve(_contexts(found, length, dests, dests, frequent), length, groups), "suffix-resolved")
        discard(keys)
        state = resolved.where(F.col("kind") == _OPEN)
        searched = _searched(state, _wanted_bytes(docs, resolved.where(F.col("kind") == _WANTED)), length, groups)
        searched = written(searched, "suffix-searched")
        info = kept(written(_by_document(resolved.where(F.col("kind") == _RUNS).select("part", "c0", "c1", "c2").unionByName(searched)), "suffix-runs"))

    def cut(batches):
        for batch in batches:
            buf, offsets = string_buffer(batch.column("text"))
            out = []
            for i, runs in enumerate(batch.column("runs").to_pylist()):
                mine = buf[offsets[i] : offsets[i + 1]]
                gone = spans(runs, length)
                edges = np.concatenate(([0], gone.ravel(), [len(mine)])).reshape(-1, 2)
                rest = b"".join(mine[a:b].tobytes() for a, b in edges) if len(gone) else mine.tobytes()
                out.append((len(mine), len(mine) - len(rest), len(gone), rest))
            n, r, s, rest = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(r, pa.int64()), pa.array(s, pa.int64()), pa.array(rest, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    both = docs.select("doc_id", "text", "rid").join(info.hint("shuffle_hash"), F.col("rid") == F.col("r"), "left").select("doc_id", "text", "runs")
    return both.mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


def op5(spark, sf_dir):
    """The contract's digest of remove_repeated(): whole ``documents``, strings of 50 bytes, sha256 of what is left."""
    out = remove_repeated(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP5_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), p AS (  -- pieces of 500 starts each, as substring() takes as long as its text is
  SELECT doc_id, b, least(500, n - 49 - 500 * b) AS m, substring(h, 1000 * b + 1, 1098) AS q FROM (SELECT *, unnest(range(0, (n - 50) // 500 + 1)) AS b FROM d WHERE n >= 50)
), s AS (
  SELECT doc_id, 500 * b + j AS i, substring(q, 2 * j - 1, 100) AS g FROM (SELECT doc_id, b, q, unnest(range(1, m + 1)) AS j FROM p)
), firsts AS (SELECT g, min(doc_id) AS least FROM s GROUP BY g
), gone AS (SELECT s.doc_id, s.i, lag(s.i) OVER (PARTITION BY s.doc_id ORDER BY s.i) AS b FROM s JOIN firsts ON s.g = firsts.g WHERE firsts.least < s.doc_id
), islands AS (SELECT doc_id, i, sum(CASE WHEN b IS NULL OR i > b + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM gone
), spans AS (SELECT doc_id, k, min(i) AS a, max(i) + 49 AS z FROM islands GROUP BY doc_id, k
), cut AS (
  SELECT d.doc_id, count(*) AS n_spans, sum(z - a + 1) AS n_removed, string_agg(substring(h, 2 * y + 1, 2 * (a - y - 1)), '' ORDER BY a) || substring(any_value(h), 2 * max(z) + 1) AS rest
  FROM (SELECT *, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS y FROM spans) s JOIN d ON s.doc_id = d.doc_id GROUP BY d.doc_id
)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, CAST(coalesce(cut.n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(cut.n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(cut.rest, d.h))) AS kept_sha256
FROM d LEFT JOIN cut ON d.doc_id = cut.doc_id
"""
