"""Language identification by prediction by partial matching over bytes.

Each language has a context tree of bytes up to ``order`` deep with frozen counts.  The
cost of a byte is its exact code length: at the deepest context known to the language
the byte has probability count / (total + distinct); otherwise the escape distinct /
(total + distinct) is paid and the next shorter context is asked, down to a uniform
choice of 256.  (Counts are frozen, so nothing is excluded and nothing adapts.)  Costs under
contexts of up to one byte are a dense table; each longer context is stored by what it changes: for a context and byte that some
language has seen, the languages that know the context, and by how much their costs differ from those at the context
one byte shorter; for any other byte after it, their escapes.  So the tree takes room for what its languages know, not for all
languages.  It is shipped to the executors.  All contexts of the training rows are kept; these are bounded
in rows and bytes, and a tree of more than ``table_bytes`` is an error, not a smaller tree.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, private, sampled, ship, table
from .kernel import slices, string_buffer


def _slot(code: np.ndarray, bits: int) -> np.ndarray:
    return (code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)


def _slots(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash table of sorted codes: the place of one code for each slot (or -1), and whether it has more."""
    bits = max(4, int(4 * len(codes)).bit_length())
    slot = _slot(codes, bits)
    table = np.full(1 << bits, -1, np.int32)
    table[slot] = np.arange(len(codes), dtype=np.int32)
    return table, np.bincount(slot, minlength=1 << bits) > 1


def _find(codes: np.ndarray, slots: tuple[np.ndarray, np.ndarray], wanted: np.ndarray) -> np.ndarray:
    """The place of each wanted code, or -1: by the hash table, and by binary search where a slot has more than one."""
    if not len(codes):
        return np.full(len(wanted), -1)
    table, crowded = slots
    slot = _slot(wanted, int(len(table)).bit_length() - 1)
    at = table[slot].astype(np.int64)
    wrong = np.flatnonzero((at < 0) | (codes[at] != wanted))
    at[wrong] = -1
    search = wrong[crowded[slot[wrong]]]
    if len(search):
        place = np.minimum(np.searchsorted(codes, wanted[search]), len(codes) - 1)
        at[search] = np.where(codes[place] == wanted[search], place, -1)
    return at


@dataclass(frozen=True)
class Level:
    """Contexts of one length: a row for each pair of context and byte that is known, then one for each context."""

    pairs: np.ndarray  #: sorted codes of context and byte
    nodes: np.ndarray  #: sorted codes of contexts
    begin: np.ndarray  #: where the entries of each row begin
    language: np.ndarray
    change: np.ndarray  #: float32, in nats
    width: int  #: languages

    def __post_init__(self) -> None:
        """Where a third of all rows' languages have entries, rows are also laid out in full (the last, of nothing, for what isn't known): quicker, and no larger than twice."""
        rows = len(self.begin) - 1
        full = None
        if rows and 3 * len(self.change) >= rows * self.width:
            full = np.zeros((rows + 1, self.width), np.float32)
            full[np.repeat(np.arange(rows), np.diff(self.begin)), self.language] = self.change
        object.__setattr__(self, "full", full)
        for name in ("pairs", "nodes"):
            object.__setattr__(self, f"slots_{name}", _slots(getattr(self, name)))

    def nbytes(self) -> int:
        return sum(x.nbytes for x in (self.pairs, self.nodes, self.begin, self.language, self.change, *self.slots_pairs, *self.slots_nodes)) + (0 if self.full is None else self.full.nbytes)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    symbol: np.ndarray  #: 256 bytes to symbol numbers; 0 is the start of a text, the last any byte never seen
    dense: np.ndarray  #: float32 [symbol before, symbol, language], in nats
    levels: list[Level]  #: contexts of two symbols, of three, ...


def _counts(symbols: np.ndarray, k: int, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (context of ``order`` symbols, next) as one number, and how often each comes."""
    code = symbols[3:].astype(np.int64)
    for j in range(1, order + 1):
        code += symbols[3 - j : len(symbols) - j].astype(np.int64) * k**j
    return np.unique(code[symbols[3:] > 0], return_counts=True)


def _costs(code: np.ndarray, times: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cost of each context and next, contexts, escape of each) of one language."""
    contexts, first = np.unique(code // k, return_index=True)
    distinct = np.diff(np.append(first, len(code)))
    total = np.add.reduceat(times, first) if len(first) else np.zeros(0, np.int64)
    return np.log(np.repeat(total + distinct, distinct) / times), contexts, np.log((total + distinct) / distinct)


def _stream(buf: np.ndarray, offsets: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Symbols of all texts, each led by three start symbols."""
    n = len(offsets) - 1
    out = np.zeros(len(buf) + 3 * n, symbol.dtype)
    shift = np.repeat(np.arange(1, n + 1) * 3, np.diff(offsets))
    out[np.arange(len(buf)) + shift] = symbol[buf]
    return out


def train(texts: dict[str, pa.Array], order: int = 3, table_bytes: int = 512 << 20) -> Model:
    """texts: per language.  Every context of up to ``order`` bytes, three at most, is kept; ValueError if the tree passes ``table_bytes``."""
    languages = sorted(texts)
    buffers = {x: string_buffer(texts[x]) for x in languages}
    seen = np.zeros(256, bool)
    for buf, _ in buffers.values():
        seen |= np.bincount(buf, minlength=256) > 0
    k = int(seen.sum()) + 2
    symbol = np.full(256, k - 1, np.uint8 if k <= 256 else np.uint16)
    symbol[seen] = np.arange(1, k - 1)
    streams = {x: _stream(*buffers[x], symbol) for x in languages}
    size = 4 * k * k * len(languages)

    def check(more: int) -> None:
        if size + more > table_bytes:
            raise ValueError(f"contexts of {len(languages)} languages need {size + more} bytes; learn from fewer bytes, or raise table_bytes")

    check(0)
    dense = np.full((k, k, len(languages)), np.log(256), np.float32)
    known = {}  # of each language, codes and costs at the contexts of the length before
    for j, x in enumerate(languages):
        for o in range(min(order, 1) + 1):
            code, times = _counts(streams[x], k, o)
            cost, contexts, escape = _costs(code, times, k)
            if o:
                dense[contexts, :, j] += escape.astype(np.float32)[:, None]
                dense[code // k, code % k, j] = cost
            elif len(code):
                dense[:, :, j] += np.float32(escape[0])
                dense[:, code, j] = cost
            known[x] = code, cost
    levels = []
    for o in range(2, order + 1):
        now = {}
        for x in languages:
            code, times = _counts(streams[x], k, o)
            cost, contexts, escape = _costs(code, times, k)
            before, earlier = known[x]
            shorter = code % k**o  # the context without its oldest byte, which the language knows with that byte after it
            now[x] = code, cost - (earlier[np.searchsorted(before, shorter)] if len(code) else 0), contexts, escape
            known[x] = code, cost
        empty = np.zeros(0, np.int64)
        pairs = np.unique(np.concatenate([v[0] for v in now.values()] or [empty]))
        nodes = np.unique(np.concatenate([v[2] for v in now.values()] or [empty]))
        owner = np.searchsorted(nodes, pairs // k)
        rows, langs, changes = [], [], []
        for j, x in enumerate(languages):
            code, change, contexts, escape = now[x]
            at = np.searchsorted(nodes, contexts)
            of_node = np.full(len(nodes), np.nan)
            of_node[at] = escape
            of_pair = of_node[owner]
            of_pair[np.searchsorted(pairs, code)] = change
            every = np.concatenate((of_pair, of_node))
            some = np.flatnonzero(~np.isnan(every))
            rows.append(some), langs.append(np.full(len(some), j, np.uint16)), changes.append(every[some].astype(np.float32))
            check(sum(len(r) for r in rows) * 6)
        row = np.concatenate(rows) if rows else empty
        sort = np.argsort(row, kind="stable")
        begin = np.concatenate((np.zeros(1, np.int64), np.cumsum(np.bincount(row, minlength=len(pairs) + len(nodes)))))
        levels.append(Level(pairs, nodes, begin, np.concatenate(langs)[sort] if langs else empty, np.concatenate(changes)[sort] if changes else empty, len(languages)))
        size += levels[-1].nbytes()
        check(0)
    return Model(languages, symbol, dense, levels)


def code_lengths(model: Model, buf: np.ndarray, offsets: np.ndarray, most: int | None = None) -> np.ndarray:
    """Nats for each document under each language, summed over its whole text."""
    k, n, width = model.dense.shape[0], len(offsets) - 1, len(model.languages)
    most = most or max(1 << 10, min(1 << 16, (1 << 20) // max(1, width)))
    out = np.zeros((n, width))
    stream = _stream(buf, offsets, model.symbol)
    begins = offsets + 3 * np.arange(n + 1)
    for a in range(0, len(stream) - 3, most):  # pieces of a fixed size, so that a long text takes no more memory
        piece = stream[a : a + most + 3].astype(np.int64)
        place = np.flatnonzero(piece[3:] > 0) + 3
        if not len(place):
            continue
        lo = np.searchsorted(begins, a + 3, "right") - 1
        hi = np.searchsorted(begins, a + len(piece), "left")
        doc = np.repeat(np.arange(hi - lo), np.diff(np.clip(begins[lo : hi + 1], a + 3, a + len(piece))))[place - 3]
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        nats = np.zeros((int(doc[-1]) + 1, width))
        costs = model.dense.reshape(k * k, width)[piece[place - 1] * k + piece[place]]
        code = piece[place] + piece[place - 1] * k
        for o, level in enumerate(model.levels, 2):
            code = code + piece[place - o] * k**o
            row = _find(level.pairs, level.slots_pairs, code)
            miss = np.flatnonzero(row < 0)
            node = _find(level.nodes, level.slots_nodes, code[miss] // k)
            row[miss] = np.where(node >= 0, len(level.pairs) + node, -1)
            if level.full is not None:
                costs += level.full[row]
                continue
            some = np.flatnonzero(row >= 0)
            begin = level.begin[row[some]]
            entries = level.begin[row[some] + 1] - begin
            each = np.repeat(begin - np.concatenate((np.zeros(1, np.int64), np.cumsum(entries)[:-1])), entries) + np.arange(entries.sum()) if len(some) else np.zeros(0, np.int64)
            key = np.repeat(doc[some] * width, entries) + level.language[each]
            nats += np.bincount(key, level.change[each], nats.size).reshape(nats.shape)
        nats[doc[first]] += np.add.reduceat(costs, first, axis=0, dtype=np.float64)
        out[lo : lo + len(nats)] += nats
    return out


def fit(docs: DataFrame, keep: str = "true", max_rows: int = 4000, max_bytes: int = 16 << 20, seed: int = 3, table_bytes: int = 512 << 20) -> Model:
    """Learn from a seeded sample of documents with a language and a text, of up to ``max_rows`` (about as many of each language) and ``max_bytes``.

    Repeated rows count once; null and empty texts and null languages teach nothing.
    An input without such rows gives a model without languages, which calls everything ``und``.
    """
    ship(docs.sparkSession)
    rows = docs.where(F.expr(keep) & F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("text") != "")).select("lang", "text", F.xxhash64(F.lit(seed), "doc_id", "lang", "text").alias("o"))
    # as many of each language as its share, but the rarest are not left out: rank by a rate that falls slowly with size
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return Model([], np.zeros(256, np.uint8), np.zeros((1, 1, 0), np.float32), [])
    each = max(1, max_rows // len(counts))
    chance = F.create_map(*[y for x, c in counts.items() for y in (F.lit(x), F.lit(min(1.0, each / c)))])
    u = F.pmod(F.xxhash64("o"), F.lit(1 << 30)) / float(1 << 30)
    found = sampled(rows.where(u <= chance[F.col("lang")]), "o", "text", 2 * max_rows, max_bytes)
    langs = found["lang"].to_numpy(zero_copy_only=False)
    return train({x: found.filter(pa.array(langs == x))["text"] for x in sorted(set(langs))}, table_bytes=table_bytes)


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The kept columns with ``lang_pred`` and ``score``: the share of the best language, at equal priors.

    Null texts and texts without a letter are ``und`` with score 0; ties go to the first language by name.
    """
    ship(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # bounded by table_bytes
    text, has_letter = private(docs, "text", "letter")
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        names = np.array([*model.languages, "und"], object)
        for batch in batches:
            letter = batch.column(has_letter).to_numpy(zero_copy_only=False).astype(bool)
            best, share = np.full(batch.num_rows, len(model.languages)), np.zeros(batch.num_rows)
            if model.languages:
                buf, offsets = string_buffer(batch.column(text))
                nats = np.concatenate([code_lengths(model, buf[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in slices(offsets)] or [np.zeros((0, len(model.languages)))])
                best = np.where(letter, nats.argmin(1), best)
                share = np.where(letter, 1 / np.exp(np.clip(nats.min(1)[:, None] - nats, -700, 0)).sum(1), 0.0)
            arrays = [*(batch.column(c) for c in keep), pa.array(names[best], pa.string()), pa.array(share)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "lang_pred", "score"])

    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.select(*keep, F.col("text").alias(text), letter.alias(has_letter)).mapInArrow(run, schema)


def op9(spark, sf_dir):
    """Languages of every whole text of ``documents``, learned outside the held-out quarter."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(fold(F.col("doc_id"), 4) != 2))
    out = predict(docs, model, ["doc_id"])
    return out.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")
