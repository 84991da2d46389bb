"""Mixing sources to target weights by min-cost flow over membership patterns.

Documents are aggregated by their membership pattern (the set of sources that may
claim them, or that hold the same text).  A flow network routes each pattern's token capacity to source
quotas; the k-th pass over a pattern costs k, so repetition is convex and is spread
before it is deepened.  What flows out of a pattern fixes how many whole passes all
its documents get and how many tokens of one further pass a seeded order selects.

Only totals reach the driver: one number for each cell, which is a source within a pattern that holds or may claim tokens.  There is
no bound on sources or patterns, and all that is held is linear in cells; where documents count for one source, a pattern is
an identifier of fixed size.  No document is shuffled: a search over sums finds where the seeded order of
each cell reaches its quota, and each row is held against that.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import kept, small, table, workspace, written

#: Bits of the hash that orders documents, so that sums of bounds stay in a long.
ORDER_BITS = 62


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+``; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def weighted_targets(sizes: Mapping[str | None, int], weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> dict[str | None, float]:
    """Targets by weight, sources in code point order and null last; none above ``most`` times its size.

    What a source cannot take is shared again by weight among those below their limit.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out: dict[str | None, float] = {}
    left, open_ = share * sum(sizes.values()), [s for s in order]
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > most * sizes[s]]
        if not over:
            out |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            out[s] = float(most * sizes[s])
        left -= sum(out[s] for s in over)
        open_ = [s for s in open_ if s not in out]
    return out


def _levels(most: float, single: int = 8) -> Iterator[int]:
    """Whole passes up to which each price level goes: one more each, and past ``single`` twice as many, so that a thousand copies are few levels."""
    k = 0
    while k < most:
        k = k + 1 if k < single else 2 * k
        yield k


def _augment(start: list[int], left: list[int], flow: list[int], room: list[int], arc_p: list[int], arc_s: list[int], of_p: list[list[int]], of_s: list[list[int]]) -> None:
    """Dinic's algorithm between patterns with tokens to ``start`` and sources with quota ``left``: the most that fits on top of ``flow``."""
    while True:
        level_p, level_s = [-1] * len(start), [-1] * len(left)
        starts = frontier = [p for p, n in enumerate(start) if n > 0]
        for p in frontier:
            level_p[p] = 0
        depth, found = 0, False
        while frontier and not found:
            reached = []
            for p in frontier:
                for e in of_p[p]:
                    s = arc_s[e]
                    if level_s[s] < 0 and flow[e] < room[e]:
                        level_s[s] = depth + 1
                        reached.append(s)
                        found = found or left[s] > 0
            depth, frontier = depth + 2, []
            for s in reached if not found else ():
                for e in of_s[s]:
                    if flow[e] > 0 and level_p[arc_p[e]] < 0:
                        level_p[arc_p[e]] = depth
                        frontier.append(arc_p[e])
        if not found:
            return
        next_p, next_s = [0] * len(start), [0] * len(left)
        for origin in starts:
            path: list[int] = []  # arcs to a source at even places, back from one at odd places
            at, is_pattern = origin, True
            while start[origin] > 0:
                if not is_pattern and left[at] > 0:
                    amount = min(start[origin], left[at], *(room[e] - flow[e] if i % 2 == 0 else flow[e] for i, e in enumerate(path)))
                    for i, e in enumerate(path):
                        flow[e] += amount if i % 2 == 0 else -amount
                    start[origin] -= amount
                    left[at] -= amount
                    path, at, is_pattern = [], origin, True
                    continue
                arcs, place, k = (of_p[at], next_p, next_p[at]) if is_pattern else (of_s[at], next_s, next_s[at])
                while k < len(arcs):
                    e = arcs[k]
                    if (flow[e] < room[e] and level_s[arc_s[e]] == level_p[at] + 1) if is_pattern else (flow[e] > 0 and level_p[arc_p[e]] == level_s[at] + 1):
                        break
                    k += 1
                place[at] = k
                if k < len(arcs):
                    path.append(e)
                    at, is_pattern = (arc_s[e], False) if is_pattern else (arc_p[e], True)
                elif path:  # a dead end: one step back, and on to the next arc there
                    e = path.pop()
                    at, is_pattern = (arc_s[e], False) if is_pattern else (arc_p[e], True)
                    (next_p if is_pattern else next_s)[at] += 1
                else:
                    break


def min_cost_flow(capacity: Mapping, quotas: Mapping, passes: int = 2, cells: Mapping[tuple, int] | None = None) -> dict:
    """Tokens from each pattern to each source: the most that fits, at the least repetition cost.

    The k-th pass over a pattern's capacity costs k, and no other arc has a cost.  So a shortest path costs what its first arc
    does, and successive shortest paths are maximal flows level by level: with one pass of every pattern, then with two, and so on.
    cells: the most that may go from a pattern to a source, by (pattern, source); by default patterns are tuples of sources, and
    the most is ``passes`` times the capacity, for each source and in all.
    """
    patterns, sources = list(capacity), list(quotas)
    place_p, place_s = {p: i for i, p in enumerate(patterns)}, {s: i for i, s in enumerate(sources)}
    arc_p, arc_s, room = [], [], []
    for (p, s), much in cells.items() if cells is not None else (((p, s), passes * n) for p, n in capacity.items() for s in p):
        if p in place_p and s in place_s and much > 0:
            arc_p.append(place_p[p]), arc_s.append(place_s[s]), room.append(much)
    of_p, of_s, total = [[] for _ in patterns], [[] for _ in sources], [0] * len(patterns)
    for e, (p, s) in enumerate(zip(arc_p, arc_s, strict=True)):
        of_p[p].append(e), of_s[s].append(e)
        total[p] += room[e]
    once = [max(1, capacity[p]) for p in patterns]
    if cells is None:
        total = [passes * capacity[p] for p in patterns]
    flow, left = [0] * len(room), [max(0, round(quotas[s])) for s in sources]
    used = [0] * len(patterns)
    for level in _levels(max((t / n for t, n in zip(total, once, strict=True)), default=0)):
        start = [min(t, level * n) - u for t, n, u in zip(total, once, used, strict=True)]
        given = start.copy()
        _augment(start, left, flow, room, arc_p, arc_s, of_p, of_s)
        used = [u + g - x for u, g, x in zip(used, given, start, strict=True)]
        if not any(left):
            break
    out: dict = {p: {} for p in patterns}
    for e, n in enumerate(flow):
        if n:
            out[patterns[arc_p[e]]][sources[arc_s[e]]] = n
    return out


def pattern_of(source: Column) -> Column:
    """The identifier of the pattern of one source; sets of sources have the exclusive ors of the same hashes."""
    return _identifier(F.xxhash64(source), F.xxhash64(source, F.lit(1)))


def _identifier(a: Column, b: Column) -> Column:
    return F.concat_ws(":", F.hex(a), F.hex(b))


def _beside(rows: pa.Table, spark) -> DataFrame:
    """Rows of the driver as a DataFrame, broadcast if their bytes (three times over, for what a hashed relation adds) are few."""
    df = spark.createDataFrame(rows)
    return F.broadcast(df) if 3 * rows.nbytes + 100 * rows.num_rows <= 64 << 20 else df


def mix_sources(
    docs: DataFrame,
    members: Column | None,
    size: Column,
    order: Sequence[Column],
    targets: Mapping[str | None, float] | None = None,
    passes: int = 2,
    seed: int = 17,
    cut: bool = False,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    own: Column | None = None,
    copies: Column | None = None,
    pattern: Column | None = None,
) -> DataFrame:
    """docs with ``mix_size``, ``mix_taken`` (tokens, repeats counted), ``mix_copies`` (whole copies) and ``mix_pattern``.

    members: array of the sources that may claim a document (its elements may be null); not needed with own.
    order: columns that tell documents apart; with the seed they fix the selection, so reruns agree.
    targets: tokens per source; by default ``weighted_targets`` of the sizes of documents by own source or first member.
    cut: the one document of a pattern that straddles its quota gives only the tokens still missing;
    else it is taken whole if at least half of it is wanted.
    own: the one source that a document is counted for; others of its pattern hold copies of it.
    pattern: with own, the identifier of a document's pattern (``holders``); by default that of its own source alone.
    copies: how many rows hold the same text; passes then repeat a pattern's distinct texts.
    A null or empty text has size 0 and takes nothing; a document of no source is never taken.
    Rows with equal ``order`` columns tie: where they straddle, all give the same share, or all are taken or none.
    Input columns with names beginning ``mix_`` are dropped.
    """
    spark = docs.sparkSession
    if own is None:
        columns, cell = {"mix_pattern": F.array_sort(F.array_distinct(members))}, ["mix_pattern"]
    else:
        columns, cell = {"mix_pattern": pattern_of(own) if pattern is None else pattern, "mix_own": own}, ["mix_pattern", "mix_own"]
    columns |= {"mix_size": size.cast("long"), "mix_order": F.shiftrightunsigned(F.xxhash64(F.lit(seed), *order), 64 - ORDER_BITS)}
    once = F.lit(1.0) if copies is None else 1.0 / copies
    docs = docs.drop(*[c for c in docs.columns if c.lower().startswith("mix_")]).withColumns(columns)
    keys = kept(written(docs.select(*columns, once.alias("mix_once")), "mix-keys"))  # texts are read once for this, and once for the result
    totals = keys.groupBy(*cell).agg(F.sum("mix_size").alias("s"), F.sum(F.col("mix_size") * F.col("mix_once")).alias("d")).toArrow()
    kinds = {c: totals.schema.field(c).type for c in cell}
    keyed = totals.column("mix_pattern").to_pylist()
    keyed = [tuple(p) if isinstance(p, list) else p for p in keyed]
    owns = totals.column("mix_own").to_pylist() if own is not None else [None] * len(keyed)
    held: dict[tuple, int] = {}
    distinct: dict = {}
    sizes: dict = {}
    for p, o, s, d in zip(keyed, owns, totals.column("s").to_pylist(), totals.column("d").to_pylist(), strict=True):
        if own is not None or p:  # else a document of no source
            source = o if own is not None else p[0]
            sizes[source] = sizes.get(source, 0) + (s or 0)
            if s:
                held[p, o] = s
                distinct[p] = distinct.get(p, 0) + (d or 0)
    if targets is None:
        targets = weighted_targets(sizes, weights, share, passes)
    if own is None:
        flow = min_cost_flow({p: s for (p, _), s in held.items()}, targets, passes)
        wanted = {(p, o): sum(flow[p].values()) for p, o in held}
    else:
        flow = min_cost_flow({p: round(d) for p, d in distinct.items()}, targets, passes, {c: passes * s for c, s in held.items()})
        wanted = {(p, o): flow[p].get(o, 0) for p, o in held}
    plan = {c: divmod(wanted[c], s) for c, s in held.items()}
    ends = _straddling(keys, cell, kinds, {c: rest for c, (_, rest) in plan.items() if rest})
    cells = _cells(list(plan), kinds)
    for name, values in zip(("mix_whole", "mix_at", "mix_need", "mix_tied"), zip(*((whole, *ends.get(c, (-1, 0, 1))) for c, (whole, _) in plan.items()), strict=True) if plan else ((),) * 4, strict=True):
        cells = cells.append_column(name, pa.array(values, pa.int64()))
    docs = _by_cell(docs, _beside(cells, spark), cell, "left")
    last = F.expr("cast(cast(mix_size as decimal(38,0)) * mix_need div mix_tied as long)") if cut else F.when(2 * F.col("mix_need") >= F.col("mix_tied"), F.col("mix_size")).otherwise(0)
    more = F.when(F.col("mix_order") < F.col("mix_at"), F.col("mix_size")).when(F.col("mix_order") == F.col("mix_at"), last).otherwise(0)
    docs = docs.withColumn("mix_taken", F.coalesce(F.col("mix_whole") * F.col("mix_size") + more, F.lit(0)).cast("long"))
    docs = docs.withColumn("mix_copies", F.when(F.col("mix_size") > 0, F.ceil(F.col("mix_taken") / F.col("mix_size"))).otherwise(0).cast("int"))
    return docs.drop("mix_order", "mix_own", "mix_whole", "mix_at", "mix_need", "mix_tied")


def _cells(cells: list[tuple], kinds: Mapping[str, pa.DataType]) -> pa.Table:
    """Cells (pattern, own) as columns named _mix_pattern and, if there is one, _mix_own."""
    return pa.table({f"_{c}": pa.array([list(x[k]) if isinstance(x[k], tuple) else x[k] for x in cells], kind) for k, (c, kind) in enumerate(kinds.items())})


def _by_cell(rows: DataFrame, cells: DataFrame, cell: Sequence[str], how: str) -> DataFrame:
    on = F.lit(True)
    for c in cell:
        on = on & rows[c].eqNullSafe(cells[f"_{c}"])
    return rows.join(cells, on, how).drop(*[f"_{c}" for c in cell])


def _straddling(keys: DataFrame, cell: Sequence[str], kinds: Mapping[str, pa.DataType], rest: Mapping[tuple, int], parts: int = 1024) -> dict[tuple, tuple[int, int, int]]:
    """Where the seeded order of each cell (pattern, own) reaches ``rest`` tokens: (mix_order there, tokens still missing, tokens of that order).

    A search by ``parts`` intervals of the order at a time, all cells at once: a round adds sizes up by
    cell and interval, combined map-side, and brings back the one interval of each cell that straddles.
    No row is moved while the cells are few enough to broadcast, and no window holds more than ``parts`` rows.
    """
    spark = keys.sparkSession
    out: dict[tuple, tuple[int, int, int]] = {}
    open_ = {c: (0, (1 << ORDER_BITS) - 1, much) for c, much in rest.items()}
    while open_:
        cells = list(open_)
        now = _cells(cells, kinds)
        columns = {"_k": range(len(cells)), "_a": [open_[c][0] for c in cells], "_b": [open_[c][1] for c in cells], "_width": [-(-(b - a + 1) // parts) for a, b, _ in open_.values()], "_much": [open_[c][2] for c in cells]}
        for name, values in columns.items():
            now = now.append_column(name, pa.array(values, pa.int64()))
        sums = _by_cell(keys, _beside(now, spark), cell, "inner").where("mix_order between _a and _b")
        sums = sums.groupBy("_k", "_much", F.expr("(mix_order - _a) div _width").alias("part")).agg(F.sum("mix_size").alias("s"), F.min("mix_order").alias("a"), F.max("mix_order").alias("b"))
        upto = Window.partitionBy("_k").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
        found = sums.withColumn("upto", F.sum("s").over(upto)).where("upto > _much and upto - s <= _much").collect()
        open_ = {}
        for r in found:
            missing = r._much - (r.upto - r.s)
            if r.a == r.b:
                out[cells[r._k]] = (r.a, missing, r.s)
            else:
                open_[cells[r._k]] = (r.a, r.b, missing)
    return out


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken, without the mix_ columns."""
    return mixed.where("mix_copies > 0").withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies")))).drop("mix_copy", "mix_copies", "mix_taken", "mix_size", "mix_pattern")


def holders(rows: DataFrame, text: str, source: str) -> DataFrame:
    """rows with ``mix_pattern``, the identifier of the set of sources that hold the same text (a column of hashes), and ``mix_rows``, how many rows do.

    The identifier is made of exclusive ors of two hashes of each source, so that no set is gathered and each row of the join has a
    fixed size.  Only hashes and sources are shuffled, and copies are added up by source before.  Both sides of the join are tables, so
    that adaptive execution can split the rows of a frequent text.
    """
    groups = rows.groupBy(F.col(text).alias("mix_t"), F.col(source).alias("mix_s")).agg(F.count("*").alias("mix_n")).groupBy("mix_t")
    groups = groups.agg(F.sum("mix_n").alias("mix_rows"), _identifier(F.bit_xor(F.xxhash64("mix_s")), F.bit_xor(F.xxhash64("mix_s", F.lit(1)))).alias("mix_pattern")).where("mix_rows > 1")
    groups = small(written(groups, "mix-holders"), 200)
    out = rows.join(groups, F.col(text) == F.col("mix_t"), "left").drop("mix_t")
    return out.withColumns({"mix_pattern": F.coalesce("mix_pattern", pattern_of(F.col(source))), "mix_rows": F.coalesce("mix_rows", F.lit(1))})


def op1(spark, sf_dir):
    """All ``documents``; sources overlap where they hold equal texts, and a row counts for the source that holds it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("same"))
    with workspace(spark):
        docs = written(docs, "mix-sizes")
        docs = kept(written(holders(docs, "same", "source").select("doc_id", "source", "size", F.col("mix_pattern").alias("pattern"), F.col("mix_rows").alias("copies")), "mix-overlap"))
    sizes = {r[0]: r[1] for r in docs.groupBy("source").agg(F.sum("size")).collect()}  # a number for each source
    targets = weighted_targets(sizes)
    mixed = mix_sources(docs, None, F.col("size"), [F.col("doc_id")], targets, cut=True, own=F.col("source"), pattern=F.col("pattern"), copies=F.col("copies"))
    known = pa.table({"s": pa.array(list(sizes), pa.string()), "source_size": pa.array([int(sizes[s]) for s in sizes], pa.int64()), "target": pa.array([float(targets[s]) for s in sizes], pa.float64())})
    known = _beside(known, spark)
    return mixed.join(known, mixed.source.eqNullSafe(known.s)).select("doc_id", "source", "size", "source_size", "target", F.col("mix_taken").alias("taken"))
