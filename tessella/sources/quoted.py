"""Quoted CSV in parallel: records whose fields hold line breaks, from files of any size cut anywhere.

The text source deals lines out by byte ranges.  What a line does to the state of the reader (outside or
inside quotes) is told by two patterns, one for each state it may begin in, in the JVM.  A first pass composes
these functions over each range, so that the driver, from one row a range, knows the state in which each begins.
The second pass then finds the starts of records by a prefix scan, range by range.  The last record of a range may go on in the ranges after it; these
rests, few and narrow, are joined to it.  Records are parsed by ``from_csv``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A quoted field up to its closing quote, a field with what follows its closing quote, and a field that is still open at the end of the line.
_QUOTED = '"[^"]*+(?:""[^"]*+)*+'
_FIELDS = f'(?:(?:{_QUOTED}"[^,]*+|(?!")[^,]*+),)*+'
_OPEN = rf"{_FIELDS}{_QUOTED}\z"
#: A line that begins outside quotes and ends inside them.
OPENS = rf"\A{_OPEN}"
#: A line that begins inside quotes and ends inside them: it holds no closing quote, or a later field opens again.
STAYS = rf'\A[^"]*+(?:""[^"]*+)*+(?:\z|"[^,]*+,{_OPEN})'
_PIECES = "file string, block long, seq long, kind int, record string"
WHOLE, BEGUN, REST, LAST_REST = range(4)


def states(opens: np.ndarray, stays: np.ndarray, start: bool) -> np.ndarray:
    """Whether each line ends inside quotes, given that the first begins in ``start``: a scan over functions of two states."""
    place = np.arange(len(opens))
    fixed = opens == stays  # ends alike however it begins
    last = np.maximum.accumulate(np.where(fixed, place, -1))
    turns = np.cumsum(opens & ~stays)  # ends the other way
    known = last >= 0
    base = np.where(known, opens[last], start)
    return base ^ ((turns - np.where(known, turns[last], 0)) % 2 == 1)


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, block, line, opens, stays): lines in the order of the file, the range of each by its first byte."""
    rows = spark.read.text(path, lineSep="\n").select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))
    quoted = F.contains("line", F.lit('"'))
    return rows.withColumns({"opens": quoted & F.col("line").rlike(OPENS), "stays": ~quoted | F.col("line").rlike(STAYS)})


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Batches cut where the range changes, with its key."""
    for b in batches:
        if not len(b):
            continue
        files, blocks = b.column("file").dictionary_encode().indices.to_numpy(), b.column("block").to_numpy()
        cuts = [0, *(np.flatnonzero((np.diff(files) != 0) | (np.diff(blocks) != 0)) + 1).tolist(), len(b)]
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            yield (b.column("file")[s].as_py(), int(blocks[s])), b.slice(s, e - s)


def _flags(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return b.column("opens").to_numpy(zero_copy_only=False), b.column("stays").to_numpy(zero_copy_only=False)


def range_functions(lines: DataFrame) -> DataFrame:
    """(file, block, opens, stays): what each range does to either state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ends = None, [False, True]

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now[0]]), pa.array([now[1]]), pa.array([ends[0]]), pa.array([ends[1]])], names=["file", "block", "opens", "stays"])

        for key, b in _runs(batches):
            if key != now:
                if now is not None:
                    yield row()
                now, ends = key, [False, True]
            ends = [bool(states(*_flags(b), x)[-1]) for x in ends]
        if now is not None:
            yield row()

    return lines.select("file", "block", "opens", "stays").mapInArrow(run, "file string, block long, opens boolean, stays boolean")


def _starts(functions: list[tuple[str, int, bool, bool]]) -> dict[tuple[str, int], bool]:
    """The state in which each range begins."""
    out, file, inside = {}, None, False
    for name, block, opens, stays in sorted(functions):
        if name != file:
            file, inside = name, False
        out[name, block] = inside
        inside = stays if inside else opens
    return out


def pieces(lines: DataFrame, starts: dict[tuple[str, int], bool]) -> DataFrame:
    """``_PIECES`` in the order of the file: whole records, a record that is only begun in its range, and the rest of one before it.

    A rest is the last one if the record ends in this range.  Ranges that aren't in ``starts`` begin outside quotes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, inside, rest, open_, seq = None, False, False, [], 0

        def batch(rows: list[tuple[int, str]]) -> pa.RecordBatch:
            nonlocal seq
            seq += len(rows)
            kinds, records = zip(*rows, strict=True) if rows else ((), ())
            return pa.RecordBatch.from_arrays([pa.array([now[0]] * len(rows), pa.string()), pa.array([now[1]] * len(rows), pa.int64()), pa.array(range(seq - len(rows), seq), pa.int64()), pa.array(kinds, pa.int32()), pa.array(records, pa.string())], names=["file", "block", "seq", "kind", "record"])

        for key, b in _runs(batches):
            if key != now:
                if open_:
                    yield batch([(REST if rest else BEGUN, "\n".join(open_))])
                now, inside, open_, seq = key, starts.get(key, False), [], 0
                rest = inside
            after = states(*_flags(b), inside)
            line = b.column("line").to_pylist()
            ends = np.flatnonzero(~after) + 1  # a record ends after each line that ends outside quotes
            rows, s = [], 0
            for e in ends.tolist():
                text = line[s] if e == s + 1 and not open_ else "\n".join([*open_, *line[s:e]])
                rows.append((LAST_REST if rest else WHOLE, text))
                rest, open_, s = False, [], e
            open_ += line[s:]
            inside = bool(after[-1])
            yield batch(rows)
        if open_:
            yield batch([(REST if rest else BEGUN, "\n".join(open_))])

    return lines.mapInArrow(run, _PIECES)


def _owners(found: list[tuple[str, int, int]], blocks: list[tuple[str, int]]) -> list[tuple[str, int, int]]:
    """(file, block, owner): the range in which the record began that a range holds a rest of."""
    kind = {(f, b): k for f, b, k in found}
    out, owner = [], None
    for f, b in sorted(blocks):
        if (f, b) in kind:
            out.append((f, b, owner))
        if kind.get((f, b)) != REST:
            owner = b
    return out


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, block, seq, record): the records of quoted CSV files, those of one line or of many, in the order of the files.

    A line feed ends a record outside quotes; a carriage return before it goes.  Blank records are left out.  A quote that is never
    closed takes all to the end of its file, as in any reader.
    """
    lines = _lines(spark, path)
    found = sorted(tuple(r) for r in range_functions(lines).collect())  # a row for each range
    starts = _starts(found)
    every = pieces(lines, starts)
    whole = every.where(F.col("kind").isin(WHOLE, BEGUN))
    if any(starts.values()):
        rests = every.where(F.col("kind").isin(REST, LAST_REST))
        marks = [tuple(r) for r in rests.select("file", "block", "kind").collect()]  # at most one for each range
        owned = F.broadcast(spark.createDataFrame(_owners(marks, list(starts)), "file string, block long, owner long"))
        joined = rests.join(owned, ["file", "block"]).groupBy("file", F.col("owner").alias("block")).agg(F.array_sort(F.collect_list(F.struct(rests.block, "record"))).alias("r"), F.sum(F.octet_length("record")).alias("n"))
        size = rests.agg(F.coalesce(F.sum(F.octet_length("record") + 300), F.lit(0))).first()[0]
        joined = joined.select("file", "block", F.array_join(F.transform("r", lambda x: x["record"]), "\n").alias("rest"))
        joined = F.broadcast(joined) if size <= 64 << 20 else joined
        whole = whole.join(joined.withColumn("kind", F.lit(BEGUN)), ["file", "block", "kind"], "left")
        whole = whole.withColumn("record", F.concat("record", F.coalesce(F.concat(F.lit("\n"), "rest"), F.lit(""))))
    text = F.regexp_replace("record", r"\r\z", "")
    return whole.select("file", "block", "seq", text.alias("record")).where("record <> ''")


def read(spark: SparkSession, path: str | list[str], names: list[str]) -> DataFrame:
    """The columns ``names``, all text and null where absent, of files that each begin with a header."""
    rows = records(spark, path)
    header = rows.where("block = 0").groupBy("file").agg(F.min("seq").alias("seq"))  # the first record that isn't blank
    first = F.broadcast(header.select("file", F.lit(0).cast("long").alias("block"), "seq"))  # a row for each file
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    parsed = rows.join(first, ["file", "block", "seq"], "left_anti").select(F.from_csv("record", schema, {"quote": '"', "escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"}).alias("r"))
    return parsed.select(*[F.col(f"r.`{n.replace('`', '``')}`") for n in names])
