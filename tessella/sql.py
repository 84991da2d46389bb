"""The document operators in SQL: table functions for lines and table runs, functions for cleaning, lines and segments.

``register(spark)`` makes them known to a session:

* ``text_lines(TABLE t [, text => 'text'])``: the other columns, ``line_no`` and ``line``, as ``operators.lines.text_lines``.
* ``table_runs(TABLE t [, keys => 'doc,page', line_no => 'line_no', line => 'line', min_cols => 3, min_block => 3])``: the
  columns of t and ``masked``, as ``operators.lines.mask_text_tables``.  It asks for the partitioning and order itself, and
  holds no more than ``min_block`` rows of a partition.  A null line is no part of a run.
* ``cleaned_text(t)``, ``page_lines(t)``, ``text_segments(t [, split, max_tokens])``: SQL functions that the optimiser
  puts in line, so that they run on the JVM; the last two are arrays, to be taken apart by ``posexplode``.

Other columns pass through whatever their names and types; a name that the result would hold twice is an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn

from tessella.functions import text as tx
from tessella.operators.lines import NOT_BLANK

#: As ``lines.COLUMN_GAP``; white space is the same 29 code points here.
GAP = re.compile(r"\t|\s{2,}")


def _value(argument: AnalyzeArgument | None, default, name: str):
    if argument is None:
        return default
    if argument.isTable or not argument.isConstantExpression or argument.value is None:
        raise ValueError(f"{name} must be a constant")
    return argument.value


def _place(schema: StructType, name: str) -> int:
    if name not in schema.names:
        raise ValueError(f"no column {name} among {schema.names}")
    return schema.names.index(name)


def _grown(schema: StructType, new: dict, without: int | None = None) -> StructType:
    """schema with more columns, and without one."""
    out = StructType([f for i, f in enumerate(schema.fields) if i != without])
    if twice := sorted(set(out.names) & set(new)):
        raise ValueError(f"columns {twice} are there already")
    for name, kind in new.items():
        out.add(name, kind)
    return out


def _table(argument: AnalyzeArgument) -> StructType:
    if not argument.isTable:
        raise ValueError("the first argument must be a table")
    return argument.dataType


@dataclass
class LinesPlan(AnalyzeResult):
    at: int = 0


@dataclass
class RunsPlan(AnalyzeResult):
    at: int = 0
    gaps: int = 2
    least: int = 3


class TextLines:
    def __init__(self, plan: LinesPlan):
        self.at = plan.at

    @staticmethod
    def analyze(rows: AnalyzeArgument, text: AnalyzeArgument | None = None) -> LinesPlan:
        schema = _table(rows)
        at = _place(schema, _value(text, "text", "text"))
        return LinesPlan(_grown(schema, {"line_no": IntegerType(), "line": StringType()}, at), at=at)

    def eval(self, row, text: str = "text") -> Iterator[tuple]:
        others = tuple(v for i, v in enumerate(row) if i != self.at)
        for number, line in enumerate((row[self.at] or "").splitlines()):
            if line and not line.isspace():
                yield (*others, number, line)


class TableRuns:
    """A run is held back until it is long enough; from then on its rows pass as they come."""

    def __init__(self, plan: RunsPlan):
        self.plan = plan
        self.held: list[tuple] = []
        self.inside = False

    @staticmethod
    def analyze(rows: AnalyzeArgument, keys: AnalyzeArgument | None = None, line_no: AnalyzeArgument | None = None, line: AnalyzeArgument | None = None, min_cols: AnalyzeArgument | None = None, min_block: AnalyzeArgument | None = None) -> RunsPlan:
        schema = _table(rows)
        names = [k.strip() for k in _value(keys, "doc,page", "keys").split(",")]
        number = _value(line_no, "line_no", "line_no")
        for name in (*names, number):
            _place(schema, name)
        least = _value(min_block, 3, "min_block")
        if least < 1:
            raise ValueError("min_block must be at least 1")
        return RunsPlan(
            _grown(schema, {"masked": BooleanType()}),
            partitionBy=[PartitioningColumn(f"`{k}`") for k in names],
            orderBy=[OrderingColumn(f"`{number}`")],
            at=_place(schema, _value(line, "line", "line")),
            gaps=_value(min_cols, 3, "min_cols") - 1,
            least=least,
        )

    def eval(self, row, keys: str = "", line_no: str = "", line: str = "", min_cols: int = 3, min_block: int = 3) -> Iterator[tuple]:
        shown = row[self.plan.at]
        if shown is not None and len(GAP.findall(shown.strip())) >= self.plan.gaps:
            self.held.append(tuple(row))
            self.inside = self.inside or len(self.held) >= self.plan.least
            if self.inside:
                yield from self._released(True)
        else:
            yield from self._released(False)
            self.inside = False
            yield (*row, False)

    def terminate(self) -> Iterator[tuple]:
        yield from self._released(False)

    def _released(self, masked: bool) -> Iterator[tuple]:
        held, self.held = self.held, []
        return ((*r, masked) for r in held)


def _raw(pattern: str) -> str:
    return f"r'{pattern}'"


def _sub(c: str, pattern: str, to: str) -> str:
    return f"regexp_replace({c}, {_raw(pattern)}, {_raw(to)})"


def _strip(c: str) -> str:
    return f"regexp_extract({c}, {_raw(tx.STRIPPED)}, 1)"


def _pieces(c: str) -> str:
    return f"filter(transform({c}, s -> {_strip('s')}), s -> s <> '')"


def _cleaned() -> str:
    c = "coalesce(t, '')"
    for old, new in tx.LIGATURES:
        c = f"replace({c}, '{old}', '{new}')"
    for pattern, to in ((tx.HYPHEN_BREAK, "$1"), (tx.WORD_EDGES, " "), (tx.DASHES, "-"), (tx.BULLETS, "-"), (tx.WS_RUN, " "), (tx.DOT_CAPITAL, r"\. $1")):
        c = _sub(c, pattern, to)
    return f"trim({c})"


def _segments() -> str:
    cut = f"transform(split(coalesce(t, ''), {_raw(tx.SENTENCE_BREAK)}, -1), s -> if(length(s) > {tx.LONG_SENTENCE}, split(s, {_raw(';' + tx.WS + '+')}, -1), array(s)))"
    paragraphs = _pieces(f"split(coalesce(t, ''), {_raw(tx.PARAGRAPH_BREAK)}, -1)")
    pieces = f"CASE split WHEN 'sentence' THEN {_pieces(f'flatten({cut})')} WHEN 'paragraph' THEN {paragraphs} ELSE raise_error(concat('split ', split, ' is neither sentence nor paragraph')) END"
    limit = f"max_tokens * {tx.CHARS_PER_TOKEN}"
    full = f"(a.buf <> '' AND length(a.buf) + length(x) >= {limit})"
    step = f"named_struct('out', if({full}, concat(a.out, array(a.buf)), a.out), 'buf', if({full} OR a.buf = '', x, concat(a.buf, ' ', x)))"
    packed = f"aggregate(split(p, {_raw(tx.CLAUSE_BREAK)}, -1), named_struct('out', cast(array() AS array<string>), 'buf', ''), (a, x) -> {step}, a -> if(a.buf <> '', concat(a.out, array(a.buf)), a.out))"
    return f"flatten(transform({pieces}, p -> if(length(p) <= {limit}, array(p), transform({packed}, q -> {_strip('q')}))))"


def register(spark: SparkSession) -> None:
    """Make the functions known to the session; a second call replaces them."""
    spark.udtf.register("text_lines", udtf(TextLines))
    spark.udtf.register("table_runs", udtf(TableRuns))
    lines = f"filter(split(coalesce(t, ''), {_raw(tx.LINE_BREAK)}, -1), s -> s RLIKE {_raw(NOT_BLANK)})"
    for head, body in (
        ("cleaned_text(t STRING) RETURNS STRING", _cleaned()),
        ("page_lines(t STRING) RETURNS ARRAY<STRING>", lines),
        ("text_segments(t STRING, split STRING DEFAULT 'sentence', max_tokens INT DEFAULT 512) RETURNS ARRAY<STRING>", _segments()),
    ):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
