"""The sink of named files: exact names and contents, nothing from failed tasks, replacement by a second run."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tessella.sources import named


def contents(folder):
    return {f: open(os.path.join(folder, f), encoding="utf-8", newline="").read() for f in sorted(os.listdir(folder))}


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "doc string, page int, cleaned string, segments array<string>")


def test_documents_have_their_names(spark, tmp_path):
    rows = [("s3://a/x/Ärger 1.pdf", 2, "zwei", ["zwei"]), ("s3://a/x/Ärger 1.pdf", 0, "null – “é”. b", ["null – “é”.", "b"]), ("s3://a/x/Ärger 1.pdf", 1, "", [])]
    rows += [("/b/empty.pdf", 0, "", []), ("/b/same.pdf", 0, "one", ["one"]), ("/a/same.pdf", 0, "two", ["two"]), ("/c/same.pdf", 0, "three", ["three"])]
    rows += [(f"/many/d{i}.pdf", 0, f"text {i}", [f"text {i}"]) for i in range(300)]
    out = str(tmp_path / "out")
    os.makedirs(out)
    open(f"{out}/d7.txt", "w").write("of an earlier run")
    open(f"{out}/other.txt", "w").write("stays")
    named.write_documents(pages_of(spark, rows).repartition(5), out)
    got = contents(out)
    assert got["Ärger 1.txt"] == "null – “é”. b\nzwei\n" and got["other.txt"] == "stays" and got["d7.txt"] == "text 7\n"
    assert [json.loads(x) for x in got["Ärger 1.jsonl"].splitlines()] == [{"page": 0, "segment_index": 0, "text": "null – “é”."}, {"page": 0, "segment_index": 1, "text": "b"}, {"page": 2, "segment_index": 0, "text": "zwei"}]
    assert "“" in got["Ärger 1.jsonl"] and got["empty.txt"] == got["empty.jsonl"] == ""
    same = {f: t for f, t in got.items() if f.startswith("same") and f.endswith(".txt")}
    assert same["same.txt"] == "two\n" and sorted(same.values()) == ["one\n", "three\n", "two\n"]
    assert len(got) == 2 * 305 + 1
    named.write_documents(pages_of(spark, rows[:2]), "file:" + out, overwrite=True)
    assert sorted(contents(out)) == ["Ärger 1.jsonl", "Ärger 1.txt"]
    named.write_documents(pages_of(spark, []), out)
    assert sorted(contents(out)) == ["Ärger 1.jsonl", "Ärger 1.txt"]


def test_failures_leave_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    named.write_named(spark.createDataFrame([("a", "old")], "name string, line string"), out, [])
    rows = spark.range(400).select(F.format_string("f%03d", "id").alias("name"), F.when(F.col("id") == 399, F.raise_error("broken")).otherwise(F.lit("new")).alias("line"))
    with pytest.raises(Exception, match="broken"):
        named.write_named(rows.unionByName(spark.createDataFrame([("a", "new")], "name string, line string")), out, [])
    assert contents(out) == {"a": "old\n"}


def test_attempts_that_were_not_reported_are_dropped(tmp_path):
    """Phase by phase: what an attempt wrote counts only if its message is there; an abort takes all away."""
    writer = named.NamedFilesWriter(str(tmp_path), False, "\n")
    for folder, text in (("0-1", "lost"), ("0-2", "kept")):
        os.makedirs(tmp_path / writer.staging / folder)
        (tmp_path / writer.staging / folder / "x.txt").write_text(text)
    writer.commit([named.Attempt("0-2", 1), named.Attempt(None, 0), None])
    assert contents(tmp_path) == {"x.txt": "kept"}
    os.makedirs(tmp_path / writer.staging / "1-3")
    with pytest.raises(RuntimeError, match="missing"):
        writer.commit([named.Attempt("1-3", 2)])
    assert contents(tmp_path) == {"x.txt": "kept"}
    writer.abort([])
