"""Operators within one row, as a batch and as a stream, against the windows; medians, rounding, distinct and expansion at size."""

import datetime
import random
import time

import pytest
from pyspark.sql import functions as F

from tessella.operators import folds, layout, lines, phrases
from tessella.plans.pipelines import Options, filtered_lines, process_blocks
from tessella.streaming import assembly, pdfs

BITS = ["alpha  beta  gamma", "left\tmid\tright", "one line of prose.", "12.5 33.1 2,004 | 8%", "Table of Contents", "Table 4: 10 20 30", "", " \t ", "row1  x2  y3", "co-", "operation; here. (It) goes", "- 42 -"]


def texts(count, seed):
    rng = random.Random(seed)
    return ["\n".join(rng.choices(BITS, k=rng.choice([0, 1, 3, 30]))) for _ in range(count)] + [None, "", "\n\n", "\r\n".join(BITS * 40)]


@pytest.mark.parametrize("options", [Options(), Options(drop_text_tables=True), Options(drop_tables=True, drop_toc=True, drop_text_tables=True, text_table_min_block=1, text_table_min_cols=2), Options(drop_toc=True, segment_by="paragraph", max_len=1)])
def test_folds_equal_windows(spark, options):
    df = spark.createDataFrame(list(enumerate(texts(120, 2))), "doc_id long, text string")
    rows = filtered_lines(lines.text_lines(df, keys=("doc_id",)), options, keys=("doc_id",))
    want = lines.clean_pages(lines.page_text(rows, keys=("doc_id",)), ("doc_id",), options.segment_by, options.max_len)
    got = folds.clean_rows(df, folds.page_lines(F.col("text")), options, ("doc_id",))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan


@pytest.mark.parametrize(("cols", "block"), [(3, 3), (1, 2), (3, 1), (2, 5)])
def test_mask_equals_window(spark, cols, block):
    df = spark.createDataFrame(list(enumerate(texts(60, 3))), "doc_id long, text string")
    want = lines.mask_text_tables(lines.text_lines(df, keys=("doc_id",)), cols, block, keys=("doc_id",)).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("line_no", "masked"))).alias("m"))
    mask = folds.bound(folds.page_lines(F.col("text")), lambda x: folds.table_mask(x, cols, block))
    got = {r.doc_id: r.m for r in df.select("doc_id", mask.alias("m")).collect() if r.m}
    assert got == {r.doc_id: [x.masked for x in r.m] for r in want.collect()}
    with pytest.raises(ValueError):
        folds.table_mask(F.col("x"), 3, 0)


def blocks(count, seed):
    rng = random.Random(seed)
    value = lambda: rng.choice([rng.uniform(0, 600), float(rng.randrange(6)), 0.25, 0.05])
    return [(f"d{rng.randrange(9)}", rng.randrange(2), i, None if rng.random() < 0.02 else value(), value(), value(), value(), rng.choice(BITS)) for i in range(count)]


def plain_order(rows, key):
    """The rule itself: upper median of the centres, left side first, then y, x and number; blocks without a centre come first."""
    centre = lambda b: None if b[3] is None else (b[3] + b[5]) / 2
    known = sorted(c for b in rows if (c := centre(b)) is not None)
    pivot = known[len(known) // 2] if known else None
    side = lambda b: -1 if centre(b) is None else int(centre(b) > pivot)
    return [b[2] for b in sorted(rows, key=lambda b: (side(b), key(b[4]), -1e300 if b[3] is None else key(b[3]), b[2]))]


@pytest.mark.parametrize("exact", [False, True])
def test_reading_order(spark, exact):
    rows = blocks(900, 5)
    df = spark.createDataFrame(rows, "doc string, page int, block_no int, x0 double, y0 double, x1 double, y1 double, text string")
    got = {}
    for r in layout.reorder_two_columns(df, exact=exact).orderBy("reading_no").collect():
        got.setdefault((r.doc, r.page), []).append(r.block_no)
    key = (lambda v: round(v, 1)) if exact else (lambda v: int((v * 10 + 0.5) // 1))
    want = {k: plain_order([b for b in rows if b[:2] == k], key) for k in got}
    assert got == want
    if not exact:
        pages = df.groupBy("doc", "page").agg(F.collect_list(F.struct("block_no", "x0", "y0", "x1", "y1", "text")).alias("blocks"))
        folded = {(r.doc, r.page): r.n for r in pages.select("doc", "page", F.transform(folds.reading_order(F.col("blocks")), lambda b: b["block_no"]).alias("n")).collect()}
        assert folded == want
        options = Options(columns=2, drop_toc=True)
        pages = pages.withColumns({"pages": F.lit(2), "width": F.lit(1.0), "height": F.lit(1.0)})
        assert sorted(map(tuple, pdfs.clean_stream(pages, options).collect())) == sorted(map(tuple, process_blocks(df, options).collect()))


def test_a_page_of_many_blocks(spark):
    """100,000 blocks on one page: no block carries the others."""
    df = spark.range(100_000).select(F.lit("d").alias("doc"), F.lit(0).alias("page"), F.col("id").alias("block_no"), F.pmod(F.xxhash64("id"), F.lit(600)).cast("double").alias("x0"), (F.col("id") / 100).alias("y0"))
    began = time.time()
    out = layout.reorder_two_columns(df.withColumn("x1", F.col("x0") + 10)).agg(F.count("*"), F.countDistinct("reading_no"), F.max("reading_no")).first()
    assert tuple(out) == (100_000, 100_000, 99_999) and time.time() - began < 60


def test_rounding_is_exact(spark):
    """Against round(x, 1) on a million values: ties, near-ties on either side, and all magnitudes."""
    import struct

    import numpy as np

    rng = np.random.default_rng(7)
    tenths = rng.integers(-10**6, 10**6, 300_000) / 10 + 0.05
    near = np.concatenate([tenths, np.nextafter(tenths, 1e9), np.nextafter(tenths, -1e9), rng.integers(-4000, 4000, 100_000) / 8 + 0.25 * rng.integers(0, 4, 100_000)])
    wide = np.array([struct.unpack("<d", struct.pack("<Q", int(b)))[0] for b in rng.integers(0, 1 << 64, 20_000, dtype=np.uint64)])
    large = rng.uniform(1e14, 9e15, 20_000)
    values = np.concatenate([near, wide[np.isfinite(wide) & (np.abs(wide) < 1e300)], large, [0.25, 0.35, -0.25, 0.05, 0.15, -0.0, 2.675, 1e22, 4503599627370497.5]])
    assert len(values) > 1_000_000
    import pandas as pd

    got = spark.createDataFrame(pd.DataFrame({"x": values})).select("x", layout.rounded_tenth(F.col("x")).alias("r")).toPandas()
    want = np.array([round(v, 1) for v in got["x"].tolist()])
    assert (got["r"].to_numpy() == want).all()
    assert spark.sql("select double('nan') x, double('-infinity') y").select(F.isnan(layout.rounded_tenth(F.col("x"))), layout.rounded_tenth(F.col("y"))).first()[:] == (True, float("-inf"))


def plain_first(found):
    seen, out = set(), []
    for p in found:
        if p.lower() not in seen:
            seen.add(p.lower())
            out.append(p)
    return out


def test_first_of_each_phrase(spark):
    rng = random.Random(6)
    small = [[("%s" % rng.choice("aAbBcÉé")) * rng.randrange(1, 3) for _ in range(rng.randrange(9))] for _ in range(60)]
    large = ["P%d" % rng.randrange(70_000) if i % 2 else "p%d" % rng.randrange(70_000) for i in range(100_000)]
    df = spark.createDataFrame([(i, [(p, "f") for p in x]) for i, x in enumerate([*small, large])], "i int, c array<struct<p:string,field:string>>")
    began = time.time()
    got = {r.i: [s.p for s in r.c] for r in df.select("i", phrases.first_by_lower(F.col("c")).alias("c")).collect()}
    assert time.time() - began < 60 and got == {i: plain_first(x) for i, x in enumerate([*small, large])}
    cell = spark.createDataFrame([("; ".join(large),)], "K string")
    out = phrases.render(cell, ["K"], row_id=F.lit(0)).select(F.size("fields_used")).first()[0]
    assert out == len(plain_first(large))


@pytest.mark.parametrize("most", [64 << 20, 0])
def test_expansion_by_a_table(spark, most):
    """The join equals the map, whether the dictionary is broadcast or shuffled with salt; order, repeats and nulls are kept."""
    rng = random.Random(4)
    table = {f"k{i}": [f"k{i}", f"Long name-{i}", "x"][: i % 4] for i in range(60)}
    rows = [(str(i), "; ".join(rng.choice(["k1", "k2", "K2", "hot", f"k{rng.randrange(60)}", "plain", " "]) for _ in range(rng.randrange(6))), rng.choice([None, "", "k3|k59", ";"])) for i in range(300)]
    df = spark.createDataFrame(rows, "RiskID string, L1 string, K string").repartition(3)
    dictionary = spark.createDataFrame([*table.items(), ("hot", ["very hot"]), ("hot", ["a"]), (None, ["n"]), ("k2x", None)], "phrase string, expansions array<string>")
    given = df.withColumn("g", phrases.given_phrases(df, ["L1", "K"]))
    got = {r.RiskID: [tuple(s) for s in r.g] for r in phrases.expand_by_table(given, "g", dictionary, most).collect()}
    whole = table | {"hot": ["very hot"]}
    want = {r.RiskID: [(q, s.field) for s in r.g for q in [s.p, *whole.get(s.p, [])]] for r in given.collect()}
    assert got == want and len(got) == 300
    by_map, by_table = phrases.render(df, ["L1", "K"], expand=table).collect(), phrases.render(df, ["L1", "K"], expand=spark.createDataFrame(list(table.items()), "phrase string, expansions array<string>")).collect()
    assert sorted(by_map) == sorted(by_table)


def test_a_dictionary_of_a_million_entries(spark):
    dictionary = spark.range(1_000_000).select(F.concat(F.lit("k"), "id").alias("phrase"), F.array(F.concat(F.lit("name "), "id")).alias("expansions"))
    df = spark.range(1000).select(F.col("id").cast("string").alias("RiskID"), F.concat(F.lit("k7; k"), F.col("id") * 997).alias("K"))  # k7 is in every row
    out = {r.riskid: r.text_phrases for r in phrases.render(df, ["K"], expand=dictionary).collect()}
    assert len(out) == 1000 and out["3"] == "name 2991 | name 7 | k2991 | k7"


def test_a_stream_of_pages(spark, tmp_path):
    """Append mode without foreachBatch: the batch's rows, each once, though the stream is stopped and started."""
    options = Options(drop_tables=True, drop_toc=True, drop_text_tables=True)
    df = spark.createDataFrame(list(enumerate(texts(80, 9))), "doc_id long, text string")
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for half in ("doc_id % 2 = 0", "doc_id % 2 = 1"):
        df.where(half).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(df.schema).parquet(source)
        records = lines.segment_records(folds.clean_rows(stream, folds.page_lines(F.col("text")), options, ("doc_id",)), ("doc_id",))
        records.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c")).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    want = lines.segment_records(folds.clean_rows(df, folds.page_lines(F.col("text")), options, ("doc_id",)), ("doc_id",))
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == sorted(map(tuple, want.collect()))


def test_documents_are_put_together_once(spark, tmp_path):
    """Pages in four batches, the stream started anew for each: complete and incomplete documents, late pages, repeats, nulls."""
    schema, start = "doc string, page int, pages int, cleaned string, at timestamp", datetime.datetime(2024, 1, 1)
    at = lambda minutes: start + datetime.timedelta(minutes=minutes)

    def batch(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        query = assembly.assemble(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c"))
        query.trigger(availableNow=True).start().awaitTermination()
        return sorted((r.doc, r.status, r.pages, r.missing, r.text, r.page) for r in spark.read.schema(assembly.OUTPUT).parquet(str(tmp_path / "out")).collect())

    first = [("c", "complete", 1, 0, "c0", None)]
    assert batch([("a", 1, 2, "a1", at(0)), ("b", 0, 3, "b0", at(1)), ("c", 0, 1, "c0", at(1)), ("b", 0, 3, "b0", at(2))]) == first
    second = sorted([*first, ("a", "complete", 2, 0, "a0\na1", None), ("c", "late", 1, 0, "again", 0)])
    assert batch([("a", 0, 2, "a0", at(5)), ("b", 2, 3, "b2", at(6)), ("c", 0, 1, "again", at(7))]) == second
    third = sorted([*second, ("b", "incomplete", 3, 1, "b0\nb2", None)])
    assert batch([("z", 0, 2, "z", at(200))]) == third  # the watermark has passed b's patience
    assert batch([("b", 1, 3, "b1", at(195)), ("z", 1, 2, None, at(201))]) == sorted([*third, ("b", "late", 3, 0, "b1", 1), ("z", "complete", 2, 0, "z", None)])
