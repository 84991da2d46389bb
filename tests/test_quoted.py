"""Quoted CSV cut anywhere equals the multi-line reader, whatever stands in its cells."""

import random

import numpy as np
import pytest

from tessella.sources import quoted, tabular


def make(rng, rows, end):
    def cell():
        text = "".join(rng.choice('ab ,"\n\'é') for _ in range(rng.randrange(rng.choice([3, 20, 200]))))
        return '"' + text.replace('"', '""') + '"' if rng.random() < 0.7 else "".join(c for c in text if c not in ',"\n')

    return end.join([f'A,"B{" " if end != chr(10) else end}x",C', *[",".join(cell() for _ in range(3)) for _ in range(rows)]]) + rng.choice(["", end])


@pytest.mark.parametrize(("seed", "split", "end"), [(1, 3000, "\n"), (2, 500, "\r\n"), (3, 1 << 27, "\n")])
def test_equals_the_multi_line_reader(spark, tmp_path, seed, split, end):
    rng = random.Random(seed)
    for k in range(2):
        (tmp_path / f"f{k}.csv").write_bytes(make(rng, 60, end).encode())
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        want = spark.read.csv(str(tmp_path), header=True, inferSchema=False, multiLine=True, quote='"', escape='"')
        got = quoted.read(spark, str(tmp_path), want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert split > 5000 or got.rdd.getNumPartitions() > 2
        assert tabular.read_csv(spark, str(tmp_path)).columns == want.columns
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_records_keep_the_order_of_the_file(spark, tmp_path):
    (tmp_path / "t.csv").write_text("K\n" + "\n".join(f'"{i}\n{"x" * 90}"' for i in range(300)), "utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4000)
    try:
        rows = tabular.read_csv(spark, str(tmp_path / "t.csv"))
        assert rows.rdd.getNumPartitions() > 3 and [r.K.split("\n")[0] for r in rows.collect()] == [str(i) for i in range(300)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_cell_over_many_ranges(spark, tmp_path):
    cell = "\n".join("y" * 50 for _ in range(400))
    (tmp_path / "t.csv").write_text(f'A,B\n1,"{cell}"\n2,\n3,"never closed\n4,5\n', "utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1500)
    try:
        rows = sorted(map(tuple, tabular.read_csv(spark, str(tmp_path / "t.csv")).collect()))
        assert rows[:2] == [("1", cell), ("2", "")] and rows[2][0] == "3" and rows[2][1].strip('"').startswith("never closed\n4,5")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_scan_over_two_states():
    rng = np.random.default_rng(3)
    for n in (1, 2, 50):
        opens, stays = rng.random(n) < 0.4, rng.random(n) < 0.6
        for start in (False, True):
            want, now = [], start
            for o, s in zip(opens, stays, strict=True):
                now = bool(s if now else o)
                want.append(now)
            assert quoted.states(opens, stays, start).tolist() == want
