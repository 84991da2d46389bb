"""SQL functions against the DataFrame operators, on null, empty and odd texts, with other columns and clashing names."""

import random

import pytest
from pyspark.sql import functions as F

from tessella import sql
from tessella.functions import text as tx
from tessella.operators import folds, lines

BITS = ["alpha  beta  gamma", "left\tmid\tright", "one line of prose.", " 12.5  33.1 ", "", " \t ", "row1  x2  y3 ", "co-", "operation; here. (It) goes", "aB\x1cCd\x85e f", "ﬁne soft­ • dash — end.Next", "a\rb\r\nc", "n\u00a0b \u00ad- x"]


@pytest.fixture(scope="module")
def docs(spark):
    sql.register(spark)
    rng = random.Random(8)
    texts = ["\n".join(rng.choices(BITS, k=rng.choice([0, 1, 3, 40]))) for _ in range(80)] + [None, "", "\n", "word; " * 900, "x" * 4000, "\n".join(BITS[:2] * 500)]
    df = spark.createDataFrame([(i, t, {"a": i}, "kept") for i, t in enumerate(texts)], "doc_id long, text string, more map<string,int>, `odd name` string")
    df.createOrReplaceTempView("sql_docs")
    return df


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_text_lines(spark, docs):
    got = spark.sql("SELECT * FROM text_lines(TABLE(sql_docs))")
    assert got.columns == ["doc_id", "more", "odd name", "line_no", "line"]
    assert rows(got.select("doc_id", "line_no", "line")) == rows(lines.text_lines(docs, keys=("doc_id",)))
    assert {(r.more["a"], r["odd name"]) for r in got.where("doc_id = 7").collect()} <= {(7, "kept")}
    named = spark.sql("SELECT doc_id, line_no, line FROM text_lines(TABLE(SELECT doc_id, text AS body FROM sql_docs), text => 'body')")
    assert rows(named) == rows(got.select("doc_id", "line_no", "line"))
    assert spark.sql("SELECT * FROM text_lines(TABLE(SELECT * FROM sql_docs WHERE false))").count() == 0


@pytest.mark.parametrize(("cols", "block"), [(3, 3), (1, 2), (3, 1), (2, 5), (3, 400)])
def test_table_runs(spark, docs, cols, block):
    found = lines.text_lines(docs, keys=("doc_id",)).withColumn("page", F.floor(F.col("line_no") / 25).cast("int"))
    found.repartition(5).createOrReplaceTempView("sql_lines")
    one = spark.sql(f"SELECT * FROM table_runs(TABLE(sql_lines), keys => 'doc_id', min_cols => {cols}, min_block => {block})")
    assert rows(one) == rows(lines.mask_text_tables(found, cols, block, keys=("doc_id",)))
    two = spark.sql(f"SELECT * FROM table_runs(TABLE(sql_lines), keys => 'doc_id, page', min_cols => {cols}, min_block => {block})")
    assert rows(two) == rows(lines.mask_text_tables(found, cols, block, keys=("doc_id", "page")))


def test_functions_run_on_the_jvm(spark, docs):
    got = spark.sql("SELECT doc_id, cleaned_text(text) AS c, page_lines(text) AS l FROM sql_docs")
    assert rows(got) == rows(docs.select("doc_id", tx.clean_text(F.col("text")).alias("c"), folds.page_lines(F.col("text")).alias("l")))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


@pytest.mark.parametrize(("split", "most"), [("sentence", 512), ("sentence", 4), ("paragraph", 16)])
def test_segments(spark, docs, split, most):
    got = spark.sql(f"SELECT doc_id, posexplode(s) AS (segment_index, segment) FROM (SELECT doc_id, text_segments(cleaned_text(text), '{split}', {most}) AS s FROM sql_docs)")
    assert rows(got) == rows(docs.select("doc_id", F.posexplode(tx.segment_text(tx.clean_text(F.col("text")), split, most))))
    default = spark.sql("SELECT doc_id, text_segments(text) AS s FROM sql_docs")
    assert rows(default) == rows(docs.select("doc_id", tx.segment_text(F.col("text"))))


@pytest.mark.parametrize(
    ("call", "says"),
    [
        ("text_lines(TABLE(sql_docs), text => 'none')", "no column none"),
        ("text_lines(TABLE(SELECT text, 1 AS line FROM sql_docs))", "there already"),
        ("text_lines('text')", "must be a table"),
        ("table_runs(TABLE(SELECT doc_id, 1 AS line_no, text AS line FROM sql_docs), keys => 'doc_id', min_block => 0)", "at least 1"),
        ("table_runs(TABLE(sql_docs))", "no column doc"),
    ],
)
def test_wrong_calls(spark, docs, call, says):
    with pytest.raises(Exception, match=says):
        spark.sql(f"SELECT * FROM {call}").collect()


def test_wrong_split(spark, docs):
    with pytest.raises(Exception, match="neither sentence nor paragraph"):
        spark.sql("SELECT text_segments(text, 'word') FROM sql_docs").collect()
