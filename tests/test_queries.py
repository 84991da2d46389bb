"""Every query against its SQL on the driver's smallest tables, and both outcomes of the filters."""

import os

import pytest
from oracle import connect, differences
from pyspark.sql import functions as F

import __spark_entry__ as driver
from tessella import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query_equals_sql(spark, name):
    assert differences(queries.queries()[name](spark, SF), connect(SF), queries.oracle_sql()[name]) == []


def test_filters_keep_and_drop(spark):
    every = queries._noisy_lines(spark, SF).count()
    assert 0 < queries.drop_numeric_lines(spark, SF).count() < every
    assert 0 < queries.strip_toc_footer(spark, SF).count() < every
    assert {r[0] for r in queries.mask_text_tables(spark, SF).select("masked").distinct().collect()} == {True, False}


def test_entry(spark):
    assert driver.entry(spark).limit(1).count() == 1
    assert set(queries.queries()) <= set(driver.queries()) and set(queries.oracle_sql()) <= set(driver.oracle_sql())


def test_filter_reaches_the_scan(spark):
    plan = queries.doc_lines(spark, SF).where(F.col("doc_id") == 3)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,3)" in plan and "source" not in plan
