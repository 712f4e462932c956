"""The shape of the physical plans: pushdown, early limits, no nested-loop joins."""

import pytest

import __spark_entry__ as entry
from peakloom.catalog.inputs import scan_list
from peakloom.operators.store import point
from peakloom.operators.summary import flattened, nested

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("name", ["sample_draw", "latest_write", "renumbered_pool"])
def test_limit_per_group_comes_before_the_shuffle(spark, name):
    assert plan(entry.queries()[name](spark, SF)).count("WindowGroupLimit") >= 2


def test_filter_and_columns_reach_the_scan(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet")
    text = plan(point(df, l_orderkey=7, l_linenumber=1).select("l_extendedprice"))
    assert "EqualTo(l_orderkey,7)" in text and "EqualTo(l_linenumber,1)" in text
    assert "l_comment" not in text and "l_discount" not in text


@pytest.mark.parametrize(
    "name",
    ["cluster_info", "cluster_summary", "scans_to_keep", "store_remove", "incremental_merge", "ppm_join", "merge_candidates"],
)
def test_joins_are_hash_or_merge_joins(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_nested_pages(spark):
    rows = scan_list(spark, SF)
    pages = nested(rows.selectExpr("1L cluster_id", "path", "scan", "precursor_mz", "retention_time"), 100)
    sizes = [len(r.scan_list) for r in pages.collect()]
    assert sum(sizes) == rows.count() and len(sizes) > 20 and max(sizes) < 300
    assert flattened(pages).count() == rows.count()
