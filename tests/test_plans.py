"""What the physical plans must look like."""

import os

import pytest

from corpusloom.plans.registry import QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
LAZY = ("chunk_adaptive", "url_scope_filter", "url_normalize", "document_links", "frontier_urls", "title_compose", "change_detect", "priority_claim", "insert_urls_ignore", "update_full", "replace_chunks", "delete_cascade", "crawl_stats", "collect_distribution", "fulltext_and", "p5_found")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, DATA))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_scope_is_pushed_to_the_scan(spark):
    text = plan(QUERIES["url_scope_filter"](spark, DATA))
    assert "StringStartsWith(url" in text
    assert "ReadSchema: struct<id:string,url:string,collect_count:int>" in text


def test_statistics_read_two_columns_in_one_pass(spark):
    text = plan(QUERIES["crawl_stats"](spark, DATA))
    assert text.count("FileScan") == 2
    assert "ReadSchema: struct<url:string,collect_count:int>" in text and "ReadSchema: struct<url:string>" in text


def test_claim_is_a_top_k(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["priority_claim"](spark, DATA))


@pytest.mark.parametrize("name", ["chunk_adaptive", "title_compose", "p5_found", "url_normalize", "document_links"])
def test_narrow_stages_do_not_shuffle(spark, name):
    assert "Exchange" not in plan(QUERIES[name](spark, DATA))
