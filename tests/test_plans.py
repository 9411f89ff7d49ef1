"""Shapes of physical plans, with broadcasting by size switched off as it would be on large tables."""

import re

import pytest

from sievework.catalog.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def plan(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield lambda name: QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def reads_of(plan, column):
    return sum(column in schema for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan))


@pytest.mark.parametrize(
    "name",
    ["qualified_leads", "qualified_leads_cached", "website_requests", "qualified_people", "weighted_leads", "checkpoint_leads",
     "cache_misses", "cache_after_delete", "results_combined", "job_progress", "run_summary"],
)
def test_no_products_and_no_single_task_windows(plan, name):
    text = plan(name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Window " not in text


def test_markup_is_read_once_and_only_where_text_is_needed(plan):
    assert reads_of(plan("qualified_leads"), "html") == 1
    assert reads_of(plan("website_requests"), "html") == 1
    assert reads_of(plan("qualified_people"), "html") == 0
    assert reads_of(plan("sites_distinct"), "html") == 0


def test_sites_are_combined_before_the_shuffle(plan):
    text = plan("website_scores")
    assert re.search(r"Exchange hashpartitioning\(site#\d+, \d+\).*\n[ :+-]*HashAggregate\(keys=\[site", text)
    assert "SortAggregate(key=[site" not in text
