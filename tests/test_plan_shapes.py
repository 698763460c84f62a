"""Plans stay as they are meant to be at scale."""

import re

import pytest

from seasonline.operators.robust import iqr_fence, keep_within
from seasonline.operators.scaling import zscore
from seasonline.plans import queries as q
from seasonline.plans import tables as t
from seasonline.plans.rendering import both_kinds, fetched_pages
from seasonline.session import staged

PYTHON = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonMapInArrow")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def errors(spark, sf_dir):
    return staged(t.errors(spark, sf_dir))


NATIVE = [
    q.trimmed_reconciliation,
    q.forecast_actual_join,
    q.season_zscore,
    q.stat_histogram,
    q.conform_layouts,
    q.records_from_cells,
    q.page_table_grid,
    q.page_cells,
    q.error_summary,
    q.ols_fit,
]


@pytest.mark.parametrize("query", NATIVE, ids=lambda f: f.__name__)
def test_no_python_no_cross_join_no_single_partition(spark, sf_dir, query):
    plan = plan_of(query(spark, sf_dir))
    assert not any(node in plan for node in PYTHON)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Exchange SinglePartition" not in plan


def test_scans_read_only_what_is_needed(spark, sf_dir):
    plan = plan_of(t.outcome_lines(spark, sf_dir))
    assert re.findall(r"ReadSchema: struct<([^>]*)>", plan) == [
        "l_partkey:bigint,l_extendedprice:double,l_discount:double,l_shipdate:timestamp_ntz"
    ]


def test_seasons_reach_the_scan_as_dates(spark, sf_dir):
    for query in (q.exposure_rescale, q.ridge_scores):
        plan = plan_of(t.stat_lines(spark, sf_dir, 1996, 1999)) if query is q.exposure_rescale else plan_of(t.stat_lines(spark, sf_dir, last=2000))
        assert re.search(r"PushedFilters: \[[^\]]*LessThan\(l_shipdate", plan)
    assert "GreaterThanOrEqual(l_shipdate" in plan_of(q.exposure_rescale(spark, sf_dir))


def test_prices_are_joined_after_the_two_sides(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(t.matched(spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # By (name, yr) for each side, by name for what was joined, and for the parts.
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 4


def test_rows_are_not_shuffled_to_meet_small_statistics(errors):
    kept = keep_within(errors, "e", iqr_fence(errors, "e", ["pos"]), ["pos"])
    plan = plan_of(kept)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert "Exchange hashpartitioning" not in plan_of(zscore(errors, ["proj"], ["yr"]))


def test_large_statistics_are_not_broadcast(spark, errors):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = keep_within(errors, "e", iqr_fence(errors, "e", ["pos"]), ["pos"])
        assert "Broadcast" not in plan_of(kept)
        without = kept.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert without == keep_within(errors, "e", iqr_fence(errors, "e", ["pos"]), ["pos"]).count()


def test_only_the_wanted_slices_are_ordered(errors):
    plan = plan_of(iqr_fence(errors, "e", ["pos"]))
    above, below = plan.split("Window [", 1)
    assert "LeftSemi" in below and "Window [" not in below


def test_partial_sums_come_before_the_shuffle(spark, sf_dir):
    plan = plan_of(t.stat_lines(spark, sf_dir))
    assert "partial_bit_or" in plan and "partial_sum" in plan
    # Parts are joined after the line items were summed.
    assert plan.index("Join") < plan.index("partial_sum")


def test_rows_of_fetched_pages_are_shuffled_once(spark, sf_dir):
    """The last record of a page is found among the page's rows, not by another shuffle of them."""
    assert "Window" not in plan_of(fetched_pages(both_kinds(spark, sf_dir), 1))
