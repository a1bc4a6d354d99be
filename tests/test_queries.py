"""Every query of the library's own operators against its SQL."""

import pytest

from terroir.plans import registry
from tests.comparing import same_as_sql

FOLDER = "/root/testdata/sf0.001"
SQL = registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, name):
    df = registry.queries()[name](spark, FOLDER)
    if name in SQL:
        same_as_sql(df, SQL[name], FOLDER)
    else:
        assert df.count() >= 0


def test_registry_is_complete():
    assert set(SQL) <= set(registry.queries())


@pytest.mark.parametrize("name", ["gap_ranking", "d19_rollup_distinct", "c05_bigram_topk", "c01_region_cascade", "c01c_longest_match", "c01d_successor", "c01f_province", "c18_per_region_reevaluation", "e02_longest_ties"])
def test_no_cross_join_of_two_tables(spark, name):
    """Plans without automatic broadcasts hold no nested loops and no cartesian product."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = registry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in plan
    assert "NestedLoop" not in plan


@pytest.mark.parametrize("name", ["gap_ranking", "e06_rank_numbers", "e11_quantile_buckets", "f01_aggregate_order", "f02_gap_order", "f04_candidate_order", "f09_multi_key_sort", "f10_coverage_sorts", "f11_ordinal_sort", "f12_variant_order"])
def test_no_window_over_all_rows_in_one_task(spark, name):
    df = registry.queries()[name](spark, FOLDER)
    assert "SinglePartition" not in df._jdf.queryExecution().executedPlan().toString()
