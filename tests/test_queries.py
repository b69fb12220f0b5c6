"""Every registered query against its SQL, and what its physical plan must not contain."""

import __spark_entry__ as contract
import pytest
from compare import connect, differences

from filingpanel import table_queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(table_queries.QUERIES))
def test_query_equals_sql(spark, database, name):
    df = contract.queries()[name](spark, SF_DIR)
    assert differences(df, database, contract.oracle_sql()[name]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(table_queries.QUERIES) == set(table_queries.ORACLE_SQL)
    assert set(table_queries.QUERIES) <= set(contract.queries())


REDUCED_FIRST = (
    "forms_by_key latest_definition dictionary_build dictionary_lookup prefix_counts numeric_inference column_profile "
    "quarter_summary entity_stats overall_stats run_status gap_first_missing gap_preview long_wide catalog_prune"
).split()


@pytest.mark.parametrize("name", REDUCED_FIRST)
def test_groups_are_reduced_before_they_are_shuffled(spark, name):
    """Below every shuffle that starts at a scan there is a map-side step of the aggregation."""
    plan = contract.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "partial_" in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "partial_" in lines[i + 1], plan


def test_rank_limits_apply_before_the_shuffle(spark):
    plan = contract.queries()["first_names"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_scans_read_only_what_is_used(spark):
    plan = contract.queries()["latest_definition"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan
    ranged = contract.queries()["period_range"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in ranged
