"""Physical plans: no Python, no cross products, pruned scans, few shuffles."""

import re

import pytest

from orderlens.plans.catalog import queries

QUERIES = queries()


def plan(df, spark):
    return df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_python_and_no_cross_product(name, spark, sf_dir):
    text = plan(QUERIES[name](spark, sf_dir), spark)
    assert not re.search(r"Python|Pandas|Arrow", text)
    assert "CartesianProduct" not in text
    assert "NestedLoopJoin" not in text


def test_scan_reads_only_needed_columns(spark, sf_dir):
    text = plan(QUERIES["company_rank"](spark, sf_dir), spark)
    assert "ReadSchema: struct<l_orderkey:bigint>" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text


def test_date_filter_reaches_the_scan(spark, sf_dir):
    text = plan(QUERIES["enriched_orders"](spark, sf_dir), spark)
    assert re.search(r"PushedFilters: \[.*o_orderdate.*1996-01-01", text)


def test_net_orders_reads_the_orders_once(spark, sf_dir):
    text = plan(QUERIES["daily_company_net"](spark, sf_dir), spark)
    assert len(re.findall(r"Location: .*lineitem\.parquet", text)) == 1


@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith("renewal_")])
def test_renewals_read_the_orders_once(name, spark, sf_dir):
    text = plan(QUERIES[name](spark, sf_dir), spark)
    assert len(re.findall(r"Location: .*lineitem\.parquet", text)) == 1


@pytest.mark.parametrize("name", ["agent_registered", "agent_milestones_registered", "agent_calendar", "auto_deduct_remaining"])
def test_reports_on_saved_tables_leave_the_orders_alone(name, spark, sf_dir):
    """What the orders say was written once before; the report reads that."""
    text = plan(QUERIES[name](spark, sf_dir), spark)
    assert "lineitem.parquet" not in text


def test_windows_never_run_over_the_orders_in_one_partition(spark, sf_dir):
    """A window without partition keys only ever sees an aggregate."""
    for name in ("company_rank", "surname_counts", "region_share_weekly", "age_sex"):
        text = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        lines = text.splitlines()
        windows = [i for i, line in enumerate(lines) if re.search(r"\bWindow \[", line)]
        assert windows
        for i in windows:
            assert any("Aggregate" in line for line in lines[i + 1 :])
