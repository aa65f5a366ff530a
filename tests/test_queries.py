"""Registered queries: results against SQL, and the shape of their plans."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as spark_entry
from assaylake.workload.oracles import ORACLES
from assaylake.workload.queries import QUERIES
from tests.check_oracles import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="benchmark tables are not here")

# The full list is checked by tests/check_oracles.py; these cover every family in a short time.
SAMPLE = (
    "rule_summary_customer rule_summary_orders rule_summary_lineitem rule_summary_documents uniqueness_null_ignored "
    "uniqueness_null_equal uniqueness_within_status ref_integrity_rows_lineitem row_verdicts_customer clean_orders "
    "quarantine_entries sequential_log_customer sequential_log_orders dataset_scores published_orders rule_contract_audit "
    "rule_upsert mapping_upsert rule_resolution rule_coverage rule_history rule_conflicts value_conflicts customer_360 "
    "top_failing_rules alerts quarantine_reprocess pii_masking profile_orders reconcile_order_lines score_trend "
    "event_sessions stream_window_metrics stream_sessions"
).split()

# Plans that are lazy end to end and read the tables directly.
PLANNED = (
    "rule_summary_customer rule_summary_orders rule_summary_lineitem rule_summary_events rule_summary_documents heatmap "
    "rule_resolution rule_coverage rule_conflicts value_conflicts rule_upsert customer_360 sales_by_brand "
    "reconcile_order_lines event_window_metrics profile_orders clean_orders row_flags_orders quarantine_entries "
    "sequential_log_orders dataset_scores"
).split()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", SAMPLE)
def test_equals_sql(spark, con, name):
    assert compare(spark, con, FOLDER, name) is None


def test_every_sql_has_its_query():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert spark_entry.entry(spark).count() == sum(len(s.able()) for s in spark_entry.SUITES.values())


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_plan_has_no_pairwise_join(spark, name):
    text = plan(spark_entry.queries()[name](spark, FOLDER))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython", text)


def test_log_reads_row_rules_in_one_scan_and_keys_alone(spark):
    text = plan(spark_entry.queries()["rule_summary_customer"](spark, FOLDER))
    scans = [s.split(",") for s in re.findall(r"FileScan parquet \[([^\]]*)\]", text)]
    columns = [sorted(c.split("#")[0] for c in s) for s in scans]
    # Five row rules, the unique key, the foreign key, and the reference.
    assert columns == [["c_acctbal", "c_mktsegment", "c_name"], ["c_acctbal"], ["c_nationkey"], ["n_nationkey", "n_regionkey"]]
    assert "Window" not in text and "SortMergeJoin" not in text


def test_bench_queries_are_registered():
    import bench

    assert set(bench.HEADLINE) <= set(spark_entry.queries())


def test_rule_documents_hold_every_part(spark, tmp_path):
    """Odd and even keys, both severities, nulls, a repeated row; many documents, which are written by few tasks."""
    parts = [(k, k % 50) for k in (1, 2, 3, 9_999, 10_000, 10_001, 777_777, 1_234_567, 12_345_678, *range(20_000, 600_000, 10_007))]
    parts += [(2, 40), (2, 40), (4, None), (None, 30), (None, None)]
    path = str(tmp_path / "part.parquet")
    spark.createDataFrame(parts, "p_partkey long, p_size int").write.parquet(path)
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW part AS SELECT * FROM read_parquet('{path}/*.parquet')")
        assert compare(spark, con, str(tmp_path), "rule_documents") is None
    assert spark_entry.queries()["rule_documents"](spark, str(tmp_path)).count() == 2 * len(parts)
