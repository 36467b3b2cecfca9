"""What the plans of the registered queries look like."""

import re

import pytest

from __spark_entry__ import entry
from fleetlens.queries import REGISTRY
from oracle import ORACLE

SF = "/root/testdata/sf0.001"
# Queries that run streams or writes of their own before they return a plan.
EAGER = {n for n in REGISTRY if n.endswith("_stream")} | {"scan_cluster_info", "delivered_documents", "read_log_lines", "submission_report_items"}
BATCH = sorted(set(REGISTRY) - EAGER)


def plan(spark, name):
    return REGISTRY[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_a_statement():
    assert set(REGISTRY) == set(ORACLE)


def test_entry_names_a_cluster_per_run(spark):
    df = entry(spark)
    assert df.columns == ["run_id", "project_id", "cluster_id", "branch"]
    assert df.count() > 0


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "InPandas" not in text


def test_scans_read_only_what_they_need(spark):
    text = plan(spark, "latest_submission_config")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert any("o_orderdate" in s for s in schemas)
    assert not any(c in s for s in schemas for c in ("o_totalprice", "o_orderpriority", "c_acctbal"))
    text = plan(spark, "retired_instances")
    assert "PushedFilters: [IsNotNull(event_type), Not(EqualTo(event_type,error))" in text


def test_newest_rows_need_no_window(spark):
    for name in ("latest_submission_config", "latest_success_submission", "latest_recommendation", "inventory_latest"):
        assert "Window" not in plan(spark, name)


def test_rewriting_jobs_shuffles_only_to_look_recommendations_up(spark):
    for name in ("job_single_cluster", "one_off_payloads"):
        text = plan(spark, name)
        assert "Join" not in text and "Aggregate" not in text and "hashpartitioning" not in text
