"""Every registered query against its SQL statement, on the supplied data and on a copy with hot keys."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracle import TABLES, compare, connect  # noqa: E402

from fleetlens.queries import REGISTRY  # noqa: E402

SF = "/root/testdata/sf0.001"
# One key holds a third of the rows of each of these tables.
HOT = {
    "lineitem": "* REPLACE (CASE WHEN (l_partkey + l_suppkey) % 3 = 0 THEN 7 ELSE l_orderkey END AS l_orderkey)",
    "orders": "* REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 3 ELSE o_custkey END AS o_custkey)",
    "events": "* REPLACE (CASE WHEN event_id % 3 = 0 THEN 3 ELSE user_id END AS user_id)",
}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.fixture(scope="module")
def hot(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("hot"))
    for t in TABLES:
        duckdb.execute(f"COPY (SELECT {HOT.get(t, '*')} FROM '{SF}/{t}.parquet') TO '{folder}/{t}.parquet'")
    return folder


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, con, name):
    status, rows, _, note = compare(spark, con, name, SF)
    assert (status, note) == ("ok", "") and rows > 0


@pytest.mark.parametrize("name", [
    "project_cluster_selection", "run_cluster_projects", "instance_timelines", "retired_instances", "monitor_step",
    "cluster_events_all", "log_size_changes", "eventlog_ready_poll", "latest_submission_config",
    "ebs_volumes_for_instances", "record_runs", "instance_timelines_stream",
])
def test_hot_keys(spark, hot, name):
    status, _, _, note = compare(spark, connect(hot), name, hot)
    assert (status, note) == ("ok", "")
