"""Projects, submissions, recommendations, workspaces and outcomes of waiting."""

from pyspark.sql import functions as F

from fleetlens.operators import events as ev
from fleetlens.operators import projects as pj
from fleetlens.operators import recommend as rc
from fleetlens.operators import reports as rp
from fleetlens.operators import waits as wt
from fleetlens.operators import workspaces as wk
from fleetlens.streaming import waits as sw
from fleetlens.streaming.replay import replay

SUBMISSION = "id string, project_id string, created_at string, state string, configuration struct<node string>"


def test_latest_submissions(spark):
    projects = spark.createDataFrame([("mixed",), ("failed",), ("none",), ("bare",)], "project_id string")
    rows = spark.createDataFrame(
        [("a", "mixed", "2024-01-01", "SUCCESS", ("n1",)), ("b", "mixed", "2024-01-02", "FAILED", ("n2",)),
         ("c", "failed", "2024-01-01", "FAILED", ("n3",)), ("d", "failed", "2024-01-01", "FAILED", ("n4",)),
         ("e", "bare", "2024-01-01", "SUCCESS", None)],
        SUBMISSION,
    )

    def run(**kw):
        got = pj.latest_submission_config(projects, rows, **kw).collect()
        return {r.project_id: (r.submission_id, r.configuration and r.configuration.node, r.error) for r in got}

    assert run() == {"mixed": ("b", "n2", None), "failed": ("d", "n4", None), "bare": ("e", None, None),
                     "none": (None, None, "NoSubmissionsFound")}
    assert run(success_only=True) == {
        "mixed": ("a", "n1", None), "failed": (None, None, "NoSuccessfulSubmissionsFound"), "bare": ("e", None, None),
        "none": (None, None, "NoSubmissionsFound"),
    }
    assert {r.id for r in pj.by_project(rows, "mixed").collect()} == {"a", "b"}
    assert [r.id for r in pj.by_project(rows, "mixed", "a").collect()] == ["a"]


def test_latest_recommendations(spark):
    projects = spark.createDataFrame([("good",), ("empty",), ("bare",), ("none",)], "project_id string")
    rec = "id string, project_id string, created_at string, recommendation struct<configuration string>"
    rows = spark.createDataFrame(
        [("a", "good", "1", ('{"node":"n1"}',)), ("b", "good", "2", ('{"node":"n2"}',)), ("c", "empty", "1", None),
         ("d", "bare", "1", (None,))], rec,
    )
    latest = pj.latest_recommendation(projects, rows)
    got = {r.project_id: (r.configuration, r.error) for r in latest.collect()}
    assert got == {"good": ('{"node":"n2"}', None), "empty": (None, "Recommendation not found"),
                   "bare": (None, "Recommendation configuration not found"), "none": (None, None)}
    defs = projects.withColumn("definition", F.parse_json(F.lit('{"node":"old","num_workers":3,"other":1}')))
    merged = rc.updated_definitions(defs, latest).select("project_id", F.to_json("definition").alias("definition"), "error")
    new = {r.project_id: (r.definition, r.error) for r in merged.collect()}
    assert new == {"good": ('{"node":"n2","other":1}', None), "empty": (None, "Recommendation not found"),
                   "bare": (None, "Recommendation configuration not found"), "none": (None, "no_recommendation")}
    both = {r.project_id: (r.known, r.cluster_recommendation, r.error) for r in rc.definition_and_recommendation(defs, latest).withColumn(
        "known", F.col("cluster_definition").isNotNull()).collect()}
    assert both["good"] == (True, '{"node":"n2"}', None)
    assert both["none"] == (False, None, "Recommendation failed")


def test_projects_by_app(spark):
    rows = spark.createDataFrame([("p2", "x", 2), ("p1", "x", 1), ("p3", None, 0)],
                                 "project_id string, app_id string, created_at int")
    assert [r.project_id for r in pj.projects_by_app(rows, "x").orderBy("project_id").collect()] == ["p1", "p2"]
    assert pj.projects_by_app(rows).count() == 3
    asked = spark.createDataFrame([("x",), ("y",), ("6fa459ea-ee8a-3ca4-894e-db77e160355e",)], "value string")
    got = {r.value: (r.project_id, r.error) for r in pj.resolve_project_ids(asked, rows).collect()}
    uuid = "6fa459ea-ee8a-3ca4-894e-db77e160355e"
    assert got == {"x": ("p1", None), "y": (None, "No project found for 'y'"), uuid: (uuid, None)}


def test_project_patches(spark):
    schema = "project_id string, description string, auto_apply_recs boolean, optimize_instance_size boolean"
    rows = spark.createDataFrame([("a", "old", True, True), ("b", "old", True, False), ("c", "old", False, True)], schema)
    patches = spark.createDataFrame([("a", "", False, False), ("b", "new", None, True)], schema)
    got = {tuple(r) for r in pj.patch_projects(rows, patches).collect()}
    assert got == {("a", "old", False, True), ("b", "new", True, True), ("c", "old", False, True)}


def test_unknown_and_untracked_projects_fail_alone(spark):
    rows = spark.createDataFrame([("c1", "a"), ("c2", "b"), ("c3", "zz"), ("c4", None)], "cluster_id string, project_id string")
    projects = spark.createDataFrame([("a", "GRADIENT_ML", True), ("b", "OLD", True)],
                                     "project_id string, project_model_id string, auto_apply_recs boolean")
    got = {r.cluster_id: r.project_error for r in pj.join_projects(rows, projects).collect()}
    assert got == {"c1": None, "c2": "Unexpected project_model_id for project b: OLD",
                   "c3": "Failed to retrieve project zz", "c4": "Failed to retrieve project None"}


def test_workspace_patches_are_three_valued(spark):
    rows = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x"), ("d", "x")], "workspace_id string, region string")
    patches = spark.createDataFrame([("a", None), ("b", "null"), ("c", "y")], "workspace_id string, region string")
    assert {tuple(r) for r in wk.patch_workspaces(rows, patches).collect()} == {
        ("a", "x"), ("b", None), ("c", "y"), ("d", "x")
    }


def test_terminations_in_batch_and_stream(spark):
    schema = "cluster_id bigint, seen_s bigint, seq bigint, state string, error_code string"
    ending = "TERMINATING"
    cases = {
        1: [(0, ending, None), (600, ending, None), (700, "TERMINATED", None)],
        2: [(0, ending, None), (601, ending, None), (700, "TERMINATED", None)],
        3: [(5, "RUNNING", None)],
        4: [(5, None, None)],
        5: [(0, ending, "404"), (5, "TERMINATED", None)],
        6: [(0, ending, None), (600, ending, None)],
        7: [(0, ending, None), (700, "TERMINATED", None)],  # the limit is tested after a TERMINATING look only
    }
    rows = spark.createDataFrame([(c, s, i, st, e) for c, v in cases.items() for i, (s, st, e) in enumerate(v)], schema)
    want = {1: "ok", 2: "Cluster failed to terminate after waiting 600 seconds", 3: "Unexpected cluster state: RUNNING",
            4: "Unexpected cluster state: None", 5: "Databricks API Error: 404", 6: "waiting", 7: "ok"}
    assert {r.cluster_id: r.outcome for r in wt.cluster_terminations(rows).collect()} == want
    streamed = replay(rows, sw.terminations, "test", "seen_s", slices=3)
    assert {r.cluster_id: r.outcome for r in streamed.collect()} == {c: o for c, o in want.items() if o != "waiting"}


def test_first_final_runs_in_batch_and_stream(spark):
    rows = spark.sql("""
        SELECT CAST(run_id AS bigint) AS run_id, s * 1000000L AS ts, s AS seq, state, error_code FROM VALUES
        (1, 1, NULL, NULL), (1, 2, 'RUNNING', NULL), (1, 3, 'FAILED', NULL), (1, 4, 'SUCCESS', NULL),
        (2, 1, NULL, NULL), (3, 1, NULL, '404'), (3, 2, 'SUCCESS', NULL), (4, 9, 'CANCELED', NULL)
        AS t(run_id, s, state, error_code)""")
    want = {1: ("FAILED", None), 2: (None, None), 3: (None, "Databricks API Error: 404"), 4: ("CANCELED", None)}
    assert {r.run_id: (r.state, r.error) for r in wt.first_final_runs(rows).collect()} == want
    out = replay(rows, sw.final_runs, "test", "seq", slices=3)
    assert {(r.run_id, r.state, r.error) for r in out.collect()} == {(r, *o) for r, o in want.items() if any(o)}


def test_first_final_recommendations_in_batch_and_stream(spark):
    rows = spark.sql("""
        SELECT CAST(recommendation_id AS bigint) AS recommendation_id, s * 1000000L AS ts, s AS seq, state FROM VALUES
        (1, 1, 'PENDING'), (1, 2, 'SUCCESS'), (2, 1, 'FAILURE'), (3, 1, 'PENDING') AS t(recommendation_id, s, state)""")
    got = {r.recommendation_id: r.outcome for r in wt.first_final_recommendations(rows).collect()}
    assert got == {1: "ready", 2: "Recommendation failed", 3: "pending"}
    out = replay(rows, sw.final_recommendations, "test", "seq", slices=2)
    assert {(r.recommendation_id, r.outcome) for r in out.collect()} == {(1, "ready"), (2, "Recommendation failed")}


def test_ended_waits_are_forgotten(spark, tmp_path):
    """Each wait is told once; its state goes when the stream is a day past its end."""
    day, out, sizes = 86_400_000_000, [], []
    schema = "run_id bigint, state string, error_code string, ts bigint, seq bigint"
    for n in range(6):
        rows = [(n, "RUNNING", None, n * day + 1, 0), (n, "SUCCESS", None, n * day + 5, 1), (n, "FAILED", None, n * day + 9, 2)]
        rows += [(n - 1, "FAILED", None, n * day + 2, 3)] if n else []  # heard of again
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{tmp_path}/in")
        stream = sw.final_runs(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), forget_after="1 day")
        (stream.writeStream.outputMode("update").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True)
         .foreachBatch(lambda batch, _: out.extend(map(tuple, batch.collect()))).start().awaitTermination())
        sizes.append(spark.read.format("statestore").option("stateVarName", "wait").load(f"{tmp_path}/c").count())
    assert sorted(out) == [(n, "SUCCESS", None) for n in range(6)]
    assert max(sizes) <= 3 and sizes[-1] <= 3


def test_report_completeness(spark):
    clusters = spark.createDataFrame([("a", "aws"), ("b", "aws"), ("c", "aws"), ("d", "azure"), ("e", "azure")],
                                     "cluster_id string, platform string")
    headers = spark.createDataFrame(
        [("a", "stored"), ("a", "live"), ("b", "live"), ("d", "stored")], "cluster_id string, source string")
    items = spark.createDataFrame(
        [("a", "live", "instances", "x"), ("a", "stored", "instance_timelines", "t"), ("b", "live", "instances", "y"),
         ("b", "live", "volumes", "v")], "cluster_id string, source string, section string, item string")
    info = rp.cluster_info(clusters, headers, items)
    got = {r.cluster_id: (r.source, r.n_instances, r.n_instance_timelines, r.n_volumes) for r in info.collect()}
    # The stored document of a has no instances; those of the live one are not mixed in.
    assert got == {"a": ("stored", 0, 1, 0), "b": ("live", 1, 0, 1), "c": (None,) * 4, "d": ("stored", 0, 0, 0),
                   "e": (None,) * 4}
    errors = {r.cluster_id: r.info_error for r in rp.completeness(info, F.lit(False)).collect()}
    missing = "Unable to find any active or recently terminated instances for cluster `{}`."
    assert errors == {"a": missing.format("a"), "b": None, "c": missing.format("c"), "d": None,
                      "e": "Unable to find cluster information for cluster `e`."}
    allowed = rp.cluster_reports(rp.completeness(info, F.lit(True)), clusters.limit(0), "Standard", "Jobs Compute")
    sizes = {r.cluster_id: (r.n_instances, r.n_timelines, r.n_volumes, r.info_error) for r in allowed.collect()}
    assert sizes == {"a": (0, 1, 0, None), "b": (1, 0, 1, None), "c": (None, 0, 0, None), "d": (0, 0, None, None),
                     "e": (None, None, None, None)}


def test_events_keep_their_order_and_lose_their_messages(spark):
    pages = spark.createDataFrame(
        [("c", 1, 0, "old", 9), ("c", 0, 1, "mid", 7), ("c", 0, 0, "new", 7), ("d", 0, 0, "x", 1)],
        "cluster_id string, page_no int, pos int, type string, total_count int",
    )
    got = ev.all_events(ev.union_pages(pages.filter("page_no = 0"), pages.filter("page_no = 1"))).collect()
    assert {(r.cluster_id, r.seq, r.type, r.total_count) for r in got} == {
        ("c", 1, "new", 7), ("c", 2, "mid", 7), ("c", 3, "old", 7), ("d", 1, "x", 1)
    }
    event = "struct<type string, details struct<reason struct<code string, parameters map<string,string>>>>"
    docs = spark.createDataFrame(
        [([("a", (("x", {"azure_error_message": "?", "databricks_error_message": "?", "k": "v"}),)),
           ("b", (None,)), ("c", None), ("d", (("x", None),))],)], f"events array<{event}>",
    )
    clean = docs.select(ev.redact_events(F.col("events")).alias("e")).first().e
    assert clean[0].details.reason.parameters == {"k": "v"} and clean[0].details.reason.code == "x"
    assert clean[1].details.reason is None and clean[2].details is None
    assert clean[3].details.reason.parameters is None
    text = docs.select(rp.without_nulls(F.get("events", F.lit(2)))).first()[0]
    assert text == '{"type":"c"}'
