"""What is shuffled, and what is never gathered."""

from pyspark.sql import functions as F

from fleetlens.functions.lookup import left_lookup
from fleetlens.operators import jobs as jb
from fleetlens.operators import reports as rp
from fleetlens.operators import tasks as tk
from fleetlens.plans import apply as ap
from fleetlens.plans import submit as sb
from fleetlens.plans.telemetry import Telemetry

DEFINITION = "struct<node_type_id string, custom_tags map<string,string>>"
TAG = "sync:project-id"


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_submissions_are_not_broadcast(spark):
    submitted = spark.createDataFrame([("s", 1, "c", "aws")], "submission_id string, run_id long, cluster_id string, platform string")
    tasks = spark.createDataFrame([(1, "c", "t", "SUCCESS", 5)], "run_id long, cluster_id string, task_key string, result_state string, end_time_ms long")
    events = spark.createDataFrame([("c", "x", {"k": "v"})], "cluster_id string, type string, parameters map<string,string>")
    headers = spark.createDataFrame([("c", "stored")], "cluster_id string, source string")
    items = spark.createDataFrame([("c", "stored", "volumes", "v")], "cluster_id string, source string, section string, item string")
    found = rp.submission_items(submitted, tasks, events, headers, items)
    assert "Broadcast" not in executed(found)
    assert {r.section for r in found.collect()} == {"tasks", "cluster_events", "volumes"}


def test_choosing_clusters_needs_tags_only(spark):
    tasks = spark.createDataFrame(
        [(1, 0, "t0", ("n", {TAG: "p1"}), None), (1, 1, "t1", None, "k"), (1, 2, "t2", (None, None), "k"), (1, 3, "t3", ("n", None), "k"),
         (1, 4, "t4", None, "none"), (2, 0, "t0", None, "k"), (None, 0, "t0", ("n", {}), None)],
        f"run_id long, pos int, task_key string, new_cluster {DEFINITION}, job_cluster_key string")
    shared = spark.createDataFrame(
        [(1, 0, "k", ("n", {TAG: "old"})), (1, 1, "k", ("n", {TAG: "p2"})), (2, 0, "k", (None, None))],
        f"run_id long, pos int, job_cluster_key string, new_cluster {DEFINITION}")
    columns = ["run_id", "pos", "task_key", "cluster_path", "project_id"]
    slim = tk.resolved_tags(tasks, shared)
    whole = tk.resolved_only(tk.resolve_clusters(tasks, shared))
    assert sorted(slim.select(*columns).collect(), key=repr) == sorted(whole.select(*columns).collect(), key=repr)
    assert slim.count() == 5 and not {"cluster", "new_cluster"} & set(slim.columns)


def jobs_of(spark):
    text = '{"tasks":[{"task_key":"t","job_cluster_key":"k"}],"job_clusters":[{"job_cluster_key":"k","new_cluster":{"node_type_id":"n"}}]}'
    return spark.createDataFrame([(1, text)], "job_id long, text string").select("job_id", F.parse_json("text").alias("settings"))


def test_whole_jobs_meet_looked_up_requests(spark):
    """The look-up of a template or recommendation is no join of whole jobs."""
    jobs = jobs_of(spark)
    templates = spark.createDataFrame([("p", '{"node_type_id":"m"}')], "project_id string, template string")
    recommendations = spark.createDataFrame([(7, ('{"node_type_id":"m"}',))], "id long, recommendation struct<configuration string>")
    asked = spark.createDataFrame([(1, "p", 7)], "job_id long, project_id string, recommendation_id long")
    for made in (ap.project_jobs(jobs, templates, asked), ap.recommended_jobs(jobs, recommendations, asked)):
        lines = made._jdf.queryExecution().optimizedPlan().toString().splitlines()
        at = next(i for i, line in enumerate(lines) if "Join LeftOuter" in line)
        depth = lines[at].index("Join")
        below = [line for line in lines[at + 1:] if len(line) - len(line.lstrip(" :+-")) > depth]
        assert below and not any("settings" in line for line in below)
        assert made.select(F.try_variant_get("settings", "$.job_clusters[0].new_cluster.node_type_id", "string")).first()[0] == "m"


def test_only_the_sections_asked_for(spark):
    rows = jb.job_parts(jobs_of(spark), ["job_clusters"]).select("job_id", "section", "pos", "key").collect()
    assert [tuple(r) for r in rows] == [(1, "job_clusters", 0, "k")]


def telemetry(spark, folder):
    """Small files of runs 1 to 4: one that is recorded, one whose cluster lacks information, one whose log is missing, one without project tag."""
    paths = (str(folder / str(k)) for k in range(99))

    def rows(data, schema):
        path = next(paths)
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(path)
        return spark.read.schema(schema).parquet(path)

    tag = lambda p: ("n", {TAG: p})
    return Telemetry(
        tasks=rows(
            [(1, 0, "a", None, "k", "c1", 11, "SUCCESS", 100), (1, 1, "b", None, "k", "c1", 11, "FAILED", 200), (1, 2, "c", tag("p9"), None, "c9", 12, "SUCCESS", 300),
             (1, 3, "d", None, "k", None, None, "SUCCESS", 900), (2, 0, "a", tag("p1"), "k", "c2", 21, "SUCCESS", 100), (3, 0, "a", tag("p1"), None, "c3", 31, "SUCCESS", 100),
             (4, 0, "a", ("n", None), None, "c4", 41, "SUCCESS", 100)],
            f"run_id long, pos int, task_key string, new_cluster {DEFINITION}, job_cluster_key string, cluster_id string, spark_context_id long,"
            " result_state string, end_time_ms long"),
        job_clusters=rows([(1, 0, "k", tag("old")), (1, 1, "k", tag("p1")), (2, 0, "k", tag("p2"))],
                          f"run_id long, pos int, job_cluster_key string, new_cluster {DEFINITION}"),
        projects=rows([("p1", "GRADIENT_ML", True)], "project_id string, project_model_id string, auto_apply_recs boolean"),
        clusters=rows([(f"c{k}", "aws", "s3", k, 1) for k in (1, 2, 3, 4, 9)],
                      "cluster_id string, platform string, log_scheme string, log_dir long, log_first_poll long"),
        cluster_states=rows([(f"c{k}", 5, 0, "TERMINATED", None) for k in (1, 2, 3, 4, 9)],
                            "cluster_id string, seen_s long, seq int, state string, error_code string"),
        info_headers=rows([(f"c{k}", "stored") for k in (1, 2, 3, 4, 9)], "cluster_id string, source string"),
        info_items=rows([(f"c{k}", "stored", "instances", "i") for k in (1, 1, 3, 4, 9)], "cluster_id string, source string, section string, item string"),
        cluster_events=rows([("c1", "x", {"k": "v"})] * 3, "cluster_id string, type string, parameters map<string,string>"),
        listing=rows([(d, 1, 0, "dbfs:/l/eventlog", 10, 10_000) for d in (1, 2)],
                     "dir long, poll_no long, pos long, path string, file_size long, mtime_ms long"),
    )


REQUEST = "run_id long, project_id string, cluster_path string"
LACKING = "Unable to find any active or recently terminated instances for cluster `c2`."


def asked(spark):
    return spark.createDataFrame([(k, "p1", None) for k in (1, 2, 3, 5)] + [(4, None, None), (None, "p1", None)], REQUEST)


def test_reports_join_runs_and_clusters_by_merge(spark, tmp_path):
    """However small they look in files: a broadcast of all clusters or runs is gathered on the driver."""
    df = sb.cluster_reports_for_runs(telemetry(spark, tmp_path), asked(spark), "Standard", "Jobs Compute")
    assert executed(df).count("BroadcastHashJoin") <= 1  # projects
    got = {r.run_id: (r.cluster_id, r.n_tasks, r.n_instances, r.n_events, r.error) for r in df.collect()}
    lost = "Failed to locate cluster in run {} for project {}"
    assert got == {1: ("c1", 2, 2, 3, None), 2: (None, None, None, None, LACKING), 3: ("c3", 1, 1, 0, None),
                   4: (None, None, None, None, lost.format(4, None)), 5: (None, None, None, None, lost.format(5, "p1")),
                   None: (None, None, None, 0, None)}


def test_recorded_runs_are_joined_by_merge(spark, tmp_path):
    df = sb.recorded_clusters(telemetry(spark, tmp_path), spark.createDataFrame([(1, None, None), (2, "p1", None), (3, "p1", None)], REQUEST))
    assert executed(df).count("BroadcastHashJoin") <= 1  # projects
    got = {(r.run_id, r.project_id): (r.cluster_id, r.submission_id is not None, r.error) for r in df.collect()}
    assert got == {(1, "p1"): ("c1", True, None), (1, "p9"): ("c9", False, "Failed to retrieve project p9"),
                   (2, "p1"): ("c2", False, LACKING), (3, "p1"): ("c3", False, "waiting")}


def test_tasks_move_once_to_choose_clusters(spark, tmp_path):
    """Paths and facts of their clusters come from one shuffle of tasks and entries, and equal those of two groupings."""
    t = telemetry(spark, tmp_path)
    extra = [(7, k, f"t{k}", None, f"k{k % 3}", f"c{k % 2}", k % 4, "SUCCESS", k) for k in range(9)] + [(7, 9, "t9", None, "k4", "c5", None, None, None)] * 2
    tasks = tk.eligible_tasks(t.tasks.unionByName(spark.createDataFrame(extra, t.tasks.schema)))
    shared = t.job_clusters.unionByName(spark.createDataFrame([(7, k, f"k{k}", ("n", {TAG: "p"})) for k in (0, 1, 2, 4)], t.job_clusters.schema))
    found = tk.unambiguous_paths_with_facts(tk.resolved_tags(tasks, shared))
    assert executed(found).count("Exchange ") == 1
    resolved = tk.resolved_only(tk.resolve_clusters(tasks, shared))
    facts = resolved.groupBy("run_id", "cluster_id").agg(
        F.count("*").alias("n_tasks"), F.max("end_time_ms").alias("end_time_ms"),
        F.min("spark_context_id").alias("_low"), F.max("spark_context_id").alias("_high"))
    want = tk.unambiguous_paths(resolved).join(facts, ["run_id", "cluster_id"])
    columns = ["run_id", "project_id", "cluster_path", "cluster_id", *tk.FACTS]
    rows = sorted(found.select(*columns).collect(), key=repr)
    assert rows == sorted(want.select(*columns).collect(), key=repr) and len(rows) == 6


def test_items_of_submissions_move_once(spark):
    """Items meet the submissions of their chosen document in one join."""
    rows = spark.createDataFrame
    submitted = rows([("s", 1, "c", "aws"), ("u", 2, "c", "azure"), ("v", 3, "d", "aws")], "submission_id string, run_id long, cluster_id string, platform string")
    tasks = rows([(1, "c", "t", "SUCCESS", 5), (9, "c", "t", "SUCCESS", 5)], "run_id long, cluster_id string, task_key string, result_state string, end_time_ms long")
    events = rows([("c", "x", {"k": "v"})], "cluster_id string, type string, parameters map<string,string>")
    headers = rows([("c", "stored"), ("c", "live"), ("d", "live")], "cluster_id string, source string")
    items = rows([("c", "stored", "volumes", "a"), ("c", "live", "volumes", "b"), ("d", "live", "instances", "i"), ("e", "live", "instances", "j")],
                 "cluster_id string, source string, section string, item string")
    found = rp.submission_items(submitted, tasks, events, headers, items)
    assert executed(found).count("Union") == 1 and "Broadcast" not in executed(found)
    assert sorted((r.submission_id, r.section) for r in found.collect()) == [
        ("s", "cluster_events"), ("s", "tasks"), ("s", "volumes"), ("u", "cluster_events"), ("v", "instances")]


def test_a_look_up_moves_what_is_asked_for(spark):
    left = spark.createDataFrame([(1, "a", "text"), (2, None, "text")], "id long, k string, long_text string")
    right = spark.createDataFrame([("a", 5)], "k string, v long")
    found = left_lookup(left, right.hint("merge"), "k", ["id"]).select("id", "v")
    assert found._jdf.queryExecution().optimizedPlan().toString().count("long_text") == 1  # in the table alone
    assert sorted(map(tuple, found.collect())) == [(1, 5), (2, None)]
