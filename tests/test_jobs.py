"""Clusters of jobs, rewritten jobs and payloads."""

import json

from pyspark.sql import functions as F

from fleetlens.functions.merge import parse_patch
from fleetlens.operators import jobs as jb
from fleetlens.plans.apply import job_updates, project_jobs, recommended_jobs


def cluster(node, project=None, name=None, policy=None):
    """A definition as delivered, with a key that no operator knows."""
    out = {"node": node, "num_workers": 3, "deep": {"er": [node]}}
    out.update({k: v for k, v in {"cluster_name": name, "policy_id": policy}.items() if v})
    return out | ({"custom_tags": {"sync:project-id": project}} if project else {})


SHARED = [("k0", cluster("n0", "p0", "name0", "pol")), ("k1", cluster("n1", "p1")), ("k1", cluster("n1b", "p1"))]


def settings(tasks, clusters=SHARED):
    """``tasks``: (key, inline definition, cluster key)."""
    out = {"name": "job", "schedule": {"cron": "0 0"}, "tasks": [
        {k: v for k, v in {"task_key": key, "new_cluster": own, "job_cluster_key": shared}.items() if v is not None}
        | {"notebook_task": {"path": "/" + key}, "libraries": [{"pypi": {"package": key}}]} for key, own, shared in tasks]}
    if clusters is not None:
        out["job_clusters"] = [{"job_cluster_key": k, "new_cluster": c} for k, c in clusters]
    return out


def jobs(spark, *task_lists, clusters=SHARED):
    rows = [(i, json.dumps(settings(tasks, clusters))) for i, tasks in enumerate(task_lists)]
    return spark.createDataFrame(rows, "job_id int, t string").select("job_id", F.parse_json("t").alias("settings"))


def at(column, path):
    return F.try_variant_get(column, path, "string")


def test_single_clusters(spark):
    rows = jb.single_clusters(jobs(
        spark,
        [("a", None, "k0")],
        [("a", cluster("own"), None)],
        [("a", {}, "k1")],  # an empty inline definition counts as absent; the first entry of a key counts
        [("a", None, "k0"), ("b", None, "k0")],
        [("a", None, "k0"), ("b", None, "k1")],
        [("a", None, "zz")],
        [("a", None, "zz"), ("b", None, "zz")],
        [("a", cluster("own"), None), ("b", cluster("own"), None)],  # several tasks: inline definitions do not count
        [],
    )).orderBy("job_id").select(at("cluster", "$.node").alias("node"), "cluster_error").collect()
    assert [(r.node, r.cluster_error) for r in rows] == [
        ("n0", None), ("own", None), ("n1", None), ("n0", None), (None, "Not all tasks use the same cluster"),
        (None, "No cluster found for task"), (None, "No cluster found for task"), (None, "No cluster found for task"),
        (None, "No task found in job"),
    ]


def test_project_clusters(spark):
    rows = jobs(
        spark,
        [("a", None, "k0"), ("b", None, "k0"), ("c", None, "k1")],
        [("a", cluster("x", "p0"), None), ("b", None, "k0")],  # two paths for p0
        [("a", cluster("x"), None), ("b", None, "zz")],  # untagged stands under NULL; unresolved is left out
    )
    got = {tuple(r) for r in jb.project_job_clusters(rows).select(
        "job_id", "project_id", "path_kind", "path_key", at("cluster", "$.node")).collect()}
    assert got == {(0, "p0", "job_clusters", "k0", "n0"), (0, "p1", "job_clusters", "k1", "n1b"),
                   (2, None, "tasks", "a", "x")}
    fewer = {(r.job_id, r.project_id) for r in jb.project_job_clusters(rows, exclude=["b"]).select("job_id", "project_id").collect()}
    assert fewer == {(0, "p0"), (0, "p1"), (1, "p0"), (2, None)}


def test_targets(spark):
    rows = jobs(spark, [("a", None, "k0"), ("b", None, "k1")], [("a", cluster("x"), None)], [])
    asked = spark.createDataFrame([(0, "p1"), (0, "p9"), (1, "p9"), (2, "p9")], "job_id int, project_id string")
    got = {(r.job_id, r.project_id): (r.path_key, r.target_error) for r in jb.target_clusters(asked, rows).drop("cluster").collect()}
    assert got == {
        (0, "p1"): ("k1", None),
        (0, "p9"): (None, "Failed to locate cluster in job 0 for project p9"),
        (1, "p9"): ("a", None),
        (2, "p9"): (None, "Failed to locate cluster in job 2 for project p9"),
    }


def rewritten(spark, tasks, clusters=SHARED, **kw):
    rows = jb.single_clusters(jobs(spark, tasks, clusters=clusters)).withColumn("patch", parse_patch(F.lit('{"node":"new","deep":{"new":1}}')))
    rows = rows.withColumn("new", jb.recommended_definition(F.col("cluster"), F.col("patch"), 2))
    return json.loads(jb.rewrite_jobs(rows, "new", **kw).select(F.to_json("settings")).first()[0])


def changed(definition):
    out = {k: v for k, v in definition.items() if k != "num_workers"}
    return out | {"node": "new", "deep": definition["deep"] | {"new": 1}}


def test_rewriting_a_shared_cluster_moves_it_to_the_end(spark):
    """Nothing else of the job changes, whatever keys it has."""
    tasks = [("a", None, "k0"), ("b", None, "k0")]
    assert rewritten(spark, tasks) == settings(tasks, [SHARED[1], SHARED[2], ("k0", changed(SHARED[0][1]))])


def test_rewriting_an_inline_cluster_drops_its_name(spark):
    task = ("a", cluster("own", name="mine"), None)
    new = changed(task[1])
    assert rewritten(spark, [task], keep_name=True) == settings([("a", new, None)])
    assert rewritten(spark, [task]) == settings([("a", {k: v for k, v in new.items() if k != "cluster_name"}, None)])


def test_unusable_jobs_stay_as_they_are(spark):
    tasks = [("a", None, "k0"), ("b", None, "k1")]
    assert rewritten(spark, tasks) == settings(tasks)
    assert rewritten(spark, []) == settings([])


def test_a_job_without_shared_clusters_gets_the_new_definition(spark):
    """The only task defines its cluster inline and still names a key; there is no list to append to."""
    got = rewritten(spark, [("t", cluster("n"), "k9")], clusters=None)
    assert got["job_clusters"] == [{"job_cluster_key": "k9", "new_cluster": changed(cluster("n"))}]


def test_one_off_runs(spark):
    rows = jb.one_off_runs(jobs(
        spark, [("a", None, "k0")], [("a", None, "k1"), ("b", None, "k1")], [("a", None, "k0"), ("b", None, "k0")], [],
    )).orderBy("job_id").select("run_name", F.to_json("tasks").alias("tasks"), F.to_json("cluster").alias("cluster"), "error").collect()
    alone, unnamed, named, none = rows
    bare = {k: v for k, v in SHARED[0][1].items() if k != "cluster_name"}
    want = settings([("a", bare, None)])["tasks"]
    assert alone.cluster is None and json.loads(alone.tasks) == want and alone.run_name == "job"
    assert json.loads(unnamed.cluster) == SHARED[1][1] | {"cluster_name": "job", "autotermination_minutes": 10}
    assert json.loads(unnamed.tasks) == settings([("a", None, None), ("b", None, None)])["tasks"]
    kept = {k: v for k, v in SHARED[0][1].items() if k != "policy_id"}
    assert json.loads(named.cluster) == kept | {"autotermination_minutes": 10}
    assert none.error == "No task found in job" and none.tasks is None


def recommendations(spark):
    return spark.createDataFrame(
        [("r1", (json.dumps({"node": "new", "num_workers": 9, "deep": {"and": {"deeper": None}}}),)), ("r2", None), ("r3", (None,))],
        "id string, recommendation struct<configuration string>")


def test_job_updates(spark):
    """Whole definitions, and a row with its error for every request that fails."""
    rows = jobs(spark, [("a", None, "k0")], [("a", cluster("x"), None)], [("a", None, "k0")], [("a", None, "k0")])
    asked = spark.createDataFrame(
        [(0, "p0", "r1"), (1, "p9", "r1"), (2, "p0", "r2"), (3, "p0", "r3"), (7, "p0", "r1"), (0, "p0", "r9")],
        "job_id int, project_id string, recommendation_id string",
    )
    got = {(r.job_id, r.recommendation_id): r for r in job_updates(rows, recommendations(spark), asked).drop("definition").collect()}
    new = {"node": "new", "num_workers": 9}
    assert json.loads(got[0, "r1"].payload) == {"job_clusters": [{"job_cluster_key": "k0", "new_cluster": SHARED[0][1] | new | {
        "deep": {"er": ["n0"], "and": {"deeper": None}}}}]}
    assert json.loads(got[1, "r1"].payload) == {"tasks": [{"task_key": "a", "new_cluster": cluster("x") | new | {
        "deep": {"er": ["x"], "and": {"deeper": None}}}}]}
    assert {k: (r.payload, r.update_error) for k, r in got.items() if k not in ((0, "r1"), (1, "r1"))} == {
        (2, "r2"): (None, "Recommendation not found"), (3, "r3"): (None, "Recommendation configuration not found"),
        (7, "r1"): (None, "Failed to locate cluster in job 7 for project p0"), (0, "r9"): (None, "Recommendation not found")}


def test_whole_jobs_keep_everything_else(spark):
    rows = jobs(spark, [("a", None, "k0")], [("a", None, "k0"), ("b", None, "k1")], [("a", cluster("x"), None)])
    asked = spark.createDataFrame([(0, "r1"), (1, "r1"), (2, "r3")], "job_id int, recommendation_id string")
    got = {r.job_id: (json.loads(r.s), r.error) for r in recommended_jobs(rows, recommendations(spark), asked).select(
        "job_id", F.to_json("settings").alias("s"), "error").collect()}
    new = SHARED[0][1] | {"node": "new", "num_workers": 9, "deep": {"er": ["n0"], "and": {"deeper": None}}}
    assert got[0] == (settings([("a", None, "k0")], [SHARED[1], SHARED[2], ("k0", new)]), None)
    assert got[1] == (settings([("a", None, "k0"), ("b", None, "k1")]), "Not all tasks use the same cluster")
    assert got[2] == (settings([("a", cluster("x"), None)]), "Recommendation configuration not found")
    templates = spark.createDataFrame([("p", '{"custom_tags":{"owner":"me"}}')], "project_id string, template string")
    owners = spark.createDataFrame([(2, "p"), (0, "q")], "job_id int, project_id string")
    got = {r.job_id: (json.loads(r.s), r.error) for r in project_jobs(rows, templates, owners).select(
        "job_id", F.to_json("settings").alias("s"), "error").collect()}
    assert got[2] == (settings([("a", cluster("x") | {"custom_tags": {"owner": "me"}}, None)]), None) and got[0][1] == "no_template"


def test_clusters_of_a_job_need_no_shuffle(spark):
    rows = jobs(spark, [("a", None, "k0")])
    plan = jb.project_job_clusters(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan
