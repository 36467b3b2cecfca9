"""Several requests of one run, and requests for projects that don't exist."""

from fleetlens.plans.submit import recorded_runs


def test_requests_of_a_run_are_counted_apart(spark):
    """By project, and by path where two requests of a run differ in the path only."""
    requests = spark.createDataFrame(
        [(1, "p1", None), (1, "p2", ""), (1, None, None), (1, "gone", None), (2, "", None), (3, "p1", None), (1, "p1", "tasks/a"), (1, "p1", "tasks/b")],
        "run_id long, project_id string, cluster_path string")
    recorded = spark.createDataFrame(
        [(1, "p1", None, "c1", "s1"), (1, "p2", None, "c2", None), (1, None, None, "c1", "s1"), (1, None, None, "c2", None), (2, None, None, "c3", None),
         (1, "p1", "tasks/a", "c1", "s1"), (1, "p1", "tasks/b", "c4", None)],
        "run_id long, requested_project string, requested_path string, cluster_id string, submission_id string")
    projects = spark.createDataFrame([("p1",), ("p2",)], "project_id string")
    got = sorted((r.run_id, r.n_clusters, r.n_submitted, r.error or "") for r in recorded_runs(requests, recorded, projects).collect())
    failed = "Failed to submit run 1 to any projects"
    assert got == [
        (1, 0, 0, "Failed to retrieve project gone"), (1, 1, 0, failed), (1, 1, 0, failed), (1, 1, 1, ""), (1, 1, 1, ""), (1, 2, 1, ""),
        (2, 1, 0, "Failed to submit run 2 to any projects"), (3, 0, 0, "Failed to locate cluster in run 3 for project p1"),
    ]
