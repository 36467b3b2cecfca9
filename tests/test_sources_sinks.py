"""Readers of documents, listings and logs; writers and their repetition."""

import gzip
import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from fleetlens import sinks as sk
from fleetlens.operators import reports as rp
from fleetlens.session import scratch_dir
from fleetlens.sources import documents as dc
from fleetlens.sources import logs as ls


def lines(path, *docs):
    path.write_text("\n".join(json.dumps(d) for d in docs))
    return str(path)


RUN = {
    "run_id": 1, "state": {"result_state": "SUCCESS"},
    "tasks": [
        {"task_key": "a", "job_cluster_key": "k", "end_time": 5, "state": {"result_state": "SUCCESS"},
         "cluster_instance": {"cluster_id": "c", "spark_context_id": "8637481617925571639"}},
        {"task_key": "b", "new_cluster": {"node_type_id": "n", "custom_tags": {"sync:project-id": "p"}}, "state": {},
         "cluster_instance": {"cluster_id": "d", "spark_context_id": "not a number"}},
    ],
    "job_clusters": [{"job_cluster_key": "k", "new_cluster": {"num_workers": 3, "unknown": 1}}],
}


def test_runs(spark, tmp_path):
    path = lines(tmp_path / "runs.json", RUN, {"run_id": 2}, {"error_code": "404", "message": "gone"})
    tasks = {(r.run_id, r.task_key): r for r in dc.read_run_tasks(spark, path).filter("run_id IS NOT NULL").collect()}
    assert set(tasks) == {(1, "a"), (1, "b"), (2, None)}
    a, b = tasks[1, "a"], tasks[1, "b"]
    assert (a.pos, a.spark_context_id, a.end_time_ms, a.result_state) == (0, 8637481617925571639, 5, "SUCCESS")
    assert (b.spark_context_id, b.result_state, b.new_cluster.node_type_id) == (None, None, "n")
    shared = dc.read_run_job_clusters(spark, path).collect()
    assert [(r.run_id, r.pos, r.job_cluster_key, r.new_cluster.num_workers) for r in shared] == [(1, 0, "k", 3)]


def test_jobs_clusters_and_events(spark, tmp_path):
    job = {"job_id": 3, "settings": {"name": "j", "tasks": RUN["tasks"], "job_clusters": RUN["job_clusters"]}}
    jobs = dc.read_jobs(spark, lines(tmp_path / "jobs.json", job, {"job_id": 4, "settings": {"name": "k"}}))
    assert [(r.job_id, r.task_key) for r in dc.job_tasks_of(jobs).orderBy("job_id", "pos").collect()] == [
        (3, "a"), (3, "b"), (4, None)
    ]
    assert [r.job_cluster_key for r in dc.job_clusters_of(jobs).collect()] == ["k"]
    cluster = {"cluster_id": "c", "spark_context_id": 8637481617925571639, "cluster_log_conf": {"s3": {"destination": "s3://b"}}}
    got = dc.read_clusters(spark, lines(tmp_path / "clusters.json", cluster)).first()
    assert (got.spark_context_id, got.cluster_log_conf.s3.destination) == (8637481617925571639, "s3://b")
    page = {"cluster_id": "c", "page_no": 0, "total_count": 2, "events": [
        {"timestamp": 2, "type": "x", "details": {"reason": {"parameters": {"k": "v"}}}}, {"timestamp": 1, "type": "y"}]}
    events = dc.read_cluster_events(spark, lines(tmp_path / "pages.json", page)).collect()
    assert [(r.pos, r.type, r.parameters) for r in events] == [(0, "x", {"k": "v"}), (1, "y", None)]


def test_tables_of_the_other_documents(spark, tmp_path):
    doc = lines(tmp_path / "x.json", {"project_id": "p", "workspace_id": "w", "id": "i", "name": "m", "Volumes": [{"VolumeId": "v"}], "value": [{"name": "m"}],
                                      "Reservations": [{"Instances": [{"InstanceId": "j"}]}]})
    assert dc.read_projects(spark, doc).first().project_id == "p"
    assert dc.read_workspaces(spark, doc).first().workspace_id == "w"
    assert dc.read_volumes(spark, doc).first().VolumeId == "v"
    assert dc.read_vms(spark, doc).first().vm_name == "m"
    assert (dc.read_vm_views(spark, doc).first().vm_name, dc.read_vm_views(spark, doc).first().statuses) == ("m", None)
    assert dc.read_submissions(spark, doc).first().id == "i"
    assert dc.read_recommendations(spark, doc).first().id == "i"
    assert [r.InstanceId for r in dc.read_instances(spark, doc).collect()] == ["j"]


def test_snapshots_of_both_clouds(spark, tmp_path):
    for cloud, key, context in (("aws", "instance_timelines", 11), ("azure", "timelines", 12)):
        folder = tmp_path / "c" / "sync_data" / str(context)
        folder.mkdir(parents=True)
        doc = {"instances": [{"InstanceId": "i"}], key: [{"instance_id": "i", "first_seen_running_time": "t"}]}
        (folder / f"{cloud}_cluster_info.json").write_text(json.dumps(doc, indent=1))
    got = {r.platform: r for r in dc.read_cluster_info(spark, str(tmp_path)).collect()}
    assert {p: r.spark_context_id for p, r in got.items()} == {"aws": 11, "azure": 12}
    assert all(r.instance_timelines[0].instance_id == "i" for r in got.values())


def test_listings_and_log_lines(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "eventlog").write_text("one\ntwo\n")
    with gzip.open(tmp_path / "d" / "eventlog-1.gz", "wt") as f:
        f.write("three\n")
    listed = ls.list_files(spark, str(tmp_path)).collect()
    assert {r.path.rsplit("/", 1)[1] for r in listed} == {"eventlog", "eventlog-1.gz"}
    assert {r.file_size for r in listed if r.path.endswith("eventlog")} == {8} and all(r.mtime_ms > 0 for r in listed)
    got = {(r.path.rsplit("/", 1)[1], r.line) for r in ls.read_log_lines(spark, str(tmp_path)).collect()}
    assert got == {("eventlog", "one"), ("eventlog", "two"), ("eventlog-1.gz", "three")}
    stored = lines(tmp_path / "listing.json", {"dir": "d", "poll_no": 1, "path": "d/x", "file_size": 3})
    assert ls.read_listing(spark, stored).first().file_size == 3


def test_bundles_are_gzipped_per_directory(spark, tmp_path):
    rows = spark.createDataFrame([("c", 1, "x"), ("c", 1, "y"), ("d", 2, "z")], "cluster_id string, context int, line string")
    sk.write_log_bundle(rows, ["cluster_id", "context"], f"{tmp_path}/out")
    files = list((tmp_path / "out" / "cluster_id=c" / "context=1").glob("*.gz"))
    assert sorted("".join(gzip.open(f, "rt").read() for f in files).split()) == ["x", "y"]


def info(spark, *clusters):
    rows = spark.createDataFrame(clusters, "cluster_id string, spark_context_id bigint, writable boolean")
    seen = spark.createDataFrame([(c[0], "i") for c in clusters], "cluster_id string, instance_id string")
    return rp.info_documents(rows, {"instances": seen, "volumes": seen.limit(0)})


def test_cluster_info_replaces_only_its_clusters(spark, tmp_path):
    path = f"{tmp_path}/info"
    sk.write_cluster_info(info(spark, ("a", 1, True), ("b", 2, True), ("c", None, True), ("d", 4, False)), path)
    sk.write_cluster_info(info(spark, ("b", 2, True)), path)
    got = sk.read_cluster_info_items(spark, path).collect()
    assert {(r.cluster_id, r.spark_context_id, r.section, r.item) for r in got} == {
        ("a", 1, "instances", '{"instance_id":"i"}'), ("b", 2, "instances", '{"instance_id":"i"}')
    }
    assert len(got) == 2


def documents(spark, clusters, seen):
    rows = spark.createDataFrame(clusters, "cluster_id string, spark_context_id bigint, writable boolean")
    return rp.info_documents(rows, {"instances": spark.createDataFrame(seen, "cluster_id string, instance_id string")})


def stored(spark, path):
    return sorted((r.cluster_id, r.spark_context_id, json.loads(r.item)["instance_id"]) for r in sk.read_cluster_info_items(spark, path).collect())


def test_an_emptied_document_replaces_its_old_one(spark, tmp_path):
    path = f"{tmp_path}/info"
    both = [("a", 1, True), ("b", 2, True)]
    assert stored(spark, path) == []
    assert sk.write_cluster_info(documents(spark, both, [("a", "x"), ("a", "y"), ("b", "z")]), path) == 0
    assert sk.write_cluster_info(documents(spark, both[:1], [("b", "other")]), path) == 1
    assert stored(spark, path) == [("b", 2, "z")]
    assert sk.write_cluster_info(documents(spark, both[:1], [("a", "x")]), path, version=1) == 1  # the same batch again
    assert stored(spark, path) == [("a", 1, "x"), ("b", 2, "z")]
    assert sorted(p.name for p in (tmp_path / "info" / "documents").iterdir()) == ["version=0", "version=1"]


def test_half_written_versions_do_not_count_and_compaction_keeps_all(spark, tmp_path):
    path = f"{tmp_path}/info"
    sk.write_cluster_info(documents(spark, [("a", 1, True), ("b", 2, True)], [("a", "x"), ("b", "z")]), path)
    sk.write_cluster_info(documents(spark, [("b", 2, True)], []), path)
    # A write that died before its commit.
    documents(spark, [("a", 1, True)], [("a", "lost")]).write.parquet(f"{path}/documents/version=2")
    assert stored(spark, path) == [("a", 1, "x")]
    assert sk.compact_cluster_info(spark, path) == 2 and stored(spark, path) == [("a", 1, "x")]
    sk.write_cluster_info(documents(spark, [("b", 2, True)], [("b", "new")]), path)
    assert stored(spark, path) == [("a", 1, "x"), ("b", 2, "new")]


def test_submissions_are_written_once(spark, tmp_path):
    rows = spark.createDataFrame([(1, "p", "c"), (2, "p", "d")], "run_id int, project_id string, cluster_id string")
    made = rp.submissions(rows, F.lit("aws-databricks"))
    sk.write_submissions(made.filter("run_id = 1"), f"{tmp_path}/s")
    sk.write_submissions(made, f"{tmp_path}/s")
    sk.write_submissions(made, f"{tmp_path}/s")
    assert sorted(r.run_id for r in spark.read.parquet(f"{tmp_path}/s").collect()) == [1, 2]


def test_destinations(spark, tmp_path):
    rows = spark.range(3)
    plain = sk.Destination("s3", "s3://bucket/path")
    assert plain.overridden(None) == plain
    moved = plain.overridden({"filesystem": "file", "base_prefix": f"{tmp_path}/x"})
    assert (moved.filesystem, moved.prefix) == ("file", f"{tmp_path}/x")
    sk.deliver(rows, moved, sk.write_json)
    assert spark.read.schema("id bigint").json(f"{tmp_path}/x").count() == 3
    seen = []
    sk.deliver(rows, plain.overridden({"filesystem": "lambda", "write_function": lambda df: seen.append(df.count())}),
               sk.write_json)
    assert seen == [3]
    with pytest.raises(ValueError, match="Unsupported filesystem: ftp"):
        sk.deliver(rows, plain.overridden({"filesystem": "ftp"}), sk.write_json)
    with pytest.raises(ValueError, match="missing cluster log destination"):
        sk.deliver(rows, sk.Destination("s3", None), sk.write_json)
    with pytest.raises(ValueError, match="write_function"):
        sk.deliver(rows, sk.Destination("lambda", None), sk.write_json)


class Session:
    """The two settings of a session that choosing a scratch folder reads."""

    def __init__(self, master, folder):
        self.sparkContext = SimpleNamespace(master=master)
        self.conf = SimpleNamespace(get=lambda name, default: folder if name == "spark.checkpoint.dir" else default)


def test_scratch_folders_follow_the_setting():
    shared = Session("yarn", "hdfs://shared/tmp/")
    first, second = scratch_dir(shared, "x"), scratch_dir(shared, "x")
    assert first.startswith("hdfs://shared/tmp/x-") and first != second
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session("yarn", None), "x")
    assert "fleetlens-" in scratch_dir(Session("local[2]", None), "x")


def test_projects_as_delivered(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"id": "p1", "app_id": "a"}\n{"project_id": "p2"}\n')
    got = dc.read_projects(spark, str(tmp_path))
    assert sorted(r.project_id for r in got.collect()) == ["p1", "p2"] and "id" not in got.columns
