"""The registered queries: every operator run over the telemetry bindings of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens import schemas as sc
from fleetlens import sinks as sk
from fleetlens.bindings import Bindings
from fleetlens.functions import merge as mg
from fleetlens.functions import paths as pt
from fleetlens.functions import status as st
from fleetlens.functions import timefmt as tf
from fleetlens.operators import eventlog as lg
from fleetlens.operators import events as ev
from fleetlens.operators import instances as fl
from fleetlens.operators import jobs as jb
from fleetlens.operators import projects as pj
from fleetlens.operators import recommend as rc
from fleetlens.operators import reports as rp
from fleetlens.operators import tasks as tk
from fleetlens.operators import waits as wt
from fleetlens.operators import workspaces as wk
from fleetlens.plans import apply as ap
from fleetlens.plans import submit as sb
from fleetlens.session import scratch_dir
from fleetlens.sources import documents as dc
from fleetlens.sources import logs as ls
from fleetlens.streaming import logwaits as lw
from fleetlens.streaming import timelines as tl
from fleetlens.streaming import waits as sw
from fleetlens.streaming.replay import replay

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[Bindings], DataFrame]) -> Callable[[Bindings], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Bindings(spark, sf_dir))

    REGISTRY[fn.__name__] = run
    return fn


# -- runs, tasks and clusters -----------------------------------------------------------------------


def _resolved(b: Bindings) -> DataFrame:
    return tk.resolved_only(tk.resolve_clusters(tk.eligible_tasks(b.task), b.job_cluster))


@query
def eligible_tasks(b):
    return tk.eligible_tasks(b.task, exclude=["t7"]).select("run_id", "pos", "task_key", "cluster_id")


@query
def runs_all_success(b):
    return tk.runs_all_success(b.task)


@query
def task_cluster_resolved(b):
    rows = tk.resolve_clusters(b.task, b.job_cluster)
    return rows.select(
        "run_id", "pos", "cluster_path", "cluster_error",
        F.col("cluster.node_type_id").alias("node_type_id"),
        F.col("cluster.num_workers").alias("num_workers"),
        tk.project_of("cluster").alias("project_id"),
    )


@query
def cluster_paths(b):
    rows = _resolved(b)
    return rows.groupBy("run_id", "cluster_path").agg(F.count("*").alias("n_tasks"))


@query
def tasks_per_cluster(b):
    return tk.tasks_by_cluster(_resolved(b))


@query
def unambiguous_cluster_paths(b):
    return tk.unambiguous_paths(_resolved(b))


@query
def run_context_id(b):
    return tk.run_contexts(b.task)


@query
def run_end_time(b):
    return tk.run_end_times(b.task)


@query
def project_cluster_selection(b):
    return tk.select_project_clusters(tk.unambiguous_paths(_resolved(b)), b.request).drop("requested_project", "requested_path")


@query
def run_cluster_projects(b):
    rows = pj.join_projects(tk.unambiguous_paths(_resolved(b)), b.project)
    return rows.select("run_id", "cluster_path", "project_id", "project_model_id", "project_error")


# -- projects, submissions, recommendations ---------------------------------------------------------


@query
def projects_by_app(b):
    return pj.projects_by_app(b.project).select("project_id", "app_id", "project_model_id", "auto_apply_recs")


@query
def submissions_by_project(b):
    return b.submission.select("project_id", "id", "state", "created_at", F.col("configuration.node_type_id"))


@query
def recommendations_by_project(b):
    return b.recommendation.select(
        "project_id", "id", "state", "created_at", F.col("recommendation.configuration").alias("configuration")
    )


def _config_rows(df):
    return df.select(
        "project_id", "submission_id", F.col("configuration.node_type_id").alias("node_type_id"),
        F.col("configuration.num_workers").alias("num_workers"), "error",
    )


@query
def latest_submission_config(b):
    return _config_rows(pj.latest_submission_config(b.project, b.submission))


@query
def latest_success_submission(b):
    return _config_rows(pj.latest_submission_config(b.project, b.submission, success_only=True))


@query
def first_project_by_app(b):
    return pj.first_project_by_app(b.project)


@query
def resolved_project_ids(b):
    return pj.resolve_project_ids(b.project_reference, b.project)


@query
def latest_recommendation(b):
    return pj.latest_recommendation(b.project, b.recommendation)


@query
def recommendation_status(b):
    return b.recommendation.select("id", st.recommendation_class(F.col("state")).alias("status"))


@query
def project_eligibility(b):
    return pj.project_eligibility(b.project)


@query
def project_patch_merge(b):
    return pj.patch_projects(b.project, b.project_patch).select(
        "project_id", "description", "app_id", "auto_apply_recs", "optimize_instance_size"
    )


@query
def api_error_rows(b):
    rows = b.response.withColumn("error", st.api_error(F.col("error_code"), F.col("message")))
    return rows.select("response_id", "error.code", F.col("error.message").alias("error_message"))


@query
def response_consistency(b):
    error = st.api_error(F.col("error_code"), F.col("message"))
    return b.response.select("response_id", st.response_problem(F.col("result"), error).alias("problem"))


# -- workspaces and hosts ---------------------------------------------------------------------------


@query
def workspace_configs(b):
    return b.workspace.select("workspace_id", "databricks_host", "collection_type", "compute_provider", "aws_region")


@query
def workspace_patch_merge(b):
    return wk.patch_workspaces(b.workspace, b.workspace_patch).select(
        "workspace_id", "aws_region", "databricks_plan_type", "aws_iam_role_arn", "collection_type"
    )


@query
def workspace_violations(b):
    return wk.workspace_violations(b.workspace)


@query
def platform_from_host(b):
    platform = pt.platform_of(F.col("databricks_host"))
    return b.workspace.select("workspace_id", platform.alias("platform"), pt.product_code(platform).alias("product"))


@query
def normalized_host(b):
    return b.log_url.select("page_id", pt.normalized_host(F.col("url")).alias("host"))


@query
def eventlog_url_class(b):
    return b.log_url.select("page_id", pt.log_url_class(F.col("url")).alias("url_class"))


# -- fleet ------------------------------------------------------------------------------------------


@query
def ec2_instances(b):
    rows = fl.ec2_instances(b.instance)
    return rows.select("cluster_id", "instance_id", "state", mg.text_at(F.col("document"), "$.InstanceType").alias("type"))


@query
def ebs_volumes_for_instances(b):
    return fl.ebs_volumes(b.volume, fl.ec2_instances(b.instance))


@query
def azure_running_vms(b):
    rows = fl.azure_vms(b.vm, b.vm_view).withColumns({"platform": F.lit("azure"), "state": F.lit(None).cast("string")})
    return fl.running_only(rows).select("cluster_id", "instance_id", mg.text_at(F.col("document"), "$.hardwareProfile.vmSize").alias("size"))


@query
def running_instances(b):
    aws = fl.ec2_instances(b.instance).withColumn("platform", F.lit("aws"))
    azure = fl.azure_vms(b.vm, b.vm_view).withColumn("platform", F.lit("azure"))
    rows = aws.unionByName(azure, allowMissingColumns=True)
    return fl.running_only(rows).select("platform", "cluster_id", "instance_id")


@query
def fleet_counts(b):
    instances = fl.ec2_instances(b.instance)
    return fl.fleet_counts(instances, fl.ebs_volumes(b.volume, instances))


def _timeline_rows(df):
    return df.select(
        "cluster_id", "instance_id", F.unix_millis("first_seen").alias("first_seen_ms"),
        F.unix_millis("last_seen").alias("last_seen_ms"), "is_active",
    )


@query
def instance_timelines(b):
    return _timeline_rows(fl.instance_timelines(b.poll, b.observation))


@query
def timelines_all(b):
    rows = fl.instance_timelines(b.poll, b.observation)
    return _timeline_rows(fl.timelines_all(rows.filter(~F.col("is_active")), rows.filter("is_active")))


@query
def retired_instances(b):
    return fl.retired_at_poll(b.poll, b.observation).select(
        "cluster_id", "instance_id", F.unix_millis("retired_at").alias("retired_at_ms"),
        F.unix_millis("last_seen").alias("last_seen_ms"),
    )


@query
def inventory_latest(b):
    return fl.inventory_latest(b.sighting, ["seen_ms", "event_id"], ["seen_ms", "state"])


@query
def monitored_clusters(b):
    return _timeline_rows(fl.monitored_clusters(b.poll, b.observation))


@query
def monitor_step(b):
    newest = b.poll.groupBy("cluster_id").agg(F.max("poll_ts").alias("poll_ts"))
    earlier = b.poll.join(newest, ["cluster_id", "poll_ts"], "left_anti")
    now = b.observation.join(newest, ["cluster_id", "poll_ts"], "left_semi")
    before = b.observation.join(newest, ["cluster_id", "poll_ts"], "left_anti")
    return _timeline_rows(fl.monitor_step(fl.instance_timelines(earlier, before), newest, now))


# -- clusters, events and event logs ----------------------------------------------------------------


@query
def scan_clusters(b):
    rows = dc.parse_documents(b.cluster_text, "value", sc.CLUSTER)
    return rows.select(
        "cluster_id", "state", "spark_context_id", "node_type_id", "num_workers",
        F.col("cluster_log_conf.s3.destination").alias("s3"), F.col("cluster_log_conf.dbfs.destination").alias("dbfs"),
    )


@query
def cluster_state_class(b):
    return b.cluster.select("cluster_id", st.cluster_state_class(F.col("state")).alias("state_class"))


@query
def log_destination(b):
    return b.cluster.select("cluster_id", "log.url", "log.scheme", "log.bucket", "log.base")


@query
def telemetry_paths(b):
    rows = b.cluster.filter(F.col("log.base").isNotNull())
    return rows.select(
        "cluster_id",
        pt.eventlog_prefix(F.col("log.base"), F.col("cluster_id")).alias("log_prefix"),
        pt.info_file_key(F.col("log.base"), F.col("spark_context_id"), F.col("platform")).alias("info_key"),
        pt.dbfs_path(F.col("log.url")).alias("dbfs_url"),
        pt.dbfs_path(F.col("log.base")).alias("dbfs_base"),
    )


@query
def sink_routing(b):
    args = (F.col("platform"), F.col("log"), F.col("cluster_id"), F.col("spark_context_id"))
    rows = b.cluster.withColumn("plain", pt.sink_target(*args)).withColumn(
        "moved", pt.sink_target(*args, override_filesystem="file", override_prefix="/reports")
    )
    return rows.select(
        "cluster_id", "plain.filesystem", "plain.target", "plain.error",
        F.col("moved.target").alias("moved_target"), F.col("moved.error").alias("moved_error"),
    )


@query
def cluster_events_all(b):
    rows = ev.all_events(ev.union_pages(b.event_row))
    return rows.select("cluster_id", "seq", "page_no", "pos", "ts_ms", "type", "total_count")


@query
def redacted_events(b):
    kept = ev.redacted(F.col("parameters"))
    return b.event_row.select(
        "cluster_id", "page_no", "pos", F.array_join(F.sort_array(F.map_keys(kept)), ",").alias("keys"),
        F.try_element_at(kept, F.lit("k")).alias("k"),
    )


@query
def json_time_encodings(b):
    ts = F.col("ts")
    return b.time.select(
        "event_id", tf.iso_offset(ts.cast("timestamp")).alias("zoned"), tf.iso_naive(ts).alias("naive"),
        tf.iso_utc(ts).alias("utc"), tf.iso_utc(ts, fraction=False).alias("utc_seconds"),
    )


@query
def log_listing_by_prefix(b):
    rows = lg.files_by_prefix(b.object_key.select("key", "file_size", "mtime_ms"), b.log_owner)
    event = F.regexp_extract("key", "eventlog-([0-9]+)$", 1).cast("bigint")
    return rows.select(event.alias("event_id"), "cluster_id", "key", "file_size", "mtime_ms")


@query
def log_dir_by_context(b):
    return lg.log_dirs_by_context(b.log_context, b.log_entry).select("run_id", "spark_context_id", "log_dir", "log_error")


@query
def final_rollover_files(b):
    path = F.col("path")
    return b.listing.select(
        F.col("pos").alias("event_id"), pt.file_stem(path).alias("stem"), pt.is_final_log(path).alias("is_final")
    )


@query
def final_log_flushed(b):
    ends = b.listing.groupBy("dir", "poll_no").agg(F.max("run_end_ms").alias("run_end_ms"))
    rows = lg.poll_summaries(b.listing).join(ends, ["dir", "poll_no"])
    return rows.select("dir", "poll_no", lg.final_flushed(F.col("run_end_ms")).alias("flushed"))


@query
def log_size_changes(b):
    rows = lg.size_changes(lg.poll_summaries(b.listing))
    return rows.select("dir", "poll_no", "total_size", "last_size", "size_changed", "any_empty")


@query
def eventlog_completeness(b):
    return lg.completeness(b.log_target, b.listing).select("dir", "scheme", "poll_no", "verdict")


@query
def eventlog_ready_poll(b):
    return lg.ready_per_wait(b.log_target, b.listing).select("dir", "scheme", "ready_poll", "polls", "outcome")


@query
def eventlog_ready_per_run(b):
    return lg.ready_per_wait(b.log_wait, b.listing).select("dir", "nth", "scheme", "first_poll", "ready_poll", "polls", "outcome")


@query
def eventlog_bundle_manifest(b):
    return lg.bundle_manifest(b.log_wait, b.listing).select("dir", "nth", "poll_no", "path", "bundle_name", "file_size")


# -- jobs, definitions and recommendations ----------------------------------------------------------


def _definition_columns(definition: str):
    """A definition (VARIANT) flattened to scalar columns."""
    def at(path, kind):
        return F.try_variant_get(definition, path, kind)

    pairs = F.transform(
        F.map_entries(at("$.custom_tags", "map<string,string>")),
        lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null"))),
    )
    return [
        at("$.cluster_name", "string").alias("cluster_name"),
        at("$.node_type_id", "string").alias("node_type_id"),
        at("$.num_workers", "bigint").alias("num_workers"),
        at("$.autoscale.max_workers", "bigint").alias("max_workers"),
        F.array_join(F.sort_array(pairs), ";").alias("tags"),
        at("$.policy_id", "string").alias("policy_id"),
        F.array_join(at("$.init_scripts", "array<string>"), ",").alias("scripts"),
        at("$.cluster_log_conf.dbfs.destination", "string").alias("log_url"),
    ]


def _mode(definition: str):
    """A key of definitions that no operator knows."""
    return F.try_variant_get(definition, "$.data_security_mode", "string").alias("mode")


@query
def scan_run_tasks(b):
    rows = dc.run_tasks_of(dc.parse_documents(b.run_text, "value", sc.RUN))
    return rows.select(
        "run_id", "pos", "task_key", "job_cluster_key", "cluster_id", "spark_context_id", "result_state",
        "end_time_ms", F.col("new_cluster.node_type_id").alias("node_type_id"),
    )


@query
def scan_job_clusters(b):
    rows = dc.job_clusters_of(dc.parse_documents(b.job_text, "value", sc.JOB))
    return rows.select(
        "job_id", "pos", "job_cluster_key", F.col("new_cluster.node_type_id").alias("node_type_id"),
        F.col("new_cluster.num_workers").alias("num_workers"), tk.project_of("new_cluster").alias("project_id"),
    )


@query
def job_single_cluster(b):
    rows = jb.single_clusters(b.job)
    return rows.select("job_id", *_definition_columns("cluster"), "cluster_error")


@query
def job_project_clusters(b):
    rows = jb.project_job_clusters(b.job)
    return rows.select("job_id", "project_id", "path_kind", "path_key", *_definition_columns("cluster"))


@query
def recommendation_target(b):
    rows = jb.target_clusters(b.job_request, b.job)
    return rows.select("job_id", "project_id", "path_kind", "path_key", "target_error")


@query
def deep_merge_config(b):
    patches, depth = rc.parsed_patches(
        b.recommendation.select("id", F.col("recommendation.configuration").alias("configuration")), "configuration", "patch")
    shared = jb.job_parts(b.job, ["job_clusters"]).filter("section = 'job_clusters'").select("job_id", "pos", "definition")
    rows = shared.join(patches, shared.job_id == patches.id)
    merged = mg.merge_documents(F.col("definition"), F.col("patch"), depth)
    return rows.withColumn("merged", merged).select("job_id", "pos", *_definition_columns("merged"))


@query
def merged_documents(b):
    """Whole definitions with whole configurations merged in: nothing that a schema doesn't know is lost."""
    rows, depth = rc.parsed_patches(b.whole_document, "configuration", "patch")
    merged = rows.select("job_id", jb.recommended_definition(F.parse_json("definition"), F.col("patch"), depth).alias("d"))
    paths = {
        "node_type_id": "$.node_type_id", "num_workers": "$.num_workers", "max_workers": "$.autoscale.max_workers", "mode": "$.data_security_mode",
        "zone": "$.aws_attributes.zone_id", "profile": "$.aws_attributes.instance_profile_arn", "ebs": "$.aws_attributes.ebs_volume_size",
        "deep_b": "$.aws_attributes.deep.a.b", "deep_c": "$.aws_attributes.deep.a.c[0]", "image": "$.docker_image.url",
        "script": "$.init_scripts[0].workspace.destination", "script_added": "$.init_scripts[1].s3.destination",
        "tag_a": "$.custom_tags.a", "tag_b": "$.custom_tags.b",
    }
    return merged.select("job_id", *[F.try_variant_get("d", path, "string").alias(name) for name, path in paths.items()])


@query
def recommended_cluster_defs(b):
    latest = pj.latest_recommendation(b.project, b.recommendation)
    rows = rc.updated_definitions(b.project_definition, latest)
    return rows.select("project_id", *_definition_columns("definition"), "error")


@query
def definition_vs_recommendation(b):
    latest = pj.latest_recommendation(b.project, b.recommendation)
    rows = rc.definition_and_recommendation(b.project_definition, latest)
    return rows.select(
        "project_id", mg.text_at(F.col("cluster_definition"), "$.node_type_id").alias("node_type_id"), "cluster_recommendation", "error"
    )


def _job_part_rows(jobs):
    return jb.job_parts(jobs).select(
        "job_id", "section", "pos", "key", *_definition_columns("definition"), _mode("definition"),
        mg.text_at(F.col("part"), "$.notebook_task.notebook_path").alias("notebook"))


@query
def rewritten_jobs(b):
    return _job_part_rows(ap.recommended_jobs(b.job, b.recommendation, b.job_request))


@query
def project_jobs(b):
    return _job_part_rows(ap.project_jobs(b.job, b.template, b.job_owner))


@query
def job_update_payloads(b):
    rows = ap.job_updates(b.job, b.recommendation, b.job_request)

    def item(path):
        return F.get_json_object("payload", path)

    return rows.select(
        "job_id",
        item("$.job_clusters[0].job_cluster_key").alias("job_cluster_key"),
        item("$.job_clusters[0].new_cluster.node_type_id").alias("shared_node"),
        item("$.tasks[0].task_key").alias("task_key"),
        item("$.tasks[0].new_cluster.node_type_id").alias("inline_node"),
        F.coalesce(item("$.job_clusters[0].new_cluster.data_security_mode"), item("$.tasks[0].new_cluster.data_security_mode")).alias("mode"),
        F.col("update_error").alias("error"),
    )


@query
def one_off_payloads(b):
    rows = jb.one_off_runs(b.job)
    tasks, cluster = F.col("tasks"), F.col("cluster")
    return rows.select(
        "job_id", "run_name", F.coalesce(F.size(mg.items(tasks)), F.lit(0)).alias("n_tasks"),
        mg.text_at(tasks, "$[0].new_cluster.node_type_id").alias("inline_node"),
        mg.text_at(tasks, "$[0].new_cluster.cluster_name").alias("inline_name"),
        mg.text_at(cluster, "$.cluster_name").alias("cluster_name"),
        mg.text_at(cluster, "$.policy_id").alias("policy_id"),
        F.try_variant_get(cluster, "$.autotermination_minutes", "bigint").alias("autotermination_minutes"),
        F.coalesce(mg.text_at(cluster, "$.data_security_mode"), mg.text_at(tasks, "$[0].new_cluster.data_security_mode")).alias("mode"),
        F.array_join(F.transform(mg.items(tasks), lambda t: mg.text_at(t, "$.notebook_task.notebook_path")), ",").alias("notebooks"),
        "error",
    )


@query
def templated_clusters(b):
    rows = rc.templated(b.project_definition, "definition", b.template)
    return rows.select("project_id", *_definition_columns("definition"))


# -- waiting ----------------------------------------------------------------------------------------


@query
def run_final_state(b):
    return b.run_state.select("run_id", st.is_final_run_state(F.col("state")).alias("is_final"))


@query
def run_first_final_state(b):
    return wt.first_final_runs(b.run_status)


@query
def cluster_termination_outcome(b):
    return wt.cluster_terminations(b.cluster_state)


@query
def recommendation_first_final(b):
    states = F.when(F.col("state") == "FAILED", "FAILURE").otherwise(F.col("state"))
    return wt.first_final_recommendations(
        b.run_status.withColumnRenamed("run_id", "recommendation_id").withColumn("state", states)
    )


# -- cluster information, reports and submissions ---------------------------------------------------


@query
def cluster_info_fallback(b):
    rows = rp.cluster_info(b.run_cluster, b.info_header, b.info_item)
    return rows.select("cluster_id", "source", "n_instances", "n_instance_timelines", "n_volumes")


def _checked_info(b):
    info = rp.cluster_info(b.run_cluster, b.info_header, b.info_item)
    # Clusters in their run's last slot may be reported without instances.
    return rp.completeness(info, F.col("cluster_id").endswith("-c2"))


@query
def report_completeness(b):
    return _checked_info(b).select(
        "cluster_id", "instances_missing", "timelines_missing", "volumes_missing", "info_error"
    )


@query
def cluster_reports(b):
    return rp.cluster_reports(_checked_info(b), b.run_cluster_event, "Standard", "Jobs Compute")


@query
def report_json(b):
    doc = F.struct("cluster_id", "state", "num_workers", F.struct("log.url", "log.bucket").alias("log"))
    return b.cluster.select("cluster_id", rp.without_nulls(doc).alias("report"))


def _info_documents(b):
    cluster = F.col("cluster_id")
    clusters = b.poll.select("cluster_id").distinct().select(
        "cluster_id",
        F.when(cluster != 3, cluster * 1000 + 7).alias("spark_context_id"),
        (cluster != 4).alias("writable"),
    )
    instances = fl.inventory_latest(b.sighting, ["seen_ms", "event_id"], ["seen_ms", "state"])
    volumes = fl.ebs_volumes(b.volume, fl.ec2_instances(b.instance)).withColumn(
        "cluster_id", F.col("cluster_id").cast("bigint")
    )
    return rp.info_documents(clusters, {
        "instances": instances,
        "instance_timelines": fl.instance_timelines(b.poll, b.observation),
        "volumes": volumes,
    })


@query
def cluster_info_documents(b):
    return rp.section_counts(_info_documents(b), ["cluster_id", "spark_context_id"])


@query
def submission_rows(b):
    selected = tk.select_project_clusters(tk.unambiguous_paths(_resolved(b)), b.request)
    rows = selected.join(b.run_cluster, "cluster_id", "left")
    return rp.submissions(rows, pt.product_code(F.col("platform")))


# -- workflows --------------------------------------------------------------------------------------


@query
def cluster_report_for_run(b):
    return sb.cluster_reports_for_runs(b.telemetry, b.request, "Standard", "Jobs Compute")


@query
def submission_for_run(b):
    return sb.submissions_for_runs(b.telemetry, b.request).drop("platform")


@query
def submission_report_items(b):
    """Submissions are written first, so their content is gathered from the stored table."""
    path = scratch_dir(b.spark, "submissions")
    made = sb.submissions_for_runs(b.telemetry, b.request).filter(F.col("submission_id").isNotNull())
    sk.write_submissions(made, path)
    items = sb.submission_items(b.telemetry, b.spark.read.schema(made.schema).parquet(path))
    return items.groupBy("submission_id", "section").agg(
        F.count("*").alias("n_items"), F.min("item").alias("first_item"), F.max("item").alias("last_item")
    )


@query
def submission_with_cluster_info(b):
    return sb.submissions_with_info(b.telemetry, b.info_request)


@query
def record_runs(b):
    return sb.recorded_clusters(b.telemetry, b.request).select(
        "run_id", "project_id", "cluster_id", "submission_id", "error"
    )


@query
def record_run_summary(b):
    return sb.recorded_runs(b.request, sb.recorded_clusters(b.telemetry, b.request), b.project)


@query
def record_finished_runs(b):
    return sb.recorded_finished_runs(b.telemetry, b.request, b.run_outcome)


@query
def handle_successful_runs(b):
    rows = ap.handled_runs(b.telemetry, b.request)
    node = F.coalesce(
        F.get_json_object("payload", "$.job_clusters[0].new_cluster.node_type_id"),
        F.get_json_object("payload", "$.tasks[0].new_cluster.node_type_id"),
    )
    mode = F.coalesce(
        F.get_json_object("payload", "$.job_clusters[0].new_cluster.data_security_mode"),
        F.get_json_object("payload", "$.tasks[0].new_cluster.data_security_mode"),
    )
    return rows.select(
        "run_id", "job_id", "project_id", "submission_id", "recommendation_id", "apply_status", "path_key",
        node.alias("new_node"), mode.alias("mode"), "error",
    )


@query
def apply_recommendations(b):
    rows = ap.job_updates(b.job, b.recommendation, b.job_request)
    return rows.select("job_id", "project_id", "path_kind", "path_key", *_definition_columns("definition"), _mode("definition"),
                       F.col("update_error").alias("error"))


# -- written and read back --------------------------------------------------------------------------


@query
def scan_cluster_info(b):
    """Cluster-info documents through the sink and back; the documents of every other cluster are written twice."""
    path = scratch_dir(b.spark, "cluster-info")
    documents = _info_documents(b)
    sk.write_cluster_info(documents, path)
    sk.write_cluster_info(documents.filter("cluster_id % 2 = 0"), path)
    return rp.section_counts(sk.read_cluster_info_items(b.spark, path), ["cluster_id", "spark_context_id"])


@query
def delivered_documents(b):
    """Cluster-info documents as an override sends them: to a user's function, and under another prefix."""
    place = scratch_dir(b.spark, "delivered")
    rows = _info_documents(b).withColumn("cluster_id", F.col("cluster_id").cast("string"))
    usual = sk.Destination("s3", "s3://logs/reports")

    def own(documents):
        documents.write.parquet(f"{place}/function")

    for via, override in (("function", {"filesystem": "lambda", "write_function": own}), ("path", {"filesystem": "file", "base_prefix": f"{place}/path"})):
        sk.deliver(rows, usual.overridden(override), lambda documents, prefix: documents.write.parquet(prefix))
    sent = [b.spark.read.schema(rows.schema).parquet(f"{place}/{via}").withColumn("via", F.lit(via)) for via in ("function", "path")]
    return rp.section_counts(sent[0].unionByName(sent[1]), ["via", "cluster_id", "spark_context_id"])


@query
def read_log_lines(b):
    """Texts as gzipped log bundles, one folder per source, and their lines read back."""
    path = scratch_dir(b.spark, "logs")
    sk.write_log_bundle(b.raw("documents").select("source", F.col("text").alias("line")), ["source"], path)
    source = F.regexp_extract("path", "/source=([^/]+)/", 1)
    return ls.read_log_lines(b.spark, path).groupBy(source.alias("source")).agg(
        F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("n_chars")
    )


# -- streams ----------------------------------------------------------------------------------------


def _poll_stream_rows(b):
    us = F.unix_micros("poll_ts").alias("poll_us")
    cluster = F.col("cluster_id").cast("string").alias("cluster_id")
    seen = b.observation.join(b.poll.select("cluster_id", "poll_ts", "ok", "state"), ["cluster_id", "poll_ts"])
    heartbeats = b.poll.select(cluster, us, F.lit(None).cast("string").alias("instance_id"), "ok", "state")
    sightings = seen.select(cluster, us, F.col("instance_id").cast("string").alias("instance_id"), "ok", "state")
    return heartbeats.unionByName(sightings)


def _stream_timeline_rows(updates):
    rows = tl.current_timelines(updates)
    return rows.select(
        F.col("cluster_id").cast("bigint").alias("cluster_id"), F.col("instance_id").cast("bigint").alias("instance_id"),
        F.floor(F.col("first_us") / 1000).alias("first_seen_ms"),
        F.floor(F.col("last_us") / 1000).alias("last_seen_ms"), "is_active",
    )


@query
def instance_timelines_stream(b):
    rows = _poll_stream_rows(b).withColumn("ok", F.lit(True))
    return _stream_timeline_rows(replay(rows, tl.timeline_updates, "timelines", "poll_us"))


@query
def monitored_clusters_stream(b):
    def monitor(polls):
        return tl.timeline_updates(polls, stop_on_termination=True)

    return _stream_timeline_rows(replay(_poll_stream_rows(b), monitor, "monitor", "poll_us"))


@query
def eventlog_ready_stream(b):
    """Three waits per directory, each announced half a day before its first poll; a poll a day; waits end after 20 days and a quarter."""
    def day(n):
        return F.timestamp_seconds((F.lit(20_000) + n) * 86_400)

    first = F.col("first_poll")
    waits = b.log_wait.select(
        "dir", F.col("nth").cast("bigint").alias("run_id"), "scheme", "run_end_ms", "first_poll", day(first + 20.25).alias("deadline"), day(first - 0.5).alias("at"))
    looks = lg.poll_summaries(b.listing).withColumn("at", day(F.col("poll_no")))
    rows = lw.wait_rows(waits).unionByName(lw.look_rows(looks))
    ended = replay(rows, lw.ready_logs, "ready-logs", "at")
    return ended.select("dir", F.col("run_id").cast("int").alias("nth"), "poll_no", "outcome")


@query
def run_first_final_stream(b):
    """Ended runs from the stream; the others from the table of runs."""
    rows = b.run_status.withColumn("ts", F.unix_micros("ts"))
    ended = replay(rows, sw.final_runs, "final-runs", "ts")
    return rows.select("run_id").distinct().join(ended, "run_id", "left").select("run_id", "state", "error")


@query
def cluster_termination_stream(b):
    return replay(b.cluster_state, sw.terminations, "terminations", "seen_s").select("cluster_id", "outcome")


@query
def recommendation_first_final_stream(b):
    rows = b.run_status.select(
        F.col("run_id").alias("recommendation_id"), F.unix_micros("ts").alias("ts"), "seq",
        F.when(F.col("state") == "FAILED", "FAILURE").otherwise(F.col("state")).alias("state"),
    )
    return replay(rows, sw.final_recommendations, "final-recommendations", "ts").select("recommendation_id", "outcome")
