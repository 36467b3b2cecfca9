"""From requested runs to cluster reports and submissions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.functions.lookup import left_lookup
from fleetlens.functions.status import check_envelope
from fleetlens.operators import eventlog, reports, tasks, waits
from fleetlens.operators.projects import look_up_projects, project_error
from fleetlens.plans.telemetry import Telemetry


def resolved_tasks(t: Telemetry, exclude: Iterable[str] | None = None) -> DataFrame:
    eligible = tasks.eligible_tasks(t.tasks, exclude)
    return tasks.resolved_tags(eligible, t.job_clusters)


def selected_clusters(t: Telemetry, requests: DataFrame, exclude: Iterable[str] | None = None) -> DataFrame:
    """Selected clusters of the requested runs with their task count, end time and Spark context."""
    paths = tasks.unambiguous_paths_with_facts(resolved_tasks(t, exclude))
    return tasks.with_context(tasks.select_project_clusters(paths, requests))


def located_requests(t: Telemetry, requests: DataFrame, exclude: Iterable[str] | None = None) -> DataFrame:
    """One row per request: its one cluster, or why none (:func:`located_error`). A request without project needs a single
    tagged cluster in its run."""
    paths = tasks.unambiguous_paths_with_facts(resolved_tasks(t, exclude))
    rows = tasks.located_context(tasks.locate_clusters(paths, requests))
    known = t.projects.select(F.col("project_id").alias("requested_project"), F.lit(True).alias("_known"))
    unknown = F.col("requested_project").isNotNull() & F.col("_known").isNull()
    return left_lookup(rows, known, "requested_project", ["run_id"]).withColumn("_unknown", unknown).drop("_known")


def located_error() -> Column:
    """Why a row of :func:`located_requests` has no cluster, or none that counts. Texts are made last, so that no shuffle carries them."""
    return F.when(
        F.col("_unknown"), F.concat(F.lit("Failed to retrieve project "), F.col("requested_project"))
    ).when(F.col("cluster_id").isNull(), tasks.locate_error(F.col("run_id"), F.col("requested_project")))


def with_report(t: Telemetry, rows: DataFrame, allow_incomplete: bool, *places: Column) -> DataFrame:
    """Add the report header of each row's cluster and what :func:`report_error` reads; also ``places``, columns of the clusters.

    There are more clusters than rows here. They are joined by merge: a guess from file sizes would gather them on the driver.
    """
    done = waits.cluster_terminations(t.cluster_states)
    info = reports.cluster_info(t.clusters, t.info_headers, t.info_items)
    checked = reports.completeness(info, F.lit(allow_incomplete))
    counted = t.cluster_events.groupBy("cluster_id").agg(F.count("*").alias("n_events"))
    known = checked.join(done.hint("merge"), "cluster_id", "left").join(counted.hint("merge"), "cluster_id", "left")
    if places:
        known = known.join(t.clusters.select("cluster_id", *places).hint("merge"), "cluster_id")
    # Whether there is an error travels on, not its text.
    known = known.withColumn("_lacking", F.col("info_error").isNotNull()).drop("info_error")
    joined = left_lookup(rows, known.hint("merge"), "cluster_id", ["run_id"]).withColumn("_ending", F.coalesce("outcome", F.lit("waiting"))).drop("outcome")
    return joined.withColumns(reports.report_columns()).withColumn("n_events", F.coalesce("n_events", F.lit(0)))


def report_error() -> Column:
    """The error of a row of :func:`with_report`: termination first, then information."""
    ended = F.when(F.col("_ending") != "ok", F.col("_ending"))
    lacking = F.when(F.col("_lacking"), reports.info_message())
    return F.when(F.col("cluster_id").isNotNull(), F.coalesce(ended, lacking))


def cluster_reports_for_runs(
    t: Telemetry,
    requests: DataFrame,
    plan_type: str,
    compute_type: str,
    allow_incomplete: bool = False,
    exclude: Iterable[str] | None = None,
) -> DataFrame:
    """One report header, or error, per requested run."""
    check_envelope(plan_type, compute_type)
    rows = with_report(t, located_requests(t, requests, exclude), allow_incomplete)
    error = F.coalesce(located_error(), report_error())
    ok = error.isNull()
    parts = ["cluster_id", "n_tasks", "n_instances", "n_timelines", "n_volumes", "n_events"]
    return rows.select(
        "run_id", "requested_project",
        F.lit(plan_type).alias("plan_type"), F.lit(compute_type).alias("compute_type"),
        *[F.when(ok, F.col(c)).alias(c) for c in parts],
        error.alias("error"),
    )


def log_places() -> list[Column]:
    """The columns of clusters that :func:`with_log` reads of rows."""
    return [F.col("log_dir").alias("dir"), F.col("log_scheme").alias("scheme"), F.col("log_first_poll").alias("first_poll")]


def with_log(t: Telemetry, rows: DataFrame) -> DataFrame:
    """Add ``log_error`` from waiting for the event log of each row's cluster and Spark context; ``rows`` have the :func:`log_places` of their cluster.

    Each cluster is a wait of its own, whose polls count from ``first_poll``, however many clusters log to its directory.
    """
    waited = eventlog.ready_per_wait(rows.withColumn("run_end_ms", F.col("end_time_ms")), t.listing, spread=["run_id"])
    # Without a usable context id a DBFS directory cannot be told; S3 listings do not need it.
    needs_context = (F.col("scheme") == "dbfs") & F.col("context_error").isNotNull()
    error = F.when(needs_context, F.col("context_error")).when(F.col("outcome") != "ready", F.col("outcome"))
    return waited.withColumn("log_error", F.when(F.col("cluster_id").isNotNull(), error)).drop(
        "run_end_ms", "dir", "scheme", "first_poll", "ready_poll", "polls", "outcome"
    )


def _submitted(rows: DataFrame, error: Column, platform: str = "platform") -> DataFrame:
    product = F.when(F.col(platform) == "azure", K.PRODUCT_CODES["azure"]).otherwise(K.PRODUCT_CODES["aws"])
    ident = reports.submission_id(F.col("run_id"), F.col("project_id"), F.col("cluster_id"))
    return rows.withColumn("error", error).withColumns({
        "submission_id": F.when(F.col("error").isNull(), ident),
        "product": F.when(F.col("error").isNull(), product),
    })


def submissions_for_runs(
    t: Telemetry, requests: DataFrame, allow_incomplete: bool = False, exclude: Iterable[str] | None = None
) -> DataFrame:
    """One submission, or error, per requested (run, project)."""
    wanted = requests.filter(F.nullif("project_id", F.lit("")).isNotNull())
    rows = with_log(t, with_report(t, located_requests(t, wanted, exclude), allow_incomplete, *log_places()))
    done = _submitted(rows, F.coalesce(located_error(), report_error(), F.col("log_error")))
    return done.select("run_id", "requested_project", "cluster_id", "platform", "product", "submission_id", "error")


def submission_items(t: Telemetry, submitted: DataFrame, exclude: Iterable[str] | None = None) -> DataFrame:
    """The report content of the accepted ones among :func:`submissions_for_runs`."""
    accepted = submitted.filter(F.col("submission_id").isNotNull())
    return reports.submission_items(
        accepted, resolved_tasks(t, exclude), t.cluster_events, t.info_headers, t.info_items
    )


def submissions_with_info(t: Telemetry, requests: DataFrame) -> DataFrame:
    """Submissions whose report parts are supplied: the cluster is located, its event log looked at once.

    ``requests`` may have ``skip_eventlog`` and ``known_size`` (total log size seen before). Only a missing or
    incomplete log is fatal; other log problems give a submission without log.
    """
    wanted = requests.filter(F.nullif("project_id", F.lit("")).isNotNull())
    options = wanted.select(
        F.col("run_id").alias("_run"), F.col("project_id").alias("_project"),
        F.nullif("cluster_path", F.lit("")).alias("_path"), "skip_eventlog", "known_size",
    ).distinct()
    # A request is its run, project and path; two requests of a run may differ in one of them only.
    asked = (
        (F.col("run_id") == F.col("_run")) & (F.col("requested_project") == F.col("_project"))
        & F.nullif("requested_path", F.lit("")).eqNullSafe(F.col("_path"))
    )
    places = t.clusters.select("cluster_id", "platform", F.col("log_dir").alias("dir"),
                               F.col("log_scheme").alias("scheme"))
    newest = eventlog.poll_summaries(t.listing).groupBy("dir").agg(
        F.max_by(F.struct("total_size", "any_empty", "final_mtime_ms"), "poll_no").alias("_look")
    ).select("dir", "_look.*", F.lit(True).alias("_listed"))
    rows = located_requests(t, wanted).join(options, asked).drop("_run", "_project", "_path")
    rows = (
        left_lookup(left_lookup(rows, places.hint("merge"), "cluster_id"), newest.hint("merge"), "dir")
        .withColumn("size_changed", F.col("total_size") != F.coalesce("known_size", F.lit(0)))
    )
    seen = eventlog.verdict(F.col("scheme"), F.col("end_time_ms"), F.coalesce("_listed", F.lit(False)))
    needs_context = (F.col("scheme") == "dbfs") & F.col("context_error").isNotNull()
    verdict = F.when(F.col("skip_eventlog"), "skipped").when(needs_context, F.col("context_error")).otherwise(seen)
    fatal = F.when(F.col("verdict") == K.LOG_INCOMPLETE, F.col("verdict"))
    done = _submitted(rows.withColumn("verdict", verdict), F.coalesce(located_error(), fatal))
    has_log = F.when(F.col("error").isNull(), F.col("verdict") == "complete")
    return done.select(
        "run_id", "requested_project", "cluster_id", "submission_id", has_log.alias("has_log"), "error"
    )


def recorded_rows(
    t: Telemetry, requests: DataFrame, allow_incomplete: bool = False, exclude: Iterable[str] | None = None
) -> DataFrame:
    """The rows of :func:`recorded_clusters` before :func:`as_recorded` makes ids and texts, for plans that move them further."""
    selected = selected_clusters(t, requests, exclude)
    rows = look_up_projects(selected, t.projects, ["run_id"])
    return with_log(t, with_report(t, rows, allow_incomplete, *log_places()))


def as_recorded(rows: DataFrame) -> DataFrame:
    """Add ``submission_id`` or ``error`` to :func:`recorded_rows`, which may have gained columns."""
    return _submitted(rows, F.coalesce(project_error(), report_error(), F.col("log_error")))


def recorded_clusters(
    t: Telemetry, requests: DataFrame, allow_incomplete: bool = False, exclude: Iterable[str] | None = None
) -> DataFrame:
    """One row per selected cluster of the requested runs: its submission, or the error that stopped only it."""
    return as_recorded(recorded_rows(t, requests, allow_incomplete, exclude)).select(
        "run_id", "requested_project", "requested_path", "project_id", "cluster_id", "auto_apply_recs", "submission_id", "error"
    )


def recorded_runs(requests: DataFrame, recorded: DataFrame, projects: DataFrame) -> DataFrame:
    """Per request (a run, for a project or for all, at a path or any) how many projects got a submission; none at all is an error.

    A requested project that doesn't exist is an error of its own, whatever was found in the run. Which submission a project got is a row of
    ``recorded``.
    """
    key = ["run_id", "requested_project", "requested_path"]
    counts = recorded.groupBy(*[F.col(c).alias(f"_{c}") for c in key]).agg(
        F.count("*").alias("n_clusters"), F.count("submission_id").alias("n_submitted")
    )
    known = projects.select(F.col("project_id").alias("_known")).distinct()
    asked = requests.select(
        "run_id", F.nullif("project_id", F.lit("")).alias("project_id"), F.nullif("cluster_path", F.lit("")).alias("cluster_path"))
    own = (
        (F.col("run_id") == F.col("_run_id")) & F.col("project_id").eqNullSafe(F.col("_requested_project"))
        & F.col("cluster_path").eqNullSafe(F.col("_requested_path"))
    )
    rows = asked.join(counts, own, "left").join(known, F.col("project_id") == F.col("_known"), "left")
    error = F.when(
        F.col("project_id").isNotNull() & F.col("_known").isNull(),
        F.concat(F.lit("Failed to retrieve project "), F.col("project_id")),
    ).when(
        F.col("n_clusters").isNull(), tasks.locate_error(F.col("run_id"), F.col("project_id"))
    ).when(
        F.col("n_submitted") == 0,
        F.concat(F.lit("Failed to submit run "), F.col("run_id").cast("string"), F.lit(" to any projects")),
    )
    return rows.select(
        "run_id", F.coalesce("n_clusters", F.lit(0)).alias("n_clusters"),
        F.coalesce("n_submitted", F.lit(0)).alias("n_submitted"), error.alias("error"),
    )


def recorded_finished_runs(t: Telemetry, requests: DataFrame, statuses: DataFrame) -> DataFrame:
    """Record the requested runs that ended well; say of the others how they ended or that they go on."""
    ended = waits.first_final_runs(statuses)
    rows = requests.join(ended.select("run_id", "state", F.col("error").alias("_api")), "run_id", "left")
    good = rows.filter("state = 'SUCCESS'").select(*requests.columns)
    done = recorded_runs(good, recorded_clusters(t, good), t.projects)
    other = rows.filter(~F.coalesce(F.col("state") == "SUCCESS", F.lit(False))).select(
        "run_id",
        F.lit(0).cast("bigint").alias("n_clusters"),
        F.lit(0).cast("bigint").alias("n_submitted"),
        F.coalesce(
            F.col("_api"),
            F.concat(F.lit("Unsuccessful run result state: "), F.col("state")),
            F.lit("waiting"),
        ).alias("error"),
    )
    return done.unionByName(other)
