"""From recommendations to job updates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.lookup import left_lookup
from fleetlens.functions.merge import merge_documents
from fleetlens.operators import jobs, recommend
from fleetlens.plans.submit import as_recorded, recorded_rows
from fleetlens.plans.telemetry import Telemetry


def job_updates(job_rows: DataFrame, recommendations: DataFrame, requests: DataFrame, spread: Sequence[str] | None = None) -> DataFrame:
    """Update payloads for ``requests(job_id, project_id, recommendation_id, …)``, or the error of each.

    The new definition is always merged from the stored one, never from an earlier result, and is a whole document. Other columns of
    the requests are kept; a request that fails stays, with ``update_error``. ``spread`` as in :func:`left_lookup`.
    """
    # Small rows meet first, so that clusters move once.
    asked, depth = recommend.with_recommendation(requests, recommendations, spread)
    rows = jobs.target_clusters(asked, job_rows)
    merged = jobs.recommended_definition(F.col("cluster"), F.col("patch"), depth)
    problem = F.coalesce("target_error", "recommendation_error")
    rows = rows.withColumn("update_error", problem).withColumn("_new", F.when(F.col("update_error").isNull(), merged))
    return rows.select(
        *requests.columns, "path_kind", "path_key", F.col("_new").alias("definition"),
        jobs.update_payload(F.col("path_kind"), F.col("path_key"), F.col("_new")).alias("payload"),
        "update_error",
    )


def recommended_jobs(job_rows: DataFrame, recommendations: DataFrame, requests: DataFrame) -> DataFrame:
    """Whole jobs with a recommendation merged into the one cluster their tasks share.

    ``requests(job_id, recommendation_id)``. Jobs that cannot be changed stay as they are, with ``error``.
    """
    # Small rows meet first, so that whole jobs move once.
    asked, depth = recommend.with_recommendation(requests.select("job_id", "recommendation_id"), recommendations)
    rows = jobs.single_clusters(job_rows).join(asked, "job_id")
    merged = jobs.recommended_definition(F.col("cluster"), F.col("patch"), depth)
    return _rewritten(rows, F.col("recommendation_error"), merged, keep_name=False)


def project_jobs(job_rows: DataFrame, templates: DataFrame, requests: DataFrame) -> DataFrame:
    """Whole jobs with a project's template merged into the one cluster their tasks share.

    ``requests(job_id, project_id)``. Jobs that cannot be changed stay as they are, with ``error``.
    """
    patches, depth = recommend.parsed_patches(templates.select("project_id", "template"), "template", "_patch")
    # Small rows meet first, so that whole jobs move once.
    asked = left_lookup(requests.select("job_id", "project_id"), patches, "project_id")
    rows = jobs.single_clusters(job_rows).join(asked, "job_id")
    problem = F.when(F.col("template").isNull(), "no_template").otherwise(recommend.merge_error(F.col("_patch"), depth))
    return _rewritten(rows, problem, merge_documents(F.col("cluster"), F.col("_patch"), depth), keep_name=True)


def _rewritten(rows: DataFrame, problem: Column, merged: Column, keep_name: bool) -> DataFrame:
    error = F.coalesce(F.col("cluster_error"), problem)
    changed = rows.withColumn("error", error).withColumn("_new", F.when(F.col("error").isNull(), merged))
    return jobs.rewrite_jobs(changed, "_new", keep_name).select("job_id", "settings", "error")


def ready_recommendations(recommendations: DataFrame) -> DataFrame:
    """Per project the newest recommendation that is ready."""
    order = F.struct("created_at", "id")
    return (
        recommendations.filter("state = 'SUCCESS'").groupBy("project_id")
        .agg(F.max(order).alias("_top")).select("project_id", F.col("_top.id").alias("recommendation_id"))
    )


def handled_runs(t: Telemetry, requests: DataFrame) -> DataFrame:
    """Record runs, then update the runs' jobs for submitted projects that ask for it with their newest ready
    recommendation. A failed update does not undo the submission."""
    # Ids and texts of errors are made last, so that no shuffle carries them.
    rows = recorded_rows(t, requests).join(t.runs.select("run_id", "job_id"), "run_id", "left")
    asked = rows.join(ready_recommendations(t.recommendations), "project_id", "left")
    updates = as_recorded(job_updates(t.jobs, t.recommendations, asked, ["run_id"]))
    status = (
        F.when(F.col("submission_id").isNull(), "not recorded")
        .when(~F.coalesce("auto_apply_recs", F.lit(False)), "not wanted")
        .when(F.col("recommendation_id").isNull(), "no ready recommendation")
        .otherwise(F.coalesce("update_error", F.lit("applied")))
    )
    return updates.withColumn("apply_status", status).select(
        "run_id", "job_id", "project_id", "submission_id", "apply_status",
        *[F.when(F.col("apply_status") == "applied", F.col(c)).alias(c)
          for c in ("recommendation_id", "path_kind", "path_key", "payload")],
        "error",
    )
