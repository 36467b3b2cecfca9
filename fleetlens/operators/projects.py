"""Projects, submissions and recommendations.

The newest row per project is an aggregate (``max_by``), not a window, so each map task keeps one row per
project and a project with a large share of all submissions is no hot spot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.functions.lookup import left_lookup
from fleetlens.functions.status import is_blank, model_error


def projects_by_app(projects: DataFrame, app_id: str | None = None) -> DataFrame:
    return projects if app_id is None else projects.filter(F.col("app_id") == app_id)


def by_project(rows: DataFrame, project_id: str, row_id: str | None = None) -> DataFrame:
    """Submissions or recommendations of one project, or the one with the given id."""
    kept = rows.filter(F.col("project_id") == project_id)
    return kept if row_id is None else kept.filter(F.col("id") == row_id)


def newest(rows: DataFrame, key: str, payload: list[str]) -> DataFrame:
    """The newest row per key by (created_at, id)."""
    top = F.max_by(F.struct(*payload), F.struct("created_at", "id"))
    return rows.groupBy(key).agg(top.alias("_top")).select(key, "_top.*")


def latest_submission_config(
    projects: DataFrame, submissions: DataFrame, success_only: bool = False
) -> DataFrame:
    """Per project: the configuration of its newest (successful) submission, or why there is none."""
    ranked = F.struct("created_at", "id")
    payload = F.struct("id", "configuration")
    won = F.col("state") == "SUCCESS"
    top = (
        F.max_by(F.when(won, payload), F.when(won, ranked)) if success_only else F.max_by(payload, ranked)
    )
    found = submissions.groupBy("project_id").agg(top.alias("_top"))
    rows = projects.select("project_id").join(
        found.withColumn("_any", F.lit(True)), "project_id", "left"
    )
    error = F.when(F.col("_any").isNull(), "NoSubmissionsFound").when(
        F.col("_top").isNull(), "NoSuccessfulSubmissionsFound"
    )
    return rows.select(
        "project_id",
        F.col("_top.id").alias("submission_id"),
        F.col("_top.configuration").alias("configuration"),
        error.alias("error"),
    )


def first_project_by_app(projects: DataFrame) -> DataFrame:
    """Per app id the project created first."""
    return (
        projects.filter(F.col("app_id").isNotNull())
        .groupBy("app_id")
        .agg(F.min(F.struct("created_at", "project_id")).alias("_first"))
        .select("app_id", F.col("_first.project_id").alias("project_id"))
    )


def is_uuid(value: Column) -> Column:
    """True for the UUID spellings with or without urn prefix, braces and dashes."""
    bare = F.replace(F.replace(value, F.lit("urn:"), F.lit("")), F.lit("uuid:"), F.lit(""))
    bare = F.replace(F.trim(bare, F.lit("{}")), F.lit("-"), F.lit(""))
    return bare.rlike("^[0-9a-fA-F]{32}$")


def resolve_project_ids(values: DataFrame, projects: DataFrame) -> DataFrame:
    """``values(value)`` → the value itself if it is a UUID, else the first project with that app id."""
    by_app = first_project_by_app(projects).withColumnRenamed("app_id", "value")
    looked_up = values.join(by_app.withColumnRenamed("project_id", "_found"), "value", "left")
    resolved = F.when(is_uuid(F.col("value")), F.col("value")).otherwise(F.col("_found"))
    error = F.when(
        resolved.isNull(), F.concat(F.lit("No project found for '"), F.col("value"), F.lit("'"))
    )
    return looked_up.select("value", resolved.alias("project_id"), error.alias("error"))


def latest_recommendation(projects: DataFrame, recommendations: DataFrame) -> DataFrame:
    """Per project: ``configuration`` of the newest recommendation, or the error, or neither when there is none."""
    top = newest(recommendations, "project_id", ["id", "recommendation"]).withColumnRenamed(
        "id", "recommendation_id"
    )
    rows = projects.select("project_id").join(top, "project_id", "left")
    error = F.when(
        F.col("recommendation_id").isNotNull() & F.col("recommendation").isNull(), K.RECOMMENDATION_NOT_FOUND
    ).when(
        F.col("recommendation").isNotNull() & F.col("recommendation.configuration").isNull(),
        K.CONFIGURATION_NOT_FOUND,
    )
    return rows.select(
        "project_id",
        "recommendation_id",
        F.col("recommendation.configuration").alias("configuration"),
        error.alias("error"),
    )


def project_eligibility(projects: DataFrame) -> DataFrame:
    error = model_error(F.col("project_id"), F.col("project_model_id"))
    return projects.select(
        "project_id",
        error.isNull().alias("eligible"),
        (error.isNull() & F.coalesce("auto_apply_recs", F.lit(False))).alias("auto_apply"),
        error.alias("error"),
    )


def look_up_projects(clusters: DataFrame, projects: DataFrame, spread: Sequence[str] | None = None) -> DataFrame:
    """Look up each cluster's project; :func:`project_error` tells which are unknown or untracked."""
    known = projects.select(
        "project_id", "project_model_id", "auto_apply_recs", F.lit(True).alias("_project_known")
    )
    return left_lookup(clusters, known, "project_id", spread)


def project_error() -> Column:
    """The error of a row of :func:`look_up_projects`."""
    return F.when(
        F.col("_project_known").isNull(),
        F.concat(F.lit("Failed to retrieve project "), F.coalesce("project_id", F.lit("None"))),
    ).otherwise(model_error(F.col("project_id"), F.col("project_model_id")))


def join_projects(clusters: DataFrame, projects: DataFrame) -> DataFrame:
    """Look up each cluster's project; an unknown or untracked project gives an error on that row only."""
    return look_up_projects(clusters, projects).withColumn("project_error", project_error()).drop("_project_known")


# Text fields change on any non-empty patch value; the two flags follow their own rules.
PATCH_TEXT_FIELDS = [
    "description", "cluster_log_url", "app_id", "prediction_params", "job_id", "cluster_path", "workspace_id",
]


def patch_projects(projects: DataFrame, patches: DataFrame) -> DataFrame:
    """Apply partial updates: empty values keep the current one; ``auto_apply_recs`` may be set to false,
    ``optimize_instance_size`` only to true."""
    changed = [c for c in patches.columns if c != "project_id"]
    renamed = patches.select("project_id", *[F.col(c).alias(f"_new_{c}") for c in changed])

    def patched(name: str) -> Column:
        old, new = F.col(name), F.col(f"_new_{name}")
        if name == "auto_apply_recs":
            return F.coalesce(new, old)
        if name == "optimize_instance_size":
            return F.when(F.coalesce(new, F.lit(False)), new).otherwise(old)
        return F.when(~is_blank(new), new).otherwise(old)

    return projects.join(renamed, "project_id", "left").select(
        *[patched(c).alias(c) if c in changed else F.col(c) for c in projects.columns]
    )
