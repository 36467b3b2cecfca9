"""Cluster definitions with recommendations or project templates merged in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.functions.lookup import left_lookup
from fleetlens.functions.merge import MOST_NESTED, merge_documents, nesting, parse_patch, patch_depth
from fleetlens.operators.jobs import recommended_definition


def parsed_patches(patches: DataFrame, text: str, patch: str) -> tuple[DataFrame, int]:
    """Add the patch (VARIANT) of a text column, and tell how deep the deepest one nests. Runs one job over the patches."""
    parsed = patches.withColumn(patch, parse_patch(F.col(text)))
    return parsed, patch_depth(parsed, patch)


def merge_error(patch: Column, depth: int) -> Column:
    """Why a patch cannot be merged, NULL if it can."""
    return F.when(nesting(patch) > MOST_NESTED, K.NESTED_TOO_DEEP) if depth > MOST_NESTED else F.lit(None).cast("string")


def with_recommendation(rows: DataFrame, recommendations: DataFrame, spread: Sequence[str] | None = None) -> tuple[DataFrame, int]:
    """Look up ``recommendation_id``; add its ``patch`` (VARIANT) or ``recommendation_error``. Also returns the patches' depth.

    ``spread`` as in :func:`left_lookup`.
    """
    known = recommendations.select(
        F.col("id").alias("recommendation_id"),
        F.lit(True).alias("_known"),
        F.col("recommendation").isNotNull().alias("_given"),
        F.col("recommendation.configuration").alias("configuration"),
    )
    found, depth = parsed_patches(known, "configuration", "patch")
    error = (
        F.when(F.col("_known").isNull() | ~F.col("_given"), K.RECOMMENDATION_NOT_FOUND)
        .when(~F.col("_configured"), K.CONFIGURATION_NOT_FOUND)
        .otherwise(merge_error(F.col("patch"), depth))
    )
    # The text stays behind: its patch is looked up.
    found = found.withColumn("_configured", F.col("configuration").isNotNull()).drop("configuration")
    looked_up = left_lookup(rows, found, "recommendation_id", spread).withColumn("recommendation_error", error)
    return looked_up.drop("_known", "_given", "_configured"), depth


def updated_definitions(definitions: DataFrame, latest: DataFrame) -> DataFrame:
    """Per project its definition (VARIANT) merged with the newest recommendation.

    ``definitions(project_id, definition)``; ``latest`` from :func:`projects.latest_recommendation`.
    """
    patches, depth = parsed_patches(latest, "configuration", "_patch")
    rows = definitions.join(patches, "project_id", "left")
    error = F.when(F.col("configuration").isNull(), F.coalesce("error", F.lit("no_recommendation"))).otherwise(
        merge_error(F.col("_patch"), depth))
    merged = recommended_definition(F.col("definition"), F.col("_patch"), depth)
    return rows.select(
        "project_id", F.when(error.isNull(), merged).alias("definition"), error.alias("error")
    )


def definition_and_recommendation(definitions: DataFrame, latest: DataFrame) -> DataFrame:
    """Definition and newest recommended configuration side by side; no recommendation is an error."""
    rows = definitions.join(latest, "project_id", "left")
    missing = F.col("recommendation_id").isNull()
    return rows.select(
        "project_id",
        F.when(~missing, F.col("definition")).alias("cluster_definition"),
        F.col("configuration").alias("cluster_recommendation"),
        F.when(missing, K.RECOMMENDATION_FAILED).alias("error"),
    )


def templated(rows: DataFrame, definition: str, templates: DataFrame) -> DataFrame:
    """Deep-merge the project's template (JSON text) into a definition column (VARIANT); no template leaves it as it is.

    A template that nests too deeply gives no definition and a ``template_error``.
    """
    patches, depth = parsed_patches(templates.select("project_id", "template"), "template", "_patch")
    merged = merge_documents(F.col(definition), F.col("_patch"), depth)
    return (
        rows.join(patches.drop("template"), "project_id", "left")
        .withColumns({definition: F.when(F.col(definition).isNotNull(), merged), "template_error": merge_error(F.col("_patch"), depth)})
        .drop("_patch")
    )
