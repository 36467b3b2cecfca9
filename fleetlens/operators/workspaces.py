"""Workspace configurations: partial updates and validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.functions.status import is_blank
from fleetlens.functions.unnest import unnest

NULL_TEXT = "null"


def patch_workspaces(workspaces: DataFrame, patches: DataFrame) -> DataFrame:
    """Apply partial updates: absent keeps, the text ``null`` clears, anything else sets."""
    changed = [c for c in patches.columns if c != "workspace_id"]
    renamed = patches.select("workspace_id", *[F.col(c).alias(f"_new_{c}") for c in changed])

    def patched(name: str) -> Column:
        new = F.col(f"_new_{name}")
        return F.when(new.isNull(), F.col(name)).when(new != NULL_TEXT, new)

    return workspaces.join(renamed, "workspace_id", "left").select(
        *[patched(c).alias(c) if c in changed else F.col(c) for c in workspaces.columns]
    )


def _not_in(col: Column, allowed: list[str]) -> Column:
    return ~F.coalesce(col.isin(allowed), F.lit(False))


def violations(ws: DataFrame) -> Column:
    """All broken rules of a workspace row, as an array of messages in rule order."""
    aws = F.col("compute_provider") == "aws"
    azure = F.col("compute_provider") == "azure"
    hosted = F.col("collection_type") == "hosted"
    remote = F.col("collection_type") == "remote"
    missing = F.array_compact(F.array(*[F.when(is_blank(F.col(f)), f) for f in K.AZURE_CREDENTIAL_FIELDS]))
    rules = [
        (_not_in(F.col("databricks_plan_type"), K.PLAN_TYPES), F.lit("Unknown plan type")),
        (_not_in(F.col("collection_type"), K.COLLECTION_TYPES), F.lit("Unknown collection type")),
        # A self-hosted workspace has no monitoring type.
        (_not_in(F.col("monitoring_type"), K.MONITORING_TYPES)
         & ~(F.coalesce(remote, F.lit(False)) & F.col("monitoring_type").isNull()),
         F.lit("Unknown monitoring type")),
        (_not_in(F.col("compute_provider"), K.PROVIDERS), F.lit("Unknown compute provider")),
        (aws & is_blank(F.col("aws_region")), F.lit("AWS Region is required for AWS compute provider")),
        (~is_blank(F.col("aws_region")) & _not_in(F.col("aws_region"), K.AWS_REGIONS), F.lit("Unknown AWS region")),
        (remote & aws & is_blank(F.col("instance_profile_arn")),
         F.lit("AWS Instance Profile ARN is required for REMOTE hosted AWS environments")),
        (hosted & aws & is_blank(F.col("aws_iam_role_arn")),
         F.lit("AWS IAM Role ARN is required for AWS compute provider")),
        (hosted & azure & (F.size(missing) > 0),
         F.concat(F.lit("Missing required fields for Azure compute provider: "), F.array_join(missing, ", "))),
    ]
    return F.array_compact(F.array(*[F.when(broken, message) for broken, message in rules]))


def workspace_violations(ws: DataFrame) -> DataFrame:
    """One row per broken rule."""
    return unnest(ws, violations(ws), ["workspace_id"], "violation")
