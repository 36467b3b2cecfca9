"""State classification, error shaping and closed-set checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens import constants as K


def is_final_run_state(state: Column) -> Column:
    return F.coalesce(state.isin(K.FINAL_RUN_STATES), F.lit(False))


def cluster_state_class(state: Column) -> Column:
    return (
        F.when(state == "TERMINATED", "done")
        .when(state == "TERMINATING", "wait")
        .when(state.isin(K.LIVE_CLUSTER_STATES), "terminate")
        .otherwise(unexpected_state(state))
    )


def unexpected_state(state: Column) -> Column:
    return F.concat(F.lit("Unexpected cluster state: "), F.coalesce(state, F.lit("None")))


def recommendation_class(state: Column) -> Column:
    return (
        F.when(state == "SUCCESS", "ready")
        .when(state == "FAILURE", K.RECOMMENDATION_FAILED)
        .otherwise("pending")
    )


def is_tracked_model(model: Column) -> Column:
    return F.coalesce(model.isin(K.TRACKED_MODELS), F.lit(False))


def model_error(project_id: Column, model: Column) -> Column:
    """NULL for a project whose runs are recorded, else why they are not."""
    return F.when(
        ~is_tracked_model(model),
        F.concat(F.lit("Unexpected project_model_id for project "), project_id, F.lit(": "),
                 F.coalesce(model, F.lit("None"))),
    )


def is_running(platform: Column, state: Column, statuses: Column, group_known: Column) -> Column:
    """AWS: the instance state. Azure: the second status; without a resource group every VM counts as running."""
    azure = F.when(~F.coalesce(group_known, F.lit(False)), F.lit(True)).otherwise(
        F.coalesce(F.get(statuses, F.lit(1))["code"] == K.POWER_RUNNING, F.lit(False))
    )
    return F.when(platform == "azure", azure).otherwise(F.coalesce(state == "running", F.lit(False)))


def api_error(error_code: Column, message: Column) -> Column:
    """struct(code, message), NULL where the payload reports no error."""
    text = F.when(error_code != "", F.concat(error_code, F.lit(": "), F.coalesce(message, F.lit("None"))))
    return F.when(
        error_code.isNotNull(),
        F.struct(F.lit(K.API_ERROR_CODE).alias("code"), F.coalesce(text, message).alias("message")),
    )


def response_problem(result: Column, error: Column) -> Column:
    """NULL for a consistent result/error pair."""
    return F.when(result.isNotNull() & error.isNotNull(), "must not provide both result and error").when(
        result.isNull() & error.isNull(), "must provide result or error"
    )


def split_responses(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Consistent result/error rows, and the others with their ``problem`` for quarantine."""
    checked = responses.withColumn("problem", response_problem(F.col("result"), F.col("error")))
    return checked.filter(F.col("problem").isNull()).drop("problem"), checked.filter(F.col("problem").isNotNull())


def check_envelope(plan_type: str, compute_type: str, platform: str | None = None) -> None:
    """Refuse report envelopes outside the closed sets."""
    for name, value, allowed in (
        ("plan type", plan_type, K.PLAN_TYPES),
        ("compute type", compute_type, K.COMPUTE_TYPES),
        ("platform", platform, [None, *K.PROVIDERS]),
    ):
        if value not in allowed:
            raise ValueError(f"Unknown {name}: {value}")


def is_empty_struct(col: Column, dtype: T.StructType) -> Column:
    """True for NULL and for a struct whose every field is NULL (the typed form of ``{}``)."""
    fields = [col[name].isNotNull() for name in dtype.names]
    return ~F.coalesce(reduce(lambda a, b: a | b, fields, F.lit(False)), F.lit(False))


def is_empty_document(df: DataFrame, column: str) -> Column:
    return is_empty_struct(F.col(column), df.schema[column].dataType)


def is_blank(col: Column) -> Column:
    return F.coalesce(col, F.lit("")) == ""
