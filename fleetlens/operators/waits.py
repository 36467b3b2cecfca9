"""Outcomes of waiting, read from state observations in time order.

Observations carry ``(…, state, error_code)``; an observation with an error code ends the wait with that error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.functions.status import is_final_run_state, unexpected_state


def _api_error(code: Column) -> Column:
    return F.concat(F.lit(K.API_ERROR_CODE + ": "), code)


def first_final_runs(observations: DataFrame) -> DataFrame:
    """Per run its first final state; a run without one is still waited for."""
    ends = is_final_run_state(F.col("state")) | F.col("error_code").isNotNull()
    first = F.min_by(
        F.when(ends, F.struct("state", "error_code")), F.when(ends, F.struct("ts", "seq"))
    )
    return observations.groupBy("run_id").agg(first.alias("_end")).select(
        "run_id",
        F.when(F.col("_end.error_code").isNull(), F.col("_end.state")).alias("state"),
        _api_error(F.col("_end.error_code")).alias("error"),
    )


def first_final_recommendations(observations: DataFrame) -> DataFrame:
    """Per recommendation ``ready``, the failure message, or ``pending``."""
    ends = F.col("state").isin("SUCCESS", "FAILURE")
    first = F.min_by(F.when(ends, F.col("state")), F.when(ends, F.struct("ts", "seq")))
    state = F.col("_state")
    return observations.groupBy("recommendation_id").agg(first.alias("_state")).select(
        "recommendation_id",
        F.when(state == "SUCCESS", "ready").when(state == "FAILURE", K.RECOMMENDATION_FAILED)
        .otherwise("pending").alias("outcome"),
    )


def cluster_terminations(
    observations: DataFrame, timeout_seconds: int = K.TERMINATION_TIMEOUT_SECONDS
) -> DataFrame:
    """Per cluster how waiting for its termination ends.

    ``observations(cluster_id, seen_s, seq, state, error_code)``. TERMINATED succeeds, TERMINATING goes on, any
    other state fails. The time limit counts from the first observation and is tested after a TERMINATING one.
    """
    starts = observations.groupBy("cluster_id").agg(F.min("seen_s").alias("_start"))
    going_on = F.coalesce(F.col("state") == "TERMINATING", F.lit(False)) & F.col("error_code").isNull()
    late = F.col("seen_s") - F.col("_start") > timeout_seconds
    result = (
        F.when(F.col("error_code").isNotNull(), _api_error(F.col("error_code")))
        .when(F.col("state") == "TERMINATED", "ok")
        .when(going_on & late, f"Cluster failed to terminate after waiting {timeout_seconds} seconds")
        .when(~going_on, unexpected_state(F.col("state")))
    )
    first = F.min_by("_result", F.when(F.col("_result").isNotNull(), F.struct("seen_s", "seq")))
    return (
        # As many as clusters: never a broadcast guessed from file sizes.
        observations.join(starts.hint("merge"), "cluster_id")
        .withColumn("_result", result)
        .groupBy("cluster_id")
        .agg(F.coalesce(first, F.lit("waiting")).alias("outcome"))
    )
