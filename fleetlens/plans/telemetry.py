"""The tables a workflow reads, gathered in one place."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Telemetry:
    """Input tables.

    tasks, job_clusters     tasks and shared clusters of runs (see operators.tasks)
    projects                project_id, project_model_id, auto_apply_recs
    clusters                cluster_id, platform, log_scheme, log_dir, log_first_poll (first poll made for its run)
    cluster_states          observations of cluster states (see operators.waits)
    info_headers, info_items  cluster-info documents (see operators.reports)
    cluster_events          one row per cluster event, with cluster_id
    listing                 polled log listings (see operators.eventlog)
    jobs                    job documents
    runs                    run_id, job_id: the job that a run is a run of
    recommendations         id, project_id, created_at, state, recommendation
    """

    tasks: DataFrame
    job_clusters: DataFrame
    projects: DataFrame
    clusters: DataFrame
    cluster_states: DataFrame
    info_headers: DataFrame
    info_items: DataFrame
    cluster_events: DataFrame
    listing: DataFrame
    jobs: DataFrame | None = None
    runs: DataFrame | None = None
    recommendations: DataFrame | None = None
