"""Jobs and the clusters they define.

A job is one row ``(job_id, settings)``; ``settings`` is the whole document (VARIANT) with ``name``, ``tasks`` and ``job_clusters``. Operators read
the few members they decide by and carry everything else along, so payloads and rewritten jobs keep task bodies, libraries, schedules and
any key of a cluster. A job is worked on inside its row, so nothing here shuffles but the look-up of a request's job.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.functions.merge import (
    array_of,
    is_blank_object,
    items,
    merge_documents,
    object_of,
    scalar,
    text_at,
    with_keys,
    without_keys,
)
from fleetlens.functions.status import is_blank
from fleetlens.functions.unnest import unnest

_TASKS = "array<struct<task_key:string,job_cluster_key:string,new_cluster:variant>>"
_CLUSTERS = "array<struct<job_cluster_key:string,new_cluster:variant>>"
PROJECT = f"$.custom_tags['{K.PROJECT_TAG}']"


def _opened(jobs: DataFrame) -> DataFrame:
    """Add ``_tasks`` and ``_clusters``: the keys and definitions inside the settings. A job without a list has an empty one."""
    settings = F.col("settings")
    none = lambda kind: F.array().cast(kind)
    return jobs.withColumns({
        "_tasks": F.coalesce(F.try_variant_get(settings, "$.tasks", _TASKS), none(_TASKS)),
        "_clusters": F.coalesce(F.try_variant_get(settings, "$.job_clusters", _CLUSTERS), none(_CLUSTERS)),
    })


def _entries(key: Column) -> Column:
    return F.filter("_clusters", lambda c: c["job_cluster_key"] == key)


def single_clusters(jobs: DataFrame) -> DataFrame:
    """Add ``cluster`` (VARIANT), ``cluster_key`` and ``cluster_error`` for the one cluster all tasks of a job share.

    A lone task may define its cluster inline; several tasks must have equal cluster keys.
    """
    first, count = F.get("_tasks", F.lit(0)), F.size("_tasks")
    same = F.forall("_tasks", lambda t: t["job_cluster_key"].eqNullSafe(first["job_cluster_key"]))
    shared = F.get(_entries(first["job_cluster_key"]), F.lit(0))["new_cluster"]
    inline = F.when((count == 1) & ~is_blank_object(first["new_cluster"]), first["new_cluster"])
    found = F.when((count == 1) | same, F.coalesce(inline, shared))
    error = (
        F.when(F.col("_count") == 0, K.NO_TASK_IN_JOB)
        .when((F.col("_count") > 1) & ~F.col("_same"), K.TASKS_NOT_SHARED)
        .when(F.col("cluster").isNull(), K.NO_CLUSTER_FOR_TASK)
    )
    rows = _opened(jobs).withColumns(
        {"cluster": found, "cluster_key": F.nullif(first["job_cluster_key"], F.lit("")), "_count": count, "_same": same})
    return rows.withColumn("cluster_error", error).drop("_count", "_same", "_tasks", "_clusters")


def with_project_clusters(jobs: DataFrame, exclude: Iterable[str] | None = None) -> DataFrame:
    """Add ``clusters``: a project's only cluster each, ``array<struct<project_id, path_kind, path_key, cluster>>``.

    Projects with several paths are left out. Clusters without project tag stand under a NULL project. Of several entries
    with one key the last counts. The list is as long as the job's tasks at most.
    """
    keys = list(exclude or [])
    opened = _opened(jobs)
    tasks = F.filter("_tasks", lambda t: ~t["task_key"].isin(keys)) if keys else F.col("_tasks")

    def resolved(task: Column) -> Column:
        inline = ~is_blank_object(task["new_cluster"])
        matches = _entries(task["job_cluster_key"])
        shared = F.get(matches, F.size(matches) - 1)["new_cluster"]
        cluster = F.when(inline, task["new_cluster"]).when(~is_blank_object(shared), shared)
        return F.struct(
            text_at(cluster, PROJECT).alias("project_id"), F.when(inline, "tasks").otherwise("job_clusters").alias("path_kind"),
            F.when(inline, task["task_key"]).otherwise(task["job_cluster_key"]).alias("path_key"), cluster.alias("cluster"))

    found = opened.withColumn("_found", F.filter(F.transform(tasks, resolved), lambda r: r["cluster"].isNotNull()))
    projects = F.array_distinct(F.transform("_found", lambda r: r["project_id"]))

    def only(project: Column) -> Column:
        own = F.filter("_found", lambda r: r["project_id"].eqNullSafe(project))
        first = F.get(own, F.lit(0))
        one = F.forall(own, lambda r: (r["path_kind"] == first["path_kind"]) & r["path_key"].eqNullSafe(first["path_key"]))
        return F.when(one, first)

    clusters = F.filter(F.transform(projects, only), lambda c: c.isNotNull())
    return found.withColumn("clusters", clusters).drop("_tasks", "_clusters", "_found")


def project_job_clusters(jobs: DataFrame, exclude: Iterable[str] | None = None) -> DataFrame:
    """The clusters of :func:`with_project_clusters` as rows: (job, project) → its only cluster, as path and definition."""
    return unnest(with_project_clusters(jobs, exclude), F.col("clusters"), ["job_id"], "c").select("job_id", "c.*")


def target_clusters(requests: DataFrame, jobs: DataFrame) -> DataFrame:
    """For each requested (job, project): the job's cluster tagged for it, else its only one, else an error.

    A request meets its job once; other columns of the requests are kept.
    """
    found = with_project_clusters(jobs).select("job_id", "clusters")
    rows = requests.join(found, "job_id", "left")
    tagged = F.get(F.filter("clusters", lambda c: c["project_id"] == F.col("project_id")), F.lit(0))
    alone = F.when(F.size("clusters") == 1, F.get("clusters", F.lit(0)))
    error = F.when(
        F.col("_chosen").isNull(),
        F.concat(F.lit("Failed to locate cluster in job "), F.col("job_id").cast("string"),
                 F.lit(" for project "), F.coalesce("project_id", F.lit("None"))),
    )
    return rows.withColumn("_chosen", F.coalesce(tagged, alone)).select(
        *requests.columns, "_chosen.path_kind", "_chosen.path_key", "_chosen.cluster", error.alias("target_error"))


def recommended_definition(cluster: Column, configuration: Column, depth: int) -> Column:
    """The definition with a recommended configuration merged in, both whole documents.

    The sizes of the old definition go first, because fixed and automatic sizes exclude each other.
    """
    return F.when(cluster.isNotNull(), merge_documents(without_keys(cluster, "num_workers", "autoscale"), configuration, depth))


def rewrite_jobs(jobs: DataFrame, definition: str, keep_name: bool = False) -> DataFrame:
    """Put the new ``definition`` (VARIANT) where the job's shared cluster was (see :func:`single_clusters`).

    A shared entry is removed and the new one appended; an inline definition replaces the first task's, by
    default without ``cluster_name``, which the platform refuses there. Everything else of the job stays.
    """
    settings, new, key = F.col("settings"), F.col(definition), F.col("cluster_key")
    inline = new if keep_name else without_keys(new, "cluster_name")
    entry = F.array(object_of(job_cluster_key=scalar(key), new_cluster=new))
    clusters = items(F.variant_get(settings, "$.job_clusters", "variant"))
    kept = F.filter(clusters, lambda c: ~text_at(c, "$.job_cluster_key").eqNullSafe(key))
    appended = F.coalesce(F.concat(kept, entry), entry)
    tasks = F.transform(
        items(F.variant_get(settings, "$.tasks", "variant")),
        lambda t, i: F.when(i == 0, with_keys(t, new_cluster=inline)).otherwise(t))
    changed = F.when(key.isNotNull(), with_keys(settings, job_clusters=array_of(appended))).otherwise(with_keys(settings, tasks=array_of(tasks)))
    return jobs.withColumn("settings", F.when(new.isNotNull(), changed).otherwise(settings))


def update_payload(path_kind: Column, path_key: Column, definition: Column) -> Column:
    """JSON of a job update that replaces one cluster by a whole definition; NULL without a definition."""
    shared = F.struct(F.array(F.struct(
        path_key.alias("job_cluster_key"), definition.alias("new_cluster"))).alias("job_clusters"))
    inline = F.struct(F.array(F.struct(path_key.alias("task_key"), definition.alias("new_cluster"))).alias("tasks"))
    payload = F.when(path_kind == "job_clusters", F.to_json(shared)).otherwise(F.to_json(inline))
    return F.when(definition.isNotNull(), payload)


def one_off_runs(jobs: DataFrame) -> DataFrame:
    """Payloads that run a job once: ``run_name``, ``tasks`` and, for several tasks, the ``cluster`` to create (VARIANT).

    Tasks keep all they do. One task carries its cluster inline, without name. Several tasks share a new cluster without policy that
    is named (after the job if it has no name) and ends itself; their ``existing_cluster_id`` is known only
    once it is created, so it is left to the caller.
    """
    rows = single_clusters(jobs)
    ok, cluster = F.col("cluster_error").isNull(), F.col("cluster")
    whole = items(F.variant_get(F.col("settings"), "$.tasks", "variant"))
    alone = F.size(whole) == 1
    job_name = text_at(F.col("settings"), "$.name")
    name = text_at(cluster, "$.cluster_name")
    own = with_keys(
        cluster, policy_id=F.lit(None).cast("variant"), cluster_name=scalar(F.when(~is_blank(name), name).otherwise(job_name)),
        autotermination_minutes=scalar(F.lit(K.ONE_OFF_AUTOTERMINATION_MINUTES)))
    inline = F.when(alone, without_keys(cluster, "cluster_name"))
    tasks = F.transform(whole, lambda t: with_keys(t, new_cluster=inline, job_cluster_key=F.lit(None).cast("variant")))
    return rows.select(
        "job_id",
        job_name.alias("run_name"),
        F.when(ok, array_of(tasks)).alias("tasks"),
        F.when(ok & ~alone, own).alias("cluster"),
        F.col("cluster_error").alias("error"),
    )


def job_parts(jobs: DataFrame, sections: Iterable[str] = ("tasks", "job_clusters")) -> DataFrame:
    """Tasks and shared clusters of jobs, one row each: ``(job_id, section, pos, key, definition, part)``.

    ``definition`` is the part's cluster, ``part`` the whole part. Only the ``sections`` asked for are opened.
    """
    keys = {"tasks": "task_key", "job_clusters": "job_cluster_key"}

    def parts(section: str, key: str) -> Column:
        return F.coalesce(F.transform(
            items(F.variant_get(F.col("settings"), f"$.{section}", "variant")),
            lambda x, i: F.struct(F.lit(section).alias("section"), i.alias("pos"), text_at(x, f"$.{key}").alias("key"),
                                  F.variant_get(x, "$.new_cluster", "variant").alias("definition"), x.alias("part"))), F.array())

    return unnest(jobs, F.concat(*[parts(s, keys[s]) for s in sections]), ["job_id"], "p").select("job_id", "p.*")
