"""Which cluster, through which path, ran which tasks of a run for which project.

Inputs: ``run_task(run_id, pos, task_key, new_cluster, job_cluster_key, cluster_id, spark_context_id,
result_state, end_time_ms)`` and ``run_job_cluster(run_id, pos, job_cluster_key, new_cluster)``.
Every grouping below uses mergeable aggregates, so map tasks reduce a hot run before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.functions.status import is_blank, is_empty_document


def eligible_tasks(tasks: DataFrame, exclude: Iterable[str] | DataFrame | None = None) -> DataFrame:
    """Tasks that got a cluster instance, less the excluded keys (a list, or a table with ``task_key``)."""
    started = tasks.filter(F.col("cluster_id").isNotNull())
    if isinstance(exclude, DataFrame):
        return started.join(exclude.select("task_key").distinct(), "task_key", "left_anti")
    keys = list(exclude or [])
    return started.filter(~F.col("task_key").isin(keys)) if keys else started


def runs_all_success(tasks: DataFrame) -> DataFrame:
    """Per run: whether every task succeeded; a missing result counts as a failure."""
    ok = F.coalesce(F.col("result_state") == "SUCCESS", F.lit(False))
    return tasks.groupBy("run_id").agg(F.bool_and(ok).alias("all_success"), F.count("*").alias("n_tasks"))


def resolve_clusters(tasks: DataFrame, job_clusters: DataFrame, owner: str = "run_id") -> DataFrame:
    """Add ``cluster`` and ``cluster_path``: the inline definition, else the owner's entry under the task's key.

    Unresolved tasks stay, with a NULL cluster and a ``cluster_error``. Of several entries with one key
    the last one counts.
    """
    shared = job_clusters.groupBy(owner, "job_cluster_key").agg(
        F.max_by("new_cluster", "pos").alias("_shared")
    )
    inline = ~is_empty_document(tasks, "new_cluster")
    joined = tasks.join(shared, [owner, "job_cluster_key"], "left")
    found = inline | ~is_empty_document(joined, "_shared")
    path = F.when(inline, F.concat(F.lit("tasks/"), F.col("task_key"))).otherwise(
        F.concat(F.lit("job_clusters/"), F.col("job_cluster_key"))
    )
    return (
        joined.withColumn("cluster", F.when(inline, F.col("new_cluster")).when(found, F.col("_shared")))
        .withColumn("cluster_path", F.when(found, path))
        .withColumn("cluster_error", F.when(~found, K.NO_CLUSTER_FOR_TASK))
        .drop("_shared")
    )


def resolved_only(resolved: DataFrame) -> DataFrame:
    """The resolved tasks with the project their cluster is tagged for (NULL when untagged)."""
    return resolved.filter(F.col("cluster_path").isNotNull()).withColumn("project_id", project_of("cluster"))


def resolved_tags(tasks: DataFrame, job_clusters: DataFrame) -> DataFrame:
    """The tasks of :func:`resolved_only` with their ``cluster_path`` and ``project_id``, without definitions.

    Choosing clusters reads the project tag of a definition only, so no more of it is shuffled. Tasks and shared entries travel together, once,
    by run; what is grouped by run afterwards moves no more. A run holds at most as many tasks as the platform lets a run have.
    """
    def tags(given: Column) -> dict[str, Column]:
        return {"_given": given, "_project": F.when(given, project_of("new_cluster"))}

    # An inline definition needs no entry.
    inline = ~is_empty_document(tasks, "new_cluster")
    path = F.when(inline, F.concat(F.lit("tasks/"), F.col("task_key")))
    own = tasks.withColumns({
        **tags(inline), "_key": F.when(~inline, F.col("job_cluster_key")), "_path": path, "_task": F.lit(True)}).drop("new_cluster")
    entries = job_clusters.withColumns(tags(~is_empty_document(job_clusters, "new_cluster"))).select(
        "run_id", F.col("job_cluster_key").alias("_key"), F.col("pos").alias("_pos"), "_given", "_project")
    # Of several entries with one key the last one counts; a missing key matches none.
    last = F.max_by(F.when(F.col("_given"), F.struct("_project")), "_pos").over(W.partitionBy("run_id", "_key"))
    known = F.col("run_id").isNotNull() & F.col("_key").isNotNull()
    rows = own.unionByName(entries, allowMissingColumns=True).repartition("run_id").withColumn("_shared", F.when(known, last))
    resolved = rows.filter(F.col("_task")).withColumns({
        "cluster_path": F.when(F.col("_given"), F.col("_path")).when(
            F.col("_shared").isNotNull(), F.concat(F.lit("job_clusters/"), F.col("_key"))),
        "project_id": F.when(F.col("_given"), F.col("_project")).otherwise(F.col("_shared._project")),
    }).filter(F.col("cluster_path").isNotNull())
    return resolved.select(*[c for c in tasks.columns if c != "new_cluster"], "cluster_path", "project_id")


def project_of(cluster: str) -> Column:
    return F.col(cluster)["custom_tags"][K.PROJECT_TAG]


def tasks_by_cluster(resolved: DataFrame) -> DataFrame:
    """Per run and cluster instance: how many tasks it ran, and the first and last of them in run order."""
    return resolved.groupBy("run_id", "cluster_id").agg(
        F.count("*").alias("n_tasks"),
        F.min_by("task_key", "pos").alias("first_task"),
        F.max_by("task_key", "pos").alias("last_task"),
    )


def unambiguous_paths(resolved: DataFrame) -> DataFrame:
    """Paths that exactly one cluster instance served, with that instance."""
    return (
        resolved.groupBy("run_id", "project_id", "cluster_path")
        .agg(F.min("cluster_id").alias("cluster_id"), F.max("cluster_id").alias("_other"))
        .filter(F.col("cluster_id") == F.col("_other"))
        .drop("_other")
    )


# Facts of a cluster that its paths may carry.
FACTS = ["n_tasks", "end_time_ms", "_low", "_high"]


def unambiguous_paths_with_facts(resolved: DataFrame) -> DataFrame:
    """:func:`unambiguous_paths` with the ``FACTS`` of each path's cluster, for choosing among them; reads :func:`resolved_tags` once."""
    served = resolved.groupBy("run_id", "project_id", "cluster_path", "cluster_id").agg(
        F.count("*").alias("n_tasks"), F.max("end_time_ms").alias("end_time_ms"),
        F.min("spark_context_id").alias("_low"), F.max("spark_context_id").alias("_high"),
    )
    path, cluster = W.partitionBy("run_id", "project_id", "cluster_path"), W.partitionBy("run_id", "cluster_id")
    alone = F.min("cluster_id").over(path) == F.max("cluster_id").over(path)
    facts = {"n_tasks": F.sum("n_tasks"), "end_time_ms": F.max("end_time_ms"), "_low": F.min("_low"), "_high": F.max("_high")}
    return served.withColumn("_alone", alone).withColumns({c: f.over(cluster) for c, f in facts.items()}).filter("_alone").drop("_alone")


def _cluster(paths: DataFrame) -> Column:
    """A path's cluster with the facts it carries; of a run's clusters the order is that of their ids."""
    carried = [c for c in FACTS if c in paths.columns]
    return F.when(F.col("cluster_id").isNotNull(), F.struct("cluster_id", *carried))


def _spread_pick(rows: DataFrame, paths: DataFrame) -> DataFrame:
    """``_picked`` as its columns, ``cluster_id`` and the facts that the paths carry."""
    return rows.select(*[c for c in rows.columns if c != "_picked"], *[F.col(f"_picked.{c}").alias(c) for c in ["cluster_id", *FACTS] if c == "cluster_id" or c in paths.columns])


def _entries(paths: DataFrame, requests: DataFrame, how: str) -> DataFrame:
    """Per request and project tag of its run: whether it is the wanted tag, whether it holds the wanted
    path, and the cluster it yields (``_pick``): several paths need the wanted one among them."""
    asked = requests.select(
        "run_id",
        F.nullif("project_id", F.lit("")).alias("_want"),
        F.nullif("cluster_path", F.lit("")).alias("_at"),
    )
    served = paths.select("run_id", "project_id", "cluster_path", _cluster(paths).alias("_cluster"))
    at_path = F.when(F.col("cluster_path") == F.col("_at"), F.col("_cluster"))
    # As many as runs: never a broadcast guessed from file sizes.
    return (
        asked.hint("merge").join(served, "run_id", how)
        .groupBy("run_id", "_want", "_at", "project_id")
        .agg(F.count("cluster_path").alias("_paths"), F.max(at_path).alias("_here"), F.max("_cluster").alias("_any"))
        .withColumns({
            "_pick": F.when(F.col("_paths") > 1, F.col("_here")).otherwise(F.col("_any")),
            "_tagged": F.coalesce(F.col("project_id") == F.col("_want"), F.lit(False)),
            "_holds": F.col("_here").isNotNull(),
        })
        # Without a wanted project every tagged entry counts, if it holds the wanted path.
        .withColumn("_listed", ~is_blank(F.col("project_id")) & (F.col("_at").isNull() | F.col("_holds")))
    )


def _wanted_branches() -> dict[str, Column]:
    """What the entries of a request with a project amount to: tagged (a), holding the path (b), only one (c)."""
    return {
        "_a": F.bool_or("_tagged"), "_pick_a": F.max(F.when(F.col("_tagged"), F.col("_pick"))),
        "_b": F.bool_or("_holds"), "_pick_b": F.max(F.when(F.col("_holds"), F.col("_pick"))),
        "_c": F.count(F.when(F.col("_paths") > 0, 1)) == 1, "_pick_c": F.max("_pick"),
    }


def _branch() -> Column:
    return F.when(F.col("_a"), "a").when(F.col("_b"), "b").when(F.col("_c"), "c")


def _picked() -> Column:
    return (
        F.when(F.col("_a"), F.col("_pick_a")).when(F.col("_b"), F.col("_pick_b")).when(F.col("_c"), F.col("_pick_c"))
    )


def select_project_clusters(paths: DataFrame, requests: DataFrame) -> DataFrame:
    """Choose the clusters that stand for projects in runs.

    ``requests(run_id, project_id, cluster_path)``; project and path are optional. An *entry* is a project
    tag of the run with its paths. With a project P: (a) the entry tagged P, else (b) the entry holding the
    requested path, else (c) the only entry. Without: all tagged entries, holding the path if one is given.
    A chosen entry with several paths yields the cluster at the requested path or nothing; an entry with
    one path yields its cluster. Result: run_id, requested_project, requested_path, project_id, cluster_id, branch.

    The one join is on the run, and both groupings keep the run's partitioning.
    """
    slot = F.when(F.col("_want").isNull(), F.col("project_id")).alias("_slot")
    columns = _wanted_branches() | {"_tag_listed": F.bool_or("_listed")}
    chosen = (
        _entries(paths, requests, "inner").groupBy("run_id", "_want", "_at", slot)
        .agg(*[c.alias(name) for name, c in columns.items()])
    )
    free = F.col("_want").isNull()
    rows = (
        chosen.withColumn("branch", F.when(free, F.when(F.col("_tag_listed"), "tagged")).otherwise(_branch()))
        .select(
            "run_id",
            F.col("_want").alias("requested_project"),
            F.col("_at").alias("requested_path"),
            F.coalesce("_want", "_slot").alias("project_id"),
            F.when(free, F.col("_pick_c")).otherwise(_picked()).alias("_picked"),
            "branch",
        )
        .filter(F.col("branch").isNotNull() & F.col("_picked").isNotNull())
    )
    found = _spread_pick(rows, paths)
    return found.select("run_id", "requested_project", "requested_path", "project_id", "cluster_id", "branch", *found.columns[6:])


def locate_clusters(paths: DataFrame, requests: DataFrame) -> DataFrame:
    """The one cluster of each request by the same rules: run_id, requested_project, requested_path, project_id, cluster_id.

    Every request gives one row; a request without project has a cluster only if a single one is selected.
    """
    usable = F.col("_listed") & F.col("_pick").isNotNull()
    columns = _wanted_branches() | {
        "_free": F.count(F.when(usable, 1)),
        "_free_project": F.max(F.when(usable, F.col("project_id"))),
        "_free_pick": F.max(F.when(usable, F.col("_pick"))),
    }
    rows = (
        _entries(paths, requests, "left").groupBy("run_id", "_want", "_at")
        .agg(*[c.alias(name) for name, c in columns.items()])
    )
    free, single = F.col("_want").isNull(), F.col("_free") == 1
    found = rows.select(
        "run_id",
        F.col("_want").alias("requested_project"),
        F.col("_at").alias("requested_path"),
        F.when(free, F.when(single, F.col("_free_project"))).otherwise(F.col("_want")).alias("project_id"),
        F.when(free, F.when(single, F.col("_free_pick"))).otherwise(_picked()).alias("_picked"),
    )
    return _spread_pick(found, paths)


def with_context(df: DataFrame) -> DataFrame:
    """Turn the bounds ``_low``/``_high`` of context ids into ``spark_context_id`` and ``context_error``."""
    same = F.col("_low") == F.col("_high")
    return (
        df.withColumn("spark_context_id", F.when(same, F.col("_low")))
        .withColumn(
            "context_error",
            F.when(F.col("_low").isNull(), K.NO_CLUSTER_FOR_TASKS).when(~same, K.MANY_CLUSTERS_FOR_TASKS),
        )
        .drop("_low", "_high")
    )


def located_context(rows: DataFrame) -> DataFrame:
    """:func:`with_context` of located requests; one without cluster has no ``context_error``."""
    return with_context(rows).withColumn("context_error", F.when(F.col("cluster_id").isNotNull(), F.col("context_error")))


def run_contexts(tasks: DataFrame) -> DataFrame:
    bounds = tasks.groupBy("run_id").agg(
        F.min("spark_context_id").alias("_low"), F.max("spark_context_id").alias("_high")
    )
    return with_context(bounds)


def run_end_times(tasks: DataFrame) -> DataFrame:
    return tasks.groupBy("run_id").agg(F.max("end_time_ms").alias("end_time_ms"))


def locate_error(run_id: Column, project_id: Column) -> Column:
    return F.concat(
        F.lit("Failed to locate cluster in run "), run_id.cast("string"),
        F.lit(" for project "), F.coalesce(project_id, F.lit("None")),
    )
