"""Cluster information, cluster reports and submissions.

The lists of a report (instances, timelines, disks, events, tasks) are unbounded, so a document is kept as rows
``(cluster_id, section, item)`` under one header row per cluster and is never gathered into one value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.status import check_envelope
from fleetlens.operators.events import redacted

SECTIONS = ["instances", "instance_timelines", "volumes"]


def choose_source(headers: DataFrame) -> DataFrame:
    """(cluster_id, source): the stored snapshot where there is one, else the live one.

    A document is taken as a whole; parts of the two are never mixed.
    """
    stored = F.bool_or(F.col("source") == "stored")
    return headers.groupBy("cluster_id").agg(F.when(stored, "stored").otherwise("live").alias("source"))


def _count(section: str) -> Column:
    return F.count(F.when(F.col("section") == section, 1))


def section_counts(items: DataFrame, keys: list[str]) -> DataFrame:
    return items.groupBy(*keys).agg(*[_count(s).alias(f"n_{s}") for s in SECTIONS])


def cluster_info(clusters: DataFrame, headers: DataFrame, items: DataFrame) -> DataFrame:
    """Per cluster the chosen source and its item counts; ``source`` is NULL when there is no document.

    ``headers(cluster_id, source)`` has one row per existing document, ``items(cluster_id, source, section, item)``
    its content. Both sources are counted in one grouping, then the chosen one's counts are taken.
    """
    parts = headers.select("cluster_id", "source", F.lit("header").alias("section")).unionByName(
        items.select("cluster_id", "source", "section")
    )

    def counts(source: str) -> list[Column]:
        own = F.col("source") == source
        return [
            F.count(F.when(own & (F.col("section") == s), 1)).alias(f"{source}_{s}") for s in ["header", *SECTIONS]
        ]

    counted = parts.groupBy("cluster_id").agg(*counts("stored"), *counts("live"))
    source = F.when(F.col("stored_header") > 0, "stored").when(F.col("live_header") > 0, "live")

    def chosen(section: str) -> Column:
        return F.when(F.col("source") == "stored", F.col(f"stored_{section}")).when(
            F.col("source") == "live", F.col(f"live_{section}")
        )

    return clusters.join(counted.hint("merge"), "cluster_id", "left").withColumn("source", source).select(
        "cluster_id", "platform", "source", *[chosen(s).alias(f"n_{s}") for s in SECTIONS]
    )


def chosen_items(headers: DataFrame, items: DataFrame) -> DataFrame:
    """The items of each cluster's chosen document.

    There are as many documents as clusters. A guess from file sizes would take them for a small table and gather them on the driver.
    """
    return items.join(choose_source(headers).hint("merge"), ["cluster_id", "source"])


def info_message() -> Column:
    """Why a cluster without the information it needs has no report."""
    return F.when(
        F.col("platform") == "azure", F.concat(F.lit("Unable to find cluster information for cluster `"), F.col("cluster_id"), F.lit("`."))
    ).otherwise(
        F.concat(F.lit("Unable to find any active or recently terminated instances for cluster `"),
                 F.col("cluster_id"), F.lit("`."))
    )


def completeness(info: DataFrame, allow_incomplete: Column) -> DataFrame:
    """Flag missing sections; missing instances are an error unless incomplete reports are allowed.

    AWS treats an empty list as missing; Azure only a missing document. Timelines and disks degrade to empty.
    """
    no_document = F.col("source").isNull()
    empty = {s: F.coalesce(F.col(f"n_{s}"), F.lit(0)) == 0 for s in SECTIONS}
    azure = F.col("platform") == "azure"
    fatal = F.when(azure, no_document).otherwise(empty["instances"])
    return info.withColumns({
        "instances_missing": empty["instances"],
        "timelines_missing": empty["instance_timelines"],
        "volumes_missing": empty["volumes"],
        "info_error": F.when(fatal & ~F.coalesce(allow_incomplete, F.lit(False)), info_message()),
    })


def report_columns() -> dict[str, Column]:
    """Section sizes of a report: disks only on AWS, lists that were not found as empty (Azure: as NULL)."""
    azure = F.col("platform") == "azure"
    return {
        "n_instances": F.when(F.col("source").isNotNull(), F.col("n_instances")),
        "n_timelines": F.when(azure, F.col("n_instance_timelines")).otherwise(
            F.coalesce("n_instance_timelines", F.lit(0))
        ),
        "n_volumes": F.when(~azure, F.coalesce("n_volumes", F.lit(0))),
    }


def cluster_reports(info: DataFrame, events: DataFrame, plan_type: str, compute_type: str) -> DataFrame:
    """Header row of each cluster's report; ``events(cluster_id)`` has one row per cluster event."""
    check_envelope(plan_type, compute_type)
    counted = events.groupBy("cluster_id").agg(F.count("*").alias("n_events"))
    sections = {k: F.when(F.col("info_error").isNull(), c) for k, c in report_columns().items()}
    return info.join(counted, "cluster_id", "left").select(
        "cluster_id", "platform",
        F.lit(plan_type).alias("plan_type"), F.lit(compute_type).alias("compute_type"),
        *[c.alias(name) for name, c in sections.items()],
        F.coalesce("n_events", F.lit(0)).alias("n_events"),
        "info_error",
    )


def info_documents(clusters: DataFrame, sections: dict[str, DataFrame]) -> DataFrame:
    """The cluster-info documents to write: ``(cluster_id, spark_context_id, section, item)``.

    Each document has a header row, whose ``section`` is NULL, and a row per item, so a document without items is a document, too.
    ``clusters(cluster_id, spark_context_id, writable)``; a cluster without context or destination is not
    written. Each section is a table with ``cluster_id``; its other columns become the JSON ``item``.
    """
    targets = clusters.filter(F.col("spark_context_id").isNotNull() & F.col("writable")).select(
        "cluster_id", "spark_context_id"
    )
    parts = [
        rows.select(
            "cluster_id", F.lit(name).alias("section"),
            F.to_json(F.struct(*[c for c in rows.columns if c != "cluster_id"])).alias("item"),
        )
        for name, rows in sections.items()
    ]
    nothing = F.lit(None).cast("string")
    headers = targets.distinct().withColumns({"section": nothing, "item": nothing})
    return reduce(DataFrame.unionByName, parts).join(targets, "cluster_id").unionByName(headers)


def submission_id(run_id: Column, project_id: Column, cluster_id: Column) -> Column:
    """A fixed id per (run, project, cluster), so a repeated job writes the same submissions again."""
    return F.sha2(F.concat_ws("|", run_id.cast("string"), project_id, cluster_id), 256)


def submission_items(
    submitted: DataFrame, tasks: DataFrame, events: DataFrame, headers: DataFrame, items: DataFrame
) -> DataFrame:
    """What each submission carries, one row per item: ``(submission_id, section, item)``, items as JSON.

    ``submitted(submission_id, run_id, cluster_id, platform)``. Error texts are taken out of the events; disks
    belong to AWS reports only.
    """
    # As many as runs, though small when compressed in files: never broadcast.
    keyed = submitted.select("submission_id", "run_id", "cluster_id", "platform").hint("merge")
    task = F.to_json(F.struct("task_key", "result_state", "end_time_ms"))
    event = F.to_json(F.struct("type", redacted(F.col("parameters")).alias("parameters")))
    by_cluster = keyed.select("cluster_id", "submission_id", "platform")
    own_events = (
        events.select("cluster_id", "type", "parameters").join(by_cluster, "cluster_id")
        .select("submission_id", F.lit("cluster_events").alias("section"), event.alias("item"))
    )
    # Submissions meet the choice of documents first, so that items move once.
    chosen = choose_source(headers).hint("merge").join(by_cluster, "cluster_id").hint("merge")
    kept = (F.col("section") != "volumes") | (F.col("platform") != "azure")
    parts = items.select("cluster_id", "source", "section", "item").join(chosen, ["cluster_id", "source"]).filter(kept)
    own_tasks = tasks.select("run_id", "cluster_id", "task_key", "result_state", "end_time_ms").join(keyed, ["run_id", "cluster_id"]).select(
        "submission_id", F.lit("tasks").alias("section"), task.alias("item"))
    columns = ["submission_id", "section", "item"]
    return own_tasks.unionByName(own_events).unionByName(parts.select(*columns))


def submissions(rows: DataFrame, product: Column) -> DataFrame:
    """Submission rows of ``(run_id, project_id, cluster_id)``."""
    return rows.select(
        submission_id(F.col("run_id"), F.col("project_id"), F.col("cluster_id")).alias("submission_id"),
        "run_id", "project_id", "cluster_id", product.alias("product"),
    )


def without_nulls(document: Column) -> Column:
    """JSON of a document, fields that are NULL left out at every level."""
    return F.to_json(document, {"ignoreNullFields": "true"})
