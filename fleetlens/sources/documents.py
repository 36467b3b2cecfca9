"""JSON documents → typed tables. Every read has an explicit schema, so no pass over the data infers one.

``read_*`` take a path of JSON lines; the ``*_of`` functions take documents that are already a DataFrame, such
as the rows of a stream or of a text column parsed with :func:`parse_documents`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens import schemas as S
from fleetlens.functions.unnest import unnest
from fleetlens.sources import pages


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def parse_documents(texts: DataFrame, column: str, schema: str) -> DataFrame:
    """One typed document per JSON text of a column."""
    return texts.select(F.from_json(column, schema).alias("_doc")).select("_doc.*")


def run_tasks_of(runs: DataFrame) -> DataFrame:
    """One row per task of each run, in run order; a run without tasks has one row without task."""
    return runs.select("run_id", F.posexplode_outer("tasks").alias("pos", "t")).select(
        "run_id",
        "pos",
        F.col("t.task_key").alias("task_key"),
        F.col("t.new_cluster").alias("new_cluster"),
        F.col("t.job_cluster_key").alias("job_cluster_key"),
        F.col("t.cluster_instance.cluster_id").alias("cluster_id"),
        F.expr("try_cast(t.cluster_instance.spark_context_id AS bigint)").alias("spark_context_id"),
        F.col("t.state.result_state").alias("result_state"),
        F.col("t.end_time").alias("end_time_ms"),
    )


def run_job_clusters_of(runs: DataFrame) -> DataFrame:
    return _keyed_clusters(runs, "run_id", F.col("job_clusters"))


def job_clusters_of(jobs: DataFrame) -> DataFrame:
    return _keyed_clusters(jobs, "job_id", F.col("settings.job_clusters"))


def _keyed_clusters(df: DataFrame, owner: str, clusters: Column) -> DataFrame:
    return unnest(df, clusters, [owner], "c", "pos").select(
        owner, "pos", F.col("c.job_cluster_key").alias("job_cluster_key"), F.col("c.new_cluster").alias("new_cluster")
    )


def job_tasks_of(jobs: DataFrame) -> DataFrame:
    return jobs.select("job_id", F.posexplode_outer("settings.tasks").alias("pos", "t")).select(
        "job_id", "pos", F.col("t.task_key").alias("task_key"), F.col("t.new_cluster").alias("new_cluster"),
        F.col("t.job_cluster_key").alias("job_cluster_key"),
    )


def cluster_events_of(pages: DataFrame) -> DataFrame:
    """One row per event of each page, with its position in the page."""
    return unnest(pages, F.col("events"), ["cluster_id", "page_no", "total_count"], "e", "pos").select(
        "cluster_id", "page_no", "pos", F.col("e.timestamp").alias("ts_ms"), F.col("e.type").alias("type"),
        F.col("e.details.reason.parameters").alias("parameters"), "total_count",
    )


def read_run_tasks(spark: SparkSession, path: str) -> DataFrame:
    return run_tasks_of(read_documents(spark, path, S.RUN))


def read_run_job_clusters(spark: SparkSession, path: str) -> DataFrame:
    return run_job_clusters_of(read_documents(spark, path, S.RUN))


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    return read_documents(spark, path, S.JOB)


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    return read_documents(spark, path, S.CLUSTER)


def read_cluster_events(spark: SparkSession, path: str) -> DataFrame:
    return cluster_events_of(read_documents(spark, path, S.EVENT_PAGE))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored pages, one JSON document a line, as text (see :mod:`fleetlens.sources.pages`)."""
    return spark.read.text(path)


def read_instances(spark: SparkSession, path: str) -> DataFrame:
    return pages.instances(read_pages(spark, path))


def read_volumes(spark: SparkSession, path: str) -> DataFrame:
    return pages.volumes(read_pages(spark, path))


def read_vms(spark: SparkSession, path: str) -> DataFrame:
    return pages.vms(read_pages(spark, path))


def read_vm_views(spark: SparkSession, path: str) -> DataFrame:
    return pages.vm_views(read_pages(spark, path))


def read_projects(spark: SparkSession, path: str) -> DataFrame:
    """Projects; documents as delivered carry ``id``, derived ones ``project_id``."""
    docs = read_documents(spark, path, f"{S.PROJECT}, id string")
    return docs.withColumn("project_id", F.coalesce("project_id", "id")).drop("id")


def read_submissions(spark: SparkSession, path: str) -> DataFrame:
    return read_documents(spark, path, S.SUBMISSION)


def read_recommendations(spark: SparkSession, path: str) -> DataFrame:
    return read_documents(spark, path, S.RECOMMENDATION)


def read_workspaces(spark: SparkSession, path: str) -> DataFrame:
    return read_documents(spark, path, S.WORKSPACE)


def read_cluster_info(spark: SparkSession, path: str) -> DataFrame:
    """Single-file snapshots ``{base}/sync_data/{context}/{cloud}_cluster_info.json``, one row per file.

    The context comes from the path; both clouds' names of the timeline list become ``instance_timelines``.
    """
    file = F.col("_metadata.file_path")
    docs = (
        spark.read.schema(S.CLUSTER_INFO)
        .option("pathGlobFilter", "*_cluster_info.json")
        .option("recursiveFileLookup", "true")
        .option("multiLine", "true")
        .json(path)
    )
    return docs.select(
        F.regexp_extract(file, r"/sync_data/([0-9]+)/", 1).cast("bigint").alias("spark_context_id"),
        F.regexp_extract(file, r"/(aws|azure)_cluster_info\.json$", 1).alias("platform"),
        "instances",
        "volumes",
        F.coalesce("instance_timelines", "timelines").alias("instance_timelines"),
    )
