"""Writers: cluster-info documents, log bundles, submissions, and routing to a user's function."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_INFO_KEYS = ["cluster_id", "spark_context_id"]
_INFO = "cluster_id string, spark_context_id bigint, section string, item string"
_COMMITS = "version bigint, is_whole boolean"


def _info_commits(spark: SparkSession, path: str) -> tuple[int, int]:
    """The newest version of the documents at ``path``, -1 without any, and the newest one that holds all documents."""
    try:
        commits = spark.read.schema(_COMMITS).parquet(f"{path}/commits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1, 0
    newest, whole = commits.agg(F.max("version"), F.max(F.when(F.col("is_whole"), F.col("version")))).first()
    return (-1 if newest is None else newest), (whole or 0)


def _write_info(documents: DataFrame, path: str, version: int, is_whole: bool) -> None:
    spark = documents.sparkSession
    rows = documents.select(*[F.col(f.name).cast(f.dataType) for f in StructType.fromDDL(_INFO)])
    # Few files, each with the documents of a range of clusters; a large document may take several.
    rows.hint("rebalance", *_INFO_KEYS).sortWithinPartitions(*_INFO_KEYS, "section").write.mode("overwrite").parquet(
        f"{path}/documents/version={version}")
    # Only now does the version count: a write that failed half-way leaves nothing to be seen and is overwritten.
    spark.range(1).select(F.lit(version).cast("bigint").alias("version"), F.lit(is_whole).alias("is_whole")).coalesce(1).write.mode(
        "append").parquet(f"{path}/commits")


def write_cluster_info(documents: DataFrame, path: str, version: int | None = None) -> int:
    """Replace the documents that have a header row in ``documents`` (see ``reports.info_documents``); others stay.

    Every write is a version, committed when it is complete; an emptied document is a header without items. The same
    ``version`` written again replaces itself, so a repeated micro-batch changes nothing. One writer at a time.
    """
    spark = documents.sparkSession
    if version is None:
        version = _info_commits(spark, path)[0] + 1
    _write_info(documents, path, version, False)
    return version


def _current_info(spark: SparkSession, path: str) -> DataFrame:
    """Header and item rows of the newest version of every document."""
    newest, whole = _info_commits(spark, path)
    if newest < 0:
        return spark.createDataFrame([], _INFO)
    rows = spark.read.schema(f"{_INFO}, version bigint").parquet(f"{path}/documents").filter(F.col("version").between(whole, newest))
    committed = spark.read.schema(_COMMITS).parquet(f"{path}/commits").select("version").distinct()
    headers = rows.filter("section IS NULL").join(committed, "version", "left_semi")
    current = headers.groupBy(*_INFO_KEYS).agg(F.max("version").alias("version"))
    return rows.join(current, [*_INFO_KEYS, "version"], "left_semi").drop("version")


def read_cluster_info_items(spark: SparkSession, path: str) -> DataFrame:
    """Items of the newest version of every document."""
    return _current_info(spark, path).filter("section IS NOT NULL")


def compact_cluster_info(spark: SparkSession, path: str) -> int:
    """Write all documents as one version; versions before it are no longer read and may be deleted."""
    version = _info_commits(spark, path)[0] + 1
    _write_info(_current_info(spark, path), path, version, True)
    return version


def write_log_bundle(lines: DataFrame, keys: list[str], path: str) -> None:
    """Lines of log files, gzipped, in one folder per ``keys`` value."""
    lines.select(*keys, "line").write.mode("overwrite").option("compression", "gzip").partitionBy(*keys).text(path)


def write_submissions(rows: DataFrame, path: str) -> None:
    """Append submissions that the table does not hold yet, so a repeated run adds nothing."""
    try:
        known = rows.sparkSession.read.schema(rows.schema).parquet(path).select("submission_id")
        rows = rows.join(known, "submission_id", "left_anti").select(*rows.columns)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    rows.write.mode("append").parquet(path)


def write_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


@dataclass(frozen=True)
class Destination:
    """Where reports go. An override replaces the filesystem and the prefix; ``lambda`` calls a function."""

    filesystem: str | None
    prefix: str | None
    write_function: Callable[[DataFrame], None] | None = None

    def overridden(self, override: dict | None) -> Destination:
        if not override:
            return self
        return Destination(
            override.get("filesystem", self.filesystem),
            override.get("base_prefix", self.prefix),
            override.get("write_function", self.write_function),
        )


def deliver(rows: DataFrame, destination: Destination, write: Callable[[DataFrame, str], None]) -> None:
    """Hand rows to the user's function, or ``write`` them under the destination's prefix."""
    if destination.filesystem == "lambda":
        if destination.write_function is None:
            raise ValueError("the lambda destination needs a write_function")
        destination.write_function(rows)
    elif destination.filesystem in ("s3", "dbfs", "file"):
        if not destination.prefix:
            raise ValueError("missing cluster log destination")
        write(rows, destination.prefix)
    else:
        raise ValueError(f"Unsupported filesystem: {destination.filesystem}")
