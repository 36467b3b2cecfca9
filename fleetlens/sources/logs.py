"""Log listings and log contents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens import schemas as S


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """Stored listings as JSON lines."""
    return spark.read.schema(S.LISTING).json(path)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """A live listing. Only file metadata is selected, so no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(
        "path", F.col("length").alias("file_size"), F.unix_millis("modificationTime").alias("mtime_ms")
    )


def read_log_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Lines of plain and gzipped log files with the file they come from."""
    lines = spark.read.option("recursiveFileLookup", "true").text(list(paths))
    return lines.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))
