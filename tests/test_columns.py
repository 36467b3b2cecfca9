"""Column functions against the Python standard library."""

import datetime as dt
import uuid
from pathlib import PurePosixPath
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from fleetlens.functions import paths, status, timefmt
from fleetlens.operators.projects import is_uuid

URLS = [
    "s3://bucket/path", "s3://my_bucket/a/b/", "s3://bucket", "dbfs:/cluster-logs", "dbfs:/", "s3://b/x#frag",
    "s3://b/x?q=1", "https://host.example.com/a?b#c", "HTTP://Host/x", "file:/tmp/x", "plain/path", "",
]


def column(spark, values, make, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(make(F.col("v"))).collect()]


def test_urls(spark):
    parsed = [urlparse(u) for u in URLS]
    assert column(spark, URLS, paths.url_scheme) == [p.scheme for p in parsed]
    assert column(spark, URLS, paths.url_authority) == [p.netloc for p in parsed]
    assert column(spark, URLS, paths.url_path) == [p.path for p in parsed]


def test_log_destination_prefers_s3_and_strips(spark):
    rows = spark.createDataFrame(
        [("s3://bucket/path", "dbfs:/x", "c1"), (None, "dbfs:/cluster-logs/", "c2"), ("", "dbfs:/a", "c3"),
         (None, None, "c4"), ("s3://bucket", None, "c5")],
        "s3 string, dbfs string, id string",
    )
    got = rows.select(paths.log_destination(F.col("s3"), F.col("dbfs"), F.col("id")).alias("d")).select("d.*")
    assert [tuple(r) for r in got.collect()] == [
        ("s3://bucket/path", "s3", "bucket", "path/c1"),
        ("dbfs:/cluster-logs/", "dbfs", "", "cluster-logs/c2"),
        ("dbfs:/a", "dbfs", "", "a/c3"),
        (None, None, None, None),
        ("s3://bucket", "s3", "bucket", "c5"),
    ]


def test_file_stems(spark):
    names = ["a/eventlog", "a/eventlog.gz", "eventlog.json.gz", "eventlog.json", "x/eventlog-1.gz", ".hidden",
             "a/.gz", "a.b.c", "dir/", "a/eventlog.", "d.x/eventlog"]
    want = [PurePosixPath(n).stem for n in names]
    assert column(spark, names, paths.file_stem) == want
    assert column(spark, names[:5], paths.is_final_log) == [True, True, False, True, False]


def test_dbfs_path(spark):
    assert column(spark, ["/a/b/", "dbfs:/a/", "a"], paths.dbfs_path) == ["dbfs:/a/b", "dbfs:/a", "dbfs:/a"]


def test_host_and_platform(spark):
    hosts = ["https://adb-1.azuredatabricks.net", "https://dbc.cloud.databricks.com/?o=1", "https://x.example.com",
             "adb-1.azuredatabricks.net", None, ""]
    assert column(spark, hosts, paths.platform_of) == ["azure", "aws", None, None, None, None]
    assert column(spark, hosts, paths.normalized_host) == [
        "https://adb-1.azuredatabricks.net", "https://dbc.cloud.databricks.com", "https://x.example.com", "https://",
        None, None,
    ]


def test_uuid_spellings(spark):
    digits = "0123456789abcdef0123456789ABCDEF"
    values = [digits, str(uuid.UUID(digits)), "{" + digits + "}", "urn:uuid:" + str(uuid.UUID(digits)), "app-1",
              digits[:-1], digits[:-1] + "g", ""]

    def accepted(v):
        try:
            uuid.UUID(v)
            return True
        except ValueError:
            return False

    assert column(spark, values, is_uuid) == [accepted(v) for v in values]


def test_time_forms(spark):
    times = [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 3, 4, 5, 60), dt.datetime(2024, 1, 2, 3, 4, 5, 999999)]
    utc = [t.replace(tzinfo=dt.timezone.utc) for t in times]
    assert column(spark, times, timefmt.iso_naive, "timestamp_ntz") == [t.isoformat() for t in times]
    zoned = lambda c: timefmt.iso_offset(c.cast("timestamp"))
    assert column(spark, times, zoned, "timestamp_ntz") == [t.isoformat() for t in utc]
    assert column(spark, times, timefmt.iso_utc, "timestamp_ntz") == [t.isoformat() + "Z" for t in times]
    short = lambda c: timefmt.iso_utc(c, fraction=False)
    assert column(spark, times, short, "timestamp_ntz") == [t.replace(microsecond=0).isoformat() + "Z" for t in times]


def test_state_classes(spark):
    assert column(spark, ["SUCCESS", "TIMEDOUT", "RUNNING", None], status.is_final_run_state) == [True, True, False, False]
    assert column(spark, ["TERMINATED", "TERMINATING", "RESIZING", "ERROR", None], status.cluster_state_class) == [
        "done", "wait", "terminate", "Unexpected cluster state: ERROR", "Unexpected cluster state: None"
    ]
    assert column(spark, ["SUCCESS", "FAILURE", "x", None], status.recommendation_class) == [
        "ready", "Recommendation failed", "pending", "pending"
    ]


def test_running_instances(spark):
    code = "array<struct<code string>>"
    rows = spark.createDataFrame(
        [("aws", "running", None, None), ("aws", "stopped", None, None), ("aws", None, None, None),
         ("azure", None, [("ok",), ("PowerState/running",)], True), ("azure", None, [("PowerState/running",)], True),
         ("azure", None, [("ok",), ("PowerState/stopped",)], True), ("azure", None, None, True),
         ("azure", None, None, False)],
        f"p string, s string, st {code}, g boolean",
    )
    got = rows.select(status.is_running(F.col("p"), F.col("s"), F.col("st"), F.col("g"))).collect()
    assert [r[0] for r in got] == [True, False, False, True, False, False, False, True]


def test_errors_and_responses(spark):
    rows = spark.createDataFrame(
        [(None, "m"), ("404", "gone"), ("404", None), ("", "m")], "code string, message string"
    )
    got = rows.select(status.api_error(F.col("code"), F.col("message")).alias("e")).select("e.*").collect()
    assert [tuple(r) for r in got] == [
        (None, None), ("Databricks API Error", "404: gone"), ("Databricks API Error", "404: None"),
        ("Databricks API Error", "m"),
    ]
    pairs = spark.createDataFrame([("r", None), (None, "e"), ("r", "e"), (None, None)], "result string, error string")
    good, bad = status.split_responses(pairs)
    assert good.count() == 2
    assert {r.problem for r in bad.collect()} == {
        "must not provide both result and error", "must provide result or error"
    }


def test_envelope():
    status.check_envelope("Standard", "Jobs Compute", "aws")
    with pytest.raises(ValueError, match="Unknown plan type: Basic"):
        status.check_envelope("Basic", "Jobs Compute")
    with pytest.raises(ValueError, match="Unknown compute type"):
        status.check_envelope("Premium", "x")


@pytest.mark.parametrize(
    "url, override, want",
    [
        ("s3://bucket/path", {}, ("s3", "s3://bucket/path/c/sync_data/5/aws_cluster_info.json", None)),
        ("s3://bucket/path", {"override_filesystem": "file", "override_prefix": "test_file_path"},
         ("file", "test_file_path/sync_data/5/aws_cluster_info.json", None)),
        (None, {"override_filesystem": "file", "override_prefix": "test_file_path"},
         ("file", "test_file_path/sync_data/5/aws_cluster_info.json", None)),
        (None, {}, (None, None, "missing cluster log destination")),
        ("gs://bucket/path", {}, ("gs", None, "Unsupported filesystem: gs")),
    ],
)
def test_sink_targets(spark, url, override, want):
    df = spark.createDataFrame([(url,)], "u string").select(
        paths.log_destination(F.col("u"), F.lit(None), F.lit("c")).alias("log")
    )
    target = paths.sink_target(F.lit("aws"), F.col("log"), F.lit("c"), F.lit(5), **override)
    assert tuple(df.select(target.alias("t")).select("t.*").first()) == want
