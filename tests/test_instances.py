"""Lifetimes from polls against a literal state machine, in batch, step by step and as a stream."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from fleetlens.operators import instances as fl
from fleetlens.sinks import read_cluster_info_items
from fleetlens.sources import pages
from fleetlens.streaming import timelines as tl
from fleetlens.streaming.replay import replay

START = dt.datetime(2024, 1, 1)
POLL = "cluster_id string, poll_ts timestamp, ok boolean, state string"
OBS = "cluster_id string, poll_ts timestamp, instance_id string"


def history(seed, clusters=3, polls=40, ids=5):
    """Random polls: {cluster: [(time, ok, state, ids)]}; instances flap, some polls are empty or fail."""
    rng = random.Random(seed)
    out = {}
    for c in range(clusters):
        rows = []
        for n in range(polls):
            seen = {f"i{k}" for k in range(ids) if rng.random() < 0.6} if rng.random() < 0.9 else set()
            state = "TERMINATED" if rng.random() < 0.02 else "RUNNING"
            rows.append((START + dt.timedelta(hours=5 * n + c), rng.random() < 0.85, state, seen))
        out[f"c{c}"] = rows
    return out


def frames(spark, polls):
    rows = [(c, t, ok, s) for c, h in polls.items() for t, ok, s, _ in h]
    seen = [(c, t, i) for c, h in polls.items() for t, _, _, ids in h for i in ids]
    return spark.createDataFrame(rows, POLL), spark.createDataFrame(seen, OBS)


def machine(polls, only_ok=False, stop=False):
    """Intervals by following the polls of each cluster one by one."""
    out = set()
    for cluster, rows in polls.items():
        active, done = {}, []
        for time, ok, state, ids in rows:
            if only_ok and not ok:
                continue
            for i in ids:
                active.setdefault(i, [time, time])[1] = time
            for i in [i for i in active if i not in ids]:
                done.append((i, *active.pop(i), False))
            if stop and state == "TERMINATED":
                break
        out |= {(cluster, *d) for d in done} | {(cluster, i, *v, True) for i, v in active.items()}
    return out


def rows_of(df):
    return {tuple(r) for r in df.select("cluster_id", "instance_id", "first_seen", "last_seen", "is_active").collect()}


@pytest.mark.parametrize("seed, block", [(1, 4096), (2, 4), (3, 1), (4, 7)])
def test_batch_matches_the_machine(spark, monkeypatch, seed, block):
    monkeypatch.setattr(fl, "POLL_BLOCK", block)
    polls = history(seed)
    got = fl.instance_timelines(*frames(spark, polls))
    assert got.count() == len(rows_of(got))
    assert rows_of(got) == machine(polls)


def test_monitor_skips_failed_polls_and_stops(spark):
    for seed in (5, 6):
        polls = history(seed, clusters=4)
        rows, seen = frames(spark, polls)
        assert rows_of(fl.monitored_clusters(rows, seen)) == machine(polls, only_ok=True, stop=True)
        assert rows_of(fl.monitored_clusters(rows, seen, stop_on_termination=False)) == machine(polls, only_ok=True)


def test_steps_add_up_to_the_whole(spark):
    polls = {c: h[:6] for c, h in history(7).items()}
    polls["c2"] = polls["c2"][:4]  # not polled in the last two steps
    first = {c: h[:3] for c, h in polls.items()}
    rows, seen = frames(spark, first)
    state = fl.instance_timelines(rows, seen)
    for n in range(3, 6):
        now = {c: h[n:n + 1] for c, h in polls.items()}
        rows, seen = frames(spark, now)
        state = spark.createDataFrame(fl.monitor_step(state, rows, seen).collect(), state.schema)
    assert rows_of(state) == machine(polls)


def test_retired_at_poll(spark):
    polls = history(8)
    rows, seen = frames(spark, polls)
    want = {
        (c, i, h[n][0], h[n - 1][0])
        for c, h in polls.items() for n in range(1, len(h)) for i in h[n - 1][3] - h[n][3]
    }
    got = fl.retired_at_poll(rows, seen)
    assert {(r.cluster_id, r.instance_id, r.retired_at, r.last_seen) for r in got.collect()} == want


def stream_rows(spark, polls):
    def us(t):
        return int((t - dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000)

    rows = [(c, us(t), None, ok, s) for c, h in polls.items() for t, ok, s, _ in h]
    rows += [(c, us(t), i, ok, s) for c, h in polls.items() for t, ok, s, ids in h for i in ids]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, tl.POLL_SCHEMA)


def from_us(df):
    to_ts = lambda c: F.timestamp_micros(c)
    return rows_of(df.select("cluster_id", "instance_id", to_ts("first_us").alias("first_seen"),
                             to_ts("last_us").alias("last_seen"), "is_active"))


@pytest.mark.parametrize("slices, stop", [(1, False), (4, True), (7, False)])
def test_stream_matches_the_machine(spark, slices, stop):
    polls = history(9, clusters=2, polls=30)

    def operator(rows):
        return tl.timeline_updates(rows, stop_on_termination=stop)

    updates = replay(stream_rows(spark, polls), operator, "test", "poll_us", slices)
    assert from_us(tl.current_timelines(updates)) == machine(polls, only_ok=True, stop=stop)


def test_monitor_goes_on_from_its_checkpoint_and_calls_a_function(spark, tmp_path):
    polls = history(10, clusters=2, polls=12)
    source, checkpoint = f"{tmp_path}/in", f"{tmp_path}/checkpoint"
    got = []
    override = {"filesystem": "lambda", "write_function": lambda df: got.extend(df.collect())}
    for part in (slice(0, 5), slice(5, 12)):
        stream_rows(spark, {c: h[part] for c, h in polls.items()}).write.mode("append").parquet(source)
        stream = spark.readStream.schema(tl.POLL_SCHEMA).parquet(source)
        tl.start_monitor(stream, tl.Destination("s3", "s3://bucket/path"), checkpoint, override).awaitTermination()
    assert from_us(tl.current_timelines(spark.createDataFrame(got, tl.OUT))) == machine(polls, only_ok=True)


def test_monitored_clusters_are_published_as_documents(spark, tmp_path):
    rows = [("c", us, i, True, "RUNNING") for us, ids in ((1_000_000, ["a"]), (2_500_000, [])) for i in (None, *ids)]
    spark.createDataFrame(rows, tl.POLL_SCHEMA).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(tl.POLL_SCHEMA).parquet(f"{tmp_path}/in")
    tl.start_monitor(stream, tl.Destination("file", f"{tmp_path}/updates"), f"{tmp_path}/c").awaitTermination()
    clusters = spark.createDataFrame([("c", 7, True)], "cluster_id string, spark_context_id bigint, writable boolean")
    tl.publish(spark, f"{tmp_path}/updates", clusters, f"{tmp_path}/info")
    got = read_cluster_info_items(spark, f"{tmp_path}/info").collect()
    assert [(r.cluster_id, r.spark_context_id, r.section) for r in got] == [("c", 7, "instance_timelines")]
    assert json.loads(got[0].item) == {"instance_id": "a", "first_seen_running_time": "1970-01-01T00:00:01+00:00",
                                       "last_seen_running_time": "1970-01-01T00:00:01+00:00"}


def test_documents_follow_every_batch(spark, tmp_path):
    clusters = spark.createDataFrame([("c", 7, True), ("d", 8, True)], "cluster_id string, spark_context_id bigint, writable boolean")
    for us, ids in ((1_000_000, ["a"]), (2_000_000, ["a", "b"]), (3_000_000, [])):
        rows = [("c", us, i, True, "RUNNING") for i in (None, *ids)]
        spark.createDataFrame(rows, tl.POLL_SCHEMA).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(tl.POLL_SCHEMA).parquet(f"{tmp_path}/in")
        tl.start_monitor(stream, tl.Destination("file", f"{tmp_path}/updates"), f"{tmp_path}/c",
                         documents=(clusters, f"{tmp_path}/info")).awaitTermination()
    got = {json.loads(r.item)["instance_id"]: json.loads(r.item)["last_seen_running_time"]
           for r in read_cluster_info_items(spark, f"{tmp_path}/info").collect()}
    assert got == {"a": "1970-01-01T00:00:02+00:00", "b": "1970-01-01T00:00:02+00:00"}


def entries(spark, checkpoint, name="open"):
    return spark.read.format("statestore").option("stateVarName", name).load(checkpoint).count()


def test_state_holds_open_intervals_only_and_goes_with_a_silent_cluster(spark, tmp_path):
    """An interval's entry goes when it is over; a cluster that is silent for long leaves nothing."""
    hour = 3_600_000_000
    got, sizes = [], []
    override = {"filesystem": "lambda", "write_function": lambda df: got.extend(df.collect())}
    polls = [[("c", hour, list("abcdef"))], [("c", 2 * hour, ["a"]), ("c", 3 * hour, ["a"])], [("d", 60 * hour, ["z"])], [("d", 61 * hour, ["z"])]]
    for batch in polls:
        rows = [(c, us, i, True, "RUNNING") for c, us, ids in batch for i in (None, *ids)]
        spark.createDataFrame(rows, tl.POLL_SCHEMA).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(tl.POLL_SCHEMA).parquet(f"{tmp_path}/in")
        tl.start_monitor(stream, tl.Destination("file", "x"), f"{tmp_path}/c", override, forget_after="1 day").awaitTermination()
        sizes.append(entries(spark, f"{tmp_path}/c"))
    assert sizes[0] == 6 and sizes[1] == 1 and sizes[-1] == 1 and entries(spark, f"{tmp_path}/c", "clock") == 1
    last = {r.instance_id: (r.first_us, r.last_us, r.is_active) for r in sorted(got, key=lambda r: (r.as_of_us, not r.is_active))}
    assert last["a"] == (hour, 3 * hour, False) and last["b"] == (hour, hour, False) and last["z"] == (60 * hour, 61 * hour, True)
    # Nothing is said twice.
    assert len({tuple(r)[1:5] for r in got}) == len(got)


def test_late_polls_are_dropped_and_counted(spark, tmp_path):
    source = f"{tmp_path}/in"
    got = []
    override = {"filesystem": "lambda", "write_function": lambda df: got.extend(df.collect())}
    for us, ids in ((100, ["a"]), (50, ["b"]), (110, ["a"])):
        rows = [("c", us, None, True, "RUNNING"), *[("c", us, i, True, "RUNNING") for i in ids]]
        spark.createDataFrame(rows, tl.POLL_SCHEMA).write.mode("append").parquet(source)
        stream = spark.readStream.schema(tl.POLL_SCHEMA).parquet(source)
        tl.start_monitor(stream, tl.Destination("file", "x"), f"{tmp_path}/c", override).awaitTermination()
    last = got[-1]
    assert (last.instance_id, last.first_us, last.last_us, last.late_rows) == ("a", 100, 110, 2)
    assert {r.instance_id for r in got} == {"a"}


TAGS = [{"Key": "Vendor", "Value": "Databricks"}, {"Key": "ClusterId", "Value": "c1"}]


def listed(spark, *documents):
    return spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in documents], "value string")


def test_instances_and_volumes(spark):
    """Pages as delivered; whole instances stay, pages without a list and pages that are no JSON are empty."""
    def instance(name, state, tags):
        return {"InstanceId": name, "State": {"Name": state, "Code": 1}, "Tags": tags, "Placement": {"Zone": name}}

    found = fl.ec2_instances(pages.instances(listed(
        spark, {"Reservations": [{"Instances": [instance("i1", "running", TAGS), instance("i2", "stopped", TAGS)]},
                                 {"Instances": [instance("i3", "running", TAGS[:1])]}, {"Owner": "x"}]},
        {"Reservations": [{"Instances": [instance("i4", "running", None), {"InstanceId": "i5"}]}]}, {"Reservations": []}, {}, "no json", "null")))
    got = found.select("cluster_id", "instance_id", "state", F.try_variant_get("document", "$.Placement.Zone", "string")).collect()
    assert {tuple(r) for r in got} == {("c1", "i1", "running", "i1"), ("c1", "i2", "stopped", "i2")}
    volumes = pages.volumes(listed(spark, {"Volumes": [
        {"VolumeId": "v1", "Tags": TAGS[:1], "Attachments": [{"InstanceId": "i1", "Device": "d"}, {"InstanceId": "i2"}], "Size": 7},
        {"VolumeId": "v2", "Tags": TAGS[:1], "Attachments": [{"InstanceId": "i9"}]}]}, {"Volumes": [
            {"VolumeId": "v3", "Attachments": [{"InstanceId": "i1"}]}, {"VolumeId": "v4", "Tags": TAGS, "Attachments": []}], "NextToken": "t"}))
    assert [r.size for r in volumes.filter("VolumeId = 'v1'").select(F.try_variant_get("document", "$.Size", "int").alias("size")).collect()] == [7]
    attached = fl.ebs_volumes(volumes, found)
    assert [tuple(r) for r in attached.collect()] == [("c1", "v1")]
    assert [tuple(r) for r in fl.fleet_counts(found, attached).collect()] == [("c1", 2, 1)]


def test_vms_as_delivered(spark):
    vms = pages.vms(listed(spark, {"value": [
        {"name": "a", "tags": {"Vendor": "Databricks", "ClusterId": "c"}, "zones": ["1"]}, {"name": "b", "tags": None},
        {"name": "d", "tags": {"Vendor": "Databricks", "ClusterId": "c"}}]}, {"value": None}).withColumn("group_known", F.lit(True)))
    views = pages.vm_views(listed(spark, {"name": "a", "statuses": [{"code": "x"}, {"code": "PowerState/running"}]}, {"name": "d"}))
    rows = fl.azure_vms(vms, views).withColumns({"platform": F.lit("azure"), "state": F.lit(None).cast("string")})
    assert {(r.cluster_id, r.instance_id) for r in fl.running_only(rows).collect()} == {("c", "a")}
    assert {r.instance_id for r in rows.collect()} == {"a", "d"}


def test_inventory_keeps_unseen_instances(spark):
    rows = spark.createDataFrame(
        [("c", "a", 1, "running"), ("c", "a", 3, "stopped"), ("c", "b", 2, "running")],
        "cluster_id string, instance_id string, seen int, state string",
    )
    got = fl.inventory_latest(rows, ["seen"], ["seen", "state"])
    assert {tuple(r) for r in got.collect()} == {("c", "a", 3, "stopped"), ("c", "b", 2, "running")}
