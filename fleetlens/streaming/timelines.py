"""Instance lifetimes from a stream of polls.

The stream has one heartbeat row per poll (``instance_id`` NULL) and one row per instance the poll saw running:
``(cluster_id string, poll_us bigint, instance_id string, ok boolean, state string)``. A poll is over once a later
one of its cluster shows up, so its rows may be spread over micro-batches.

State is a map per cluster with an entry per open interval, and the cluster's clock. An interval's entry goes when the interval is over; with
``forget_after`` a cluster that is silent for so long is closed and leaves no state. A micro-batch's polls of a cluster are worked on
as a whole, and only intervals that it changed are emitted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from fleetlens.functions.timefmt import iso_offset
from fleetlens.operators.reports import info_documents
from fleetlens.sinks import Destination, deliver, write_cluster_info

POLL_SCHEMA = "cluster_id string, poll_us bigint, instance_id string, ok boolean, state string"
OUT = (
    "cluster_id string, instance_id string, first_us bigint, last_us bigint, is_active boolean, as_of_us bigint,"
    " late_rows bigint"
)
_COLUMNS = [field.split()[0] for field in OUT.split(", ")]


def lifetimes(
    open_: dict[str, tuple[int, int]], clock: int, polls: np.ndarray, ids: np.ndarray, seen: np.ndarray
) -> tuple[pd.DataFrame, int]:
    """Intervals after some polls: ``(instance_id, first_us, last_us, open)``, and the cluster's clock.

    ``open_``: instance → (first, last) at poll ``clock`` (-1: none yet); ``polls``: their times; ``ids``, ``seen``: sightings. An
    interval is over when a poll that missed it is over.
    """
    times = np.unique(np.concatenate([np.array([clock] if clock >= 0 else [], np.int64), polls, seen]))
    carried = [(k, 0 if last == clock else -1, first, last) for k, (first, last) in open_.items()]
    at = np.searchsorted(times, seen)
    rows = pd.DataFrame({
        "instance_id": [c[0] for c in carried] + list(ids), "pos": [c[1] for c in carried] + at.tolist(),
        "first_us": [c[2] for c in carried] + seen.tolist(), "last_us": [c[3] for c in carried] + seen.tolist(),
    }).sort_values(["instance_id", "pos", "first_us"], kind="stable")
    opens = (rows["instance_id"] != rows["instance_id"].shift()) | (rows["pos"] > rows["pos"].shift() + 1)
    runs = rows.groupby(opens.cumsum()).agg(
        instance_id=("instance_id", "first"), first_us=("first_us", "first"), last_us=("last_us", "max"), pos=("pos", "max"))
    runs["open"] = runs["pos"] >= len(times) - 2
    return runs.drop(columns="pos"), int(times[-1]) if len(times) else clock


class _Timelines(StatefulProcessor):
    def __init__(self, stop_on_termination: bool, forget_us: int):
        self.stop_on_termination = stop_on_termination
        self.forget_us = forget_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.clock = handle.getValueState("clock", "poll_us bigint, stop_us bigint, late_rows bigint, timer_ms bigint")
        self.open = handle.getMapState("open", "instance_id string", "first_us bigint, last_us bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows))
        clock, stop, late, timer = (int(x) for x in (self.clock.get() if self.clock.exists() else (-1, -1, 0, -1)))
        now = frame["poll_us"] >= clock
        late += int((~now).sum())
        frame = frame[now]
        if self.stop_on_termination and stop < 0:
            ended = frame[frame["instance_id"].isna() & (frame["state"] == "TERMINATED")]
            stop = int(ended["poll_us"].min()) if len(ended) else -1
        if stop >= 0:
            frame = frame[frame["poll_us"] <= stop]
        carried = {k[0]: (int(v[0]), int(v[1])) for k, v in self.open.iterator()} if self.open.exists() else {}
        seen = frame[frame["instance_id"].notna()]
        runs, after = lifetimes(
            carried, clock, frame["poll_us"].to_numpy(np.int64), seen["instance_id"].to_numpy(), seen["poll_us"].to_numpy(np.int64))
        out = []
        for r in runs.itertuples(index=False):
            span, active = (int(r.first_us), int(r.last_us)), r.last_us == after
            before = carried.get(r.instance_id)
            if r.open:
                if before != span:
                    self.open.updateValue((r.instance_id,), span)
            elif before is not None and before[0] == r.first_us:
                self.open.removeKey((r.instance_id,))
            # Nothing is said again: an interval is news if it is new, went on, or has just been missed or ended.
            if before != span or active != (span[1] == clock):
                out.append((key[0], r.instance_id, *span, bool(active), after, late))
        if self.forget_us and after >= 0:
            if timer >= 0:
                self.handle.deleteTimer(timer)
            timer = (after + self.forget_us) // 1000 + 1
            self.handle.registerTimer(timer)
        self.clock.update((after, stop, late, timer))
        yield pd.DataFrame(out, columns=_COLUMNS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        poll, _, late, _ = self.clock.get()
        spans = [(key[0], k[0], v[0], v[1], False, poll, late) for k, v in self.open.iterator()] if self.open.exists() else []
        self.open.clear()
        self.clock.clear()
        yield pd.DataFrame(spans, columns=_COLUMNS)

    def close(self) -> None:
        pass


def timeline_updates(polls: DataFrame, stop_on_termination: bool = False, forget_after: str | None = None) -> DataFrame:
    """Changes of intervals: each retired interval once, each open one after every micro-batch that changed it.

    Rows older than the newest poll of their cluster are dropped and counted in ``late_rows``. ``forget_after`` (such as
    ``7 days``) ends the intervals of a cluster that was silent for so long and drops its state; rows later than that are dropped by the
    watermark. Without it a cluster's clock is kept for ever.
    """
    worked = polls.filter("ok").withColumn("at", F.timestamp_micros("poll_us"))
    forget_us = int(pd.Timedelta(forget_after).total_seconds() * 1_000_000) if forget_after else 0
    if forget_after:
        worked = worked.withWatermark("at", forget_after)
    return worked.groupBy("cluster_id").transformWithStateInPandas(
        statefulProcessor=_Timelines(stop_on_termination, forget_us), outputStructType=OUT, outputMode="Update",
        timeMode="EventTime" if forget_after else "None")


def current_timelines(updates: DataFrame) -> DataFrame:
    """The newest state of every interval."""
    newest = F.max_by(F.struct("last_us", "is_active"), F.struct("as_of_us", "last_us"))
    return (
        updates.groupBy("cluster_id", "instance_id", "first_us").agg(newest.alias("_n"))
        .select("cluster_id", "instance_id", "first_us", "_n.last_us", "_n.is_active")
    )


def write_batch(path: str) -> Callable[[DataFrame, int], None]:
    """A sink that may see a batch twice: each batch replaces its own folder."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def read_updates(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def publish(
    spark: SparkSession, updates_path: str, clusters: DataFrame, info_path: str,
    sections: dict[str, DataFrame] | None = None,
) -> None:
    """Write the cluster-info documents of ``clusters(cluster_id, spark_context_id, writable)`` as the stream has
    them now, with other ``sections`` (instances, volumes) if given; documents of other clusters stay."""
    updates = read_updates(spark, updates_path).join(clusters.select("cluster_id"), "cluster_id", "left_semi")
    spans = current_timelines(updates).select(
        "cluster_id", "instance_id",
        iso_offset(F.timestamp_micros("first_us")).alias("first_seen_running_time"),
        iso_offset(F.timestamp_micros("last_us")).alias("last_seen_running_time"),
    )
    write_cluster_info(info_documents(clusters, {"instance_timelines": spans, **(sections or {})}), info_path)


def start_monitor(
    polls: DataFrame,
    destination: Destination,
    checkpoint: str,
    override: dict | None = None,
    stop_on_termination: bool = False,
    forget_after: str | None = None,
    interval: str | None = None,
    documents: tuple[DataFrame, str] | None = None,
) -> StreamingQuery:
    """Follow all clusters of a poll stream: every ``interval`` for ever, or, without one, process what is there and end.

    Started again on the same checkpoint it applies only the polls that came since. ``override`` may name
    another ``filesystem`` and ``base_prefix``, or a ``write_function`` for the ``lambda`` filesystem. With ``documents``, a table
    ``(cluster_id, spark_context_id, writable)`` and a path, every micro-batch also rewrites the cluster-info documents of the clusters it
    changed; the destination must then be a path, as the documents are made from all updates there.
    """
    target = destination.overridden(override)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        deliver(batch, target, lambda rows, prefix: write_batch(prefix)(rows, batch_id))
        if documents:
            clusters, path = documents
            changed = clusters.join(batch.select("cluster_id").distinct(), "cluster_id", "left_semi")
            publish(batch.sparkSession, target.prefix, changed, path)
        batch.unpersist()

    updates = timeline_updates(polls, stop_on_termination, forget_after)
    writer = updates.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(sink)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()
