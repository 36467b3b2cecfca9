"""Streaming forms of waiting for runs, recommendations and terminations (for logs see :mod:`logwaits`).

A key's wait ends with its first decisive observation in time order and is emitted once. State is one row per key that has ended, or whose
waiting time counts; with ``forget_after`` it goes when the stream's time has passed the end by that much, so the state's size follows what
happens in that time and not all that ever happened. Observations later than that are dropped by the watermark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fleetlens import constants as K

# What ends a wait: the observations of one key and micro-batch in time order, and the time of the key's first one → the rest of the row.
Decide = Callable[[pd.DataFrame, int], tuple | None]


class _FirstEnd(StatefulProcessor):
    def __init__(self, decide: Decide, order: list[str], columns: list[str], timed: bool, forget_ms: int):
        self.decide, self.order, self.columns, self.timed, self.forget_ms = decide, order, columns, timed, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.wait = handle.getValueState("wait", "start bigint, done boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows)).sort_values(self.order, kind="stable")
        start, done = self.wait.get() if self.wait.exists() else (None, False)
        out = []
        if not done:
            first = int(frame[self.order[0]].iloc[0])
            start = first if start is None else min(int(start), first)
            end = self.decide(frame, start)
            if end is not None:
                out, done = [(*key, *end)], True
            if done or self.timed:
                self.wait.update((start, done))
            if self.forget_ms and (done or self.timed):
                self.handle.registerTimer(int(frame["observed_at"].max().timestamp() * 1000) + self.forget_ms)
        yield pd.DataFrame(out, columns=self.columns)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.wait.clear()
        yield pd.DataFrame([], columns=self.columns)

    def close(self) -> None:
        pass


def _first_end(
    rows: DataFrame, key: str, order: list[str], decide: Decide, out: str, at: Column, forget_after: str | None, timed: bool = False
) -> DataFrame:
    rows = rows.withColumn("observed_at", at)
    if forget_after:
        rows = rows.withWatermark("observed_at", forget_after)
    forget_ms = int(pd.Timedelta(forget_after).total_seconds() * 1000) if forget_after else 0
    columns = [field.split()[0] for field in out.split(", ")]
    return rows.groupBy(key).transformWithStateInPandas(
        statefulProcessor=_FirstEnd(decide, order, columns, timed, forget_ms), outputStructType=out, outputMode="Update",
        timeMode="EventTime" if forget_after else "None")


def _run_end(frame: pd.DataFrame, start: int) -> tuple | None:
    failed = frame["error_code"].notna()
    ends = frame[frame["state"].isin(K.FINAL_RUN_STATES) | failed]
    if not len(ends):
        return None
    code = ends["error_code"].iloc[0]
    return (ends["state"].iloc[0], None) if pd.isna(code) else (None, f"{K.API_ERROR_CODE}: {code}")


def final_runs(observations: DataFrame, forget_after: str | None = None) -> DataFrame:
    """Runs that have ended, by their first final state in time order: ``(run_id, state, error)``.

    ``observations(run_id, state, error_code, ts, seq)``, ``ts`` in microseconds.
    """
    return _first_end(observations, "run_id", ["ts", "seq"], _run_end, "run_id bigint, state string, error string",
                      F.timestamp_micros("ts"), forget_after)


def _recommendation_end(frame: pd.DataFrame, start: int) -> tuple | None:
    ends = frame["state"][frame["state"].isin(["SUCCESS", "FAILURE"])]
    return ("ready" if ends.iloc[0] == "SUCCESS" else K.RECOMMENDATION_FAILED,) if len(ends) else None


def final_recommendations(observations: DataFrame, forget_after: str | None = None) -> DataFrame:
    """Recommendations that are ready or have failed: ``(recommendation_id, outcome)``; observations as of :func:`final_runs`."""
    return _first_end(observations, "recommendation_id", ["ts", "seq"], _recommendation_end, "recommendation_id bigint, outcome string",
                      F.timestamp_micros("ts"), forget_after)


def _termination(timeout_seconds: int) -> Decide:
    def decide(frame: pd.DataFrame, start: int) -> tuple | None:
        failed = frame["error_code"].notna()
        going_on = (frame["state"] == "TERMINATING") & ~failed
        ends = frame[~going_on | (frame["seen_s"] - start > timeout_seconds)]
        if not len(ends):
            return None
        code, state = ends["error_code"].iloc[0], ends["state"].iloc[0]
        if not pd.isna(code):
            return (f"{K.API_ERROR_CODE}: {code}",)
        if state == "TERMINATED":
            return ("ok",)
        if state == "TERMINATING":
            return (f"Cluster failed to terminate after waiting {timeout_seconds} seconds",)
        return (f"Unexpected cluster state: {state}",)

    return decide


def terminations(
    observations: DataFrame, timeout_seconds: int = K.TERMINATION_TIMEOUT_SECONDS, forget_after: str | None = None
) -> DataFrame:
    """One row per cluster once waiting for its termination ends: ``(cluster_id, outcome)``.

    ``observations(cluster_id, seen_s, seq, state, error_code)``. A cluster's waiting time counts from its first observation, so its state
    is kept while it goes on, too.
    """
    return _first_end(observations, "cluster_id", ["seen_s", "seq"], _termination(timeout_seconds), "cluster_id bigint, outcome string",
                      F.timestamp_seconds("seen_s"), forget_after, timed=True)
