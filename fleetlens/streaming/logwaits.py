"""Waiting for event logs on a stream, one state value per block of directories.

The stream holds two kinds of rows of a directory (:data:`SCHEMA`): a *wait* (``run_id`` set) says that a run waits for the directory's log from
poll ``first_poll`` on, until ``deadline`` if it has one; a *look* (``run_id`` NULL) says what a poll found. Send a wait before its first poll.

Directories are taken in blocks of ``2 ** BLOCK_BITS`` ids in a row. State is one list (JSON) per block: what is known of each open wait, read and
written once per block and micro-batch, since a call per wait, and a timer per wait, cost more than all the work. A wait leaves the list when
it ends, so nothing is kept of directories nobody waits for. Looks may come in any order within a micro-batch. Needs the RocksDB state store (see
``session.tune``).
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fleetlens import constants as K

SCHEMA = (
    "dir bigint, at timestamp, run_id bigint, scheme string, run_end_ms bigint, first_poll bigint, deadline timestamp,"
    " poll_no bigint, total_size bigint, any_empty boolean, final_mtime_ms bigint"
)
OUT = "dir bigint, run_id bigint, poll_no bigint, outcome string"
BLOCK_BITS = 6
# Stand-ins for NULL, so that numbers stay whole in pandas.
_NONE, _NEVER = -(2**62), 2**62
_NO_LOG = "No eventlog found"


def wait_rows(waits: DataFrame, at: str = "at") -> DataFrame:
    """Waits ``(dir, run_id, scheme, run_end_ms, first_poll, deadline)`` with their time as rows of the stream."""
    given = {c: F.col(c) for c in ("dir", "run_id", "scheme", "run_end_ms", "first_poll", "deadline")}
    return _rows(waits, {**given, "at": F.col(at)})


def look_rows(looks: DataFrame, at: str = "at") -> DataFrame:
    """Summaries of polls (``eventlog.poll_summaries``) with their time as rows of the stream."""
    given = {c: F.col(c) for c in ("dir", "poll_no", "total_size", "any_empty", "final_mtime_ms")}
    return _rows(looks, {**given, "at": F.col(at)})


def _rows(df: DataFrame, given: dict) -> DataFrame:
    fields = [f.strip().split() for f in SCHEMA.split(",")]
    return df.select(*[given.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in fields])


def _tuples(frame: pd.DataFrame, *columns: str) -> Iterator[tuple]:
    return zip(*(frame[c].tolist() for c in columns), strict=True)


def _ended(rows: list[tuple]) -> pd.DataFrame:
    whole = {"dir": "Int64", "run_id": "Int64", "poll_no": "Int64"}
    return pd.DataFrame(rows, columns=["dir", "run_id", "poll_no", "outcome"]).astype(whole)


class _LogWaits(StatefulProcessor):
    def __init__(self, limit: int):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waits = handle.getValueState("waits", "waits string, timer bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows))
        if key[0] is None or pd.isna(key[0]):
            frame["dir"] = None
        waits, timer = self._kept()
        is_wait = frame["run_id"] != _NONE
        out = []
        for place, run, scheme, *wait in _tuples(frame[is_wait], "dir", "run_id", "scheme", "run_end_ms", "first_poll", "deadline_ms"):
            if scheme in ("s3", "dbfs"):
                end, first, deadline = wait
                waits[place, run] = (scheme, end, first, first, 0, deadline)
            else:
                out.append((place, run, None, f"Unknown log destination: {scheme}" if scheme else K.NO_LOG_LOCATION))
        looks = defaultdict(list)
        if waits:
            for place, *look in _tuples(frame[~is_wait], "dir", "poll_no", "total_size", "any_empty", "final_mtime_ms"):
                looks[place].append(look)
        for seen in looks.values():
            seen.sort(key=lambda look: look[0])
        for (place, run), state in [w for w in waits.items() if w[0][0] in looks]:
            outcome, state = self._watched(state, looks[place])
            if outcome:
                out.append((place, run, *outcome))
                del waits[place, run]
            else:
                waits[place, run] = state
        if waits or self.waits.exists():
            self._keep(waits, timer)
        yield _ended(out)

    def _watched(self, state: tuple, looks: list[tuple]) -> tuple:
        scheme, end, first, due, size, deadline = state
        for n, total, any_empty, final_mtime_ms in looks:
            if n < due:
                continue
            # A DBFS directory that is missing from a poll ends the wait, and so does the last poll.
            if n >= first + self.limit or (scheme == "dbfs" and n > due):
                return (None, _NO_LOG), None
            flushed = final_mtime_ms != _NONE and final_mtime_ms >= end
            if flushed and (scheme == "s3" or (not any_empty and total == size)):
                return (n, "ready"), None
            if n == first + self.limit - 1:
                return (None, _NO_LOG), None
            due, size = n + 1, total
        return None, (scheme, end, first, due, size, deadline)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, passed = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        waits, timer = self._kept()
        # All that are over by now go at once, not each with a timer of its own.
        over = [w for w, state in waits.items() if state[5] != _NONE and (state[5] <= now or state[5] < passed)]
        for w in over:
            del waits[w]
        # The timer that has expired is gone.
        self._keep(waits, None if timer == now else timer)
        yield _ended([(*w, None, _NO_LOG) for w in over])

    def _kept(self) -> tuple[dict, int | None]:
        """Open waits by directory and run, and the block's only timer, which is set to the first deadline."""
        state = self.waits.get()
        return ({(w[0], w[1]): tuple(w[2:]) for w in json.loads(state[0])}, state[1]) if state else ({}, None)

    def _keep(self, waits: dict, timer: int | None) -> None:
        first = min((state[5] for state in waits.values() if state[5] != _NONE), default=None)
        if first != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if first is not None:
                self.handle.registerTimer(first)
        if waits:
            self.waits.update((json.dumps([(*key, *state) for key, state in waits.items()]), first))
        else:
            self.waits.clear()

    def close(self) -> None:
        pass


def ready_logs(rows: DataFrame, limit: int = K.LOG_POLL_LIMIT, delay: str = "0 seconds") -> DataFrame:
    """One row per wait once it ends: ``outcome`` is ``ready`` with the poll, or why it failed.

    The same outcomes as ``eventlog.ready_per_wait``; a wait with a deadline also ends when the stream's time passes it. ``delay`` is how late
    rows may be.
    """
    numbers = {c: F.coalesce(c, F.lit(_NONE)) for c in ("dir", "run_id", "poll_no", "total_size", "final_mtime_ms")}
    # A wait without a first poll or a run's end is never ready.
    numbers |= {c: F.coalesce(c, F.lit(_NEVER)) for c in ("run_end_ms", "first_poll")}
    deadline = F.coalesce(F.unix_millis("deadline"), F.lit(_NONE))
    dealt = rows.withWatermark("at", delay).withColumns({
        "_block": F.shiftright("dir", BLOCK_BITS), **numbers, "deadline_ms": deadline, "any_empty": F.coalesce("any_empty", F.lit(False))})
    return dealt.drop("deadline").groupBy("_block").transformWithStateInPandas(
        statefulProcessor=_LogWaits(limit), outputStructType=OUT, outputMode="Update", timeMode="EventTime")
