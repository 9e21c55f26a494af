"""Global sessions as a stateful processor (ST8).

One chain of events runs over the whole stream: a session ends when no event of
any zone follows within the gap.  A session window cannot count per zone with
a state of one entry a zone, so the chain is an arbitrary stateful operator: a
map state holds the open sessions with a counter per zone that occurs in them,
and an event-time timer at the last event + gap emits and forgets a session.

The chain is one key by definition.  What reaches it is reduced first: each
Arrow batch of a task becomes its runs (events no farther apart than the gap)
with one count per zone, so the key's task gets runs x zones, not events.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from farebox.streaming.sinks import prepare_state_store

RUNS = "chain int, first long, last long, zone int, n long"
SESSIONS = "session_start timestamp, session_end timestamp, PULocationID int, num_trips long"


def split_runs(first: pd.Series, last: pd.Series, gap_us: int) -> pd.Series:
    """Number of the run of each interval (sorted by start): a new run begins
    more than ``gap_us`` behind all before it."""
    return (first > last.cummax().shift(fill_value=first.iloc[0]) + gap_us).cumsum()


def runs_of(events: pd.DataFrame, gap_us: int) -> pd.DataFrame:
    """``first, last, zone, n`` per run and zone; first and last are the run's."""
    events = events.sort_values("first", kind="stable", ignore_index=True)
    events["run"] = split_runs(events["first"], events["last"], gap_us)
    out = events.groupby(["run", "zone"], dropna=False, as_index=False)["n"].sum()
    ends = events.groupby("run").agg(first=("first", "min"), last=("last", "max"))
    return out.join(ends, on="run")


class ZoneSessions(StatefulProcessor):
    """State ``open``: session start -> last event, trips without a zone, and
    the zones with a counter each.  Runs of a micro-batch and the open sessions
    within the gap of each other merge; what meets no open session and ends at
    or behind the watermark is late and dropped.  One timer stands at the
    earliest end of an open session."""

    def __init__(self, gap_us: int):
        self.gap_us = gap_us

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "start long", "last long, unknown long, zones array<int>, counts array<long>")

    def _held(self) -> dict[int, tuple[int, dict]]:
        """start -> (last, zone -> trips) of the open sessions."""
        return {k[0]: (v[0], dict(zip(v[2], v[3])) | ({None: v[1]} if v[1] else {})) for k, v in self.open.iterator()}

    def _put(self, start: int, last: int, zones: dict) -> None:
        named = sorted(z for z in zones if z is not None)
        self.open.updateValue((start,), (last, zones.get(None, 0), named, [zones[z] for z in named]))

    def _set_timer(self, lasts: list[int]) -> None:
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        if lasts:
            # The first millisecond at which the session is over; timers fire when the watermark is past theirs.
            self.handle.registerTimer(-(-(min(lasts) + self.gap_us) // 1000) - 1)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        held = self._held()
        was = [pd.DataFrame({"first": s, "last": e, "zone": list(z), "n": list(z.values())}) for s, (e, z) in held.items()]
        # All of it is reduced already: runs and open sessions times zones.
        parts = pd.concat([*was, *rows], ignore_index=True)
        parts["zone"] = parts["zone"].astype("Int32")
        now = {}
        for (first, last), run in runs_of(parts, self.gap_us).groupby(["first", "last"]):
            zones = {None if pd.isna(z) else int(z): int(n) for z, n in zip(run["zone"], run["n"])}
            if int(last) + self.gap_us > watermark or any(int(first) <= s <= int(last) for s in held):
                now[int(first)] = int(last), zones
        for start in held.keys() - now.keys():
            self.open.removeKey((start,))
        for start, (last, zones) in now.items():
            if held.get(start) != (last, zones):
                self._put(start, last, zones)
        self._set_timer([last for last, _ in now.values()])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        held = self._held()
        over = {s: x for s, x in held.items() if x[0] + self.gap_us <= watermark}
        rows = [(s, last + self.gap_us, zone, n) for s, (last, zones) in over.items() for zone, n in zones.items()]
        for start in over:
            self.open.removeKey((start,))
        self._set_timer([last for s, (last, _) in held.items() if s not in over])
        if rows:
            out = pd.DataFrame(rows, columns=["session_start", "session_end", "PULocationID", "num_trips"])
            for c in ("session_start", "session_end"):
                out[c] = pd.to_datetime(out[c], unit="us")
            yield out.astype({"PULocationID": "Int32"})

    def close(self) -> None:
        pass


def session_global(trips: DataFrame, gap_seconds: int = 300, delay: str = "5 seconds", zone_col: str = "PULocationID") -> DataFrame:
    """ST8: trips per zone in each session of the one chain of all events
    (``event_time``); any zone, the null one included, is a counter of its
    own.  Rows without an event time belong to no session."""
    prepare_state_store(trips.sparkSession)  # map states and timers need RocksDB
    gap_us = gap_seconds * 1_000_000
    timed = trips.where(F.col("event_time").isNotNull()).withWatermark("event_time", delay)
    events = timed.select(F.unix_micros("event_time").alias("first"), F.col(zone_col).cast("int").alias("zone"))

    def reduce(parts):
        for part in parts:
            if len(part):
                part["last"], part["n"] = part["first"], 1
                out = runs_of(part, gap_us).assign(chain=0)
                yield out[["chain", "first", "last", "zone", "n"]].astype({"zone": "Int32"})

    runs = events.mapInPandas(reduce, RUNS)
    return runs.groupBy("chain").transformWithStateInPandas(ZoneSessions(gap_us), SESSIONS, "append", "eventTime")
