"""Keyed state with event-time timers, for transformWithStateInPandas.

Rows arrive as flat frames with `ts` in epoch milliseconds and, where days matter, `day_no`: the day of ts in the session's time
zone, counted from 1970. A processor keeps one small value per key;
timers clear it, so that state does not outlive its use. Within a micro-batch rows count in order of ts.
"""

from __future__ import annotations

import itertools
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from .. import fixed

# Workers get these classes with the query and need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DAY = "day_no"  # a name with a leading underscore would not reach the frames


class FixIsNew(StatefulProcessor):
    """Correct is_new per device from the day of its first visit, which stays in state for good."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.visit = handle.getValueState("visit", "day long")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.visit.update((int(initialState["day"].iat[0]),))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # Rows only wait here while the device is unknown: the earliest of them decides, and a device
        # that first says '0' was here before.
        waiting = []
        if not self.visit.exists():
            waiting = [f for f in rows if len(f)]
            first = min((f.loc[f["ts"].idxmin(), ["ts", DAY, "is_new"]] for f in waiting), key=lambda r: r["ts"])
            self.visit.update((int(first[DAY]) - (0 if first["is_new"] == "1" else 1),))
        (day,) = self.visit.get()
        for frame in itertools.chain(waiting, rows):
            wrong = (frame["is_new"] == "1") & (frame[DAY] != day)
            yield frame.assign(is_new=frame["is_new"].mask(wrong, "0"))

    def close(self) -> None:
        pass


class DailyFirst(StatefulProcessor):
    """The first row per key and day, with the day before it on which the key was seen (-1: none).

    Rows of a day before the last one seen are left out. With ttl_ms a key is forgotten that long (in
    event time) after its last first row. With keep_all every row comes out, the first ones with
    is_first = 1.
    """

    def __init__(self, ttl_ms: int | None = None, keep_all: bool = False):
        self.ttl_ms, self.keep_all = ttl_ms, keep_all

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "day long, at long")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        day, at = int(initialState["day"].iat[0]), int(initialState["at"].iat[0])
        self.seen.update((day, at))
        if self.ttl_ms is not None:
            self.handle.registerTimer(at + self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # One row per day is held, however many rows the key has. State is asked and told once, and the days come out together.
        firsts = None
        for frame in rows:
            both = frame if firsts is None else pd.concat([firsts, frame])
            both = both.iloc[both["ts"].to_numpy().argsort(kind="stable")]
            both = both[both[DAY].notna().to_numpy()]
            again = both[DAY].duplicated().to_numpy()
            if self.keep_all and again.any():
                yield both[again].assign(previous_day=-1, is_first=0).drop(columns=DAY)
            firsts = both[~again]
        days = firsts[DAY].to_numpy().astype("int64")
        order = days.argsort()
        days, firsts = days[order], firsts.iloc[order]
        last, at = self.seen.get() or (-1, 0)
        new = days > last
        if new.any():
            now = int(firsts["ts"].iat[-1])
            self.seen.update((int(days[-1]), now))
            if self.ttl_ms is not None:
                if last >= 0:
                    self.handle.deleteTimer(at + self.ttl_ms)
                self.handle.registerTimer(now + self.ttl_ms)
        if new.any() or self.keep_all and len(days):
            before = np.maximum(np.concatenate([[last], days[:-1]]), last)
            out = firsts.assign(previous_day=before, is_first=new.astype("int32")).drop(columns=DAY)
            yield out if self.keep_all else out[new]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        yield from ()

    def close(self) -> None:
        pass


class UserJump(StatefulProcessor):
    """Entry pages followed by another entry, or by nothing within the timeout. Keeps the open entry."""

    def __init__(self, schema: StructType, timeout_ms: int = fixed.JUMP_TIMEOUT_MS):
        self.schema, self.timeout_ms = schema, timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", self.schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # A micro-batch is bounded by the rate limit of its source. The open entry takes its place among the new rows:
        # some of them may be older.
        names = self.schema.names
        frames = [f[names] for f in rows]
        if self.open.exists():
            held = pd.DataFrame([self.open.get()], columns=names)
            self.handle.deleteTimer(int(held["ts"].iat[0]) + self.timeout_ms)
            frames.insert(0, held.astype(frames[0].dtypes.to_dict()))
        frame = pd.concat(frames, ignore_index=True).sort_values("ts", kind="stable", ignore_index=True)
        entry, ts = frame["last_page_id"].isna().to_numpy(), frame["ts"].to_numpy()
        jumps = entry[:-1] & (entry[1:] | (ts[1:] - ts[:-1] >= self.timeout_ms))
        if entry[-1]:
            self.open.update(tuple(v if v is None or isinstance(v, str) else None if pd.isna(v) else getattr(v, "item", lambda v=v: v)()
                                   for v in frame.iloc[-1]))
            self.handle.registerTimer(int(ts[-1]) + self.timeout_ms)
        else:
            self.open.clear()
        yield frame.iloc[:-1][jumps]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.open.exists():
            yield pd.DataFrame([self.open.get()], columns=self.schema.names)
            self.open.clear()

    def close(self) -> None:
        pass


class FirstLogin(StatefulProcessor):
    """Per device: hold the earliest row of each day, emit it a while after the first arrival.

    A device's days are one value, and one timer stands for what is next: a row to emit, or a day to forget.
    """

    def __init__(self, schema: StructType, hold_ms: int = fixed.LOGIN_HOLD_MS, ttl_ms: int = fixed.STATE_TTL_MS):
        self.schema, self.hold_ms, self.ttl_ms = schema, hold_ms, ttl_ms
        day = StructType([StructField("day", LongType()), StructField("due", LongType()), StructField("row", schema)])
        self.state = StructType([StructField("timer", LongType()), StructField("days", ArrayType(day))])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", self.state)

    def _days(self) -> tuple[int | None, dict[int, tuple]]:
        """The timer, and per day its due time and its row (none: it is out)."""
        timer, days = self.held.get() or (None, [])
        return timer, {day: (due, row and tuple(row)) for day, due, row in days}

    def _keep(self, timer: int | None, days: dict[int, tuple], fired: bool) -> None:
        due = min((due + self.ttl_ms if row is None else due for due, row in days.values()), default=None)
        if due is None:
            self.held.clear()
            return
        self.held.update((due, [(day, *held) for day, held in days.items()]))
        if fired or due != timer:
            if timer is not None and not fired:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names = self.schema.names
        at = names.index("ts")
        timer, days = self._days()
        fresh: dict[int, tuple] = {}
        for frame in rows:
            frame = frame.iloc[frame["ts"].to_numpy().argsort(kind="stable")]
            first = frame[frame[DAY].notna().to_numpy() & ~frame[DAY].duplicated().to_numpy()]
            values = zip(*[first[n].astype(object).where(first[n].notna(), None) for n in names], strict=True)
            for day, row in zip(first[DAY].astype("int64"), values, strict=True):
                if day not in fresh or row[at] < fresh[day][at]:
                    fresh[day] = row
        for day, row in fresh.items():
            due, held = days.get(day, (int(row[at]) + self.hold_ms, row))
            if held is not None:  # else it is out
                days[day] = (due, row if row[at] < held[at] else held)
        if fresh:
            self._keep(timer, days, False)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        timer, days = self._days()
        ready = {day: (due, None) for day, (due, row) in days.items() if row is not None and due <= now}
        if ready:
            yield pd.DataFrame([days[day][1] for day in ready], columns=self.schema.names)
        # A day that is over leaves no state behind.
        days = {day: held for day, held in (days | ready).items() if held[1] is not None or held[0] + self.ttl_ms > now}
        self._keep(timer, days, True)

    def close(self) -> None:
        pass
