"""What a keyed processor asks of its state: calls cost far more than rows, so they must not grow with a key's days."""

import collections

import pandas as pd
from pyspark.sql import types as T

from tidemart.streaming import processors

DAY = 86_400_000
SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.LongType())])


class Handle:
    """State and timers of one key, with a count of all calls."""

    def __init__(self):
        self.values, self.timers, self.calls = {}, set(), collections.Counter()

    def getValueState(self, name, schema, ttl=None):
        handle = self

        class Value:
            def exists(self):
                handle.calls["state"] += 1
                return name in handle.values

            def get(self):
                handle.calls["state"] += 1
                return handle.values.get(name)

            def update(self, value):
                handle.calls["state"] += 1
                handle.values[name] = value

            def clear(self):
                handle.values.pop(name, None)

        return Value()

    def registerTimer(self, at):
        self.calls["timer"] += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls["timer"] += 1
        self.timers.discard(at)


class Time:
    def __init__(self, at):
        self.at = at

    def getExpiryTimeInMs(self):
        return self.at

    def getCurrentWatermarkInMs(self):
        return self.at


def frame(*rows):
    made = pd.DataFrame([(i, ts) for i, ts in rows], columns=["id", "ts"])
    return made.assign(**{processors.DAY: made["ts"] // DAY})


def batch(processor, *frames):
    return [tuple(r) for out in processor.handleInputRows(("k",), iter(frames), None) for r in out.itertuples(index=False)]


def test_daily_first_asks_once_per_batch():
    handle, first = Handle(), processors.DailyFirst(ttl_ms=DAY)
    first.init(handle)
    rows = [(i, (i % 30) * DAY + 100 - i // 30) for i in range(90)]
    outs = [*first.handleInputRows(("k",), iter([frame(*rows[:50]), frame(*rows[50:])]), None)]
    got = pd.concat(outs).sort_values("ts")
    assert [*got["id"]] == [*range(60, 90)] and [*got["previous_day"]] == [-1, *range(29)] and set(got["is_first"]) == {1}
    assert len(outs) == 1 and handle.calls["state"] <= 3 and handle.calls["timer"] == 1
    assert handle.values["seen"] == (29, 29 * DAY + 98) and handle.timers == {30 * DAY + 98}
    # A day that is not later is left out, one that is later knows the one before.
    assert batch(first, frame((1, 5), (2, 29 * DAY), (3, 31 * DAY))) == [(3, 31 * DAY, 29, 1)]
    assert handle.timers == {32 * DAY}


def test_daily_first_keeps_all_rows():
    first = processors.DailyFirst(keep_all=True)
    first.init(Handle())
    got = batch(first, frame((1, 50), (2, 40)), frame((3, 30), (4, DAY)))
    assert sorted(got) == [(1, 50, -1, 0), (2, 40, -1, 0), (3, 30, -1, 1), (4, DAY, 0, 1)]
    assert batch(first, frame((5, 10))) == [(5, 10, 1, 0)]


def test_first_login_has_one_timer_and_value_for_all_days():
    handle, login = Handle(), processors.FirstLogin(SCHEMA, hold_ms=2_000, ttl_ms=DAY)
    login.init(handle)
    assert batch(login, frame(*[(d, d * DAY + 10) for d in range(30)]), frame((99, 5))) == []
    assert handle.calls["state"] <= 4 and handle.timers == {2_005}

    def fire(at):
        due = min(handle.timers)
        handle.timers.discard(due)
        info = Time(due)
        return [tuple(r) for out in login.handleExpiredTimer(("k",), Time(at), info) for r in out.itertuples(index=False)]

    assert fire(2_009) == [(99, 5)]                                # the second day waits for its time
    assert batch(login, frame((7, 1), (8, DAY + 9))) == []         # the first is out; the second has an earlier row
    assert fire(5 * DAY) == [(8, DAY + 9)] + [(d, d * DAY + 10) for d in range(2, 5)]
    while handle.timers:
        fire(99 * DAY)
    assert handle.values == {}
