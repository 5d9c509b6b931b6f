"""Keyed state on streams.

Each processor sees the rows of one key in one micro-batch and orders them itself, because a
shuffle does not keep arrival order. How many rows that can be is set by the source's admission
limit (`maxOffsetsPerTrigger`, `maxFilesPerTrigger`). The row form is used: most keys have a few
rows per batch, where building a table per key would cost more than the rows do.
"""

from __future__ import annotations

import datetime
import pickle
from collections.abc import Iterator

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

DAY_MS = 86_400_000
GROUP = "_group"    # the column that puts keys into groups


def _date(millis: int, zone: datetime.tzinfo) -> str:
    return datetime.datetime.fromtimestamp(millis / 1000, zone).strftime("%Y-%m-%d")


def _midnight(date: str, zone: datetime.tzinfo) -> int:
    day = datetime.datetime.strptime(date, "%Y-%m-%d").replace(tzinfo=zone)
    return int(day.timestamp() * 1000)


def _window_last(millis: int, length: int) -> int:
    """Last millisecond of the window a time falls in."""
    return millis - millis % length + length - 1


class _Keyed(StatefulProcessor):
    """One row of state per key, read once and written once per micro-batch.

    With `keep_ms`, a key is forgotten that long after its last row, in event time. The last
    field of the state is the time of that row.
    """

    schema = "value string, used bigint"

    def __init__(self, zone: datetime.tzinfo = datetime.timezone.utc, keep_ms: int | None = None):
        self.zone, self.keep_ms = zone, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.value = handle.getValueState("value", self.schema)

    def _store(self, state: tuple) -> None:
        self.value.update(state)
        if self.keep_ms:
            self.handle.registerTimer(state[-1] + self.keep_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state = self.value.get()
        if state is not None and state[-1] + self.keep_ms <= expiredTimerInfo.getExpiryTimeInMs():
            self.value.clear()
        return iter([])

    def close(self) -> None:
        pass


class VisitorFlag(_Keyed):
    """A device called new on another day than its first is not new."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        state = self.value.get()
        first = state[0] if state else None
        for row in sorted(rows, key=lambda r: (r.ts, r.is_new != "1")):
            today = _date(row.ts, self.zone)
            if first is None:
                first = today if row.is_new == "1" else _date(row.ts - DAY_MS, self.zone)
            flag = "0" if row.is_new == "1" and first != today else row.is_new
            yield Row(**{**row.asDict(), "is_new": flag})
        if state is None or self.keep_ms:
            self._store((first, row.ts))


class DailyVisitor(_Keyed):
    """Measured page views; the first of a device on a day is a unique visitor."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        state = self.value.get()
        before = last = state[0] if state else None
        for row in sorted(rows, key=lambda r: (r.ts, r.last_page_id or "", r.sc or "", r.is_new or "")):
            today = _date(row.ts, self.zone)
            visitor, last = int(today != last), today
            yield Row(source=row.sc, is_new=row.is_new, ts=row.ts, uv_ct=visitor,
                      sv_ct=int(row.last_page_id is None), pv_ct=1, dur_sum=row.during_time or 0, et=row.et)
        if last != before or self.keep_ms:
            self._store((last, row.ts))


class DailyLogin(_Keyed):
    """The first view of a user on a day is a login; after more than `days` whole days, a return."""

    def __init__(self, days: int = 7, **options):
        super().__init__(**options)
        self.days = days

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        state = self.value.get()
        before = last = state[0] if state else None
        for row in sorted(rows, key=lambda r: r.ts):
            today = _date(row.ts, self.zone)
            login = int(today != last)
            away = login and last is not None and (row.ts - _midnight(last, self.zone)) // DAY_MS > self.days
            last = today
            yield Row(ts=row.ts, user_count=login, back_count=int(bool(away)), et=row.et)
        if last != before or self.keep_ms:
            self._store((last, row.ts))


class Correction(_Keyed):
    """First row of a fact as it is; a later one gives the row before, with measures new minus old.

    A row given again carries its old time. Its event time is the end of its window, so that it is
    dropped exactly when that window has closed. Rows come in groups of keys (`states.GROUPS`), as a group
    of its own for each key would cost several calls and an Arrow batch per key. The state of a group is
    one packed value: the last row of each of its keys.
    """

    schema = "facts binary"

    def __init__(self, key: str, measures: list[str], window_ms: int, **options):
        super().__init__(**options)
        self.key, self.measures, self.window_ms = key, measures, window_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last = self._last()
        rows = list(rows)
        names = [n for n in rows[0].__fields__ if n not in (GROUP, "et")]
        places = [rows[0].__fields__.index(n) for n in names]
        given_as = Row(*names, "et")
        ident, at, seq = names.index(self.key), names.index("ts"), names.index("seq")
        measures = [names.index(m) for m in self.measures]
        closed = timerValues.getCurrentWatermarkInMs()
        facts = [tuple(row[p] for p in places) for row in rows]
        for fact in sorted(facts, key=lambda f: (f[at], -1 if f[seq] is None else f[seq])):
            before = last.get(fact[ident])
            given = fact
            if before is not None:
                given = list(before)
                for m in measures:
                    given[m] = _minus(fact[m], before[m])
            end = _window_last(given[at], self.window_ms)
            if end > closed:
                yield given_as(*given, datetime.datetime.fromtimestamp(end / 1000, datetime.timezone.utc))
            last[fact[ident]] = fact
        self._keep(last, at)

    def _last(self) -> dict:
        state = self.value.get()
        return pickle.loads(state[0])[1] if state else {}

    def _keep(self, last: dict, at: int) -> None:
        self.value.update((bytearray(pickle.dumps((at, last))),))
        if self.keep_ms:
            self.handle.registerTimer(min(fact[at] for fact in last.values()) + self.keep_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state = self.value.get()
        if state is not None:
            at, last = pickle.loads(state[0])
            over = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)
            kept = {k: fact for k, fact in last.items() if fact[at] + self.keep_ms > over}
            if not kept:
                self.value.clear()
            elif len(kept) < len(last):
                self._keep(kept, at)
        return iter([])


def _minus(new, old):
    return None if new is None or old is None else new - old
