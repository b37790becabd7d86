"""Keyed state of the traffic jobs: first visits, and windows that close, are
corrected by late rows for a while, and then set further rows aside."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from strata.operators.traffic import STAMP
from strata.schemas import names
from strata.streaming.state import pack, unpack

DAY_MS = 86_400_000


# ---------------------------------------------------------------------------
# First visits
# ---------------------------------------------------------------------------

def earliest_per_day(views: DataFrame, mid: str = "mid", ts: str = "ts", tie: str = "log_id") -> DataFrame:
    """The first view per device and day of every Arrow batch: what a device adds to a
    day can only come from these, so a hot device sends few rows to its task."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            part = part.sort_values([ts, tie], kind="stable")
            yield part[~pd.DataFrame({"m": part[mid], "d": part[ts].dt.floor("D")}).duplicated()]
    return views.mapInPandas(run, views.schema)


class FirstVisits(StatefulProcessor):
    """Per device: was it ever seen, and on which days that may still get rows."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", "since LONG")
        self.days = handle.getMapState("days", "day LONG", "seen BOOLEAN")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        for row in sorted(rows, key=lambda r: (r.ts, -1 if r.log_id is None else r.log_id)):
            day = int(row.ms // DAY_MS)
            if row.ms < timerValues.getCurrentWatermarkInMs() or self.days.containsKey((day,)):
                continue
            ever = self.known.exists()
            if not ever:
                self.known.update((row.ms,))
            self.days.updateValue((day,), (True,))
            # Once the watermark has left the day, no row of it can count any more.
            self.handle.registerTimer((day + 1) * DAY_MS)
            yield Row(ts=row.ts, mid=key[0], log_id=row.log_id, vc=row.vc, ch=row.ch, ar=row.ar,
                      during_time=row.during_time, last_page_id=row.last_page_id, is_new="0" if ever else "1")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        day = expiredTimerInfo.getExpiryTimeInMs() // DAY_MS - 1
        if self.days.containsKey((day,)):
            self.days.removeKey((day,))
        return iter(())

    def close(self) -> None:
        pass


class GroupedFirstVisits(StatefulProcessor):
    """The same for a group of devices at once: two packed lists instead of calls per
    row, and views as texts."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getListState("known", "packed BINARY")
        self.days = handle.getListState("days", "packed BINARY")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        known, days = set(unpack(self.known)), set(unpack(self.days))
        timed = {day for _, day in days}
        devices, visits, out = [], [], []
        views = [view for part in rows for view in zip(part["us"], part["tie"], part["mid"], part["view"], strict=True)]
        for us, _, mid, view in sorted(views, key=lambda v: v[:2]):
            ms = us // 1000
            visit = (mid, ms // DAY_MS)
            if ms < mark or visit in days:
                continue
            ever = mid in known
            if not ever:
                known.add(mid)
                devices.append(mid)
            days.add(visit)
            visits.append(visit)
            out.append((us, mid, view, "0" if ever else "1"))
        if not out:
            return
        found = pd.DataFrame(out, columns=["us", "mid", "view", "is_new"])
        found.insert(0, "ts", pd.to_datetime(found.pop("us"), unit="us", utc=True))
        yield found
        if devices:
            self.known.appendValue(pack(devices))
        self.days.appendValue(pack(visits))
        for day in {day for _, day in visits} - timed:
            # Once the watermark has left the day, no row of it can count any more.
            self.handle.registerTimer(int((day + 1) * DAY_MS))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        days = list(unpack(self.days))
        held = [(mid, day) for mid, day in days if (day + 1) * DAY_MS > mark]
        if not held:
            self.days.clear()
        elif len(held) < len(days):
            self.days.put([pack(held)])
        return iter(())

    def close(self) -> None:
        pass


FIRST_VISIT = ("ts TIMESTAMP, mid STRING, log_id LONG, vc STRING, ch STRING, ar STRING, during_time LONG, "
               "last_page_id STRING, is_new STRING")


def first_visits(views: DataFrame, delay: str, groups: int | None = None) -> DataFrame:
    """First view per device and day of a stream of page views (``ts`` TIMESTAMP), in
    the order of arrival between batches and of event time within one; ``is_new`` is
    '1' on the device's very first. A view behind the watermark is no visit.

    With ``groups`` the devices are dealt over that many keys of the state, for fewer
    calls to the store; a batch then reads the groups of its devices."""
    rows = earliest_per_day(views.withWatermark("ts", delay)).withColumn("ms", F.unix_millis("ts"))
    if groups is None:
        return rows.groupBy("mid").transformWithState(FirstVisits(), FIRST_VISIT, "Append", "EventTime",
                                                      eventTimeColumnName="ts")
    view = "log_id LONG, vc STRING, ch STRING, ar STRING, during_time LONG, last_page_id STRING"
    found = rows.select(
        F.pmod(F.xxhash64("mid"), F.lit(groups)).alias("device_group"), "mid", F.unix_micros("ts").alias("us"),
        F.coalesce("log_id", F.lit(-1)).alias("tie"), F.to_json(F.struct(*names(view))).alias("view")
    ).groupBy("device_group").transformWithStateInPandas(
        GroupedFirstVisits(), "ts TIMESTAMP, mid STRING, view STRING, is_new STRING", "Append", "EventTime",
        eventTimeColumnName="ts")
    return found.select("ts", "mid", F.from_json("view", view).alias("v"), "is_new").select(
        "ts", "mid", "v.*", "is_new")


# ---------------------------------------------------------------------------
# Windows that close
# ---------------------------------------------------------------------------

class ClosingWindow(StatefulProcessor):
    """One window of one dimension tuple. When the watermark passes its end it is
    emitted (version 1). Rows that come within the lateness after that emit a new
    version per batch; later ones leave as they came."""

    def __init__(self, size_ms: int, lateness_ms: int, dims: list[str], measures: list[str]):
        self.size_ms, self.lateness_ms, self.dims, self.measures = size_ms, lateness_ms, dims, measures

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        sums = ", ".join(f"{m} LONG" for m in self.measures)
        self.state = handle.getValueState("window", f"version INT, pv_ct LONG, {sums}")

    def _out(self, kind: str, key, state: tuple, log_id=None, late_ms=None) -> Row:
        return Row("kind", "w", *self.dims, "version", "pv_ct", *self.measures, "log_id", "late_ms")(
            kind, *key, *state, log_id, late_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now, end = timerValues.getCurrentWatermarkInMs(), key[0] + self.size_ms
        if end + self.lateness_ms <= now:
            for row in rows:
                yield self._out("late", key, (None,) * (2 + len(self.measures)), row.log_id, row.ms)
            return
        if self.state.exists():
            version, count, *sums = self.state.get()
        else:
            version, count, sums = 0, 0, [0] * len(self.measures)
            self.handle.registerTimer(end)
            self.handle.registerTimer(end + self.lateness_ms)
        for row in rows:
            count += 1
            sums = [a + (row[m] or 0) for a, m in zip(sums, self.measures, strict=True)]
        closed = end <= now
        self.state.update((version + closed, count, *sums))
        if closed:
            yield self._out("window", key, (version + 1, count, *sums))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.state.exists():
            version, *rest = self.state.get()
            if not version:
                self.state.update((1, *rest))
                yield self._out("window", key, (1, *rest))
            if expiredTimerInfo.getExpiryTimeInMs() >= key[0] + self.size_ms + self.lateness_ms:
                self.state.clear()

    def close(self) -> None:
        pass


def millis(interval: str) -> int:
    """Milliseconds of an interval such as ``1 hour`` or ``30 MINUTES``."""
    number, unit = interval.split()
    scale = {"second": 1000, "minute": 60_000, "hour": 3_600_000, "day": DAY_MS}[unit.lower().rstrip("s")]
    return int(float(number) * scale)


def closing_windows(views: DataFrame, size: str, lateness: str, delay: str, dims: list[str],
                    measures: list[str], ts: str = "ts", log_id: str = "log_id") -> DataFrame:
    """Window versions and late rows of a stream (``kind`` window or late): stt, edt,
    dims, version, pv_ct and measures, or the row's log_id and late_ts.

    The event-time column loses its mark before the state: Spark would otherwise drop
    rows behind the watermark, which here correct a window or are set aside."""
    size_ms = millis(size)
    seen = views.withWatermark(ts, delay)
    ms = F.unix_millis(ts)
    rows = seen.select((F.floor(ms / size_ms) * size_ms).cast("long").alias("w"), *dims, ms.alias("ms"),
                       F.col(log_id).cast("long").alias("log_id"), *[F.col(m).cast("long").alias(m) for m in measures])
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    out = T.StructType([T.StructField(n, t) for n, t in (
        ("kind", T.StringType()), ("w", T.LongType()), *[(d, kinds[d]) for d in dims], ("version", T.IntegerType()),
        ("pv_ct", T.LongType()), *[(m, T.LongType()) for m in measures], ("log_id", T.LongType()),
        ("late_ms", T.LongType()))])
    found = rows.groupBy("w", *dims).transformWithState(
        ClosingWindow(size_ms, millis(lateness), dims, measures), out, "Append", "EventTime")

    def stamp(c: Column) -> Column:
        return F.date_format(F.timestamp_millis(c), STAMP)
    return found.select("kind", stamp(F.col("w")).alias("stt"), stamp(F.col("w") + size_ms).alias("edt"), *dims,
                        "version", "pv_ct", *measures, "log_id", F.timestamp_millis("late_ms").alias("late_ts"))
