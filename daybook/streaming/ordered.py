"""Ordered stateful streams (STM-01, STM-05, STM-06).

Rows of one key reach a stream in any order, over several Arrow chunks and
batches. A rule about neighbours in time is only right on ordered rows, so
every key keeps a buffer in event time: rows wait until the watermark has
passed them (later ones can't come any more), are released in order, and only
then meet the rule, a small machine with a state of a few fields. One timer per
key, at its earliest waiting row or deadline, does the releasing also when no
more rows come. State per key is the rows of one watermark delay and the
machine's fields.

Built on ``transformWithStateInPandas``, whose state lives in RocksDB
(``use_rocksdb``). Times travel as microseconds since the epoch, so no session
time zone plays a part.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType, TimestampType, _parse_datatype_string

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """The state store that ordered streams need, unless the session names one."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if "HDFSBacked" in (spark.conf.get(key, "") or "HDFSBacked"):
        spark.conf.set(key, ROCKSDB)


class Machine:
    """A rule over the ordered rows of a key. ``start`` is the state before the
    first row; ``step`` takes a row's values and gives the new state and output
    rows; ``deadline`` is when a state has to ``expire`` without a row. Times
    are microseconds."""
    schema = ""
    start: tuple = ()

    def step(self, key: tuple, state: tuple, row: tuple) -> tuple[tuple, list[tuple]]:
        raise NotImplementedError

    def deadline(self, state: tuple) -> int | None:
        return None

    def expire(self, key: tuple, state: tuple) -> tuple[tuple, list[tuple]]:
        return state, []


class Ordered(StatefulProcessor):
    """Releases buffered rows to a machine as the watermark passes them."""

    def __init__(self, machine: Machine, rows: StructType, columns: list[str], out: list[str], ts: str, tiebreak: list[str]):
        self.machine, self.rows, self.columns, self.out = machine, rows, columns, out
        self.at = columns.index(ts)
        self.order = [self.at, *(columns.index(c) for c in tiebreak)]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.rows)
        self.state = handle.getValueState("machine", self.machine.schema)

    def close(self) -> None:
        pass

    def _sorted(self, rows: list[tuple]) -> list[tuple]:
        # None sorts first, as in Spark's ascending order
        return sorted(rows, key=lambda r: tuple((r[i] is not None, r[i]) for i in self.order))

    def _release(self, key: tuple, rows: list[tuple], watermark: int) -> Iterator[pd.DataFrame]:
        state = tuple(self.state.get()) if self.state.exists() else self.machine.start
        past = watermark * 1000 + 999  # a watermark is in milliseconds
        ready = self._sorted([r for r in rows if r[self.at] <= past])
        waiting = [r for r in rows if r[self.at] > past]
        found: list[tuple] = []
        for row in ready:
            due = self.machine.deadline(state)
            if due is not None and due <= row[self.at]:
                state, more = self.machine.expire(key, state)
                found += more
            state, more = self.machine.step(key, state, row)
            found += more
        due = self.machine.deadline(state)
        if due is not None and due <= past:
            state, more = self.machine.expire(key, state)
            found += more
            due = self.machine.deadline(state)
        if waiting:
            self.waiting.put(waiting)
        else:
            self.waiting.clear()
        self.state.update(state)
        times = [r[self.at] for r in waiting] + ([due] if due is not None else [])
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        if times:
            self.handle.registerTimer(max(min(times) // 1000, watermark + 1))
        if found:
            yield pd.DataFrame(found, columns=self.out)

    def _values(self, pdf: pd.DataFrame) -> list[tuple]:
        plain = pdf[self.columns].astype(object).where(pdf[self.columns].notna(), None)
        return [tuple(x.item() if hasattr(x, "item") else x for x in r) for r in plain.itertuples(index=False, name=None)]

    def _held(self) -> list[tuple]:
        return [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        new = [r for pdf in rows for r in self._values(pdf)]
        yield from self._release(key, self._held() + new, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        yield from self._release(key, self._held(), timerValues.getCurrentWatermarkInMs())


def ordered(rows: DataFrame, key: str, ts: str, tiebreak: list[str], machine: Machine, out: str | StructType,
            watermark: str) -> DataFrame:
    """The machine's output over the rows of each ``key`` in the order of
    (``ts``, ``tiebreak``). Rows later than ``watermark`` behind the newest
    are dropped by Spark, as in any stream with a watermark; rows without a
    time or key belong to no order and are left out."""
    use_rocksdb(rows.sparkSession)
    schema = _parse_datatype_string(out) if isinstance(out, str) else out
    timed = rows.filter(F.col(ts).isNotNull() & F.col(key).isNotNull()).withColumn("__event_time", F.col(ts)) \
        .withWatermark("__event_time", watermark)
    sent = timed.select(*[F.unix_micros(f.name).alias(f.name) if isinstance(f.dataType, TimestampType) else f.name
                          for f in rows.schema.fields], "__event_time")
    held = sent.drop("__event_time").schema
    processor = Ordered(machine, held, held.names, schema.names, ts, tiebreak)
    plain = StructType([StructField(f.name, LongType() if isinstance(f.dataType, TimestampType) else f.dataType)
                        for f in schema.fields])
    found = sent.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=plain, outputMode="append", timeMode="EventTime")
    return found.select(*[F.timestamp_micros(f.name).alias(f.name) if isinstance(f.dataType, TimestampType) else f.name
                          for f in schema.fields])


class Transitions(Machine):
    """Emits a row when its state columns differ from those of the row before
    (STM-01); the first row of a key always counts."""
    schema = "seen boolean, values string"
    start = (False, "")

    def __init__(self, places: list[int]):
        self.places = places

    def step(self, key, state, row):
        values = repr(tuple(row[i] for i in self.places))
        return (True, values), [row] if not state[0] or values != state[1] else []


class Plays(Machine):
    """Track changes to plays (STM-05/06): a segment starts when the track
    differs from the one before (empty ones never start any) and ends at the
    next start, at most ``slack_s`` seconds after its known duration, or
    ``unknown_s`` seconds after its start when the duration is unknown. Plays
    shorter than ``dwell_s`` are dropped."""
    schema = "start long, track string, duration long, previous string"
    start = (None, "", 0, "__none__")

    def __init__(self, track: int, ts: int, duration: int, dwell_s: int, slack_s: int, unknown_s: int):
        self.track, self.ts, self.duration = track, ts, duration
        self.dwell_s, self.slack_s, self.unknown_s = dwell_s, slack_s, unknown_s

    def deadline(self, state):
        if state[0] is None:
            return None
        return state[0] + 1_000_000 * (state[2] // 1000 + self.slack_s if state[2] > 0 else self.unknown_s)

    def _close(self, key, state, end):
        if state[0] is None:
            return []
        end = min(end, self.deadline(state))
        whole = end // 1_000_000 - state[0] // 1_000_000
        return [(key[0], state[1], state[0], end)] if whole >= self.dwell_s else []

    def step(self, key, state, row):
        track = row[self.track] or ""
        if track == state[3] or not track:
            return (*state[:3], track), []
        return (row[self.ts], track, int(row[self.duration] or 0), track), self._close(key, state, row[self.ts])

    def expire(self, key, state):
        # the track before stays, so that the same one does not start again
        return (None, "", 0, state[3]), self._close(key, state, self.deadline(state))
