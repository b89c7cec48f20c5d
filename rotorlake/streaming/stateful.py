"""Keyed state of streams: the last row of each turbine from run to run, and windows that end with their day.

Rows are packed to JSON before they reach the Python side of the state, and unpacked after it, so that a processor
handles a time and a text whatever the columns.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_MICROS = 86_400_000_000
_NTZ = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state where keyed processors can use it; the session's setting comes back."""
    old = spark.conf.get(STATE_CONF)
    spark.conf.set(STATE_CONF, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(STATE_CONF, old)


def micros(ts: str) -> Column:
    """Microseconds of a plain time since the start of 1970, whatever the session's zone."""
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', `{ts}`)")


class LastRow(StatefulProcessor):
    """Keeps each key's last row; hands out the midnight row that opens a day of which new rows came."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "at long, row string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        before = tuple(self.last.get()) if self.last.exists() else None
        last, openings, days = before, {}, set()
        if before and before[0] % DAY_MICROS == 0:
            openings[before[0]] = before[1]
        for frame in rows:
            at = frame["at"].to_numpy(np.int64)
            days.update(np.unique((at - 1) // DAY_MICROS * DAY_MICROS).tolist())
            latest = frame[at == at.max()]
            last = max(last or (latest["at"].iloc[0], ""), (int(at.max()), latest["row"].max()))
            for a, row in zip(at[at % DAY_MICROS == 0].tolist(), frame["row"][at % DAY_MICROS == 0], strict=True):
                openings[a] = max(openings.get(a, ""), row)
        if last is not None and last != before:
            self.last.update((int(last[0]), last[1]))
        found = [openings[a] for a in sorted(openings) if a in days]
        if found:
            yield pd.DataFrame({"key": [key[0]] * len(found), "row": found})

    def close(self) -> None:
        pass


def carried_rows(stream: DataFrame, key: str, ts: str) -> DataFrame:
    """Each key's midnight row, once rows of the day that it opens come, in the same run or a later one.

    Times are plain (without zone); of rows with one time the one that is last as text counts. The state is one row a
    key, and a query that is started again from its checkpoint has it.
    """
    packed = stream.where(F.col(ts).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).cast("string").alias("key"), micros(ts).alias("at"), F.to_json(F.struct(*stream.columns), _NTZ).alias("row")
    )
    found = packed.groupBy("key").transformWithStateInPandas(LastRow(), "key string, row string", "Append", "None")
    return found.select(F.from_json("row", stream.schema, _NTZ).alias("row")).select("row.*")


class WindowMeans(StatefulProcessor):
    """Number and sum of each value of a window, handed out as means when the window's time to close has come."""

    def __init__(self, values: list[str]) -> None:
        self.values = values

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", "packed string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        closes = int(key[1])
        if closes >= timerValues.getCurrentWatermarkInMs():
            n, s = json.loads(self.sums.get()[0]) if self.sums.exists() else ([0] * len(self.values), [0.0] * len(self.values))
            for frame in rows:
                for k, v in enumerate(self.values):
                    known = frame[v].dropna()
                    n[k] += len(known)
                    s[k] += float(known.sum())
            self.sums.update((json.dumps([n, s]),))
            self.handle.registerTimer(closes)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.sums.exists():
            n, s = json.loads(self.sums.get()[0])
            self.sums.clear()
            means = {v: pd.Series([s[k] / n[k] if n[k] else None], dtype="float64") for k, v in enumerate(self.values)}
            yield pd.DataFrame({"start": [int(key[0])], **means})

    def close(self) -> None:
        pass


def day_end_means(stream: DataFrame, ts: str, values: list[str], size: str = "10 minutes", watermark: str = "0 seconds", mark: str = "mark") -> DataFrame:
    """Mean of each value per tumbling window, labelled by its start; a day's last window closes at 23:59:59.

    Other windows close when the watermark reaches their end. No row of the next day is needed: the row of 23:59:59,
    or a row with a ``mark`` at that time (``jobs.close_day``), which tells the time and has no values, is enough.
    Rows behind the watermark are dropped.
    """
    window = F.window(ts, size)
    end = window["end"]
    # Timers before the watermark expire, so each is a millisecond before the time that closes its window.
    closes = F.unix_millis(end) - F.when(end == F.date_trunc("day", end), F.lit(1001)).otherwise(F.lit(1))
    timed = stream.withWatermark(ts, watermark)
    if mark in stream.columns:
        # The condition names the time, or it would be pushed below the watermark, which must see the marks.
        timed = timed.where(F.when(F.col(mark).isNull(), F.col(ts)).isNotNull())
    keyed = timed.select(ts, *values, F.unix_micros(window["start"]).alias("start"), closes.alias("closes"))
    schema = "start long, " + ", ".join(f"`{v}` double" for v in values)
    means = keyed.groupBy("start", "closes").transformWithStateInPandas(WindowMeans(values), schema, "Append", "EventTime")
    return means.select(F.timestamp_micros("start").alias(ts), *values)
