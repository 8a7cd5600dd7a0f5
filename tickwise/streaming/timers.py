"""Minute merge with a timer for each minute (T5).

Every minute is a key of its own with a value state of a few numbers and one
event-time timer, set to the minute's latest event plus the timeout. New rows move
the timer; when the watermark passes it the minute is emitted and its state cleared,
so the state holds open minutes only. Rows become partial minutes in the tasks that
read them, so a hot minute sends one row for each Arrow batch.

:func:`tickwise.streaming.merge.state_merge` packs an hour of minutes into one state
and calls Python once an hour, which is faster; this form has the state one can look
into, minute by minute.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickwise.functions import timefmt as tf
from tickwise.streaming import merge

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The state store that timers need (a fixed name).
STORE = {"spark.sql.streaming.stateStore.providerClass":
         "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
_STATE = ", ".join(f"{c} double" for c in merge._COLS)


_MAXIMA = [merge._COLS.index(c) for c in ("max_high", "max_ms")]
_MINIMA = [merge._COLS.index("min_low")]


def _together(rows: np.ndarray) -> np.ndarray:
    """Partial rows of one minute as one."""
    if len(rows) == 1:
        return rows[0]
    out = rows.sum(axis=0)
    out[0] = rows[0, 0]
    out[_MAXIMA] = np.fmax.reduce(rows[:, _MAXIMA])
    out[_MINIMA] = np.fmin.reduce(rows[:, _MINIMA])
    return out


class OpenMinute(StatefulProcessor):
    """State of one minute, until its timer."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.minute = handle.getValueState("minute", _STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [pdf[list(merge._COLS)].to_numpy(dtype="float64") for pdf in rows if len(pdf)]
        if self.minute.exists():
            held = tuple(self.minute.get())
            parts.append(np.array([[np.nan if v is None else v for v in held]], dtype="float64"))
            self.handle.deleteTimer(self._due(held[-1]))
        if parts:
            now = _together(np.vstack(parts))
            self.minute.update(tuple(map(float, now)))
            self.handle.registerTimer(self._due(now[-1]))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = [np.nan if v is None else v for v in self.minute.get()]
        self.minute.clear()
        yield merge._final_rows(np.array([held], dtype="float64"))

    def close(self) -> None:
        pass

    @staticmethod
    def _due(max_ms: float) -> int:
        return int(max_ms) + merge.STATE_TIMEOUT_MS


def timer_merge(tagged: DataFrame, delay: str = merge.DEFAULT_DELAY) -> DataFrame:
    """T5: minute features, each emitted when the watermark has passed its latest event
    by the timeout. Start the query with :data:`STORE` set. Rows without a time are
    dropped."""
    parts = merge.minute_partials(tagged, delay).withColumn("minute", F.col("minute_s").cast("long"))
    out = parts.groupBy("minute").transformWithStateInPandas(
        statefulProcessor=OpenMinute(), outputStructType=merge.OUT_SCHEMA, outputMode="append",
        timeMode="eventTime")
    return out.select(tf.ntz(F.timestamp_seconds("minute_s")).alias("Timestamp_Rounded"),
                      "Open", "High", "Low", "Close", "Volume", "Score", "news_count")
