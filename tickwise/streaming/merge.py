"""Stream merge of price and news into minute features.

T4 (default): one tagged-union stream, event-time watermark, one-minute
tumbling windows with algebraic aggregates; a minute is emitted once the
watermark passes its end (append mode). State per open minute is a handful
of numbers, so a hot minute costs no more than a quiet one.

T5 (general keyed state): the same result through
``applyInPandasWithState`` with an event-time timeout: each minute key keeps
running sums/counts/extremes, pushes its timeout to ``latest event + 30
minutes`` and emits its final row when the watermark passes that point.
"""

from __future__ import annotations

import datetime as dt
import sys

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState

from tickwise import schemas
from tickwise.functions import timefmt as tf
from tickwise.functions.jsonfmt import parse_json
from tickwise.operators import bars
from tickwise.streaming.publish import ENVELOPE_TS_FORMAT

# Python functions of this module run inside tasks: ship them by value so
# workers need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DEFAULT_DELAY = "10 minutes"
STATE_TIMEOUT_MS = 30 * 60 * 1000

PRICE_JSON = T.StructType([T.StructField(c, T.DoubleType())
                           for c in ("Open", "High", "Low", "Close", "Volume")])
MSG_TYPES = ("price", "news")
NEWS_JSON = T.StructType([T.StructField("score", T.DoubleType())])


def parse_events(messages: DataFrame) -> DataFrame:
    """``value`` envelope JSON -> ``(key, timestamp, msg_type, data)``;
    malformed messages go to :func:`rejects`."""
    e = messages.select("key", parse_json("value", schemas.EVENT_ENVELOPE).alias("e"))
    return (e.select("key", F.col("e.timestamp").alias("timestamp"),
                     F.col("e.msg_type").alias("msg_type"), F.col("e.data").alias("data"))
            .where(F.col("msg_type").isNotNull() & F.col("timestamp").isNotNull()))


def _typed(good: Column) -> list[Column]:
    """``ts, is_news, Open..Volume, score`` of an element ``item`` of a good envelope."""
    ts = tf.parse_ts(F.col("timestamp"), ENVELOPE_TS_FORMAT.replace(".SSSSSS", "[.SSSSSS]"))
    p = F.from_json("item", PRICE_JSON)
    n = F.from_json("item", NEWS_JSON)
    is_news = F.col("msg_type") == "news"
    cols = [F.when(~is_news, p[c]).alias(c) for c in ("Open", "High", "Low", "Close", "Volume")]
    return [F.when(good, ts).alias("ts"), F.when(good, is_news).alias("is_news"), *cols,
            F.when(is_news, n["score"]).alias("score")]


def typed_rows(events: DataFrame) -> DataFrame:
    """Envelopes -> tagged rows ``(key, ts, is_news, Open..Volume, score)``, one
    for each element of ``data``; envelopes without any go to :func:`rejects`."""
    return (events.where(F.col("msg_type").isin(*MSG_TYPES))
            .withColumn("item", F.explode("data"))
            .select("key", *_typed(F.lit(True))))


# Why a message is left out (fixed values), and the name of messages that are not.
REASONS = ("malformed", "unknown type", "empty")
GOOD = "ok"


def _reason(e: Column) -> Column:
    return (F.when(e["msg_type"].isNull() | e["timestamp"].isNull(), REASONS[0])
            .when(~e["msg_type"].isin(*MSG_TYPES), REASONS[1])
            .when(F.coalesce(F.size(e["data"]), F.lit(0)) <= 0, REASONS[2]))


def rejects(messages: DataFrame) -> DataFrame:
    """What :func:`parse_events` and :func:`typed_rows` leave out, ``(key, value,
    reason)`` with a reason of :data:`REASONS`."""
    e = messages.select("key", "value", parse_json("value", schemas.EVENT_ENVELOPE).alias("e"))
    return (e.select("key", "value", _reason(F.col("e")).alias("reason"))
            .where(F.col("reason").isNotNull()))


def sorted_rows(messages: DataFrame, metric: str = "messages") -> DataFrame:
    """T3 with its rejects from one parse: the typed rows of good messages (``reason``
    = :data:`GOOD`) and one row for each message left out, with its text in ``value``.

    Counts travel with the pass as observed metrics: ``metric`` holds the number of
    messages and of those of each reason, ``metric + "_rows"`` the number of typed
    rows. Write it with ``partition_by=["reason"]``: rows and rejects are then folders
    of one sink.
    """
    e = messages.select("key", "value", parse_json("value", schemas.EVENT_ENVELOPE).alias("e"))
    e = e.select("key", "value", "e", F.coalesce(_reason(F.col("e")), F.lit(GOOD)).alias("reason"))
    e = e.observe(metric, F.count(F.lit(1)).alias("messages"),
                  *[F.count_if(F.col("reason") == r).alias(r) for r in (GOOD, *REASONS)])
    good = F.col("reason") == GOOD
    none = F.expr("CAST(array(NULL) AS array<string>)")
    rows = e.select("key", "value", "reason", "e.timestamp", "e.msg_type",
                    F.explode(F.when(good, F.col("e.data")).otherwise(none)).alias("item"))
    out = rows.select("key", *_typed(good), F.when(~good, F.col("value")).alias("value"), "reason")
    return out.observe(f"{metric}_rows", F.count_if(F.col("reason") == GOOD).alias("rows"))


def open_minutes(tagged: DataFrame, emitted: DataFrame) -> DataFrame:
    """End-of-input flush: features of the minutes that a finished stream has not
    emitted. ``tagged`` is the same input as a batch. Minutes close in order of
    time, so those after the last emitted one are open: its time bounds the scan."""
    last = emitted.agg(F.max("Timestamp_Rounded")).first()[0]              # one value
    rows = tagged if last is None else tagged.where(
        F.col("ts") >= F.lit(last + dt.timedelta(minutes=1)))
    agg = event_time(rows).groupBy(F.date_trunc("minute", "ets").alias("m")).agg(*bars.tagged_aggs())
    return agg.select(tf.ntz(F.col("m")).alias("Timestamp_Rounded"),
                      "Open", "High", "Low", "Close", "Volume", "Score", "news_count")


def event_time(tagged: DataFrame, ts: str = "ts") -> DataFrame:
    """Zone-free timestamps cannot carry a watermark: add ``ets`` as a timestamp."""
    return tagged.withColumn("ets", F.col(ts).cast("timestamp"))


def window_merge(tagged: DataFrame, delay: str = DEFAULT_DELAY) -> DataFrame:
    """T4: minute features from a tagged stream (append mode, closed minutes)."""
    w = event_time(tagged).withWatermark("ets", delay)
    agg = w.groupBy(F.window("ets", "1 minute")).agg(*bars.tagged_aggs())
    return agg.select(tf.ntz(F.col("window.start")).alias("Timestamp_Rounded"),
                      "Open", "High", "Low", "Close", "Volume", "Score", "news_count")


# State per HOUR key: one packed float64 row per open minute of that hour,
# columns in this order. Bounded (at most 60 rows x 12 numbers per key).
_COLS = ("minute_s", "n_price", "n_open", "sum_open", "max_high", "min_low", "n_close",
         "sum_close", "sum_volume", "n_news", "sum_score", "max_ms")
STATE_SCHEMA = T.StructType([T.StructField("minutes", T.BinaryType())])
OUT_SCHEMA = T.StructType([
    T.StructField("minute_s", T.LongType()),
    *[T.StructField(c, T.DoubleType()) for c in ("Open", "High", "Low", "Close", "Volume", "Score")],
    T.StructField("news_count", T.LongType()),
])


def _chunk_minutes(pdf: pd.DataFrame) -> np.ndarray:
    """Per-minute partial aggregates of one chunk of rows (vectorised)."""
    isn = pdf["is_news"].to_numpy(dtype=bool)
    p = ~isn
    f = pd.DataFrame({
        "minute_s": pdf["minute_s"].to_numpy(dtype="int64"),
        "n_price": p.astype("float64"),
        "o": np.where(p, pdf["Open"].to_numpy(dtype="float64"), np.nan),
        "h": np.where(p, pdf["High"].to_numpy(dtype="float64"), np.nan),
        "l": np.where(p, pdf["Low"].to_numpy(dtype="float64"), np.nan),
        "c": np.where(p, pdf["Close"].to_numpy(dtype="float64"), np.nan),
        "v": np.where(p, pdf["Volume"].to_numpy(dtype="float64"), np.nan),
        "s": np.where(isn, pdf["score"].to_numpy(dtype="float64"), np.nan),
        "ms": pdf["ms"].to_numpy(dtype="float64"),
    })
    g = f.groupby("minute_s", sort=True)
    a = pd.DataFrame({
        "n_price": g["n_price"].sum(), "n_open": g["o"].count(), "sum_open": g["o"].sum(),
        "max_high": g["h"].max(), "min_low": g["l"].min(), "n_close": g["c"].count(),
        "sum_close": g["c"].sum(), "sum_volume": g["v"].sum(), "n_news": g["s"].count(),
        "sum_score": g["s"].sum(), "max_ms": g["ms"].max()})
    return np.column_stack([a.index.to_numpy(dtype="float64"), a.to_numpy(dtype="float64")])


def _minute_partials(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        if len(pdf):
            yield pd.DataFrame(_chunk_minutes(pdf), columns=list(_COLS))


def _combine(rows: np.ndarray) -> np.ndarray:
    """Merge rows that share a minute (state + new chunks)."""
    f = pd.DataFrame(rows, columns=_COLS)
    g = f.groupby("minute_s", sort=True)
    sums = g[["n_price", "n_open", "sum_open", "n_close", "sum_close", "sum_volume",
              "n_news", "sum_score"]].sum()
    out = pd.DataFrame({"n_price": sums["n_price"], "n_open": sums["n_open"],
                        "sum_open": sums["sum_open"], "max_high": g["max_high"].max(),
                        "min_low": g["min_low"].min(), "n_close": sums["n_close"],
                        "sum_close": sums["sum_close"], "sum_volume": sums["sum_volume"],
                        "n_news": sums["n_news"], "sum_score": sums["sum_score"],
                        "max_ms": g["max_ms"].max()})
    return np.column_stack([out.index.to_numpy(dtype="float64"), out.to_numpy(dtype="float64")])


def _final_rows(m: np.ndarray) -> pd.DataFrame:
    n_price, n_open, n_close = m[:, 1], m[:, 2], m[:, 6]
    with np.errstate(invalid="ignore", divide="ignore"):
        return pd.DataFrame({
            "minute_s": m[:, 0].astype("int64"),
            "Open": np.where(n_open > 0, m[:, 3] / np.where(n_open > 0, n_open, 1), np.nan),
            "High": m[:, 4], "Low": m[:, 5],
            "Close": np.where(n_close > 0, m[:, 7] / np.where(n_close > 0, n_close, 1), np.nan),
            "Volume": np.where(n_price > 0, m[:, 8], np.nan),
            "Score": m[:, 10], "news_count": m[:, 9].astype("int64")})


def _update_hour(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState):
    """Fold new partial minutes into the hour's open minutes; emit every minute whose own
    timeout (latest event + 30 min) the watermark has passed, and re-arm the
    timer for the earliest remaining one."""
    parts = [np.frombuffer(state.get[0], dtype="float64").reshape(-1, len(_COLS))] \
        if state.exists else []
    if not state.hasTimedOut:
        parts += [pdf[list(_COLS)].to_numpy(dtype="float64") for pdf in pdfs if len(pdf)]
    if not parts:
        return
    m = _combine(np.vstack(parts))
    wm = state.getCurrentWatermarkMs()
    due = m[:, 11] + STATE_TIMEOUT_MS < wm if wm and wm > 0 else np.zeros(len(m), dtype=bool)
    keep = m[~due]
    if len(keep):
        state.update((keep.astype("float64").tobytes(),))
        nxt = int(keep[:, 11].min()) + STATE_TIMEOUT_MS
        state.setTimeoutTimestamp(max(nxt, wm + 1) if wm and wm > 0 else nxt)
    else:
        state.remove()
    if due.any():
        yield _final_rows(m[due])


def minute_partials(tagged: DataFrame, delay: str) -> DataFrame:
    """Rows of a tagged stream as partial minutes, made in the tasks that read them,
    with a watermark on the latest event of each (``ets``). Rows without a time are
    dropped."""
    e = event_time(tagged).where(F.col("ets").isNotNull()).select(
        F.unix_seconds(F.date_trunc("minute", "ets")).alias("minute_s"),
        F.unix_millis("ets").alias("ms"), "is_news",
        "Open", "High", "Low", "Close", "Volume", "score")
    e = e.mapInPandas(_minute_partials, ", ".join(f"{c} double" for c in _COLS))
    return e.withColumn("ets", F.timestamp_millis(F.col("max_ms").cast("long"))).withWatermark("ets", delay)


def state_merge(tagged: DataFrame, delay: str = DEFAULT_DELAY) -> DataFrame:
    """T5: keyed-state form of the minute merge with a 30-minute event-time
    timeout per minute. State is keyed by hour (per-minute aggregates inside),
    so the per-key overhead is paid once per hour, not once per minute.

    Rows become partial minutes inside the task that reads them, before the
    shuffle: a hot hour sends at most 60 rows for each Arrow batch. A partial
    minute carries its latest event time, so a minute of which some row in the
    batch is not late is taken whole. Rows without a time are dropped.
    """
    e = minute_partials(tagged, delay).withColumn("hour_s", F.floor(F.col("minute_s") / 3600))
    out = e.groupBy("hour_s").applyInPandasWithState(
        _update_hour, OUT_SCHEMA, STATE_SCHEMA, "append", "EventTimeTimeout")
    return out.select(tf.ntz(F.timestamp_seconds("minute_s")).alias("Timestamp_Rounded"),
                      "Open", "High", "Low", "Close", "Volume", "Score", "news_count")
