"""Publishers (T1, T2): rows -> keyed JSON messages in one shared envelope.

The original producers wrote flat row JSON while the consumer expected an
envelope nobody wrote; here both producers emit the envelope
``{"timestamp", "msg_type", "data": [row json]}`` so the merge job can read
either topic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.functions import timefmt as tf
from tickwise.functions.jsonfmt import row_json

ENVELOPE_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def envelope(df: DataFrame, key: Column, ts: Column, msg_type: str,
             columns: list[str] | None = None) -> DataFrame:
    """``(key, value)`` with the value an envelope holding the row as JSON."""
    value = F.to_json(F.struct(
        F.date_format(ts, ENVELOPE_TS_FORMAT).alias("timestamp"),
        F.lit(msg_type).alias("msg_type"),
        F.array(row_json(df, columns)).alias("data")))
    return df.select(key.cast("string").alias("key"), value.alias("value"))


def flat_message(df: DataFrame, key: str = "id") -> DataFrame:
    """The original flat form: ``key = id``, ``value = row JSON``."""
    return df.select(F.col(key).cast("string").alias("key"), row_json(df).alias("value"))


def publish_prices(prices: DataFrame) -> DataFrame:
    """Price rows (``Date`` + ``Time`` strings) -> envelope messages."""
    ts = tf.parse_ts(tf.date_time("Date", "Time"))
    return envelope(prices, F.col("id"), ts, "price")


def publish_news(news: DataFrame) -> DataFrame:
    """News rows with ``timestamp`` parsed from ``pub_date`` -> envelopes."""
    with_ts = news.withColumn("timestamp", tf.parse_ts_inferred("pub_date"))
    return envelope(with_ts, F.col("id"), F.col("timestamp"), "news",
                    [c for c in with_ts.columns])
