"""Named streaming queries: each runs the stream over the whole table
(``availableNow``), appends to Parquet in the shared checkpoint folder and
returns the written result."""

from __future__ import annotations

import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tickwise.operators import model, samples
from tickwise.plans.bars_q import MINUTE_FEATURES_RAW_SQL, MINUTE_FEATURES_SQL
from tickwise.plans.common import finish, sql_list
from tickwise.plans.model_q import features_sql, fixed_coefficients, p_up_sql
from tickwise.session import scratch_path
from tickwise.sources import tables
from tickwise.sources.tables import NEWS_TYPES, PRICE_TYPES, tag_events, tagged_ticks
from tickwise.streaming import live, merge, publish, sinks, sources, timers

ALL_TYPES = PRICE_TYPES + NEWS_TYPES
RESUME_FILES = 4


def _tagged_stream(spark, sf_dir):
    return tag_events(sources.table_stream(spark, sf_dir, "events"))


def _messages(spark, sf_dir):
    """T1 + T2 on the events stream: price and news rows as envelopes."""
    ev = sources.table_stream(spark, sf_dir, "events")
    ev = ev.where(F.col("event_type").isin(*ALL_TYPES))
    is_news = F.col("event_type").isin(*NEWS_TYPES)
    vol = F.get_json_object("props", "$.k").cast("double")
    prices = ev.where(~is_news).select(
        F.col("event_id").alias("id"), *[F.col("value").alias(c) for c in ("Open", "High", "Low", "Close")],
        vol.alias("Volume"), F.date_format("ts", "HH:mm:ss").alias("Time"),
        F.date_format("ts", "yyyy-MM-dd").alias("Date"))
    news = ev.where(is_news).select(F.col("event_id").alias("id"),
                                    F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("pub_date"),
                                    F.col("value").alias("score"))
    return publish.publish_prices(prices).unionByName(publish.publish_news(news))


def q_stream_minute_features(spark, sf_dir):
    """T4 (+T6/T7/T8 via the runner): all minutes of the window merge, those still
    open at the end of the input flushed."""
    out = sinks.run_to_parquet(merge.window_merge(_tagged_stream(spark, sf_dir)), "minute-window")
    return finish(out.unionByName(merge.open_minutes(tagged_ticks(spark, sf_dir), out)))


def q_stream_state_merge(spark, sf_dir):
    """T5: minutes emitted by the keyed-state merge after their timeout, and those
    whose timeout the end of the input left open."""
    out = sinks.run_to_parquet(merge.state_merge(_tagged_stream(spark, sf_dir)), "minute-state")
    return finish(out.unionByName(merge.open_minutes(tagged_ticks(spark, sf_dir), out)))


def q_stream_minute_timers(spark, sf_dir):
    """T5 with a timer a minute: emitted minutes, and those that are still open."""
    out = sinks.run_to_parquet(timers.timer_merge(_tagged_stream(spark, sf_dir)), "minute-timers",
                               conf=timers.STORE)
    return finish(out.unionByName(merge.open_minutes(tagged_ticks(spark, sf_dir), out)))


def q_stream_envelope_roundtrip(spark, sf_dir):
    """T1 + T2 + F25 publish, T3 + F26 parse back to typed rows."""
    typed = merge.typed_rows(merge.parse_events(_messages(spark, sf_dir)))
    out = sinks.run_to_parquet(typed, "envelopes")
    return finish(out.select("key", "ts", "is_news", "Open", "High", "Low", "Close",
                             "Volume", "score"))


def q_stream_predictions(spark, sf_dir):
    """T9 + K5 + F24: every window of closed minutes scored as its last minute closes,
    from the tail, by a saved model of fixed coefficients."""
    base = scratch_path(spark, f"tickwise-streams/live-{uuid.uuid4().hex[:12]}")
    model.save(model.linear_model(fixed_coefficients(spark)), f"{base}/model")
    fn = live.predict_each_batch(f"{base}/features", f"{base}/predictions", f"{base}/model",
                                 every_window=True, score=model.score_linear)
    sinks.run_each_batch(merge.window_merge(_tagged_stream(spark, sf_dir)), fn, f"{base}/_checkpoint")
    out = spark.read.parquet(f"{base}/predictions")
    return finish(out.select("start_ts", "end_ts", "p_up", "direction"))


def _broken(messages):
    """A fixed share of the messages spoilt, by the last digit of their key."""
    digit = F.pmod(F.col("key").cast("long"), F.lit(10))
    value = (F.when(digit == 3, F.substring("value", 1, 20))
             .when(digit == 5, F.regexp_replace("value", '"msg_type":"[a-z]+"', '"msg_type":"other"'))
             .when(digit == 7, F.regexp_replace("value", r'"data":\[.*\]', '"data":[]'))
             .otherwise(F.col("value")))
    return messages.select("key", value.alias("value"))


def q_stream_rejects(spark, sf_dir):
    """Messages by reason for leaving them out, counted in the pass itself (observed
    metrics) and in the sink that the rows and the rejects share."""
    counts: dict[str, int] = {}
    out = sinks.run_to_parquet(merge.sorted_rows(_broken(_messages(spark, sf_dir))), "rejects",
                               partition_by=["reason"], counts=counts)
    seen = spark.createDataFrame([(r, counts.get(f"messages.{r}", 0)) for r in (merge.GOOD, *merge.REASONS)],
                                 "reason string, observed long")
    kept = out.groupBy("reason").agg(F.count(F.lit(1)).alias("written"), F.count("value").alias("texts"))
    return seen.join(kept, "reason", "left").select(
        "reason", "observed", F.coalesce("written", F.lit(0)).alias("written"),
        F.coalesce("texts", F.lit(0)).alias("texts"))


class SinkFailure(Exception):
    """The failure that :func:`q_stream_resume` makes."""


def q_stream_resume(spark, sf_dir):
    """A run over the events in several files fails after a sink write and before
    its commit; the resumed run neither loses nor repeats a row."""
    base = scratch_path(spark, f"tickwise-streams/resume-{uuid.uuid4().hex[:12]}")
    ev = tables.table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    ev.repartition(RESUME_FILES, "event_id").write.parquet(f"{base}/in")
    write = sinks.epoch_writer(f"{base}/out")

    def failing(batch, epoch):
        write(batch, epoch)
        if epoch == 1:
            raise SinkFailure("after the write, before the commit")

    def stream():
        return sources.folder_stream(spark, f"{base}/in", ev.schema, max_files_per_trigger=1)

    try:
        sinks.run_each_batch(stream(), failing, f"{base}/_checkpoint")
    except StreamingQueryException as e:
        if "before the commit" not in str(e):
            raise
    sinks.run_each_batch(stream(), write, f"{base}/_checkpoint")
    return finish(spark.read.parquet(f"{base}/out").drop("epoch"))


QUERIES = {
    "stream_rejects": q_stream_rejects,
    "stream_resume": q_stream_resume,
    "stream_predictions": q_stream_predictions,
    "stream_minute_features": q_stream_minute_features,
    "stream_state_merge": q_stream_state_merge,
    "stream_minute_timers": q_stream_minute_timers,
    "stream_envelope_roundtrip": q_stream_envelope_roundtrip,
}

# Minutes are closed once the watermark (last event less ten minutes) has passed them.
_CLOSED = f"""m AS ({MINUTE_FEATURES_RAW_SQL}),
wm AS (SELECT max(ts) - INTERVAL 10 MINUTE AS w FROM events WHERE event_type IN ({sql_list(ALL_TYPES)})),
clean AS (SELECT Timestamp_Rounded AS ts, Open, High, Low, Close, Volume, Score AS Sentiment_Value FROM m, wm
  WHERE Timestamp_Rounded + INTERVAL 1 MINUTE <= w AND Open IS NOT NULL AND High IS NOT NULL
    AND Low IS NOT NULL AND Close IS NOT NULL AND Volume IS NOT NULL)"""

ORACLE = {
    "stream_rejects": f"""WITH e AS (
  SELECT CASE event_id % 10 WHEN 3 THEN 'malformed' WHEN 5 THEN 'unknown type' WHEN 7 THEN 'empty' ELSE 'ok' END AS reason
  FROM events WHERE event_type IN ({sql_list(ALL_TYPES)})),
r AS (SELECT unnest(['ok', 'malformed', 'unknown type', 'empty']) AS reason)
SELECT r.reason, count(e.reason) AS observed, count(e.reason) AS written,
  count(CASE WHEN e.reason <> 'ok' THEN 1 END) AS texts
FROM r LEFT JOIN e ON e.reason = r.reason GROUP BY 1""",
    "stream_resume": "SELECT event_id, ts, event_type, round(value, 6) AS value FROM events",
    "stream_predictions": f"""WITH {_CLOSED},
w AS (SELECT ts AS start_ts, lead(ts, {samples.WINDOW - 1}) OVER o AS end_ts,
    list([Open, High, Low, Close, Volume, Sentiment_Value]) OVER (ORDER BY ts ROWS BETWEEN CURRENT ROW AND {samples.WINDOW - 1} FOLLOWING) AS rws,
    lead(Close, {samples.WINDOW - 1}) OVER o AS lc, lead(Volume, {samples.WINDOW - 1}) OVER o AS lv
  FROM clean WINDOW o AS (ORDER BY ts)),
s AS (SELECT *, {features_sql()} AS fs FROM w WHERE end_ts IS NOT NULL),
p AS (SELECT start_ts, end_ts, {p_up_sql('fs')} AS p FROM s)
SELECT start_ts, end_ts, round(p, 6) AS p_up, CASE WHEN p < 0.5 THEN 'DOWN' ELSE 'UP' END AS direction
FROM p WHERE p IS NOT NULL""",
    "stream_minute_features": MINUTE_FEATURES_SQL,
    "stream_state_merge": MINUTE_FEATURES_SQL,
    "stream_minute_timers": MINUTE_FEATURES_SQL,
    "stream_envelope_roundtrip": f"""SELECT CAST(event_id AS VARCHAR) AS key,
  CASE WHEN event_type IN ({sql_list(NEWS_TYPES)}) THEN date_trunc('second', ts)
       ELSE date_trunc('second', ts) END AS ts,
  event_type IN ({sql_list(NEWS_TYPES)}) AS is_news,
  CASE WHEN event_type IN ({sql_list(PRICE_TYPES)}) THEN round(value, 6) END AS Open, Open AS High,
  Open AS Low, Open AS Close,
  CASE WHEN event_type IN ({sql_list(PRICE_TYPES)}) THEN round(CAST(json_extract_string(props, '$.k') AS DOUBLE), 6) END AS Volume,
  CASE WHEN event_type IN ({sql_list(NEWS_TYPES)}) THEN round(value, 6) END AS score
FROM events WHERE event_type IN ({sql_list(ALL_TYPES)})""",
}
