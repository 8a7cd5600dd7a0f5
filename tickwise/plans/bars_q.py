"""Named queries over minute/hour bars (events adapter)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tickwise.operators import bars
from tickwise.plans.common import finish, sql_list
from tickwise.sources import tables
from tickwise.sources.tables import NEWS_TYPES, PRICE_TYPES

ALL_TYPES = PRICE_TYPES + NEWS_TYPES

# --- oracle building blocks (DuckDB dialect) -------------------------------
TAGGED_SQL = f"""
  SELECT ts, event_type IN ({sql_list(NEWS_TYPES)}) AS is_news, value,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS vol
  FROM events WHERE event_type IN ({sql_list(ALL_TYPES)})"""

MINUTE_FEATURES_RAW_SQL = f"""
SELECT date_trunc('minute', ts) AS Timestamp_Rounded,
  avg(CASE WHEN NOT is_news THEN value END) AS Open,
  max(CASE WHEN NOT is_news THEN value END) AS High,
  min(CASE WHEN NOT is_news THEN value END) AS Low,
  avg(CASE WHEN NOT is_news THEN value END) AS Close,
  CASE WHEN count(CASE WHEN NOT is_news THEN 1 END) > 0
       THEN coalesce(sum(CASE WHEN NOT is_news THEN vol END), 0) END AS Volume,
  coalesce(sum(CASE WHEN is_news THEN value END), 0) AS Score,
  count(CASE WHEN is_news THEN value END) AS news_count
FROM ({TAGGED_SQL}) t
GROUP BY 1"""

MINUTE_FEATURES_SQL = f"""
SELECT Timestamp_Rounded, round(Open, 6) AS Open, round(High, 6) AS High, round(Low, 6) AS Low,
  round(Close, 6) AS Close, round(Volume, 6) AS Volume, round(Score, 6) AS Score, news_count
FROM ({MINUTE_FEATURES_RAW_SQL}) m"""


def q_minute_features(spark: SparkSession, sf_dir: str):
    """Flagship: minute OHLCV with summed news score and article count."""
    return finish(bars.minute_features_tagged(tables.tagged_ticks(spark, sf_dir)))


QUERIES = {
    "minute_features": q_minute_features,
}
ORACLE = {
    "minute_features": MINUTE_FEATURES_SQL,
}


# --- dense hourly series, overlay, normalise, derivative ---------------------
from pyspark.sql import functions as F  # noqa: E402

from tickwise.functions import timefmt as tf  # noqa: E402
from tickwise.operators import series as S  # noqa: E402
from tickwise.plans.series_q import HIST, REFERENCE_COIN  # noqa: E402


def q_tick_seconds(spark, sf_dir):
    """F7 + F16: seconds since midnight of every tick, by its time as text."""
    t = tables.price_ticks(spark, sf_dir).select("id", F.date_format("ts", "HH:mm:ss").alias("time"))
    return t.select("id", "time", tf.hms_seconds("time").alias("seconds"))


QUERIES["tick_seconds"] = q_tick_seconds
ORACLE["tick_seconds"] = f"""SELECT event_id AS id, strftime(ts, '%H:%M:%S') AS time,
  CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS INTEGER) AS seconds
FROM events WHERE event_type IN ({sql_list(PRICE_TYPES)})"""


def _minutes(spark, sf_dir):
    return bars.minute_features_tagged(tables.tagged_ticks(spark, sf_dir))


def _hourly_news(spark, sf_dir):
    return bars.dense_bucket_agg(tables.news_rows(spark, sf_dir), "pub_date", "score", "sum",
                                 "hour", out="score_sum")


def _hourly_close(spark, sf_dir):
    return bars.dense_bucket_agg(_minutes(spark, sf_dir), "Timestamp_Rounded", "Close", "mean",
                                 "hour", out="close_mean")


def q_hourly_news_score(spark, sf_dir):
    """A4: dense hourly sum of news score (empty hour = 0)."""
    return finish(_hourly_news(spark, sf_dir))


def q_hourly_close_mean(spark, sf_dir):
    """A5: dense hourly mean close (empty hour = null)."""
    return finish(_hourly_close(spark, sf_dir))


def q_hourly_close_volume_sum(spark, sf_dir):
    """A6 + W4: dense hourly sums of close and volume (empty hour = 0), each
    also divided by its abs-max."""
    m = _minutes(spark, sf_dir)
    both = bars.dense_bucket_agg(m, "Timestamp_Rounded", ["Close", "Volume"], "sum", "hour",
                                 out=["close_sum", "volume_sum"])
    return finish(S.absmax_normalise(both, ["close_sum", "volume_sum"]))


def q_daily_close_volume(spark, sf_dir):
    """A7 + P6: sparse daily sums of close and volume for one name."""
    h = tables.daily_history(spark, sf_dir).where(F.col("coin") == REFERENCE_COIN)
    return finish(bars.daily_sum(h, "date", ["close", "volume"]))


def q_sentiment_price_overlay(spark, sf_dir):
    """J4 + W4 + W3: hourly news score and close on one axis, normalised
    by their abs-max, with the derivative of each normalised series."""
    step = F.expr("INTERVAL 1 HOUR")
    n = S.absmax_normalise(_hourly_news(spark, sf_dir), ["score_sum"])
    n = S.gradient_dense(n, "bucket", "score_sum_norm", step, out="score_slope")
    c = S.absmax_normalise(_hourly_close(spark, sf_dir), ["close_mean"])
    c = S.gradient_dense(c, "bucket", "close_mean_norm", step, out="close_slope")
    return finish(bars.overlay(n, c, "bucket"))


def q_minute_feature_counts(spark, sf_dir):
    """Non-null counts per column and the row count of the feature table."""
    return bars.column_counts(_minutes(spark, sf_dir))


def q_news_minute_range(spark, sf_dir):
    """A2 + A3: per-minute news sum, count, max and range."""
    return finish(bars.news_minute_stats(tables.news_rows(spark, sf_dir), with_range=True))


def q_minute_features_outer_join(spark, sf_dir):
    """J1 literally: per-side aggregates, full outer join, news nulls -> 0."""
    return finish(bars.minute_features_joined(tables.price_ticks(spark, sf_dir),
                                              tables.news_rows(spark, sf_dir)))


QUERIES.update({
    "hourly_news_score": q_hourly_news_score,
    "hourly_close_mean": q_hourly_close_mean,
    "hourly_close_volume_sum": q_hourly_close_volume_sum,
    "daily_close_volume": q_daily_close_volume,
    "sentiment_price_overlay": q_sentiment_price_overlay,
    "minute_feature_counts": q_minute_feature_counts,
    "news_minute_range": q_news_minute_range,
    "minute_features_outer_join": q_minute_features_outer_join,
})

MINUTES_CTE = f"minutes AS ({MINUTE_FEATURES_RAW_SQL})"
NEWS_SQL = f"SELECT ts AS pub_date, value AS score FROM events WHERE event_type IN ({sql_list(NEWS_TYPES)})"


def dense_sql(name: str, src: str, ts: str, agg: str, fill: str) -> str:
    """CTE ``name(bucket, v)``: hourly ``agg`` over ``src`` on a gap-free spine."""
    return f"""{name}_raw AS (SELECT date_trunc('hour', {ts}) AS bucket, {agg} AS v FROM {src} GROUP BY 1),
{name} AS (
  SELECT s.bucket, {fill} AS v FROM (
    SELECT unnest(generate_series((SELECT min(bucket) FROM {name}_raw),
                                  (SELECT max(bucket) FROM {name}_raw), INTERVAL 1 HOUR)) AS bucket) s
  LEFT JOIN {name}_raw r USING (bucket))"""


def slope_sql(v: str) -> str:
    w = "OVER (ORDER BY bucket)"
    return f"""CASE WHEN lag(bucket) {w} IS NOT NULL AND lead(bucket) {w} IS NOT NULL
        THEN (lead({v}) {w} - lag({v}) {w}) / 2
      WHEN lead(bucket) {w} IS NOT NULL THEN lead({v}) {w} - {v}
      WHEN lag(bucket) {w} IS NOT NULL THEN {v} - lag({v}) {w} END"""


ORACLE.update({
    "hourly_news_score": f"""WITH {dense_sql('n', f'({NEWS_SQL})', 'pub_date', 'sum(score)', 'coalesce(r.v, 0)')}
SELECT bucket, round(v, 6) AS score_sum FROM n""",
    "hourly_close_mean": f"""WITH {MINUTES_CTE},
{dense_sql('c', 'minutes', 'Timestamp_Rounded', 'avg(Close)', 'r.v')}
SELECT bucket, round(v, 6) AS close_mean FROM c""",
    "hourly_close_volume_sum": f"""WITH {MINUTES_CTE},
{dense_sql('c', 'minutes', 'Timestamp_Rounded', 'sum(Close)', 'coalesce(r.v, 0)')},
{dense_sql('v', 'minutes', 'Timestamp_Rounded', 'sum(Volume)', 'coalesce(r.v, 0)')},
b AS (SELECT bucket, c.v AS cs, v.v AS vs FROM c FULL OUTER JOIN v USING (bucket))
SELECT bucket, round(cs, 6) AS close_sum, round(vs, 6) AS volume_sum,
  round(cs / nullif((SELECT greatest(max(cs), abs(min(cs))) FROM b), 0), 6) AS close_sum_norm,
  round(vs / nullif((SELECT greatest(max(vs), abs(min(vs))) FROM b), 0), 6) AS volume_sum_norm
FROM b""",
    "daily_close_volume": f"""WITH {HIST}
SELECT date, round(sum(close), 6) AS close_sum, CAST(sum(volume) AS BIGINT) AS volume_sum
FROM hist WHERE coin = '{REFERENCE_COIN}' GROUP BY date""",
    "sentiment_price_overlay": f"""WITH {MINUTES_CTE},
{dense_sql('n', f'({NEWS_SQL})', 'pub_date', 'sum(score)', 'coalesce(r.v, 0)')},
{dense_sql('c', 'minutes', 'Timestamp_Rounded', 'avg(Close)', 'r.v')},
nn AS (SELECT bucket, v AS score_sum, v / nullif((SELECT greatest(max(v), abs(min(v))) FROM n), 0) AS score_sum_norm FROM n),
cn AS (SELECT bucket, v AS close_mean, v / nullif((SELECT greatest(max(v), abs(min(v))) FROM c), 0) AS close_mean_norm FROM c),
ns AS (SELECT *, {slope_sql('score_sum_norm')} AS score_slope FROM nn),
cs AS (SELECT *, {slope_sql('close_mean_norm')} AS close_slope FROM cn)
SELECT bucket, round(score_sum, 6) AS score_sum, round(score_sum_norm, 6) AS score_sum_norm,
  round(score_slope, 6) AS score_slope, round(close_mean, 6) AS close_mean,
  round(close_mean_norm, 6) AS close_mean_norm, round(close_slope, 6) AS close_slope
FROM ns FULL OUTER JOIN cs USING (bucket)""",
    "minute_feature_counts": f"""WITH {MINUTES_CTE}
SELECT count(*) AS n_rows, count(Timestamp_Rounded) AS n_Timestamp_Rounded, count(Open) AS n_Open,
  count(High) AS n_High, count(Low) AS n_Low, count(Close) AS n_Close, count(Volume) AS n_Volume,
  count(Score) AS n_Score, count(news_count) AS n_news_count FROM minutes""",
    "news_minute_range": f"""SELECT date_trunc('minute', pub_date) AS Timestamp_Rounded,
  round(coalesce(sum(score), 0), 6) AS Score, count(score) AS news_count,
  round(max(score), 6) AS score_max, round(max(score) - min(score), 6) AS score_range
FROM ({NEWS_SQL}) n GROUP BY 1""",
    "minute_features_outer_join": MINUTE_FEATURES_SQL,
})
