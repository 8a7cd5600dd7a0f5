"""Time-bucketed bars: minute features, dense hourly series, table counts.

Plan shape at scale: every aggregate here is algebraic (sum / count / min /
max / avg), so Spark runs a partial aggregate inside each scan task and only
one pre-aggregated row per bucket per task crosses the shuffle. A hot bucket
(one minute holding a third of the rows) therefore costs nothing extra.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.functions import timefmt as tf
from tickwise.session import materialize

UNIT_SECONDS = {"minute": 60, "hour": 3600, "day": 86400}


def _price_aggs(is_price: Column) -> list[Column]:
    def p(c):
        return F.when(is_price, F.col(c))
    n_price = F.count(F.when(is_price, F.lit(1)))
    # pandas sums an all-missing group to 0, but only where price rows exist.
    volume = F.when(n_price > 0, F.coalesce(F.sum(p("Volume")), F.lit(0.0)))
    return [F.avg(p("Open")).alias("Open"), F.max(p("High")).alias("High"),
            F.min(p("Low")).alias("Low"), F.avg(p("Close")).alias("Close"),
            volume.alias("Volume")]


def tagged_aggs() -> list[Column]:
    """Aggregates of one minute of tagged rows (shared by batch and stream)."""
    is_news = F.col("is_news")
    return [*_price_aggs(~is_news),
            F.coalesce(F.sum(F.when(is_news, F.col("score"))), F.lit(0.0)).alias("Score"),
            F.count(F.when(is_news, F.col("score"))).alias("news_count")]


def minute_features_tagged(tagged: DataFrame, ts: str = "ts") -> DataFrame:
    """A1 + A2 + J1 + P11 over tagged rows (see ``tables.tagged_ticks``).

    One aggregate keyed by minute replaces "aggregate each side, then full
    outer join": a minute appears if it has a price row, a news row or both.
    Price columns stay null on news-only minutes; ``Score``/``news_count``
    are 0 on price-only minutes.
    """
    return tagged.groupBy(tf.minute(ts).alias("Timestamp_Rounded")).agg(*tagged_aggs())


def minute_features(prices: DataFrame, news: DataFrame,
                    price_ts: str = "ts", news_ts: str = "pub_date") -> DataFrame:
    """Same as :func:`minute_features_tagged` for two separate inputs.

    The sides are tagged and unioned (no join, one shuffle keyed by minute).
    """
    cols = ["Open", "High", "Low", "Close", "Volume"]
    p = prices.select(F.col(price_ts).alias("ts"), F.lit(False).alias("is_news"),
                      *[F.col(c).cast("double").alias(c) for c in cols],
                      F.lit(None).cast("double").alias("score"))
    n = news.select(F.col(news_ts).alias("ts"), F.lit(True).alias("is_news"),
                    *[F.lit(None).cast("double").alias(c) for c in cols],
                    F.col("score").cast("double").alias("score"))
    return minute_features_tagged(p.unionByName(n))


def minute_features_joined(prices: DataFrame, news: DataFrame,
                           price_ts: str = "ts", news_ts: str = "pub_date") -> DataFrame:
    """J1 literally: aggregate each side by minute, then a full outer join.

    Both aggregates come out hash-partitioned on the minute, so the sort-merge
    join reuses that partitioning (no extra exchange). Kept for inputs that
    arrive as already-aggregated tables.
    """
    pa = (prices.groupBy(tf.minute(price_ts).alias("Timestamp_Rounded"))
          .agg(*_price_aggs(F.lit(True))))
    na = news_minute_stats(news, news_ts).select("Timestamp_Rounded", "Score", "news_count")
    j = pa.join(na, "Timestamp_Rounded", "full_outer")
    return j.select("Timestamp_Rounded", "Open", "High", "Low", "Close", "Volume",
                    F.coalesce("Score", F.lit(0.0)).alias("Score"),
                    F.coalesce("news_count", F.lit(0)).cast("bigint").alias("news_count"))


def news_minute_stats(news: DataFrame, ts: str = "pub_date", value: str = "score",
                      with_range: bool = False) -> DataFrame:
    """A2 (sum and non-null count per minute); A3 adds max and ``max - min``."""
    v = F.col(value)
    aggs = [F.coalesce(F.sum(v), F.lit(0.0)).alias("Score"), F.count(v).alias("news_count")]
    if with_range:
        aggs += [F.max(v).alias("score_max"), (F.max(v) - F.min(v)).alias("score_range")]
    return news.groupBy(tf.minute(ts).alias("Timestamp_Rounded")).agg(*aggs)


def time_spine(df: DataFrame, bucket_col: str, unit: str = "hour",
               keys: list[str] | None = None) -> DataFrame:
    """H2: every ``unit`` bucket between the first and last bucket of ``df``.

    ``df[bucket_col]`` must already be truncated to ``unit``. Bounds come from
    a one-row (or one-row-per-key) aggregate; the days in between are spread
    over the cluster and each day is expanded to its buckets, so no single
    row or task holds the whole calendar.
    """
    keys = keys or []
    step = F.expr(f"INTERVAL 1 {unit.upper()}")
    b = df.groupBy(*keys).agg(F.min(bucket_col).alias("_lo"), F.max(bucket_col).alias("_hi"))
    if unit == "day":
        days = b.select(*keys, "_lo", "_hi", F.explode(F.sequence(
            F.col("_lo"), F.col("_hi"), F.expr("INTERVAL 1 DAY"))).alias("_d"))
        return days.select(*keys, tf.ntz("_d").alias(bucket_col))
    days = b.select(*keys, "_lo", "_hi", F.explode(F.sequence(
        F.to_date("_lo"), F.to_date("_hi"), F.expr("INTERVAL 1 DAY"))).alias("_d"))
    days = days.repartition(*keys, "_d") if keys else days.repartition("_d")
    start = tf.ntz(F.col("_d"))
    end = tf.ntz(F.timestamp_add("DAY", F.lit(1), F.col("_d").cast("timestamp_ntz")))
    buckets = days.select(*keys, "_lo", "_hi", F.explode(F.sequence(
        start, end - step, step)).alias(bucket_col))
    return buckets.where(F.col(bucket_col).between(F.col("_lo"), F.col("_hi"))) \
        .select(*keys, bucket_col)


def dense_bucket_agg(df: DataFrame, ts: str, value: str | Sequence[str], how: str,
                     unit: str = "hour", out: str | Sequence[str] | None = None) -> DataFrame:
    """Bucket aggregate of one or several values over a gap-free calendar.

    ``how='sum'``: empty bucket = 0 (pandas ``resample().sum()``);
    ``how='mean'``: empty bucket = null; ``how='count'``: empty bucket = 0.
    The buckets (one row each) are written once: the calendar's bounds and the
    result both read them, and the input is read once.
    """
    values = [value] if isinstance(value, str) else list(value)
    outs = [out] if isinstance(out, str) else list(out or [f"{v}_{how}" for v in values])
    agg = {"sum": lambda v: F.coalesce(F.sum(v), F.lit(0.0)), "mean": F.avg, "count": F.count}[how]
    per = materialize(df.groupBy(tf.ntz(F.date_trunc(unit, F.col(ts))).alias("bucket"))
                      .agg(*[agg(F.col(v)).alias(o) for v, o in zip(values, outs)]))
    fill = {"sum": lambda c: F.coalesce(c, F.lit(0.0)), "mean": lambda c: c,
            "count": lambda c: F.coalesce(c, F.lit(0)).cast("bigint")}[how]
    return time_spine(per, "bucket", unit).join(per, "bucket", "left").select(
        "bucket", *[fill(F.col(o)).alias(o) for o in outs])


def daily_sum(df: DataFrame, date_col: str, values: list[str]) -> DataFrame:
    """Sparse per-day sums (no calendar fill)."""
    return df.groupBy(F.col(date_col).alias("date")).agg(
        *[F.sum(c).alias(f"{c}_sum") for c in values])


def overlay(left: DataFrame, right: DataFrame, key: str = "bucket") -> DataFrame:
    """Two series on one time axis (full outer join on the bucket)."""
    return left.join(right, key, "full_outer")


def column_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Non-null count of every column plus the row count, as one row."""
    cols = columns or df.columns
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  *[F.count(F.col(f"`{c}`")).alias(f"n_{c}") for c in cols])
