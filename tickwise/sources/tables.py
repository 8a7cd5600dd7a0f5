"""Adapters from the generated Parquet tables to the domain inputs.

The jobs expect minute price ticks, scored news rows, daily coin histories,
article texts and crawled pages. The driver tables stand in for them:

* ``events``: ``purchase``/``view`` rows are price ticks (O=H=L=C=value,
  volume = ``props.k``); ``click``/``error``/``signup`` rows are scored news.
* ``orders``: one daily history per ``o_orderpriority`` ("coin").
* ``documents``: article texts (``source`` plays the section name).
* ``pages``: crawled HTML.

Every adapter is a projection/filter over one Parquet scan, so Catalyst
prunes columns and pushes the event-type filter into the reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Which event types stand for price ticks and for news rows.
PRICE_TYPES = ("purchase", "view")
NEWS_TYPES = ("click", "error", "signup")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _volume(props: str = "props"):
    return F.get_json_object(F.col(props), "$.k").cast("double")


def price_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, ts, Open, High, Low, Close, Volume)`` price ticks."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type").isin(*PRICE_TYPES))
    v = F.col("value")
    return ev.select(F.col("event_id").alias("id"), "ts",
                     v.alias("Open"), v.alias("High"), v.alias("Low"), v.alias("Close"),
                     _volume().alias("Volume"))


def news_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, pub_date, score)`` scored news rows."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type").isin(*NEWS_TYPES))
    return ev.select(F.col("event_id").alias("id"), F.col("ts").alias("pub_date"),
                     F.col("value").alias("score"))


def tagged_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price and news rows from ONE scan, tagged by ``is_news``.

    Columns: ``ts, is_news, Open, High, Low, Close, Volume, score``; price
    columns are null on news rows and ``score`` is null on price rows.
    """
    return tag_events(table(spark, sf_dir, "events"))


def tag_events(events: DataFrame) -> DataFrame:
    """The tagging projection of :func:`tagged_ticks` (batch or stream input)."""
    ev = events.where(F.col("event_type").isin(*(PRICE_TYPES + NEWS_TYPES)))
    is_news = F.col("event_type").isin(*NEWS_TYPES)
    price = F.when(~is_news, F.col("value"))
    return ev.select(
        "ts", is_news.alias("is_news"),
        price.alias("Open"), price.alias("High"), price.alias("Low"), price.alias("Close"),
        F.when(~is_news, _volume()).alias("Volume"),
        F.when(is_news, F.col("value")).alias("score"))


def daily_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One daily OHLC history per ``o_orderpriority`` ("coin").

    ``open`` is the day's first order price by order key, ``high``/``low`` the
    extremes, ``close`` the day's mean price (the series value the statistics
    use), ``volume`` the order count and ``market_cap`` the day's total price.
    A partial aggregate runs before the shuffle, so a hot coin or day only
    costs one pre-aggregated row per input partition.
    """
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_orderpriority").alias("coin"),
                      F.to_date("o_orderdate").alias("date"))
            .agg(F.min_by("o_totalprice", "o_orderkey").alias("open"),
                 F.max("o_totalprice").alias("high"),
                 F.min("o_totalprice").alias("low"),
                 F.avg("o_totalprice").alias("close"),
                 F.count(F.lit(1)).alias("volume"),
                 F.sum("o_totalprice").alias("market_cap")))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as news articles: ``(id, content, section_name, lang, n_chars)``."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("id"), F.col("text").alias("content"),
                    F.col("source").alias("section_name"), "lang", "n_chars")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")
