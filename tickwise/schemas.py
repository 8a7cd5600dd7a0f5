"""Explicit schemas for every input the jobs read, and the column rename map."""

from pyspark.sql import types as T

# Minute price row as published by the price feed (header-less CSV).
PRICE_ROW = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("Open", T.FloatType()),
    T.StructField("High", T.FloatType()),
    T.StructField("Low", T.FloatType()),
    T.StructField("Close", T.FloatType()),
    T.StructField("Volume", T.FloatType()),
    T.StructField("Time", T.StringType()),
    T.StructField("Date", T.StringType()),
])

# Scored news row (header-less CSV); pub_date and word_count are strings.
NEWS_ROW = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("web_url", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("headline", T.StringType()),
    T.StructField("document_type", T.StringType()),
    T.StructField("pub_date", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("section_name", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("word_count", T.StringType()),
    T.StructField("content_no_stopwords", T.StringType()),
    T.StructField("SENTIMENT_VALUE", T.FloatType()),
    T.StructField("SENTIMENT", T.StringType()),
    T.StructField("relevance", T.FloatType()),
    T.StructField("score", T.FloatType()),
])

# Raw article metadata before text is attached.
RAW_NEWS = T.StructType([
    T.StructField("web_url", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("headline", T.StringType()),
    T.StructField("document_type", T.StringType()),
    T.StructField("pub_date", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("section_name", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("word_count", T.StringType()),
])

# Minute feature table (output of the bar builder).
MINUTE_FEATURES = T.StructType([
    T.StructField("Timestamp_Rounded", T.TimestampNTZType()),
    T.StructField("Open", T.DoubleType()),
    T.StructField("High", T.DoubleType()),
    T.StructField("Low", T.DoubleType()),
    T.StructField("Close", T.DoubleType()),
    T.StructField("Volume", T.DoubleType()),
    T.StructField("Score", T.DoubleType()),
    T.StructField("news_count", T.LongType()),
])

# Daily coin history as scraped: dates like "Mar 01, 2019", '-' for missing.
HISTORY_CSV = T.StructType([
    T.StructField("_index", T.IntegerType()),
    T.StructField("Date", T.StringType()),
    T.StructField("Open*", T.DoubleType()),
    T.StructField("High", T.DoubleType()),
    T.StructField("Low", T.DoubleType()),
    T.StructField("Close**", T.DoubleType()),
    T.StructField("Volume", T.StringType()),
    T.StructField("Market Cap", T.StringType()),
])

# One rename map at ingest: scraped headers -> canonical names.
HISTORY_RENAMES = {
    "Date": "date_str",
    "Open*": "open",
    "High": "high",
    "Low": "low",
    "Close**": "close",
    "Volume": "volume",
    "Market Cap": "market_cap",
}

# Stream envelope: producer-agnostic message with a typed tag.
EVENT_ENVELOPE = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("msg_type", T.StringType()),
    T.StructField("data", T.ArrayType(T.StringType())),
])

# Monthly archive response: response.docs[] with nested headline / byline.
ARCHIVE_JSON = T.StructType([
    T.StructField("response", T.StructType([
        T.StructField("docs", T.ArrayType(T.StructType([
            T.StructField("web_url", T.StringType()),
            T.StructField("headline", T.StructType([T.StructField("main", T.StringType())])),
            T.StructField("byline", T.StructType([T.StructField("original", T.StringType())])),
            T.StructField("document_type", T.StringType()),
            T.StructField("pub_date", T.StringType()),
            T.StructField("source", T.StringType()),
            T.StructField("section_name", T.StringType()),
            T.StructField("word_count", T.LongType()),
        ]))),
    ])),
])

# Sentiment lexicon and stop-word tables.
LEXICON = T.StructType([
    T.StructField("word", T.StringType(), False),
    T.StructField("valence", T.DoubleType(), False),
])
