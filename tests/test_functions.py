"""Scalar expressions against Python/pandas behaviour."""

import datetime as dt
from urllib.parse import urljoin

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickwise.functions import numeric as num
from tickwise.functions import text as tx
from tickwise.functions import timefmt as tf


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_python_round1_all_four_place_values(spark):
    # Every value with four decimals in [-1, 1]: Python's round(x, 1) exactly.
    vals = [k / 10000 for k in range(-10000, 10001)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(num.python_round1("x")).collect()]
    assert got == [round(v, 1) + 0.0 for v in vals]


def test_python_round1_known_halves(spark):
    got = one(spark, num.python_round1("x"), [(0.35,), (0.15,), (0.45,), (0.25,), (-0.05,)], "x double")
    assert got == [0.3, 0.1, 0.5, 0.2, -0.1]


def test_sentiment_classes(spark):
    vals = [1.0, 0.5, 0.4, 0.0, -0.5, -0.6, None]
    got = one(spark, num.sentiment_class("x"), [(v,) for v in vals], "x double")
    assert got == ["Very Positive", "Very Positive", "Positive", "Neutral", "Negative",
                   "Very Negative", None]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from(["the", "The", "bitcoin", "a", "  ", "\n", "is", "up", "you're",
                                 "x", "\t", " ", "ok"]), max_size=12))
def test_stop_words_match_python_split(spark, words):
    text = " ".join(words)
    stop = set(tx.ENGLISH_STOP_WORDS)
    want = " ".join(w for w in text.lower().split() if w not in stop)
    got = one(spark, tx.remove_stop_words(tx.lower("t")), [(text,)], "t string")[0]
    assert got == want


def test_relevance_rules(spark):
    rows = [("Bitcoin up",), ("the U.S economy",), ("UXS",), ("nothing",), (None,)]
    got = one(spark, num.relevance("c"), rows, "c string")
    assert got == [6.0, 0.08, 0.08, 0.002, 0.002]
    got_nan = one(spark, num.relevance("c", null_as_hit=True), [(None,)], "c string")
    assert got_nan == [6.0]


def test_text_cleanup(spark):
    rows = [("By Jane Bytes", "<p>a</p><b\nc>d", "[[x]]", "(BTC)", " 1,234 ", "-")]
    df = spark.createDataFrame(rows, "a string, h string, b string, s string, n string, d string")
    r = df.select(tx.strip_byline("a"), tx.strip_byline("a", anchored=False), tx.strip_tags("h"),
                  tx.strip_brackets("b"), tx.inner_text("s"), tx.parse_count("n"),
                  num.dash_to_zero_bigint("d")).first()
    assert r[0] == "Jane Bytes"
    assert r[1] == " Jane tes"
    assert r[2] == "a<b\nc>d"          # a tag broken over two lines survives
    assert r[3] == "x"
    assert r[4] == "BTC"
    assert r[5] == 1234
    assert r[6] == 0


def test_absolute_url_matches_urljoin(spark):
    cases = [("http://a.com/x/y.html", "/z"), ("http://a.com/x/y.html", "z"),
             ("https://a.com", "z"), ("http://a.com/x/", "https://b.org/q"),
             ("https://a.com/p", "//c.net/r"), ("http://a.com/x/y", "")]
    got = one(spark, tx.absolute_url("b", "h"), cases, "b string, h string")
    assert got == [urljoin(b, h) for b, h in cases]


def test_time_parsing(spark):
    rows = [("2019-01-02", "03:04:05", "Mar 01, 2019", "01:02:03")]
    df = spark.createDataFrame(rows, "d string, t string, s string, hms string")
    r = df.select(tf.parse_ts(tf.date_time("d", "t")), tf.parse_scraped_date("s"),
                  tf.hms_seconds("hms"), tf.minute(tf.parse_ts(tf.date_time("d", "t")))).first()
    assert r[0] == dt.datetime(2019, 1, 2, 3, 4, 5)
    assert r[1] == dt.date(2019, 3, 1)
    assert r[2] == 3723
    assert r[3] == dt.datetime(2019, 1, 2, 3, 4)


def test_ratios_are_null_on_zero(spark):
    df = spark.createDataFrame([(2.0, 1.0, 0.0, 1.5)], "high double, low double, open double, close double")
    r = df.select(num.volatility(), num.day_ratio()).first()
    assert r[0] is None and r[1] is None


def test_row_json_omits_nulls(spark):
    from tickwise.functions.jsonfmt import parse_json, row_json
    df = spark.createDataFrame([(1, None, 2.5)], "id int, a string, b double")
    j = df.select(row_json(df).alias("j")).first()[0]
    assert j == '{"id":1,"b":2.5}'
    back = spark.createDataFrame([(j,), ("{bad",)], "j string") \
        .select(parse_json("j", "id int, b double").alias("s")).collect()
    assert back[0]["s"]["b"] == 2.5 and back[1]["s"]["b"] is None
