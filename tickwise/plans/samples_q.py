"""Named queries over training samples."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tickwise.functions import numeric as num
from tickwise.operators import bars, samples, stats
from tickwise.plans.bars_q import MINUTE_FEATURES_RAW_SQL
from tickwise.plans.common import finish
from tickwise.session import materialize, scratch_path
from tickwise.sources import tables

# A smaller holdout used to exercise both splits on small inputs.
SMALL_HOLDOUT = 1000


def _input(spark, sf_dir):
    """The complete minutes, written once: the row index reads them twice."""
    return materialize(samples.model_input(
        bars.minute_features_tagged(tables.tagged_ticks(spark, sf_dir))))


def q_sample_targets(spark, sf_dir):
    """W5-W8 with the reference layout (60 rows, targets 1/10/30, 10,000 held out)."""
    s = samples.build_samples(_input(spark, sf_dir))
    return finish(s.select("t", "start_ts", "end_ts", "split", "y1", "y10", "y30", "label"))


def q_sample_features(spark, sf_dir):
    """M1: the 360 normalised features of every sample."""
    s = samples.build_samples(_input(spark, sf_dir))
    return finish(s.select("t", "features"))


def q_sample_split_counts(spark, sf_dir):
    """W8 with a 1,000-start holdout: sample count and up share per split."""
    s = samples.build_samples(_input(spark, sf_dir), test_starts=SMALL_HOLDOUT)
    return finish(s.groupBy("split").agg(F.count(F.lit(1)).alias("n"),
                                         F.avg("label").alias("up_share"),
                                         F.min("t").alias("first_t"), F.max("t").alias("last_t")))


def q_live_sample(spark, sf_dir):
    """T9 input / prediction sample: the newest 60 complete minutes, normalised."""
    return finish(samples.latest_sample(_input(spark, sf_dir)).select(
        "start_ts", "end_ts", "features"))


QUERIES = {
    "live_sample": q_live_sample,
    "sample_targets": q_sample_targets,
    "sample_features": q_sample_features,
    "sample_split_counts": q_sample_split_counts,
}


def _samples_sql(test: int) -> str:
    h = samples.WINDOW + max(samples.TARGETS)
    ys = ", ".join(f"lead(Close, {samples.WINDOW + n}) OVER o AS c{n}" for n in samples.TARGETS)
    return f"""WITH minutes AS ({MINUTE_FEATURES_RAW_SQL}),
clean AS (SELECT Timestamp_Rounded AS ts, Open, High, Low, Close, Volume, Score AS Sentiment_Value
  FROM minutes WHERE Timestamp_Rounded IS NOT NULL AND Open IS NOT NULL AND High IS NOT NULL
  AND Low IS NOT NULL AND Close IS NOT NULL AND Volume IS NOT NULL AND Score IS NOT NULL
  AND news_count IS NOT NULL),
idx AS (SELECT *, row_number() OVER (ORDER BY ts) - 1 AS i, count(*) OVER () AS N FROM clean),
w AS (SELECT i, N, ts AS start_ts, lead(ts, {samples.WINDOW - 1}) OVER o AS end_ts,
    list([Open, High, Low, Close, Volume, Sentiment_Value]) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND {samples.WINDOW - 1} FOLLOWING) AS rws,
    lead(Close, {samples.WINDOW - 1}) OVER o AS lc, lead(Volume, {samples.WINDOW - 1}) OVER o AS lv, {ys}
  FROM idx WINDOW o AS (ORDER BY i)),
s AS (SELECT *, CASE WHEN i < N - {h} - {test} THEN 'train' WHEN i > 0 THEN 'test' END AS split
  FROM w WHERE i < N - {h})
SELECT * FROM s WHERE split IS NOT NULL"""


def _div(a: str, b: str) -> str:
    return f"CASE WHEN {b} = 0 THEN NULL ELSE {a} / {b} END"


_Y = ", ".join(f"round({_div(f'c{n}', 'lc')}, 6) AS y{n}" for n in samples.TARGETS)
ORACLE = {
    "live_sample": f"""WITH minutes AS ({MINUTE_FEATURES_RAW_SQL}),
clean AS (SELECT Timestamp_Rounded AS ts, Open, High, Low, Close, Volume, Score AS Sentiment_Value
  FROM minutes WHERE Timestamp_Rounded IS NOT NULL AND Open IS NOT NULL AND High IS NOT NULL
  AND Low IS NOT NULL AND Close IS NOT NULL AND Volume IS NOT NULL AND Score IS NOT NULL
  AND news_count IS NOT NULL),
last AS (SELECT * FROM clean ORDER BY ts DESC LIMIT {samples.WINDOW}),
agg AS (SELECT min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS n,
  list([Open, High, Low, Close, Volume, Sentiment_Value] ORDER BY ts) AS rws,
  arg_max(Close, ts) AS lc, arg_max(Volume, ts) AS lv FROM last)
SELECT start_ts, end_ts, flatten(list_transform(rws, lambda r: [
  round({_div('r[1]', 'lc')}, 6), round({_div('r[2]', 'lc')}, 6), round({_div('r[3]', 'lc')}, 6),
  round({_div('r[4]', 'lc')}, 6), round({_div('r[5]', 'lv')}, 6), round({_div('r[6]', 'lv')}, 6)])) AS features
FROM agg WHERE n = {samples.WINDOW}""",
    "sample_targets": f"""WITH x AS ({_samples_sql(samples.TEST_STARTS)})
SELECT i AS t, start_ts, end_ts, split, {_Y},
  CAST({_div('c1', 'lc')} > 1 AS INTEGER) AS label FROM x""",
    "sample_features": f"""WITH x AS ({_samples_sql(samples.TEST_STARTS)})
SELECT i AS t, flatten(list_transform(rws, lambda r: [
  round({_div('r[1]', 'lc')}, 6), round({_div('r[2]', 'lc')}, 6), round({_div('r[3]', 'lc')}, 6),
  round({_div('r[4]', 'lc')}, 6), round({_div('r[5]', 'lv')}, 6), round({_div('r[6]', 'lv')}, 6)])) AS features
FROM x""",
    "sample_split_counts": f"""WITH x AS ({_samples_sql(SMALL_HOLDOUT)})
SELECT split, count(*) AS n, round(avg(CAST({_div('c1', 'lc')} > 1 AS INTEGER)), 6) AS up_share,
  min(i) AS first_t, max(i) AS last_t FROM x GROUP BY split""",
}


# --- model (rows-only checks: training is iterative, not SQL) ---------------
def q_model_validation(spark, sf_dir):
    """M2 + A17: logistic direction model, accuracy on the latest 10 % of train starts."""
    from tickwise.operators import model
    s = samples.build_samples(_input(spark, sf_dir), test_starts=SMALL_HOLDOUT)
    _, acc = model.train(s)
    return finish(acc)


def q_model_scores(spark, sf_dir):
    """M2 + K5 + M4 + F24: train, save, reload, score the test starts."""
    from tickwise.operators import model
    s = samples.build_samples(_input(spark, sf_dir), test_starts=SMALL_HOLDOUT)
    m, _ = model.train(s)
    path = scratch_path(spark, f"tickwise-models/direction-{uuid.uuid4().hex}")
    model.save(m, path)
    return finish(model.score(model.load(path), s.where(F.col("split") == "test")))


QUERIES.update({
    "model_validation": q_model_validation,
    "model_scores": q_model_scores,
})


# --- decisions and metrics over a stored prediction column -------------------
def _naive(spark, sf_dir):
    """A prediction that needs no training: the price returns to the mean of the
    window's closes. ``y_hat`` is that mean over the last close."""
    s = samples.build_samples(_input(spark, sf_dir), test_starts=SMALL_HOLDOUT)
    step, close = len(samples.FEATURES), samples.FEATURES.index("Close")
    closes = F.filter("features", lambda v, i: i % step == close)
    total = F.aggregate(closes, F.lit(0.0), lambda acc, v: acc + v)
    # written once: the decision, the filter and both metrics read the mean
    n = materialize(s.select("t", "split", "y1", "label",
                             (total / F.lit(float(samples.WINDOW))).alias("y_hat")))
    return n.where(F.col("y_hat").isNotNull()) \
        .withColumn("p_up", F.col("y_hat") / (F.col("y_hat") + F.lit(1.0)))


def q_direction_decisions(spark, sf_dir):
    """M4 + F24: UP/DOWN decisions of the held-out starts from a probability column."""
    n = _naive(spark, sf_dir).where(F.col("split") == "test")
    return finish(n.select("t", "p_up", num.direction("p_up").alias("direction"), "label"))


def q_prediction_metrics(spark, sf_dir):
    """Accuracy, mean absolute and mean squared error of a prediction column."""
    n = _naive(spark, sf_dir).where(F.col("y1").isNotNull())
    up = (num.direction("p_up") == "UP").cast("int")
    return finish(stats.prediction_metrics(n.withColumn("up", up), "label", "up", "y1", "y_hat"))


QUERIES.update({
    "direction_decisions": q_direction_decisions,
    "prediction_metrics": q_prediction_metrics,
})
_NAIVE = f"""WITH x AS ({_samples_sql(SMALL_HOLDOUT)}),
y AS (SELECT i AS t, split, c1 / nullif(lc, 0) AS y1, CAST({_div('c1', 'lc')} > 1 AS INTEGER) AS label,
  list_sum(list_transform(rws, lambda r: r[4] / nullif(lc, 0))) / {samples.WINDOW} AS y_hat FROM x),
p AS (SELECT *, y_hat / (y_hat + 1) AS p_up FROM y WHERE y_hat IS NOT NULL)"""
ORACLE.update({
    "direction_decisions": f"""{_NAIVE}
SELECT t, round(p_up, 6) AS p_up, CASE WHEN p_up < 0.5 THEN 'DOWN' ELSE 'UP' END AS direction, label
FROM p WHERE split = 'test'""",
    "prediction_metrics": f"""{_NAIVE}
SELECT round(avg(CAST(label = CAST(p_up >= 0.5 AS INTEGER) AS INTEGER)), 6) AS accuracy, count(*) AS n,
  round(avg(abs(y_hat - y1)), 6) AS mae, round(avg((y_hat - y1) * (y_hat - y1)), 6) AS mse
FROM p WHERE y1 IS NOT NULL""",
})
