"""Named queries of models that are tables of coefficients."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import functions as F

from tickwise.operators import model, samples, stats
from tickwise.plans import samples_q
from tickwise.plans.common import finish
from tickwise.plans.samples_q import SMALL_HOLDOUT
from tickwise.session import materialize, scratch_path

RIDGE = 0.05
N_FEATURES = samples.WINDOW * len(samples.FEATURES)
BIAS = -0.25


def fixed_coefficients(spark):
    """A table of made coefficients: the rule is the model of the query, not a fit."""
    rows = [(f"f{i}", i, _weight(i)) for i in range(N_FEATURES)]
    return spark.createDataFrame([(model.BIAS, -1, BIAS), *rows], model.COEFFICIENTS)


def _weight(i: int) -> float:
    return round(math.sin(i + 1) / 20, 6)


def q_price_regression(spark, sf_dir):
    """M3 + A17: next price from the mean close of the window, alone and (ridge) with
    the first volume; coefficients, and errors on the last tenth of the train starts."""
    s = samples.build_samples(samples_q._input(spark, sf_dir), test_starts=SMALL_HOLDOUT)
    closes = F.transform(F.sequence(F.lit(0), F.lit(samples.WINDOW - 1)),
                         lambda i: F.element_at("features", i * len(samples.FEATURES) + 4))
    mean = F.aggregate(closes, F.lit(0.0), lambda a, x: a + x) / samples.WINDOW
    rows = materialize(s.where("split = 'train'").select(
        "t", mean.alias("x1"), F.element_at("features", 5).alias("x2"), "y1").dropna())
    fit, rest = model.time_split(rows)
    out = None
    for name, cols, ridge in (("one", ["x1"], 0.0), ("two", ["x1", "x2"], RIDGE)):
        coefs = model.least_squares(fit, cols, "y1", ridge)
        scored = model.linear_model(coefs, "x", "linear").transform(
            rest.withColumn("x", F.array(*cols)))
        err = stats.regression_metrics(scored, "y1")
        part = coefs.select(F.lit(name).alias("model"), "name", F.col("weight").alias("value")).unionByName(
            err.select(F.lit(name).alias("model"), F.expr(
                "stack(3, 'mae', mae, 'mse', mse, 'n', CAST(n AS DOUBLE)) AS (name, value)")))
        out = part if out is None else out.unionByName(part)
    return finish(out)


def q_linear_scores(spark, sf_dir):
    """K5 + M4 + F24: a pipeline of fixed coefficients, saved, loaded and applied to
    every sample."""
    path = scratch_path(spark, f"models/linear-{uuid.uuid4().hex}")
    model.save(model.linear_model(fixed_coefficients(spark)), path)
    s = samples.build_samples(samples_q._input(spark, sf_dir))
    return finish(model.score_linear(model.load(path), s).select("t", "split", "p_up", "direction", "label"))


QUERIES = {"price_regression": q_price_regression, "linear_scores": q_linear_scores}


def weights_sql() -> str:
    return "[" + ", ".join(f"{_weight(i)!r}::DOUBLE" for i in range(N_FEATURES)) + "]"


def features_sql() -> str:
    """The 360 features of a row of the samples SQL, not rounded."""
    d = samples_q._div
    return (f"flatten(list_transform(rws, lambda r: [{d('r[1]', 'lc')}, {d('r[2]', 'lc')}, {d('r[3]', 'lc')}, "
            f"{d('r[4]', 'lc')}, {d('r[5]', 'lv')}, {d('r[6]', 'lv')}]))")


def p_up_sql(features: str) -> str:
    """Null where a feature is null (as the product in Spark)."""
    return (f"CASE WHEN len(list_filter({features}, lambda v: v IS NULL)) = 0 THEN "
            f"1 / (1 + exp(-({BIAS!r}::DOUBLE + list_inner_product(list_transform({features}, lambda v: coalesce(v, 0)), {weights_sql()})))) END")


_FIT = f"""WITH x AS ({samples_q._samples_sql(SMALL_HOLDOUT)}),
v AS (SELECT i AS t, list_sum(list_transform(rws, lambda r: {samples_q._div('r[4]', 'lc')})) / {samples.WINDOW} AS x1,
    {samples_q._div('rws[1][5]', 'lv')} AS x2, {samples_q._div('c1', 'lc')} AS y1
  FROM x WHERE split = 'train'),
u AS (SELECT * FROM v WHERE x1 IS NOT NULL AND x2 IS NOT NULL AND y1 IS NOT NULL),
cut AS (SELECT min(t) + (max(t) - min(t)) * (1.0 - {model.VALIDATION_SHARE}) AS c FROM u),
f AS (SELECT * FROM u, cut WHERE t < c),
r AS (SELECT * FROM u, cut WHERE t >= c),
s AS (SELECT avg(x1) m1, avg(x2) m2, avg(y1) my, covar_pop(x1, x1) + {RIDGE} a, covar_pop(x2, x2) + {RIDGE} d,
    covar_pop(x1, x2) b, covar_pop(y1, x1) g, covar_pop(y1, x2) h,
    regr_slope(y1, x1) w0, regr_intercept(y1, x1) i0 FROM f),
w AS (SELECT *, (d * g - b * h) / (a * d - b * b) AS w1, (a * h - b * g) / (a * d - b * b) AS w2 FROM s),
k AS (SELECT 'one' AS model, i0 AS i, w0 AS wa, 0.0 AS wb FROM w
      UNION ALL SELECT 'two', my - w1 * m1 - w2 * m2, w1, w2 FROM w),
e AS (SELECT k.model, avg(abs(i + wa * x1 + wb * x2 - y1)) AS mae,
    avg((i + wa * x1 + wb * x2 - y1) * (i + wa * x1 + wb * x2 - y1)) AS mse, count(r.t)::DOUBLE AS n
  FROM k LEFT JOIN r ON true GROUP BY k.model)"""
ORACLE = {
    "price_regression": f"""{_FIT}
SELECT model, name, round(value, 6) AS value FROM (
  SELECT model, '{model.BIAS}' AS name, i AS value FROM k UNION ALL SELECT model, 'x1', wa FROM k
  UNION ALL SELECT model, 'x2', wb FROM k WHERE model = 'two'
  UNION ALL SELECT model, 'mae', mae FROM e UNION ALL SELECT model, 'mse', mse FROM e
  UNION ALL SELECT model, 'n', n FROM e) z""",
    "linear_scores": f"""WITH x AS ({samples_q._samples_sql(samples.TEST_STARTS)}),
s AS (SELECT i AS t, split, {features_sql()} AS fs, CAST({samples_q._div('c1', 'lc')} > 1 AS INTEGER) AS label FROM x),
p AS (SELECT t, split, label, {p_up_sql('fs')} AS p FROM s)
SELECT t, split, round(p, 6) AS p_up, CASE WHEN p < 0.5 THEN 'DOWN' ELSE 'UP' END AS direction, label
FROM p WHERE p IS NOT NULL""",
}
