"""Models that are tables of coefficients, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickwise.operators import model


def _rows(spark, n=200, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) + [0, 1e6, 5]
    y = 2 + x @ [1.5, -0.25, 0.0] + rng.normal(scale=0.1, size=n)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, y double")
    return df, x, y


@pytest.mark.parametrize("ridge", [0.0, 0.3])
@pytest.mark.parametrize("files", [1, 6])
def test_least_squares_is_numpy_s(spark, ridge, files):
    df, x, y = _rows(spark)
    holes = spark.createDataFrame([(None, 1.0, 1.0, 1.0), (1.0, 1.0, 1.0, None), (float("nan"), 1.0, 1.0, 1.0)], df.schema)
    got = {r["name"]: r["weight"] for r in model.least_squares(
        df.unionByName(holes).repartition(files), ["a", "b", "c"], "y", ridge).collect()}
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc / len(x) + ridge * np.eye(3), xc.T @ yc / len(x))
    assert [got[k] for k in "abc"] == pytest.approx(w, rel=1e-6, abs=1e-9)
    assert got[model.BIAS] == pytest.approx(y.mean() - w @ x.mean(0), rel=1e-6)


def test_least_squares_of_odd_tables(spark):
    df, _, _ = _rows(spark, 30)
    empty = model.least_squares(df.where("false"), ["a"], "y").collect()
    assert [(r["name"], r["weight"]) for r in empty] == [(model.BIAS, None), ("a", None)]
    twice = {r["name"]: r["weight"] for r in model.least_squares(
        df.withColumn("a2", F.col("a")).withColumn("one", F.lit(1.0)), ["a", "a2", "one"], "y").collect()}
    assert twice["a"] == pytest.approx(twice["a2"]) and twice["one"] == pytest.approx(0)


def test_linear_model_survives_saving(spark, tmp_dir):
    coefs = spark.createDataFrame([(model.BIAS, -1, 0.5), ("a", 0, 2.0), ("b", 1, -1e-9)], model.COEFFICIENTS)
    data = spark.createDataFrame([(1, [1.0, 3.0]), (2, [0.0, 1e9]), (3, [None, 1.0]), (4, [0.0, 0.0]), (5, None)],
                                 "t int, features array<double>")
    for kind, col, f in (("logistic", "p_up", lambda z: 1 / (1 + np.exp(-z))), ("linear", "prediction", lambda z: z)):
        path = f"{tmp_dir}/{kind}"
        model.save(model.linear_model(coefs, kind=kind), path)
        got = {r["t"]: r[col] for r in model.load(path).transform(data).collect()}
        assert got[1] == pytest.approx(f(2.5 - 3e-9)) and got[2] == pytest.approx(f(-0.5))
        assert got[3] is None and got[5] is None and got[4] == pytest.approx(f(0.5))
    none = model.linear_model(coefs.where("false"), kind="linear").transform(data).collect()
    assert {r["prediction"] for r in none} == {0.0}
    out = model.score_linear(model.load(f"{tmp_dir}/logistic"), data.where("t <> 3 AND features IS NOT NULL"))
    assert {r["t"]: r["direction"] for r in out.collect()} == {1: "UP", 2: "DOWN", 4: "UP"}
