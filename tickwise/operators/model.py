"""Direction classifier on samples with Spark ML.

The original trained a GPU LSTM in one process; here the 360 normalised
features feed a Spark ML pipeline (scaler + classifier) that trains with
distributed tree aggregation. Validation is the most recent 10 % of the
training starts (by time, never shuffled).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier)
from pyspark.ml.feature import SQLTransformer, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.functions import numeric as num
from tickwise.operators import stats
from tickwise.session import materialize

VALIDATION_SHARE = 0.1
# Hidden layer sizes of the dense classifier variant.
MLP_LAYERS = (64, 32, 32)


def assemble(samples: DataFrame, label: str | None = "label") -> DataFrame:
    """M1: features array -> ML vector; drops samples with missing features
    (a zero last close/volume leaves nulls, which a model cannot take) and,
    for training (``label`` given), samples without a label."""
    ok = F.forall("features", lambda x: x.isNotNull() & ~F.isnan(x))
    if label:
        ok = ok & F.col(label).isNotNull()
    return samples.where(ok).withColumn("fv", array_to_vector("features"))


def time_split(train: DataFrame, share: float = VALIDATION_SHARE, t: str = "t"):
    """The last ``share`` of the span of training starts ``t`` (row numbers) is the
    validation set: the cut needs the least and the largest ``t`` only."""
    cut = train.agg(F.min(t) + (F.max(t) - F.min(t)) * (1.0 - share)).scalar()
    return train.where(F.col(t) < cut), train.where(F.col(t) >= cut)


def classifier(kind: str = "logistic", n_features: int = 360, seed: int = 7):
    if kind == "logistic":
        est = LogisticRegression(featuresCol="x", labelCol="label", maxIter=50, regParam=0.01)
    elif kind == "gbt":
        est = GBTClassifier(featuresCol="x", labelCol="label", maxIter=30, maxDepth=4, seed=seed)
    elif kind == "mlp":
        est = MultilayerPerceptronClassifier(featuresCol="x", labelCol="label", seed=seed,
                                             layers=[n_features, *MLP_LAYERS, 2], maxIter=100)
    else:
        raise ValueError(kind)
    return Pipeline(stages=[StandardScaler(inputCol="fv", outputCol="x"), est])


def regressor(kind: str = "linear", target: str = "y1"):
    """M3: next-price regression on a normalised target."""
    est = (LinearRegression(featuresCol="x", labelCol=target, regParam=0.01) if kind == "linear"
           else GBTRegressor(featuresCol="x", labelCol=target, maxIter=30, maxDepth=4))
    return Pipeline(stages=[StandardScaler(inputCol="fv", outputCol="x"), est])


def train(samples: DataFrame, kind: str = "logistic") -> tuple[PipelineModel, DataFrame]:
    """M2: fit on train starts minus the validation tail; return the model and
    A17 validation accuracy (one row)."""
    # Iterative training passes over the same rows: written once, so they
    # outlive a lost executor.
    tr = materialize(assemble(samples.where(F.col("split") == "train")))
    fit_part, val_part = time_split(tr)
    model = classifier(kind).fit(fit_part)
    acc = materialize(stats.binary_metrics(model.transform(val_part).withColumn(
        "prediction", F.col("prediction").cast("int"))))
    return model, acc


def score(model: PipelineModel, samples: DataFrame) -> DataFrame:
    """M4 + F24: probability of an up move and the UP/DOWN decision."""
    out = model.transform(assemble(samples, label=None))
    p_up = vector_to_array("probability")[1]
    return out.select("t", "start_ts", "split", p_up.alias("p_up"),
                      num.direction(p_up).alias("direction"), "label")


# --- models that are tables of coefficients ---------------------------------

BIAS = "(intercept)"
COEFFICIENTS = "name string, pos int, weight double"


def least_squares(train: DataFrame, features: Sequence[str], target: str,
                  ridge: float = 0.0) -> DataFrame:
    """M3: linear regression of ``target`` on columns, as a table of coefficients
    ``(name, pos, weight)``; the intercept is :data:`BIAS` at place -1.

    One aggregate gives means and centred cross products (X'X and X'y, built from
    partial sums that stay exact for values far from zero), so only p x p numbers
    reach the driver, which solves for the weights; ``ridge`` is added to the
    diagonal of X'X / n. Rows with a missing feature or target are left out; features
    that add nothing (constant, or a sum of others) get the smallest weights that
    fit; without any row the weights are null.
    """
    cols = [*features, target]
    have = train.where(F.forall(F.array(*[F.col(c).cast("double") for c in cols]),
                                lambda x: x.isNotNull() & ~F.isnan(x)))
    p = len(features)
    means = [F.avg(c) for c in cols]
    cross = [F.covar_pop(cols[i], cols[j]) for i in range(p) for j in range(i, p + 1)]
    got = have.agg(*[m.alias(f"m{i}") for i, m in enumerate(means)],
                   *[c.alias(f"c{i}") for i, c in enumerate(cross)]).first()
    names = [BIAS, *features]
    if got["m0"] is None:
        weights = [None] * (p + 1)
    else:
        xx, xy, k = np.zeros((p, p)), np.zeros(p), p + 1
        for i in range(p):
            for j in range(i, p + 1):
                if j < p:
                    xx[i, j] = xx[j, i] = got[k]
                else:
                    xy[i] = got[k]
                k += 1
        w = np.linalg.lstsq(xx + ridge * np.eye(p), xy, rcond=None)[0]
        weights = [float(got[p] - w @ np.array(got[:p])), *w.tolist()]
    rows = [(n, i - 1, v) for i, (n, v) in enumerate(zip(names, weights))]
    return train.sparkSession.createDataFrame(rows, COEFFICIENTS)


def _number(x: float | None) -> str:
    return f"CAST({'NULL' if x is None else repr(x)} AS DOUBLE)"


def linear_model(coefficients: DataFrame, features: str = "features",
                 kind: str = "logistic") -> PipelineModel:
    """A saveable pipeline from a table of coefficients ``(name, pos, weight)``: the
    product of the array column ``features`` with the weights, in the JVM, as
    ``p_up`` (``logistic``) or ``prediction`` (``linear``). One row per place; places
    beyond an array, null elements and null weights make the score null.
    """
    weights = {r["pos"]: r["weight"] for r in coefficients.collect()}     # p numbers
    bias, width = weights.pop(-1, 0.0), max(weights, default=-1) + 1
    row = ", ".join(_number(weights.get(i, 0.0)) for i in range(width))
    total = f"{_number(bias)}"
    if width:
        total += (f" + aggregate(zip_with(slice({features}, 1, {width}), array({row}), (x, w) -> x * w),"
                  " CAST(0 AS DOUBLE), (s, x) -> s + x)")
    out = f"1 / (1 + exp(-({total}))) AS p_up" if kind == "logistic" else f"{total} AS prediction"
    return PipelineModel(stages=[SQLTransformer(statement=f"SELECT *, {out} FROM __THIS__")])


def score_linear(model: PipelineModel, samples: DataFrame) -> DataFrame:
    """M4 + F24 with a :func:`linear_model`: probability and UP/DOWN decision; samples
    with missing features are left out, as in :func:`score`."""
    ok = F.forall("features", lambda x: x.isNotNull() & ~F.isnan(x))
    out = model.transform(samples.where(ok))
    return out.withColumn("direction", num.direction("p_up"))


def save(model: PipelineModel, path: str) -> None:
    """K5."""
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    """K5."""
    return PipelineModel.load(path)
