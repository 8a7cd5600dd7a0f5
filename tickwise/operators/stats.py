"""Statistics: category counts and shares, dedup, correlation matrices, metrics.

Correlation matrices take a long table ``(key, series, value)`` and are pairwise
complete: two series are compared over the keys that both have. Kendall's tau-b
counts discordant pairs by bit levels of the y rank (O(n log n) rows per pair of
series) instead of comparing all n^2 row pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwise.operators.order import prefix_sums
from tickwise.session import materialize


def count_per_group(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Non-null count of every other column per group (null keys excluded)."""
    cols = [c for c in (columns or df.columns) if c != key]
    return (df.where(F.col(key).isNotNull()).groupBy(key)
            .agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in cols]))


def share_of_total(df: DataFrame, label: str, value: str | None = None,
                   digits: int = 1) -> DataFrame:
    """Percent of the total per label (``autopct`` with one decimal).

    ``value=None`` counts rows. The total is a one-number subquery over the
    grouped table, which is written once, so the input is aggregated once.
    """
    agg = F.count(F.lit(1)) if value is None else F.sum(value)
    # The null-label group is removed only after the aggregate: a filter on a
    # derived label placed before it would be pushed into the projection that
    # computes the label and evaluate it twice.
    g = materialize(df.groupBy(label).agg(agg.cast("double").alias("amount")))
    known = F.col(label).isNotNull()
    total = g.agg(F.sum(F.when(known, F.col("amount")))).scalar()
    return (g.select(label, "amount",
                     F.round(F.try_divide(F.col("amount") * 100.0, total), digits).alias("pct"))
            .where(known))


def top_k_with_other(df: DataFrame, label: str, value: str, k: int,
                     other: str = "other") -> DataFrame:
    """Keep the ``k`` largest labels (ties broken by label), sum the rest.

    The top ``k`` come from a distributed ordered limit over the grouped table,
    which is written once.
    """
    g = materialize(df.groupBy(label).agg(F.sum(value).alias("amount")))
    top = (g.orderBy(F.col("amount").desc(), F.col(label).desc()).limit(k)
           .select(F.col(label).alias("_top"), F.lit(True).alias("_in")))
    r = g.join(top, F.col(label).eqNullSafe(F.col("_top")), "left")
    lab = F.when(F.col("_in"), F.col(label)).otherwise(F.lit(other))
    return r.groupBy(lab.alias(label)).agg(F.sum("amount").alias("amount"))


def dedup_first(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key, the first by ``order`` (deterministic when
    ``order`` is unique within a key).

    ``min_by`` is a partial aggregate: each task keeps one candidate per key
    before the shuffle, so a key repeated across a third of the table costs
    one row per task, not one sorted group in one task.
    """
    rest = [c for c in df.columns if c != key]
    best = F.min_by(F.struct(*[F.col(f"`{c}`") for c in rest]),
                    F.struct(*[F.col(f"`{c}`") for c in order]))
    return df.groupBy(key).agg(best.alias("_first")).select(key, "_first.*").select(*df.columns)


# --- correlation matrices ----------------------------------------------------

def shared_pairs(long: DataFrame, key: str, series: str, value: str) -> DataFrame:
    """J3 by pairs: ``(series_a, series_b, x, y)`` for each unordered pair of
    series (a series with itself too) and each key that both have a value at."""
    v = long.where(F.col(value).isNotNull())
    a = v.select(F.col(key).alias("_key"), F.col(series).alias("series_a"), F.col(value).alias("x"))
    b = v.select(F.col(key).alias("_key"), F.col(series).alias("series_b"), F.col(value).alias("y"))
    return a.join(b, "_key").where(F.col("series_a") <= F.col("series_b")).drop("_key")


def _coefficients(pairs: DataFrame, name: str) -> DataFrame:
    """Correlation and shared keys per pair, both orders; null where either side
    is constant. Partial sums per pair, so a task sends one row per pair."""
    spread = F.stddev_pop("x") * F.stddev_pop("y")
    g = pairs.groupBy("series_a", "series_b").agg(
        F.try_divide(F.covar_pop("x", "y"), spread).alias("r"), F.count(F.lit(1)).alias("n"))
    return _both_orders(g, name)


def _both_orders(g: DataFrame, name: str) -> DataFrame:
    """``(series_a, series_b, name, n)`` of both orders from ``r`` of one order; a
    series with itself has 1 (or null, where it is constant)."""
    own = (F.col("series_a") == F.col("series_b")) & F.col("r").isNotNull()
    half = g.select("series_a", "series_b", F.when(own, F.lit(1.0)).otherwise(F.col("r")).alias(name), "n")
    return half.unionByName(half.where("series_a <> series_b").select(
        F.col("series_b").alias("series_a"), F.col("series_a").alias("series_b"), name, "n"))


def pearson_matrix(long: DataFrame, key: str, series: str, value: str) -> DataFrame:
    """``(series_a, series_b, pearson, n)`` for every ordered pair, over the
    ``n`` keys that the two series share (as pandas ``corr`` takes them)."""
    return _coefficients(shared_pairs(long, key, series, value), "pearson")


# Dense ranks are cut into blocks of this many.
BUCKET_ROWS = 4096


def _running(c: DataFrame, by: Sequence[str], bucket: str, order: str, sums: dict[str, str]) -> DataFrame:
    """Adds, per group, the sum of each column (``sums``: column -> output) over
    the rows of a smaller ``order``. Rows are summed per bucket (``bucket`` rises
    with ``order``), buckets are offset, and the windows run inside one bucket."""
    by = list(by)
    per = c.groupBy(*by, bucket).agg(*[F.sum(k).alias(f"_b_{k}") for k in sums])
    before = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*by, bucket, *[F.coalesce(F.sum(f"_b_{k}").over(before), F.lit(0)).alias(f"_o_{k}")
                                    for k in sums])
    w = Window.partitionBy(*by, bucket).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return c.join(per, [*by, bucket]).select(*c.columns, *[
        (F.col(f"_o_{k}") + F.coalesce(F.sum(k).over(w), F.lit(0))).alias(out) for k, out in sums.items()])


def value_ranks(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """One row per ``(by, distinct value)``: ``ties`` (rows with that value),
    ``n_below`` (rows with a smaller value) and ``dense`` (0-based dense rank).

    Works on distinct values (a value repeated across a third of the rows is
    one row after a partial aggregate), ranked by a scan over ranges
    (:func:`tickwise.operators.order.prefix_sums`): no task holds a series, however
    many values it has.
    """
    c = (df.where(F.col(value).isNotNull()).groupBy(*by, value)
         .agg(F.count(F.lit(1)).alias("ties")).withColumn("_one", F.lit(1)))
    return prefix_sums(c, [value], list(by), {"ties": "n_below", "_one": "dense"}).drop("_one")


def ranked(long: DataFrame, series: str, value: str) -> DataFrame:
    """The rows with a value, which is replaced by its dense rank in the series.
    Every order statistic of pairs can be read off these ranks, so a series is
    ranked once, not once for each partner."""
    v = long.where(F.col(value).isNotNull())
    r = value_ranks(v, [series], value).select(series, value, F.col("dense").alias("_r"))
    return v.join(r, [series, value]).drop(value).withColumnRenamed("_r", value)


def _average_ranks(cells: DataFrame, by: list[str], col: str) -> DataFrame:
    """Per pair the average rank of each distinct ``col`` (a dense rank) of weighted cells."""
    c = cells.groupBy(*by, col).agg(F.sum("cnt").alias("t"))
    c = c.withColumn("_b", F.floor(F.col(col) / BUCKET_ROWS))
    r = _running(c, by, "_b", col, {"t": "below"})
    return r.select(*by, col, (F.col("below") + (F.col("t") + 1) / 2.0).alias(f"{col}r"))


_PAIR = ["series_a", "series_b"]


def _cells(long: DataFrame, key: str, series: str, value: str) -> DataFrame:
    """Distinct rank pairs ``(x, y)`` of each pair of series with their counts:
    every later step reads them, so they are computed once and written."""
    pairs = shared_pairs(ranked(long, series, value), key, series, value)
    return materialize(pairs.groupBy(*_PAIR, "x", "y").agg(F.count(F.lit(1)).alias("cnt")))


def spearman_matrix(long: DataFrame, key: str, series: str, value: str) -> DataFrame:
    """Pearson of average ranks, ranked for each pair over its shared keys."""
    cells = _cells(long, key, series, value)
    n = cells.groupBy(*_PAIR).agg(F.sum("cnt").alias("n"))
    both = cells.join(n, _PAIR)
    for c in ("x", "y"):
        both = both.join(_average_ranks(cells, _PAIR, c), [*_PAIR, c])
    # the mean of average ranks is (n + 1) / 2 on both sides
    x, y = (F.col(c) - (F.col("n") + 1) / 2.0 for c in ("xr", "yr"))
    g = both.groupBy(*_PAIR).agg(
        F.max("n").alias("n"), F.sum(F.col("cnt") * x * y).alias("sxy"),
        F.sum(F.col("cnt") * x * x).alias("sxx"), F.sum(F.col("cnt") * y * y).alias("syy"))
    r = F.try_divide(F.col("sxy"), F.sqrt(F.col("sxx") * F.col("syy")))
    return _both_orders(g.select(*_PAIR, r.alias("r"), "n"), "spearman")


def _ties(cells: DataFrame, cols: list[str], name: str) -> DataFrame:
    """Tied pairs ``sum t(t-1)/2`` over groups of equal ``cols`` (from weighted cells)."""
    t = cells.groupBy(*_PAIR, *cols).agg(F.sum("cnt").alias("t")) if cols else cells.withColumnRenamed("cnt", "t")
    return t.groupBy(*_PAIR).agg(F.sum(F.col("t") * (F.col("t") - 1) / 2).alias(name),
                                 F.sum("t").alias("n"))


def kendall_matrix(long: DataFrame, key: str, series: str, value: str) -> DataFrame:
    """Kendall tau-b ``(series_a, series_b, kendall, n)`` for every ordered
    pair of series over the ``n`` keys that both have; 1 for a series with itself.

    Per pair with rows (x, y), the strictly discordant pairs are
    ``D = sum_j #{i : x_i < x_j and y_i > y_j}``. With y a dense rank, such a
    pair first differs at some bit ``l`` of y where i has 1 and j has 0 and the
    higher bits (the prefix) agree. So per bit level and prefix, D adds
    ``c0(x) * (ones at smaller x)``, a running count over distinct x. Rows are
    first reduced to distinct ``(x, y)`` with counts (hot values collapse), and
    the running count is a prefix sum over blocks of x ranks, so no window holds
    a whole pair. O(n log n) rows instead of n^2 row pairs. Then
    ``tau_b = (C - D) / sqrt((n0 - Tx)(n0 - Ty))`` with
    ``C = n0 - Tx - Ty + Txy - D`` and tie counts from group-bys.
    """
    every = _cells(long, key, series, value)
    cells = every.where("series_a <> series_b")
    tx = _ties(cells, ["x"], "tx")
    ty = _ties(cells, ["y"], "ty").drop("n")
    txy = _ties(cells, [], "txy").drop("n")

    bits = cells.groupBy(*_PAIR).agg(
        F.greatest(F.ceil(F.log2(F.max("y") + 1)).cast("int"), F.lit(1)).alias("bits"))
    lv = cells.join(bits, _PAIR).select(
        *_PAIR, "x", "y", "cnt", F.floor(F.col("x") / BUCKET_ROWS).alias("xb"),
        F.explode(F.sequence(F.lit(0), F.col("bits") - 1)).alias("l"))
    lv = (lv.select(*_PAIR, "x", "xb", "cnt", "l", F.expr("shiftright(y, l + 1)").alias("prefix"),
                    F.expr("shiftright(y, l) & 1").alias("b"))
          .groupBy(*_PAIR, "l", "prefix", "xb", "x")
          .agg(F.sum(F.when(F.col("b") == 1, F.col("cnt")).otherwise(0)).alias("c1"),
               F.sum(F.when(F.col("b") == 0, F.col("cnt")).otherwise(0)).alias("c0")))
    disc = (_running(lv, [*_PAIR, "l", "prefix"], "xb", "x", {"c1": "ones"})
            .groupBy(*_PAIR).agg(F.sum(F.col("c0") * F.col("ones")).cast("double").alias("d")))

    t = tx.join(ty, _PAIR).join(txy, _PAIR).join(disc, _PAIR, "left")
    n0 = F.col("n") * (F.col("n") - 1) / 2
    d = F.coalesce(F.col("d"), F.lit(0.0))
    c = n0 - F.col("tx") - F.col("ty") + F.col("txy") - d
    tau = F.try_divide(c - d, F.sqrt((n0 - F.col("tx")) * (n0 - F.col("ty"))))
    own = every.where("series_a = series_b").groupBy(*_PAIR).agg(F.sum("cnt").alias("n"))
    return _both_orders(t.select(*_PAIR, tau.alias("r"), "n").unionByName(
        own.select(*_PAIR, F.lit(1.0).alias("r"), "n")), "kendall")


# --- model metrics (A17) ----------------------------------------------------

def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy of a 0/1 prediction."""
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"),
                  F.count(F.lit(1)).alias("n"))


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """MAE and MSE."""
    e = F.col(prediction) - F.col(label)
    return df.agg(F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"), F.count(F.lit(1)).alias("n"))


def prediction_metrics(df: DataFrame, label: str, decision: str, target: str, prediction: str) -> DataFrame:
    """A17 of a 0/1 decision and of a predicted value in one aggregate."""
    e = F.col(prediction) - F.col(target)
    return df.agg(F.avg((F.col(label) == F.col(decision)).cast("double")).alias("accuracy"),
                  F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"))
