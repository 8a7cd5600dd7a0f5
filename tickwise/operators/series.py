"""Series operators over long tables ``(series key, order key, value)``.

Series are never one frame per name: every operator takes a long table and a
``by`` list, so many series are processed in one job. Windows are always
partitioned by the series key; a very long series, or a whole table as one, is
scanned range by range (:mod:`tickwise.operators.order`), numbered by
:func:`with_row_index` and shifted by equi-joins on the index.
"""

from __future__ import annotations

import sys

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.operators.order import with_previous
from tickwise.session import written

# Python functions of this module run inside tasks: ship them by value so
# workers need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _w(by: Sequence[str], order) -> Window:
    """A window over one series; a whole table is never one window."""
    if not by:
        raise ValueError("name the series, or use the scan over ranges")
    return Window.partitionBy(*by).orderBy(order)


def _is_long(by: Sequence[str], long: bool | None) -> bool:
    return not by if long is None else long


def changes(df: DataFrame, value: str, order: str | Sequence[str], by: Sequence[str] = (),
            diff: str | None = None, pct: str | None = None) -> DataFrame:
    """W1 (column ``diff``) and W2 (column ``pct``) of long series in one scan over
    ranges: no task holds a series (:func:`tickwise.operators.order.with_previous`)."""
    d = with_previous(df, value, _listed(order), by, "_prev", "_ff", "_ffp")
    if diff:
        d = d.withColumn(diff, F.coalesce(F.col(value) - F.col("_prev"), F.lit(0.0)))
    if pct:
        change = F.try_divide(F.col("_ff"), F.col("_ffp")) - F.lit(1.0)
        d = d.withColumn(pct, F.coalesce(change, F.lit(0.0)))
    return d.drop("_prev", "_ff", "_ffp")


def first_diff(df: DataFrame, value: str, order: str | Sequence[str], by: Sequence[str] = (),
               out: str | None = None, long: bool | None = None) -> DataFrame:
    """``v - previous v``; first row and missing neighbours give 0.

    ``long`` series (the default without ``by``) are scanned range by range
    (:func:`changes`); otherwise each series is sorted in one task (a row per day,
    say). Rows equal in ``order`` have no stated order; give several columns to fix it.
    """
    out = out or f"{value}_diff"
    if _is_long(by, long):
        return changes(df, value, order, by, diff=out)
    w = _w(by, _listed(order))
    return df.withColumn(out, F.coalesce(F.col(value) - F.lag(value).over(w), F.lit(0.0)))


def pct_change(df: DataFrame, value: str, order: str | Sequence[str], by: Sequence[str] = (),
               out: str | None = None, long: bool | None = None) -> DataFrame:
    """Percent change on the forward-filled value; missing -> 0.

    A zero previous value yields 0 here (pandas gives inf). ``long`` as in
    :func:`first_diff`.
    """
    out = out or f"{value}_pct"
    if _is_long(by, long):
        return changes(df, value, order, by, pct=out)
    w = _w(by, _listed(order))
    filled = F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    d = df.withColumn("_ff", filled)
    pct = F.try_divide(F.col("_ff"), F.lag("_ff").over(w)) - F.lit(1.0)
    return d.withColumn(out, F.coalesce(pct, F.lit(0.0))).drop("_ff")


def _listed(order) -> list:
    return list(order) if isinstance(order, (list, tuple)) else [order]


def gradient_dense(df: DataFrame, key: str, value: str, step, by: Sequence[str] = (),
                   out: str | None = None) -> DataFrame:
    """``numpy.gradient`` with unit spacing over a gap-free series.

    Neighbours are fetched by equi-joins on ``key +/- step`` (hash-partitioned
    on the key, so no single task sees the whole series). Interior rows give
    ``(next - prev) / 2``, the ends are one-sided and a missing neighbour
    value propagates as null. ``step`` is a Column-compatible interval or
    number.
    """
    by = list(by)
    k = F.col(key)
    step_c = step if isinstance(step, Column) else F.lit(step)
    prev = df.select(*by, (k + step_c).alias(key), F.col(value).alias("_prev"),
                     F.lit(True).alias("_hp"))
    nxt = df.select(*by, (k - step_c).alias(key), F.col(value).alias("_next"),
                    F.lit(True).alias("_hn"))
    j = df.join(prev, [*by, key], "left").join(nxt, [*by, key], "left")
    v, p, n = F.col(value), F.col("_prev"), F.col("_next")
    hp, hn = F.col("_hp").isNotNull(), F.col("_hn").isNotNull()
    slope = (F.when(hp & hn, (n - p) / 2.0)
             .when(hn, n - v)
             .when(hp, v - p))
    return j.withColumn(out or f"{value}_slope", slope).drop("_prev", "_next", "_hp", "_hn")


def absmax_normalise(df: DataFrame, values: Sequence[str], by: Sequence[str] = (),
                     suffix: str = "_norm") -> DataFrame:
    """W4 (with A10): divide by ``max(max(v), |min(v)|)`` of the series.

    Without ``by`` the scale is a scalar subquery (one number, no join);
    with ``by`` it is a per-series aggregate joined back (one row per series).
    """
    def scale(c):
        return F.greatest(F.max(c), F.abs(F.min(c)))
    if not by:
        s = df.agg(*[scale(c).alias(c) for c in values])
        return df.select("*", *[F.try_divide(F.col(c), s.select(c).scalar()).alias(c + suffix)
                                for c in values])
    s = df.groupBy(*by).agg(*[scale(c).alias(f"_s_{c}") for c in values])
    out = df.join(s, list(by), "left")
    for c in values:
        out = out.withColumn(c + suffix, F.try_divide(F.col(c), F.col(f"_s_{c}")))
    return out.drop(*[f"_s_{c}" for c in values])


def global_extremes(df: DataFrame, value: str) -> DataFrame:
    """A10: one row with max, min and abs-max."""
    return df.agg(F.max(value).alias("max"), F.min(value).alias("min"),
                  F.greatest(F.max(value), F.abs(F.min(value))).alias("absmax"))


def last_n(df: DataFrame, n: int, order: str, by: Sequence[str] = ()) -> DataFrame:
    """The last ``n`` rows of every series (a top-k, so the limit is the feature)."""
    if not by:
        return df.orderBy(F.col(order).desc()).limit(n)
    w = _w(by, F.col(order).desc())
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def rows_at_max(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Every row attaining the maximum (ties kept), per series or global."""
    if not by:
        return df.where(F.col(value) == df.agg(F.max(value)).scalar())
    # Per-key maxima by a partial aggregate, joined back on (key, max): no
    # window holds a hot key's rows in one task; AQE broadcasts the maxima
    # when they turn out small and splits skewed join partitions otherwise.
    m = df.groupBy(*by).agg(F.max(value).alias("_m"))
    return df.join(m, [*by], "inner").where(F.col(value) == F.col("_m")).drop("_m")


def latest_per_key(df: DataFrame, key: str, order: str, fields: Sequence[str]) -> DataFrame:
    """The latest row's ``fields`` per key (``max_by``; partial aggregate, no sort)."""
    s = F.max_by(F.struct(*[F.col(f) for f in fields]), F.col(order)).alias("_l")
    return df.groupBy(key).agg(F.max(order).alias(order), s).select(key, order, "_l.*")


def with_row_index(df: DataFrame, order: Sequence[str], bucket: Column,
                   idx: str = "idx", total: str | None = None) -> DataFrame:
    """Dense 0-based index in ``order`` without a one-partition window.

    ``bucket`` must be monotone in ``order`` (e.g. the day of a timestamp)
    and bounded in size, because each bucket's rows are numbered in one task:
    the day of a minute series holds at most 1,440 rows. Rows are numbered
    inside each bucket; bucket offsets come from a table
    with one row per bucket (bounded by the time span). The result only depends on the data, not on partitioning, so a recomputed
    task after executor loss yields the same numbers.
    """
    d = df.withColumn("_b", bucket)
    counts = d.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
                         F.sum("_n").over(Window.partitionBy()).alias("_total"))
    w = Window.partitionBy("_b").orderBy(*order)
    out = (d.join(offs, "_b")
           .withColumn(idx, F.row_number().over(w) - 1 + F.col("_off")))
    if total:
        out = out.withColumnRenamed("_total", total)
    return out.drop("_b", "_off", "_n", "_total")


# --- cross-correlation lag (W10-W12) --------------------------------------

LAG_BLOCK = 1024        # steps of the index in one block of a series
LAG_BINS = 64           # frequencies that one task of the second transform holds

_SPECTRUM = "series string, block long, part int, z binary, h binary"


def _block_spectra(length: int) -> Callable:
    """Blocks of a series to their spectra: values and presence, each padded with
    zeros to twice the length, cut into parts of :data:`LAG_BINS` frequencies."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                dense, there = np.zeros(2 * length), np.zeros(2 * length)
                dense[np.asarray(r.at)], there[np.asarray(r.at)] = r.v, 1.0
                z, h = np.fft.rfft(dense), np.fft.rfft(there)
                out += [(r.series, r.block, p, z[s:s + LAG_BINS].tobytes(), h[s:s + LAG_BINS].tobytes())
                        for p, s in enumerate(range(0, len(z), LAG_BINS))]
            yield pd.DataFrame(out, columns=["series", "block", "part", "z", "h"])
    return run


def _rows(pdf: pd.DataFrame, name: str, first: int, size: int) -> np.ndarray:
    """Spectra of a series as a matrix, one row per block (zeros where it has none)."""
    bins = [np.frombuffer(b, dtype="complex128") for b in pdf[name]]
    out = np.zeros((size, len(bins[0])), dtype="complex128")
    out[pdf["block"].to_numpy() - first] = bins
    return out


def _across_blocks(length: int, max_lag: int | None) -> Callable:
    """Second transform, along the blocks: for some frequencies, the spectrum of the
    products on every block diagonal, of a series against the reference."""
    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame(columns=["series", "block", "part", "z", "h"])
        a0, b0 = int(a["block"].min()), int(b["ref_block"].min())
        na, nb = int(a["block"].max()) - a0 + 1, int(b["ref_block"].max()) - b0 + 1
        b = b.rename(columns={"ref_block": "block", "ref_z": "z", "ref_h": "h"})
        size = na + nb - 1
        # diagonal d: block of the series minus block of the reference
        diagonals = np.arange(size) - (nb - 1) + (a0 - b0)
        if max_lag is not None:
            diagonals = diagonals[np.abs(diagonals) <= max_lag // length + 1]
        both = []
        for name in ("z", "h"):
            x = np.fft.fft(_rows(a, name, a0, na), size, axis=0)
            y = np.fft.fft(_rows(b, name, b0, nb), size, axis=0)
            both.append(np.fft.ifft(x * np.conj(y), axis=0)[(diagonals - (a0 - b0)) % size])
        return pd.DataFrame({"series": a["series"].iloc[0], "block": diagonals.astype("int64"),
                             "part": a["part"].iloc[0], "z": [r.tobytes() for r in both[0]],
                             "h": [r.tobytes() for r in both[1]]})
    return run


def _diagonal_lags(length: int, max_lag: int | None) -> Callable:
    """All parts of one diagonal back to sums by lag. The blocks overlap: a lag has
    a share in two diagonals, which are added up afterwards."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        z, h = (np.fft.irfft(np.concatenate([np.frombuffer(b, dtype="complex128") for b in pdf[c]]),
                             2 * length) for c in ("z", "h"))
        lag = np.arange(2 * length)
        lag = np.where(lag < length, lag, lag - 2 * length) + int(pdf["block"].iloc[0]) * length
        pairs = np.rint(h).astype("int64")
        keep = pairs > 0
        if max_lag is not None:
            keep &= np.abs(lag) <= max_lag
        return pd.DataFrame({"series": pdf["series"].iloc[0], "lag": lag[keep], "z": z[keep],
                             "pairs": pairs[keep]})
    return run


def lag_products(indexed: DataFrame, series: str, value: str, reference: str,
                 max_lag: int | None = None) -> DataFrame:
    """``(series, lag, z, pairs)`` for every lag (of at most ``max_lag`` steps
    either way, if given) at which a series and the reference have rows ``lag``
    steps apart: the sum of products and their number.

    A transform in two steps, O(n log n) however many lags are asked for. Series are
    cut into blocks of ``LAG_BLOCK`` steps; each block is transformed padded with
    zeros; for each few frequencies a second transform along the blocks multiplies a
    series with the reference on all block diagonals at once; each diagonal is
    transformed back and its sums are added by lag. A task holds a block, a
    diagonal, or one number per block for :data:`LAG_BINS` frequencies, never a
    series. With ``max_lag`` only the diagonals that reach it are kept.
    """
    # functions are shipped by value with the block length in force
    length = LAG_BLOCK
    b = (indexed.where(F.col(value).isNotNull() & F.col("idx").isNotNull())
         .select(F.col(series).alias("series"), F.floor(F.col("idx") / length).alias("block"),
                 F.pmod("idx", F.lit(length)).cast("int").alias("at"),
                 F.col(value).cast("double").alias("v"))
         .groupBy("series", "block").agg(F.collect_list(F.struct("at", "v")).alias("r"))
         .select("series", "block", F.col("r.at").alias("at"), F.col("r.v").alias("v")))
    spectra = written(b.mapInPandas(_block_spectra(length), _SPECTRUM), "lag-spectra")
    ref = spectra.where(F.col("series") == reference).select(
        F.col("part").alias("ref_part"), F.col("block").alias("ref_block"), F.col("z").alias("ref_z"),
        F.col("h").alias("ref_h"))
    keys = spectra.select(F.col("series").alias("to"), F.col("part").alias("ref_part")).distinct()
    met = (spectra.groupBy("series", "part")
           .cogroup(ref.join(keys, "ref_part").groupBy("to", "ref_part"))
           .applyInPandas(_across_blocks(length, max_lag), _SPECTRUM))
    lags = met.groupBy("series", "block").applyInPandas(
        _diagonal_lags(length, max_lag), "series string, lag long, z double, pairs long")
    return lags.groupBy("series", "lag").agg(F.sum("z").alias("z"), F.sum("pairs").alias("pairs"))


def best_lag(indexed: DataFrame, series: str, value: str, reference: str) -> DataFrame:
    """W10 + W11: ``(series, n, raw_lag, lag, xcorr_max)``, per series the lag that
    maximises the cross-correlation with ``reference`` (first on ties).

    Input: ``(series, idx, value)``; ``idx`` counts steps (days) from 0 and may
    have gaps. ``n`` is the span of ``idx`` over all series, and ``raw_lag`` the
    place among its 2n-1 lags.
    """
    n = indexed.agg((F.max("idx") + 1).cast("long")).scalar()
    top = lag_products(indexed, series, value, reference).groupBy("series").agg(
        F.max(F.struct("z", (-F.col("lag")).alias("back"))).alias("m"))
    return top.select("series", n.alias("n"), (n - 1 - F.col("m.back")).alias("raw_lag"),
                      (-F.col("m.back")).alias("lag"), F.col("m.z").alias("xcorr_max"))


def roll(indexed: DataFrame, lags: DataFrame, series: str, n: int | Column,
         raw: bool = False) -> DataFrame:
    """Circular shift of each series by its lag.

    Default shifts by ``-lag`` (aligns the series to the reference);
    ``raw=True`` rolls by the raw argmax index, as the original notebook did.
    """
    shift = F.col("raw_lag") if raw else -F.col("lag")
    n_c = n if isinstance(n, Column) else F.lit(n)
    j = indexed.join(lags.select(F.col("series").alias(series), "raw_lag", "lag"), series)
    return j.withColumn("idx", F.pmod(F.col("idx") + shift, n_c)).drop("raw_lag", "lag")
