"""Samples (W5-W8) against a direct re-implementation of the notebook loop."""

import datetime as dt

import numpy as np
import pytest

from tickwise.operators import samples


def _frame(spark, n, seed=5, zero_volume_at=None):
    rng = np.random.default_rng(seed)
    base = dt.datetime(2024, 1, 1, 23, 0)
    rows = []
    for i in range(n):
        o, h, lo, c = (float(x) for x in rng.uniform(1, 100, 4))
        v = 0.0 if i == zero_volume_at else float(rng.integers(1, 50))
        rows.append((base + dt.timedelta(minutes=3 * i), o, h, lo, c, v, float(rng.normal())))
    df = spark.createDataFrame(rows, "ts timestamp_ntz, Open double, High double, Low double, "
                                     "Close double, Volume double, Sentiment_Value double")
    return df, rows


def _reference(rows, window=60, targets=(1, 10, 30), test=10):
    x = np.array([r[1:] for r in rows], dtype=float)
    n = len(x)
    out = {}

    def sample(t):
        blk = x[t:t + window].copy()
        lc, lv = blk[-1, 3], blk[-1, 4]
        with np.errstate(divide="ignore", invalid="ignore"):
            blk[:, :4] /= lc
            blk[:, 4] /= lv
            blk[:, 5] /= lv
            ys = [x[t + window + k, 3] / lc for k in targets]
        return blk.flatten(), ys

    for t in range(n - window - targets[-1] - test):
        out[t] = ("train",) + sample(t)
    for t in range(n - window - targets[-1] - test, n - window - targets[-1]):
        if t > 0:
            out[t] = ("test",) + sample(t)
    return out


def _clean(v):
    return None if v is None or not np.isfinite(v) else v


@pytest.mark.parametrize("block", [91, 150, 100000])
def test_samples_equal_notebook_loop(spark, block):
    df, rows = _frame(spark, 400, zero_volume_at=250)
    got = {r.t: r for r in samples.build_samples(df.repartition(7), test_starts=40, block=block).collect()}
    want = _reference(rows, test=40)
    assert set(got) == set(want)
    for t, (split, feats, ys) in want.items():
        g = got[t]
        assert g.split == split
        assert [_clean(a) for a in g.features] == pytest.approx([_clean(b) for b in feats], nan_ok=False)
        assert [_clean(g.y1), _clean(g.y10), _clean(g.y30)] == pytest.approx([_clean(y) for y in ys])
        assert g.label == (None if _clean(ys[0]) is None else int(ys[0] > 1))


def test_short_series_gives_no_train_and_skips_t0(spark):
    df, rows = _frame(spark, 95)
    got = samples.build_samples(df, test_starts=10000).collect()
    assert sorted(r.t for r in got) == [1, 2, 3, 4]      # starts 1..n-91, t=0 excluded
    assert {r.split for r in got} == {"test"}
    assert len(got[0].features) == 360
    assert samples.build_samples(_frame(spark, 90)[0]).count() == 0
