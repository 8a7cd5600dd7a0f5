"""Series and statistics operators against pandas / numpy / brute force."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickwise.operators import bars, series as S, stats


def _long(spark, data):
    rows = [(k, d, v) for k, vals in data.items() for d, v in enumerate(vals)]
    return spark.createDataFrame(rows, "coin string, d int, v double")


def test_diff_and_pct_change_match_pandas(spark):
    data = {"a": [1.0, 2.0, None, 4.0, 0.0, 3.0], "b": [5.0], "c": [2.0, 2.0]}
    df = _long(spark, data)
    out = S.pct_change(S.first_diff(df, "v", "d", ["coin"], out="diff"), "v", "d", ["coin"], out="pct")
    got = {(r.coin, r.d): (r.diff, r.pct) for r in out.collect()}
    for k, vals in data.items():
        s = pd.Series(vals, dtype="float64")
        diff = s.diff().fillna(0)
        pct = (s.ffill() / s.ffill().shift(1) - 1).replace([np.inf, -np.inf], np.nan).fillna(0)
        for i in range(len(vals)):
            assert got[(k, i)][0] == pytest.approx(diff[i])
            assert got[(k, i)][1] == pytest.approx(pct[i])


def test_gradient_matches_numpy(spark):
    vals = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "k int, v double")
    got = [r.s for r in S.gradient_dense(df, "k", "v", 1, out="s").orderBy("k").collect()]
    assert got == pytest.approx(list(np.gradient(np.array(vals))))
    two = spark.createDataFrame([(0, 1.0), (1, None), (2, 5.0)], "k int, v double")
    got2 = [r.s for r in S.gradient_dense(two, "k", "v", 1, out="s").orderBy("k").collect()]
    assert got2 == [None, 2.0, None]          # missing neighbours propagate


def test_absmax_normalise_and_extremes(spark):
    df = spark.createDataFrame([(1, -4.0), (2, 2.0), (3, 1.0)], "k int, v double")
    got = [r.v_norm for r in S.absmax_normalise(df, ["v"]).orderBy("k").collect()]
    assert got == [-1.0, 0.5, 0.25]
    e = S.global_extremes(df, "v").first()
    assert (e["max"], e["min"], e["absmax"]) == (2.0, -4.0, 4.0)


def test_dense_hourly_sum_and_mean_fill(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1, 0, 10)
    rows = [(t0, 1.0), (t0 + dt.timedelta(hours=3, minutes=5), 2.0)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, v double")
    s = bars.dense_bucket_agg(df, "ts", "v", "sum", "hour", out="x").orderBy("bucket").collect()
    m = bars.dense_bucket_agg(df, "ts", "v", "mean", "hour", out="x").orderBy("bucket").collect()
    assert [r.x for r in s] == [1.0, 0.0, 0.0, 2.0]
    assert [r.x for r in m] == [1.0, None, None, 2.0]


def test_row_index_is_dense_and_layout_independent(spark):
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(minutes=7 * i),) for i in range(3000)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    for parts in (1, 17):
        out = S.with_row_index(df.repartition(parts), ["ts"], F.to_date("ts"), total="n")
        got = sorted((r.ts, r.idx, r.n) for r in out.collect())
        assert [g[1] for g in got] == list(range(3000))
        assert {g[2] for g in got} == {3000}


def _tau_b(x, y):
    n = len(x)
    s = nx = ny = 0
    for i, j in itertools.combinations(range(n), 2):
        a, b = np.sign(x[i] - x[j]), np.sign(y[i] - y[j])
        s += a * b
        nx += a != 0
        ny += b != 0
    return s / math.sqrt(nx * ny)


@pytest.fixture()
def ranges(spark, request):
    """A number of ranges for the scans (the shuffle partitions)."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(request.param))
    yield request.param
    spark.conf.set(key, before)


@pytest.mark.parametrize("ranges,bucket_rows", [(1, 4096), (8, 4096), (13, 7)], indirect=["ranges"])
def test_correlation_matrices_with_ties(spark, monkeypatch, ranges, bucket_rows):
    monkeypatch.setattr(stats, "BUCKET_ROWS", bucket_rows)        # small: many blocks
    rng = np.random.default_rng(3)
    n = 120
    data = {"a": rng.integers(0, 6, n).astype(float),          # heavy ties
            "b": rng.normal(size=n).round(1),                   # light ties
            "c": rng.integers(0, 40, n).astype(float)}
    long = spark.createDataFrame([(k, d, float(v)) for k, vals in data.items() for d, v in enumerate(vals)],
                                 "coin string, d int, v double")
    pdf = pd.DataFrame(data)
    p = {(r.series_a, r.series_b): r.pearson for r in stats.pearson_matrix(long, "d", "coin", "v").collect()}
    s = {(r.series_a, r.series_b): r.spearman for r in stats.spearman_matrix(long, "d", "coin", "v").collect()}
    k = {(r.series_a, r.series_b): r.kendall for r in stats.kendall_matrix(long, "d", "coin", "v").collect()}
    pc, sc = pdf.corr("pearson"), pdf.corr("spearman")
    for a in data:
        for b in data:
            assert p[(a, b)] == pytest.approx(pc.loc[a, b], abs=1e-12)
            assert s[(a, b)] == pytest.approx(sc.loc[a, b], abs=1e-12)
            want = 1.0 if a == b else _tau_b(data[a], data[b])
            assert k[(a, b)] == pytest.approx(want, abs=1e-12)


def test_best_lag_and_roll(spark):
    y = np.array([0.0, 1.0, 0.0, 0.0, 2.0, 0.0, 0.0, 0.0])
    x = np.roll(y, 2)                                   # x is y delayed by 2
    rows = [("ref", i, float(v)) for i, v in enumerate(y)] + [("x", i, float(v)) for i, v in enumerate(x)]
    ix = spark.createDataFrame(rows, "coin string, idx long, v double")
    lags = {r.series: r for r in S.best_lag(ix, "coin", "v", "ref").collect()}
    z = np.correlate(x, y, "full")
    assert lags["x"].raw_lag == int(np.argmax(z)) and lags["x"].lag == 2
    rolled = S.roll(ix, S.best_lag(ix, "coin", "v", "ref"), "coin", len(y))
    got = [r.v for r in rolled.where("coin = 'x'").orderBy("idx").collect()]
    assert got == list(y)                               # shifted back onto the reference
    raw = S.roll(ix, S.best_lag(ix, "coin", "v", "ref"), "coin", len(y), raw=True)
    got_raw = [r.v for r in raw.where("coin = 'x'").orderBy("idx").collect()]
    assert got_raw == list(np.roll(x, int(np.argmax(z))))


@pytest.mark.parametrize("block", [1024, 8, 1])
def test_lag_products_over_blocks_and_gaps(spark, monkeypatch, block):
    monkeypatch.setattr(S, "LAG_BLOCK", block)
    rng = np.random.default_rng(5)
    n = 50
    there = {"ref": sorted(rng.choice(n, 31, replace=False)), "x": sorted(rng.choice(n, 23, replace=False)),
             "one": [7]}
    rows = [(k, int(i), float(rng.normal())) for k, at in there.items() for i in at] + [("x", 3, None), ("none", 2, None)]
    ix = spark.createDataFrame(rows, "coin string, idx long, v double")
    want: dict = {}
    for k, i, v in rows:
        for k2, j, w in rows:
            if k2 == "ref" and v is not None and w is not None:
                z, c = want.get((k, i - j), (0.0, 0))
                want[(k, i - j)] = (z + v * w, c + 1)
    got = {(r.series, r.lag): (r.z, r.pairs) for r in S.lag_products(ix, "coin", "v", "ref").collect()}
    assert got.keys() == want.keys()
    for k, (z, c) in want.items():
        assert got[k][0] == pytest.approx(z, abs=1e-12) and got[k][1] == c
    best = {r.series: r for r in S.best_lag(ix, "coin", "v", "ref").collect()}
    assert best["x"].lag == max((z, -d) for (k, d), (z, _) in want.items() if k == "x")[1] * -1
    assert best["x"].raw_lag == best["x"].lag + best["x"].n - 1 and "none" not in best
    assert S.best_lag(ix.where("false"), "coin", "v", "ref").count() == 0


def test_shares_topk_dedup_latest_and_max(spark):
    df = spark.createDataFrame([("a", 5.0, 1), ("b", 3.0, 2), ("c", 1.0, 3), ("d", 1.0, 4), ("a", 1.0, 5)],
                               "name string, v double, k int")
    sh = {r.name: r.pct for r in stats.share_of_total(df, "name", "v").collect()}
    assert sh == {"a": 54.5, "b": 27.3, "c": 9.1, "d": 9.1}
    top = {r.name: r.amount for r in stats.top_k_with_other(df, "name", "v", 2).collect()}
    assert top == {"a": 6.0, "b": 3.0, "other": 2.0}
    first = {r.name: r.k for r in stats.dedup_first(df, "name", ["k"]).collect()}
    assert first["a"] == 1
    latest = {r.name: r.v for r in S.latest_per_key(df, "name", "k", ["v"]).collect()}
    assert latest["a"] == 1.0
    ties = spark.createDataFrame([(1, 3.0), (2, 3.0), (3, 1.0)], "k int, v double")
    assert sorted(r.k for r in S.rows_at_max(ties, "v").collect()) == [1, 2]
    counts = stats.count_per_group(spark.createDataFrame(
        [("x", 1, None), ("x", None, "a"), (None, 1, "b")], "g string, a int, b string"), "g").collect()
    assert [(r.g, r.a, r.b) for r in counts] == [("x", 1, 1)]


def test_correlations_are_pairwise_complete(spark):
    import pandas as pd
    a = {d: (d * 7 % 11) / 3 for d in range(40)}
    b = {d: (d * 5 % 13) * 1.0 for d in range(10, 50) if d % 3}
    c = {d: 2.0 for d in range(60)}                                  # constant: null, no error
    long = spark.createDataFrame([(s, d, v) for s, m in (("a", a), ("b", b), ("c", c)) for d, v in m.items()],
                                 "coin string, d int, v double")
    frame = pd.DataFrame({"a": a, "b": b, "c": c})
    for fn, name in ((stats.pearson_matrix, "pearson"), (stats.spearman_matrix, "spearman"),
                     (stats.kendall_matrix, "kendall")):
        want = frame.corr(name) if name != "kendall" else pd.DataFrame(
            {x: {y: 1.0 if x == y else None if "c" in (x, y) else
                 _tau_b(*frame[[x, y]].dropna().to_numpy().T) for y in frame} for x in frame})
        got = {(r.series_a, r.series_b): (r[name], r.n) for r in fn(long, "d", "coin", "v").collect()}
        assert len(got) == 9
        for (x, y), (r, n) in got.items():
            assert n == frame[[x, y]].dropna().shape[0] if x != y else True
            assert (r is None) == pd.isna(want.loc[x, y])
            assert r is None or abs(r - want.loc[x, y]) < 1e-9


# --- long series: scans over ranges, numbers, lags -------------------------

SERIES = "s string, k int, u int, v double, extra string"


def _ticks(seed=3, n=400):
    """Rows of three series (one null) with ties in ``k``, nulls and a hot key."""
    import random
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "a", "b", None]), rng.choice([None, 7, 7, 7, rng.randrange(60)]), i,
             rng.choice([None, 0.0, rng.uniform(1, 9), rng.uniform(1, 9)]), "x") for i in range(n)]
    return rows + [("nulls", i, n + i, None, "x") for i in range(40)]


def _plain_changes(rows, by):
    groups = {}
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        groups.setdefault(r[0] if by else 0, []).append(r)
    out = {}
    for g in groups.values():
        v = pd.Series([r[3] for r in g], dtype="float64")
        ff = v.ffill()
        pct = [(b / a - 1) if a and not math.isnan(a) and not math.isnan(b) else 0.0
               for a, b in zip(ff.shift(1), ff)]
        for r, d, p in zip(g, v.diff().fillna(0), pct):
            out[r[2]] = (pytest.approx(d), pytest.approx(p))
    return out


@pytest.mark.parametrize("by,files", [((), 1), ((), 7), (("s",), 5)])
def test_changes_of_long_series(spark, by, files):
    rows = _ticks()
    df = spark.createDataFrame(rows, SERIES).repartition(files)
    d = S.first_diff(df, "v", ["k", "u"], by, "diff", long=True)
    d = S.pct_change(d, "v", ["k", "u"], by, "pct", long=True)
    assert d.columns == df.columns + ["diff", "pct"]
    got = {r.u: (r["diff"], r.pct) for r in d.collect()}
    assert got == _plain_changes(rows, by)
    empty = df.where("false")
    assert S.pct_change(S.first_diff(empty, "v", "k"), "v", "k").count() == 0


def test_no_range_holds_a_hot_key(spark):
    """A third of the rows equal in every order column still spread over the ranges."""
    from tickwise.operators.order import ranged
    df = spark.range(0, 6000, 1, 6).selectExpr("IF(id % 3 = 0, 5, id) AS k")
    sizes = [r["count"] for r in ranged(df, ["k"]).groupBy("_part").count().collect()]
    assert sum(sizes) == 6000 and max(sizes) < 2 * 6000 / len(sizes) and len(sizes) > 4
    with pytest.raises(ValueError):
        S.first_diff(df, "k", "k", long=False)


@pytest.mark.parametrize("by", [(), ("s",)])
def test_numbers_in_global_order(spark, by):
    from tickwise.operators.order import numbered
    rows = _ticks()
    for files in (1, 6):
        df = spark.createDataFrame(rows, SERIES).repartition(files)
        got = {r.u: r.pos for r in numbered(df, [F.col("k").desc_nulls_last(), "u"], by).collect()}
        groups = {}
        for r in sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[2])):
            groups.setdefault(r[0] if by else 0, []).append(r[2])
        assert got == {u: i for g in groups.values() for i, u in enumerate(g)}
    assert numbered(df.where("false"), ["k"]).count() == 0
    same = spark.createDataFrame([(1,)] * 50, "k int").repartition(4)      # equal rows
    assert sorted(r.pos for r in numbered(same, ["k"]).collect()) == list(range(50))


@pytest.mark.parametrize("max_lag", [0, 3, 8, 40])
def test_lags_in_a_band(spark, monkeypatch, max_lag):
    monkeypatch.setattr(S, "LAG_BLOCK", 8)
    monkeypatch.setattr(S, "LAG_BINS", 3)
    import random
    rng = random.Random(4)
    rows = [(c, i, rng.uniform(-1, 1)) for c in ("ref", "x", "far") for i in range(70)
            if rng.random() < 0.7 and (c != "far" or i > 50)] + [("x", 5, None), ("x", None, 1.0)]
    df = spark.createDataFrame(rows, "coin string, idx long, v double")
    got = {(r.series, r.lag): (r.z, r.pairs)
           for r in S.lag_products(df, "coin", "v", "ref", max_lag=max_lag).collect()}
    want = {}
    for c, i, v in rows:
        for _, j, w in (r for r in rows if r[0] == "ref"):
            if None not in (i, v, j, w) and abs(i - j) <= max_lag:
                z, n = want.get((c, i - j), (0.0, 0))
                want[c, i - j] = (z + v * w, n + 1)
    assert got == {k: (pytest.approx(z), n) for k, (z, n) in want.items()}
