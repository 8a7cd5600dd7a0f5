"""Named queries over daily coin histories (orders adapter)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickwise.functions import numeric as num
from tickwise.functions import timefmt as tf
from tickwise.operators import filters, series as S, stats
from tickwise.plans.common import finish
from tickwise.session import materialize
from tickwise.sources import tables

# Fixed parameters of the registered queries.
REFERENCE_COIN = "1-URGENT"     # the series every other one is lagged against
SPLIT_DATE = "1998-01-01"       # P16 before/after split
PICK_COIN = "3-MEDIUM"          # P17 single-coin history
PICK_START, PICK_END = "1996-03-01", "1997-03-01"
SHARE_DATE = "1998-08-02"       # A11/A12 market-share snapshot
TOP_K = 3

# --- oracle building blocks --------------------------------------------------
HIST = """hist AS (
  SELECT o_orderpriority AS coin, CAST(o_orderdate AS DATE) AS date,
         arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
         min(o_totalprice) AS low, avg(o_totalprice) AS close,
         count(*) AS volume, sum(o_totalprice) AS market_cap
  FROM orders GROUP BY 1, 2)"""
PCT = """pct AS (
  SELECT coin, date, close,
    coalesce(ff / nullif(lag(ff) OVER (PARTITION BY coin ORDER BY date), 0) - 1, 0) AS pct
  FROM (SELECT *, last_value(close IGNORE NULLS) OVER (PARTITION BY coin ORDER BY date
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ff FROM hist) h)"""
INDEXED = """idxd AS (
  SELECT coin, date, pct, CAST(date - (SELECT min(date) FROM pct) AS BIGINT) AS idx FROM pct)"""
LAGS = f"""xc AS (
  SELECT a.coin, a.idx - b.idx AS d, sum(a.pct * b.pct) AS z
  FROM idxd a JOIN idxd b ON b.coin = '{REFERENCE_COIN}' GROUP BY 1, 2),
nn AS (SELECT max(idx) + 1 AS n FROM idxd),
best AS (
  SELECT coin AS series, n, d + n - 1 AS raw_lag, d AS lag, z AS xcorr_max FROM (
    SELECT xc.*, row_number() OVER (PARTITION BY coin ORDER BY z DESC, d) AS rn FROM xc) x, nn
  WHERE rn = 1),
rolled AS (
  SELECT i.coin, ((i.idx - b.lag) % b.n + b.n) % b.n AS idx, i.pct
  FROM idxd i JOIN best b ON b.series = i.coin)"""


def pearson_sql(src: str, key: str, val: str) -> str:
    """Pairwise-complete: each pair over the keys that both have."""
    return f"""SELECT a.coin AS series_a, b.coin AS series_b,
  round(CASE WHEN a.coin <> b.coin THEN corr(a.{val}, b.{val})
             WHEN var_pop(a.{val}) > 0 THEN 1.0 END, 6) AS pearson, count(*) AS n
FROM {src} a JOIN {src} b USING ({key}) WHERE a.{val} IS NOT NULL AND b.{val} IS NOT NULL
GROUP BY 1, 2"""


def spearman_sql(src: str, key: str, val: str) -> str:
    return f"""SELECT sa AS series_a, sb AS series_b,
  round(CASE WHEN sa <> sb THEN corr(rx, ry) WHEN var_pop(rx) > 0 THEN 1.0 END, 6) AS spearman,
  count(*) AS n
FROM (SELECT sa, sb,
    rank() OVER (PARTITION BY sa, sb ORDER BY x) + (count(*) OVER (PARTITION BY sa, sb, x) - 1) / 2.0 AS rx,
    rank() OVER (PARTITION BY sa, sb ORDER BY y) + (count(*) OVER (PARTITION BY sa, sb, y) - 1) / 2.0 AS ry
  FROM (SELECT a.coin AS sa, b.coin AS sb, a.{val} AS x, b.{val} AS y
        FROM {src} a JOIN {src} b USING ({key})
        WHERE a.{val} IS NOT NULL AND b.{val} IS NOT NULL) p) r
GROUP BY 1, 2"""


def kendall_sql(src: str, key: str, val: str) -> str:
    """Tau-b by all row pairs of each pair of series."""
    return f"""SELECT sa AS series_a, sb AS series_b, round(CASE WHEN sa = sb THEN 1.0 ELSE tau END, 6) AS kendall, n
FROM (SELECT a.coin AS sa, b.coin AS sb, count(*) AS n
      FROM {src} a JOIN {src} b USING ({key}) GROUP BY 1, 2) c
LEFT JOIN (
  SELECT a1.coin AS sa, b1.coin AS sb,
    sum(sign(a1.{val} - a2.{val}) * sign(b1.{val} - b2.{val}))
    / nullif(sqrt(sum(CASE WHEN a1.{val} <> a2.{val} THEN 1 ELSE 0 END)::DOUBLE
         * sum(CASE WHEN b1.{val} <> b2.{val} THEN 1 ELSE 0 END)), 0) AS tau
  FROM {src} a1 JOIN {src} b1 ON a1.{key} = b1.{key}
  JOIN {src} a2 ON a2.coin = a1.coin AND a2.{key} > a1.{key}
  JOIN {src} b2 ON b2.coin = b1.coin AND b2.{key} = a2.{key}
  GROUP BY 1, 2) t USING (sa, sb)"""


# --- Spark side --------------------------------------------------------------

def _pct(spark, sf_dir):
    h = tables.daily_history(spark, sf_dir)
    return S.pct_change(h, "close", "date", ["coin"], out="pct")


def _daily(spark, sf_dir, *columns):
    """Columns of the daily histories, written once for queries that read them twice."""
    return materialize(tables.daily_history(spark, sf_dir).select("coin", "date", *columns))


def _pct_written(spark, sf_dir):
    """The daily pct series, written once for the matrix jobs."""
    return materialize(_pct(spark, sf_dir).select("coin", "date", "pct"))


def _indexed(spark, sf_dir):
    """The daily pct series with the day's number since the first day of all
    series as index, written once: the lag search, the shift and the matrices
    all read this small table instead of re-aggregating the raw orders."""
    p = _pct_written(spark, sf_dir)
    first = p.agg(F.min("date")).scalar()
    return p.withColumn("idx", F.datediff("date", first).cast("long"))


def _rolled(spark, sf_dir):
    ix = _indexed(spark, sf_dir)
    lags = materialize(S.best_lag(ix, "coin", "pct", REFERENCE_COIN))
    n = lags.agg(F.max("n")).scalar()
    return materialize(S.roll(ix.select("coin", "idx", "pct"), lags, "coin", n))


def q_history_features(spark, sf_dir):
    """P12/P13 ingest + F15 + F17 + P16 over every daily history."""
    h = tables.daily_history(spark, sf_dir)
    return finish(h.select(
        "coin", "date", "close", "volume", num.billions("market_cap").alias("market_cap_bn"),
        num.volatility().alias("volatility"), num.day_ratio().alias("day_diff"),
        tf.day_of_year("date").alias("doy"), tf.month("date").alias("month"),
        filters.split_label("date", SPLIT_DATE).alias("period")))


def q_close_diff(spark, sf_dir):
    h = tables.daily_history(spark, sf_dir)
    return finish(S.first_diff(h, "close", "date", ["coin"], out="close_diff")
                  .select("coin", "date", "close_diff"))


def q_close_pct_change(spark, sf_dir):
    return finish(_pct(spark, sf_dir).select("coin", "date", "pct"))


def q_pct_last10(spark, sf_dir):
    return finish(S.last_n(_pct(spark, sf_dir), 10, "date", ["coin"]).select("coin", "date", "pct"))


def q_corr_pearson(spark, sf_dir):
    return finish(stats.pearson_matrix(_pct_written(spark, sf_dir), "date", "coin", "pct"))


def q_corr_spearman(spark, sf_dir):
    return finish(stats.spearman_matrix(_pct_written(spark, sf_dir), "date", "coin", "pct"))


def q_corr_kendall(spark, sf_dir):
    return finish(stats.kendall_matrix(_pct_written(spark, sf_dir), "date", "coin", "pct"))


def q_xcorr_lag(spark, sf_dir):
    ix = _indexed(spark, sf_dir)
    return finish(S.best_lag(ix, "coin", "pct", REFERENCE_COIN))


def q_lagged_corr_pearson(spark, sf_dir):
    return finish(stats.pearson_matrix(_rolled(spark, sf_dir), "idx", "coin", "pct"))


def q_lagged_corr_spearman(spark, sf_dir):
    return finish(stats.spearman_matrix(_rolled(spark, sf_dir), "idx", "coin", "pct"))


def q_lagged_corr_kendall(spark, sf_dir):
    return finish(stats.kendall_matrix(_rolled(spark, sf_dir), "idx", "coin", "pct"))


def q_latest_per_coin(spark, sf_dir):
    h = tables.daily_history(spark, sf_dir)
    return finish(S.latest_per_key(h, "coin", "date", ["open", "close", "volume", "market_cap"]))


def q_max_high_rows(spark, sf_dir):
    return finish(S.rows_at_max(_daily(spark, sf_dir, "high"), "high", ["coin"]))


def q_global_max_high(spark, sf_dir):
    return finish(S.rows_at_max(_daily(spark, sf_dir, "high"), "high"))


def q_coin_history_window(spark, sf_dir):
    """P17 (inclusive) and P7 (open interval) on one coin."""
    h = tables.daily_history(spark, sf_dir)
    inc = materialize(filters.history_between(h, "coin", PICK_COIN, "date", PICK_START, PICK_END)
                      .select("coin", "date", "close"))
    opn = filters.open_range(inc, "date", PICK_START, PICK_END)
    return finish(inc.select("coin", "date", "close", F.lit("inclusive").alias("kind"))
                  .unionByName(opn.select("coin", "date", "close", F.lit("open").alias("kind"))))


def q_coin_lookup(spark, sf_dir):
    """The rows of one label."""
    h = tables.daily_history(spark, sf_dir)
    return finish(filters.lookup(h, "coin", PICK_COIN).select("coin", "date", "open", "close"))


def q_market_share(spark, sf_dir):
    """A11 + A12 + P6 + P4 + U2: share of market cap on one day, top-k + other."""
    h = tables.daily_history(spark, sf_dir).where(F.col("date") == F.lit(SHARE_DATE).cast("date"))
    top = stats.top_k_with_other(h, "coin", "market_cap", TOP_K)
    # O3: largest share first, ties by label (a handful of rows).
    return finish(stats.share_of_total(top, "coin", "amount")).orderBy(F.desc("amount"), F.desc("coin"))


def q_close_extremes(spark, sf_dir):
    """A10 per coin + W4 normalisation of close by its abs-max."""
    return finish(S.absmax_normalise(_daily(spark, sf_dir, "close"), ["close"], ["coin"]))


QUERIES = {
    "history_features": q_history_features,
    "close_diff": q_close_diff,
    "close_pct_change": q_close_pct_change,
    "pct_last10": q_pct_last10,
    "corr_pearson": q_corr_pearson,
    "corr_spearman": q_corr_spearman,
    "corr_kendall": q_corr_kendall,
    "xcorr_lag": q_xcorr_lag,
    "lagged_corr_pearson": q_lagged_corr_pearson,
    "lagged_corr_spearman": q_lagged_corr_spearman,
    "lagged_corr_kendall": q_lagged_corr_kendall,
    "latest_per_coin": q_latest_per_coin,
    "max_high_rows": q_max_high_rows,
    "global_max_high": q_global_max_high,
    "coin_history_window": q_coin_history_window,
    "coin_lookup": q_coin_lookup,
    "market_share": q_market_share,
    "close_norm": q_close_extremes,
}

_L = f"WITH {HIST}, {PCT}, {INDEXED}, {LAGS}"
ORACLE = {
    "history_features": f"""WITH {HIST}
SELECT coin, date, round(close, 6) AS close, volume, round(market_cap / 1e9, 6) AS market_cap_bn,
  round((high - low) / nullif(open, 0), 6) AS volatility,
  round(close / nullif(open, 0), 6) AS day_diff,
  CAST(dayofyear(date) AS INTEGER) AS doy, CAST(month(date) AS INTEGER) AS month,
  CASE WHEN date < DATE '{SPLIT_DATE}' THEN 'before' ELSE 'after' END AS period
FROM hist""",
    "close_diff": f"""WITH {HIST}
SELECT coin, date, round(coalesce(close - lag(close) OVER (PARTITION BY coin ORDER BY date), 0), 6)
  AS close_diff FROM hist""",
    "close_pct_change": f"WITH {HIST}, {PCT} SELECT coin, date, round(pct, 6) AS pct FROM pct",
    "pct_last10": f"""WITH {HIST}, {PCT}
SELECT coin, date, round(pct, 6) AS pct FROM (
  SELECT *, row_number() OVER (PARTITION BY coin ORDER BY date DESC) AS rn FROM pct) t
WHERE rn <= 10""",
    "corr_pearson": f"WITH {HIST}, {PCT} {pearson_sql('pct', 'date', 'pct')}",
    "corr_spearman": f"WITH {HIST}, {PCT} {spearman_sql('pct', 'date', 'pct')}",
    "corr_kendall": f"WITH {HIST}, {PCT} {kendall_sql('pct', 'date', 'pct')}",
    "xcorr_lag": f"{_L} SELECT series, n, raw_lag, lag, round(xcorr_max, 6) AS xcorr_max FROM best",
    "lagged_corr_pearson": f"{_L} {pearson_sql('rolled', 'idx', 'pct')}",
    "lagged_corr_spearman": f"{_L} {spearman_sql('rolled', 'idx', 'pct')}",
    "lagged_corr_kendall": f"{_L} {kendall_sql('rolled', 'idx', 'pct')}",
    "latest_per_coin": f"""WITH {HIST}
SELECT coin, max(date) AS date, round(arg_max(open, date), 6) AS open,
  round(arg_max(close, date), 6) AS close, arg_max(volume, date) AS volume,
  round(arg_max(market_cap, date), 6) AS market_cap FROM hist GROUP BY coin""",
    "max_high_rows": f"""WITH {HIST}
SELECT coin, date, round(high, 6) AS high FROM hist h
WHERE high = (SELECT max(high) FROM hist m WHERE m.coin = h.coin)""",
    "global_max_high": f"""WITH {HIST}
SELECT coin, date, round(high, 6) AS high FROM hist WHERE high = (SELECT max(high) FROM hist)""",
    "coin_history_window": f"""WITH {HIST}
SELECT coin, date, round(close, 6) AS close, 'inclusive' AS kind FROM hist
WHERE coin = '{PICK_COIN}' AND date BETWEEN DATE '{PICK_START}' AND DATE '{PICK_END}'
UNION ALL
SELECT coin, date, round(close, 6) AS close, 'open' AS kind FROM hist
WHERE coin = '{PICK_COIN}' AND date > DATE '{PICK_START}' AND date < DATE '{PICK_END}'""",
    "coin_lookup": f"""WITH {HIST}
SELECT coin, date, round(open, 6) AS open, round(close, 6) AS close FROM hist WHERE coin = '{PICK_COIN}'""",
    "market_share": f"""WITH {HIST},
day AS (SELECT coin, sum(market_cap) AS amount FROM hist WHERE date = DATE '{SHARE_DATE}' GROUP BY coin),
rk AS (SELECT *, row_number() OVER (ORDER BY amount DESC, coin DESC) AS rn FROM day),
top AS (SELECT CASE WHEN rn <= {TOP_K} THEN coin ELSE 'other' END AS coin, sum(amount) AS amount
        FROM rk GROUP BY 1)
SELECT coin, round(amount, 6) AS amount,
  round(round(amount * 100.0 / (SELECT sum(amount) FROM top), 1), 6) AS pct FROM top""",
    "close_norm": f"""WITH {HIST},
s AS (SELECT coin, greatest(max(close), abs(min(close))) AS sc FROM hist GROUP BY coin)
SELECT h.coin, h.date, round(h.close, 6) AS close, round(h.close / nullif(s.sc, 0), 6) AS close_norm
FROM hist h JOIN s USING (coin)""",
}
