"""Named queries over long series and whole tables in order: scans over ranges,
lags by transform, global positions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickwise.operators import order, stats
from tickwise.operators import series as S
from tickwise.plans.common import finish, sql_list
from tickwise.plans.series_q import HIST, SHARE_DATE
from tickwise.session import materialize
from tickwise.sources import tables
from tickwise.sources.tables import PRICE_TYPES

MAX_LAG = 180                           # minutes either way
XCORR_REFERENCE = "purchase"            # its minutes are the reference series


def q_tick_changes(spark, sf_dir):
    """W1 + W2 over every price tick as one series, in order of time and id."""
    t = tables.price_ticks(spark, sf_dir).select("id", "ts", "Close")
    return finish(S.changes(t, "Close", ["ts", "id"], diff="diff", pct="pct"))


def q_minute_changes(spark, sf_dir):
    """W1 + W2 over the minute closes of every price type, each a long series."""
    m = _minute_closes(spark, sf_dir)
    return finish(S.changes(m, "close", "minute", ["kind"], diff="diff", pct="pct"))


def _minute_closes(spark, sf_dir):
    ev = tables.table(spark, sf_dir, "events").where(F.col("event_type").isin(*PRICE_TYPES))
    return (ev.groupBy(F.col("event_type").alias("kind"), F.date_trunc("minute", "ts").alias("minute"))
            .agg(F.avg("value").alias("close")))


def q_minute_xcorr(spark, sf_dir):
    """Sums of products of minute closes at all lags up to three hours."""
    m = materialize(_minute_closes(spark, sf_dir).select(
        "kind", F.expr("unix_seconds(CAST(minute AS TIMESTAMP)) div 60").alias("at"), "close"))
    first = m.agg(F.min("at")).scalar()
    ix = m.select("kind", (F.col("at") - first).alias("idx"), "close")
    return finish(S.lag_products(ix, "kind", "close", XCORR_REFERENCE, max_lag=MAX_LAG))


def q_news_in_order(spark, sf_dir):
    """O1: every news row's place by time, then id."""
    n = tables.news_rows(spark, sf_dir)
    return finish(order.numbered(n, ["pub_date", "id"], idx="pos"))


def q_section_order(spark, sf_dir):
    """O2: sections by number of articles, then name."""
    a = tables.articles(spark, sf_dir)
    s = stats.share_of_total(a, "section_name")
    return finish(order.numbered(s, ["amount", "section_name"], idx="pos"))


def q_market_cap_order(spark, sf_dir):
    """O3: coins of every day by falling market cap, then falling name."""
    h = tables.daily_history(spark, sf_dir).select("date", "coin", "market_cap")
    return finish(order.numbered(h, [F.desc("market_cap"), F.desc("coin")], ["date"], idx="pos"))


QUERIES = {
    "tick_changes": q_tick_changes,
    "minute_changes": q_minute_changes,
    "minute_xcorr": q_minute_xcorr,
    "news_in_order": q_news_in_order,
    "section_order": q_section_order,
    "market_cap_order": q_market_cap_order,
}

_KINDS = sql_list(PRICE_TYPES)
_MINUTES = f"""m AS (
  SELECT event_type AS kind, date_trunc('minute', ts) AS minute, avg(value) AS close
  FROM events WHERE event_type IN ({_KINDS}) GROUP BY 1, 2)"""


def _changes_sql(source: str, keep: str, value: str, by: str, key: str) -> str:
    w = f"({by} ORDER BY {key})"
    return f"""SELECT {keep}, round({value}, 6) AS {value},
  round(coalesce({value} - lag({value}) OVER {w}, 0), 6) AS diff,
  round(coalesce(ff / nullif(lag(ff) OVER {w}, 0) - 1, 0), 6) AS pct
FROM (SELECT *, last_value({value} IGNORE NULLS) OVER ({by} ORDER BY {key}
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ff FROM {source}) f"""


ORACLE = {
    "tick_changes": f"""WITH t AS (SELECT event_id AS id, ts, value AS Close FROM events
  WHERE event_type IN ({_KINDS}))
{_changes_sql('t', 'id, ts', 'Close', '', 'ts, id')}""",
    "minute_changes": f"""WITH {_MINUTES}
{_changes_sql('m', 'kind, minute', 'close', 'PARTITION BY kind', 'minute')}""",
    "minute_xcorr": f"""WITH {_MINUTES},
i AS (SELECT kind, CAST(floor(epoch(minute) / 60) AS BIGINT) AS idx, close FROM m)
SELECT a.kind AS series, a.idx - b.idx AS lag, round(sum(a.close * b.close), 6) AS z, count(*) AS pairs
FROM i a JOIN i b ON b.kind = '{XCORR_REFERENCE}'
  AND a.idx BETWEEN b.idx - {MAX_LAG} AND b.idx + {MAX_LAG}
WHERE a.close IS NOT NULL AND b.close IS NOT NULL GROUP BY 1, 2""",
    "news_in_order": f"""SELECT event_id AS id, ts AS pub_date, round(value, 6) AS score,
  row_number() OVER (ORDER BY ts NULLS FIRST, event_id NULLS FIRST) - 1 AS pos
FROM events WHERE event_type IN ({sql_list(tables.NEWS_TYPES)})""",
    "section_order": """WITH g AS (
  SELECT source AS section_name, count(*)::DOUBLE AS amount FROM documents WHERE source IS NOT NULL GROUP BY 1)
SELECT section_name, amount, round(round(amount * 100.0 / (SELECT sum(amount) FROM g), 1), 6) AS pct,
  row_number() OVER (ORDER BY amount, section_name) - 1 AS pos FROM g""",
    "market_cap_order": f"""WITH {HIST}
SELECT date, coin, round(market_cap, 6) AS market_cap,
  row_number() OVER (PARTITION BY date ORDER BY market_cap DESC, coin DESC) - 1 AS pos FROM hist""",
}
