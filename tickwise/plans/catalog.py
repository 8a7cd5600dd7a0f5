"""The registry behind ``__spark_entry__``: query name -> builder and SQL."""

from __future__ import annotations

from tickwise.plans import (bars_q, files_q, long_q, model_q, news_q, pages_q, samples_q, series_q,
                            streams_q)

_MODULES = [bars_q, series_q, news_q, pages_q, files_q, samples_q, long_q, model_q, streams_q]


def _utc(fn):
    """Bucketing of zone-free timestamps assumes a UTC session: set it."""
    def run(spark, sf_dir):
        if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def queries():
    out = {}
    for m in _MODULES:
        out.update({k: _utc(v) for k, v in m.QUERIES.items()})
    return out


def oracle_sql():
    out = {}
    for m in _MODULES:
        out.update(m.ORACLE)
    return out
