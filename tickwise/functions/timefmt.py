"""Timestamp parsing and bucketing expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The formats the inputs use.
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"          # price Date + Time, news pub_date
SCRAPED_DATE_FORMAT = "MMM dd, yyyy"       # history tables, e.g. "Mar 01, 2019"
# Formats tried, in order, when the format is not known (inferred parsing).
INFERRED_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
    "yyyy-MM-dd",
    "MMM dd, yyyy",
    "MMM d, yyyy",
    "yyyyMMdd",
)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(c) -> Column:
    """Timestamp without zone (results collect identically on any host)."""
    return _c(c).cast("timestamp_ntz")


def date_time(date_col, time_col) -> Column:
    """``Date + ' ' + Time``; null if either part is null."""
    d, t = _c(date_col), _c(time_col)
    return F.when(d.isNotNull() & t.isNotNull(), F.concat_ws(" ", d, t))


def parse_ts(c, fmt: str = TS_FORMAT) -> Column:
    """explicit-format parse; unparsable text gives null."""
    return ntz(F.try_to_timestamp(_c(c), F.lit(fmt)))


def parse_ts_inferred(c, formats=INFERRED_FORMATS) -> Column:
    """first format that parses wins (``to_datetime`` without a format)."""
    col = _c(c)
    return ntz(F.coalesce(*[F.try_to_timestamp(col, F.lit(f)) for f in formats]))


def parse_scraped_date(c) -> Column:
    """F13 for scraped history dates such as ``Mar 01, 2019``."""
    return F.to_date(F.try_to_timestamp(_c(c), F.lit(SCRAPED_DATE_FORMAT)))


def minute(c) -> Column:
    """truncate to the minute."""
    return ntz(F.date_trunc("minute", _c(c)))


def hour(c) -> Column:
    return ntz(F.date_trunc("hour", _c(c)))


def day_of_year(c) -> Column:
    """F15."""
    return F.dayofyear(_c(c))


def month(c) -> Column:
    """F15."""
    return F.month(_c(c))


def hms_seconds(c) -> Column:
    """F16: ``HH:MM:SS`` text to seconds since midnight (null if malformed)."""
    t = F.try_to_timestamp(F.concat(F.lit("1970-01-01 "), _c(c)), F.lit(TS_FORMAT))
    return F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
