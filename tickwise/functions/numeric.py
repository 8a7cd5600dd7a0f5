"""Numeric rules: ratios, weights, rounding and class labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickwise.functions import text as tx


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num, den) -> Column:
    """Division that yields null instead of failing on a zero denominator."""
    return F.try_divide(_c(num), _c(den))


def volatility(high="high", low="low", open_="open") -> Column:
    """``(high - low) / open``."""
    return ratio(_c(high) - _c(low), open_)


def day_ratio(close="close", open_="open") -> Column:
    """``close / open``."""
    return ratio(close, open_)


def billions(c) -> Column:
    """F18."""
    return _c(c) / F.lit(1e9)


def dash_to_zero_bigint(c) -> Column:
    """The scraped ``-`` becomes 0, a number (thousands separators allowed)
    bigint; anything else is null, never a made-up zero."""
    v = F.trim(_c(c))
    return F.when(v == "-", F.lit(0).cast("bigint")).otherwise(
        F.regexp_replace(v, ",", "").try_cast("bigint"))


def relevance(content="content", null_as_hit: bool = False) -> Column:
    """F19 + F20: larger of the crypto weight and the economy weight."""
    r1 = F.when(tx.contains_regex(content, tx.CRYPTO_PATTERN, null_as_hit),
                F.lit(tx.CRYPTO_WEIGHT)).otherwise(F.lit(tx.NO_HIT_WEIGHT))
    r2 = F.when(tx.contains_regex(content, tx.ECONOMY_PATTERN, null_as_hit),
                F.lit(tx.ECONOMY_WEIGHT)).otherwise(F.lit(tx.NO_HIT_WEIGHT))
    return F.greatest(r1, r2)


def score(sentiment="SENTIMENT_VALUE", relevance_col="relevance") -> Column:
    """F21."""
    return _c(sentiment) * _c(relevance_col)


def _python_round1_halves() -> dict[str, float]:
    """Decimal halves at one place in [-1, 1] and what Python's round gives.

    ``round(x, 1)`` rounds the binary value, so 0.35 -> 0.3 but 0.45 -> 0.5,
    while SQL rounding works on the decimal text. Built from the rule, not
    listed by hand.
    """
    out = {}
    for k in range(1, 20, 2):          # 0.05, 0.15, ..., 0.95
        v = k / 20
        for x in (v, -v):
            out[f"{x:.4f}"] = round(x, 1) + 0.0
    return out


PY_ROUND1_HALVES = _python_round1_halves()


def python_round1(c) -> Column:
    """Python ``round(x, 1)`` for values already rounded to 4 places."""
    x = _c(c)
    halves = F.create_map(*[e for k, v in sorted(PY_ROUND1_HALVES.items())
                            for e in (F.lit(k), F.lit(v))])
    r = F.coalesce(F.element_at(halves, F.format_string("%.4f", x)), F.round(x, 1))
    return r + F.lit(0.0)   # -0.0 -> 0.0


def sentiment_class(c) -> Column:
    """five-way class; anything else in range order is 'Very Negative'.

    A null value (no text) stays null.
    """
    x = _c(c)
    return (F.when(x.isNull(), F.lit(None).cast("string"))
            .when((x <= 1) & (x >= 0.5), "Very Positive")
            .when((x < 0.5) & (x > 0), "Positive")
            .when(x == 0, "Neutral")
            .when((x < 0) & (x >= -0.5), "Negative")
            .otherwise("Very Negative"))


def up_label(c, threshold: float = 1.0) -> Column:
    """1 when the normalised future price is above ``threshold``."""
    return (_c(c) > F.lit(threshold)).cast("int")


def direction(p, cut: float = 0.5) -> Column:
    """decision text from a probability."""
    return F.when(_c(p) < F.lit(cut), F.lit("DOWN")).otherwise(F.lit("UP"))
