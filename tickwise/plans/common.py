"""Helpers shared by the named queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Registered results round doubles to this many places, in Spark and in the
# oracle SQL alike, so sums taken in a different order hash the same.
DIGITS = 6


def round_half_away(c, digits: int = DIGITS):
    """Round half away from zero on the binary value: ``sign(y) * floor(|y| + 0.5)``
    with ``y = x * 10^digits``. This is the rule the SQL oracle's ``round``
    applies to doubles, so both sides produce identical doubles (Spark's
    ``round`` instead rounds the decimal text, which differs at exact ties).
    """
    scale = float(10 ** digits)
    y = c * F.lit(scale)
    r = F.signum(y) * F.floor(F.abs(y) + F.lit(0.5)).cast("double") / F.lit(scale)
    return F.when(F.abs(y) < F.lit(1e15), r).otherwise(c)


def finish(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double/float column; cast timestamps to zone-free."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = round_half_away(c.cast("double"), digits)
        elif isinstance(f.dataType, T.ArrayType) and isinstance(
                f.dataType.elementType, (T.DoubleType, T.FloatType)):
            c = F.transform(c, lambda x: round_half_away(x.cast("double"), digits))
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def sql_list(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)
