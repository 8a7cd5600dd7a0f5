"""Row filters and labels over histories and news tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.functions import text as tx


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def equals(df: DataFrame, col: str, value) -> DataFrame:
    """P6."""
    return df.where(F.col(col) == F.lit(value))


def open_range(df: DataFrame, col: str, start, end) -> DataFrame:
    """``start < col < end`` (both ends exclusive)."""
    c = F.col(col)
    return df.where((c > F.lit(start).cast(df.schema[col].dataType)) &
                    (c < F.lit(end).cast(df.schema[col].dataType)))


def in_list(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """P8."""
    return df.where(F.col(col).isin(*values))


def section_label(col: str, sections: Sequence[str]) -> Column:
    """The first section whose pattern matches the start of ``col``.

    One pass labels every row, so the subsets come from one
    ``write.partitionBy('section')`` instead of one scan per section.
    """
    out = F.lit(None).cast("string")
    for s in reversed(list(sections)):
        out = F.when(tx.starts_with_regex(col, s), F.lit(s)).otherwise(out)
    return out


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """P10: drop rows with any null."""
    return df.na.drop("any", subset=list(subset) if subset else None)


def split_label(col: str, date, before: str = "before", after: str = "after") -> Column:
    """``before`` strictly earlier than ``date``, else ``after``."""
    c = F.col(col)
    return F.when(c < F.lit(date).cast("date"), F.lit(before)).otherwise(F.lit(after))


def history_between(df: DataFrame, key: str, value, date_col: str, start, end=None) -> DataFrame:
    """One key between two dates inclusive; ``end`` defaults to today.

    With the history stored partitioned by ``key`` the key filter prunes
    partitions; the date filter is pushed into the Parquet reader.
    """
    e = F.lit(end).cast("date") if end is not None else F.current_date()
    return df.where((F.col(key) == F.lit(value)) &
                    F.col(date_col).between(F.lit(start).cast("date"), e))


def nth_by_rank(df: DataFrame, rank_col: str, n: int) -> DataFrame:
    """The item at listing position ``n`` (0-based)."""
    return df.where(F.col(rank_col) == n)


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    """Row lookup by an explicit key column."""
    return df.where(F.col(key) == F.lit(value))
