"""Order over a whole table without a one-task window.

:func:`numbered` gives every row its number in a global order: rows are dealt
out by range, sorted inside each range, written once, and the row counts of the
ranges (one row per range) give the offsets. :func:`with_previous`
looks back over a series the same way: only the edge of each range, one row,
travels.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.session import written

_ROW_BITS = 33          # monotonically_increasing_id: partition above, row below


def _keys(by: Sequence[str], order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).asc() for c in by] + [F.col(c).asc() if isinstance(c, str) else c for c in order]


def ranged(df: DataFrame, order: Sequence[str | Column], by: Sequence[str] = ()) -> DataFrame:
    """``df`` written once in global order ``(by, order)``, with ``_part`` (number
    of the range) and ``_row`` (place in it).

    Rows that compare equal may be cut between ranges anywhere (their place in
    the input parts them), so a value that a third of the rows share does not
    make a large range.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = df.withColumn("_tie", F.monotonically_increasing_id())
    keys = [*_keys(by, order), F.col("_tie").asc()]
    d = (d.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_tie")
         .withColumn("_at", F.monotonically_increasing_id()))
    d = d.select("*", F.shiftright("_at", _ROW_BITS).alias("_part"),
                 F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1).alias("_row")).drop("_at")
    return written(d, "ranged")


def _over_ranges(by: Sequence[str], *order: Column) -> Window:
    """A window over per-range rows: one row per range (and series), never data rows."""
    return Window.partitionBy(*(by or [F.lit(0)])).orderBy(*order)


def same(a: DataFrame, b: DataFrame, columns: Sequence[str], how: str = "left") -> DataFrame:
    """Join on equal values, null equal to null; ``b``'s columns are dropped."""
    b = b.withColumnsRenamed({c: f"_b_{c}" for c in columns})
    on = [a[c].eqNullSafe(b[f"_b_{c}"]) for c in columns]
    return a.join(b, on, how).drop(*[f"_b_{c}" for c in columns])


def numbered(df: DataFrame, order: Sequence[str | Column], by: Sequence[str] = (),
             idx: str = "pos") -> DataFrame:
    """Every row with its 0-based number ``idx`` in ``order``, within ``by`` if given.

    Order as Spark's: nulls first when ascending. Rows equal in ``order`` get
    different numbers in no stated order; add columns to ``order`` to fix it.
    """
    d = ranged(df, order, by)
    counts = d.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = _over_ranges(by, F.col("_part")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0))
                                           - F.col("_first")).alias("_off"))
    out = same(d, offsets, [*by, "_part"], "inner")
    return out.withColumn(idx, F.col("_row") + F.col("_off")).drop("_part", "_row", "_off")


def prefix_sums(df: DataFrame, order: Sequence[str | Column], by: Sequence[str],
                sums: dict[str, str]) -> DataFrame:
    """Each row with the sum of some columns (``sums``: column -> output) over the rows
    before it in ``order`` within ``by``; 0 for the first. Sums per range (one row
    each) are carried forward, and windows run inside a range."""
    d = ranged(df, order, by)
    per = d.groupBy(*by, "_part").agg(*[F.sum(c).alias(f"_s_{c}") for c in sums])
    before = _over_ranges(by, F.col("_part")).rowsBetween(Window.unboundedPreceding, -1)
    halo = per.select(*by, "_part", *[F.coalesce(F.sum(f"_s_{c}").over(before), F.lit(0)).alias(f"_in_{c}")
                                      for c in sums])
    w = Window.partitionBy("_part", *by).orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    inside = d.select("*", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(out) for c, out in sums.items()])
    out = same(inside, halo, [*by, "_part"], "inner")
    return out.withColumns({o: F.col(o) + F.col(f"_in_{c}") for c, o in sums.items()}).drop(
        "_part", "_row", *[f"_in_{c}" for c in sums])


def with_previous(df: DataFrame, value: str, order: Sequence[str | Column], by: Sequence[str] = (),
                  previous: str = "prev", filled: str = "filled",
                  filled_previous: str = "filled_prev") -> DataFrame:
    """Each row with the value of the row before it (``previous``), its own value
    filled forward over nulls (``filled``) and that of the row before it
    (``filled_previous``), in ``order`` within each series of ``by`` (or over the
    whole table). Null where there is no earlier row or value.

    A segmented scan: inside a range the values come from a window over that range's
    rows of the series; what enters a range from outside is one row (its halo), the
    last value and the last non-null value of the ranges before it, carried forward
    over one row per range and series.
    """
    d = ranged(df, order, by)
    last = F.max_by(F.struct(F.col(value).alias("v")), F.col("_row"))["v"]
    last_known = F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col("_row")))
    edges = d.groupBy(*by, "_part").agg(last.alias("_last"), last_known.alias("_known"))
    over = _over_ranges(by, F.col("_part"))
    halo = edges.select(
        *by, "_part", F.lag("_last").over(over).alias("_in"),
        F.last("_known", ignorenulls=True)
        .over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("_in_known"))
    w = Window.partitionBy("_part", *by).orderBy("_row")
    inside = d.select(
        "*", F.lag(value).over(w).alias(previous), (F.row_number().over(w) == 1).alias("_first"),
        F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias(filled),
        F.last(value, ignorenulls=True)
        .over(w.rowsBetween(Window.unboundedPreceding, -1)).alias(filled_previous))
    out = same(inside, halo, [*by, "_part"], "inner")
    return out.withColumns({
        previous: F.when(F.col("_first"), F.col("_in")).otherwise(F.col(previous)),
        filled: F.coalesce(filled, "_in_known"),
        filled_previous: F.coalesce(filled_previous, "_in_known"),
    }).drop("_part", "_row", "_first", "_in", "_in_known")
