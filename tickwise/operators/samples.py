"""Training samples from the minute feature table.

A sample starting at row ``t`` holds rows ``t .. t+59`` (six features each)
and targets ``Close[t+60+n]`` for ``n`` in (1, 10, 30); prices are divided by
the last input close, volume (and, as in the original notebook, sentiment) by
the last input volume.

Plan at scale (the whole table is ONE series ordered by time):

1. ``with_row_index``: a dense global row number from per-day counts (one
   broadcast row per day), rows numbered inside their day.
2. Rows are cut into blocks of ``block`` rows; each row is also copied to the
   previous block when a sample starting there needs it (a halo of 90 rows),
   so only ~90/block extra rows are shuffled.
3. One window per block (``partitionBy(blk).orderBy(i)``) gathers the next
   60 rows and the future closes; each block keeps the starts it owns.

No task ever holds more than ``block + 90`` rows, however long the series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.functions import numeric as num
from tickwise.operators import filters
from tickwise.operators.series import with_row_index

# Fixed values of the sample layout.
WINDOW = 60                      # input rows per sample
TARGETS = (1, 10, 30)            # rows after the window that are predicted
TEST_STARTS = 10000              # most recent starts held out for testing
FEATURES = ("Open", "High", "Low", "Close", "Volume", "Sentiment_Value")
BLOCK = 4096


def model_input(minutes: DataFrame, ts: str = "Timestamp_Rounded") -> DataFrame:
    """P10 + P2 + P3: drop incomplete minutes, keep the six features in order."""
    clean = filters.drop_incomplete(minutes)
    return clean.select(F.col(ts).alias("ts"), "Open", "High", "Low", "Close", "Volume",
                        F.col("Score").alias("Sentiment_Value"))


def _split(i: Column, n: Column, horizon: int, test_starts: int) -> Column:
    """train = starts before the last ``test_starts``; test = the rest, t > 0."""
    cut = n - F.lit(horizon) - F.lit(test_starts)
    return F.when(i < cut, F.lit("train")).when(i > 0, F.lit("test"))


def build_samples(df: DataFrame, order: str = "ts", window: int = WINDOW,
                  targets: Sequence[int] = TARGETS, test_starts: int = TEST_STARTS,
                  block: int = BLOCK, sentiment_by_volume: bool = True,
                  bucket: Column | None = None) -> DataFrame:
    """W5-W8 + M1 + F24: one row per sample start.

    Columns: ``t, start_ts, end_ts, split, features`` (array<double> of
    ``window * 6``, row-major), ``y{n}`` normalised targets and ``label``
    (1 when the first target is above the last close).
    """
    horizon = window + max(targets)
    if block <= horizon:
        raise ValueError("block must exceed the sample horizon")
    d = with_row_index(df, [order], bucket if bucket is not None else F.to_date(order),
                       idx="i", total="N")
    own = F.floor(F.col("i") / block)
    first = F.floor(F.greatest(F.col("i") - horizon, F.lit(0)) / block)
    x = d.select("*", own.alias("_own"), F.explode(F.sequence(first, own)).alias("blk"))
    w = Window.partitionBy("blk").orderBy("i")
    frame = w.rowsBetween(0, window - 1)
    rows = F.collect_list(F.struct(*[F.col(c) for c in FEATURES])).over(frame)
    lc = F.lead("Close", window - 1).over(w)
    lv = F.lead("Volume", window - 1).over(w)
    end_ts = F.lead(order, window - 1).over(w)
    ys = [F.lead("Close", window + n).over(w).alias(f"_y{n}") for n in targets]
    s = x.select("i", "N", "_own", "blk", F.col(order).alias("start_ts"), end_ts.alias("end_ts"),
                 rows.alias("_rows"), lc.alias("_lc"), lv.alias("_lv"), *ys)
    s = s.where((F.col("blk") == F.col("_own")) & (F.col("i") < F.col("N") - horizon))
    split = _split(F.col("i"), F.col("N"), horizon, test_starts)
    s = s.withColumn("split", split).where(F.col("split").isNotNull())

    def norm(r):
        lc_, lv_ = F.col("_lc"), F.col("_lv")
        sent = F.try_divide(r["Sentiment_Value"], lv_) if sentiment_by_volume else r["Sentiment_Value"]
        return F.array(F.try_divide(r["Open"], lc_), F.try_divide(r["High"], lc_),
                       F.try_divide(r["Low"], lc_), F.try_divide(r["Close"], lc_),
                       F.try_divide(r["Volume"], lv_), sent)

    feats = F.flatten(F.transform("_rows", norm))
    out = s.select(F.col("i").alias("t"), "start_ts", "end_ts", "split", feats.alias("features"),
                   *[F.try_divide(F.col(f"_y{n}"), F.col("_lc")).alias(f"y{n}") for n in targets])
    return out.withColumn("label", num.up_label(f"y{targets[0]}"))


def windows(df: DataFrame, order: str = "ts", window: int = WINDOW, block: int = BLOCK,
            sentiment_by_volume: bool = True) -> DataFrame:
    """Every complete input window (no targets): ``t, start_ts, end_ts, features``.

    Numbered and cut into blocks with a halo as in :func:`build_samples`, so no task
    holds more than ``block + window`` rows.
    """
    d = with_row_index(df, [order], F.to_date(order), idx="i", total="N")
    own = F.floor(F.col("i") / block)
    first = F.floor(F.greatest(F.col("i") - (window - 1), F.lit(0)) / block)
    x = d.select("*", own.alias("_own"), F.explode(F.sequence(first, own)).alias("blk"))
    w = Window.partitionBy("blk").orderBy("i")
    rows = F.collect_list(F.struct(*[F.col(c) for c in FEATURES])).over(w.rowsBetween(0, window - 1))
    s = x.select("i", "N", "_own", "blk", F.col(order).alias("start_ts"),
                 F.lead(order, window - 1).over(w).alias("end_ts"), rows.alias("_rows"))
    s = s.where((F.col("blk") == F.col("_own")) & (F.col("i") <= F.col("N") - window))
    last = F.element_at("_rows", -1)

    def norm(r):
        sent = F.try_divide(r["Sentiment_Value"], last["Volume"]) if sentiment_by_volume \
            else r["Sentiment_Value"]
        return F.array(*[F.try_divide(r[c], last["Close"]) for c in ("Open", "High", "Low", "Close")],
                       F.try_divide(r["Volume"], last["Volume"]), sent)

    return s.select(F.col("i").alias("t"), "start_ts", "end_ts",
                    F.flatten(F.transform("_rows", norm)).alias("features"),
                    F.lit(None).cast("int").alias("label"))


def latest_sample(df: DataFrame, order: str = "ts", window: int = WINDOW,
                  sentiment_by_volume: bool = True) -> DataFrame:
    """The newest complete input window (for live scoring, T9): one row with
    ``t`` = -1, ``start_ts``, ``end_ts`` and ``features``; empty when fewer
    than ``window`` rows exist. A distributed top-``window`` followed by one
    aggregate over exactly ``window`` rows."""
    last = df.orderBy(F.col(order).desc()).limit(window)
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"),
                                                *[F.col(c) for c in FEATURES])))
    one = last.agg(rows.alias("_rows"), F.count(F.lit(1)).alias("_n"))
    lastr = F.element_at("_rows", -1)

    def norm(r):
        lc_, lv_ = lastr["Close"], lastr["Volume"]
        sent = F.try_divide(r["Sentiment_Value"], lv_) if sentiment_by_volume else r["Sentiment_Value"]
        return F.array(F.try_divide(r["Open"], lc_), F.try_divide(r["High"], lc_),
                       F.try_divide(r["Low"], lc_), F.try_divide(r["Close"], lc_),
                       F.try_divide(r["Volume"], lv_), sent)

    return one.where(F.col("_n") == window).select(
        F.lit(-1).cast("long").alias("t"), F.element_at("_rows", 1)["_o"].alias("start_ts"),
        lastr["_o"].alias("end_ts"), F.flatten(F.transform("_rows", norm)).alias("features"),
        F.lit(None).cast("int").alias("label"))
