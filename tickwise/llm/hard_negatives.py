"""Hard negatives by Fagin's threshold algorithm.

Rows are cut into blocks of bounded size, anchors into groups, and every group
meets every block (an equi-join on the block number). A block holds, for each
dimension, the list of its rows sorted by that component. For an anchor, every
list is read from the end that its sign favours (sorted access), each row met for
the first time is scored in integers (random access), and the threshold is what a
row could still score that stands below the places read in all lists. Reading
stops when the threshold falls strictly below the k-th score of every window, or
below the window's lower end: no unread row, not even a tied one, can then enter.

Two passes: the first finds an anchor's positives, the second the negatives inside
the score windows that the positives set. Each pass keeps the best k of a block
for each window and merges these few rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.llm._common import ship, staged

ship(__name__)

POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95                   # a window, in percent of the positive's score
SCALE = 256
BLOCK_ROWS = 16_384
GROUP_ANCHORS = 256
FIRST_DEPTH = 16
# Largest scaled component: a score of up to 2**15 dimensions then fits 63 bits.
LIMIT = 1 << 24

_OUT = "anchor long, slot int, vec_id long, score long"


class Block:
    """Rows of one block with a sorted list for each dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.x = ids[by_id], labels[by_id], x[by_id]
        self.lists = np.argsort(self.x, axis=0, kind="stable").T.copy()
        self.dims = np.arange(x.shape[1])
        most = int(np.abs(x).max(initial=0))
        # products in doubles are exact while every sum stays below 2**53
        self.fast = self.x.astype("float64") if most * max(1, x.shape[1]) * LIMIT < 1 << 53 else None

    def scores(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        if self.fast is None:
            return self.x[rows] @ q
        return (self.fast[rows] @ q.astype("float64")).astype("int64")

    def search(self, q: np.ndarray, allowed: np.ndarray, windows: list[tuple[int, int, int]],
               first_depth: int = FIRST_DEPTH) -> list[list[tuple[int, int]]]:
        """For each window ``(low, high, k)`` its first k rows of ``allowed`` with
        ``low <= score <= high``, as ``(id, score)``."""
        n = len(self.ids)
        used = self.dims[q != 0]
        up = q[used] > 0
        seen = np.zeros(n, dtype=bool)
        best = [(np.empty(0, "int64"), np.empty(0, "int64")) for _ in windows]   # (rows, scores)
        open_, depth, step = list(range(len(windows))), 0, first_depth
        if not len(used):                                   # every score is 0: no list says more
            depth, fresh = n, np.arange(n)
        while open_:
            if depth < n:
                to = min(n, depth + step)
                met = np.zeros(n, dtype=bool)
                met[self.lists[used[up], n - to:n - depth].ravel()] = True
                met[self.lists[used[~up], depth:to].ravel()] = True
                fresh = np.flatnonzero(met & ~seen)
                seen[fresh] = True
                depth, step = to, step * 2
            fresh = fresh[allowed[fresh]]
            s = self.scores(fresh, q)
            edge = np.where(up, self.lists[used, n - depth], self.lists[used, depth - 1])
            threshold = int((self.x[edge, used] * q[used]).sum())
            for w in list(open_):
                low, high, k = windows[w]
                rows, scores = best[w]
                fits = (s >= low) & (s <= high)
                rows, scores = np.append(rows, fresh[fits]), np.append(scores, s[fits])
                if len(scores) > k:                          # ties of the k-th stay
                    top = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
                    rows, scores = rows[top], scores[top]
                first = np.lexsort((rows, -scores))[:k]      # rows stand by id
                best[w] = rows[first], scores[first]
                if depth >= n or threshold < low or (len(first) == k and threshold < scores[first[-1]]):
                    open_.remove(w)
        return [list(zip(self.ids[r].tolist(), s.tolist())) for r, s in best]


def _matrix(values, width: int) -> np.ndarray:
    out = np.zeros((len(values), width), dtype="int64")
    for i, v in enumerate(values):
        out[i, :len(v)] = v
    return out


def _search(same: bool):
    """Anchors of one group against the rows of one block."""
    def run(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(anchors) and len(rows):
            width = max(max(map(len, rows["q"])), max(map(len, anchors["to"])))
            block = Block(rows["vec_id"].to_numpy("int64"), rows["label"].to_numpy("int64"),
                          _matrix(rows["q"].tolist(), width))
            for a, label, q, lows, highs in zip(anchors["anchor"], anchors["own"],
                                                _matrix(anchors["to"].tolist(), width),
                                                anchors["lows"], anchors["highs"]):
                if same:
                    allowed = (block.labels == label) & (block.ids != a)
                    windows = [(-(1 << 63), (1 << 63) - 1, POSITIVES)]
                else:
                    allowed = block.labels != label
                    windows = [(lo, hi, NEGATIVES) for lo, hi in zip(lows.tolist(), highs.tolist())]
                for slot, found in enumerate(block.search(q, allowed, windows)):
                    out.extend((a, slot, i, s) for i, s in found)
        return pd.DataFrame(out, columns=["anchor", "slot", "vec_id", "score"])
    return run


def quantized(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, label, q)``: rows that take part, components as integers, one row
    for a vec_id (of several the one with the least label, then vector)."""
    x = F.col("embedding").cast("array<double>")
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
              & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    label, vec = F.col("label").cast("long"), F.col("vec_id").cast("long")
    q = F.transform("x", lambda v: F.floor(F.greatest(F.least(v * SCALE, F.lit(float(LIMIT))),
                                                      F.lit(float(-LIMIT)))).cast("int"))
    rows = embeddings.withColumn("x", x).where(usable).select(
        vec.alias("vec_id"),
        F.when(F.pmod(vec, F.lit(7)) == 0, F.pmod(label + 1, F.lit(10))).otherwise(label).alias("label"),
        q.alias("q"))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("r")).select("vec_id", "r.*")


def _meet(anchors: DataFrame, rows: DataFrame, groups: int, blocks: int, same: bool) -> DataFrame:
    """Every anchor group with every block of rows: ``(anchor, slot, vec_id, score)``."""
    a = anchors.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("in_block"))
    r = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("for_group"))
    return a.groupBy("g", "in_block").cogroup(r.groupBy("for_group", "b")).applyInPandas(_search(same), _OUT)


def _first(found: DataFrame, by: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _hundredth(x: Column) -> Column:
    """``floor(x / 100)`` in whole numbers (a long quotient of an exact multiple)."""
    return F.call_function("div", x - F.pmod(x, F.lit(100)), F.lit(100).cast("long"))


def mine(embeddings: DataFrame, anchor: Column | None = None) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``anchor`` says which rows are anchors (default: vec_id divisible by 50). An
    anchor's positives are its first :data:`POSITIVES` other rows of its label, its
    negatives for a positive the first :data:`NEGATIVES` rows of other labels with
    ``LOW * p <= 100 * n <= HIGH * p``; higher scores first, ties by smaller vec_id.

    Rows with a null vec_id, label, vector or component, or one that is not finite,
    take no part; a vec_id counts once (repeated rows: the least label, then vector).
    Vectors of different lengths are filled up with zeros; scaled components stop at
    ``+-LIMIT``. A positive whose window is empty gives no row, an empty table
    none. Other columns are not read.
    """
    rows = staged(quantized(embeddings), "vectors")
    anchor = F.pmod("vec_id", F.lit(50)) == 0 if anchor is None else anchor
    n, n_anchors = rows.agg(F.count(F.lit(1)), F.count_if(anchor)).first()
    blocks, groups = max(1, -(-n // BLOCK_ROWS)), max(1, -(-n_anchors // GROUP_ANCHORS))
    spread = F.xxhash64("vec_id")
    rows = rows.withColumn("b", F.pmod(spread, F.lit(blocks)).cast("int"))
    anchors = rows.where(anchor).select(
        F.col("vec_id").alias("anchor"), F.col("label").alias("own"), F.col("q").alias("to"),
        F.pmod(F.shiftright(spread, 17), F.lit(groups)).cast("int").alias("g"))
    none = F.lit(None).cast("array<long>")
    found = _meet(anchors.select("*", none.alias("lows"), none.alias("highs")), rows, groups, blocks, True)
    positives = staged(_first(found, ["anchor"], POSITIVES).select(
        "anchor", F.col("rank").alias("slot"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score")), "positives")

    # whole numbers n with 50 p <= 100 n <= 95 p
    ends = positives.groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("slot", "positive_score"))).alias("w"))
    lows = F.transform("w", lambda s: -_hundredth(-s["positive_score"] * LOW))
    highs = F.transform("w", lambda s: _hundredth(s["positive_score"] * HIGH))
    windows = ends.select("anchor", lows.alias("lows"), highs.alias("highs"))
    found = _meet(anchors.join(windows, "anchor"), rows, groups, blocks, False)
    negatives = _first(found, ["anchor", "slot"], NEGATIVES).withColumn("slot", F.col("slot") + 1)
    return negatives.join(positives, ["anchor", "slot"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
