"""Toxicity by non-negative positive-unlabelled learning.

Only texts confirmed as toxic are taken as labelled; all other texts are unlabelled,
whatever their label says. With the share ``prior`` of toxic texts, the risk of a
scorer f is estimated as

    prior * E_pos[loss(f)] + max(0, E_unl[loss(-f)] - prior * E_pos[loss(-f)])

(logistic loss). The second term estimates the risk on clean texts, which cannot be
negative: where a fit drives it below zero, the step goes the other way.

A text is the set of its words and of their beginnings. Members of a small ensemble
are fitted in tasks of their own, in numpy, each on its own bounded sample (at most
``POSITIVES`` confirmed and ``UNLABELLED`` other texts, the first by a hash of
their id); the mean of the members scores every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm._common import ship, staged

ship(__name__)

MEMBERS = 3
POSITIVES, UNLABELLED = 4_000, 8_000      # bound of a member's sample
FEATURES = 4_096                          # bound of a member's features
LEAST = 4                                 # confirmed texts that a feature needs
LEAST_GAIN = 5.0                          # nats by which it must tell them apart
STARTS = (4, 5, 6)                        # lengths of word beginnings
THRESHOLD = 0.7
_STEPS, _RATE, _SHRINK = 150, 0.1, 1e-4


def held_out(doc_id: Column) -> Column:
    """Rows no label is learned from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


# --- features ---------------------------------------------------------------

_hash = xxhash.xxh64_intdigest


def _features(word: str) -> list[int]:
    """A word and its beginnings, as hashes."""
    size = len(word)
    return [_hash(word) >> 1, *[_hash(word[:n], 1) >> 1 for n in STARTS if n <= size]]


def _words(texts) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """The words of many texts in order: their rows, their numbers, distinct words."""
    low = pc.utf8_lower(pc.fill_null(texts, ""))
    lists = pc.split_pattern_regex(low, r"[^\p{L}\p{N}]+")
    coded = pc.list_flatten(lists).dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    words = coded.dictionary.to_pylist()
    row = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype("int64")
    return row, coded.indices.to_numpy(zero_copy_only=False).astype("int64"), words


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(member, positive, text)`` to ``(member, positive, features)``."""
    for b in batches:
        for at in range(0, b.num_rows, 500):
            part = b.slice(at, 500)
            rows, numbers, words = _words(part.column("text"))
            known = [_features(w) if w else [] for w in words]
            cuts = np.searchsorted(rows, np.arange(part.num_rows + 1))
            sets = [sorted({f for n in set(numbers[s:e].tolist()) for f in known[n]})
                    for s, e in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [part.column("member"), part.column("positive"), pa.array(sets, pa.list_(pa.int64()))],
                ["member", "positive", "features"])


# --- fit --------------------------------------------------------------------

def _log_loss(f: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, -f)


def _up(f: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(f, -60, 60)))


def fit_pu(rows: np.ndarray, cols: np.ndarray, positive: np.ndarray, n_features: int, prior: float,
           steps: int = _STEPS) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear scorer over 0/1 features (``rows``, ``cols`` name
    the ones) by the non-negative risk; full-batch Adam."""
    n = len(positive)
    in_pos, in_unl = positive / max(1, positive.sum()), ~positive / max(1, (~positive).sum())
    w = np.zeros(n_features + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        f = np.bincount(rows, weights=w[cols], minlength=n) + w[-1]
        clean = in_unl @ _log_loss(-f) - prior * (in_pos @ _log_loss(-f))
        p = _up(f)
        d_clean = (in_unl - prior * in_pos) * p               # slope of the clean part
        d = -d_clean if clean < 0 else prior * in_pos * (p - 1) + d_clean
        g = np.append(np.bincount(cols, weights=d[rows], minlength=n_features)[:n_features], d.sum())
        if clean >= 0:
            g[:-1] += _SHRINK * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= _RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w[:-1], float(w[-1])


def _choose(rows: np.ndarray, feats: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Features that stand apart in confirmed texts: in at least :data:`LEAST` of them
    and with :data:`LEAST_GAIN` over the unlabelled share, the clearest first."""
    names, at = np.unique(feats, return_inverse=True)
    n_pos, n_unl = max(1, positive.sum()), max(1, (~positive).sum())
    a = np.bincount(at, weights=positive[rows], minlength=len(names))
    b = np.bincount(at, weights=~positive[rows], minlength=len(names))
    share, other = (a + 0.5) / (n_pos + 1), (b + 0.5) / (n_unl + 1)
    gain = a * np.log(share / other)
    good = np.flatnonzero((a >= LEAST) & (gain >= LEAST_GAIN))
    best = good[np.lexsort((names[good], -gain[good]))][:FEATURES]
    return np.sort(names[best])


def _fit_member(prior: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lists = [np.asarray(x, dtype="int64") for x in pdf["features"]]
        positive = pdf["positive"].to_numpy(dtype=bool)
        rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        feats = np.concatenate([*lists, np.empty(0, "int64")])
        names = _choose(rows, feats, positive) if len(feats) else feats
        at = np.minimum(np.searchsorted(names, feats), max(0, len(names) - 1))
        hit = names[at] == feats if len(names) else np.zeros(len(feats), dtype=bool)
        w, bias = fit_pu(rows[hit], at[hit], positive, len(names), prior)
        return pd.DataFrame({"names": [names.tolist()], "weights": [w.tolist()], "bias": [bias]})
    return run


def train(docs: DataFrame, labels: DataFrame, members: int = MEMBERS, positives: int = POSITIVES,
          unlabelled: int = UNLABELLED) -> list[tuple[list[int], list[float], float]]:
    """The fitted members, as ``(features, weights, bias)``.

    Learns from rows that are not held out only. The class prior is the toxic share of
    the labelled ids. Without a confirmed text there is no member.
    """
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    known = (labels.select(doc_id, F.col("toxic").cast("int").alias("toxic"))
             .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    known = staged(known, "toxic-labels")
    n, n_toxic = known.agg(F.count(F.lit(1)), F.count_if(F.col("toxic") == 1)).first()
    if not n_toxic:
        return []
    prior = min(0.5, max(0.001, n_toxic / n))
    texts = docs.select(doc_id, F.col("text").cast("string").alias("text")).where(~held_out(F.col("doc_id")))
    confirmed = known.where("toxic = 1").select("doc_id")
    others = texts.select("doc_id").where("doc_id IS NOT NULL").distinct()

    def first(ids: DataFrame, member: int, size: int, positive: bool) -> DataFrame:
        rank = F.xxhash64("doc_id", F.lit(member), F.lit(positive))
        return (ids.orderBy(rank, "doc_id").limit(size)
                .select("doc_id", F.lit(member).alias("member"), F.lit(positive).alias("positive")))

    sample = None
    for k in range(members):
        both = first(confirmed, k, positives, True).unionByName(first(others, k, unlabelled, False))
        sample = both if sample is None else sample.unionByName(both)
    # at most members * (positives + unlabelled) ids, a documented bound
    chosen = texts.join(F.broadcast(staged(sample, "toxic-sample")), "doc_id").select("member", "positive", "text")
    hashed = chosen.mapInArrow(_hashed, "member int, positive boolean, features array<long>")
    fitted = hashed.groupBy("member").applyInPandas(
        _fit_member(prior), "names array<long>, weights array<double>, bias double")
    return [tuple(r) for r in fitted.collect()]


# --- score ------------------------------------------------------------------

def _score(model):
    names = sorted({n for m in model for n in m[0]})
    place = {n: i for i, n in enumerate(names)}
    weights = np.zeros((len(names), len(model)))
    for k, (own, w, _) in enumerate(model):
        weights[[place[n] for n in own], k] = w
    bias = np.array([m[2] for m in model])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = place.get
        for b in batches:
            scores = []
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                rows, numbers, words = _words(part.column("text"))
                hits = [[i for i in map(find, _features(w)) if i is not None] for w in words]
                count = np.array([len(h) for h in hits], dtype="int64")
                flat = np.array([i for h in hits for i in h], dtype="int64")
                start = np.cumsum(count) - count
                telling = count[numbers] > 0
                rows, numbers = rows[telling], numbers[telling]
                times = count[numbers]
                rows = np.repeat(rows, times)
                inner = np.arange(len(rows)) - np.repeat(np.cumsum(times) - times, times)
                cols = flat[np.repeat(start[numbers], times) + inner]
                pairs = np.unique(rows * max(1, len(names)) + cols)     # a feature counts once a text
                rows, cols = pairs // max(1, len(names)), pairs % max(1, len(names))
                f = np.stack([np.bincount(rows, weights=weights[cols, k], minlength=part.num_rows)
                              for k in range(len(bias))], axis=1) + bias
                scores.append(_up(f).mean(axis=1))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.concatenate([*scores, np.empty(0)]))], ["doc_id", "score"])
    return run


def score(docs: DataFrame, model) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs(doc_id, text)``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if model:
        scored = rows.mapInArrow(_score(model), "doc_id long, score double")
    else:
        scored = rows.select("doc_id", F.lit(0.0).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every text of ``docs(doc_id, text)`` after learning from
    ``labels(doc_id, toxic)``.

    Each row is scored by its own text alone: null or empty texts get the score of no
    feature, repeated rows the same one, long texts are read whole. An id with
    several labels is toxic if any says so; labels without text, null ids and null
    labels teach nothing, and a row without an id is never held out. Without a
    confirmed text all scores are 0. Other columns are not read; an empty table
    gives no rows.
    """
    return score(docs, train(docs, labels))
