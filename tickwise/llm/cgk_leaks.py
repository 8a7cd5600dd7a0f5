"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

Words are the symbols. The CGK random walk copies a window's words one by one
and, by a random bit for each (step, word), stays or moves on; two windows at a
small edit distance then agree at most steps, so edit distance becomes Hamming
distance. Keys sample a few steps of the walk; several walks with several
samples each give the repetitions that reach the target recall. Texts and items
that share a key are candidates, and an exact edit distance (bit-parallel, over
words) decides: an item leaks if some stretch of the text is within
``floor(0.2 * words)`` edits of it, i.e. at similarity 0.8 or more.

Windows are item-sized: items are grouped into classes of like length. Windows
start at every word; those that cannot hold a leak are skipped without loss, as
an item of n words within k edits shares at least ``n - q + 1 - q * k`` of its
q-grams with the window.

The benchmark is a stated query set. It is read in blocks of bounded bytes, each
block is broadcast, and every document is met by every block inside its own
task: no shuffle, no group, no pairs of documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm._common import filter_rows, plain_words, ship

ship(__name__)

EDIT_SHARE = 0.2
WALKS = 8
SAMPLES = 6
SAMPLED_STEPS = 2
CLASS_RATIO = 1.3
BLOCK_BYTES = 1 << 20            # of item text; its index takes about 20 times that
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    return x ^ (x >> np.uint64(27))


def _grams(ids: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit code for the q words from each place; 0 where a word is unknown."""
    n = len(ids) - q + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out, known = np.zeros(n, dtype=np.uint64), np.ones(n, dtype=bool)
    for k in range(q):
        part = ids[k:k + n]
        out = _mix(out * _M1 + part.astype(np.uint64))
        known &= part > 0
    out[~known] = 0
    return out


def walk_keys(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, steps: int, seed: int,
              samples: int, per: int) -> np.ndarray:
    """(len(starts), samples) keys of the CGK walks over ``ids[start:end]``.

    Beyond the end a walk copies a padding word. The random bits come from a
    hash of (seed, step, word), the sampled steps from the seed.
    """
    rng = np.random.default_rng(seed)
    chosen = rng.integers(0, steps, size=(samples, per))
    wanted: dict[int, list[int]] = {}
    for k, row in enumerate(chosen):
        for j in row:
            wanted.setdefault(int(j), []).append(k)
    at = starts.astype(np.int64).copy()
    keys = np.zeros((len(starts), samples), dtype=np.uint64)
    for j in range(max(wanted) + 1):
        inside = at < ends
        word = np.where(inside, ids[np.minimum(at, len(ids) - 1)], -1).astype(np.uint64)
        for k in wanted.get(j, ()):
            keys[:, k] = _mix(keys[:, k] * _M1 + word + np.uint64(j + 1))
        coin = _mix((word + np.uint64(seed * 1_000_003 + j)) * _M1) >> np.uint64(63)
        at += coin.astype(np.int64)
    return keys


class Items:
    """A block of benchmark items, indexed; small enough to broadcast."""

    def __init__(self, items: list[tuple], share: float = EDIT_SHARE, walks: int = WALKS,
                 samples: int = SAMPLES, per: int = SAMPLED_STEPS):
        self.share, self.walks, self.samples, self.per = share, walks, samples, per
        self.words: dict[str, int] = {}
        self.items: list[tuple[int, np.ndarray]] = []
        for item_id, text in items:
            ids = [self.words.setdefault(w, len(self.words) + 1) for w in plain_words(text)]
            if ids:
                self.items.append((item_id, np.array(ids, dtype=np.int64)))
        by: dict[int, list[int]] = {}
        for i, (_, ids) in enumerate(self.items):
            by.setdefault(int(np.log(len(ids)) / np.log(CLASS_RATIO)), []).append(i)
        self.classes = [self._class(c, members) for c, members in sorted(by.items())]
        self.longest = max((len(x) for _, x in self.items), default=1)

    def edits(self, n: int) -> int:
        return int(self.share * n + 1e-9)

    def _class(self, c: int, members: list[int]) -> dict:
        sizes = [len(self.items[i][1]) for i in members]
        q = next(q for q in (3, 2, 1)
                 if all(n - q + 1 - q * self.edits(n) >= 1 for n in sizes) or q == 1)
        need = max(1, min(n - q + 1 - q * self.edits(n) for n in sizes))
        steps = max(4, int(1.7 * min(sizes)))
        tables: list[dict[int, list[int]]] = []
        for w in range(self.walks):
            here: list[dict[int, list[int]]] = [{} for _ in range(self.samples)]
            for i in members:
                ids = self.items[i][1]
                keys = walk_keys(ids, np.array([0]), np.array([len(ids)]), steps, 1000 * c + w,
                                 self.samples, self.per)[0]
                for k, key in enumerate(keys.tolist()):
                    here[k].setdefault(key, []).append(i)
            tables.extend(here)
        sorted_keys = [np.array(sorted(t), dtype=np.uint64) for t in tables]
        grams = np.unique(np.concatenate([_grams(self.items[i][1], q) for i in members]))
        return {"seed": 1000 * c, "q": q, "need": need, "steps": steps, "tables": tables,
                "keys": sorted_keys, "grams": grams[grams > 0],
                "window": max(sizes) + self.edits(max(sizes)), "size": max(sizes)}

    def ids(self, words: list[str]) -> list[int]:
        get = self.words.get
        return [get(w, 0) for w in words]

    def candidates(self, ids: np.ndarray, stop: np.ndarray, cls: dict) -> set[tuple[int, int]]:
        """(start, item) pairs that share a key; ``stop`` ends each place's text."""
        codes = _grams(ids, cls["q"])
        if not len(codes) or not len(cls["grams"]):
            return set()
        place = np.minimum(np.searchsorted(cls["grams"], codes), len(cls["grams"]) - 1)
        hit = (cls["grams"][place] == codes) & (codes > 0)
        if not hit.any():
            return set()
        total = np.concatenate([[0], np.cumsum(hit)])
        at = np.arange(len(codes))
        inside = total[np.minimum(at + cls["window"], len(codes))] - total[at]
        # a leak starts at one of its words, so a start need not lie before the first hit
        starts = np.flatnonzero(inside >= cls["need"])
        found: set[tuple[int, int]] = set()
        for block in range(0, len(starts), 100_000):
            here = starts[block:block + 100_000]
            ends = np.minimum(here + cls["size"], stop[here])
            for w in range(self.walks):
                keys = walk_keys(ids, here, ends, cls["steps"], cls["seed"] + w,
                                 self.samples, self.per)
                for k in range(self.samples):
                    t = w * self.samples + k
                    known = cls["keys"][t]
                    at_key = np.minimum(np.searchsorted(known, keys[:, k]), len(known) - 1)
                    for r in np.flatnonzero(known[at_key] == keys[:, k]).tolist():
                        for i in cls["tables"][t][int(keys[r, k])]:
                            found.add((int(here[r]), i))
        return found


def least_edits(item: list[int], text: list[int]) -> int:
    """Smallest edit distance, in words, of ``item`` to any stretch of ``text``
    (bit-parallel approximate matching)."""
    n = len(item)
    where: dict[int, int] = {}
    for i, w in enumerate(item):
        where[w] = where.get(w, 0) | (1 << i)
    ones, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score = ones, 0, n
    best = n
    for w in text:
        eq = where.get(w, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph, mh = minus | (ones & ~(xh | plus)), plus & xh
        score += 1 if ph & top else -1 if mh & top else 0
        ph, mh = (ph << 1) & ones, (mh << 1) & ones
        plus, minus = mh | (ones & ~(xv | ph)), ph & xv
        best = min(best, score)
    return best


def leaks_of(texts: list, items: Items) -> Iterator[tuple[int, int, int, int]]:
    """(text number, item number, edits, words) for a batch of texts."""
    if not items.items:
        return
    lists = [items.ids(plain_words(t)) for t in texts]
    gap = [0] * (items.longest + 1)                   # no window reaches the next text
    flat: list[int] = []
    begin = []
    for x in lists:
        begin.append(len(flat))
        flat.extend(x)
        flat.extend(gap)
    ids = np.array(flat, dtype=np.int64)
    begins = np.array(begin, dtype=np.int64)
    ends = begins + np.array([len(x) for x in lists], dtype=np.int64)
    stop = np.repeat(ends, np.diff(np.concatenate([begins, [len(ids)]])))
    best: dict[tuple[int, int], int] = {}
    for cls in items.classes:
        pairs: dict[tuple[int, int], list[int]] = {}
        for start, i in items.candidates(ids, stop, cls):
            doc = int(np.searchsorted(begins, start, side="right")) - 1
            pairs.setdefault((doc, i), []).append(start)
        for (doc, i), starts in pairs.items():
            item = items.items[i][1]
            n, k = len(item), items.edits(len(item))
            done, low = -1, n
            for s in sorted(starts):                   # overlapping stretches are read once
                if s <= done:
                    continue
                done = s + n
                lo, hi = max(int(begins[doc]), s - k), min(int(ends[doc]), s + 2 * n + k)
                low = min(low, least_edits(item.tolist(), flat[lo:hi]))
            if low <= k:
                best[doc, i] = min(low, best.get((doc, i), n))
    for (doc, i), low in sorted(best.items()):
        yield doc, i, low, len(items.items[i][1])


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """The items in blocks of bounded size. One partition is held at a time."""
    block, size = [], 0
    for r in benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")) \
            .where(F.col("text").isNotNull()).toLocalIterator():
        block.append((r[0], r[1]))
        size += len(r[1])
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


OUT = "doc_id long, item_id long, edits long, item_words long, similarity double"


def leaks(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(doc_id, item_id, edits, item_words, similarity)``: one row per input
    row and item that leaks into it, with the fewest word edits found.

    Words are lower-case letter/digit runs. Null or word-less texts and items
    match nothing; repeated rows of either table give repeated results; extra
    columns are not read. An empty benchmark gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = None
    for block in item_blocks(benchmark, block_bytes):
        shared = spark.sparkContext.broadcast(cloudpickle.dumps(Items(block)))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = cloudpickle.loads(shared.value)
            for b in batches:
                names, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
                rows = [(names[at + d], items.items[i][0], e, n, 1 - e / n)
                        for at in range(0, len(texts), 1000)
                        for d, i, e, n in leaks_of(texts[at:at + 1000], items)]
                cols = list(zip(*rows)) if rows else [()] * 5
                kinds = [pa.int64()] * 4 + [pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, kinds)],
                    [x.split()[0] for x in OUT.split(", ")])

        part = texts.mapInArrow(run, OUT)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], OUT)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` into which no item leaks, with all their columns; no
    shuffle. Each block of the benchmark filters what the one before kept."""
    spark, at = docs.sparkSession, docs.columns.index("text")
    for block in item_blocks(benchmark, block_bytes):
        shared = spark.sparkContext.broadcast(cloudpickle.dumps(Items(block)))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = cloudpickle.loads(shared.value)
            for b in batches:
                texts = b.column(at).to_pylist()
                clean = np.ones(len(texts), dtype=bool)
                for s in range(0, len(texts), 1000):
                    clean[[s + d for d, *_ in leaks_of(texts[s:s + 1000], items)]] = False
                yield b.filter(pa.array(clean))

        docs = filter_rows(docs, run)
    return docs
