"""Bounded-space online packing of tokenised documents.

Each task reads its documents once, in file order, and keeps a fixed number of
open windows. A piece goes into the open window it fits best; if it fits none, a
new window is opened, and where the windows are used up the fullest is emitted
first. Windows still open at the end of a task are leftovers: their pieces are
merged in groups of bounded size, best fit by falling length. Only a document
longer than a window is cut.

Neither step groups by a key of the data, so copies, hot sources and long texts
do not make a large task; the state of a task is its open windows.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm._common import ship, shuffle_partitions, staged, tokenizer_file

ship(__name__)

WINDOW = 2048
OPEN_WINDOWS = 64
END_ID = 1
MERGE_TOKENS = 1 << 18
_REMEMBER = 300_000                                      # words of one generation
_ID = 4                                                  # bytes of a token id

PIECE = ("doc_id long, start long, length long, doc_tokens long, ids binary, "
         "part long, window long, offset long, open boolean")
OUT = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


# What the vocabulary's splitter takes as one token to merge: letters, a digit,
# other signs. Words with an apostrophe (contractions) go the long way.
_UNITS = re.compile(r"[^\W\d_]+|[0-9]|[!-&(-/:-@\[-`{-~]+")


def _byte_signs() -> list[str]:
    """The sign that stands for each byte in a byte-level vocabulary: printable
    ones for themselves, the others numbered from 256."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class WordIds(dict):
    """Word -> its token ids as little-endian 32-bit numbers, remembered.

    The vocabulary's splitter never joins characters across white space, so the
    ids of a text are those of its words one after another. Plain words are
    parted into the splitter's units, which are merged by the model and shared
    between words; any other word (a contraction, a special token's string, signs
    that normalising may change) is encoded by the whole tokenizer.
    """

    def __init__(self, path: str):
        import tokenizers
        super().__init__()
        self.tok = tokenizers.Tokenizer.from_file(path)
        self.merge = self.tok.model.tokenize
        self.old: dict[bytes, bytes] = {}
        self.units: dict[str, bytes] = {}
        self.signs = _byte_signs()

    @staticmethod
    def _pack(ids: list[int]) -> bytes:
        out = array("I", ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _whole(self, word: bytes) -> bytes:
        return self._pack(self.tok.encode(word.decode("utf-8", "surrogatepass"),
                                          add_special_tokens=False).ids)

    def _unit(self, unit: str) -> bytes | None:
        """Ids of one unit in lower case; None where normalising may change it."""
        shown = unit
        if not unit.isascii():
            if not unit.isalpha() or not unicodedata.is_normalized("NFC", unit) or "\u03c2" in unit:
                return None
            signs = self.signs
            shown = "".join([signs[b] for b in unit.encode()])
        out = self.units[unit] = self._pack([t.id for t in self.merge(shown)])
        return out

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "surrogatepass")
        low = text.lower()
        units = _UNITS.findall(low)
        if len(low) == len(text) and sum(map(len, units)) == len(low) and "<|" not in low:
            out, known = [], self.units
            for u in units:
                ids = known.get(u) or self._unit(u)
                if ids is None:
                    break
                out.append(ids)
            else:
                return b"".join(out)
        return self._whole(word)

    def find(self, word: bytes) -> bytes:
        """A word's ids, remembered in two generations: when the young one is full it
        becomes the old one, so words still in use stay known."""
        ids = self.get(word)
        if ids is None:
            ids = self.old.get(word)
            if ids is None:
                ids = self._word(word)
            if len(word) <= 64:
                if len(self) >= _REMEMBER:
                    self.old = dict(self)
                    self.clear()
                    self.units.clear()
                self[word] = ids
        return ids

    def texts(self, texts: pa.Array) -> list[bytes]:
        """The ids of many texts. Words are parted and counted as distinct values in
        Arrow, so only distinct words are looked up; the ids of all words taken in
        order lie one after another, and a text's are a range of them."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
        words = pc.list_flatten(lists).dictionary_encode()
        known, find = self.get, self.find
        ids = pa.array([known(w) or (find(w) if w else b"")
                        for w in words.dictionary.cast(pa.large_binary()).to_pylist()], pa.large_binary())
        if not len(words):
            return [b""] * len(texts)
        _, ends, data = ids.take(words.indices).buffers()
        ends, data = np.frombuffer(ends, dtype="int64"), memoryview(data or b"")
        cuts = ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()].tolist()
        return [bytes(data[s:e]) for s, e in zip(cuts[:-1], cuts[1:])]


class Windows:
    """Open windows of ``size`` tokens, at most ``limit`` at once (None: any
    number). ``put`` returns the windows that were emitted."""

    def __init__(self, size: int, limit: int | None):
        self.size, self.limit = size, limit
        self.free: list[tuple[int, int]] = []            # (room, window), sorted
        self.rows: dict[int, list[tuple]] = {}
        self.next = 0

    def put(self, length: int, row: tuple) -> list[tuple[int, list[tuple]]]:
        out = []
        at = bisect_left(self.free, (length, -1))
        if at < len(self.free):
            room, w = self.free.pop(at)
        else:
            if self.limit is not None and len(self.free) >= self.limit:
                _, fullest = self.free.pop(0)
                out.append((fullest, self.rows.pop(fullest)))
            room, w = self.size, self.next
            self.next += 1
            self.rows[w] = []
        self.rows[w].append((*row, self.size - room))
        if room == length:
            out.append((w, self.rows.pop(w)))
        else:
            insort(self.free, (room - length, w))
        return out

    def rest(self) -> list[tuple[int, list[tuple]]]:
        out = [(w, self.rows.pop(w)) for _, w in self.free]
        self.free.clear()
        return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.binary()] + [pa.int64()] * 3 + [pa.bool_()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
        [x.split()[0] for x in PIECE.split(", ")])


def _place(path: str, window: int, open_windows: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # a task has one core
        part, last = TaskContext.get().partitionId(), end.to_bytes(_ID, "little")
        known, bins, rows = WordIds(path), Windows(window, open_windows), []

        def emit(closed, still_open):
            for w, members in closed:
                rows.extend((*m[:5], part, w, m[5], still_open) for m in members)

        for b in batches:
            names = b.column(0).to_pylist()
            for at in range(0, b.num_rows, 500):
                for name, ids in zip(names[at:at + 500], known.texts(b.column(1).slice(at, 500))):
                    ids += last
                    total = len(ids) // _ID
                    for s in range(0, total, window):
                        piece = ids[s * _ID:(s + window) * _ID]
                        n = len(piece) // _ID
                        emit(bins.put(n, (name, s, n, total, piece)), False)
                if len(rows) > 2000:
                    yield _batch(rows)
                    rows.clear()
        emit(bins.rest(), True)
        if rows:
            yield _batch(rows)
    return run


def _merge(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (group, falling length); a group is a few hundred windows."""
        group, bins, rows = None, Windows(window, None), []

        def finish():
            for w, members in sorted(bins.rest()):
                rows.extend((*m[:5], group, w, m[5], False) for m in members)

        for b in batches:
            for g, *row in zip(*(b.column(i).to_pylist() for i in range(6))):
                if g != group:
                    finish()
                    group, bins = g, Windows(window, None)
                for w, members in bins.put(row[2], tuple(row)):
                    rows.extend((*m[:5], group, w, m[5], False) for m in members)
            if len(rows) > 2000:
                yield _batch(rows)
                rows.clear()
        finish()
        if rows:
            yield _batch(rows)
    return run


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW,
         open_windows: int = OPEN_WINDOWS, end_id: int = END_ID) -> DataFrame:
    """Pieces of ``docs(doc_id, text)`` in sequences of at most ``window`` tokens.

    Columns :data:`OUT`: ``start`` counts the document's ids before the piece,
    ``offset`` the sequence's, ``ids`` holds the piece's ids as little-endian
    32-bit numbers, ``doc_tokens`` the document's ids with the end id. Null or
    empty texts are the end id alone; each input row is a document of its own,
    whatever its doc_id; extra columns are not read.
    """
    spark = docs.sparkSession
    path = path or tokenizer_file("word_bpe_49k.json")
    placed = staged(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .mapInArrow(_place(path, window, open_windows, end_id), PIECE), "packed")
    left = placed.where("open")
    tokens = left.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    groups = max(1, -(-tokens // MERGE_TOKENS))
    merged = (left.withColumn("grp", F.pmod(F.xxhash64("part", "window", "offset"),
                                            F.lit(groups)))
              .repartition(min(groups, shuffle_partitions(spark)), "grp")
              .sortWithinPartitions("grp", F.desc("length"), "doc_id", "start", "part", "window",
                                    "offset")
              .select("grp", "doc_id", "start", "length", "doc_tokens", "ids")
              .mapInArrow(_merge(window), PIECE))
    # sequence numbers: task or group, then window; groups have the next bit set
    number = F.shiftleft(F.col("part"), 32) + F.col("window")
    return (placed.where("NOT open").withColumn("sequence_id", number)
            .unionByName(merged.withColumn("sequence_id", number + F.lit(1 << 62)))
            .select(*[x.split()[0] for x in OUT.split(", ")]))
