"""Quality rules on tokeniser fertility.

A public vocabulary measures how a text falls apart: characters per token, the
share of byte-fallback tokens and the entropy of the tokens used. Each language
(or, where it is unknown, script) has a band for each measure; a text outside a
band is rejected. Two plain rules stand before the bands: fewer than ten words,
and more than a fifth of the words inside repeated five-word windows.

One pass, no shuffle: every measure is a text's own, the bands are parameters.
Words are tokenised one by one and remembered, which gives the same pieces as
the whole text with single blanks, as pieces never cross a blank.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm._common import WHITE, byte_words, filter_rows, ship, tokenizer_file

ship(__name__)

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
_REMEMBER = 400_000

# Rejection bands: characters per token (low, high), largest byte-fallback
# share, and token entropy as a share of the greatest possible for the number
# of tokens (low, high). By language, then by script, then for anything else.
# A mean over n tokens scatters by about 1/sqrt(n), so the low fertility edge
# gives way by NOISE / sqrt(tokens) and short texts are not rejected by chance.
NOISE = 4.0
BANDS = {
    "en": ((2.08, 8.0), 0.10, (0.40, 1.0)),
    "de": ((2.10, 8.0), 0.10, (0.40, 1.0)),
    "es": ((1.81, 8.0), 0.10, (0.40, 1.0)),
    "fr": ((1.84, 8.0), 0.10, (0.40, 1.0)),
    "Latin": ((1.40, 8.0), 0.15, (0.40, 1.0)),
    "Greek": ((0.50, 6.0), 0.50, (0.35, 1.0)),
    "Cyrillic": ((1.00, 6.0), 0.20, (0.40, 1.0)),
    "Arabic": ((0.40, 5.0), 0.60, (0.35, 1.0)),
    "Han": ((0.15, 3.0), 0.80, (0.30, 1.0)),
    "Kana": ((0.20, 3.0), 0.70, (0.30, 1.0)),
    "Hangul": ((0.10, 3.0), 0.90, (0.30, 1.0)),
    "other": ((0.00, 10.0), 1.00, (0.25, 1.0)),
}
# Where the letters of a script lie (first and last code point).
SCRIPTS = (("Latin", 0x41, 0x24F), ("Greek", 0x370, 0x3FF), ("Cyrillic", 0x400, 0x52F),
           ("Arabic", 0x600, 0x6FF), ("Kana", 0x3040, 0x30FF), ("Han", 0x4E00, 0x9FFF),
           ("Hangul", 0xAC00, 0xD7AF))

OUT = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
       "n_repeat_words long, base_failed boolean, kept boolean, band string, n_tokens long, "
       "chars_per_token double, byte_share double, token_entropy double")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside a window of ``window`` words that the text has twice or more.

    Windows are sifted by a rolling hash; only those whose hash occurs twice are
    compared as words, so the count is exact.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    one = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    mixed = np.zeros(n, dtype=np.uint64)
    for k in range(window):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + one[k:k + n]
    order = np.argsort(mixed, kind="stable")
    same = mixed[order[1:]] == mixed[order[:-1]]
    if not same.any():
        return 0
    maybe = np.zeros(n, dtype=bool)
    maybe[order[1:][same]] = maybe[order[:-1][same]] = True
    at = np.flatnonzero(maybe).tolist()
    runs = [tuple(words[i:i + window]) for i in at]
    seen = Counter(runs)
    covered = end = 0
    for i, run in zip(at, runs):
        if seen[run] > 1:
            covered += i + window - max(i, end)
            end = i + window
    return covered


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    return len(lines) - len(set(lines))


def script_of(text: str) -> str:
    """The script of most letters of a text; "other" if it has none of them."""
    seen: Counter = Counter()
    for ch, n in Counter(text).items():
        if ch.isalpha():
            code = ord(ch)
            seen[next((s for s, lo, hi in SCRIPTS if lo <= code <= hi), "other")] += n
    return max(seen, key=lambda s: (seen[s], s)) if seen else "other"


class Pieces(dict):
    """Word -> its piece ids as bytes of 16-bit numbers, remembered."""

    def __init__(self, path: str):
        import sentencepiece
        super().__init__()
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.sp.get_piece_size()
        self.low = np.array([self.sp.is_byte(i) for i in range(self.size)])
        self.chars = np.array([0 if self.low[i] else sum(map(str.isalnum, self.sp.id_to_piece(i)))
                               for i in range(self.size)])

    def __missing__(self, word: bytes) -> bytes:
        ids = self.sp.encode(word.decode("utf-8", "surrogatepass"))
        return np.array(ids, dtype=np.uint16).tobytes()

    def learn(self, texts: list[list[bytes]]) -> None:
        """Tokenise the new words of many texts in one call."""
        new = [w for w in set().union(*texts) if w not in self and len(w) <= 64]
        if len(self) + len(new) > _REMEMBER:
            self.clear()
        for at in range(0, len(new), 10_000):
            part = new[at:at + 10_000]
            found = self.sp.encode([w.decode("utf-8", "surrogatepass") for w in part],
                                   num_threads=1)
            self.update(zip(part, (np.array(x, dtype=np.uint16).tobytes() for x in found)))

    def measure(self, words: list[bytes]) -> tuple[int, float, float, float]:
        """Tokens, characters per token (letters and digits that whole pieces
        carry), byte share, entropy as a share of the greatest."""
        ids = np.frombuffer(b"".join(map(self.__getitem__, words)), dtype=np.uint16)
        if not len(ids):
            return 0, 0.0, 0.0, 0.0
        seen = np.bincount(ids, minlength=self.size)
        low = int(seen[self.low].sum())
        chars = int(seen @ self.chars)
        seen = seen[seen > 0].astype(np.float64)
        bits = math.log2(len(ids)) - float((seen * np.log2(seen)).sum()) / len(ids)
        most = math.log2(min(len(ids), self.size))
        return len(ids), chars / len(ids), low / len(ids), (bits / most if most > 0 else 1.0)


def judge_all(texts: list, langs: list, pieces: Pieces, bands: dict) -> Iterator[tuple]:
    for at in range(0, len(texts), 500):
        words = [byte_words(t) for t in texts[at:at + 500]]
        pieces.learn(words)
        for t, w, g in zip(texts[at:at + 500], words, langs[at:at + 500]):
            yield judge(t or "", w, g, pieces, bands)


def judge(text: str, words: list[bytes], lang: str | None, pieces: Pieces, bands: dict) -> tuple:
    """The values of :data:`OUT` after doc_id for one text."""
    chars = len(text) - sum(text.count(c) for c in WHITE)
    repeats = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * len(words)
    band = lang if lang in bands else script_of(text)
    band = band if band in bands else "other"
    tokens, fertility, low, entropy = pieces.measure(words)
    (f_lo, f_hi), most, (e_lo, e_hi) = bands[band]
    f_lo -= NOISE / math.sqrt(max(tokens, 1))
    good = f_lo <= fertility <= f_hi and low <= most and e_lo <= entropy <= e_hi
    return (len(words), chars, sum(text.count(c) for c in SYMBOLS), repeated_lines(text), repeats,
            failed, bool(good and not failed), band, tokens, fertility, low, entropy)


def quality(docs: DataFrame, path: str | None = None, bands: dict | None = None) -> DataFrame:
    """One row of :data:`OUT` per input row.

    ``docs`` needs ``doc_id, text`` and may have ``lang``; other columns are not
    read. A null text counts as empty (no words: rejected by the first rule), an
    unknown or null language is judged by its script's band, repeated rows are
    judged alike. ``path`` is the vocabulary file (a sentencepiece model).
    """
    path, bands = path or tokenizer_file("piece_bpe_32k.model"), bands or BANDS
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(path)
        for b in batches:
            rows = list(judge_all(b.column(1).to_pylist(), b.column(2).to_pylist(), pieces, bands))
            cols = list(zip(*rows)) if rows else [()] * 12
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.string(), pa.int64()] + [pa.float64()] * 3
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                [x.split()[0] for x in OUT.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"),
                       lang.cast("string").alias("lang")).mapInArrow(run, OUT)


def keep_good(docs: DataFrame, path: str | None = None, bands: dict | None = None) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns; no shuffle."""
    path, bands = path or tokenizer_file("piece_bpe_32k.model"), bands or BANDS
    names = docs.columns
    at, lang = names.index("text"), names.index("lang") if "lang" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(path)
        for b in batches:
            langs = [None] * b.num_rows if lang is None else b.column(lang).to_pylist()
            good = [r[6] for r in judge_all(b.column(at).to_pylist(), langs, pieces, bands)]
            yield b.filter(pa.array(good, pa.bool_()))

    return filter_rows(docs, run)
