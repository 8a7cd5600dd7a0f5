"""Edit-aware token counts.

A document keeps a segment tree over its pre-tokens: leaves are stretches of
text with their lengths and token counts, inner nodes the sums. A leaf ends
where a blank or line feed follows a character that is no white space; the
vocabulary's splitter always starts a new pre-token there, whatever stands
around, so leaves are encoded on their own and their counts add up exactly.

An edit touches the leaves that hold its range and the character before and
after it (the boundary context: only there can a leaf's end stop being one).
After a run of edits those leaves are cut and encoded anew, once, and the sums
above them updated; all other leaves keep their counts. The count after any number of edits equals that of
encoding the edited text from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.llm._common import match_spans, ship, tokenizer_file

ship(__name__)

LEAF_CHARS = 512
TREE = "doc_id long, leaf_chars array<int>, leaf_tokens array<int>, n_tokens long"
EDIT = "array<struct<start:int,end:int,new:string>>"
OUT = ("doc_id long, tokens_before long, tokens_after long, n_edits long, n_leaves long, "
       "leaves_encoded long, chars_encoded long, chars_after long")


def load_encoding(path: str):
    import base64

    import public_tokenizers
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def leaf_lengths(text: str, least: int = LEAF_CHARS) -> list[int]:
    """Lengths of the leaves of a text: the first safe cut from ``least``
    characters on. An empty text has no leaf."""
    out, begin, n = [], 0, len(text)
    while begin < n:
        at = begin + least
        while at < n and not (text[at] in " \n" and not text[at - 1].isspace()
                              and text[at - 1] not in "\x1c\x1d\x1e\x1f"):
            at += 1
        out.append(min(at, n) - begin)
        begin = min(at, n)
    return out


class Tree:
    """Leaves with lengths and token counts, and their sums. Leaves are kept in a
    binary tree over arrays; a leaf that an edit removed has length zero."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.load(list(zip(chars, tokens)))

    def load(self, leaves: list[tuple[int, int]]) -> None:
        self.size = 1
        while self.size < max(1, len(leaves)):
            self.size *= 2
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for i, (c, t) in enumerate(leaves):
            self.chars[self.size + i], self.tokens[self.size + i] = c, t
        for i in range(self.size - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at``, and where it starts."""
        i, start = 1, 0
        while i < self.size:
            i *= 2
            if at - start >= self.chars[i] and start + self.chars[i] < self.chars[1]:
                start += self.chars[i]
                i += 1
        return i - self.size, start

    def set(self, leaf: int, chars: int, tokens: int) -> None:
        i = self.size + leaf
        self.chars[i], self.tokens[i] = chars, tokens
        while i > 1:
            i //= 2
            self._sum(i)

    def leaves(self) -> list[tuple[int, int]]:
        return [(c, t) for c, t in zip(self.chars[self.size:], self.tokens[self.size:]) if c]


def build(text: str, enc) -> Tree:
    chars, at, tokens = leaf_lengths(text), 0, []
    for n in chars:
        tokens.append(len(enc.encode_ordinary(text[at:at + n])))
        at += n
    return Tree(chars, tokens)


def splice(tree: Tree, dirty: set[int], text: str, start: int, end: int, new: str) -> str:
    """Replace ``text[start:end]`` by ``new``. The first leaf that the edit or its
    boundary context touches takes the others' characters and is dirty until
    :func:`settle`. Ranges are cut to the text."""
    n = len(text)
    start = min(max(start, 0), n)
    end = min(max(end, start), n)
    if start == end and not new:
        return text
    first = tree.find(max(start - 1, 0))[0]
    last = tree.find(min(end, n - 1))[0] if n else first
    chars = sum(tree.chars[tree.size + k] for k in range(first, last + 1))
    for k in range(first + 1, last + 1):
        if tree.chars[tree.size + k]:
            tree.set(k, 0, 0)
        dirty.discard(k)
    tree.set(first, chars + len(new) - (end - start), 0)
    dirty.add(first)
    return text[:start] + new + text[end:]


def settle(tree: Tree, dirty: set[int], text: str, enc) -> tuple[int, int]:
    """Cut and encode the dirty leaves anew and update the sums above them: how
    many leaves and characters were encoded."""
    fresh, total = {}, 0
    for k in sorted(dirty):
        begin, i = 0, tree.size + k
        while i > 1:                                     # what stands left of leaf k
            if i % 2:
                begin += tree.chars[i - 1]
            i //= 2
        region = text[begin:begin + tree.chars[tree.size + k]]
        at, total, fresh[k] = 0, total + len(region), []
        for c in leaf_lengths(region):
            fresh[k].append((c, len(enc.encode_ordinary(region[at:at + c]))))
            at += c
    count = sum(map(len, fresh.values()))
    if all(len(x) <= 1 for x in fresh.values()):
        for k, x in fresh.items():
            tree.set(k, *(x[0] if x else (0, 0)))
    else:                                                # a leaf became several: load anew
        row = list(zip(tree.chars[tree.size:], tree.tokens[tree.size:]))
        tree.load([y for k, x in enumerate(row) for y in fresh.get(k, [x] if x[0] else [])])
    dirty.clear()
    return count, total


def trees(docs: DataFrame, path: str | None = None) -> DataFrame:
    """:data:`TREE` per input row: the leaves of each document's tree, to be kept
    beside the documents. Null texts are empty: no leaf, no token."""
    path = path or tokenizer_file("byte_bpe_50k.tiktoken")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = load_encoding(path)
        for b in batches:
            rows = [build(t or "", enc).leaves() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([[c for c, _ in r] for r in rows], pa.list_(pa.int32())),
                 pa.array([[t for _, t in r] for r in rows], pa.list_(pa.int32())),
                 pa.array([sum(t for _, t in r) for r in rows], pa.int64())],
                [x.split()[0] for x in TREE.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, TREE)


def recount(rows: DataFrame, path: str | None = None) -> DataFrame:
    """Counts after edits, :data:`OUT` per row of ``rows(doc_id, text, edits)``,
    with or without the kept ``leaf_chars`` and ``leaf_tokens``.

    ``edits`` is an array of ``(start, end, new)``, applied in order, each to the
    text as the ones before left it. Null texts, edits and replacements are
    empty; ranges are cut to the text, an end before its start counts as the
    start. A tree that is missing or does not fit its text's length is built.
    """
    path = path or tokenizer_file("byte_bpe_50k.tiktoken")
    kept = {"leaf_chars", "leaf_tokens"} <= set(rows.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = load_encoding(path)
        for b in batches:
            out = []
            for name, text, edits, chars, tokens in zip(*(b.column(i).to_pylist() for i in range(5))):
                text = text or ""
                fits = chars is not None and tokens is not None and len(chars) == len(tokens) \
                    and sum(chars) == len(text)
                tree = Tree(chars, tokens) if fits else build(text, enc)
                before, dirty = tree.tokens[1], set()
                for e in edits or ():
                    if e is not None:
                        text = splice(tree, dirty, text, e["start"] or 0, e["end"] or 0,
                                      e["new"] or "")
                leaves, encoded = settle(tree, dirty, text, enc)
                out.append((name, before, tree.tokens[1], len(edits or ()), len(tree.leaves()),
                            leaves, encoded, len(text)))
            cols = list(zip(*out)) if out else [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             [x.split()[0] for x in OUT.split(", ")])

    none = F.lit(None).cast("array<int>")
    return rows.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("edits").cast(EDIT),
        F.col("leaf_chars").cast("array<int>") if kept else none.alias("leaf_chars"),
        F.col("leaf_tokens").cast("array<int>") if kept else none.alias("leaf_tokens"),
    ).mapInArrow(run, OUT)


def with_trees(rows: DataFrame, path: str | None = None) -> DataFrame:
    """``rows(text, ...)`` with their trees beside them, in the same task (no join).

    The trees are ``leaf_chars`` and ``leaf_tokens``; columns of these names that
    ``rows`` has already are replaced. A null text has the tree of an empty one, long
    texts are read whole, repeated rows get equal trees.
    """
    rows = rows.drop("leaf_chars", "leaf_tokens")
    path = path or tokenizer_file("byte_bpe_50k.tiktoken")
    at = rows.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = load_encoding(path)
        for b in batches:
            found = [build(t or "", enc).leaves() for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([[c for c, _ in r] for r in found], pa.list_(pa.int32())),
                 pa.array([[t for _, t in r] for r in found], pa.list_(pa.int32()))],
                [*b.schema.names, "leaf_chars", "leaf_tokens"])

    more = [T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("leaf_chars", "leaf_tokens")]
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *more]))


def replacements(text: Column, pattern: str, new: str) -> Column:
    """Edits that replace every match of a pattern, last match first (so that
    each range holds when its turn comes)."""
    return F.transform(F.reverse(match_spans(text, pattern)), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.lit(new).alias("new")))
