"""Near copies by SimHash with pigeonring filtering.

A text becomes a 64-bit fingerprint; fingerprints within ``max_bits`` differing
bits are linked and the links' components returned. All work after the
fingerprints is done on *distinct* fingerprints, so a group of exact copies
costs one row however large it is.

Candidates follow the pigeonring principle. The 64 bits are a ring of four
16-bit segments. If two fingerprints differ in at most 3 bits, some segment
starts a chain whose first 1, 2, 3 and 4 segments differ in at most
``floor(length * 3 / 4)`` bits together: 0, 1, 2 and 3. The first two steps of
the chain make the join key: one side gives its two segments (32 bits), the
other side the same and each variant with one more bit set in the second
segment (of two keys that differ in one bit exactly one has it clear, so no
other variant is needed). The further steps are checked on the candidates, and
the full Hamming distance last.

A key bucket is compared inside a task, block against block, and gives only the
edges of a spanning forest, never all pairs. A bucket of more than
``block_rows`` fingerprints is split into blocks, each a task-sized group of its
own; every pair of blocks still meets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.llm._common import byte_words, ship, shuffle_partitions, staged

ship(__name__)

SHINGLE = 3
MAX_BITS = 3
SEGMENTS = 4
WIDTH = 16
BLOCK_ROWS = 2048
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of one text; no words: zero."""
    import xxhash
    words = [w.lower() for w in byte_words(text)]       # bytes.lower: A-Z only
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = [b" ".join(g) for g in zip(*(words[k:] for k in range(shingle)))]
    h = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(parts), _CHUNK):
        part = parts[at:at + _CHUNK]
        codes = np.fromiter((h(s, 42) for s in part), dtype="<u8", count=len(part))
        bits = np.unpackbits(codes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    over = (2 * ones > len(parts)).astype(np.uint8)
    return int(np.packbits(over, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        codes = np.array([fingerprint(t) for t in b.column(1).to_pylist()], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(codes.view(np.int64), pa.int64())], ["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp)``, one row per input row; ``fp`` is the fingerprint as a
    signed long."""
    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(_fingerprints, "doc_id long, fp long"))


def _key_rows(fps: DataFrame) -> DataFrame:
    """``(key, probe, fp)``: the chain keys of each fingerprint. ``key`` holds
    the chain's first segment number and the 32 bits of its first two segments."""
    seg = "(shiftrightunsigned(fp, {0}) & 65535L)"
    first, second = seg.format("16 * i"), seg.format("16 * ((i + 1) % 4)")
    base = f"(shiftleft(cast(i as bigint), 32) | shiftleft({first}, 16) | {second})"
    own = f"array(named_struct('key', {base}, 'probe', false))"
    more = (f"transform(filter(sequence(0, 15), b -> (shiftrightunsigned({second}, b) & 1L) = 0),"
            f" b -> named_struct('key', {base} | shiftleft(1L, b), 'probe', true))")
    return (fps.select("fp", F.explode(F.expr(
        f"flatten(transform(sequence(0, 3), i -> concat({own}, {more})))")).alias("k"))
        .select("k.key", "k.probe", "fp"))


def _close(a: np.ndarray, b: np.ndarray, seg: int) -> np.ndarray:
    """Which of a x b pass the chain budgets from ``seg`` on; the last budget is
    the full Hamming check."""
    x = a[:, None] ^ b[None, :]
    ok, total = None, np.zeros(x.shape, dtype=np.uint8)
    for step in range(SEGMENTS):
        shift = np.uint64(WIDTH * ((seg + step) % SEGMENTS))
        total = total + np.bitwise_count((x >> shift) & np.uint64(0xFFFF))
        good = total <= (step + 1) * MAX_BITS // SEGMENTS
        ok = good if ok is None else ok & good
    return ok


def _forest(part: np.ndarray, own: np.ndarray, seg: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links between ``part`` and ``own``."""
    near = _close(part, own, seg)
    if not near.any():
        return []
    top = len(own)
    label = np.arange(top)
    while True:
        low = np.where(near, label[None, :], top).min(axis=1)
        new = np.minimum(label, np.where(near, low[:, None], top).min(axis=0))
        if np.array_equal(new, label):
            break
        label = new
    out = [(int(p), int(own[k])) for p, k in zip(part, low) if k < top and p != own[k]]
    return out + [(int(own[i]), int(own[k])) for i, k in enumerate(label) if i != k]


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, block, probe): one run per bucket block, carried
    over batch edges. Probes beyond a block's worth are compared as they come."""
    out: list[tuple[int, int]] = []
    run, own, probes, begun = None, [], [], False

    def flush():
        nonlocal begun
        if own and len(own) + len(probes) > 1:
            mine, seg = np.array(own, dtype=np.uint64), (run[0] >> 32) & 3
            if not begun and len(own) > 1:
                out.extend(_forest(mine, mine, seg))
            for at in range(0, len(probes), BLOCK_ROWS):
                out.extend(_forest(np.array(probes[at:at + BLOCK_ROWS], dtype=np.uint64),
                                   mine, seg))
            begun = True
        probes.clear()

    def batch():
        a = np.array(out, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], ["u", "v"])

    for b in batches:
        if not b.num_rows:
            continue
        key, blk, probe, fp = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        fp = fp.view(np.uint64)
        cut = np.flatnonzero((key[1:] != key[:-1]) | (blk[1:] != blk[:-1])) + 1
        edges = np.concatenate([[0], cut, [len(key)]])
        size = np.diff(edges)
        # a lone row inside the batch links to nothing; the first and last run may go on
        for r in np.unique(np.concatenate([[0], np.flatnonzero(size > 1), [len(size) - 1]])):
            s, e = int(edges[r]), int(edges[r + 1])
            if run != (int(key[s]), int(blk[s])):
                flush()
                own.clear()
                run, begun = (int(key[s]), int(blk[s])), False
            p = probe[s:e]
            own.extend(fp[s:e][~p].tolist())
            probes.extend(fp[s:e][p].tolist())
            if len(probes) > 4 * BLOCK_ROWS:
                flush()
        if out:
            yield batch()
    flush()
    if out:
        yield batch()


def links(fps: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(u, v)``: edges between distinct fingerprints ``fps(fp)`` whose
    components are those of all pairs within three bits."""
    spark = fps.sparkSession
    rows = _key_rows(fps)
    large = staged(rows.where(~F.col("probe")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
                   .where(F.col("n") > block_rows), "ring-large")
    if large.isEmpty():
        rows = rows.withColumn("blk", F.lit(0))
    else:
        n = F.ceil(F.coalesce(F.col("n"), F.lit(1)) / F.lit(block_rows)).cast("int")
        mine = F.pmod(F.xxhash64("fp"), n).cast("int")
        rows = (rows.join(large, "key", "left")
                .withColumn("mine", mine)
                # an own row stands in its block and visits the later blocks;
                # a probe visits every block
                .withColumn("blk", F.explode(F.when(F.col("probe"), F.sequence(F.lit(0), n - 1))
                                             .otherwise(F.sequence(F.col("mine"), n - 1))))
                .withColumn("probe", F.col("probe") | (F.col("blk") != F.col("mine"))))
    return (rows.select("key", "blk", "probe", "fp")
            .repartition(shuffle_partitions(spark), "key", "blk")
            .sortWithinPartitions("key", "blk", "probe")
            .mapInArrow(_link, "u long, v long")
            .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)``; root is the smallest
    node of the component. Large-star and small-star steps alternate until the
    edges are stars; each round is written to shared storage."""
    def large(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return (both.join(low, "u").where(F.col("v") > F.col("u"))
                .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())

    def small(e):
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        return (e.join(low, "u").where(F.col("v") != F.col("m"))
                .select(F.col("v").alias("u"), F.col("m").alias("v"))
                .unionByName(low.select("u", F.col("m").alias("v"))).distinct())

    def mark(e):
        return e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()

    cur = staged(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .where("u <> v").distinct(), "ring-edges")
    seen = mark(cur)
    while seen[0]:
        cur = staged(small(large(cur)), "ring-round")
        now = mark(cur)
        if now == seen:
            break
        seen = now
    return (cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))


def _solve(docs: DataFrame, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, fp)`` per row and ``(fp, root, component_id)`` per fingerprint."""
    rows = staged(fingerprints(docs), "ring-fp")
    groups = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "ring-groups")
    tree = components(links(groups.select("fp"), block_rows))
    rooted = groups.join(tree, groups["fp"] == tree["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return rows, rooted.select("fp", "root").join(lowest, "root").select(
        "fp", "root", "component_id")


def near_copies(docs: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per input row.

    ``fingerprint`` is 16 lower-case hex digits; ``component_id`` the smallest
    doc_id that chains of links reach (null only if none of them has an id).
    Null and word-less texts have fingerprint zero and are linked like others;
    rows that repeat a doc_id each have their own fingerprint and row.
    """
    rows, of = _solve(docs, block_rows)
    return rows.join(of.drop("root"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The rows of ``docs`` without near copies, one of each component: the row
    of its smallest doc_id. Where several rows have that id, or a component has
    no id at all, the first by (fingerprint, text) of them stays."""
    rows, of = _solve(docs, block_rows)
    of = staged(of, "ring-of")
    found = rows.join(of, "fp")
    ids = staged(found.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("chosen")), "ring-ids")
    once = ids.where("n = 1 AND chosen AND doc_id IS NOT NULL").select(F.col("doc_id").alias("id"))
    many = ids.where("chosen AND (n > 1 OR doc_id IS NULL)").select(F.col("doc_id").alias("id"))
    # the kept ids grow with the documents: never broadcast them
    single = docs.join(once.hint("merge"), docs["doc_id"] == once["id"], "left_semi")
    if many.isEmpty():
        return single
    again = docs.join(many, docs["doc_id"].eqNullSafe(many["id"]), "left_semi")
    packed = again.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                          F.col("doc_id").cast("long").alias("doc_id"),
                          F.col("text").cast("string").alias("text"))
    coded = packed.mapInArrow(_code_rows, T.StructType(
        [*packed.schema.fields, T.StructField("fp", T.LongType())]))
    best = (coded.join(of, "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .groupBy("root")
            .agg(F.min_by("row", F.struct("fp", F.coalesce("text", F.lit("")))).alias("row")))
    return single.unionByName(best.select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns]))


def _code_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        codes = np.array([fingerprint(t) for t in b.column(2).to_pylist()], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), b.column(2), pa.array(codes.view(np.int64), pa.int64())],
            ["row", "doc_id", "text", "fp"])
