"""Merkle manifest, positive-unlabelled toxicity, hard negatives."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MID, SF_SMALL
from tests.llm.fixtures import edge_docs, no_docs
from tests.oracle import assert_same, duck
from tickwise.llm import hard_negatives as N
from tickwise.llm import merkle_manifest as M
from tickwise.llm import oracles, pu_toxicity as P
from tickwise.llm import queries as Q


# --- 11 manifest ---

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(r, text):
    values = [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def plain_path(levels, at):
    for nodes in levels[:-1]:
        s = at // 3 * 3
        yield nodes[s:at], nodes[at + 1:s + 3]
        at //= 3


def plain_manifest(rows):
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append((r["doc_id"], plain_leaf(r, r["text"]), r))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        by[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = [plain_levels([x[1] for x in by[s]]) for s in order]
    top = plain_levels([t[-1][0] for t in trees])
    out = []
    for k, s in enumerate(order):
        for i, (doc, leaf, r) in enumerate(by[s]):
            path = [*plain_path(trees[k], i), *plain_path(top, k)]
            text = r["text"]
            if text is not None and doc is not None and zlib.crc32(str(doc).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded = plain_leaf(r, text)
            for a, b in path:
                folded = H(*a, folded, *b)
            root = top[-1][0]
            out.append((doc, leaf, trees[k][-1][0], root, H(*[x for a, b in path for x in a + b]), folded,
                        folded == root))
    return out


def check_manifest(docs):
    got = Counter(tuple(r) for r in M.manifest(docs).collect())
    assert got == Counter(plain_manifest([r.asDict() for r in docs.collect()]))
    return got


def test_manifest_of_edge_rows(spark):
    got = check_manifest(edge_docs(spark))
    assert {r[-1] for r in got} == {True, False} or {r[-1] for r in got} == {True}
    assert M.manifest(no_docs(spark)).collect() == []


@pytest.mark.parametrize("n,sources", [(1, 1), (4, 4), (28, 1)])
def test_manifest_of_small_shapes(spark, n, sources):
    rows = [(i, "a\nb" * (i % 3), None, "s" if sources == 1 else f"s{i % sources}", i) for i in range(n)]
    check_manifest(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))


def test_manifest_in_small_blocks_and_a_hot_source(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 9)
    rows = [(i // 2, f"t\n{i % 5}", "en", "hot" if i % 3 else f"s{i}", 1) for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    check_manifest(docs.repartition(5))


def test_manifest_oracle(spark):
    assert_same(Q.op11_merkle_manifest(spark, SF_SMALL), duck(SF_SMALL), oracles.OP11)


def test_manifest_restores_the_row_limit(spark):
    key = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(key)
    M.manifest(edge_docs(spark)).count()
    assert spark.conf.get(key) == before


# --- 12 toxicity ---

def test_pu_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    out = P.toxicity(docs, labels).join(labels, "doc_id").where("held_out AND toxic IS NOT NULL").toPandas()
    toxic = out[out.toxic == 1].score.to_numpy()
    clean = out[out.toxic == 0].score.to_numpy()
    ranked = (toxic[:, None] > clean[None]).mean() + 0.5 * (toxic[:, None] == clean[None]).mean()
    assert ranked > 0.85                                     # few toxic rows at this size
    assert (clean >= P.THRESHOLD).mean() < 0.1


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    flipped = labels.withColumn("toxic", F.when(P.held_out(F.col("doc_id")), 1 - F.col("toxic"))
                                .otherwise(F.col("toxic")))
    assert P.train(docs, labels) == P.train(docs, flipped)


def test_negative_labels_are_not_read(spark):
    """Which unlabelled rows are labelled clean does not change the sample, only the prior."""
    rng = np.random.default_rng(5)
    n = 400
    toxic = np.arange(n) < 200
    x = rng.random((n, 6)) < np.where(toxic[:, None], [.9, .5, .5, .5, .5, .5], [.02, .5, .5, .5, .5, .5])
    positive = toxic & (np.arange(n) < 100)                  # half of the toxic rows are unlabelled
    rows, cols = np.nonzero(x)
    w, b = P.fit_pu(rows, cols, positive, 6, prior=1 / 3)
    f = x @ w + b
    assert w[0] > 2 * abs(w[1:]).max()
    hidden = toxic & ~positive
    assert (f[hidden & x[:, 0]] > 0).all() and (f[~toxic & ~x[:, 0]] < 0).mean() > 0.95


def test_risk_on_clean_texts_stays_non_negative():
    """With separable rows the plain estimate goes below zero; the fit holds it there."""
    rng = np.random.default_rng(1)
    n, d = 60, 200
    positive = np.arange(n) < 20
    x = rng.random((n, d)) < 0.2
    rows, cols = np.nonzero(x)
    w, b = P.fit_pu(rows, cols, positive, d, prior=0.5, steps=400)
    f = x @ w + b
    clean = P._log_loss(-f)[~positive].mean() - 0.5 * P._log_loss(-f)[positive].mean()
    assert clean > -0.5 and np.isfinite(f).all()


def test_toxicity_on_edge_rows(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (9999, 1), (7, 0)],
                                   "doc_id long, toxic int")
    out = P.toxicity(edge_docs(spark), labels).collect()
    assert len(out) == edge_docs(spark).count()
    assert all(0 <= r["score"] <= 1 for r in out)
    assert P.toxicity(no_docs(spark), labels).collect() == []
    nothing = P.toxicity(edge_docs(spark), labels.limit(0)).collect()
    assert {r["score"] for r in nothing} == {0.0} and {r["predicted"] for r in nothing} == {0}


def test_score_is_the_mean_of_plain_sums(spark):
    words = ["bad*", "Bad.", "awfully", "ok"]
    names = [P._features("bad")[0], *P._features("awfully")[1:2]]
    model = [(names, [2.0, 1.0], -1.0), (names[:1], [0.5], 0.0)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "BAD bad bad"), (3, None), (4, "awfu")],
                                 "doc_id long, text string")
    got = {r[0]: r["score"] for r in P.score(docs, model).collect()}
    s = lambda z: 1 / (1 + np.exp(-z))                       # noqa: E731
    want = {1: (s(2.0) + s(.5)) / 2, 2: (s(1.0) + s(.5)) / 2, 3: (s(-1.0) + s(0)) / 2, 4: (s(0.0) + s(0)) / 2}
    assert got == pytest.approx(want)


# --- 13 hard negatives ---

def plain_negatives(rows, anchors=50):
    by = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        by[i] = min(by.get(i, (99, [])), (label, [int(np.floor(256 * float(x))) for x in v])) if i in by \
            else (label, [int(np.floor(256 * float(x))) for x in v])
    out = []
    for a in by:
        if a % anchors:
            continue
        score = {i: sum(x * y for x, y in zip(by[a][1], by[i][1])) for i in by}
        order = sorted((i for i in by if i != a), key=lambda i: (-score[i], i))
        for p in [i for i in order if by[i][0] == by[a][0]][:5]:
            hard = [i for i in order if by[i][0] != by[a][0] and 50 * score[p] <= 100 * score[i] <= 95 * score[p]]
            out += [(a, p, r + 1, i, score[p], score[i]) for r, i in enumerate(hard[:3])]
    return sorted(out)


VECTORS = "vec_id long, embedding array<float>, label int, extra string, q int, b int, g int"


def vectors(seed, n, d, ties):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, d))
    if ties:
        v = np.round(v * 2) / 2
    v[: n // 3] = v[0] if ties else v[: n // 3]              # a third of equal vectors
    return [(i, [float(np.float32(x)) for x in v[i]], int(rng.integers(0, 4))) for i in range(n)]


@pytest.mark.parametrize("ties", [False, True])
def test_negatives_against_brute_force(spark, monkeypatch, ties):
    monkeypatch.setattr(N, "BLOCK_ROWS", 60)
    monkeypatch.setattr(N, "GROUP_ANCHORS", 2)
    rows = vectors(3, 260, 5, ties)
    bad = [(300, None, 1), (350, [1.0, None, 1.0, 1.0, 1.0], 1), (None, rows[0][1], 1),
           (400, rows[0][1], None), (450, [float("nan")] * 5, 2), (500, [float("inf")] * 5, 2),
           (550, [0.0] * 5, 1), (600, [], 1), (601, [1.0, 2.0], 3), rows[7], rows[50]]
    every = rows + bad
    df = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in every], VECTORS)
    got = sorted(tuple(r) for r in N.mine(df).collect())
    assert got == plain_negatives(every) and got


def test_negatives_of_an_empty_table(spark):
    assert N.mine(spark.createDataFrame([], VECTORS)).collect() == []


def test_negatives_oracle(spark):
    assert_same(Q.op13_hard_negatives(spark, SF_MID), duck(SF_MID), oracles.OP13)


def test_search_stops_before_the_end_and_is_exact():
    """Vectors with a few strong components: the threshold falls quickly."""
    rng = np.random.default_rng(2)
    x = np.floor(256 * rng.pareto(1.5, size=(4000, 3))).astype("int64")
    block = N.Block(np.arange(4000), np.zeros(4000, "int64"), x)
    read = []
    plain = N.Block.scores
    block.scores = lambda rows, q: (read.append(len(rows)), plain(block, rows, q))[1]
    q = np.array([200, 0, 5])
    got = block.search(q, np.ones(4000, bool), [(-(1 << 60), 1 << 60, 3)])[0]
    s = x @ q
    assert got == [(int(i), int(s[i])) for i in np.lexsort((np.arange(4000), -s))[:3]]
    assert sum(read) < 1000


def test_ties_at_the_threshold_keep_the_smaller_id():
    x = np.ones((500, 2), dtype="int64")
    block = N.Block(np.arange(500)[::-1].copy(), np.zeros(500, "int64"), x)
    got = block.search(np.array([1, -1]), np.ones(500, bool), [(0, 0, 3)], first_depth=1)[0]
    assert got == [(0, 0), (1, 0), (2, 0)]
    wide = N.Block(np.arange(4), np.zeros(4, "int64"), np.array([[1 << 24] * 40] * 4))
    assert wide.fast is None and wide.search(wide.x[0], np.ones(4, bool), [(0, 1 << 62, 1)])[0] == [(0, 40 << 48)]
