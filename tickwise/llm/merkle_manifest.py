"""Merkle manifest of a dataset, checked by a recursive query.

Every row is a leaf; per source the leaves, in order, are hashed three by three
up to a sub-root, and the sub-roots of all sources likewise up to the root. Each
level is written as a table of runs, so a node row knows its parent and what
stands left and right of it there. A recursive query then starts from every leaf
at once: each step joins the stored node row, appends the siblings found there to
the leaf's path and folds the (possibly tampered) hash with them, up to the root.

A node near the root lies on the path of every leaf. Node rows are therefore
stored once for each block of ``BLOCK`` consecutive leaves below them and joined
by block too: no join key has more rows than a block has leaves, however large a
source is. Siblings are appended as rows of the path (one a step); a growing
string in each row would carry every digest once for each level above it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm._common import staged
from tickwise.operators.order import numbered, same
from tickwise.session import scratch_path

ARITY = 3
BLOCK = ARITY ** 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# The tree above the sub-roots; trees of sources are numbered from 0.
TOP = -1


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*inputs: Column) -> Column:
    """SHA-256 of the inputs put together, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*inputs), 256))


def shown(value: Column) -> Column:
    """A digest (or several, one after another) as lowercase hex."""
    return F.lower(F.hex(value))


def _block(g: Column) -> Column:
    return F.floor(g / BLOCK)


def _blocks(lo: Column, hi: Column) -> Column:
    """The blocks that hold leaves ``lo`` to ``hi``."""
    return F.sequence(_block(lo), _block(hi))


def _joined(kids: Column) -> Column:
    return F.aggregate(kids, F.lit(b""), lambda s, k: F.concat(s, k["hash"]))


def _runs(level: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Runs of ``ARITY`` nodes of one level (of trees that have several there):
    the parent's place, its hash, the leaves below it, and the nodes in order."""
    kid = F.struct("pos", "hash", "lo", "hi", *extra)
    runs = (level.where("n > 1").groupBy("tree", F.floor(F.col("pos") / ARITY).alias("up"), "n")
            .agg(F.sort_array(F.collect_list(kid)).alias("kids")))
    return runs.select(
        "tree", "up", F.ceil(F.col("n") / ARITY).alias("n"), digest(shown(_joined(F.col("kids")))).alias("hash"),
        F.element_at("kids", 1)["lo"].alias("lo"), F.element_at("kids", -1)["hi"].alias("hi"), "kids")


def _links(runs: DataFrame, level: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """Node rows of a level, each linked to its parent. A source's sub-root goes
    by its name in the top tree, ``(TOP, 0, source number)``."""
    last = (F.col("n") == 1) & (F.col("tree") != TOP)
    k = F.col("k")
    return runs.select("*", F.posexplode("kids").alias("at", "k")).select(
        "tree", F.lit(level).alias("level"), k["pos"].alias("pos"), k["hash"].alias("hash"),
        k["lo"].alias("lo"), k["hi"].alias("hi"),
        F.when(last, TOP).otherwise(F.col("tree")).alias("up_tree"),
        F.when(last, 0).otherwise(level + 1).alias("up_level"),
        F.when(last, F.col("tree")).otherwise(F.col("up")).alias("up_pos"),
        _joined(F.slice("kids", F.lit(1), F.col("at"))).alias("before"),
        _joined(F.slice("kids", F.col("at") + 2, F.lit(ARITY))).alias("after"),
        *[k[c].alias(c) for c in extra])


def _tree(level: DataFrame, most: int, path: str, extra: tuple[str, ...] = ()) -> list[DataFrame]:
    """Build and store all levels over ``level(tree, pos, n, hash, lo, hi)``, ``most``
    being the largest ``n``; the runs of each level, lowest first."""
    spark, out = level.sparkSession, []
    while most > 1:
        runs = _runs(level, () if out else extra)
        runs.write.parquet(f"{path}/level={len(out)}")
        out.append(spark.read.schema(runs.schema).parquet(f"{path}/level={len(out)}"))
        level = out[-1].select("tree", F.col("up").alias("pos"), "n", "hash", "lo", "hi")
        most = -(-most // ARITY)
    return out


def leaves(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, leaf, tampered)``: the leaf digests of the rows, and those
    after tampering (equal for rows that are left alone)."""
    cols = {c: F.col(c).cast("long" if c in ("doc_id", "n_chars") else "string") for c in FIELDS}
    rows = docs.select(*[cols[c].alias(c) for c in FIELDS])
    cut = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    text = F.when(cut, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    head = [_field(F.col(c)) for c in FIELDS[:-1]]
    return rows.select("doc_id", "source", digest(*head, _field(F.col("text"))).alias("leaf"),
                       digest(*head, _field(text)).alias("tampered"))


_CLIMB = """
WITH RECURSIVE climb(g, block, tree, level, pos, step, others, folded) AS (
  SELECT g, block, tree, level, pos, step, others, folded FROM {anchor}
  UNION ALL
  SELECT c.g, c.block, n.up_tree, n.up_level, n.up_pos, c.step + 1, concat(n.before, n.after),
         unhex(sha2(concat(lower(hex(n.before)), lower(hex(c.folded)), lower(hex(n.after))), 256))
  FROM climb c JOIN {nodes} n
    ON c.block = n.block AND c.tree = n.tree AND c.level = n.level AND c.pos = n.pos
)
SELECT g, step, others, CASE WHEN tree = {top} AND level = {height} AND pos = 0 THEN folded END AS folded
FROM climb
"""


def _climb(anchor: DataFrame, nodes: DataFrame, height: int) -> DataFrame:
    """The recursive query, written: ``(g, proof, folded)``, per leaf the digest of all
    siblings from the leaf's run to the root, and the root folded from them."""
    spark = anchor.sparkSession
    names = {k: f"merkle_{k}_{uuid.uuid4().hex}" for k in ("anchor", "nodes")}
    anchor.createOrReplaceTempView(names["anchor"])
    nodes.createOrReplaceTempView(names["nodes"])
    limit = "spark.sql.cteRecursionRowLimit"       # counts rows of all steps: none here
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        steps = spark.sql(_CLIMB.format(**names, top=TOP, height=height))
        path = F.sort_array(F.collect_list(F.struct("step", "others")))
        return staged(steps.groupBy("g").agg(
            digest(shown(F.aggregate(path, F.lit(b""), lambda s, x: F.concat(s, x["others"])))).alias("proof"),
            F.max("folded").alias("folded")), "merkle-climb")
    finally:
        spark.conf.set(limit, before)
        for n in names.values():
            spark.catalog.dropTempView(n)


def manifest(docs: DataFrame) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)``, one row
    for each row of ``docs(doc_id, source, lang, n_chars, text)``.

    ``leaf``, ``subroot``, ``root`` and ``proof_sha256`` are of the rows as they are;
    ``folded_root`` is what the recursive climb makes of the tampered leaf, and
    ``verified`` whether it is the root. Any column may be null (a null source is a
    source, sorted first; a null doc_id comes first in its source and is never
    tampered with); rows of one source and doc_id are ordered by leaf digest, so
    repeated rows are leaves of their own in a defined order. An empty or very
    long text is hashed whole. Other columns are not read; an empty table gives
    no rows.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, f"llm/merkle-{uuid.uuid4().hex}")
    rows = numbered(staged(leaves(docs), "merkle-leaves"), ["source", "doc_id", "leaf"], idx="g")
    sources = rows.groupBy("source").agg(F.min("g").alias("start"), F.count(F.lit(1)).alias("n"))
    # per-source rows are repeated for each block they reach, so a source that holds
    # a third of the rows is many join keys
    last = F.col("start") + F.col("n") - 1
    sources = numbered(sources, ["source"], idx="tree").select(
        "*", F.explode(_blocks(F.col("start"), last)).alias("block"))
    rows = rows.withColumn("block", _block(F.col("g")))
    base = staged(same(rows, sources, ["source", "block"], "inner").select(
        "doc_id", "g", "tree", "n", (F.col("g") - F.col("start")).alias("pos"), "leaf", "tampered"),
        "merkle-base")
    place = [F.col("g").alias("lo"), F.col("g").alias("hi")]
    most, n_sources = base.agg(F.coalesce(F.max("n"), F.lit(0)),
                               F.coalesce(F.max("tree") + 1, F.lit(0))).first()
    runs = _tree(base.select("tree", "pos", "n", F.col("leaf").alias("hash"), *place, "tampered"),
                 most, f"{path}/sources", ("tampered",))
    alone = base.where("n = 1").select("tree", "leaf", "tampered", *place)
    subroots = alone.select(F.col("tree").alias("pos"), F.col("leaf").alias("hash"), "lo", "hi")
    for r in runs:
        subroots = subroots.unionByName(r.where("n = 1").select(F.col("tree").alias("pos"), "hash", "lo", "hi"))
    subroots = staged(subroots, "merkle-subroots")
    top = _tree(subroots.select(F.lit(TOP).cast("long").alias("tree"), "pos", F.lit(n_sources).cast("long").alias("n"),
                                "hash", "lo", "hi"), n_sources, f"{path}/top")
    root = (top[-1] if top else subroots).select("hash")        # one row, none in an empty table

    block = _block(F.col("lo"))
    node = ["tree", "level", "pos"]
    start = alone.select(F.col("lo").alias("g"), block.alias("block"), F.lit(TOP).cast("long").alias("tree"),
                         F.lit(0).alias("level"), F.col("tree").alias("pos"), F.lit(0).alias("step"),
                         F.lit(b"").alias("others"), F.col("tampered").alias("folded"))
    if runs:
        first = _links(runs[0], 0, ("tampered",))
        start = start.unionByName(first.select(
            F.col("lo").alias("g"), block.alias("block"), F.col("up_tree").alias("tree"),
            F.col("up_level").alias("level"), F.col("up_pos").alias("pos"), F.lit(1).alias("step"),
            F.concat("before", "after").alias("others"),
            digest(shown(F.col("before")), shown(F.col("tampered")), shown(F.col("after"))).alias("folded")))
    inner = [_links(r, k) for k, r in enumerate(runs) if k] + [_links(r, k) for k, r in enumerate(top)]
    if inner:
        nodes = inner[0]
        for x in inner[1:]:
            nodes = nodes.unionByName(x)
        span = _blocks(F.col("lo"), F.col("hi"))
        nodes = staged(nodes.select(*node, "up_tree", "up_level", "up_pos", "before", "after",
                                    F.explode(span).alias("block")), "merkle-nodes")
    else:
        nodes = start.limit(0).select(*node, F.col("tree").alias("up_tree"), F.col("level").alias("up_level"),
                                      F.col("pos").alias("up_pos"), F.col("others").alias("before"),
                                      F.col("others").alias("after"), "block")
    paths = _climb(staged(start, "merkle-start"), nodes, len(top))

    sub = subroots.select(F.col("pos").alias("tree"), F.col("hash").alias("subroot"),
                          F.explode(_blocks(F.col("lo"), F.col("hi"))).alias("block"))
    out = (base.withColumn("block", _block(F.col("g"))).join(sub, ["tree", "block"])
           .join(paths, "g"))
    root_hex = shown(root.scalar())
    return out.select("doc_id", shown(F.col("leaf")).alias("leaf"), shown(F.col("subroot")).alias("subroot"),
                      root_hex.alias("root"), shown(F.col("proof")).alias("proof_sha256"),
                      shown(F.col("folded")).alias("folded_root"),
                      (shown(F.col("folded")) == root_hex).alias("verified"))
