"""Secret scans weighed by corpus-wide ownership.

Patterns find candidates; their values are hashed, and each hash is counted by
the distinct repositories and owners that hold it. A value that many owners hold
is an example that was copied around; one that a single owner or two hold and
that looks random is a live credential. Three fixed kinds are always reported;
a wider kind ("generic": long runs of letters and digits) is reported only where
the ownership makes it live.

JVM-side only. The scan is one projection; only hashes and spans are shuffled,
and distinct (hash, owner, repository) rows are formed before the count, so a
value that a third of all rows hold shrinks map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm._common import match_spans, staged

# The patterns, the kinds' order and their least lengths.
ASSIGN = (r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
          r"[A-Za-z0-9+/_.=-]+")
ASSIGN_VALUE = r"[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)$"
# A run of a single class has its least length in the pattern: a shorter run
# holds no longer one, so the findings are those of "+" and a length check.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
GENERIC = r"[A-Za-z0-9_-]{24,}"
KINDS = ("assign", "access", "hex", "generic")
MIN_ASSIGN = 12
LIVE_OWNERS = 2
MIN_DISTINCT_CHARS = 8

_SPAN = "array<struct<start:int,kind:int,end:int,hash:bigint,varied:boolean>>"


def _typed(spans: Column, kind: int, value) -> Column:
    """Spans with kind, value hash and whether the value looks random."""
    def one(s):
        v = value(s["value"])
        return F.struct(
            s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"),
            F.xxhash64(v).alias("hash"),
            (F.size(F.array_distinct(F.split(v, ""))) >= MIN_DISTINCT_CHARS).alias("varied"))
    return F.transform(spans, one)


def _assigned(match: Column) -> Column:
    return F.regexp_extract(match, ASSIGN_VALUE, 1)


def _scan(text: Column) -> dict[str, Column]:
    """Candidate spans by kind; the first three hold the fixed findings."""
    assign = F.filter(match_spans(text, ASSIGN),
                      lambda s: F.length(_assigned(s["value"])) >= MIN_ASSIGN)
    generic = F.filter(
        match_spans(text, GENERIC),
        lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]"))
    return {"assign": _typed(assign, 0, _assigned),
            "access": _typed(match_spans(text, ACCESS), 1, lambda v: v),
            "hex": _typed(match_spans(text, HEX), 2, lambda v: v),
            "generic": _typed(generic, 3, lambda v: v)}


def ownership(values: DataFrame) -> DataFrame:
    """``(hash, n_repos, n_owners)`` of ``values(hash, owner, repo)``: distinct
    repositories (of an owner) and distinct owners that hold a value."""
    return (values.select("hash", "owner", "repo").distinct()
            .groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("r"))
            .groupBy("hash").agg(F.sum("r").alias("n_repos"), F.count(F.lit(1)).alias("n_owners")))


def find_secrets(docs: DataFrame, owner: Column | None = None, repo: Column | None = None,
                 carry: Column | None = None, live_owners: int = LIVE_OWNERS) -> DataFrame:
    """One row per input row: ``doc_id``, ``found`` and, if asked for, ``carry``.

    ``found`` is an array of ``(start, kind, end, live, n_repos, n_owners)`` by
    start, then kind (an index of :data:`KINDS`), offsets in code points, end
    exclusive. The fixed kinds are all there, ``generic`` only where live and
    not inside a fixed one. A value is live if at most ``live_owners`` owners
    hold it and it has eight or more different characters. Defaults: ``source``
    is the owner, (source, lang) the repository. Null texts have no findings;
    rows without an owner count as one unnamed owner; each row stands for
    itself, whatever its doc_id.
    """
    names = docs.columns
    owner = owner if owner is not None else (F.col("source") if "source" in names else F.lit(""))
    repo = repo if repo is not None else (F.col("lang") if "lang" in names else F.lit(""))
    kinds = _scan(F.col("text").cast("string"))
    base = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
        F.coalesce(repo.cast("string"), F.lit("")).alias("repo"),
        (carry if carry is not None else F.lit(True)).alias("carry"),
        *[c.cast(_SPAN).alias(k) for k, c in kinds.items()])
    held = F.concat("assign", "access", "hex")
    outside = F.filter("generic", lambda g: ~F.exists(
        held, lambda s: (s["start"] < g["end"]) & (g["start"] < s["end"])))
    base = staged(base.select("rid", "doc_id", "owner", "repo", "carry",
                              F.concat(held, outside).alias("spans")), "secret-spans")
    each = base.where(F.size("spans") > 0).select(
        "rid", "owner", "repo", F.explode("spans").alias("s")).select(
        "rid", "owner", "repo", "s.*")
    held_by = ownership(each)
    judged = (each.join(held_by, "hash")
              .withColumn("live", (F.col("n_owners") <= live_owners) & F.col("varied"))
              .where((F.col("kind") < 3) | F.col("live"))
              .groupBy("rid").agg(F.sort_array(F.collect_list(F.struct(
                  "start", "kind", "end", "live", "n_repos", "n_owners"))).alias("found")))
    none = F.expr("array()").cast("array<struct<start:int,kind:int,end:int,live:boolean,"
                                  "n_repos:bigint,n_owners:bigint>>")
    keep = ["doc_id", "found"] + (["carry"] if carry is not None else [])
    some = base.where(F.size("spans") > 0).join(judged, "rid", "left").withColumn(
        "found", F.coalesce("found", none))
    return (base.where(F.size("spans") <= 0).withColumn("found", none).select(*keep)
            .unionByName(some.select(*keep)))


def spans_text(found: Column) -> Column:
    """``kind:start:end`` of each finding, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"], s["end"])), ",")


def redact_text(text: Column, found: Column) -> Column:
    """The text with each finding replaced: live ones by ``<secret>``, copied
    examples by ``<secret-example>``; overlapping findings become one."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(
        found, start,
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(
                acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]),
                F.when(s["live"], F.lit("<secret>")).otherwise(F.lit("<secret-example>"))))
            .alias("out")),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(found) > 0, done).otherwise(text)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every finding replaced in ``text`` and ``n_chars`` (where
    there is one) set anew; rows without findings are unchanged."""
    found = find_secrets(docs, carry=F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    text = redact_text(F.col("carry").getField("text"), F.col("found"))
    cols = []
    for f in docs.schema.fields:
        old = F.col("carry").getField(f.name)
        if f.name == "text":
            old = text
        elif f.name == "n_chars":
            old = F.when(F.size("found") > 0, F.length(text)).otherwise(old).cast(f.dataType)
        cols.append(old.alias(f.name))
    return found.select(*cols)
