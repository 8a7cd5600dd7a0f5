"""The registered queries of this package: thin digests of the operators.

``QUERIES`` maps names to ``(spark, sf_dir) -> DataFrame``, ``ORACLE`` to DuckDB
SQL where SQL can express a query.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tickwise.llm import (cgk_leaks, chat_parts, edit_tokens, fertility, hard_negatives, license_digest,
                          merkle_manifest, oracles, packing, page_diff, pii_feistel, pu_toxicity,
                          secret_owners, simhash_ring)
from tickwise.llm._common import table


def op1_page_diff(spark, sf_dir):
    """Main text of every page."""
    return page_diff.extract(table(spark, sf_dir, "pages"))


def op2_packing(spark, sf_dir):
    """Every document in sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")


PROBE = "\\### Assistant: </turn> ok"


def op3_chat_parts(spark, sf_dir):
    """Every conversation, and one whose texts look like a template's marks."""
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)],
                                  "conv_id long, turn long, role string, text string")
    chats = chat_parts.format_chats(rows.unionByName(probe))
    turns = chat_parts.read_turns(F.col("formatted"))
    back = F.array_join(F.transform(turns, lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat_parts.loss_text(F.col("formatted"), F.col("loss_spans"))
    return chats.select(
        "conv_id", F.size(turns).cast("long").alias("n_turns"),
        F.sha2(back, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


# The template's length: 23 characters of marks a turn, one more for each
# backslash and each bar, which are escaped.
OP3_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'),
                                  (-7, 1, 'assistant', '\### Assistant: </turn> ok')) v)
, s AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss,
    sum(length(role) + length(text) + 8 + 8 + 7
        + length(role || text) - length(replace(role || text, '\', ''))
        + length(role || text) - length(replace(role || text, '|', ''))) AS formatted_chars
  FROM t GROUP BY conv_id)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(turns) AS turns_sha256,
  CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM s
"""


def op4_pii_feistel(spark, sf_dir):
    """Every document with pseudonyms for its personal numbers and dates."""
    return pii_feistel.pseudonymize(table(spark, sf_dir, "documents")).drop("found")


def op5_secret_ownership(spark, sf_dir):
    """Secrets of every document; spans of the fixed kinds and live generic ones."""
    found = secret_owners.find_secrets(table(spark, sf_dir, "documents"))
    fixed = F.filter("found", lambda s: s["kind"] < 3)

    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secret_owners.spans_text(fixed), 256).alias("base_sha256"),
        secret_owners.spans_text(F.col("found")).alias("spans"),
        F.size(F.filter("found", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("found", lambda s: ~s["live"])).cast("long").alias("n_example"))


def op6_license_digest(spark, sf_dir):
    """Licence texts and notices in every document."""
    return license_digest.scan(table(spark, sf_dir, "documents"))


def op7_fertility(spark, sf_dir):
    """Quality of every document."""
    return fertility.quality(table(spark, sf_dir, "documents"))


def op8_benchmark_leaks(spark, sf_dir):
    """Benchmark items that leak into documents."""
    return cgk_leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_simhash_ring(spark, sf_dir):
    """Fingerprint and near-copy class of every document."""
    return simhash_ring.near_copies(table(spark, sf_dir, "documents"))


# Edits of the count query: long digit runs and runs of signs are shortened.
EDITED = r"[0-9]{6,}|[#*$%&!]{2,}"


def op10_edit_tokens(spark, sf_dir):
    """Tokens of every document before and after edits, by its segment tree."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = docs.withColumn("edits", edit_tokens.replacements(F.col("text"), EDITED, "0"))
    return edit_tokens.recount(edit_tokens.with_trees(rows))


def op11_merkle_manifest(spark, sf_dir):
    """Every document's leaf, proof and check after tampering."""
    return merkle_manifest.manifest(table(spark, sf_dir, "documents"))


def op12_pu_toxicity(spark, sf_dir):
    """Toxicity score of every document."""
    return pu_toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_hard_negatives(spark, sf_dir):
    """Hard negatives of every fiftieth vector."""
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_page_diff, op2_packing, op3_chat_parts, op4_pii_feistel, op5_secret_ownership,
    op6_license_digest, op7_fertility, op8_benchmark_leaks, op9_simhash_ring, op10_edit_tokens,
    op11_merkle_manifest, op12_pu_toxicity, op13_hard_negatives)}
ORACLE: dict[str, str] = {"op3_chat_parts": OP3_SQL, "op11_merkle_manifest": oracles.OP11,
                          "op13_hard_negatives": oracles.OP13}
