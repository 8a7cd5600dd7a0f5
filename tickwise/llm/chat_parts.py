"""Chat formatting with typed content parts.

A turn's content is a list of typed parts. A visitor walks the parts in order:
text is escaped and appended, an image, audio or document part leaves a
placeholder, its reference (with the turn, the part and the place of the
placeholder) and its expanded token count. A plain text column is one text part.

Template: ``<|turn|>role<|says|>content<|end|>`` per turn. Every backslash and every
bar of a text stands behind a backslash of its own, so a ``<|`` is always a mark's,
however a text is cut into parts, and the template can be read back.

JVM-side only. A conversation is one row of the result, so its turns meet in one
task by nature of the contract; nothing else is grouped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm._common import let

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
LOSS_ROLE = "assistant"
# Placeholder and tokens per unit of each part type. A unit is a tile of an
# image, a second of sound or a page of a document.
PART_TYPES = {"image": ("<|image|>", 256), "audio": ("<|audio|>", 25),
              "document": ("<|document|>", 512)}
PART = "struct<type:string,text:string,ref:string,units:bigint>"
_VISIT = "struct<out:string,refs:array<struct<turn:int,part:int,type:string,ref:string,at:int,tokens:bigint>>,tokens:bigint>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(.)", "$1")


def text_part(text: Column) -> Column:
    """A plain text as a list of one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.cast("string").alias("text"),
                            F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("bigint").alias("units")))


def _visit(parts: Column, turn: Column) -> Column:
    """Flatten one turn's parts: text so far, references, expanded tokens. A part
    of an unknown or null type counts as text; a null text is empty, null or
    negative units are none."""
    start = F.struct(
        F.lit("").alias("out"),
        F.expr("array()").alias("refs"), F.lit(0).cast("bigint").alias("tokens")).cast(_VISIT)

    def step(acc, pair):
        part = pair["part"]
        mark, each = F.lit(None).cast("string"), F.lit(None).cast("bigint")
        for name, (placeholder, tokens) in PART_TYPES.items():
            mark = F.when(part["type"] == name, placeholder).otherwise(mark)
            each = F.when(part["type"] == name, F.lit(tokens).cast("bigint")).otherwise(each)
        count = each * F.greatest(F.coalesce(part["units"], F.lit(0)), F.lit(0))
        ref = F.struct(turn.cast("int").alias("turn"), pair["no"].alias("part"),
                       part["type"].alias("type"), part["ref"].alias("ref"),
                       F.length(acc["out"]).alias("at"), count.alias("tokens"))
        return F.struct(
            F.concat(acc["out"], F.coalesce(mark, escape(F.coalesce(part["text"], F.lit("")))))
            .alias("out"),
            F.when(mark.isNotNull(), F.concat(acc["refs"], F.array(ref))).otherwise(acc["refs"])
            .alias("refs"),
            (acc["tokens"] + F.coalesce(count, F.lit(0))).alias("tokens")).cast(_VISIT)

    numbered = F.transform(F.coalesce(parts, F.expr(f"cast(array() as array<{PART}>)")),
                           lambda p, i: F.struct(p.alias("part"), i.alias("no")))
    return F.aggregate(numbered, start, step)


def format_chats(turns: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row per conversation of ``turns(conv_id, turn, role, parts)``.

    ``parts`` is an array of :data:`PART`; without it ``text`` is taken as one
    text part. Columns: ``conv_id, formatted, n_turns, refs, part_tokens,
    loss_spans``. ``refs`` lists the attachments (turn, part, type, ref, place of
    the placeholder in the formatted text, expanded tokens); ``loss_spans`` the
    code-point ranges of the escaped contents of ``loss_role``.

    Turns are ordered by turn, then role, then content, so ties and repeated
    rows have one order; null turns come first, null roles are empty, a null
    conv_id is a conversation of its own. Extra columns are not read.
    """
    parts = F.col("parts").cast(f"array<{PART}>") if "parts" in turns.columns \
        else text_part(F.col("text"))
    each = turns.select("conv_id", F.struct(
        F.col("turn").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        _visit(parts, F.col("turn")).alias("v")).alias("t"))
    talks = each.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    heads = F.transform("ts", lambda t: F.concat(
        F.lit(TURN), escape(t["role"]), F.lit(SAYS)))
    # where each content starts: the lengths of all before it
    sized = F.arrays_zip(heads.alias("head"), F.col("ts").alias("t"))
    walked = F.aggregate(
        sized,
        F.expr("cast(named_struct('at', 0, 'places', array()) as struct<at:int,places:array<int>>)"),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["head"]) + F.length(x["t"]["v"]["out"]) + len(END)).alias("at"),
            F.concat(acc["places"], F.array(acc["at"] + F.length(x["head"]))).alias("places")),
        lambda acc: acc["places"])
    talks = talks.withColumn("heads", heads).withColumn("places", walked)
    with_at = F.arrays_zip(F.col("ts").alias("t"), F.col("places").alias("p"))
    return talks.select(
        "conv_id",
        F.array_join(F.zip_with("heads", "ts", lambda h, t: F.concat(
            h, t["v"]["out"], F.lit(END))), "").alias("formatted"),
        F.size("ts").cast("long").alias("n_turns"),
        F.flatten(F.transform(with_at, lambda x: F.transform(
            x["t"]["v"]["refs"], lambda r: r.withField("at", r["at"] + x["p"])))).alias("refs"),
        F.aggregate("ts", F.lit(0).cast("bigint"), lambda s, t: s + t["v"]["tokens"])
        .alias("part_tokens"),
        F.transform(F.filter(with_at, lambda x: x["t"]["role"] == loss_role), lambda x: F.struct(
            x["p"].alias("start"), (x["p"] + F.length(x["t"]["v"]["out"])).alias("end")))
        .alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text: an array of ``(role, text)``, unescaped.
    Placeholders stay in the text."""
    rows = F.slice(F.split(formatted, r"<\|turn\|>", -1), F.lit(2), F.length(formatted))
    return F.transform(rows, lambda r: let(F.split(r, r"<\|says\|>|<\|end\|>", -1), lambda x: F.struct(
        unescape(F.element_at(x, 1)).alias("role"), unescape(F.element_at(x, 2)).alias("text"))))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), "")
