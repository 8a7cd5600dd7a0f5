"""Record extraction from crawled pages stored as ``(page_id, url, html)``.

Extraction is written as regex projections that run inside the JVM
(``regexp_extract_all`` + ``arrays_zip`` + ``posexplode``), one page per row,
no shuffle and no per-row Python. Elements that nest (tables, rows, cells, cards)
are found by :func:`elements`, by patterns of a few levels or else a scan over tag
tokens that carries the depth; it is not a general HTML parser (see README).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.functions import text as tx

# Markup the extractors look for.
ANCHOR_RE = r"(?is)<a(\s[^>]*)?>(.*?)</a>"
HREF_RE = r"""(?is)\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
TITLE_RE = r"(?is)<title[^>]*>(.*?)</title>"
# Markup whose content is no markup: comments, scripts, styles.
RAW_RE = r"(?is)<(?:!--.*?-->|script(?=[\s>]).*?</script\s*>|style(?=[\s>]).*?</style\s*>)"


def attribute_re(name: str, value: str) -> str:
    """An attribute with exactly this value (as an XPath ``@name='value'`` test),
    in either kind of quotes and with the name in either case."""
    v = _escape(value)
    return rf"""(?<=\s)(?i:{_escape(name)})\s*=\s*(?-i:"{v}"|'{v}')"""


def class_re(cls: str) -> str:
    return attribute_re("class", cls)


def _escape(s: str) -> str:
    out = []
    for ch in s:
        out.append("\\" + ch if ch in r".^$*+?()[]{}|\/" else ch)
    return "".join(out)


def _first_text(inner: Column) -> Column:
    """Text before the first child tag (an element's ``.text``)."""
    return F.regexp_extract(inner, r"^([^<]*)", 1)


_ELEMENTS = "struct<depth:int,head:string,body:string,found:array<struct<head:string,body:string>>>"
# How many elements may lie in one another for one pattern to find the outermost
# ones; a text with deeper ones is scanned token by token.
PATTERN_DEPTH = 4


def _tag_re(tags: Sequence[str], before: str) -> str:
    """A tag of one of these names; ``before`` stands between ``<`` and the name."""
    name = "|".join(_escape(t) for t in tags)
    return rf"""<{before}(?:{name})(?=[\s/>])(?:[^'">]+|"[^"]*+"|'[^']*+')*+>"""


def _outermost_re(tags: Sequence[str]) -> tuple[str, str]:
    """Two patterns: an outermost element ``(head)(body)`` with at most ``PATTERN_DEPTH``
    more inside one another, and a whole text of no other ones. A start tag of any other
    matches alone, as do end tags too many with no start tag after them: then the body is
    empty. The repeats are possessive, so that no part of a text is tried in two ways."""
    start, end = _tag_re(tags, ""), _tag_re(tags, "/")
    text = rf"(?:[^<]+|(?!{_tag_re(tags, '/?')})<)*+"
    strays = rf"(?:{end}{text})"
    body = text
    for _ in range(PATTERN_DEPTH):
        body = rf"{text}(?:{start}{body}(?:{end}|\z){text})*+"
    return (rf"(?is){strays}*+({start})(?:({body})(?:{end}|\z)|)|{strays}++\z",
            rf"(?is)\A{text}(?:{strays}*+{start}{body}(?:{end}|\z){text})*+\z")


def elements(html: Column, tags: Sequence[str], attribute: str | None = None) -> Column:
    """The outermost elements of some tags, as an array of ``(head, body)``: the start
    tag and the markup inside, up to the element's own end tag.

    ``attribute`` is a pattern that the start tag must contain. Elements of the same
    names inside one do not end it. An element without an end tag reaches to the end of
    the text; an end tag too many is passed over. Null gives null.

    One pattern finds them unless very many lie in one another; that, or an
    ``attribute``, takes a scan that cuts the text at the start and end tags of these
    names and carries how many are open.
    """
    def found(h):
        if attribute is not None:
            return _scan(h, tags, attribute)
        one, whole = _outermost_re(tags)
        return F.when(h.rlike(whole), F.zip_with(
            F.regexp_extract_all(h, F.lit(one), 1), F.regexp_extract_all(h, F.lit(one), 2),
            lambda a, b: F.struct(a.alias("head"), b.alias("body")))).otherwise(_scan(h, tags))

    return _once(html, found)


def bodies(html: Column, tags: Sequence[str]) -> Column:
    """The bodies alone of :func:`elements`."""
    one, whole = _outermost_re(tags)
    # an empty body may be tags that matched alone
    return _once(html, lambda h: _once(F.regexp_extract_all(h, F.lit(one), 2), lambda found: (
        F.when(~F.array_contains(found, ""), found).when(h.rlike(whole), found)
        .otherwise(F.transform(_scan(h, tags), lambda e: e["body"])))))


def _once(c: Column, use) -> Column:
    """``use`` of a column that is worked out once: a lambda variable."""
    return F.get(F.transform(F.array(c), use), 0)


def _scan(h: Column, tags: Sequence[str], attribute: str | None = None) -> Column:
    """:func:`elements` of any text, token by token."""
    token = "(?is)" + _tag_re(tags, "/?")
    start = F.expr(f"CAST(named_struct('depth', 0, 'head', '', 'body', '', 'found', array()) AS {_ELEMENTS})")

    def state(depth, head, body, found):
        return F.struct(depth.cast("int").alias("depth"), head.alias("head"), body.alias("body"),
                        found.alias("found")).cast(_ELEMENTS)

    def with_one(acc):
        one = F.struct(acc["head"].alias("head"), acc["body"].alias("body"))
        return F.concat(acc["found"], F.array(one))

    def step(acc, x):
        tag, text = x["tag"], x["after"]
        ends = tag.startswith("</")
        starts = ~ends if attribute is None else ~ends & tag.rlike(attribute)
        inside = F.concat(acc["body"], tag, text)
        return (F.when((acc["depth"] == 0) & starts, state(F.lit(1), tag, text, acc["found"]))
                .when(acc["depth"] == 0, acc)
                .when(ends & (acc["depth"] == 1), state(F.lit(0), F.lit(""), F.lit(""), with_one(acc)))
                .otherwise(state(acc["depth"] + F.when(ends, -1).otherwise(1), acc["head"], inside, acc["found"])))

    tags_after = F.zip_with(F.regexp_extract_all(h, F.lit(token), 0),
                            F.slice(F.split(h, token, -1), F.lit(2), F.length(h) + 1),
                            lambda t, a: F.struct(t.alias("tag"), a.alias("after")))
    return F.aggregate(tags_after, start, step,
                       lambda acc: F.when(acc["depth"] > 0, with_one(acc)).otherwise(acc["found"]))


def anchors(pages: DataFrame, cls: str | None = None) -> DataFrame:
    """``(page_id, url, pos, text, href)`` for every anchor, optionally
    only those whose class equals ``cls``; ``pos`` is document order. Tags in
    either case, over several lines, attributes in either kind of quotes or none;
    character references are decoded (an anchor without href has an empty one)."""
    attrs = F.regexp_extract_all("html", F.lit(ANCHOR_RE), 1)
    inner = F.regexp_extract_all("html", F.lit(ANCHOR_RE), 2)
    a = pages.select("page_id", "url", F.posexplode(F.arrays_zip(attrs.alias("attrs"),
                                                                 inner.alias("inner"))))
    a = a.select("page_id", "url", F.col("pos"),
                 F.col("col.attrs").alias("attrs"), F.col("col.inner").alias("inner"))
    if cls is not None:
        a = a.where(F.col("attrs").rlike(class_re(cls)))
    href = F.concat(*[F.regexp_extract("attrs", HREF_RE, g) for g in (1, 2, 3)])
    return a.select("page_id", "url", "pos",
                    tx.decode_references(_first_text(F.col("inner"))).alias("text"),
                    tx.decode_references(href).alias("href"))


def first_link_with_text(pages: DataFrame, text: str) -> DataFrame:
    """Per page, the href of the first anchor whose text equals ``text``
    (``min_by`` over the page's anchors, no sort)."""
    a = anchors(pages).where(F.col("text") == F.lit(text))
    return a.groupBy("page_id").agg(F.min_by("href", "pos").alias("href"))


def first_element_text(html: Column, tag: str, cls: str) -> Column:
    """Text of the first ``<tag class="cls">`` element (null if none)."""
    pat = r"(?s)<" + tag + r"\s[^>]*" + class_re(cls) + r"[^>]*>([^<]*)"
    hit = F.regexp_extract(html, pat, 1)
    found = html.rlike(r"(?s)<" + tag + r"\s[^>]*" + class_re(cls) + r"[^>]*>")
    return F.when(found, hit)


def _element_re(tag: str, attribute: tuple[str, str] | None) -> str:
    if attribute:
        return rf"(?is)<{tag}\s[^>]*{attribute_re(*attribute)}[^>]*>(.*?)</{tag}>"
    return rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>"


def has_article(html: Column, tag: str = "article", attribute: tuple[str, str] | None = None) -> Column:
    return html.rlike(_element_re(tag, attribute))


def article_text(html: Column, tag: str = "article", attribute: tuple[str, str] | None = None) -> Column:
    """E5 + F5 + F6: every body of the page, joined the way a list of elements
    prints (``", "`` between them), tags removed and outer brackets stripped; a
    page without one gives null (dropped by the join). A body is a ``tag``
    element, of a given ``attribute`` (name, value) if any, such as
    ``("name", "articleBody")`` of ``section``."""
    bodies = F.array_join(F.regexp_extract_all(html, F.lit(_element_re(tag, attribute)), 1), ", ")
    return F.when(has_article(html, tag, attribute), tx.strip_brackets(tx.strip_tags(bodies)))


def page_title(html: Column) -> Column:
    return F.regexp_extract(html, TITLE_RE, 1)


def first_table(pages: DataFrame) -> DataFrame:
    """Rows of the first ``<table>`` of each page as
    ``(page_id, row_no, cells array<string>)``; header cells included. A table
    inside a cell is part of that cell's text."""
    table = F.get(bodies(F.regexp_replace("html", RAW_RE, ""), ["table"]), 0)
    rows = F.transform(bodies(table, ["tr"]), lambda r: F.transform(
        bodies(r, ["td", "th"]),
        lambda c: F.btrim(F.when(c.contains("<"), tx.strip_tags(c)).otherwise(c), F.lit(tx.WS_CHARS))))
    return (pages.select("page_id", F.posexplode(rows).alias("row_no", "cells"))
            .where(F.size("cells") > 0))


def repo_cards(pages: DataFrame, card_cls: str = "pinned-repo-item-content",
               name_cls: str = "repo js-repo") -> DataFrame:
    """One row per repository card: ``(page_id, card_no, name, url, description)``.

    A card is the ``<div class=card_cls>`` block up to its own end tag; ``name`` is the
    text of its ``<span class=name_cls>``, ``url`` the enclosing anchor's href resolved
    against the page url (F11), ``description`` its first ``<p>``'s text.
    """
    found = elements(F.regexp_replace("html", RAW_RE, ""), ["div"], class_re(card_cls))
    c = pages.select("page_id", "url", F.posexplode(found).alias("card_no", "card"))
    c = c.withColumn("card", F.col("card")["body"])
    span = (r"""(?s)<a\s[^>]*href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))[^>]*>\s*<span\s[^>]*"""
            + class_re(name_cls) + r"[^>]*>([^<]*)")
    href = F.concat(*[F.regexp_extract("card", span, g) for g in (1, 2, 3)])
    return c.select("page_id", "card_no",
                    F.regexp_extract("card", span, 4).alias("name"),
                    tx.absolute_url(F.col("url"), href).alias("repo_url"),
                    F.regexp_extract("card", r"(?s)<p(?:\s[^>]*)?>([^<]*)", 1).alias("description"))


def repo_counts(pages: DataFrame) -> DataFrame:
    """E4 counters: stars (``a.social-count``), forks (href ends ``network``),
    watchers (href ends ``watchers``), language (first ``span.lang``)."""
    # other anchors would only be sorted; pages without one of these get nulls by the join
    a = anchors(pages).where(F.col("href").endswith("network") | F.col("href").endswith("watchers"))
    firsts = a.groupBy("page_id").agg(
        F.min_by(F.when(F.col("href").endswith("network"), F.col("text")),
                 F.when(F.col("href").endswith("network"), F.col("pos"))).alias("_forks"),
        F.min_by(F.when(F.col("href").endswith("watchers"), F.col("text")),
                 F.when(F.col("href").endswith("watchers"), F.col("pos"))).alias("_watch"))
    base = pages.select("page_id",
                        first_element_text(F.col("html"), "a", "social-count js-social-count").alias("_stars"),
                        first_element_text(F.col("html"), "span", "lang").alias("language"))
    return base.join(firsts, "page_id", "left").select(
        "page_id", "language",
        tx.parse_count("_stars").alias("stars"), tx.parse_count("_forks").alias("forks"),
        tx.parse_count("_watch").alias("watch"))


def is_repo_page(html: Column) -> Column:
    """The search-scope label mentions 'repository'; null without the label."""
    label = first_element_text(html, "a", "header-search-scope no-underline")
    return F.when(label.isNotNull(), label.contains("repository"))


def repo_of_page(pages: DataFrame) -> DataFrame:
    """The page itself when it is a repository page, else its first card
    (null when it has none)."""
    kind = pages.select("page_id", "url", is_repo_page(F.col("html")).alias("is_repo"))
    first = repo_cards(pages).where(F.col("card_no") == 0).select("page_id", "name", "repo_url")
    j = kind.join(first, "page_id", "left")
    return j.select("page_id", "is_repo",
                    F.when(F.col("is_repo"), F.col("url")).otherwise(F.col("repo_url")).alias("repo_url"))


def coin_records(pages: DataFrame, latest: DataFrame | None = None) -> DataFrame:
    """One record per coin page: symbol (F8 on the ``small.bold hidden-xs``
    text), source-code link (E2) and, if given, the latest price row (O5) whose
    ``coin`` is the page's: the last part of its URL's path."""
    sym = tx.inner_text(first_element_text(F.col("html"), "small", "bold hidden-xs"))
    coin = F.regexp_extract("url", r"^[^?#]*?([^/?#]+)/*(?:[?#].*)?$", 1)
    base = pages.select("page_id", "url", coin.alias("coin"), sym.alias("symbol"))
    src = first_link_with_text(pages, "Source Code").withColumnRenamed("href", "github_url")
    out = base.join(src, "page_id", "left")
    if latest is not None:
        out = out.join(latest, "coin", "left")
    return out
