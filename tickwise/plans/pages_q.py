"""Named queries over crawled pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickwise.functions import text as tx
from tickwise.operators import filters, stats
from tickwise.operators import pages as P
from tickwise.session import written
from tickwise.sources import tables

LINK_TEXT = "the"        # E2 parameter for the registered query
NTH_LINK = 2             # P18 place, from 0
# Rendered pages that one task holds at a time: what it sorts and joins stays as
# large on any input, as the tasks grow in number.
PAGES_PER_TASK = 10_000


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def q_page_links(spark, sf_dir):
    """E1 + F10 + F11: every anchor with its absolute URL."""
    a = P.anchors(tables.pages(spark, sf_dir))
    return a.select("page_id", "pos", "text", "href",
                    tx.absolute_url(F.col("url"), F.col("href")).alias("abs_url"),
                    tx.ends_with("href", "e").alias("ends_e"))


def q_page_first_link(spark, sf_dir):
    """First link per page whose text equals a value."""
    return P.first_link_with_text(tables.pages(spark, sf_dir), LINK_TEXT)


def q_page_nth_link(spark, sf_dir):
    """The link at a place of every page's listing."""
    a = filters.nth_by_rank(P.anchors(tables.pages(spark, sf_dir)), "pos", NTH_LINK)
    return a.select("page_id", "text", "href")


def q_page_ad_text(spark, sf_dir):
    """Text of the first ``div.ad`` element."""
    p = tables.pages(spark, sf_dir)
    return p.select("page_id", P.first_element_text(F.col("html"), "div", "ad").alias("ad_text"))


def q_page_articles(spark, sf_dir):
    """E5 + J2 + A13: article bodies joined to page metadata by URL, one per URL."""
    p = tables.pages(spark, sf_dir)
    bodies = p.where(P.has_article(F.col("html"))) \
        .select("page_id", F.col("url").alias("web_url"), P.article_text(F.col("html")).alias("content"))
    meta = p.select("page_id", F.col("url").alias("web_url"), P.page_title(F.col("html")).alias("headline"))
    # one row per URL on either side before the join, so a repeated URL costs
    # one row per task; page_id makes the first one unique
    first = stats.dedup_first(bodies, "web_url", ["page_id"]).select("web_url", "content")
    j = first.join(stats.dedup_first(meta, "web_url", ["page_id"]), "web_url")
    return j.select("page_id", "web_url", "headline", "content")


def _cell(c, tag="td"):
    return F.concat(F.lit(f"<{tag}>"), c.cast("string"), F.lit(f"</{tag}>"))


def order_pages(lineitem):
    """An order as a page: a table of its lines, with a table inside the last cell."""
    inner = F.concat(F.lit('<table class="x"><tr><td>shipped</td><td>'),
                     F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("</td></tr></table>"))
    row = F.concat(F.lit("<TR class='line'>"), _cell(F.col("l_linenumber")), _cell(F.col("l_partkey")),
                   F.lit("<td\n align=right> "), F.col("l_quantity").cast("int").cast("string"), F.lit(" </td>"),
                   _cell(inner), F.lit("</TR>"))
    head = "<tr><th>line</th><th>part</th><th>quantity</th><th>more</th></tr>"
    lines = F.array_join(F.transform(F.sort_array(F.collect_list(
        F.struct("l_linenumber", "l_partkey", "l_quantity", "l_shipdate", row.alias("row")))), lambda x: x["row"]), "")
    return lineitem.groupBy(F.col("l_orderkey").alias("page_id")).agg(F.concat(
        F.lit(f"<html><!-- <table><tr><td>no</td></tr></table> --><body><table border=1>{head}"), lines,
        F.lit("</table><table><tr><td>second</td></tr></table></body></html>")).alias("html"))


def q_order_tables(spark, sf_dir):
    """Orders rendered as pages with nested tables, written and read back."""
    html = written(order_pages(tables.table(spark, sf_dir, "lineitem")), "order-pages")
    return P.first_table(html)


def repo_pages(part):
    """A part as a repository page: two cards with nested blocks, counters, a symbol."""
    key = F.col("p_partkey").cast("string")
    count = F.format_number(F.col("p_partkey") * 7, 0)

    def card(no, name, text):
        return F.concat(
            F.lit('<div class="pinned-repo-item-content"><div class="d-flex"><div>'),
            F.lit("<a class=text-bold href=/"), F.col("p_brand"), F.lit("/"), key, F.lit(f"-{no}>\n<span class='repo js-repo'>"),
            name, F.lit("</span></a></div></div><p class=note>"), text, F.lit("</p></div>"))

    scope = F.when(F.col("p_partkey") % 2 == 0, "This repository").otherwise("This organization")
    html = F.concat(
        F.lit('<a class="header-search-scope no-underline">'), scope, F.lit("</a>"),
        F.lit('<small class="bold hidden-xs">('), F.col("p_brand"), F.lit(")</small>"),
        card(0, F.col("p_name"), F.col("p_type")), card(1, F.lit("second"), F.lit("other")),
        F.lit('<a class="social-count js-social-count"> '), count, F.lit(" </a><a href=/x/network>"), key,
        F.lit("</a><a href='/x/watchers'> n/a </a><span class=\"lang\">"), F.col("p_type"),
        F.lit("</span><a href=https://code.example/"), key, F.lit(">Source Code</a>"))
    return part.select(F.col("p_partkey").cast("long").alias("page_id"),
                       F.concat(F.lit("https://hub.example/coin-"), key, F.lit("/?tab=1")).alias("url"), html.alias("html"))


def q_repo_records(spark, sf_dir):
    """E4 + E6 + E8 + F8 + F9: cards, counters and coin records of rendered pages."""
    part = tables.table(spark, sf_dir, "part")
    n = max(spark.sparkContext.defaultParallelism, -(-part.count() // PAGES_PER_TASK))
    # rendered by as many tasks; then dealt by page once, for every step and join
    p = written(repo_pages(part.repartition(n, "p_partkey")), "repo-pages").repartition(n, "page_id")
    first = P.repo_cards(p).where("card_no = 0").select("page_id", "name", "description")
    cards = P.repo_cards(p).groupBy("page_id").agg(F.count(F.lit(1)).alias("cards"))
    out = P.repo_counts(p)
    for other in (first, cards, P.repo_of_page(p), P.coin_records(p).drop("url")):
        out = out.join(other, "page_id")
    return out


QUERIES = {
    "order_tables": q_order_tables,
    "repo_records": q_repo_records,
    "page_links": q_page_links,
    "page_first_link": q_page_first_link,
    "page_nth_link": q_page_nth_link,
    "page_ad_text": q_page_ad_text,
    "page_articles": q_page_articles,
}

# The SQL has patterns of its own, not those of the operators.
_REFS = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", "\u00a0"), ("&amp;", "&")]


def _plain(x: str) -> str:
    for ref, sign in _REFS:
        x = f"replace({x}, {_lit(ref)}, {_lit(sign)})"
    return x


_ANCHORS = f"""tags AS (
  SELECT page_id, url, regexp_extract_all(html, '(?is)<a(?:>|\\s.*?>).*?</a>') AS els FROM pages),
a AS (
  SELECT page_id, url, CAST(unnest(range(len(els))) AS INTEGER) AS pos, unnest(els) AS el FROM tags),
links AS (
  SELECT page_id, url, pos, {_plain("regexp_extract(el, '^[^>]*>([^<]*)', 1)")} AS text,
    {_plain("""regexp_extract(el, '(?i)^<a\\s(?:[^>]*\\s)?href\\s*=\\s*["'']([^"''>]*)', 1)""")} AS href FROM a)"""


def abs_url_sql(b: str, h: str) -> str:
    sh = f"regexp_extract({b}, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1)"
    sc = f"regexp_extract({b}, '^([a-zA-Z][a-zA-Z0-9+.-]*):', 1)"
    bd = f"regexp_extract({b}, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^?#]*/)', 1)"
    return f"""CASE WHEN regexp_matches({h}, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN {h}
  WHEN starts_with({h}, '//') THEN {sc} || ':' || {h}
  WHEN starts_with({h}, '/') THEN {sh} || {h}
  WHEN {h} = '' THEN {b}
  WHEN {bd} <> '' THEN {bd} || {h}
  ELSE {sh} || '/' || {h} END"""


ORACLE = {
    "order_tables": """SELECT l_orderkey AS page_id,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity, l_shipdate) AS INTEGER) AS row_no,
  [CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(CAST(l_quantity AS INTEGER) AS VARCHAR),
   'shipped' || strftime(l_shipdate, '%Y-%m-%d')] AS cells FROM lineitem
UNION ALL
SELECT DISTINCT l_orderkey, 0, ['line', 'part', 'quantity', 'more'] FROM lineitem""",
    "repo_records": """SELECT CAST(p_partkey AS BIGINT) AS page_id, p_type AS language,
  CAST(p_partkey * 7 AS BIGINT) AS stars, CAST(p_partkey AS BIGINT) AS forks, CAST(NULL AS BIGINT) AS watch,
  p_name AS name, p_type AS description, CAST(2 AS BIGINT) AS cards, p_partkey % 2 = 0 AS is_repo,
  CASE WHEN p_partkey % 2 = 0 THEN 'https://hub.example/coin-' || p_partkey || '/?tab=1'
       ELSE 'https://hub.example/' || p_brand || '/' || p_partkey || '-0' END AS repo_url,
  'coin-' || p_partkey AS coin, p_brand AS symbol, 'https://code.example/' || p_partkey AS github_url
FROM part""",
    "page_links": f"""WITH {_ANCHORS}
SELECT page_id, pos, text, href, {abs_url_sql('url', 'href')} AS abs_url, ends_with(href, 'e') AS ends_e
FROM links""",
    "page_first_link": f"""WITH {_ANCHORS}
SELECT page_id, arg_min(href, pos) AS href FROM links WHERE text = {_lit(LINK_TEXT)} GROUP BY page_id""",
    "page_nth_link": f"""WITH {_ANCHORS}
SELECT page_id, text, href FROM links WHERE pos = {NTH_LINK}""",
    "page_ad_text": f"""SELECT page_id,
  CASE WHEN regexp_matches(html, '<div [^>]*class=["'']ad["'']')
  THEN regexp_extract(html, '<div [^>]*class=["'']ad["''][^>]*>([^<]*)', 1) END AS ad_text
FROM pages""",
    "page_articles": f"""WITH b AS (
  SELECT page_id, url AS web_url, regexp_replace(regexp_replace(
    array_to_string(regexp_extract_all(html, '(?s)<article[^>]*>(.*?)</article>', 1), ', '), '<.*?>', '', 'g'),
    {_lit(r'^[\[\]]+|[\[\]]+$')}, '', 'g') AS content
  FROM pages WHERE regexp_matches(html, '(?s)<article(?:\\s[^>]*)?>.*?</article>')),
m AS (SELECT page_id, url AS web_url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS headline FROM pages),
b1 AS (SELECT *, row_number() OVER (PARTITION BY web_url ORDER BY page_id) AS rn FROM b),
m1 AS (SELECT *, row_number() OVER (PARTITION BY web_url ORDER BY page_id) AS rn FROM m)
SELECT m1.page_id, web_url, headline, content FROM b1 JOIN m1 USING (web_url) WHERE b1.rn = 1 AND m1.rn = 1""",
}
