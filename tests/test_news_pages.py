"""News scoring and page extraction on inline fixtures."""

import json

from pyspark.sql import functions as F

from tickwise.operators import news
from tickwise.operators import pages as P


def test_sentiment_map_and_join_paths_agree(spark):
    docs = spark.createDataFrame([(1, "good good gain!"), (2, "bad, crash"), (3, ""), (4, None),
                                  (5, "GOOD news")], "id long, content string")
    docs = news.clean_content(docs)
    lex = {"good": 1.9, "gain": 1.6, "bad": -2.5, "crash": -1.7, "news": 0.0}
    a = {r.id: (r.SENTIMENT_VALUE, r.SENTIMENT) for r in news.with_sentiment(docs, lexicon=lex).collect()}
    # a table that lists a word twice takes the larger valence
    lex_df = spark.createDataFrame([*lex.items(), ("good", 0.1)], "word string, valence double")
    b = {r.id: (r.SENTIMENT_VALUE, r.SENTIMENT) for r in
         news.with_sentiment(docs, lexicon=lex_df).collect()}
    assert a == b
    # rows that share an id are scored by their own text; repeated rows alike
    same = news.clean_content(spark.createDataFrame(
        [(1, "good"), (1, "bad"), (1, "bad"), (None, "good")], "id long, content string"))
    by_map = sorted(r.SENTIMENT_VALUE for r in news.with_sentiment(same, lexicon=lex).collect())
    by_join = sorted(r.SENTIMENT_VALUE for r in news.with_sentiment(same, lexicon=lex_df).collect())
    assert by_map == by_join and len(set(by_map)) == 2
    s = 1.9 * 2 + 1.6
    assert a[1][0] == round(round(s / (s * s + 15) ** 0.5, 4), 1)
    assert a[2][1] in ("Very Negative", "Negative")
    assert a[3] == (0.0, "Neutral")
    assert a[4] == (None, None)


def test_sections_are_start_anchored(spark):
    df = spark.createDataFrame([("World",), ("U.S.",), ("UXS.",), ("Business Day",), ("Arts",)], "section_name string")
    got = [r.section for r in news.section_of(df).collect()]
    assert got == ["World", "U.S.", "U.S.", "Business", None]


def test_archive_flatten(spark, tmp_dir):
    from tickwise.sources import files
    docs = [{"web_url": f"u{i}", "headline": {"main": f"h{i}"}, "byline": {"original": "By Ann Byrd"},
             "document_type": "article" if i % 3 else "blogpost", "pub_date": "2019-01-01T00:00:00+0000",
             "source": "NYT", "section_name": ["World", "Arts", "U.S."][i % 3], "word_count": i}
            for i in range(12)]
    with open(f"{tmp_dir}/a.json", "w") as fh:
        json.dump({"response": {"docs": docs}}, fh)
    raw = files.read_archive(spark, f"{tmp_dir}/a.json")
    got = news.flatten_archive(raw).orderBy("web_url").collect()
    # World or U.S.; document_type article (i % 3 != 0)
    assert [r.web_url for r in got] == ["u11", "u2", "u5", "u8"]
    got = got[1:]
    assert got[0].author == "Ann Byrd" and got[0].headline == "h2"


PAGE = """<html><head><title>Coin X</title></head><body>
<small class="bold hidden-xs">(XCN)</small>
<a href="/a" class="currency-name-container link-secondary">Alpha</a>
<a class="currency-name-container link-secondary" href="/b">Beta</a>
<a href="https://github.com/xcoin">Source Code</a><a href="/later">Source Code</a>
<a class="header-search-scope no-underline" href="#">This repository</a>
<div class="pinned-repo-item-content"><a href="/xcoin/core"><span class="repo js-repo">core</span></a>
<p>The node</p></div>
<a class="social-count js-social-count" href="/s"> 1,234 </a>
<a href="/xcoin/core/network">56</a><a href="/xcoin/core/watchers">7</a><span class="lang">Go</span>
<table><tr><th>Date</th><th>Open*</th></tr>
<tr><td>Mar 01, 2019</td><td><b>3,800.1</b></td></tr></table>
<article><p>Body [one]</p>
<p>two</p></article><article>three</article></body></html>"""


def _pages(spark):
    return spark.createDataFrame([(1, "https://site.example/coins/x", PAGE),
                                  (2, "https://site.example/y", "<p>no markup</p>")],
                                 "page_id long, url string, html string")


def test_archive_responses_are_bounded_by_rows(spark):
    from tickwise.plans import files_q
    rows = [(7 if k % 3 == 0 else None if k % 3 == 1 else k, "en", "src1", k) for k in range(7000)]
    d = spark.createDataFrame(rows, "doc_id long, lang string, source string, n_chars int").repartition(3)
    got = [r[0] for r in files_q.archive_responses(d).collect()]
    assert max(map(len, got)) <= files_q.DOCS_PER_RESPONSE
    assert sorted(x["word_count"] for docs in got for x in docs) == list(range(7000))


def test_anchor_extraction(spark):
    p = _pages(spark)
    cls = P.anchors(p, "currency-name-container link-secondary").orderBy("pos").collect()
    assert [(r.text, r.href) for r in cls] == [("Alpha", "/a"), ("Beta", "/b")]
    src = {r.page_id: r.href for r in P.first_link_with_text(p, "Source Code").collect()}
    assert src == {1: "https://github.com/xcoin"}


def test_anchors_of_every_form(spark):
    html = """<A CLASS='k' HREF='/up?a=1&amp;b=2'>Upper &amp;lt; &#233;&#x1F600; &nope; & x</A>
<a
  class="k"
  href="/two
lines">over
two lines</a><a class="k">bare</a><a data-href="/no" href="/yes">d</a>"""
    p = spark.createDataFrame([(1, "https://s.example/", html), (2, "u", None), (3, "u", "")],
                              "page_id long, url string, html string")
    got = [(r.page_id, r.text, r.href) for r in P.anchors(p).orderBy("pos").collect()]
    assert got == [(1, "Upper &lt; \u00e9\U0001f600 &nope; & x", "/up?a=1&b=2"),
                   (1, "over\ntwo lines", "/two\nlines"), (1, "bare", ""), (1, "d", "/yes")]
    assert [r.text for r in P.anchors(p, "k").orderBy("pos").collect()][1:] == ["over\ntwo lines", "bare"]


def test_article_by_element_and_attribute(spark):
    html = """<section name="top">no</section><SECTION class='x' name='articleBody'><p>One [1]</p>
two</SECTION><article>other</article>"""
    p = spark.createDataFrame([(1, html), (2, "<section>no</section>")], "page_id long, html string")
    body = P.article_text(F.col("html"), "section", ("name", "articleBody"))
    assert [r.b for r in p.select(body.alias("b")).collect()] == ["One [1]\ntwo", None]


def test_coin_records_join_on_the_coin(spark):
    p = spark.createDataFrame([(1, "https://s.example/currencies/alpha/?x=1", "<p>a</p>"),
                               (2, "https://s.example/currencies/beta", "<p>b</p>")],
                              "page_id long, url string, html string")
    latest = spark.createDataFrame([("alpha", 2.5)], "coin string, close double")
    got = {r.page_id: (r.coin, r.close) for r in P.coin_records(p, latest).collect()}
    assert got == {1: ("alpha", 2.5), 2: ("beta", None)}


def test_elements_cards_counts_tables(spark):
    p = _pages(spark)
    r = p.select(P.first_element_text(F.col("html"), "small", "bold hidden-xs").alias("s"),
                 P.is_repo_page(F.col("html")).alias("repo"), P.article_text(F.col("html")).alias("body"),
                 P.page_title(F.col("html")).alias("title")).collect()
    assert r[0].s == "(XCN)" and r[0].repo is True and r[0].title == "Coin X"
    assert r[0].body == "Body [one]\ntwo, three"
    assert r[1].s is None and r[1].repo is None and r[1].body is None
    cards = P.repo_cards(p).collect()
    assert [(c.name, c.repo_url, c.description) for c in cards] == \
        [("core", "https://site.example/xcoin/core", "The node")]
    counts = {c.page_id: c for c in P.repo_counts(p).collect()}
    assert (counts[1].stars, counts[1].forks, counts[1].watch, counts[1].language) == (1234, 56, 7, "Go")
    t = P.first_table(p).orderBy("row_no").collect()
    assert [list(x.cells) for x in t] == [["Date", "Open*"], ["Mar 01, 2019", "3,800.1"]]
    rec = P.coin_records(p).where("page_id = 1").first()
    assert rec.symbol == "XCN" and rec.github_url == "https://github.com/xcoin"
    repo = {x.page_id: x.repo_url for x in P.repo_of_page(p).collect()}
    assert repo[1] == "https://site.example/coins/x"


def test_articles_do_not_depend_on_file_layout(spark, tmp_dir):
    """One URL fills a third of the pages: same rows for any layout."""
    import __spark_entry__ as E
    data = [(i, "http://x/hot" if i % 3 == 0 else f"http://x/{i}",
             f"<title>t{i}</title><article>body {i}</article>") for i in range(300)]
    df = spark.createDataFrame(data, "page_id long, url string, html string")
    seen = set()
    for n in (1, 3, 9):
        df.repartition(n).write.parquet(f"{tmp_dir}/{n}/pages.parquet")
        got = E.queries()["page_articles"](spark, f"{tmp_dir}/{n}").collect()
        assert len(got) == 201
        seen.add(tuple(sorted(map(tuple, got))))
        assert [(r.page_id, r.content) for r in got if r.web_url == "http://x/hot"] == [(0, "body 0")]
    assert len(seen) == 1


def _elements_plain(html, tags, cls=None):
    """Outermost elements by a plain walk over the tags."""
    import re
    out, depth, start = [], 0, 0
    for m in re.finditer(r"(?is)<(/?)(%s)(?=[\s/>])[^>]*>" % "|".join(tags), html):
        if not m.group(1):
            if depth == 0 and cls is not None and f'class="{cls}"' not in m.group():
                continue
            if depth == 0:
                start = m.end()
            depth += 1
        elif depth:
            depth -= 1
            if depth == 0:
                out.append(html[start:m.start()])
    return out + ([html[start:]] if depth else [])


def test_elements_carry_their_depth(spark):
    import random
    rng = random.Random(8)
    parts = ["<div>", '<div class="x">', "</div>", "<p>", "</p>", "text", "<divide>", "<DIV\n>", "</Div >", "<td>", ""]
    pages = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(200)] + ["", "no tags"]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(pages)] + [(-1, None)], "i int, h string")
    got = {r.i: r for r in df.select(
        "i", F.transform(P.elements(F.col("h"), ["div"]), lambda e: e["body"]).alias("any"),
        F.transform(P.elements(F.col("h"), ["div", "p"], P.class_re("x")), lambda e: e["body"]).alias("x")).collect()}
    for i, h in enumerate(pages):
        assert got[i]["any"] == _elements_plain(h, ["div"])
        assert got[i].x == _elements_plain(h, ["div", "p"], "x")
    assert got[-1]["any"] is None


def test_nested_tables_and_cards(spark):
    nested = ("<!-- <table><tr><td>no</td></tr></table> --><table><tr><th>a</th></tr>"
              "<tr><td>x<table><tr><td>in</td><td>ner</td></tr></table>y</td><td>2</td></tr>"
              "<tr></tr></table><table><tr><td>second</td></tr></table>")
    card = ('<div class="pinned-repo-item-content"><div><a href=/o/r><span class="repo js-repo">r</span></a></div>'
            "<p>about <b>it</b></p></div><p>outside</p>")
    pages = spark.createDataFrame([(1, "https://h/x", nested), (2, "https://h/x", card), (3, None, None), (4, "u", "")],
                                  "page_id long, url string, html string")
    assert [(r.row_no, r.cells) for r in P.first_table(pages).orderBy("row_no").collect()] == \
        [(0, ["a"]), (1, ["xinnery", "2"])]
    assert [tuple(r) for r in P.repo_cards(pages).collect()] == [(2, 0, "r", "https://h/o/r", "about ")]


def test_hrefs_without_quotes(spark):
    pages = spark.createDataFrame([(1, "https://h/", "<a href=foo>t</a><a class=x href=/b?c=1&amp;d=2>u</a><a href=''>v</a>")],
                                  "page_id long, url string, html string")
    assert [r.href for r in P.anchors(pages).orderBy("pos").collect()] == ["foo", "/b?c=1&d=2", ""]


def _context_plain(text, lexicon, modifiers):
    import re
    ws = [w for w in (re.sub(r"^[^\w]+|[^\w]+$", "", t) for t in text.split()) if w]
    total = 0.0
    for i, w in enumerate(ws):
        if w in lexicon:
            near = [ws[i - d] if i >= d else None for d in (1, 2, 3)]
            v = lexicon[w]
            more = sum(modifiers.get(n, (0.0, False))[0] * x for n, x in zip(near, news.REACH_DAMPING))
            v += (1 if v > 0 else -1) * more
            if any(modifiers.get(n, (0.0, False))[1] for n in near):
                v *= news.NEGATION
            total += v
    return total


def test_negations_and_boosters(spark):
    import random
    rng = random.Random(6)
    words = ["good", "bad", "not", "very", "slightly", "never", "day,", "great!", "--", "loss"]
    texts = ["not good", "good", "very good", "bad", "not bad", "not a b c good", "not a b good", "very not good",
             "", "very", "good not", *[" ".join(rng.choice(words) for _ in range(rng.randrange(25))) for _ in range(60)]]
    rows = [(i, t) for i, t in enumerate(texts)] + [(-1, None), (3, "good"), (None, "not good")]
    docs = spark.createDataFrame(rows, "id int, t string").repartition(3)
    lex, mods = news.DEMO_LEXICON, news.DEMO_MODIFIERS
    table = spark.createDataFrame([(w, float(v)) for w, v in lex.items()], "word string, valence double")
    by_map = news.with_sentiment(docs, "t", lex, modifiers=mods).collect()
    by_join = news.with_sentiment(docs, "t", table, modifiers=mods).collect()
    key = lambda r: (str(r.id), str(r.t), r.SENTIMENT_VALUE, r.SENTIMENT)     # noqa: E731
    assert sorted(map(key, by_map)) == sorted(map(key, by_join))
    for r in by_map:
        if r.t is None:
            assert r.SENTIMENT_VALUE is None and r.SENTIMENT is None
            continue
        s = _context_plain(r.t, lex, mods)
        assert r.SENTIMENT_VALUE == round(round(s / (s * s + 15) ** 0.5, 4), 1)
    got = {r.t: r.SENTIMENT_VALUE for r in by_map}
    assert got["not good"] < 0 < got["good"] <= got["very good"] and got["not a b c good"] == got["good"]
    assert news.with_sentiment(docs.where("false"), "t", table, modifiers=mods).count() == 0


def test_elements_by_pattern_equal_the_scan(spark):
    """Random markup: quotes, stray ends, no ends, any depth, empty bodies."""
    import random
    rng = random.Random(21)
    parts = ["<td>", "<TH\n a='>'>", "</td>", "</Th >", "<td b=\"<td>\">", "<td '>", "<tdx>", "<", ">", "x", "\n", "<td/>", "</td", '"']
    pages = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(1500)]
    pages += ["<td>" * n + "x" + "</td>" * m for n in range(9) for m in range(9)] + ["", "no tags", "<td></td><td>x</td>"]
    df = spark.createDataFrame([(i, h) for i, h in enumerate([*pages, None])], "i int, h string").repartition(4)
    h, tags = F.col("h"), ["td", "th"]
    body = lambda c: F.transform(c, lambda e: e["body"])     # noqa: E731
    got = df.select("i", "h", P.elements(h, tags).alias("e"), P.bodies(h, tags).alias("b"), P._scan(h, tags).alias("s"),
                    body(P.elements(h, tags, "b=")).alias("ea"), body(P._scan(h, tags, "b=")).alias("sa")).collect()
    assert len(got) == len(pages) + 1
    for r in got:
        assert r.e == r.s and r.ea == r.sa, r.h
        assert r.b == (None if r.s is None else [e.body for e in r.s]), r.h
    assert sum(bool(r.s) for r in got) > 500


def test_tables_without_a_scan(spark, monkeypatch):
    """Pages whose elements lie a few deep take patterns alone, long ones too (finding F1)."""
    def never(h, tags, attribute=None):
        return F.raise_error(F.lit("scanned")).cast("array<struct<head:string,body:string>>")
    monkeypatch.setattr(P, "_scan", never)
    cell = "<td> a <table><tr><td>in</td><td>ner<table><tr><td>!</td></tr></table></td></tr></table>　</td><td></td>"
    rows = 4000
    html = ["<table><tr><th>h</th></tr>" + f"<TR>{cell}</TR>" * n + "</table><table><tr><td>no</td></tr></table>" for n in (1, 2, rows)]
    html.append("<table><tr><td>" + "x <b>y</b> " * 50_000 + "</td></tr>")
    got = P.first_table(spark.createDataFrame(list(enumerate(html)), "page_id int, html string")).collect()
    by = {}
    for r in got:
        by.setdefault(r.page_id, {})[r.row_no] = r.cells
    assert by[0] == {0: ["h"], 1: ["a inner!", ""]}
    assert len(by[2]) == rows + 1 and by[2][rows] == ["a inner!", ""]
    assert by[3] == {0: ["x y " * 49_999 + "x y"]}


def test_repo_records_deal_pages_to_tasks_by_number(spark, tmp_dir, monkeypatch):
    """No task joins more than a few times PAGES_PER_TASK pages, of one file and
    row group too (finding F2)."""
    from tickwise.plans import pages_q
    monkeypatch.setattr(pages_q, "PAGES_PER_TASK", 50, raising=False)
    rows = [(k, f"name {k}", "Brand#1", f"TYPE {k % 7}") for k in range(4000)]
    part = spark.createDataFrame([*rows, (None, "no key", "Brand#1", "T")],
                                 "p_partkey long, p_name string, p_brand string, p_type string")
    part.coalesce(1).write.parquet(f"{tmp_dir}/part.parquet")
    out = pages_q.q_repo_records(spark, tmp_dir)
    got = out.withColumn("task", F.spark_partition_id()).collect()
    assert sorted((r.page_id, r.name, r.cards, r.stars, r.forks, r.watch) for r in got) == \
        [(k, n, 2, 7 * k, k, None) for k, n, _, _ in rows]
    tasks = {}
    for r in got:
        tasks[r.task] = tasks.get(r.task, 0) + 1
    assert max(tasks.values()) <= 150


def test_counts_of_pages_without_the_links(spark):
    pages = spark.createDataFrame(
        [(1, "<a href=/x/network>5</a><a href=/y/network>6</a><a href=/z>7</a>"), (2, "<a href=/z>7</a>"), (3, None),
         (4, "<a href=/watchers>1,000</a>")], "page_id long, html string").withColumn("url", F.lit("u"))
    assert sorted((r.page_id, r.forks, r.watch) for r in P.repo_counts(pages).collect()) == \
        [(1, 5, None), (2, None, None), (3, None, None), (4, None, 1000)]
