"""Pages, conversations, the registered queries and the pipeline."""

import html as H
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.fixtures import edge_docs, no_docs
from tests.oracle import assert_same, duck
from tickwise.llm import cgk_leaks, chat_parts, fertility, page_diff, secret_owners, simhash_ring
from tickwise.llm import queries as Q


def rows(df):
    return [r.asDict() for r in df.collect()]


# --- 1 pages ---

def test_pages_give_their_article(spark):
    got = {r["page_id"]: r for r in rows(Q.op1_page_diff(spark, SF_SMALL))}
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        inner = re.search(r"(?s)<article>(.*)</article>", p["html"]).group(1)
        blocks = [" ".join(H.unescape(re.sub(r"<[^>]*>", "", x)).split())
                  for x in re.split(r"</?(?:p|h1|br)[^>]*>", inner)]
        assert got[p["page_id"]]["text"] == "\n".join(b for b in blocks if b)


def test_difference_finds_an_unmarked_template(spark):
    def page(k):
        return (f"<html><body><div>Site name</div><div>Contact us</div><div>Story {k} begins.</div>"
                f"<div>It ends &amp; {k}\n  more.</div><div>All rights</div></body></html>")
    data = [(k, f"http://h.example/a/{k:03d}", page(k)) for k in range(40)]
    data += [(100, "http://other.example/x", page(100)), (101, None, None), (102, None, "<p>a<p>b"),
             (103, "http://h.example/a/003", page(3)), (3, "http://h.example/a/003", page(3)), (None, "", "")]
    want = Counter((k, f"Story {k} begins.\nIt ends & {k} more.") for k in range(40))
    want[103, "Story 3 begins.\nIt ends & 3 more."] += 1
    want[3, "Story 3 begins.\nIt ends & 3 more."] += 1
    for parts in (1, 7):
        df = spark.createDataFrame(data, "page_id long, url string, html string").repartition(parts)
        got = rows(page_diff.extract(df))
        assert len(got) == len(data)
        texts = Counter((r["page_id"], r["text"]) for r in got if r["url"] and "h.example" in r["url"])
        assert texts == want
        rest = {r["page_id"]: r["text"] for r in got if r["page_id"] in (101, 102, None)}
        assert rest == {101: "", 102: "a\nb", None: ""}
    assert page_diff.extract(df.limit(0)).count() == 0


def test_marked_furniture_goes():
    page = ("<body><header>top</header><div class='cookie-notice'>We use cookies</div><article><h1>T</h1>"
            "<p>One <b>bold</b>&nbsp;word<aside>side</aside><p class=ad>buy</p><script>x</script>two"
            "<form>f<button>b</button></form><section id='comments'><p>me too</p></section></article>"
            "<div>outside</div><footer>end</footer>")
    lines = page_diff.page_lines(page)
    assert page_diff.main_lines([(t, m) for t, m, _ in lines], set()) == ["T", "One bold word", "two"]


def extracted(spark, pages):
    data = [(k, f"http://h.example/a/{k:03d}", p) for k, p in enumerate(pages)]
    got = rows(page_diff.extract(spark.createDataFrame(data, "page_id long, url string, html string")))
    return [r["text"] for r in sorted(got, key=lambda r: r["page_id"])]


def test_body_outside_an_article_stays(spark):
    def page(k):
        return (f"<body><div>Site name</div><div><p>Body {k} begins.<p>Quoted line.<p>Body {k} ends.</div>"
                f"<article><h2>Next story {k}</h2></article><div>All rights</div></body>")
    pages = [page(k).replace("<p>Quoted line.", "" if k % 2 else "<p>Quoted line.") for k in range(12)]
    quoted = ["", "\nQuoted line."]
    assert extracted(spark, pages) == [f"Body {k} begins.{quoted[1 - k % 2]}\nBody {k} ends.\nNext story {k}"
                                       for k in range(12)]
    alone = page_diff.page_lines(page(0))                          # no neighbour: nothing is known to be shared
    assert "Body 0 begins." in page_diff.main_lines([(t, m) for t, m, _ in alone], set())


@pytest.mark.parametrize("wrap", [
    "<div class='has-sidebar'>", "<div class='layout no-sidebar with-sidebar'>", "<section id='discussion'>",
    "<div id='page' class='page-with-comments'>", "<div class='post social-share-enabled'>", "<div id='related-work'>",
    "<div class='sidebar'><article>", "<div class='sidebar'><main class='content'>",
    "<div class=sidebar><div itemprop=articleBody>", "<div class='comments'><article class='post has-comments'>"])
def test_layout_wrappers_keep_their_text(spark, wrap):
    pages = [f"<body><nav>menu {k}</nav><div class='ad'>Buy {k}</div>{wrap}<p>Body {k} begins.<p>Body {k} ends."
             for k in range(5)]
    assert extracted(spark, pages) == [f"Body {k} begins.\nBody {k} ends." for k in range(5)]


def test_cued_lines_go_where_a_neighbour_has_their_place(spark):
    def page(k):
        said = "".join(f"<article class='comment-body'><p>said {k} {j}</p></article>" for j in range(1 + 3 * k % 5))
        return (f"<body><div class='cookie-notice'>Cookies {k}</div><main><p>Body {k}.</p></main>"
                f"{'<div class=banner>Only here.</div>' if k == 2 else ''}<section id=comments>{said}</section></body>")
    assert extracted(spark, [page(k) for k in range(5)]) == [
        f"Body {k}." + ("\nOnly here." if k == 2 else "") for k in range(5)]


def lcs_plain(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            t[i][j] = t[i - 1][j - 1] + 1 if x == y else max(t[i - 1][j], t[i][j - 1])
    return t[-1][-1]


@pytest.mark.parametrize("cells", [1 << 28, 30])
def test_shared_lines_are_a_longest_subsequence(monkeypatch, cells):
    import random
    monkeypatch.setattr(page_diff, "_CELLS", cells)
    rng = random.Random(5)
    for _ in range(300):
        a = [rng.randrange(6) for _ in range(rng.randrange(25))]
        b = [rng.randrange(6) for _ in range(rng.randrange(25))]
        s = sorted(page_diff.shared_lines(a, b))
        assert len(s) == lcs_plain(a, b)
        it = iter(b)
        assert all(x in it for x in (a[i] for i in s))


# --- 3 conversations ---

def test_chat_oracle(spark):
    assert_same(Q.op3_chat_parts(spark, SF_SMALL), duck(SF_SMALL), Q.OP3_SQL)


def test_chat_round_trip_with_hostile_texts(spark):
    texts = ["<|turn|>user<|says|>x<|end|>", "\\", "\\\\<\\|", "<", "|", "", None, "😀<|", "a\nb\\n", "<\\|<|\\"]
    data = [(1, k, "assistant" if k % 2 else "us<|er\\", t, "x") for k, t in enumerate(texts)]
    data += [(None, 0, None, "no id", "x"), (2, None, "assistant", "t", "x"), (2, None, "assistant", "t", "x")]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, formatted string")
    out = chat_parts.format_chats(df)
    got = {r["conv_id"]: r for r in rows(out.select(
        "conv_id", "n_turns", chat_parts.read_turns(out["formatted"]).alias("turns"),
        chat_parts.loss_text(out["formatted"], out["loss_spans"]).alias("loss")))}
    assert [(t["role"], t["text"]) for t in got[1]["turns"]] == [(r[2], r[3] or "") for r in data[:len(texts)]]
    assert got[1]["loss"] == "".join(t or "" for t in texts[1::2])
    assert got[None]["turns"][0]["role"] == "" and got[2]["n_turns"] == 2
    assert chat_parts.format_chats(df.limit(0)).count() == 0


def test_chat_parts_are_placed_in_order(spark):
    parts = [("text", "see <|", None, None), ("image", None, "i.png", 2), ("text", " and ", None, None),
             ("audio", None, "a.wav", None), ("document", "ignored", "d.pdf", 3), ("strange", "kept", None, 1)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)],
                               f"conv_id long, turn int, role string, parts array<{chat_parts.PART}>")
    r = rows(chat_parts.format_chats(df))[0]
    assert r["formatted"] == ("<|turn|>user<|says|>see <\\|<|image|> and <|audio|><|document|>kept<|end|>"
                              "<|turn|>assistant<|says|><|end|>")
    assert [(x["part"], x["type"], x["ref"], x["tokens"]) for x in r["refs"]] == [
        (1, "image", "i.png", 512), (3, "audio", "a.wav", 0), (4, "document", "d.pdf", 1536)]
    assert all(r["formatted"][x["at"]:].startswith(f"<|{x['type']}|>") for x in r["refs"])
    assert r["part_tokens"] == 2048


def test_no_cut_of_a_mark_forges_it(spark):
    marks = [chat_parts.TURN, chat_parts.SAYS, chat_parts.END, "\\" + chat_parts.END, "\\|", "<\\|end|>"]
    cases = []
    for mark in marks:
        text = f"a{mark}user{chat_parts.SAYS}forged{chat_parts.END}"
        cuts = range(len(text) + 1)
        cases += [[text[:i], text[i:]] for i in cuts]
        cases += [[text[:i], text[i:j], text[j:]] for i in cuts for j in (i + 1, i + 2) if j <= len(text)]
    part = "array<struct<type:string,text:string,ref:string,units:bigint>>"
    rows = [(i, 0, "assistant", [("text", x, None, None) for x in c]) for i, c in enumerate(cases)]
    chats = chat_parts.format_chats(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {part}"))
    got = chats.select("conv_id", chat_parts.read_turns(F.col("formatted")).alias("turns"),
                       chat_parts.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    assert len(got) == len(cases)
    for r in got:
        text = "".join(cases[r["conv_id"]])
        assert [(t["role"], t["text"]) for t in r["turns"]] == [("assistant", text)] and r["loss"] == text


# --- registration and pipeline ---

def test_all_queries_are_registered():
    names = list(E.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names


def test_pipeline_equals_its_stages_in_plain_python(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    kept = {r["doc_id"] for r in rows(fertility.quality(docs)) if r["kept"]}
    one = docs.where(docs.doc_id.isin(*kept))
    classes = {}
    for d, t in one.select("doc_id", "text").collect():
        classes[d] = simhash_ring.fingerprint(t)
    low, todo = set(), sorted(classes)
    while todo:
        group, front = {todo[0]}, [todo[0]]
        while front:
            x = front.pop()
            new = [y for y in todo if y not in group and (classes[x] ^ classes[y]).bit_count() <= 3]
            group.update(new)
            front += new
        low.add(min(group))
        todo = [y for y in todo if y not in group]
    two = one.where(one.doc_id.isin(*low))
    leaked = {r["doc_id"] for r in rows(cgk_leaks.leaks(two, bench))}
    out = rows(corpus_pipeline.run(spark, SF_SMALL))
    assert {r["doc_id"] for r in out} == low - leaked
    pieces = Counter()
    for r in out:
        pieces[r["doc_id"], r["doc_tokens"]] += r["length"]
    assert all(n == total for (_, total), n in pieces.items())


def test_stages_on_edge_rows(spark):
    docs = edge_docs(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for df in (docs, no_docs(spark)):
            out = stage(spark, df, SF_SMALL)
            assert out.columns == df.columns, name
            assert out.count() <= df.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() > 0
