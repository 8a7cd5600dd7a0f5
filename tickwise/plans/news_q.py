"""Named queries over news articles (documents adapter)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickwise.functions import numeric as num
from tickwise.functions import text as tx
from tickwise.operators import news, stats
from tickwise.plans.common import finish
from tickwise.sources import tables

# Fixed parameter: section patterns for the P9 query over the adapter's
# section names (``src0`` .. ``src19``); 'src1' also matches 'src10'.. as a
# start-anchored match does.
DOC_SECTIONS = ("src1", "src2", "src3")


def _scored(spark, sf_dir):
    a = news.clean_content(tables.articles(spark, sf_dir))
    a = news.with_sentiment(a)
    return news.with_relevance(a)


def q_news_clean(spark, sf_dir):
    """F1 + F2: lower-cased content without stop words."""
    return news.clean_content(tables.articles(spark, sf_dir)).select("id", "content_no_stopwords")


def q_news_sentiment(spark, sf_dir):
    """E7 + F22 + F23 over every article (no row cap)."""
    return finish(_scored(spark, sf_dir).select("id", "SENTIMENT_VALUE", "SENTIMENT"))


def q_news_scored(spark, sf_dir):
    """F3 + F19 + F20 + F21: relevance and score = sentiment x relevance."""
    return finish(_scored(spark, sf_dir).select("id", "relevance", "SENTIMENT_VALUE", "score"))


def q_news_sections(spark, sf_dir):
    """Start-anchored section labels."""
    a = tables.articles(spark, sf_dir)
    return news.section_of(a, "section_name", DOC_SECTIONS).select("id", "section_name", "section")


def q_news_distribution(spark, sf_dir):
    """Non-null count of the other columns per section (a text has a sentiment and
    a score unless it is null, so none is worked out here)."""
    a = tables.articles(spark, sf_dir)
    s = a.select("section_name", "id", "lang", a.content.isNotNull().alias("_has"))
    has = F.when(F.col("_has"), F.lit(1))
    return stats.count_per_group(
        s.select("section_name", "id", "lang", has.alias("SENTIMENT"), has.alias("score")), "section_name")


def q_news_sentiment_context(spark, sf_dir):
    """E7 with negations and boosters, on text that keeps its stop words."""
    a = tables.articles(spark, sf_dir).withColumn("low", tx.lower("content"))
    s = news.with_sentiment(a, "low", modifiers=news.DEMO_MODIFIERS)
    return finish(s.select("id", "SENTIMENT_VALUE", "SENTIMENT"))


def q_sentiment_shares(spark, sf_dir):
    """A11 + O2: share of articles per sentiment class, one decimal."""
    s = _scored(spark, sf_dir)
    # O2: ascending by count, then label, as the chart input (five rows).
    return finish(stats.share_of_total(s, "SENTIMENT")).orderBy("amount", "SENTIMENT")


def q_section_shares(spark, sf_dir):
    """A8 + A11 + O2: share of articles per section, ascending by count."""
    a = tables.articles(spark, sf_dir)
    return finish(stats.share_of_total(a, "section_name")).orderBy("amount", "section_name")


def q_relevance_null_as_hit(spark, sf_dir):
    """F19 with the CSV-reader rule (missing text counts as a hit)."""
    a = tables.articles(spark, sf_dir)
    return finish(a.select("id", num.relevance("content", null_as_hit=True).alias("relevance")))


QUERIES = {
    "news_clean": q_news_clean,
    "news_sentiment": q_news_sentiment,
    "news_scored": q_news_scored,
    "news_sentiment_context": q_news_sentiment_context,
    "news_sections": q_news_sections,
    "news_distribution": q_news_distribution,
    "sentiment_shares": q_sentiment_shares,
    "section_shares": q_section_shares,
    "relevance_null_as_hit": q_relevance_null_as_hit,
}


# --- oracle -------------------------------------------------------------------
def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


STOP_LIST = "[" + ", ".join(_lit(w) for w in tx.ENGLISH_STOP_WORDS) + "]"
LEX_VALUES = ", ".join(f"({_lit(w)}, {float(v)!r}::DOUBLE)" for w, v in sorted(news.DEMO_LEXICON.items()))
HALVES = " ".join(f"WHEN {_lit(k)} THEN {v!r}::DOUBLE" for k, v in sorted(num.PY_ROUND1_HALVES.items()))


def tokens_sql(x: str) -> str:
    return (f"list_filter(string_split_regex(regexp_replace({x}, {_lit(tx.EDGE_WS)}, '', 'g'), "
            f"{_lit(tx.WS)}), lambda w: w <> '')")


def clean_sql(x: str) -> str:
    return (f"array_to_string(list_filter({tokens_sql(f'lower({x})')}, "
            f"lambda w: NOT list_contains({STOP_LIST}, w)), ' ')")


def relevance_sql(x: str, null_as_hit: bool = False) -> str:
    nh = "true" if null_as_hit else "false"
    r1 = (f"CASE WHEN coalesce(regexp_matches({x}, {_lit(tx.CRYPTO_PATTERN)}), {nh}) "
          f"THEN {tx.CRYPTO_WEIGHT!r}::DOUBLE ELSE {tx.NO_HIT_WEIGHT!r}::DOUBLE END")
    r2 = (f"CASE WHEN coalesce(regexp_matches({x}, {_lit(tx.ECONOMY_PATTERN)}), {nh}) "
          f"THEN {tx.ECONOMY_WEIGHT!r}::DOUBLE ELSE {tx.NO_HIT_WEIGHT!r}::DOUBLE END")
    return f"greatest({r1}, {r2})"


SCORED = f"""docs AS (
  SELECT doc_id AS id, text AS content, source AS section_name, lang, {clean_sql('text')} AS c
  FROM documents),
toks AS (
  SELECT id, regexp_replace(unnest({tokens_sql('c')}), {_lit(tx.EDGE_PUNCT)}, '', 'g') AS word FROM docs),
lex AS (SELECT * FROM (VALUES {LEX_VALUES}) l(word, valence)),
sums AS (SELECT id, sum(valence) AS s FROM toks JOIN lex USING (word) GROUP BY id),
cmp AS (
  SELECT d.*, CASE WHEN d.c IS NULL THEN NULL ELSE
    round(coalesce(s.s, 0) / sqrt(coalesce(s.s, 0) * coalesce(s.s, 0) + {news.COMPOUND_ALPHA!r}), 4) END AS c4
  FROM docs d LEFT JOIN sums s USING (id)),
sv AS (
  SELECT *, (CASE printf('%.4f', c4) {HALVES} ELSE round(c4, 1) END) + 0.0 AS SENTIMENT_VALUE FROM cmp),
scored AS (
  SELECT *, CASE WHEN SENTIMENT_VALUE IS NULL THEN NULL
    WHEN SENTIMENT_VALUE <= 1 AND SENTIMENT_VALUE >= 0.5 THEN 'Very Positive'
    WHEN SENTIMENT_VALUE < 0.5 AND SENTIMENT_VALUE > 0 THEN 'Positive'
    WHEN SENTIMENT_VALUE = 0 THEN 'Neutral'
    WHEN SENTIMENT_VALUE < 0 AND SENTIMENT_VALUE >= -0.5 THEN 'Negative'
    ELSE 'Very Negative' END AS SENTIMENT,
    {relevance_sql('content')} AS relevance
  FROM sv)"""


_CLASS_SQL = """CASE WHEN v IS NULL THEN NULL WHEN v <= 1 AND v >= 0.5 THEN 'Very Positive'
  WHEN v < 0.5 AND v > 0 THEN 'Positive' WHEN v = 0 THEN 'Neutral' WHEN v < 0 AND v >= -0.5 THEN 'Negative'
  ELSE 'Very Negative' END"""
_MOD_VALUES = ", ".join(f"({_lit(w)}, {b!r}::DOUBLE, {str(n).lower()})"
                        for w, (b, n) in sorted(news.DEMO_MODIFIERS.items()))
_NEAR = "".join(f" LEFT JOIN mods m{d} ON m{d}.word = CASE WHEN i > {d} THEN ws[i - {d}] END" for d in (1, 2, 3))
_MORE = " + ".join(f"coalesce(m{d}.boost, 0) * {x!r}" for d, x in zip((1, 2, 3), news.REACH_DAMPING))
CONTEXT = f"""WITH t AS (
  SELECT doc_id AS id, text, list_filter(list_transform({tokens_sql('lower(text)')},
    lambda w: regexp_replace(w, {_lit(tx.EDGE_PUNCT)}, '', 'g')), lambda w: w <> '') AS ws FROM documents),
u AS (SELECT id, ws, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM t),
lex AS (SELECT * FROM (VALUES {LEX_VALUES}) l(word, valence)),
mods AS (SELECT * FROM (VALUES {_MOD_VALUES}) m(word, boost, negates)),
h AS (
  SELECT id, (valence + sign(valence) * ({_MORE}))
    * CASE WHEN coalesce(m1.negates, false) OR coalesce(m2.negates, false) OR coalesce(m3.negates, false)
           THEN {news.NEGATION!r} ELSE 1.0 END AS x
  FROM u JOIN lex USING (word){_NEAR}),
s AS (SELECT id, sum(x) AS s FROM h GROUP BY id),
c AS (SELECT t.id, CASE WHEN text IS NOT NULL THEN
    round(coalesce(s, 0) / sqrt(coalesce(s, 0) * coalesce(s, 0) + {news.COMPOUND_ALPHA!r}), 4) END AS c4
  FROM t LEFT JOIN s USING (id)),
v AS (SELECT id, (CASE printf('%.4f', c4) {HALVES} ELSE round(c4, 1) END) + 0.0 AS v FROM c)
SELECT id, round(v, 6) AS SENTIMENT_VALUE, {_CLASS_SQL} AS SENTIMENT FROM v"""


def section_sql(x: str) -> str:
    whens = " ".join(f"WHEN coalesce(regexp_matches({x}, {_lit('^(?:' + s + ')')}), false) THEN {_lit(s)}"
                     for s in DOC_SECTIONS)
    return f"CASE {whens} END"


ORACLE = {
    "news_sentiment_context": CONTEXT,
    "news_clean": f"SELECT doc_id AS id, {clean_sql('text')} AS content_no_stopwords FROM documents",
    "news_sentiment": f"WITH {SCORED} SELECT id, round(SENTIMENT_VALUE, 6) AS SENTIMENT_VALUE, SENTIMENT FROM scored",
    "news_scored": f"""WITH {SCORED}
SELECT id, round(relevance, 6) AS relevance, round(SENTIMENT_VALUE, 6) AS SENTIMENT_VALUE,
  round(SENTIMENT_VALUE * relevance, 6) AS score FROM scored""",
    "news_sections": f"SELECT doc_id AS id, source AS section_name, {section_sql('source')} AS section FROM documents",
    "news_distribution": f"""WITH {SCORED}
SELECT section_name, count(id) AS id, count(lang) AS lang, count(SENTIMENT) AS SENTIMENT,
  count(SENTIMENT_VALUE * relevance) AS score
FROM scored WHERE section_name IS NOT NULL GROUP BY section_name""",
    "sentiment_shares": f"""WITH {SCORED},
g AS (SELECT SENTIMENT, CAST(count(*) AS DOUBLE) AS amount FROM scored WHERE SENTIMENT IS NOT NULL GROUP BY 1)
SELECT SENTIMENT, round(amount, 6) AS amount,
  round(round(amount * 100.0 / (SELECT sum(amount) FROM g), 1), 6) AS pct FROM g""",
    "section_shares": """WITH g AS (
  SELECT source AS section_name, CAST(count(*) AS DOUBLE) AS amount FROM documents
  WHERE source IS NOT NULL GROUP BY 1)
SELECT section_name, round(amount, 6) AS amount,
  round(round(amount * 100.0 / (SELECT sum(amount) FROM g), 1), 6) AS pct FROM g""",
    "relevance_null_as_hit": f"SELECT doc_id AS id, round({relevance_sql('text', True)}, 6) AS relevance FROM documents",
}
