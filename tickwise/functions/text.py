"""Text expressions: case, stop words, regex tests and page-text cleanup."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The English stop-word list used before scoring (the common
# public English list, 179 entries, in its usual order).
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your "
    "yours yourself yourselves he him his himself she she's her hers herself it "
    "it's its itself they them their theirs themselves what which who whom this "
    "that that'll these those am is are was were be been being have has had "
    "having do does did doing a an the and but if or because as until while of "
    "at by for with about against between into through during before after "
    "above below to from up down in out on off over under again further then "
    "once here there when where why how all any both each few more most other "
    "some such no nor not only own same so than too very s t can will just don "
    "don't should should've now d ll m o re ve y ain aren aren't couldn "
    "couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't "
    "isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't "
    "shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't"
).split()

# Topic patterns and weights of the relevance score.
CRYPTO_PATTERN = "Cryptocurrency|cryptocurrency|BITCOIN|bitcoin|Bitcoin"
ECONOMY_PATTERN = "economy|us dollar|money|U.S|american"
CRYPTO_WEIGHT = 6.0
ECONOMY_WEIGHT = 0.08
NO_HIT_WEIGHT = 0.002

# Whitespace exactly as Python's str.split() sees it: every code point for
# which str.isspace() holds (derived by rule, not listed by hand).
WS_CHARS = "".join(ch for ch in map(chr, range(0x110000)) if ch.isspace())
# The same set as a regex class both Java (Spark) and RE2 (the SQL oracle) read.
WS_CLASS = "[" + "".join(f"\\x{{{ord(ch):X}}}" for ch in WS_CHARS) + "]"
WS = WS_CLASS + "+"
EDGE_WS = f"^{WS}|{WS}$"
# Punctuation trimmed from both ends of a token before a lexicon lookup.
EDGE_PUNCT = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"
# The same trim applied to every token of a space-normalised text in one
# regex pass: a run of non-letter/digit characters touching a token edge.
TOKEN_EDGE_PUNCT = r"(?<![^ ])[^\p{L}\p{N} ]+|[^\p{L}\p{N} ]+(?![^ ])"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lower(c) -> Column:
    """F1."""
    return F.lower(_c(c))


def normalize_ws(c) -> Column:
    """Every whitespace character becomes a plain space (a character map, no regex)."""
    return F.translate(_c(c), WS_CHARS, " " * len(WS_CHARS))


def tokens(c) -> Column:
    """Whitespace tokens of a text, as ``str.split()`` gives them."""
    return F.array_remove(F.split(normalize_ws(c), " "), "")


def remove_stop_words(c, stop_words=ENGLISH_STOP_WORDS) -> Column:
    """drop whitespace tokens found in ``stop_words``; rejoin with one space."""
    stop = F.array(*[F.lit(w) for w in stop_words])
    kept = F.filter(tokens(c), lambda w: ~F.array_contains(stop, w))
    return F.array_join(kept, " ")


def contains_regex(c, pattern: str, null_as_hit: bool = False) -> Column:
    """case-sensitive regex search anywhere in the text (``.`` is a wildcard)."""
    hit = _c(c).rlike(pattern)
    return F.coalesce(hit, F.lit(bool(null_as_hit)))


def starts_with_regex(c, pattern: str) -> Column:
    """Regex anchored at the start (``str.match``)."""
    return F.coalesce(_c(c).rlike(f"^(?:{pattern})"), F.lit(False))


def strip_byline(c, anchored: bool = True) -> Column:
    """remove the ``By`` prefix of a byline.

    ``anchored=False`` removes every ``By`` as the raw replacement does,
    which also cuts names (``Bytes`` -> ``tes``).
    """
    if anchored:
        return F.regexp_replace(_c(c), r"^By\s+", "")
    return F.regexp_replace(_c(c), "By", "")


def strip_tags(c) -> Column:
    """remove ``<...>`` runs; ``.`` does not cross a newline."""
    return F.regexp_replace(_c(c), "<.*?>", "")


def strip_brackets(c) -> Column:
    """strip ``[`` and ``]`` characters from both ends."""
    return F.regexp_replace(_c(c), r"^[\[\]]+|[\[\]]+$", "")


def inner_text(c) -> Column:
    """F8: drop the first and last character (``(BTC)`` -> ``BTC``)."""
    s = _c(c)
    return F.when(F.length(s) >= 2, s.substr(F.lit(2), F.length(s) - 2)) \
        .when(s.isNotNull(), F.lit(""))


def parse_count(c) -> Column:
    """``' 1,234 '`` -> 1234 as bigint; anything else -> null."""
    return F.regexp_replace(F.regexp_replace(_c(c), EDGE_WS, ""), ",", "").try_cast("bigint")


def ends_with(c, suffix: str) -> Column:
    """F10."""
    return _c(c).endswith(suffix)


# The named character references that markup text uses.
NAMED_REFERENCES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0"}


def decode_references(c) -> Column:
    """Character references (named as above, decimal, hexadecimal) decoded once;
    any other ``&`` stays as it is."""
    c = _c(c)
    named = F.create_map(*[F.lit(x) for kv in NAMED_REFERENCES.items() for x in kv])

    def one(part):
        name = F.regexp_extract(part, r"^([A-Za-z]+|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});", 1)
        code = F.when(name.rlike("^#[xX]"), F.conv(F.substr(name, F.lit(3)), 16, 10)) \
            .when(name.startswith("#"), F.substr(name, F.lit(2))).cast("bigint")
        sign = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        text = F.when(sign, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")) \
            .otherwise(F.try_element_at(named, name))
        return F.when((name != "") & text.isNotNull(),
                      F.concat(text, F.substr(part, F.length(name) + 2))) \
            .otherwise(F.concat(F.lit("&"), part))

    parts = F.split(c, "&", -1)
    decoded = F.array_join(F.transform(F.slice(parts, F.lit(2), F.size(parts)), one), "")
    return F.when(c.contains("&"), F.concat(parts[0], decoded)).otherwise(c)


def absolute_url(base, href) -> Column:
    """resolve ``href`` against ``base`` (absolute, rooted and relative)."""
    b, h = _c(base), _c(href)
    scheme_host = F.regexp_extract(b, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(b, r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1)
    base_dir = F.regexp_extract(b, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^?#]*/)", 1)
    return (F.when(h.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), h)
            .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
            .when(h.startswith("/"), F.concat(scheme_host, h))
            .when(h == "", b)
            .when(base_dir != "", F.concat(base_dir, h))
            .otherwise(F.concat(scheme_host, F.lit("/"), h)))
