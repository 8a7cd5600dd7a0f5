"""Main text of web pages by nearest-URL page differencing.

Pages of a host are ordered by URL path and each is paired with the page before
and after it. Both are read as lines: a block's text, or, for a line of page
furniture (menus, headers, adverts: by element, role and class names), the place
of its element, since a template repeats the place and not always the words. The
lines are aligned by longest common subsequence and shared lines deleted.

What lies in an article element is the page's own and stays even where another
page repeats it (copies, quoted passages); of the other lines the unshared rest
stays, whether the page has an article element or not. Furniture by element or
role that no neighbour shares is removed after the difference. A class or id name
is only a hint: its lines go where a neighbour has the same place, and an article
or main element inside ends it. A page without a neighbour has no difference:
there an article element with most of the text is the text.

The pairing needs no host-wide group: ranges of (host, path, page) are cut at
split points taken from the sorted keys, each range is read in order with the
lines of one page beyond either end, and a task holds a few pages at a time.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm._common import ship, shuffle_partitions

ship(__name__)

# HTML element names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data dfn del em font i ins kbd label mark q s "
                   "samp small span strike strong sub sup time tt u var".split())
SILENT = frozenset("script style template noscript svg math iframe object canvas audio video "
                   "button select textarea head title map datalist".split())
FURNITURE = frozenset("nav header footer aside form menu dialog".split())
SELF_CLOSING = frozenset("p li dt dd td th tr option".split())
UNMARKED = frozenset("html body article main p h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert".split())
CUES = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo "
                 "cookie cookies consent gdpr notice notices alert disclaimer sidebar menu nav navbar "
                 "navigation breadcrumb breadcrumbs masthead footer comment comments disqus reply "
                 "replies respond share sharing social newsletter subscribe signup popup "
                 "modal overlay related recommended widget toolbar pagination pager".split())
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
_SPACE = re.compile(r"\s+")

PLAIN, ARTICLE, CHROME, CUED = 0, 1, 2, 3


class Lines(HTMLParser):
    """Blocks of a page as (text, mark, place)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        # tag, silent, furniture, article, the cue that held before it
        self.stack: list[tuple[str, bool, bool, bool, str]] = []
        self.silent = self.chrome = self.article = 0
        self.cue = ""
        self.buffer: list[str] = []
        self.state: tuple[int, str] = (PLAIN, "")
        self.out: list[tuple[str, int, str]] = []

    def _flush(self) -> None:
        if self.buffer:
            text = _SPACE.sub(" ", "".join(self.buffer)).strip()
            self.buffer.clear()
            if text:
                self.out.append((text, *self.state))

    @staticmethod
    def _named(attrs, whole: bool = True) -> str:
        """The first class or id name made of cue words only, or, unless
        ``whole``, one that begins with a cue word."""
        for k, v in attrs:
            if k in ("class", "id"):
                for name in (v or "").split():
                    words = [w.lower() for w in _WORD.findall(name)]
                    if words and all(w in CUES for w in (words if whole else words[:1])):
                        return name
        return ""

    def _cue(self, tag: str, attrs, article: bool) -> str:
        """The cue that holds inside an element."""
        if tag == "main":
            return ""
        if article:                                      # own text, but for comments as articles
            return self.cue if self._named(attrs, whole=False) else ""
        if tag in UNMARKED and tag != "p":
            return self.cue
        if tag == "p":
            attrs = [x for x in attrs if x[0] == "class"]
        return self._named(attrs) or self.cue

    def _pop_to(self, at: int) -> None:
        for _, s, c, a, _ in self.stack[at:]:
            self.silent -= s
            self.chrome -= c
            self.article -= a
        if at < len(self.stack):
            self.cue = self.stack[at][4]
        del self.stack[at:]

    def handle_starttag(self, tag, attrs) -> None:
        if tag not in INLINE:
            self._flush()
        if tag in VOID:
            return
        if tag not in INLINE:
            # a block ends an open paragraph; an item ends the item before it
            at = len(self.stack) - 1
            while at >= 0 and self.stack[at][0] in INLINE:
                at -= 1
            if at >= 0 and (self.stack[at][0] == "p" or self.stack[at][0] == tag in SELF_CLOSING):
                self._pop_to(at)
        s = tag in SILENT
        c = tag in FURNITURE or (tag not in UNMARKED and any(
            k == "role" and (v or "").lower() in ROLES for k, v in attrs))
        a = tag == "article" or any(k == "itemprop" and v == "articleBody" for k, v in attrs)
        if tag == "body":
            self._pop_to(0)                              # whatever the head left open
        self.stack.append((tag, s, c, a, self.cue))
        self.cue = self._cue(tag, attrs, a)
        self.silent += s
        self.chrome += c
        self.article += a

    def handle_startendtag(self, tag, attrs) -> None:
        self.handle_starttag(tag, attrs)                 # HTML has no self-closing but void elements

    def handle_endtag(self, tag) -> None:
        if tag not in INLINE:
            self._flush()
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] == tag:
                self._pop_to(at)
                return

    def handle_data(self, data) -> None:
        if self.silent:
            return
        mark = CHROME if self.chrome else CUED if self.cue else ARTICLE if self.article else PLAIN
        if not self.buffer or mark != self.state[0]:
            self._flush()
            place = ">".join(x[0] for x in self.stack[-6:]) if mark in (CHROME, CUED) else ""
            self.state = (mark, f"{place} {self.cue}" if mark == CUED else place)
        self.buffer.append(data)

    def close(self) -> None:
        super().close()
        self._flush()


def page_lines(html: str | None) -> list[tuple[str, int, str]]:
    """(text, mark, place) of a page's blocks, in order; null: none."""
    if not html:
        return []
    p = Lines()
    p.feed(html)
    p.close()
    return p.out


def _sweep(a: list, b: list) -> list[int]:
    """Bit-parallel LCS: the row after each element of ``a``; a clear bit j in
    row i says that b[j] adds one to the length for a[:i + 1]."""
    where: dict = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | (1 << j)
    full = (1 << len(b)) - 1
    row, rows = full, []
    for x in a:
        m = where.get(x, 0)
        u = row & m
        row = ((row + u) | (row & ~m)) & full
        rows.append(row)
    return rows


_CELLS = 1 << 28


def shared_lines(a: list, b: list) -> set[int]:
    """Places in ``a`` of a longest common subsequence of ``a`` and ``b``. Long
    inputs are halved first, so memory stays bounded."""
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    out = set(range(lo)) | set(range(len(a) - hi, len(a)))
    in_b, in_a = set(b[lo:len(b) - hi]), set(a[lo:len(a) - hi])
    pos = [i for i in range(lo, len(a) - hi) if a[i] in in_b]
    x, y = [a[i] for i in pos], [v for v in b[lo:len(b) - hi] if v in in_a]
    if x and y:
        out |= {pos[k] for k in _trace(x, y)}
    return out


def _trace(x: list, y: list) -> set[int]:
    if len(x) > 1 and len(x) * len(y) > _CELLS:
        mid = len(x) // 2
        left, right = _sweep(x[:mid], y)[-1], _sweep(x[mid:][::-1], y[::-1])[-1]
        n = len(y)
        gain, best, cut, total = 0, -1, 0, n - right.bit_count()
        for j in range(n + 1):                           # y[:j] for the first half
            if gain + total > best:
                best, cut = gain + total, j
            if j < n:
                gain += not (left >> j) & 1
                total -= not (right >> (n - 1 - j)) & 1
        return _trace(x[:mid], y[:cut]) | {mid + k for k in _trace(x[mid:], y[cut:])} \
            if cut and cut < n else (_trace(x[:mid], y) if cut else {mid + k for k in _trace(x[mid:], y)})
    if not x or not y:
        return set()
    rows, out = _sweep(x, y), set()
    full = (1 << len(y)) - 1
    i, width = len(x) - 1, full
    while i >= 0:
        clear = ~rows[i] & width
        if not clear:
            break
        j = clear.bit_length() - 1                       # the last place that adds one
        above = rows[i - 1] if i else full
        if (above >> j) & 1:                             # it adds only with x[i]: x[i] meets y[j]
            out.add(i)
            width = (1 << j) - 1
        i -= 1
    return out


def main_lines(lines: list[tuple[str, int]], shared: set[int], compared: bool = False) -> list[str]:
    """What stays of a page's (text, mark) lines once shared ones are deleted;
    ``compared`` says that the page has a neighbour. Cued lines of shared places
    are among ``shared``."""
    if not compared:
        inside = sum(len(t) for t, m in lines if m == ARTICLE)
        if inside > sum(len(t) for t, m in lines if m == PLAIN):
            return [t for t, m in lines if m == ARTICLE]
    return [t for i, (t, m) in enumerate(lines) if m == ARTICLE or (m in (PLAIN, CUED) and i not in shared)]


def _keys(pages: DataFrame) -> DataFrame:
    """``key``: host, path (with query) and page, in sort order."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_replace(rest.substr(F.length(host) + 1, F.length(rest)), "#.*$", "")
    page = F.coalesce(F.lpad((F.col("page_id").cast("decimal(20,0)") + F.lit(str(2 ** 63)).cast("decimal(20,0)"))
                             .cast("decimal(20,0)").cast("string"), 20, "0"), F.lit(""))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.concat_ws("\t", host, path, page).alias("key"), *[c for c in ("html",) if c in pages.columns])


def _ranges(pages: DataFrame) -> list[tuple[str, str]]:
    """First and last key of each sort range, one per shuffle partition."""
    n = shuffle_partitions(pages.sparkSession)
    keys = _keys(pages).select("key")
    ends = (keys.repartitionByRange(n, "key").groupBy(F.spark_partition_id().alias("p"))
            .agg(F.min("key").alias("low"), F.max("key").alias("high")))
    return sorted((r["low"], r["high"]) for r in ends.collect())


ROW = "bucket int, key string, own boolean, page_id long, url string, texts array<string>, marks array<int>, codes array<long>"
OUT = "page_id long, url string, text string, n_chars long, n_lines long, n_shared long"


def _read_pages(ends: list[tuple[str, str]]):
    lows = [lo for lo, _ in ends]
    firsts = {lo: i - 1 for i, (lo, _) in enumerate(ends) if i}       # also read by the range before
    lasts = {hi: i + 1 for i, (_, hi) in enumerate(ends) if i + 1 < len(ends)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        for b in batches:
            out = []
            for page, url, key, html in zip(*(b.column(i).to_pylist() for i in range(4))):
                lines = page_lines(html)
                codes = [xxhash.xxh64_intdigest(f"{m}\t{place or text}") - (1 << 63)
                         for text, m, place in lines]
                bucket = max(bisect_right(lows, key) - 1, 0)
                out.append((bucket, key, True, page, url, [t if m != CHROME else "" for t, m, _ in lines],
                            [m for _, m, _ in lines], codes))
                for other in {firsts.get(key), lasts.get(key)} - {None}:
                    out.append((other, key, False, page, url, None, None, codes))
            for at in range(0, len(out), 1000):
                cols = zip(*out[at:at + 1000])
                kinds = (pa.int32(), pa.string(), pa.bool_(), pa.int64(), pa.string(),
                         pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                 [x.split()[0] for x in ROW.split(", ")])
    return run


def _difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (bucket, key): each page against the nearest one before and
    after it that has other lines. Pages in a row with the same lines are one run:
    their text is made once."""
    out: list[tuple] = []
    before = run = None
    members: list[tuple] = []

    def same_host(x, y):
        return x[0] == y[0] and x[1].split("\t", 1)[0] == y[1].split("\t", 1)[0]

    def write(after):
        if members:
            others = [x for x in (before, after) if x and same_host(run, x)]
            shared = set().union(*(shared_lines(run[7], x[7]) for x in others))
            if CUED in run[6]:
                places = set().union(*(x[7] for x in others))
                shared.update(i for i, m in enumerate(run[6]) if m == CUED and run[7][i] in places)
            text = "\n".join(main_lines(list(zip(run[5], run[6])), shared, bool(others)))
            out.extend((*m, text, len(text), len(run[5]), len(shared)) for m in members)
            members.clear()

    def batch():
        cols = list(zip(*out))
        kinds = [pa.int64(), pa.string(), pa.string()] + [pa.int64()] * 3
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                          [x.split()[0] for x in OUT.split(", ")])

    for b in batches:
        for row in zip(*(b.column(i).to_pylist() for i in range(8))):
            if run is None or not same_host(run, row) or run[7] != row[7]:
                write(row)
                before, run = run, row
            elif not run[2]:
                run = row                                # the own page has the texts
            if row[2]:
                members.append((row[3], row[4]))
            if len(out) > 500:
                yield batch()
    write(None)
    if out:
        yield batch()


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars, n_lines, n_shared)``, one row per page.

    White space inside a block is one blank, blocks are joined by a line feed;
    no main text gives an empty string. Null html is an empty page; a null url
    has the empty host; pages of the same URL are ordered by page_id. Neighbours
    with the very same lines (repeated rows, copies) show no template and are
    passed over; where copies fill a range to its end, that side has none. Extra
    columns are not read.
    """
    ends = _ranges(pages)
    if not ends:
        return pages.sparkSession.createDataFrame([], OUT)
    keyed = _keys(pages).select("page_id", "url", "key", F.col("html").cast("string"))
    rows = keyed.mapInArrow(_read_pages(ends), ROW)
    # a bucket is a partition of its own (hashed, some would share one)
    return (rows.repartitionById(len(ends), "bucket")
            .sortWithinPartitions("bucket", "key", "own")
            .mapInArrow(_difference, OUT))
