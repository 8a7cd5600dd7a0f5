"""Format-preserving pseudonyms for personal numbers and dates.

A value that passes its kind's validation is replaced by another valid value of
the same format: a keyed Feistel network permutes the values of the format, so
equal values get equal pseudonyms in every document and different values
different ones. Rounds add a keyed SHA-256 of one half to the other half, modulo
the half's size, so any size a * b is permuted exactly, without cycle walking.

Kinds: payment cards (Luhn; first digit kept, check digit made anew), phone
numbers (country code and separators kept; also (ddd) ddd-dddd without one), IPv4 addresses, US social security
numbers, calendar dates (also with one-digit parts or month names) and e-mail addresses (the local part; separators and
domain kept). Candidates that fail the validation stay as they are.

JVM-side only and without a shuffle: one projection per document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm._common import let

ROUNDS = 8
DEFAULT_KEY = "tickwise-pseudonyms"

EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9](?:[A-Za-z0-9.-]*[A-Za-z0-9])?\.[A-Za-z]{2,}"
PHONE = (r"\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){2,3}(?!\d)"
         r"|(?<![\d+.-])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?![.-]?\d)")
IP = r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
MONTH = (r"(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?|Aug(?:ust)?|Sep(?:tember)?"
         r"|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)")
DATE = (r"(?<![\d-])\d{4}-\d{2}-\d{2}(?![\d-])|(?<![\d./])\d{1,2}([./])\d{1,2}\1\d{4}(?![./]?\d)"
        rf"|(?<![A-Za-z]){MONTH} \d{{1,2}}, \d{{4}}(?!\d)|(?<![\d.,/-])\d{{1,2}} {MONTH} \d{{4}}(?!\d)")
CARD = (r"(?<![\dA-Za-z])(?:\d{13,19}|\d{4}([ -])\d{4}\2\d{4}\2\d{4}|\d{4}([ -])\d{6}\3\d{5})"
        r"(?![\dA-Za-z])")
ANY = "|".join(f"(?:{p})" for p in (EMAIL, PHONE, IP, SSN, DATE, CARD))
KINDS = ("card", "phone", "ip", "ssn", "date", "email")
# Dates are permuted inside eras of 270 * 270 days (about 200 years) from this day on.
_ERA, _HALF_ERA = 270 * 270, 270
_FIRST_DAY = "0001-01-01"
# Days of the years 1 to 9999; the last era has what is left, as a product of two.
_DAYS = 3_652_059
_LAST_ERA = _DAYS // _ERA
_LAST_HALF = max(d for d in range(1, 85) if (_DAYS % _ERA) % d == 0)
_LETTERS = "0123456789abcdefghijklmnopqrstuvwxyz"


def _noise(key: str, kind: str, no: Column, half: Column) -> Column:
    """60 keyed bits of a round number and a half."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), no, half), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def feistel(value: Column, a: Column, b: Column, key: str, kind: str) -> Column:
    """Permutation of 0 .. a*b - 1 (both below 2^30). The left half counts
    modulo a, the right modulo b; rounds change them in turn."""
    start = F.struct(F.floor(value / b).cast("bigint").alias("l"),
                     F.pmod(value, b).cast("bigint").alias("r"))

    def step(s, i):
        left = F.pmod(s["l"] + F.pmod(_noise(key, kind, i, s["r"]), a), a)
        right = F.pmod(s["r"] + F.pmod(_noise(key, kind, i, s["l"]), b), b)
        return F.when(F.pmod(i, F.lit(2)) == 0, F.struct(left.alias("l"), s["r"].alias("r"))) \
            .otherwise(F.struct(s["l"].alias("l"), right.alias("r")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step,
                       lambda s: s["l"] * b + s["r"])


def _power(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("bigint")


def _digits(text: Column, key: str, kind: str) -> Column:
    """Permute a string of up to 17 digits among those of its length."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    moved = feistel(text.cast("bigint"), _power(half), _power(n - half), key, kind)
    return F.lpad(moved.cast("string"), n, "0")


def _refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, in order."""
    chars = F.split(shape, "")
    return F.aggregate(
        chars, F.struct(F.lit(1).alias("at"), F.lit("").alias("out")),
        lambda s, c: F.when(c.rlike("[0-9]"), F.struct(
            (s["at"] + 1).alias("at"), F.concat(s["out"], F.substring(digits, s["at"], 1)).alias("out")))
        .otherwise(F.struct(s["at"].alias("at"), F.concat(s["out"], c).alias("out"))),
        lambda s: s["out"])


def _luhn(digits: Column) -> Column:
    """Sum of the Luhn rule over a digit string, the last digit not doubled."""
    return F.aggregate(
        F.transform(F.split(F.reverse(digits), ""), lambda c, i: let(
            c.cast("int") * (F.pmod(i, F.lit(2)) + 1),
            lambda d: F.when(d > 9, d - 9).otherwise(d))),
        F.lit(0), lambda s, d: s + d)


def _bare(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _card(v: Column, key: str) -> Column:
    def made(d):
        n = F.length(d)
        body = F.concat(F.substring(d, 1, 1),
                        _digits(d.substr(F.lit(2), n - 2), key, "card"))
        return let(body, lambda p: F.concat(
            p, F.pmod(10 - F.pmod(_luhn(F.concat(p, F.lit("0"))), F.lit(10)), F.lit(10))
            .cast("string")))
    return let(_bare(v), lambda d: F.when(
        F.pmod(_luhn(d), F.lit(10)) == 0, _refill(v, made(d))))


def _phone(v: Column, key: str) -> Column:
    code = F.regexp_extract(v, r"^\+\d{1,3}[ .-]?", 0)
    rest = v.substr(F.length(code) + 1, F.length(v))
    return F.when(F.length(_bare(v)).between(8, 15), F.concat(
        code, _refill(rest, _digits(_bare(rest), key, "phone"))))


def _ip(v: Column, key: str) -> Column:
    def moved(o):
        def n(i):
            return F.element_at(o, i).cast("bigint")
        value = ((n(1) * 256 + n(2)) * 256 + n(3)) * 256 + n(4)
        half = F.lit(65536).cast("bigint")
        return let(feistel(value, half, half, key, "ip"), lambda x: F.concat_ws(
            ".", *[F.pmod(F.shiftright(x, 24 - 8 * k), F.lit(256)) for k in range(4)]))
    return let(F.split(v, r"\."), lambda o: F.when(
        F.forall(o, lambda x: x.cast("int") <= 255) & F.forall(o, lambda x: ~x.rlike("^0.")),
        moved(o)))


def _ssn(v: Column, key: str) -> Column:
    """Areas 001-665 and 667-899, groups 01-99, serials 0001-9999."""
    area, group, serial = (F.substring(v, a, n).cast("bigint") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    a = F.when(area > 666, area - 2).otherwise(area - 1)

    def shown(x):
        head = F.floor(x / 9999)
        area2 = F.floor(head / 99)
        return F.format_string("%03d-%02d-%04d", F.when(area2 >= 665, area2 + 2).otherwise(area2 + 1),
                               F.pmod(head, F.lit(99)) + 1, F.pmod(x, F.lit(9999)) + 1)
    return F.when(valid, let(
        feistel((a * 99 + group - 1) * 9999 + serial - 1, F.lit(898 * 99).cast("bigint"),
                F.lit(9999).cast("bigint"), key, "ssn"), shown))


def _date(v: Column, key: str) -> Column:
    iso, named = v.rlike("^[0-9]{4}-"), v.rlike("[A-Z]")
    sep = F.regexp_extract(v, "[./]", 0)
    year, month = F.right(v, F.lit(4)), F.regexp_extract(v, "[A-Za-z]+", 0)
    one, two = F.regexp_extract(v, r"^(\d{1,2})[./]", 1), F.regexp_extract(v, r"[./](\d{1,2})[./]", 1)
    short = (F.length(one) == 1) | (F.length(two) == 1)

    def joined(m, d):
        return F.concat_ws("-", year, F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))
    # dd.mm.yyyy; with slashes mm/dd/yyyy
    other = F.when(named, joined(
        F.floor((F.instr(F.lit("JanFebMarAprMayJunJulAugSepOctNovDec"), F.left(month, F.lit(3))) + 2) / 3)
        .cast("string"), F.regexp_extract(v, r"(?<!\d)(\d{1,2})(?!\d)", 1))) \
        .when(sep == ".", joined(two, one)).otherwise(joined(one, two))
    day = F.try_to_timestamp(F.when(iso, v).otherwise(other), F.lit("yyyy-MM-dd")).cast("date")

    def shown(n):
        era = F.floor(n / _ERA)
        last = era == _LAST_ERA
        a = F.when(last, _LAST_HALF).otherwise(_HALF_ERA).cast("bigint")
        b = F.when(last, _DAYS % _ERA // _LAST_HALF).otherwise(_HALF_ERA).cast("bigint")
        moved = feistel(F.pmod(n, F.lit(_ERA)), a, b, key, "date") + era * _ERA
        out = F.date_add(F.lit(_FIRST_DAY).cast("date"), moved.cast("int"))
        form = F.when(F.length(month) > 3, F.date_format(out, "MMMM")).otherwise(F.date_format(out, "MMM"))
        return F.when(iso, F.date_format(out, "yyyy-MM-dd")) \
            .when(named & v.rlike("^[0-9]"), F.concat_ws(" ", F.date_format(out, "d"), form, F.date_format(out, "yyyy"))) \
            .when(named, F.concat(form, F.date_format(out, " d, yyyy"))) \
            .when(short & (sep == "."), F.date_format(out, "d.M.yyyy")) \
            .when(short, F.date_format(out, "M/d/yyyy")) \
            .when(sep == ".", F.date_format(out, "dd.MM.yyyy")).otherwise(F.date_format(out, "MM/dd/yyyy"))
    return let(F.datediff(day, F.lit(_FIRST_DAY).cast("date")).cast("bigint"),
               lambda n: F.when((n >= 0) & (n < _DAYS), shown(n)))


def _email(v: Column, key: str) -> Column:
    """The letters and digits of the local part, permuted as a string over 36
    signs: each half is shifted, sign by sign, by a keyed digest of the other."""
    local, domain = F.lower(F.substring_index(v, "@", 1)), F.substring_index(v, "@", -1)

    def shift(text, other, no):
        def stream(block):
            return F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), no, block.cast("string"), other), 256)
        return F.array_join(F.transform(F.split(text, ""), lambda c, i: F.substring(
            F.lit(_LETTERS),
            F.pmod(F.instr(F.lit(_LETTERS), c) - 1 + F.conv(
                F.substring(stream(F.floor(i / 32)), F.pmod(i, F.lit(32)) * 2 + 1, F.lit(2)), 16, 10)
                .cast("int"), F.lit(36)) + 1, F.lit(1))), "")

    def moved(plain):
        half = F.floor(F.length(plain) / 2).cast("int")
        start = F.struct(plain.substr(F.lit(1), half).alias("l"),
                         plain.substr(half + 1, F.length(plain)).alias("r"))
        return F.aggregate(
            F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start,
            lambda s, i: F.when(F.pmod(i, F.lit(2)) == 0, F.struct(
                F.when(s["l"] == "", "").otherwise(shift(s["l"], s["r"], i)).alias("l"),
                s["r"].alias("r"))).otherwise(F.struct(
                    s["l"].alias("l"), shift(s["r"], s["l"], i).alias("r"))),
            lambda s: F.concat(s["l"], s["r"]))

    def refill(signs):
        return F.aggregate(
            F.split(local, ""), F.struct(F.lit(1).alias("at"), F.lit("").alias("out")),
            lambda s, c: F.when(c.rlike("[0-9a-z]"), F.struct(
                (s["at"] + 1).alias("at"), F.concat(s["out"], F.substring(signs, s["at"], F.lit(1))).alias("out")))
            .otherwise(F.struct(s["at"].alias("at"), F.concat(s["out"], c).alias("out"))),
            lambda s: s["out"])
    return let(moved(F.regexp_replace(local, "[^0-9a-z]", "")),
               lambda m: F.concat(refill(m), F.lit("@"), domain))


def _kind(v: Column) -> Column:
    """Which pattern a candidate is of (an index of :data:`KINDS`)."""
    return F.when(v.contains("@"), 5).when(v.rlike(r"^\+|^\(|^\d{3}[.-]\d{3}[.-]\d{4}$"), 1) \
        .when(v.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), 2).when(v.rlike(r"^\d{3}-\d{2}-\d{4}$"), 3) \
        .when(v.rlike(r"^\d{4}-\d{2}-\d{2}$|^\d{1,2}[./]\d{1,2}[./]\d{4}$|[A-Z]"), 4).otherwise(0)


def pseudonymize(docs: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """One row per input row: ``doc_id``, ``text`` with pseudonyms, ``found`` (an
    array of ``(kind, value, pseudonym)`` in text order) and a count per kind.

    Null texts stay null and have no findings; the order of rows, ties and
    repeated rows do not matter, each row is treated alone; extra columns are
    not read. The key decides the permutation and is not stored in the result.
    """
    def swap(v, k):
        out = F.lit(None).cast("string")
        for no, fn in ((0, _card), (1, _phone), (2, _ip), (3, _ssn), (4, _date), (5, _email)):
            out = F.when(k == no, fn(v, key)).otherwise(out)
        return out

    text = F.col("text").cast("string")
    found = F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), lambda v: let(
        _kind(v), lambda k: F.struct(k.alias("kind"), v.alias("value"), swap(v, k).alias("pseudonym"))))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       found.alias("all"))
    new = F.array_join(F.flatten(F.zip_with(
        F.split("text", ANY, -1), F.concat(
            F.transform("all", lambda s: F.coalesce(s["pseudonym"], s["value"])), F.array(F.lit(""))),
        lambda gap, value: F.array(gap, value))), "")
    valid = F.filter(F.coalesce("all", F.expr(
        "cast(array() as array<struct<kind:int,value:string,pseudonym:string>>)")),
        lambda s: s["pseudonym"].isNotNull())
    def count(no):
        return F.size(F.filter("found", lambda s: s["kind"] == no)).cast("long")

    counts = [count(no).alias(f"n_{name}") for no, name in enumerate(KINDS)]
    return rows.select("doc_id", F.when(F.size("all") > 0, new).otherwise(F.col("text")).alias("text"),
                       valid.alias("found")).select("doc_id", "text", "found", *counts)
