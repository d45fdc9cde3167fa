"""Format-preserving pseudonyms for personal numbers and dates.

Values are found by pattern, validated (check digits, ranges, the calendar), and permuted within their format by
a keyed Feistel network, so a pseudonym is valid where its value was, and equal values get equal pseudonyms in
all documents, whatever their separators. Everything is built from SQL functions.

========  =====================================================================  ==========================
kind      valid                                                                  kept
========  =====================================================================  ==========================
card      13 to 19 digits, Luhn                                                  separators; new check digit
iban      two letters and check digits, remainder 1 modulo 97                    country, letters, blanks
phone     North American (area and exchange 200-999), or + and 8 to 15 digits    country code, separators
ssn       area 001-899 without 666, group 01-99, serial 0001-9999                hyphens
ipv4      four numbers up to 255                                                 dots
date      year-month-day, day/month/year or month/day/year, day.month.year;      order, separators
          in the calendar, years 1900-2099
email     a name, @ and a domain with a dot                                      domain, stops in the name
========  =====================================================================  ==========================

A run of numbers that is no value as a whole is searched for the values in it: cards and IBANs between separators, the
longest first (an IBAN has its country's length), then the other kinds in what is left. What is not valid stays as it is. A null text stays null with no findings, an empty one empty; repeated rows get
equal results; an empty table gives an empty result; texts are worked on whole; other columns pass, but one named
``n_found`` is replaced.
"""

from __future__ import annotations

import hashlib
import hmac
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docstream.llm.dealing import unused

#: Patterns of the kinds.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9])"
IPV4 = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
ISO_DATE = r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])"
DAY_DATE = r"(?<![0-9/.])[0-9]{1,2}([/.])[0-9]{1,2}\1[0-9]{4}(?![0-9/])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
CARD = r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"
LOCAL_PHONE = r"(?<![0-9+])(?:\+?1[ .-]?)?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-]?[0-9]{4}(?![0-9])"
WORLD_PHONE = r"(?<![0-9+])\+[1-9](?:[ ().-]{0,2}[0-9]){7,14}(?![0-9])"
#: A run of 13 or more digits with single separators, up to a token that an address begins with; an IBAN with the numbers after it.
TOKEN = r"[ ./-][0-9]++(?![A-Za-z0-9._%+-]{0,64}+@)"
RUN = rf"(?<![0-9])(?=[0-9](?:[ ./-]?[0-9]){{12}})[0-9]++(?:{TOKEN})*+"
ANY = "|".join((EMAIL, rf"{IBAN}(?:{TOKEN})*+", IPV4, ISO_DATE, DAY_DATE, SSN, RUN, LOCAL_PHONE, WORLD_PHONE))
#: What is looked for beside the cards and IBANs of a run.
BESIDE = "|".join((IPV4, ISO_DATE, DAY_DATE, SSN, LOCAL_PHONE))
#: Characters of an IBAN by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
#: Most tokens that a card or an IBAN has.
MOST_TOKENS = 19
ALNUM = "0123456789abcdefghijklmnopqrstuvwxyz"
FIRST_DAY, N_DAYS = "1900-01-01", 17 * 4297
ROUNDS = 10


def prf(key: str, *parts: Column) -> Column:
    """A keyed number below 2**60 that depends on all parts."""
    told = F.concat_ws("|", *[p.cast("string") for p in parts])
    inner = F.sha2(F.concat(F.lit(key + "\x00"), told), 256)
    return F.conv(F.substring(F.sha2(F.concat(F.lit(key + "\x01"), inner), 256), 1, 15), 16, 10).cast("bigint")


def permuted(key: str, kind: str, value: Column, left: int, right: int, rounds: int = ROUNDS) -> Column:
    """A keyed permutation of 0 .. left * right - 1: halves modulo ``left`` and ``right`` take turns."""
    zero = F.struct(F.floor(value / F.lit(right)).cast("bigint").alias("a"), F.pmod(value, F.lit(right)).cast("bigint").alias("b"))

    def step(s: Column, r: Column) -> Column:
        even = F.pmod(r, F.lit(2)) == 0
        a = F.when(even, F.pmod(s["a"] + F.pmod(prf(key, F.lit(kind), r, s["b"]), F.lit(left)), F.lit(left))).otherwise(s["a"])
        b = F.when(even, s["b"]).otherwise(F.pmod(s["b"] + F.pmod(prf(key, F.lit(kind), r, s["a"]), F.lit(right)), F.lit(right)))
        return F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), zero, step, lambda s: s["a"] * F.lit(right) + s["b"])


def permuted_text(key: str, kind: str, text: Column, letters: str, rounds: int = ROUNDS) -> Column:
    """A keyed permutation of the strings of one length over ``letters``; of any length."""
    n, base = F.length(text), len(letters)
    zero = F.struct(F.substring(text, F.lit(1), F.floor(n / 2).cast("int")).alias("a"), F.substring(text, F.floor(n / 2).cast("int") + 1, n).alias("b"))

    def moved(part: Column, other: Column, r: Column) -> Column:
        shift = lambda c, i: F.substring(F.lit(letters), (F.pmod(F.instr(F.lit(letters), c) - 1 + F.pmod(prf(key, F.lit(kind), r, n, i, other), F.lit(base)), F.lit(base)) + 1).cast("int"), F.lit(1))
        return F.array_join(F.transform(F.filter(F.split(part, ""), lambda c: c != ""), shift), "")

    def step(s: Column, r: Column) -> Column:
        even = F.pmod(r, F.lit(2)) == 0
        return F.struct(
            F.when(even, moved(s["a"], s["b"], r)).otherwise(s["a"]).alias("a"),
            F.when(even, s["b"]).otherwise(moved(s["b"], s["a"], r)).alias("b"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), zero, step, lambda s: F.concat(s["a"], s["b"]))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def refilled(value: Column, chars: Column, places: str = "[0-9]") -> Column:
    """``value`` with its characters at ``places`` replaced, in order, by ``chars``."""
    before = lambda i: F.length(F.regexp_replace(F.substring(value, F.lit(1), i.cast("int")), f"[^{places[1:]}", ""))
    put = lambda c, i: F.when(c.rlike(places), F.substring(chars, (before(i) + 1).cast("int"), F.lit(1))).otherwise(c)
    return F.array_join(F.transform(F.filter(F.split(value, ""), lambda c: c != ""), put), "")


def luhn_sum(number: Column) -> Column:
    """Sum of the digits, every second from the right (not the last) doubled."""
    told = F.filter(F.split(F.reverse(number), ""), lambda c: c != "")
    one = lambda c, i: F.when(F.pmod(i, F.lit(2)) == 1, F.pmod(c.cast("int") * 2, F.lit(10)) + F.floor(c.cast("int") * 2 / 10)).otherwise(c.cast("int")).cast("int")
    return F.aggregate(F.transform(told, one), F.lit(0), lambda a, x: a + x)


def mod97(compact: Column) -> Column:
    """Remainder of the number that an IBAN stands for: the first four characters last, letters from 10 to 35."""
    told = F.concat(F.substring(compact, F.lit(5), F.length(compact)), F.substring(compact, 1, 4))
    value = lambda c: F.instr(F.lit(ALNUM.upper()), c) - 1
    step = lambda a, c: F.pmod(F.when(value(c) > 9, a * 100).otherwise(a * 10) + value(c), F.lit(97)).cast("int")
    return F.aggregate(F.filter(F.split(told, ""), lambda c: c != ""), F.lit(0), step)


def card(key: str, value: Column) -> Column:
    number = digits(value)
    body = permuted_text(key, "card", F.substring(number, F.lit(1), F.length(number) - 1), ALNUM[:10])
    checked = F.transform(F.array(body), lambda b: F.concat(b, F.pmod(10 - F.pmod(luhn_sum(F.concat(b, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string")))
    return F.when(F.pmod(luhn_sum(number), F.lit(10)) == 0, refilled(value, checked[0]))


def iban(key: str, value: Column) -> Column:
    compact = F.replace(value, F.lit(" "), F.lit(""))
    account = F.substring(compact, F.lit(5), F.length(compact))
    country = F.substring(compact, 1, 2)

    def made(new: Column) -> Column:
        zeros = F.concat(country, F.lit("00"), new)
        return F.concat(country, F.lpad((98 - mod97(zeros)).cast("string"), 2, "0"), new)

    new = refilled(account, permuted_text(key, "iban", digits(account), ALNUM[:10]))
    return F.when(mod97(compact) == 1, refilled(value, F.transform(F.array(new), made)[0], "[A-Z0-9]"))


def phone(key: str, value: Column) -> Column:
    number = digits(value)
    at = lambda start, n: F.substring(number, start, n).cast("bigint")
    start = F.when(F.length(number) == 11, F.lit(2)).otherwise(F.lit(1))
    area, exchange, line = (at(start + k, F.lit(n)) for k, n in ((0, 3), (3, 3), (6, 4)))
    new = permuted(key, "phone", ((area - 200) * 800 + exchange - 200) * 10_000 + line, 80_000, 80_000)
    text = F.transform(F.array(new), lambda x: F.concat((F.floor(x / 8_000_000) + 200).cast("string"), (F.pmod(F.floor(x / 10_000), F.lit(800)) + 200).cast("string"), F.lpad(F.pmod(x, F.lit(10_000)).cast("string"), 4, "0")))[0]
    local = F.concat(F.when(F.length(number) == 11, F.lit("1")).otherwise(F.lit("")), text)
    world = F.concat(F.substring(number, 1, 2), permuted_text(key, "world", F.substring(number, F.lit(3), F.length(number)), ALNUM[:10]))
    return refilled(value, F.when(value.rlike(f"^(?:{LOCAL_PHONE})$"), local).otherwise(world))


def ssn(key: str, value: Column) -> Column:
    number = digits(value)
    area, group, serial = (F.substring(number, *at).cast("bigint") for at in ((1, 3), (4, 2), (6, 4)))
    rank = F.when(area > 666, area - 2).otherwise(area - 1)
    new = permuted(key, "ssn", rank * 989_901 + (group - 1) * 9_999 + serial - 1, 898, 989_901)

    def made(x: Column) -> Column:
        area = F.floor(x / 989_901) + 1
        rest = F.pmod(x, F.lit(989_901))
        parts = (F.when(area > 665, area + 1).otherwise(area), 3), (F.floor(rest / 9_999) + 1, 2), (F.pmod(rest, F.lit(9_999)) + 1, 4)
        return F.concat_ws("-", *[F.lpad(p.cast("string"), n, "0") for p, n in parts])

    return F.when(area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0), F.transform(F.array(new), made)[0])


def ipv4(key: str, value: Column) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: p.cast("bigint"))
    number = F.aggregate(parts, F.lit(0).cast("bigint"), lambda a, p: a * 256 + p)
    new = permuted(key, "ipv4", number, 65_536, 65_536)
    told = F.transform(F.array(new), lambda x: F.concat_ws(".", *[F.pmod(F.floor(x / 256**k), F.lit(256)).cast("string") for k in (3, 2, 1, 0)]))[0]
    return F.when(F.forall(parts, lambda p: p < 256), told)


def date(key: str, value: Column) -> Column:
    def moved(layout: str, told: str) -> Column:
        day = F.try_to_timestamp(value, F.lit(layout)).cast("date")
        number = F.date_diff(day, F.lit(FIRST_DAY).cast("date")).cast("bigint")
        new = F.date_add(F.lit(FIRST_DAY).cast("date"), permuted(key, "date", number, 17, 4297).cast("int"))
        return F.when((number >= 0) & (number < N_DAYS), F.date_format(new, told))

    slashes = F.coalesce(moved("d/M/yyyy", "dd/MM/yyyy"), moved("M/d/yyyy", "MM/dd/yyyy"))
    return F.when(value.contains("-"), moved("yyyy-MM-dd", "yyyy-MM-dd")).when(value.contains("/"), slashes).otherwise(moved("d.M.yyyy", "dd.MM.yyyy"))


def email(key: str, value: Column) -> Column:
    name = F.lower(F.substring_index(value, "@", 1))
    chars = permuted_text(key, "email", F.regexp_replace(name, "[^0-9a-z]", ""), ALNUM)
    return F.concat(refilled(name, chars, "[0-9a-z]"), F.lit("@"), F.substring_index(value, "@", -1))


def pseudonym(key: str, value: Column) -> Column:
    """The pseudonym of a match of ``ANY``; null if it is not valid."""
    is_a = lambda pattern: value.rlike(f"^(?:{pattern})$")
    kinds = [
        (value.contains("@"), email(key, value)),
        (is_a(IBAN), iban(key, value)),
        (is_a(IPV4), ipv4(key, value)),
        (is_a(ISO_DATE) | is_a(DAY_DATE), date(key, value)),
        (is_a(SSN), ssn(key, value)),
        (is_a(LOCAL_PHONE) | is_a(WORLD_PHONE), phone(key, value)),
    ]
    return reduce(lambda case, kind: case.when(*kind), kinds[1:], F.when(*kinds[0])).when(is_a(CARD), card(key, value))


def let(value: Column, made) -> Column:
    """``made(value)`` with ``value`` worked out once."""
    return F.transform(F.array(value), made)[0]


def within(value: Column) -> Column:
    """(start, n) of the valid cards and IBANs among the pieces (tokens and separators in turn) of a run, in order; the longest win."""
    country = lambda x: reduce(lambda case, at: case.when(F.substring(x, 1, 2).isin(at[1].split()), F.lit(at[0])), IBAN_LENGTHS.items(), F.when(F.lit(False), F.lit(0)))
    compact = lambda x: F.replace(x, F.lit(" "), F.lit(""))
    valid = lambda x: (
        F.when(x.rlike(f"^(?:{CARD})$"), F.pmod(luhn_sum(digits(x)), F.lit(10)) == 0)
        .when(x.rlike(f"^(?:{IBAN})$"), (F.coalesce(country(x), F.length(compact(x))) == F.length(compact(x))) & (mod97(compact(x)) == 1))
        .otherwise(F.lit(False))
    )

    def chosen(pieces: Column) -> Column:
        text = lambda i, k: F.array_join(F.slice(pieces, i + 1, 2 * k + 1), "")
        spans = lambda i: F.transform(
            F.sequence(F.lit(0), F.least(F.lit(MOST_TOKENS - 1), F.floor((F.size(pieces) - 1 - i) / 2).cast("int"))),
            lambda k: F.struct((-F.length(text(i, k))).alias("size"), i.alias("start"), (2 * k + 1).alias("n"), text(i, k).alias("text")),
        )
        starts = F.sequence(F.lit(0), F.size(pieces) - 1, F.lit(2))
        found = F.array_sort(F.filter(F.flatten(F.transform(starts, spans)), lambda c: valid(c["text"])))
        none = F.array().cast("array<struct<start:int,n:int>>")
        free = lambda a, c: ~F.exists(a, lambda o: (c["start"] < o["start"] + o["n"]) & (o["start"] < c["start"] + c["n"]))
        add = lambda a, c: F.when(free(a, c), F.concat(a, F.array(F.struct(c["start"].alias("start"), c["n"].alias("n"))))).otherwise(a)
        return F.struct(pieces.alias("pieces"), F.array_sort(F.aggregate(found, none, add)).alias("at"))

    return let(F.regexp_extract_all(value, F.lit("[A-Z0-9]+|[^A-Z0-9]"), F.lit(0)), chosen)


def replaced(key: str, value: Column) -> Column:
    """(text, n) of a match of ``ANY``: with pseudonyms for what is valid in it, and how many."""

    def parts(run: Column) -> Column:
        """Values of a run and what is beside them, as texts with whether they are a value."""
        cut = lambda start, n: F.array_join(F.slice(run["pieces"], start + 1, n), "")
        zero = F.struct(F.lit(0).alias("end"), F.array().cast("array<string>").alias("told"))
        # A gap, a value, a gap, ...
        step = lambda a, c: F.struct((c["start"] + c["n"]).alias("end"), F.concat(a["told"], F.array(cut(a["end"], c["start"] - a["end"]), cut(c["start"], c["n"]))).alias("told"))
        last = lambda a: F.concat(a["told"], F.array(cut(a["end"], F.size(run["pieces"]) - a["end"])))
        told = F.aggregate(run["at"], zero, step, last)
        beside = lambda t: F.zip_with(F.split(t, BESIDE), F.regexp_extract_all(t, F.lit(BESIDE), F.lit(0)), lambda gap, m: F.array(gap, F.coalesce(m, F.lit(""))))
        return F.flatten(F.transform(told, lambda t, i: F.when(F.pmod(i, F.lit(2)) == 0, F.flatten(beside(t))).otherwise(F.array(t))))

    def made(texts: Column) -> Column:
        new = F.transform(texts, lambda t: F.struct(t.alias("old"), F.when(t.rlike("[0-9]"), pseudonym(key, t)).alias("new")))
        return let(new, lambda x: F.struct(F.array_join(F.transform(x, lambda t: F.coalesce(t["new"], t["old"])), "").alias("text"), F.size(F.filter(x, lambda t: t["new"].isNotNull())).alias("n")))

    whole = F.struct(value.alias("text"), F.lit(0).alias("n"))
    is_run = value.rlike(f"^(?:{IBAN}(?:{TOKEN})*+|{RUN})$")
    told = lambda new: F.when(new.isNotNull(), F.struct(new.alias("text"), F.lit(1).alias("n"))).when(is_run, let(parts_of(value), made)).otherwise(whole)
    parts_of = lambda v: let(within(v), parts)
    return let(pseudonym(key, value), told)


def working_key(secret: str) -> str:
    """What the permutations are keyed by: made of the secret, which doesn't show in plans and logs, and can't be had from it."""
    return hmac.new(secret.encode(), b"format-preserving pseudonyms", hashlib.sha256).hexdigest()


def pseudonymise(docs: DataFrame, key: str, text: str = "text", counted: str = "n_found") -> DataFrame:
    """``docs`` with ``text`` pseudonymised and ``counted``, the number of values replaced.

    ``key`` is the secret: the same key gives the same pseudonyms. Plans hold a key made of it by a one-way function;
    whoever reads plans or event logs could make the same pseudonyms, but not find the secret of other work. Texts
    without a digit or @ are not searched.
    """
    key, at = working_key(key), unused(docs, "_at")
    own = F.col(text).cast("string")
    found = F.when(own.rlike("[0-9@]"), F.regexp_extract_all(own, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))
    rest = [F.col(c) for c in docs.columns if c not in (text, counted)]
    df = docs.select(*rest, own.alias(text), F.explode(F.array(F.struct(found.alias("found")))).alias(at))
    new = F.transform(F.col(f"{at}.found"), lambda m: replaced(key, m))
    made = F.when(F.size(f"{at}.found") > 0, F.struct(F.split(F.col(text), ANY).alias("between"), new.alias("new")))
    df = df.select(*rest, text, F.explode(F.array(made)).alias(at))
    woven = F.array_join(F.flatten(F.zip_with(F.col(f"{at}.between"), F.col(f"{at}.new.text"), lambda gap, n: F.array(gap, F.coalesce(n, F.lit(""))))), "")
    order = [F.when(F.col(at).isNull(), F.col(text)).otherwise(woven).alias(text) if c == text else F.col(c) for c in docs.columns if c != counted]
    return df.select(*order, F.coalesce(F.aggregate(f"{at}.new.n", F.lit(0), lambda a, n: a + n), F.lit(0)).alias(counted))
