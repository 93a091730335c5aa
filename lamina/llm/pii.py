"""Format-preserving pseudonyms for personal data; built-in expressions only.

Cards and IBANs are validated first (Luhn, mod 97), since neighbours of a value can
read as a part of it: every part of a digit run that begins and ends with a group, and
an IBAN by its country's length. One pattern then finds a text's values, of cards and
IBANs those validated. A match that passes its kind's validation (the calendar for
dates, ranges for the rest) is replaced by a keyed permutation within its format:

* a Feistel network on the two halves of the value. A round adds a stream of
  SHA-256(key, kind, round, other half) to each character of a half, modulo the
  size of the character's class (digits, lower or upper case), so that the result
  has the same length, layout and character classes;
* on numbers with a range (dates, SSNs, IPv4 addresses) the halves are residues
  of a mixed radix, and a round adds modulo the radix;
* check digits are computed anew.

The value is stripped of its layout first: the same number written with other
separators, or the same day in another date format, gets the same pseudonym in
every document. The permutation is a bijection within its domain, and whoever has
the key can invert it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

_MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"

#: kind -> pattern, in order of precedence. No pattern can match the empty text, and
#: each begins behind a boundary, so that a long run of characters is read once. Groups
#: without a bound repeat possessively: Java's matcher then loops, and doesn't recurse.
PATTERNS = {
    "email": (r"(?<![._%+-])[A-Za-z0-9._%+-]++@(?=[A-Za-z0-9.-]*\.[A-Za-z]{2})[A-Za-z0-9-]++"
              r"(?:\.[A-Za-z0-9-]++)*+"),
    "key": r"AKIA[0-9A-Z]{16}(?![A-Za-z0-9])",
    "secret": r"""(?<!_)(?i:password|passwd|secret|api_key|token)\s?[=:]\s?["']?[A-Za-z0-9_+/.~-]{8,}+["']?""",
    "iban": r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "month": rf"(?<![A-Za-z])(?:{_MONTHS}) \d{{1,2}}, \d{{4}}(?!\d)",
    "ipv4": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)",
    "date": (r"(?<![\d/.-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}\.\d{2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4})(?![\d/-])"
             rf"|(?<!\d)\d{{1,2}} (?:{_MONTHS}) \d{{4}}(?!\d)"),
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-])",
    "phone": (r"(?<![\d+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d){5,10}(?!\d)"
              r"|(?<![\d(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])[2-9]\d{2}[ .-][2-9]\d{2}[ .-]\d{4}(?![\d-])"),
}
_AT_WORDS = ("email", "key", "secret", "iban")


def _either(kinds) -> str:
    return "|".join(f"(?:{PATTERNS[k]})" for k in kinds)


#: All kinds, but for the two places of a text's own IBANs and cards. Tests of one
#: character decide at most places: those that begin with a token stand at a word's
#: start, months begin with a capital, the others with a digit or a sign.
_IBANS, _CARDS = "<ibans>", "<cards>"
_FRAME = (rf"(?<![A-Za-z0-9])(?=[A-Za-z0-9._%+-])(?:{_either(k for k in _AT_WORDS if k != 'iban')}|{_IBANS})"
          rf"|(?=[ADFJMNOS])(?:{_either(['month'])})"
          rf"|(?=[\d+(])(?:{_either(k for k in PATTERNS if k not in (*_AT_WORDS, 'month', 'card', 'phone'))}"
          rf"|{_CARDS}|{_either(['phone'])})")
_NONE = "(?!)"
#: What may be an IBAN, with the character behind it; and up to 19 digits in whole groups.
#: Both are looked at from every place where one may begin.
_IBAN_AT = r"(?=[A-Z]{2}\d{2})(?<![A-Za-z0-9])(?=([A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}[A-Za-z0-9]?))"
_RUN_AT = r"(?=\d)(?<!\d)(?<!^-)(?<!\D-)(?=(\d(?:[ -]?\d){12,18})(?!\d|-\D|-$))"
#: Digits in the groups of a card.
_CARD_LAYOUT = r"^(?:[2-6]\d{12,18}|[2-6]\d{3}([ -])\d{4}\1\d{4}\1\d{4}|3\d{3}([ -])\d{6}\2\d{4,5})$"
#: Lengths of the registered IBANs.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
    32: "LC", 33: "RU"}
#: Places that no value crosses and whose left side no pattern looks behind: after a line
#: feed, if no sign of a secret is beside it, after a semicolon, and after a comma that
#: isn't a month's (behind its day). A text falls into parts there, each with its own
#: values, so that a page of numbers isn't searched with all of them at every place.
_PART_END = r"(?<=\n)(?<![=:]\n)(?![=:])|(?<=;)|(?<=\d\d\d,)|(?<=[^\d],)"
#: A text without any of these holds no match.
QUICK = r"[0-9@=:]|AKIA"

#: A stream has 32 bytes: secrets and mail names of over 128 characters are permuted in blocks of 32,
#: the last one of up to 63.
_BLOCKS = r".{32}(?=.{32})|.+"
_FIRST_DAY = "1900-01-01"
#: 1900 to 2099 have 73,049 days: 17 times 4,297.
_DAYS = (17, 4297)
#: Areas 1 to 899 but 666, times groups 1 to 99 and serials 1 to 9999.
_SSN = (898, 99 * 9999)


def _prf(key: str, kind: str, i: Column, other: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), other.cast("string")).cast("binary"), 256)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _add_stream(half: Column, stream: Column, upper: int, lower: int) -> Column:
    """Each character moved on within its class by a byte of the stream."""
    def all_moved(bytes_: Column) -> Column:
        def moved(j: Column) -> Column:
            c = F.substr(half, j, F.lit(1))
            a = F.ascii(c)
            b = F.conv(F.substr(bytes_, 1 + 2 * F.pmod(j - 1, F.lit(32)), F.lit(2)), 16, 10).cast("int")
            return (F.when(a.between(48, 57), F.char(48 + F.pmod(a - 48 + b, F.lit(10))))
                    .when(a.between(65, 64 + upper), F.char(65 + F.pmod(a - 65 + b, F.lit(upper))))
                    .when(a.between(97, 96 + lower), F.char(97 + F.pmod(a - 97 + b, F.lit(lower))))
                    .otherwise(c))

        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(half)), moved), "")

    return F.when(F.length(half) == 0, F.lit("")).otherwise(_let(stream, all_moved))


def feistel_text(value: Column, key: str, kind: str, upper: int = 26, lower: int = 26) -> Column:
    """Permutation of the strings with the same characters' classes. ``upper`` and
    ``lower`` are the sizes of the letter classes, from A and a."""
    def halves(v: Column) -> Column:
        half = F.floor(F.length(v) / 2).cast("int")
        return F.struct(F.substr(v, F.lit(1), half).alias("l"), F.substr(v, half + 1, F.length(v)).alias("r"))

    def step(s: Column, i: Column) -> Column:
        left, right = s["l"], s["r"]
        return (F.when(i % 2 == 1, F.struct(left.alias("l"), _add_stream(right, _prf(key, kind, i, left), upper, lower).alias("r")))
                .otherwise(F.struct(_add_stream(left, _prf(key, kind, i, right), upper, lower).alias("l"), right.alias("r"))))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), _let(value, halves), step, lambda s: F.concat(s["l"], s["r"]))


def feistel_number(value: Column, key: str, kind: str, radix: tuple[int, int]) -> Column:
    """Permutation of 0 .. radix[0] * radix[1] - 1."""
    a, b = F.lit(radix[0]).cast("long"), F.lit(radix[1]).cast("long")

    def halves(v: Column) -> Column:
        return F.struct(F.floor(v / b).cast("long").alias("l"), F.pmod(v, b).alias("r"))

    def drawn(i: Column, other: Column) -> Column:
        return F.conv(F.substr(_prf(key, kind, i, other), F.lit(1), F.lit(12)), 16, 10).cast("long")

    def step(s: Column, i: Column) -> Column:
        left, right = s["l"], s["r"]
        return (F.when(i % 2 == 1, F.struct(left.alias("l"), F.pmod(right + drawn(i, left), b).alias("r")))
                .otherwise(F.struct(F.pmod(left + drawn(i, right), a).alias("l"), right.alias("r"))))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), _let(value.cast("long"), halves), step,
                       lambda s: s["l"] * b + s["r"])


def _blocks(value: Column) -> Column:
    return F.when(F.length(value) > 128, F.regexp_extract_all(value, F.lit(_BLOCKS), F.lit(0))).otherwise(F.array(value))


def _strip(value: Column, but: str) -> Column:
    return F.regexp_replace(value, f"[^{but}]", "")


def _into_layout(layout: Column, value: Column, signs: str) -> Column:
    """``value``'s characters in the places of those of ``layout`` that are in ``signs``."""
    def filled(new: Column) -> Column:
        def at(j: Column) -> Column:
            c = F.substr(layout, j, F.lit(1))
            nth = F.length(_strip(F.substr(layout, F.lit(1), j), signs))
            return F.when(c.rlike(f"[{signs}]"), F.substr(new, nth, F.lit(1))).otherwise(c)

        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(layout)), at), "")

    return _let(value, filled)


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Sum of the digits; those at places p from the right with p % 2 == ``doubled`` doubled."""
    n = F.length(digits)

    def add(total: Column, j: Column) -> Column:
        d = F.substr(digits, j, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when((n - j + 1) % 2 == doubled, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _card(m: Column, key: str) -> Column:
    def checked(body: Column) -> Column:
        return F.concat(body, F.pmod(F.lit(10) - F.pmod(_luhn_sum(body, 1), F.lit(10)), F.lit(10)).cast("string"))

    def replaced(digits: Column) -> Column:
        body = F.concat(F.substr(digits, F.lit(1), F.lit(1)),
                        feistel_text(F.substr(digits, F.lit(2), F.length(digits) - 2), key, "card"))
        return F.when(F.pmod(_luhn_sum(digits, 0), F.lit(10)) == 0,
                      _into_layout(m, _let(body, checked), "0-9")).otherwise(m)

    return _let(_strip(m, "0-9"), replaced)


def _mod97(text: Column) -> Column:
    """Remainder of letters and digits read as an IBAN number (A is 10)."""
    def all_added(t: Column) -> Column:
        def add(rest: Column, j: Column) -> Column:
            a = F.ascii(F.substr(t, j, F.lit(1)))
            return F.when(a < 65, F.pmod(rest * 10 + a - 48, F.lit(97))).otherwise(F.pmod(rest * 100 + a - 55, F.lit(97)))

        return F.aggregate(F.sequence(F.lit(1), F.length(t)), F.lit(0), add)

    return _let(text, all_added)


def _iban(m: Column, key: str) -> Column:
    def replaced(plain: Column) -> Column:
        country, body = F.substr(plain, F.lit(1), F.lit(2)), F.substr(plain, F.lit(5), F.length(plain))
        valid = _mod97(F.concat(body, F.substr(plain, F.lit(1), F.lit(4)))) == 1

        def checked(new: Column) -> Column:
            check = F.lpad((98 - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
            return F.concat(country, check, new)

        new = _let(feistel_text(body, key, "iban"), checked)
        return F.when(valid, _into_layout(m, new, "A-Z0-9")).otherwise(m)

    return _let(_strip(m, "A-Z0-9"), replaced)


def _phone(m: Column, key: str) -> Column:
    """The national number's last ten digits (all but the country code's) are
    permuted; places that begin an area or an exchange keep their class."""
    def lead(s: Column) -> Column:
        return F.translate(s, "0123456789", "abABCDEFGH")

    def replaced(digits: Column) -> Column:
        n = F.length(digits)
        own = F.least(n, F.lit(10))
        code, number = F.substr(digits, F.lit(1), n - own), F.substr(digits, n - own + 1, own)
        marked = F.concat(lead(F.substr(number, F.lit(1), F.lit(1))), F.substr(number, F.lit(2), F.lit(2)),
                          lead(F.substr(number, F.lit(4), F.lit(1))), F.substr(number, F.lit(5), own))
        new = F.translate(feistel_text(marked, key, "phone", upper=8, lower=2), "abABCDEFGH", "0123456789")
        return _into_layout(m, F.concat(code, new), "0-9")

    return _let(_strip(m, "0-9"), replaced)


def _ipv4(m: Column, key: str) -> Column:
    number = F.aggregate(F.split(m, r"\."), F.lit(0).cast("long"), lambda s, x: s * 256 + x.cast("long"))
    return _let(feistel_number(number, key, "ipv4", (65536, 65536)), lambda new: F.concat_ws(
        ".", *[F.pmod(F.shiftright(new, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)]))


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.split(m, "-")[i].cast("int") for i in range(3))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    index = area - F.when(area > 666, 2).otherwise(1)

    def written(new: Column) -> Column:
        first, rest = F.floor(new / _SSN[1]) + 1, F.pmod(new, F.lit(_SSN[1]))
        first = F.when(first >= 666, first + 1).otherwise(first)
        return F.concat_ws(
            "-", F.lpad(first.cast("string"), 3, "0"), F.lpad((F.floor(rest / 9999) + 1).cast("string"), 2, "0"),
            F.lpad((F.pmod(rest, F.lit(9999)) + 1).cast("string"), 4, "0"))

    new = feistel_number(index * _SSN[1] + (group - 1) * 9999 + serial - 1, key, "ssn", _SSN)
    return F.when(valid, _let(new, written)).otherwise(m)


def _date(m: Column, key: str) -> Column:
    """The same layout's text of another day of 1900 to 2099."""
    forms = [(r"^\d{4}-", "yyyy-MM-dd"), (r"^\d{4}/", "yyyy/MM/dd"), (r"^\d{2}\.", "dd.MM.yyyy"),
             (r"^\d{2}/\d{2}/", "MM/dd/yyyy"), (r"^\d{2}/\d{2}/", "dd/MM/yyyy"),
             (r"^\d{1,2}/", "M/d/yyyy"), (r"^\d{1,2}/", "d/M/yyyy"),
             (r"^\d{1,2} ", "d MMMM yyyy"), (r"^[A-Z]", "MMMM d, yyyy")]
    out = m
    for shape, form in reversed(forms):
        index = F.datediff(F.try_to_timestamp(m, F.lit(form)).cast("date"), F.lit(_FIRST_DAY).cast("date"))
        fits = m.rlike(shape) & index.between(0, _DAYS[0] * _DAYS[1] - 1)
        new = F.date_add(F.lit(_FIRST_DAY).cast("date"), feistel_number(index, key, "date", _DAYS).cast("int"))
        out = F.when(fits, F.date_format(new, form)).otherwise(out)
    return out


def _email(m: Column, key: str) -> Column:
    """The local part is permuted; domains of mail hosts stay."""
    name = F.substring_index(m, "@", 1)
    new = F.array_join(F.transform(_blocks(name), lambda v: feistel_text(v, key, "email")), "")
    return F.concat(new, F.lit("@"), F.substring_index(m, "@", -1))


def _secret(m: Column, key: str) -> Column:
    name = F.regexp_extract(m, r"""^([A-Za-z_]+\s?[=:]\s?["']?)""", 1)
    value = F.regexp_extract(m, r"""^[A-Za-z_]+\s?[=:]\s?["']?([A-Za-z0-9_+/.~-]*)""", 1)
    end = F.substr(m, F.length(name) + F.length(value) + 1, F.length(m))

    def permuted(kind: str, lower: int) -> Column:
        return F.array_join(F.transform(_blocks(value), lambda v: feistel_text(v, key, kind, lower=lower)), "")

    new = F.when(value.rlike("^[0-9a-f]+$"), permuted("hex", 6)).otherwise(permuted("secret", 26))
    return F.concat(name, new, end)


def _key(m: Column, key: str) -> Column:
    return F.concat(F.lit("AKIA"), feistel_text(F.substr(m, F.lit(5), F.lit(16)), key, "key"))


#: Columns for the length of one projection, by names that no table has.
_COLUMNS = tuple(f"__pseudonym_7d0c5f_{n}" for n in ("parts", "found", "new", "values"))

_REPLACE = {"email": _email, "key": _key, "secret": _secret, "iban": _iban, "month": _date, "ipv4": _ipv4,
            "date": _date, "ssn": _ssn, "card": _card, "phone": _phone}


def _starting(found: Column, item: str, count: Column, end: str) -> Column:
    """The part of ``found`` with ``count`` signs after its first; empty if it ends within a group."""
    return F.call_function("regexp_extract", found, F.concat(F.lit(f"^({item}"), count.cast("string"), F.lit(f"}}){end}")), F.lit(1))


def _ibans(text: Column) -> Column:
    """The valid IBANs of a text: of registered countries those of their length, of
    others the valid starts, longest first."""
    def starts(w: Column) -> Column:
        own = F.sequence(F.lit(34), F.lit(15), F.lit(-1))
        for n, countries in IBAN_LENGTHS.items():
            own = F.when(F.substr(w, F.lit(1), F.lit(2)).isin(countries.split()), F.array(F.lit(n))).otherwise(own)
        return F.transform(own, lambda n: _starting(
            w, r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]){", n - 4, "(?![A-Za-z0-9])"))

    def valid(v: Column) -> Column:
        return (v != "") & (_let(_strip(v, "A-Z0-9"), lambda p: _mod97(
            F.concat(F.substr(p, F.lit(5), F.length(p)), F.substr(p, F.lit(1), F.lit(4))))) == 1)

    windows = F.array_distinct(F.regexp_extract_all(text, F.lit(_IBAN_AT), F.lit(1)))
    return F.filter(F.flatten(F.transform(windows, starts)), valid)


def _cards(text: Column) -> Column:
    """The parts of a text's digit runs, in whole groups, that Luhn's sum allows; longest first."""
    def starts(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(18), F.lit(12), F.lit(-1)),
                           lambda n: _starting(w, r"\d(?:[ -]?\d){", n, r"(?!\d)"))

    windows = F.array_distinct(F.regexp_extract_all(text, F.lit(_RUN_AT), F.lit(1)))
    return F.array_distinct(F.filter(F.flatten(F.transform(windows, starts)),
                                     lambda v: (v != "") & F.call_function("luhn_check", _strip(v, "0-9"))))


def _values(text: Column) -> Column:
    """The pattern of all kinds for this text, with its own valid IBANs and cards. Parts
    in a card's layout come first, and others don't begin where they would cut one."""
    first, between, last = re.split(f"{_IBANS}|{_CARDS}", _FRAME)

    def any_of(values: Column, end: str) -> Column:
        return F.concat(F.lit("(?:"), F.array_join(F.array_append(values, F.lit(_NONE)), "|"), F.lit(f"){end}"))

    def cards(found: Column) -> Column:
        usual = any_of(F.filter(found, lambda v: v.rlike(_CARD_LAYOUT)), r"(?!\d)")
        others = F.transform(F.filter(found, lambda v: ~v.rlike(_CARD_LAYOUT)), lambda v: F.concat(
            F.lit(r"(?![\d -]{1,"), (F.length(v) - 1).cast("string"), F.lit(r"}(?<!\d)"), usual, F.lit(")"), v))
        return F.concat(F.lit(r"(?<!\d)(?:"), usual, F.lit("|"), any_of(others, r"(?!\d)"), F.lit(")"))

    return F.concat(F.lit(first), any_of(_ibans(text), "(?![A-Za-z0-9])"), F.lit(between),
                    _let(_cards(text), cards), F.lit(last))


def pseudonym(m: Column, key: str) -> Column:
    """The replacement of one match; itself if its kind's validation fails."""
    out = m
    for kind in reversed(PATTERNS):
        out = F.when(m.rlike(f"^(?:{PATTERNS[kind]})$"), _REPLACE[kind](m, key)).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text",
                 count_col: str | None = None) -> DataFrame:
    """``docs`` with the personal data of ``text_col`` replaced; ``count_col`` adds
    the number of replaced values.

    A null text stays null, an empty one empty; rows, their other columns and
    texts without personal data are unchanged. No shuffle.
    """
    parts, found, new, values = _COLUMNS
    text = F.col(text_col)
    rows = docs.withColumn(parts, F.when(text.rlike(QUICK), F.split(text, _PART_END, -1)))
    rows = rows.withColumn(values, F.transform(parts, lambda p: F.when(p.rlike(QUICK), _values(p)).otherwise(F.lit(_NONE))))
    rows = rows.withColumn(found, F.zip_with(parts, values, lambda p, v: F.regexp_extract_all(p, v, F.lit(0))))
    some = F.exists(found, lambda f: F.size(f) > 0)
    rows = rows.withColumn(new, F.when(some, F.transform(found, lambda f: F.transform(f, lambda m: pseudonym(m, key)))))

    def joined(p: Column, v: Column, n: Column) -> Column:
        return _let(F.split(p, v, -1), lambda between: F.concat(
            F.array_join(F.zip_with(F.slice(between, 1, F.size(n)), n, lambda a, b: F.concat(a, b)), ""),
            F.element_at(between, -1)))

    whole = F.array_join(F.transform(F.arrays_zip(F.col(parts).alias("p"), F.col(values).alias("v"), F.col(new).alias("n")),
                                     lambda x: joined(x["p"], x["v"], x["n"])), "")
    rows = rows.withColumn(text_col, F.when(F.col(new).isNotNull(), whole).otherwise(text))
    if count_col:
        differs = F.aggregate(F.zip_with(found, new, lambda f, n: F.size(F.filter(
            F.zip_with(f, n, lambda a, b: a != b), lambda x: x))), F.lit(0).cast("long"), lambda s, x: s + x)
        rows = rows.withColumn(count_col, F.coalesce(differs, F.lit(0).cast("long")))
    return rows.drop(*_COLUMNS)
