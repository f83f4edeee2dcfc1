"""Format-preserving pseudonyms for personal data, in DataFrame functions only.

Found and validated: e-mail addresses, IBANs (the country's length, mod 97), calendar dates
(1800 to 2199, also those of ISO timestamps, whose time stays), IPv4
addresses (octets up to 255), payment cards (Luhn), US social security numbers (issued
ranges), and phone numbers (North American plan, or ``+`` and 8 to 15 digits). Whatever
fails its check is left alone.

Each value is read as a list of numbers with a modulus each (a digit: 10, a letter: 26, an
octet: 256, a date: its day in a cycle of 146097 days as 627 x 233, ...), and the list is
permuted by a keyed Feistel network: in every round one half of the list is shifted,
number by number, by the SHA-256 of key, kind, round and other half. So the map is one to
one on each format, equal values have equal pseudonyms in all documents, and the result
has the form of the value: punctuation, letter case and lengths of digit runs stay, check
digits are computed anew. An e-mail address keeps its domain, a card its first digit, a
phone number its country code. A date keeps its notation; ``a/b/year`` is month first
where that is a date, else day first.

NULL texts stay NULL; other columns are kept, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Countries by the length of their IBAN: the registry, and those that use the form without
#: being in it (Algeria in two lengths).
IBAN_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE GG IE IM JE ME RS", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ DZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR",
    27: "BI BL CF CG CM DJ FR GA GF GP GQ GR IT KM MC MF MG MQ NC PF PM RE SM TD TF WF YT",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_pattern() -> str:
    """In groups of four exactly as long as the country has it, so that what follows is not
    taken along; of any other country in one run, which ends by itself."""
    lengths = [f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
               for n, c in sorted(IBAN_COUNTRIES.items(), reverse=True)]
    known = "|".join(sorted(set(" ".join(IBAN_COUNTRIES.values()).split())))
    return (r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})(?:" + "|".join(lengths)
            + rf"|(?!{known})[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{8,31}})(?![A-Za-z0-9])")


#: Alternatives in the order of their precedence.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9](?:[A-Za-z0-9.-]{0,250}[A-Za-z0-9])?\.[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "iban": _iban_pattern(),
    "date": r"(?<![\w./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?:(?<=-[0-9]{2})(?=[Tt][0-9]{2})|(?![\w/-]))",
    "ip": r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?\w)",
    "card": r"(?<![\w+-])(?:[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{13,19})(?![\w-])",
    "ssn": r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
    "phone": r"(?<![\w+(-])(?:\+?1[ .-]?)?(?:\([2-9][0-9]{2}\)[ .-]?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-]?[0-9]{4}(?!\w)",
    "phone_intl": r"(?<![\w+])\+[0-9](?:[ .()-]{0,2}[0-9]){7,14}(?!\w)",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
DAYS, CYCLE = "1800-01-01", (627, 233)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _at(s: Column, i) -> Column:
    """The character at place ``i`` (from 1)."""
    return s.substr(F.lit(i) if isinstance(i, int) else i, F.lit(1))


def _is(kind: str, s: Column) -> Column:
    return s.rlike(f"^(?:{PATTERNS[kind]})$")


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def feistel(values: Column, key: str, kind: str) -> Column:
    """Permute an array of structs (v, m) with 0 <= v < m: the moduli stay in place."""

    def turn(acc: Column, r: Column) -> Column:
        other = F.array_join(F.transform(acc["b"], lambda x: x["v"].cast("string")), ",")

        def shift(h: Column) -> Column:
            return F.transform(acc["a"], lambda x, i: F.struct(
                ((x["v"] + F.conv(h.substr((i % 16) * 4 + 1, F.lit(4)), 16, 10).cast("long")) % x["m"]).alias("v"), x["m"].alias("m")))

        return F.struct(acc["b"].alias("a"), _let(F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), r.cast("string"), other), 256), shift).alias("b"))

    def run(v: Column) -> Column:
        half = F.floor(F.size(v) / 2).cast("int")
        start = F.struct(F.slice(v, F.lit(1), half).alias("a"), F.slice(v, half + 1, F.size(v) - half).alias("b"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda acc: F.concat(acc["a"], acc["b"]))

    return _let(values, run)


def _number(v: Column, m) -> Column:
    return F.struct(v.cast("long").alias("v"), (F.lit(m) if isinstance(m, int) else m).cast("long").alias("m"))


def _letter(c: Column) -> Column:
    """0 to 25 of an ASCII letter of either case."""
    return F.ascii(F.lower(c)) - 97


def _permute_chars(s: Column, takes, low, key: str, kind: str) -> Column:
    """Permute the digits and letters of ``s`` at the places where ``takes(place)`` holds; the
    digit at a place is at least ``low(place)`` before and after."""
    whole = F.sequence(F.lit(1), F.char_length(s))

    def value(p: Column) -> Column:
        return _let(_at(s, p), lambda c: F.when(c.between("0", "9"), _number(F.ascii(c) - 48 - low(p), 10 - low(p))).otherwise(_number(_letter(c), 26)))

    def char(p: Column, places: Column, new: Column) -> Column:
        def place(i: Column) -> Column:
            c, v = _at(s, p), F.get(new, i.cast("int") - 1)["v"]
            return (F.when(i == 0, c)
                    .when(c.between("0", "9"), (v + low(p)).cast("string"))
                    .when(c.between("a", "z"), F.char(v + 97))
                    .otherwise(F.char(v + 65)))

        return _let(F.array_position(places, p), place)

    return _let(
        F.filter(whole, lambda p: takes(p) & _at(s, p).rlike("^[A-Za-z0-9]$")),
        lambda places: _let(feistel(F.transform(places, value), key, kind),
                            lambda new: F.array_join(F.transform(whole, lambda p: char(p, places, new)), "")))


def _luhn_sum(number: Column, doubled: int) -> Column:
    """Luhn sum of the digits; from the right, those whose place (from 0) has this parity
    count double."""

    def total(digits: Column) -> Column:
        def add(so_far: Column, p: Column) -> Column:
            d = _at(digits, p).cast("int")
            twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
            return so_far + F.when((F.char_length(digits) - p) % 2 == doubled, twice).otherwise(d)

        return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), add)

    return _let(_digits(number), total)


def _card(s: Column, key: str) -> Column:
    last = F.char_length(s)
    moved = _permute_chars(s, lambda p: (p > 1) & (p < last), lambda p: F.lit(0), key, "card")
    return _let(moved.substr(F.lit(1), last - 1),
                lambda body: F.concat(body, ((10 - _luhn_sum(body, 0) % 10) % 10).cast("string")))


def _mod97(spelled: Column) -> Column:
    """Remainder of the number that IBAN characters spell (letters count 10 to 35)."""

    def rest(s: Column) -> Column:
        def add(r: Column, p: Column) -> Column:
            c = _at(s, p)
            return F.when(c.between("0", "9"), (r * 10 + c.cast("int")) % 97).otherwise((r * 100 + _letter(c) + 10) % 97)

        return F.aggregate(F.sequence(F.lit(1), F.char_length(s)), F.lit(0), add)

    return _let(spelled, rest)


def _iban(s: Column, key: str) -> Column:
    moved = _permute_chars(s, lambda p: p > 4, lambda p: F.lit(0), key, "iban")

    def check(new: Column) -> Column:
        body = F.concat(F.regexp_replace(new.substr(F.lit(5), F.char_length(new)), " ", ""), new.substr(1, 2), F.lit("00"))
        return F.concat(new.substr(1, 2), F.lpad((98 - _mod97(body)).cast("string"), 2, "0"), new.substr(F.lit(5), F.char_length(new)))

    return _let(moved, check)


def _iban_ok(s: Column) -> Column:
    return _mod97(F.concat(F.regexp_replace(s.substr(F.lit(5), F.char_length(s)), " ", ""), s.substr(1, 4))) == 1


def _ip(s: Column, key: str) -> Column:
    new = feistel(F.transform(F.split(s, r"\."), lambda x: _number(x, 256)), key, "ip")
    return F.array_join(F.transform(new, lambda x: x["v"].cast("string")), ".")


def _ssn_parts(s: Column) -> tuple[Column, Column, Column]:
    return s.substr(1, 3).cast("int"), s.substr(5, 2).cast("int"), s.substr(8, 4).cast("int")


def _ssn(s: Column, key: str) -> Column:
    area, group, serial = _ssn_parts(s)
    new = feistel(F.array(_number(area - 1 - (area > 666).cast("int"), 898), _number(group - 1, 99), _number(serial - 1, 9999)), key, "ssn")
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")

    def write(x: Column) -> Column:
        v = [F.get(x, F.lit(i))["v"] for i in range(3)]
        return F.concat_ws("-", pad(v[0] + 1 + (v[0] >= 665).cast("long"), 3), pad(v[1] + 1, 2), pad(v[2] + 1, 4))

    return _let(new, write)


def _ssn_ok(s: Column) -> Column:
    area, group, serial = _ssn_parts(s)
    return (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)


def _day(y: Column, m: Column, d: Column) -> Column:
    return F.try_to_date(F.concat_ws("-", F.lpad(y, 4, "0"), F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")


def _date_of(s: Column) -> Column:
    """Struct of the date (NULL if it is none) and whether its notation is month first."""

    def read(n: Column) -> Column:
        a, b, c = (F.get(n, F.lit(i)) for i in range(3))
        first = F.when(s.contains("/"), _day(c, a, b))
        day = F.when(s.contains("-"), _day(a, b, c)).otherwise(F.coalesce(first, _day(c, b, a)))
        return F.struct(F.when(day.between(F.lit(DAYS).cast("date"), F.lit("2199-12-31").cast("date")), day).alias("day"), first.isNotNull().alias("month_first"))

    return _let(F.split(s, "[-/.]"), read)


def _date(s: Column, key: str) -> Column:
    start = F.lit(DAYS).cast("date")

    def move(x: Column) -> Column:
        n = F.datediff(x["day"], start)
        new = feistel(F.array(_number(F.floor(n / CYCLE[1]), CYCLE[0]), _number(n % CYCLE[1], CYCLE[1])), key, "date")
        out = F.aggregate(new, F.lit(0).cast("long"), lambda acc, v: acc * CYCLE[1] + v["v"])
        return _let(F.date_add(start, out.cast("int")), lambda day: write(day, x["month_first"]))

    def write(day: Column, month_first: Column) -> Column:
        parts, mark = F.split(s, "[/.]"), F.when(s.contains("/"), "/").otherwise(".")
        width = lambda i, c: F.lpad(c.cast("string"), F.greatest(F.char_length(F.get(parts, F.lit(i))), F.char_length(c.cast("string"))), F.lit("0"))
        d, m, y = F.dayofmonth(day), F.month(day), F.year(day).cast("string")
        return (F.when(s.contains("-"), F.date_format(day, "yyyy-MM-dd"))
                .when(month_first, F.concat(width(0, m), mark, width(1, d), mark, y))
                .otherwise(F.concat(width(0, d), mark, width(1, m), mark, y)))

    return _let(_date_of(s), move)


def _phone(s: Column, key: str) -> Column:
    """Ten digits; area and exchange codes begin with 2 to 9."""
    skip = F.char_length(_digits(s)) - 10
    order = lambda p: F.char_length(_digits(s.substr(F.lit(1), p))) - skip  # noqa: E731  which digit of the ten
    return _permute_chars(s, lambda p: order(p) >= 1, lambda p: F.when(order(p).isin(1, 4), 2).otherwise(0), key, "phone")


def _phone_intl(s: Column, key: str) -> Column:
    return _permute_chars(s, lambda p: F.char_length(_digits(s.substr(F.lit(1), p))) > 2, lambda p: F.lit(0), key, "phone_intl")


def pseudonym(s: Column, key: str) -> Column:
    """The pseudonym of one match of ``ANY``; the match itself if it fails its check."""
    at = F.instr(s, "@")
    rules = [
        (_is("email", s), _permute_chars(s, lambda p: p < at, lambda p: F.lit(0), key, "email")),
        (_is("iban", s) & _iban_ok(s), _iban(s, key)),
        (_is("date", s) & _date_of(s)["day"].isNotNull(), _date(s, key)),
        (_is("ip", s) & F.forall(F.split(s, r"\."), lambda x: x.cast("int") < 256), _ip(s, key)),
        (_is("card", s) & (_luhn_sum(s, 1) % 10 == 0) & s.rlike("[1-9]"), _card(s, key)),
        (_is("ssn", s) & _ssn_ok(s), _ssn(s, key)),
        (_is("phone", s), _phone(s, key)),
        (_is("phone_intl", s), _phone_intl(s, key)),
    ]
    return reduce(lambda rest, rule: F.when(rule[0], rule[1]).otherwise(rest), reversed(rules), s)


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with the personal data in ``text_col`` replaced; ``count_col``, if given, gets
    the number of values replaced (0 for NULL)."""
    text = F.col(text_col)
    likely = text.rlike("[0-9@]")  # a cheap look before the full pattern
    pairs = F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), lambda m: F.struct(m.alias("old"), pseudonym(m, key).alias("new")))
    joined = F.array_join(F.zip_with(F.split(text, ANY, -1), F.col("__pairs"), lambda gap, p: F.concat(gap, F.coalesce(p["new"], F.lit("")))), "")
    n = F.size(F.filter("__pairs", lambda p: p["old"] != p["new"]))
    out = {text_col: F.when(F.size("__pairs") > 0, joined).otherwise(text)}
    if count_col is not None:
        out[count_col] = F.when(F.size("__pairs") > 0, n).otherwise(0)
    return docs.withColumn("__pairs", F.when(likely, pairs)).withColumns(out).drop("__pairs")
