"""Format-preserving pseudonyms for personal numbers, dates and addresses, in DataFrame functions alone.

Candidates are found by pattern and validated (Luhn, mod 97, calendar, octets, area rules).  A
valid value is permuted inside its own format by a keyed Feistel network whose two halves are
added modulo the size of their part, so the permutation is one-to-one on exactly the valid values:

* card numbers keep length and separators and stay Luhn-valid,
* dates from 1800 to 2199 stay such dates and keep their layout,
* IPv4 addresses, US social security numbers, IBANs and phone numbers stay well formed,
* e-mail addresses keep the class of each character (digits, small and capital letters move inside their class; so
  do those of Latin-1, Cyrillic and Greek, other scripts' letters stay).

Equal values get equal pseudonyms in every document, and only holders of the key can go back.
Invalid candidates, such as a digit run that fails Luhn, are left as they are.

Layouts: dates are three numbers with -, / or . between them, the year (four digits) first or last,
days and months of one or two digits.  With the year last, a dot puts the day first and - or / the
month, unless only the other order is in the calendar.  A day of 1 to 9, 10 to 12 or from 13 on and
a month of 1 to 9 or from 10 on stay in that range, so that every layout of a day can show the same
pseudonym and each text is read the way it was written; this much of a date is visible.  IBANs are
unbroken or in groups of four with one blank or - between them, those in groups by the lengths of
``IBAN_LENGTHS``.  Not found: dates with month names, two-digit years or no marks, dates that touch a
further number with -, / or . (such as ranges without blanks) or follow one of these marks, IBANs in
small letters, phone numbers with blanks or nothing between their groups unless they begin with + or a bracket,
cards in other groups than 4-4-4-4 and 4-6-5, social security numbers without marks, IPv6 addresses.

The key is needed, and stays out of plans and event logs.

Defined results: null stays null and has no values; an empty text stays empty; a text is read whole, however long; where
candidates overlap the one that begins first counts; repeated rows are treated alike; an empty table gives an empty
result; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.llm.columns import let

ROUNDS = 8
_EDGE, _NO_MORE = r"(?<![0-9A-Za-z.+-])", r"(?![0-9A-Za-z])"

#: Letters and digits of any script, so that no address is cut.  Begins after any punctuation that no letter or digit
#: precedes, as in _john@x.com_.
_SIGN = r"\p{L}\p{M}\p{N}"
EMAIL = (
    rf"(?<![{_SIGN}])(?<![{_SIGN}][._%+-])[\p{{L}}\p{{N}}][{_SIGN}._%+-]{{0,63}}"
    rf"@(?:[{_SIGN}-]{{1,63}}\.){{1,8}}[\p{{L}}\p{{M}}]{{2,24}}"
)
#: Further alphabets whose letters move inside their own one.  Fixed values: Latin-1, Cyrillic and Greek.
ALPHABETS = (
    "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ",
    "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
    "αβγδεζηθικλμνξοπρςστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
)
#: Countries by the length of their IBANs, those outside the registry included.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}


def _grouped(length: int, countries: str) -> str:
    groups, last = divmod(length - 4, 4)
    end = rf"\k<gap>[A-Z0-9]{{{last}}}" if last else ""
    return rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:\k<gap>[A-Z0-9]{{4}}){{{groups}}}{end}"


#: Exactly as many groups as the country has, so that no word after the number is taken for one.
IBAN_GROUPS = (
    _EDGE
    + r"(?=[A-Z]{2}[0-9]{2}(?<gap>[ \u00a0-]))(?:"
    + "|".join(_grouped(length, countries) for length, countries in IBAN_LENGTHS.items())
    + ")"
    + _NO_MORE
)
IBAN = _EDGE + r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}" + _NO_MORE
IPV4 = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])"
DATE = (
    r"(?<![0-9./-])(?:[0-9]{4}(?<mark>[-/.])[0-9]{1,2}\k<mark>[0-9]{1,2}"
    r"|[0-9]{1,2}(?<sign>[-/.])[0-9]{1,2}\k<sign>[0-9]{4})(?![./-]?[0-9])"
)
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?!-?[0-9])"
PHONE = (
    r"(?<![0-9])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){1,4}"
    r"|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|[0-9]{3}(?<dash>[-.])[0-9]{3}\k<dash>[0-9]{4})(?![0-9])"
)
CARD = (
    r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?<four>[ -])[0-9]{4}\k<four>[0-9]{4}\k<four>[0-9]{4}"
    r"|[0-9]{4}(?<six>[ -])[0-9]{6}\k<six>[0-9]{5})(?![0-9])"
)
#: Back references go by name, so that each pattern is the same alone and in the alternation.
ANY = "|".join((DATE, PHONE, CARD, EMAIL, IBAN, IBAN_GROUPS, IPV4, SSN))


def _is(value: Column, pattern: str) -> Column:
    return value.rlike(f"^(?:{pattern})$")


def _drawn(key: Column, *parts: Column) -> Column:
    """A keyed pseudo-random number below 2^60: the head of a SHA-256 with the key on both ends."""
    digest = F.sha2(F.concat_ws("|", key, *[p.cast("string") for p in parts], key), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _feistel(left: Column, right: Column, lefts: Column, rights: Column, key: Column, kind: str) -> Column:
    """Struct of both halves after the rounds; ``lefts`` and ``rights`` are the sizes of the parts."""

    def turn(halves: Column, i: Column) -> Column:
        a, b = halves["a"], halves["b"]
        return F.when(
            i % 2 == 0, F.struct(((a + _drawn(key, F.lit(kind), i, b) % lefts) % lefts).alias("a"), b.alias("b"))
        ).otherwise(F.struct(a.alias("a"), ((b + _drawn(key, F.lit(kind), i, a) % rights) % rights).alias("b")))

    start = F.struct(left.cast("long").alias("a"), right.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _power(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("long")


def _digits(value: Column, key: Column, kind: str) -> Column:
    """A digit string of 2 to 36 digits permuted among those of its length."""
    half = F.floor(F.length(value) / 2).cast("int")
    rest = F.length(value) - half
    return let(
        _feistel(
            F.substring(value, F.lit(1), half), F.substring(value, half + 1, rest), _power(half), _power(rest), key, kind
        ),
        lambda x: F.concat(F.lpad(x["a"].cast("string"), half, "0"), F.lpad(x["b"].cast("string"), rest, "0")),
    )


def _refill(value: Column, chars: Column, kind: str = "[0-9]") -> Column:
    """The characters of ``value`` that match ``kind`` replaced in order."""

    def step(state: Column, c: Column) -> Column:
        return F.when(
            c.rlike(kind),
            F.struct(
                F.concat(state["out"], F.substring(state["rest"], 1, 1)).alias("out"),
                F.substring(state["rest"], F.lit(2), F.length(state["rest"])).alias("rest"),
            ),
        ).otherwise(F.struct(F.concat(state["out"], c).alias("out"), state["rest"].alias("rest")))

    start = F.struct(F.lit("").alias("out"), chars.alias("rest"))
    return F.aggregate(F.split(value, ""), start, step)["out"]


def _only_digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _card(value: Column, key: Column) -> Column:
    def closed(body: Column) -> Column:
        ten = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: F.concat(body, d.cast("string")))
        return F.element_at(F.filter(ten, lambda number: _luhn(number)), 1)

    digits = _only_digits(value)
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    return F.when(
        _luhn(digits), _refill(value, let(_digits(body, key, "card"), closed))
    ).otherwise(value)


def _days(year: Column, month: Column) -> Column:
    """Days of the month."""
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    return F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)


def _moved_date(year: Column, month: Column, day: Column, key: Column) -> Column:
    """Struct of year, month and day, permuted among the dates of the cycle whose day and month lie in the same ranges."""
    early = month <= 9
    first_month, months = F.when(early, 1).otherwise(10), F.when(early, 9).otherwise(3)
    first_day = F.when(day <= 9, 1).when(day <= 12, 10).otherwise(13)
    days = F.when(day <= 9, 9).when(day <= 12, 3).otherwise(19)
    ranges = F.struct(*[c.alias(n) for c, n in ((first_month, "month"), (months, "months"), (first_day, "day"), (days, "days"))])

    def permuted(at: Column) -> Column:
        def date(x: Column) -> Column:
            parts = (x["a"] + 1800, F.floor(x["b"] / at["days"]) + at["month"], x["b"] % at["days"] + at["day"])
            return F.struct(*[p.cast("int").alias(n) for p, n in zip(parts, ("year", "month", "day"))])

        def turn(x: Column) -> Column:
            return _feistel(x["a"], x["b"], F.lit(400), at["months"] * at["days"], key, "date")

        # The 31st of a short month isn't a date: the permutation goes on from it, at most 3.4% of the time.
        def on(x: Column, _: Column) -> Column:
            return F.when(let(date(x), lambda d: d["day"] <= _days(d["year"], d["month"])), x).otherwise(turn(x))

        start = F.struct(
            (year - 1800).cast("long").alias("a"), ((month - at["month"]) * at["days"] + day - at["day"]).cast("long").alias("b")
        )
        return let(F.aggregate(F.sequence(F.lit(1), F.lit(24)), let(start, turn), on), date)

    return let(ranges, permuted)


def _date(value: Column, key: Column) -> Column:
    mark = F.substring(F.regexp_replace(value, "[0-9]", ""), 1, 1)

    def read(p: Column) -> Column:
        first, second = p[0].cast("int"), p[1].cast("int")
        day_first = F.when(mark == ".", second <= 12).otherwise(first > 12)

        def parts(*order: int) -> Column:
            return F.struct(*[p[i].alias(n) for i, n in zip(order, ("year", "month", "day"))], F.lit(order[2]).alias("at"))

        return F.when(F.length(p[0]) == 4, parts(0, 1, 2)).when(day_first, parts(2, 1, 0)).otherwise(parts(2, 0, 1))

    def replaced_in(old: Column) -> Column:
        year, month, day = (old[n].cast("int") for n in ("year", "month", "day"))
        valid = year.between(1800, 2199) & month.between(1, 12) & (day >= 1) & (day <= _days(year, month))

        def written(new: Column) -> Column:
            y, m, d = (F.lpad(new[n].cast("string"), F.length(old[n]), "0") for n in ("year", "month", "day"))
            return F.when(old["at"] == 2, F.concat(y, mark, m, mark, d)).when(
                old["at"] == 0, F.concat(d, mark, m, mark, y)
            ).otherwise(F.concat(m, mark, d, mark, y))

        return F.when(valid, let(_moved_date(year, month, day, key), written)).otherwise(value)

    return let(let(F.split(value, "[-./]"), read), replaced_in)


def _ipv4(value: Column, key: Column) -> Column:
    def moved(o: Column) -> Column:
        halves = _feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536), key, "ipv4")
        return let(
            halves,
            lambda x: F.concat_ws(
                ".", *[p.cast("string") for p in (F.floor(x["a"] / 256), x["a"] % 256, F.floor(x["b"] / 256), x["b"] % 256)]
            ),
        )

    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("long"))
    return let(octets, lambda o: F.when(F.array_max(o) <= 255, moved(o)).otherwise(value))


def _ssn(value: Column, key: Column) -> Column:
    area, group, serial = (F.substring(value, a, n).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    # 898 areas (001 to 899 without 666), groups 01 to 99, serials 0001 to 9999.
    index = F.when(area > 666, area - 2).otherwise(area - 1)
    halves = _feistel(index * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), key, "ssn")

    def written(x: Column) -> Column:
        at = F.floor(x["a"] / 99)
        new = F.when(at >= 665, at + 2).otherwise(at + 1)
        parts = ((new, 3), (x["a"] % 99 + 1, 2), (x["b"] + 1, 4))
        return F.concat_ws("-", *[F.lpad(p.cast("string"), n, "0") for p, n in parts])

    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    return F.when(valid, let(halves, written)).otherwise(value)


def _phone(value: Column, key: Column) -> Column:
    """The country code stays; the digits after it are permuted."""
    code = F.regexp_extract(value, r"^\+[0-9]{1,3}(?=[ .(-])", 0)
    code = F.when((code == "") & value.startswith("+"), F.substring(value, 1, 2)).otherwise(code)
    rest = F.substring(value, F.length(code) + 1, F.length(value))
    digits = _only_digits(rest)
    valid = F.length(_only_digits(value)).between(8, 15) & (F.length(digits) >= 4)
    return F.when(valid, F.concat(code, _refill(rest, _digits(digits, key, "phone")))).otherwise(value)


def _classed(value: Column, key: Column, kind: str) -> Column:
    """Letters and digits permuted inside their class; other characters stay."""

    def added(half: Column, other: Column, i: Column) -> Column:
        def moved(c: Column, at: Column) -> Column:
            pad = _drawn(key, F.lit(kind), i, at, F.array_join(other, ""))
            code = F.ascii(c).cast("long")

            def inside(first: str, size: int) -> Column:
                return F.char((code - ord(first) + pad % size) % size + ord(first))

            new = F.when(c.rlike("[0-9]"), inside("0", 10)).when(c.rlike("[a-z]"), inside("a", 26)).when(
                c.rlike("[A-Z]"), inside("A", 26)
            )
            for alphabet in ALPHABETS:
                place = F.instr(F.lit(alphabet), c)
                moved_to = ((place - 1 + pad % len(alphabet)) % len(alphabet) + 1).cast("int")
                new = new.when(place > 0, F.substring(F.lit(alphabet), moved_to, F.lit(1)))
            return new.otherwise(c)

        return F.transform(half, moved)

    def turn(halves: Column, i: Column) -> Column:
        a, b = halves["a"], halves["b"]
        return F.when(i % 2 == 0, F.struct(added(a, b, i).alias("a"), b.alias("b"))).otherwise(
            F.struct(a.alias("a"), added(b, a, i).alias("b"))
        )

    def permuted(chars: Column) -> Column:
        half = F.ceil(F.size(chars) / 2).cast("int")
        start = F.struct(F.slice(chars, 1, half).alias("a"), F.slice(chars, half + 1, F.size(chars)).alias("b"))
        done = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)
        return let(done, lambda x: F.array_join(F.concat(x["a"], x["b"]), ""))

    return let(F.array_remove(F.split(value, ""), ""), permuted)


def _email(value: Column, key: Column) -> Column:
    """All but the top-level domain, so that short local parts aren't guessed."""
    top = F.regexp_extract(value, r"\.[\p{L}\p{M}]+$", 0)
    return F.concat(_classed(F.substring(value, F.lit(1), F.length(value) - F.length(top)), key, "email"), top)


def _mod97(value: Column) -> Column:
    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(c.rlike("[0-9]"), (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.array_remove(F.split(value, ""), ""), F.lit(0), step)


def _iban(value: Column, key: Column) -> Column:
    def moved(whole: Column) -> Column:
        country, body = F.substring(whole, 1, 2), F.substring(whole, F.lit(5), F.length(whole))

        def closed(new: Column) -> Column:
            check = F.lpad((98 - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
            return _refill(value, F.concat(country, check, new), "[0-9A-Z]")

        valid = _mod97(F.concat(body, F.substring(whole, 1, 4))) == 1
        # Groups that are no IBAN may still hold a card number.
        return F.when(valid, let(_classed(body, key, "iban"), closed)).when(
            whole != value, _substituted(value, CARD, lambda card: _card(card, key))["text"]
        ).otherwise(value)

    return let(F.regexp_replace(value, "[^0-9A-Z]", ""), moved)


_KINDS: tuple[tuple[str, str, Callable[[Column, Column], Column]], ...] = (
    ("date", DATE, _date),
    ("email", EMAIL, _email),
    ("ipv4", IPV4, _ipv4),
    ("ssn", SSN, _ssn),
    ("phone", PHONE, _phone),
    ("card", CARD, _card),
    ("iban", f"{IBAN}|{IBAN_GROUPS}", _iban),
)


def pseudonym(value: Column, key: Column) -> Column:
    """The pseudonym of one candidate, or the candidate itself where it isn't valid."""
    chosen = F.when(F.lit(False), value)
    for _, pattern, permute in _KINDS:
        chosen = chosen.when(_is(value, pattern), permute(value, key))
    return chosen.otherwise(value)


def _substituted(text: Column, pattern: str, new: Callable[[Column], Column]) -> Column:
    """Struct of the text with each match replaced by ``new`` of it, and how many have changed."""

    def rebuilt(found: Column) -> Column:
        def joined(names: Column) -> Column:
            gaps = F.split(text, pattern, -1)
            return F.struct(
                F.array_join(F.flatten(F.transform(gaps, lambda gap, i: F.array_compact(F.array(gap, F.get(names, i))))), "").alias("text"),
                F.size(F.filter(F.arrays_zip(found.alias("a"), names.alias("b")), lambda x: x["a"] != x["b"])).cast("long").alias("n"),
            )

        return let(F.transform(found, new), joined)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), rebuilt)


def replaced(text: Column, key: Column) -> Column:
    """Struct of the new text and the number of values replaced."""
    unchanged = F.struct(text.alias("text"), F.lit(0).cast("long").alias("n"))
    return F.when(text.rlike("[0-9@]"), _substituted(text, ANY, lambda value: pseudonym(value, key))).otherwise(unchanged)


def _secret(docs: DataFrame, key: str) -> Column:
    """The key as a scalar subquery over a one-row relation, whose rows no plan or event log shows."""
    if not key:
        raise ValueError("pseudonyms need a key")
    return docs.sparkSession.sql("SELECT * FROM VALUES (:key) AS t(key)", args={"key": key}).scalar()


def replace(docs: DataFrame, key: str, text: str = "text", count: str | None = None) -> DataFrame:
    """The rows with pseudonyms in their texts; ``count`` names a column for the number of values."""
    old = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    # Apart from the input's columns, whose names may be anything.
    rows = docs.select(old.alias("old"), F.col(f"`{text}`").alias("text"), _secret(docs, key).alias("key"))
    rows = rows.select("old", replaced(F.col("text"), F.col("key")).alias("new"))
    kept = [
        F.col("new")["text"].alias(c) if c == text else F.col("old")[c].alias(c) for c in docs.columns if c != count
    ]
    return rows.select(*kept, *([F.col("new")["n"].alias(count)] if count else []))
