"""Personal data replaced by format-preserving Feistel pseudonyms, in DataFrame functions only.

Payment card numbers (Luhn), account numbers (IBAN), telephone and social security numbers, IPv4 and IPv6 addresses,
calendar dates, e-mail addresses and hexadecimal secrets are found by one regular expression and validated. A value is then permuted
within its own format by a keyed Feistel network whose round function is SHA-256:

* digits stay digits and letters stay letters of their case, at their places, separators included;
* a card keeps its length and gets the check digit that makes it valid again;
* a date with slashes is dd/MM/yyyy if it can be, else MM/dd/yyyy, and stays what it is; day and month of one digit
  are read too, and a pseudonym of such a date has no leading zeros (so inverting may add them);
* an IBAN keeps its country and gets the check digits that make it valid again; an IPv6 address keeps its groups;
* an address stays four octets; a date stays a date of the same 400 Gregorian years (146,097 days = 189 * 773);
* of an e-mail address the local part is permuted (its letters a to z and digits), of a telephone number the ten
  national digits, or abroad what follows the country code, or what follows the first two of five pairs of digits.

The permutation depends on key, kind and value alone, so equal values have equal pseudonyms in all documents
(also when written with other separators), different values different ones, and who has the key can invert it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

ROUNDS = 8
#: First day and number of days of the dates that are permuted, and the two factors of that number.
FIRST_DAY, DAYS, DAY_FACTORS = "1800-01-01", 146_097, (189, 773)
#: Months of those years, and the days after the 12th of a month (all that only MM/dd/yyyy can mean) with their factors.
MONTHS, LATE_DAYS, LATE_FACTORS = 4_800, 88_497, (9, 9_833)

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_EMAIL = r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@(?:[A-Za-z0-9\-]++\.){1,126}[A-Za-z]{2,24}(?![A-Za-z0-9])"
_DATE = r"(?<![0-9./\-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![0-9]|[./\-][0-9])"
_ADDRESS = rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"
_PHONE = r"(?<![0-9A-Za-z+])(?:\+?[0-9]{1,3}[ .\-]?)?(?:\([0-9]{3}\)[ .\-]?|[0-9]{3}[ .\-])[0-9]{3}[ .\-][0-9]{4}(?![0-9])"
_SSN = r"(?<![0-9\-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9]|-[0-9])"
_CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ \-][0-9]{4}){2}[ \-][0-9]{1,4}|[0-9]{4}[ \-][0-9]{6}[ \-][0-9]{5})(?![0-9])"
_SECRET = r"(?<![A-Za-z0-9])(?=[0-9]{0,63}[A-Fa-f])(?=[A-Fa-f]{0,63}[0-9])[0-9A-Fa-f]{32,64}(?![A-Za-z0-9])"
_GROUP = "[0-9A-Fa-f]{1,4}"
_ADDRESS6 = rf"(?<![0-9A-Za-z:.])(?:(?:{_GROUP}:){{7}}{_GROUP}|(?:{_GROUP}:){{1,6}}(?::{_GROUP}){{1,6}})(?![0-9A-Za-z:])"
_IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
_ABROAD = r"(?<![0-9A-Za-z+])\+[1-9][0-9]{0,3}(?:[ .\-]?\([0-9]{1,4}\))?(?:[ .\-]?[0-9]{1,4}){2,6}(?![0-9])"
_PAIRS = r"(?<![0-9A-Za-z+.\-])0[1-9](?:[ .\-][0-9]{2}){4}(?![0-9]|[.\-][0-9])"
ANY = "|".join((_EMAIL, _ADDRESS, _ADDRESS6, _IBAN, _DATE, _PHONE, _ABROAD, _PAIRS, _SSN, _SECRET, _CARD))
#: Country codes of one and two digits; all others have three. Fixed values.
_COUNTRY = "^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"

KINDS = ("email", "address", "address6", "iban", "date", "phone", "ssn", "secret", "card")


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _chars(x: Column) -> Column:
    return F.when(F.length(x) > 0, F.transform(F.sequence(F.lit(1), F.length(x)), lambda i: F.substr(x, i, F.lit(1)))).otherwise(F.array().cast("array<string>"))


def _digest(key: str, kind: str, turn: Column, half: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{key}|{kind}|"), turn.cast("string"), F.lit("|"), half), 256)


def _number(digest: Column, at: Column, length: int) -> Column:
    return F.conv(F.substr(digest, at, F.lit(length)), 16, 10).cast("long")


_LOWER, _UPPER, _DIGIT, _HEX = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"


def _shift(char: Column, by: Column, alphabets: tuple[str, ...]) -> Column:
    """The character moved along its own alphabet; any other stays."""
    out = char
    for a in alphabets:
        place = F.position(char, F.lit(a))
        out = F.when(place > 0, F.substr(F.lit(a), (F.pmod(place - 1 + by, F.lit(len(a))) + 1).cast("int"), F.lit(1))).otherwise(out)
    return out


def feistel_text(value: Column, key: str, kind: str, alphabets: tuple[str, ...], sign: int = 1) -> Column:
    """A string permuted so that each character stays in its alphabet (``sign=-1``: inverted)."""

    def moved(x: Column, other: Column, turn: Column) -> Column:
        return let(_digest(key, kind, turn, other), lambda d: F.array_join(F.transform(_chars(x), lambda c, i: _shift(c, sign * _number(d, F.pmod(i, F.lit(31)) * 2 + 1, 4), alphabets)), ""))

    half = F.floor(F.length(value) / 2).cast("int")
    start = F.struct(F.substr(value, F.lit(1), half).alias("l"), F.substr(value, half + 1).alias("r"))
    if sign > 0:
        step = lambda s, k: F.struct(s["r"].alias("l"), moved(s["l"], s["r"], k).alias("r"))
        turns = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    else:
        step = lambda s, k: F.struct(moved(s["r"], s["l"], k).alias("l"), s["l"].alias("r"))
        turns = F.sequence(F.lit(ROUNDS - 1), F.lit(0))
    return F.aggregate(turns, start, step, lambda s: F.concat(s["l"], s["r"]))


def feistel_numbers(left: Column, right: Column, sizes: tuple[int, int], key: str, kind: str, sign: int = 1) -> Column:
    """Two numbers below ``sizes`` permuted together; a struct ``l, r``."""
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    f = lambda turn, x: _number(_digest(key, kind, turn, x.cast("string")), F.lit(1), 12)

    def step(s: Column, k: Column) -> Column:
        if sign > 0:
            return let(F.pmod(s["l"] + f(k * 2, s["r"]), F.lit(sizes[0]).cast("long")), lambda l: F.struct(l.alias("l"), F.pmod(s["r"] + f(k * 2 + 1, l), F.lit(sizes[1]).cast("long")).alias("r")))
        return let(F.pmod(s["r"] - f(k * 2 + 1, s["l"]), F.lit(sizes[1]).cast("long")), lambda r: F.struct(F.pmod(s["l"] - f(k * 2, r), F.lit(sizes[0]).cast("long")).alias("l"), r.alias("r")))

    last = ROUNDS // 2 - 1
    return F.aggregate(F.sequence(F.lit(0), F.lit(last)) if sign > 0 else F.sequence(F.lit(last), F.lit(0)), start, step)


def luhn_sum(digits: Column) -> Column:
    """Luhn's sum, from the right: every second digit is doubled and its digits added."""
    n = F.length(digits)

    def term(i: Column) -> Column:
        d = F.substr(digits, n - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda a, i: a + term(i))


def _refill(template: Column, digits: Column) -> Column:
    """The template with its digits replaced, in order, by others."""
    place = lambda i: F.length(_digits(F.substr(template, F.lit(1), i + 1)))
    return F.array_join(F.transform(_chars(template), lambda c, i: F.when(c.rlike("^[0-9]$"), F.substr(digits, place(i), F.lit(1))).otherwise(c)), "")


def _card(value: Column, key: str, sign: int) -> Column:
    def whole(payload: Column) -> Column:
        return F.concat(payload, F.pmod(F.lit(10) - luhn_sum(F.concat(payload, F.lit("0"))) % 10, F.lit(10)).cast("string"))

    return let(_digits(value), lambda d: let(feistel_text(F.substr(d, F.lit(1), F.length(d) - 1), key, "card", (_DIGIT,), sign), lambda p: _refill(value, whole(p))))


def _phone(value: Column, key: str, sign: int) -> Column:
    """Ten national digits, or what follows the country code or the area's first two digits."""

    def moved(d: Column, keep: Column, kind: str) -> Column:
        return F.concat(F.substr(d, F.lit(1), keep), feistel_text(F.substr(d, keep + 1), key, kind, (_DIGIT,), sign))

    def whole(d: Column) -> Column:
        ten = moved(d, F.length(d) - 10, "phone")
        abroad = moved(d, F.length(F.regexp_extract(d, _COUNTRY, 0)), "phone abroad")
        return F.when(value.rlike(f"^(?:{_PHONE})$"), ten).when(F.startswith(value, F.lit("+")), abroad).otherwise(moved(d, F.lit(2), "phone in pairs"))

    return let(_digits(value), lambda d: _refill(value, whole(d)))


def _mod97(text: Column) -> Column:
    """The remainder of an account number's letters and digits, read as a number (A is 10)."""

    def step(a: Column, c: Column) -> Column:
        n = F.ascii(c)
        return F.when(n < 65, (a * 10 + n - 48) % 97).otherwise((a * 100 + n - 55) % 97)

    return F.aggregate(_chars(text), F.lit(0), step)


def _plain(value: Column) -> Column:
    return F.replace(value, F.lit(" "), F.lit(""))


def _iban(value: Column, key: str, sign: int) -> Column:
    """The country stays, the account is permuted, the check digits are made anew."""

    def whole(v: Column) -> Column:
        country = F.substr(v, F.lit(1), F.lit(2))
        check = lambda b: F.lpad((98 - _mod97(F.concat(b, country, F.lit("00")))).cast("string"), 2, "0")
        return let(feistel_text(F.substr(v, F.lit(5)), key, "iban", (_UPPER, _DIGIT), sign), lambda b: F.concat(country, check(b), b))

    place = lambda i: F.length(_plain(F.substr(value, F.lit(1), i + 1)))
    grouped = lambda new: F.array_join(F.transform(_chars(value), lambda c, i: F.when(c == " ", c).otherwise(F.substr(new, place(i), F.lit(1)))), "")
    return let(let(_plain(value), whole), grouped)


def _ssn(value: Column, key: str, sign: int) -> Column:
    """Area 001-665 or 667-899, group 01-99, serial 0001-9999, permuted within these."""
    area, group, serial = (F.substr(value, F.lit(a), F.lit(n)).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    left = area - 1 - F.when(area > 666, 1).otherwise(0)
    right = (group - 1) * 9999 + serial - 1
    pad = lambda x, n: F.lpad(x.cast("string"), n, "0")
    area_of = lambda l: l + 1 + F.when(l + 1 >= 666, 1).otherwise(0)
    return let(feistel_numbers(left, right, (898, 99 * 9999), key, "ssn", sign), lambda s: F.concat_ws("-", pad(area_of(s["l"]), 3), pad(F.floor(s["r"] / 9999) + 1, 2), pad(s["r"] % 9999 + 1, 4)))


def _address(value: Column, key: str, sign: int) -> Column:
    def joined(o: Column) -> Column:
        part = lambda k: F.get(o, F.lit(k)).cast("long")
        moved = feistel_numbers(part(0) * 256 + part(1), part(2) * 256 + part(3), (65536, 65536), key, "address", sign)
        return let(moved, lambda s: F.concat_ws(".", *(x.cast("string") for x in (F.floor(s["l"] / 256), s["l"] % 256, F.floor(s["r"] / 256), s["r"] % 256))))

    return let(F.split(value, r"\."), joined)


def _date_formats(value: Column) -> list[tuple[Column, str]]:
    forms = (("^[0-9]{4}-", "yyyy-MM-dd"), ("^[0-9]{4}/", "yyyy/MM/dd"), ("^[0-9]{2}/[0-9]{2}/", "dd/MM/yyyy"), ("/", "d/M/yyyy"), (r"^[0-9]{2}\.[0-9]{2}\.", "dd.MM.yyyy"))
    return [(value.rlike(form), layout) for form, layout in forms] + [(F.lit(True), "d.M.yyyy")]


def _date(value: Column, key: str, sign: int) -> Column:
    """Null if it is no day of the calendar."""
    day = text = None
    for is_, layout in reversed(_date_formats(value)):
        parsed = F.try_to_timestamp(value, F.lit(layout)).cast("date")
        day = parsed if day is None else F.when(is_, parsed).otherwise(day)
    n = F.date_diff(day, F.lit(FIRST_DAY).cast("date"))

    def written(s: Column) -> Column:
        out = None
        new = F.date_add(F.lit(FIRST_DAY).cast("date"), (s["l"] * DAY_FACTORS[1] + s["r"]).cast("int"))
        for is_, layout in reversed(_date_formats(value)):
            t = F.date_format(new, layout)
            out = t if out is None else F.when(is_, t).otherwise(out)
        return out

    usual = let(n, lambda n: F.when((n >= 0) & (n < DAYS), let(feistel_numbers(F.floor(n / DAY_FACTORS[1]), n % DAY_FACTORS[1], DAY_FACTORS, key, "date", sign), written)))
    month_first = value.rlike("^[0-9]{1,2}/") & F.try_to_timestamp(value, F.lit("d/M/yyyy")).isNull()
    return F.when(month_first, _month_first(value, key, sign)).otherwise(usual)


def _month_first(value: Column, key: str, sign: int) -> Column:
    """A MM/dd/yyyy with a day over 12, permuted among these; null if it is no day of the calendar."""
    first = F.lit(FIRST_DAY).cast("date")
    # How many days after the 12th there are before a month.
    before = lambda m: F.date_diff(F.add_months(first, m), first) - m * 12

    def written(s: Column) -> Column:
        def day(r: Column) -> Column:
            near = (F.floor(r * MONTHS / LATE_DAYS) - 2).cast("int")
            month = let(near, lambda m: m - 1 + sum(((before(m + k) <= r).cast("int") for k in range(1, 5)), F.lit(1)))
            return let(month, lambda m: let(F.date_add(F.add_months(first, m), (r - before(m) + 12).cast("int")), lambda d: F.when(value.rlike("^[0-9]{2}/"), F.date_format(d, "MM/dd/yyyy")).otherwise(F.date_format(d, "M/d/yyyy"))))

        return let(s["l"] * LATE_FACTORS[1] + s["r"], day)

    def moved(d: Column) -> Column:
        m = (F.year(d) - int(FIRST_DAY[:4])) * 12 + F.month(d) - 1
        rank = let(m, lambda m: before(m) + F.dayofmonth(d) - 13)
        return let(rank, lambda n: let(feistel_numbers(F.floor(n / LATE_FACTORS[1]), n % LATE_FACTORS[1], LATE_FACTORS, key, "late date", sign), written))

    parsed = F.try_to_timestamp(value, F.lit("M/d/yyyy")).cast("date")
    return let(parsed, lambda d: F.when(d.isNotNull() & F.date_diff(d, first).between(0, DAYS - 1), moved(d)))


def kind_of(value: Column) -> Column:
    """The kind of a match, or null if it does not hold up to validation."""
    n = F.length(_digits(value))
    whole = lambda p: value.rlike(f"^(?:{p})$")
    card = whole(_CARD) & n.between(13, 19) & (luhn_sum(_digits(value)) % 10 == 0)
    plain = _plain(value)
    iban = whole(_IBAN) & F.length(plain).between(15, 34) & (_mod97(F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))) == 1)
    abroad = whole(_ABROAD) & n.between(8, 15)
    out = F.when(value.contains("@"), "email").when(whole(_ADDRESS), "address").when(whole(_ADDRESS6) & (~value.contains("::") | (F.size(F.split(value, ":+")) < 8)), "address6").when(iban, "iban").when(whole(_DATE) & _date(value, "", 1).isNotNull(), "date")
    return out.when(whole(_SSN), "ssn").when(whole(_SECRET), "secret").when(card, "card").when(whole(_PHONE) | abroad | whole(_PAIRS), "phone")


def pseudonym(value: Column, kind: Column, key: str, sign: int = 1) -> Column:
    """The pseudonym of a value of that kind (``sign=-1``: the value of a pseudonym); null kinds stay."""
    local = lambda: F.regexp_extract(value, "^([^@]*)(@.*)$", 1)
    out = F.when(kind == "email", F.concat(feistel_text(local(), key, "email", (_LOWER, _UPPER, _DIGIT), sign), F.regexp_extract(value, "^([^@]*)(@.*)$", 2)))
    for name, f in (("address", _address), ("date", _date), ("iban", _iban), ("phone", _phone), ("ssn", _ssn), ("card", _card)):
        out = out.when(kind == name, f(value, key, sign))
    lower, upper = ~value.rlike("[A-F]"), ~value.rlike("[a-f]")
    for name in ("secret", "address6"):
        moved = lambda *alphabets: feistel_text(value, key, name, alphabets, sign)  # noqa: B023, E731
        out = out.when((kind == name) & lower, moved(_HEX)).when((kind == name) & upper, moved(_HEX.upper())).when(kind == name, moved(_DIGIT, _HEX[10:], _HEX[10:].upper()))
    return out.otherwise(value)


def pseudonymise(df: DataFrame, key: str, text: str = "text", sign: int = 1) -> DataFrame:
    """``df`` with ``text`` replaced and ``pii`` added: an array of (kind, value, pseudonym) in order.

    Null stays null, with no values; a text without values is unchanged; numbers that fail validation stay as they
    are. Repeated rows are treated each. A column of ``df`` named ``pii`` is replaced. ``sign=-1`` inverts.
    """
    some = F.col(text).rlike("[0-9@]")
    matches = F.when(some, F.regexp_extract_all(F.col(text), F.lit(ANY), 0)).otherwise(F.array().cast("array<string>"))
    kinds = F.transform("__found", lambda v: F.struct(kind_of(v).alias("kind"), v.alias("value")))
    values = F.transform("__kinds", lambda v: F.struct(v["kind"].alias("kind"), v["value"].alias("value"), pseudonym(v["value"], v["kind"], key, sign).alias("pseudonym")))
    out = df.drop("pii").withColumn("__found", matches).withColumn("__kinds", F.when(F.size("__found") > 0, kinds).otherwise(F.array()))
    out = out.withColumn("__values", F.when(F.size("__kinds") > 0, values).otherwise(F.array()))
    pieces = lambda p: F.concat(F.get(p, F.lit(0)), F.array_join(F.zip_with(F.slice(p, 2, F.size("__values")), F.col("__values"), lambda gap, v: F.concat(v["pseudonym"], gap)), ""))
    out = out.withColumn(text, F.when(F.size("__values") > 0, let(F.split(F.col(text), ANY, -1), pieces)).otherwise(F.col(text)))
    return out.withColumn("pii", F.filter("__values", lambda v: v["kind"].isNotNull())).drop("__found", "__kinds", "__values")
