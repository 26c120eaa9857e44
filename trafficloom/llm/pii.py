"""Pseudonyms for personal data by format-preserving Feistel networks.

Numbers and dates are found by one pattern, validated, and permuted among the valid values of their
format under a key: a payment card stays a valid card number, a bank account one of its country with
right check digits, a social security number an issuable one, a date a date of its century; a
telephone number keeps its country code. What separates digits stays in the text and does not
count: equal values have equal pseudonyms in all documents however they are written, different ones
different ones. Only column expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "iban", "card", "ip", "ssn", "phone", "date")
#: A value starts where none of these stands before it.
EMAIL = r"(?<![\p{L}0-9._%+\-])[\p{L}0-9._%+\-]++@[A-Za-z0-9.\-]*[A-Za-z0-9]\.[A-Za-z]{2,}"
#: Blocks of four, after the first ones of digits; or in one piece.
IBAN = r"(?<![\w])[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}| [A-Z0-9]{4}(?: \d{4}){1,6}(?: \d{1,3})?)(?![\w])"
#: Sixteen digits, or an issuer's first digits and its other lengths.
CARD = (
    r"(?<![\w.])(?:(?:\d{4}[ -]?){3}\d{4}|4\d{12}(?:\d{6})?|3[47]\d{2}[ -]?\d{6}[ -]?\d{5}"
    r"|3(?:0[0-5]|[68]\d)\d[ -]?\d{6}[ -]?\d{4}|(?:6\d|35)\d{15,17}|(?:6\d|35|4\d)\d{2}(?:[ -]\d{4}){3}[ -]\d{3})(?![\w])"
)
IP = r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d)"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
PHONE = r"(?<![\w+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}(?![\w])|(?<![\w(])\(\d{3}\) ?\d{3}[-. ]\d{4}(?![\w])"
DATE = r"(?<![\w.-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4})(?![\w-]|\.\d)"
PATTERN = "|".join((EMAIL, IBAN, CARD, IP, SSN, PHONE, DATE))
ROUNDS = 8
#: The telephone country codes of one and two digits; all others have three.
COUNTRY_CODE = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"


def _number(text: Column) -> Column:
    """A 60-bit number from a hash in hexadecimal."""
    return F.conv(F.substring(text, 1, 15), 16, 10).cast("long")


def feistel(value: Column, left: Column, right: Column, key: str, tweak: Column) -> Column:
    """Keyed permutation of 0 … left * right - 1: the value is split into a part modulo each, and
    every round adds to one part, modulo its size, a keyed hash of the other."""
    start = F.struct(F.floor(value / right).cast("long").alias("l"), F.pmod(value, right).alias("r"))

    def turn(state: Column, i: Column) -> Column:
        even = i % 2 == 0
        other = F.when(even, state["r"]).otherwise(state["l"])
        drawn = _number(F.sha2(F.concat_ws(":", F.lit(key), tweak, i.cast("string"), other.cast("string")), 256))
        return F.struct(
            F.when(even, F.pmod(state["l"] + drawn, left)).otherwise(state["l"]).alias("l"),
            F.when(even, state["r"]).otherwise(F.pmod(state["r"] + drawn, right)).alias("r"),
        )

    rounds = F.array(*(F.lit(i) for i in range(ROUNDS)))
    return F.aggregate(rounds, start, turn, lambda s: s["l"] * right + s["r"])


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "")


def permute_digits(digits: Column, key: str, tweak: Column) -> Column:
    """A run of 1 to 18 digits mapped to another of the same length."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    power = F.array(*(F.lit(10**i).cast("long") for i in range(19)))
    left, right = F.get(power, n - half), F.get(power, half)
    value = feistel(digits.cast("long"), left, right, key, F.concat(tweak, n.cast("string")))
    return F.lpad(value.cast("string"), n, "0")


def put_digits(text: Column, digits: Column, replaced: str = "[0-9]") -> Column:
    """The text with its digits replaced one by one; everything else stays."""
    characters = F.split(text, "")
    # The digits travel in the state: named in the step, they would be worked out for every character.
    state = F.struct(F.lit("").alias("s"), F.lit(1).alias("i"), digits.alias("d"))

    def step(s: Column, c: Column) -> Column:
        is_digit = c.rlike(replaced)
        return F.struct(
            F.concat(s["s"], F.when(is_digit, F.substr(s["d"], s["i"], F.lit(1))).otherwise(c)).alias("s"),
            (s["i"] + is_digit.cast("int")).alias("i"),
            s["d"].alias("d"),
        )

    return F.aggregate(characters, state, step, lambda s: s["s"])


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a number whose last digit is the check digit."""

    def weigh(c: Column, i: Column) -> Column:
        d = c.cast("int")
        double = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 1, double).otherwise(d)

    figures = F.transform(F.split(F.reverse(digits), ""), weigh)
    return F.aggregate(figures, F.lit(0), lambda a, x: a + x)


def _card(text: Column, key: str) -> Column:
    """A valid number of the same length; of other lengths than sixteen the first three digits, which
    say who issued it, stay."""
    digits = digits_of(text)
    n = F.length(digits)
    kept = F.when(n == 16, F.lit("")).otherwise(F.substring(digits, 1, 3))
    inner = F.substr(digits, F.length(kept) + 1, n - 1 - F.length(kept))
    body = F.concat(kept, permute_digits(inner, key, F.concat(F.lit("card"), kept)))
    check = F.pmod(10 - F.pmod(luhn_sum(F.concat(body, F.lit("0"))), F.lit(10)), F.lit(10))
    return put_digits(text, F.concat(body, check.cast("string")))


def mod97(text: Column) -> Column:
    """Remainder of a number whose letters stand for 10 to 35."""

    def add(a: Column, c: Column) -> Column:
        letter = c >= "A"
        value = F.when(letter, F.ascii(c) - 55).otherwise(c.cast("int"))
        return F.pmod(F.when(letter, a * 100).otherwise(a * 10) + value, F.lit(97))

    return F.aggregate(F.split(text, ""), F.lit(0), add)


def iban_rest(text: Column) -> Column:
    """The remainder that is 1 for a valid account: country and check digits count last."""
    compact = F.replace(text, F.lit(" "), F.lit(""))
    return mod97(F.concat(F.substr(compact, F.lit(5)), F.substring(compact, 1, 4)))


def _iban(text: Column, key: str) -> Column:
    """Country and letters stay. The account has up to 30 digits: each half is permuted under the
    other one, the second under what the first became."""
    compact = F.replace(text, F.lit(" "), F.lit(""))
    country, account = F.substring(compact, 1, 2), F.substr(compact, F.lit(5))
    digits = digits_of(account)
    half = F.floor(F.length(digits) / 2).cast("int")
    first, second = F.substr(digits, F.lit(1), half), F.substr(digits, half + 1)
    frame = F.concat(F.lit("iban"), country, F.regexp_replace(account, "[0-9]", "."))
    made = F.transform(
        F.array(F.when(half > 0, permute_digits(first, key, F.concat(frame, second))).otherwise("")),
        lambda f: F.concat(f, permute_digits(second, key, F.concat(frame, f))),
    )[0]

    def written(renewed: Column) -> Column:
        check = 98 - mod97(F.concat(renewed, country, F.lit("00")))
        return put_digits(text, F.concat(country, F.lpad(check.cast("string"), 2, "0"), renewed), "[A-Z0-9]")

    return F.transform(F.array(put_digits(account, made)), written)[0]


def _ssn(text: Column, key: str) -> Column:
    """Another issuable number: areas 001 to 899 without 666, groups and serials from 1."""
    area, group, serial = (F.substring(text, at, n).cast("long") for at, n in ((1, 3), (5, 2), (8, 4)))
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    rank = (place * 99 + group - 1) * 9999 + serial - 1
    made = feistel(rank, F.lit(898 * 99).cast("long"), F.lit(9999).cast("long"), key, F.lit("ssn"))

    def written(made: Column) -> Column:
        upper = F.floor(made / 9999)
        place = F.floor(upper / 99)
        area = F.when(place >= 665, place + 2).otherwise(place + 1)
        parts = ((area, 3), (F.pmod(upper, F.lit(99)) + 1, 2), (F.pmod(made, F.lit(9999)) + 1, 4))
        return F.concat_ws("-", *(F.lpad(p.cast("string"), n, "0") for p, n in parts))

    return F.transform(F.array(made), written)[0]


def _ip(text: Column, key: str) -> Column:
    parts = F.transform(F.split(text, r"\."), lambda c: c.cast("long"))
    value = F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a * 256 + x)
    made = feistel(value, F.lit(1 << 16).cast("long"), F.lit(1 << 16).cast("long"), key, F.lit("ip"))
    shifts = F.array(F.lit(1 << 24), F.lit(1 << 16), F.lit(1 << 8), F.lit(1))
    octets = F.transform(shifts, lambda s: F.pmod(F.floor(made / s), F.lit(256)).cast("string"))
    return F.array_join(octets, ".")


def _phone(text: Column, key: str) -> Column:
    """The country code stays; the rest is permuted. A number that starts with its area code in
    brackets is of country 1."""
    code = F.regexp_extract(text, COUNTRY_CODE, 0)
    rest = F.substr(text, F.length(code) + 1)
    country = F.when(code == "", F.lit("+1")).otherwise(code)
    return F.concat(code, put_digits(rest, permute_digits(digits_of(rest), key, F.concat(F.lit("phone"), country))))


def _email(text: Column, key: str) -> Column:
    """The name before @ has no number to permute: a keyed hash takes its place."""
    hashed = F.sha2(F.concat_ws(":", F.lit(key), F.lit("email"), F.lower(text)), 256)
    return F.concat(F.lit("user-"), F.substring(hashed, 1, 16), F.lit("@"), F.substring_index(text, "@", -1))


def _parsed(text: Column) -> Column:
    iso = F.regexp_extract(text, r"^(\d{4})-(\d{2})-(\d{2})$", 0) != ""
    y, m, d = (F.regexp_extract(text, r"(\d+)\D(\d+)\D(\d+)", i) for i in (1, 2, 3))
    german = F.instr(text, ".") > 0
    us = F.concat_ws("-", d, F.lpad(y, 2, "0"), F.lpad(m, 2, "0"))
    own = F.concat_ws("-", d, F.lpad(m, 2, "0"), F.lpad(y, 2, "0"))
    return F.when(iso, text).when(german, own).otherwise(us).try_cast("date")


#: Days of the centuries as products: 1900-1999 and 2000-2099.
_CENTURIES = (("1900-01-01", 92, 397), ("2000-01-01", 75, 487))


def _date(text: Column, key: str) -> Column:
    """Another day of the same century in the same notation."""
    day = _parsed(text)
    late = F.year(day) >= 2000

    def choose(i: int) -> Column:
        return F.when(late, F.lit(_CENTURIES[1][i]).cast("long")).otherwise(F.lit(_CENTURIES[0][i]).cast("long"))

    first = F.when(late, F.lit("2000-01-01")).otherwise(F.lit("1900-01-01")).cast("date")
    tweak = F.when(late, F.lit("date20")).otherwise(F.lit("date19"))
    made = feistel(F.datediff(day, first).cast("long"), choose(1), choose(2), key, tweak)
    moved = F.date_add(first, made.cast("int"))
    # Digits are put in one by one; day and month of one digit take the room of two.
    return (
        F.when(F.instr(text, ".") > 0, F.date_format(moved, "dd.MM.yyyy"))
        .when(F.instr(text, "/") > 0, F.date_format(moved, "MM/dd/yyyy"))
        .otherwise(F.date_format(moved, "yyyy-MM-dd"))
    )


def kind_of(text: Column) -> Column:
    """The kind of a match, null if it is not valid as one."""
    digits = digits_of(text)
    octets = F.transform(F.split(text, r"\."), lambda c: c.try_cast("int"))
    is_ip = text.rlike(r"^(?:\d{1,3}\.){3}\d{1,3}$")
    is_ssn = text.rlike(r"^\d{3}-\d{2}-\d{4}$")
    is_card = text.rlike(f"^(?:{CARD})$")
    is_date = text.rlike(r"^(?:\d{4}-\d{2}-\d{2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4})$")
    return (
        F.when(F.instr(text, "@") > 0, "email")
        .when(text.rlike("^[A-Z]"), F.when(iban_rest(text) == 1, "iban"))
        .when(is_card, F.when(F.pmod(luhn_sum(digits), F.lit(10)) == 0, "card"))
        .when(is_ip, F.when(F.forall(octets, lambda o: o.isNotNull() & (o <= 255)), "ip"))
        .when(is_ssn, F.when(~text.rlike(r"^(?:000|666|9)|-00-|-0000$"), "ssn"))
        .when(is_date, F.when(F.year(_parsed(text)).between(1900, 2099), "date"))
        .when(F.length(digits).between(8, 15), "phone")
    )


def pseudonym(match: Column, kind: Column, key: str) -> Column:
    return (
        F.when(kind == "email", _email(match, key))
        .when(kind == "iban", _iban(match, key))
        .when(kind == "card", _card(match, key))
        .when(kind == "ip", _ip(match, key))
        .when(kind == "ssn", _ssn(match, key))
        .when(kind == "phone", _phone(match, key))
        .when(kind == "date", _date(match, key))
        .otherwise(match)
    )


def pseudonymise(
    docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, text with every valid value replaced by its pseudonym, and found: an array
    of struct (kind, value, pseudonym) in the order of the text.

    Null texts stay null and have found nothing, as have empty ones. Invalid numbers and dates
    (a card or account whose check digits fail, an octet above 255, a 31st of April) stay as they are.
    Rows are treated one by one: repeated and null ids stay; an empty table gives no rows; other
    columns are not read.
    """
    text = F.col("text")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    some = text.rlike("[0-9@]")  # each kind has one of these
    found = F.when(some, F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("matches", found)
    named = F.transform("matches", lambda m: F.struct(m.alias("value"), kind_of(m).alias("kind")))
    rows = rows.withColumn("found", named)
    changed = F.transform(
        "found",
        lambda f: F.struct(
            f["kind"].alias("kind"),
            f["value"].alias("value"),
            pseudonym(f["value"], f["kind"], key).alias("pseudonym"),
        ),
    )
    rows = rows.withColumn("found", changed)
    between = F.split("text", PATTERN, -1)
    pieces = F.zip_with(
        between, "found", lambda gap, f: F.concat(gap, F.coalesce(f["pseudonym"], F.lit("")))
    )
    text = F.when(F.size("matches") > 0, F.array_join(pieces, "")).otherwise(F.col("text"))
    valid = F.filter("found", lambda f: f["kind"].isNotNull())
    return rows.select("doc_id", text.alias("text"), valid.alias("found"))
