"""Personal data as format-preserving pseudonyms, in DataFrame functions only.

Values are found by one regular expression, validated (check sums, ranges, real dates), and replaced by a keyed
permutation of the values of their format: a Feistel network over mixed radixes. A value is written as digits with a
radix each (a decimal digit 10, a letter 26, an octet 256, a day of the 400-year calendar 189 x 773). Each round adds to
every second digit a keyed hash of the others, so the whole can be undone with the key, and equal values get equal
pseudonyms in every document. Check digits are computed anew, so a card number stays a valid card number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageglean.functions.bind import let

ROUNDS = 8
KEY = "change this key"
# Days of the calendar's 400-year cycle, as a product for two digits of a mixed radix.
_DAYS = (189, 773)
_FIRST_DAY = "1800-01-01"
_DATE_FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd", "dd.MM.yyyy", "MM/dd/yyyy", "dd/MM/yyyy")
_DIGITS, _LOWER, _UPPER, _LEADING = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "23456789"

_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]{1,63}+\.){1,126}[A-Za-z]{2,24}(?![A-Za-z0-9-])"
_SECRET = r"(?<![A-Za-z0-9])(?i:password|passwd|pwd|secret|token|api[_-]?key)[ ]?[=:][ ]?[\"']?[A-Za-z0-9_+/-]{12,}+"
_SECRET_NAME = r"^[^=:]*[=:][ ]?[\"']?"
_IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
_DATE = r"(?<![0-9A-Za-z/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9A-Za-z/-])"
_IP = r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z]|\.[0-9])"
_SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
_PHONE = r"(?<![0-9A-Za-z])(?:\+?[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ ]?|[0-9]{3}[.-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])"
_CARD = r"(?<![0-9A-Za-z])(?:[0-9][ -]?){12,18}[0-9](?![0-9A-Za-z])"
PATTERN = "|".join((_EMAIL, _SECRET, _IBAN, _DATE, _IP, _SSN, _PHONE, _CARD))
# Digits with blanks and hyphens of any length, in which card numbers are looked for.
_RUN = r"(?<![0-9A-Za-z])[0-9][0-9 -]{11,}[0-9](?![0-9A-Za-z])"
_RUNS = PATTERN.removesuffix(_CARD) + _RUN
# Stands at the ends of a value while it is looked for. Its middle character is doubled in the text meanwhile, so that no text
# holds the mark.
_MIDDLE = "\ufffe"
_END = f"\uffff{_MIDDLE}\uffff"
# What is replaced: of digits only card numbers with these marks, so that others hide no value behind them.
_MARKED = PATTERN.removesuffix(_CARD) + rf"(?<={_END})(?:[0-9][ -]?){{12,18}}[0-9](?={_END})"
_IBAN_LENGTHS = (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 "
    "GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 "
    "PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20")
KINDS = ("email", "secret", "iban", "date", "ip", "ssn", "phone", "card")


def feistel(values: Column, radixes: Column, key: str, kind: Column) -> Column:
    """Keyed permutation of digit lists: ``values[i]`` stays between 0 and ``radixes[i]`` - 1."""
    def one_round(v: Column, r: Column) -> Column:
        others = F.concat_ws(",", F.filter(v, lambda _, j: j % 2 != r % 2).cast("array<string>"))
        text = F.concat_ws("|", F.lit(key), kind, F.size(v), r, others)

        def added(t: Column) -> Column:
            return F.transform(v, lambda x, i: F.when(i % 2 != r % 2, x).otherwise(
                F.pmod(x + F.conv(F.substring(F.sha2(F.concat_ws("|", t, i), 256), 1, 12), 16, 10).cast("bigint"), F.get(radixes, i))))

        # Of a long list the digest is hashed, so that the work grows with the list and not with its square.
        return let(F.when(F.size(v) > 256, F.sha2(text, 256)).otherwise(text), added)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), values, one_round)


def permute_text(text: Column, key: str, kind: Column) -> Column:
    """Letters and digits of a text permuted among those of their class; all else stays.

    Of a telephone number, a digit from 2 to 9 that begins the area or the exchange stays one.
    """
    def special(c: Column, i: Column) -> Column:
        return (kind == "phone") & i.isin(0, 3) & F.contains(F.lit(_LEADING), c)

    def place(alphabet: str, c: Column) -> Column:
        return F.instr(F.lit(alphabet), c) - 1

    def value(c: Column, i: Column) -> Column:
        return F.when(special(c, i), place(_LEADING, c)).otherwise(
            F.greatest(place(_DIGITS, c), place(_LOWER, c), place(_UPPER, c), F.lit(0))).cast("bigint")

    def radix(c: Column, i: Column) -> Column:
        return F.when(special(c, i), 8).when(place(_DIGITS, c) >= 0, 10).when(
            (place(_LOWER, c) >= 0) | (place(_UPPER, c) >= 0), 26).otherwise(1).cast("bigint")

    def written(c: Column, i: Column, v: Column) -> Column:
        def at(alphabet: str) -> Column:
            return F.substr(F.lit(alphabet), (v + 1).cast("int"), F.lit(1))

        return F.when(special(c, i), at(_LEADING)).when(place(_DIGITS, c) >= 0, at(_DIGITS)).when(
            place(_LOWER, c) >= 0, at(_LOWER)).when(place(_UPPER, c) >= 0, at(_UPPER)).otherwise(c)

    def permuted(chars: Column) -> Column:
        found = feistel(F.transform(chars, value), F.transform(chars, radix), key, kind)
        return let(found, lambda n: F.array_join(F.transform(chars, lambda c, i: written(c, i, F.get(n, i))), ""))

    return let(F.split(text, ""), permuted)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _refilled(text: Column, pattern: str, fresh: Column) -> Column:
    """The text with its characters of a class replaced, in order, by those of ``fresh``."""
    def one(c: Column, i: Column) -> Column:
        nth = F.length(F.regexp_replace(F.substr(text, F.lit(1), i + 1), pattern, ""))
        return F.when(F.regexp_replace(c, pattern, "") == "", c).otherwise(F.substr(fresh, nth, F.lit(1)))

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _check_digit(body: Column) -> Column:
    """The digit that makes a card number valid."""
    doubled = F.transform(F.split(F.reverse(body), ""), lambda c, i: let(
        c.cast("int") * F.when(i % 2 == 0, 2).otherwise(1), lambda n: F.when(n > 9, n - 9).otherwise(n)))
    return F.pmod(-F.aggregate(doubled, F.lit(0), lambda a, x: a + x), F.lit(10)).cast("string")


def _mod97(text: Column) -> Column:
    """Rest by 97 of the number an IBAN's letters and digits stand for, check digits last."""
    turned = F.concat(F.substr(text, F.lit(5)), F.substr(text, F.lit(1), F.lit(4)))

    def step(rest: Column, c: Column) -> Column:
        letter = F.instr(F.lit(_UPPER), c)
        return F.when(letter > 0, (rest * 100 + letter + 9) % 97).otherwise((rest * 10 + c.cast("int")) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), step)


def _body(value: Column, kind: Column) -> Column:
    """The part of a valid value that is permuted; null for a value that is not valid."""
    digits, packed = _digits(value), F.replace(value, F.lit(" "), F.lit(""))
    return (
        F.when(kind == "email", F.regexp_replace(value, r"[.][A-Za-z]+\z", ""))
        .when(kind == "secret", F.regexp_replace(value, _SECRET_NAME, ""))
        .when(kind == "iban", F.when(_mod97(packed) == 1, F.substr(packed, F.lit(5))))
        .when(kind == "ssn", F.when(~F.rlike(value, F.lit("^(?:000|666|9)|-00-|-0000$")), value))
        .when(kind == "phone", F.substr(digits, F.length(digits) - 9))
        .when(kind == "card", F.when(F.call_function("luhn_check", digits), F.substr(digits, F.lit(1), F.length(digits) - 1)))
    )


def _assembled(value: Column, kind: Column, body: Column) -> Column:
    """The value around its permuted part: names, codes and separators as they were, check digits computed anew."""
    def iban(country: Column) -> Column:
        check = F.lpad((F.lit(98) - _mod97(F.concat(country, F.lit("00"), body))).cast("string"), 2, "0")
        return _refilled(value, "[ ]", F.concat(country, check, body))

    digits = _digits(value)
    numbers = F.when(kind == "phone", F.concat(F.substr(digits, F.lit(1), F.length(digits) - 10), body)).otherwise(
        F.concat(body, _check_digit(body)))
    return (
        F.when(kind == "email", F.concat(body, F.regexp_extract(value, r"[.][A-Za-z]+\z", 0)))
        .when(kind == "secret", F.concat(F.regexp_extract(value, _SECRET_NAME, 0), body))
        .when(kind == "iban", let(F.substr(value, F.lit(1), F.lit(2)), iban))
        .when(kind == "ssn", body)
        .otherwise(_refilled(value, "[^0-9]", numbers))
    )


def _date(text: Column, key: str) -> Column:
    first = F.lit(_FIRST_DAY).cast("date")

    def read(pattern: str) -> Column:
        return F.struct(F.datediff(F.try_to_timestamp(text, F.lit(pattern)).cast("date"), first).alias("n"), F.lit(pattern).alias("pattern"))

    def fresh(d: Column) -> Column:
        n = d["n"]
        pair = feistel(F.array(F.floor(n / _DAYS[1]).cast("bigint"), F.pmod(n, F.lit(_DAYS[1])).cast("bigint")),
                       F.array(*[F.lit(x).cast("bigint") for x in _DAYS]), key, F.lit("date"))
        day = let(pair, lambda p: F.date_add(first, (F.get(p, F.lit(0)) * _DAYS[1] + F.get(p, F.lit(1))).cast("int")))
        return let(day, lambda x: F.coalesce(*[F.when(d["pattern"] == p, F.date_format(x, p)) for p in _DATE_FORMATS]))

    # Of a date with slashes the month comes first where that gives a date.
    formats = F.array(*[read(p) for p in _DATE_FORMATS])
    real = F.filter(formats, lambda d: d["n"].between(0, _DAYS[0] * _DAYS[1] - 1))
    return let(F.get(real, F.lit(0)), lambda d: F.when(d.isNotNull(), fresh(d)))


def _ip(text: Column, key: str) -> Column:
    octets = F.transform(F.split(text, "[.]"), lambda o: o.cast("bigint"))

    def fresh(o: Column) -> Column:
        found = feistel(o, F.array_repeat(F.lit(256).cast("bigint"), 4), key, F.lit("ip"))
        return F.when(F.forall(o, lambda x: x <= 255), F.array_join(found.cast("array<string>"), "."))

    return let(octets, fresh)


def kind_of(value: Column) -> Column:
    """Which of the formats a found value has; the order is that of the pattern."""
    tests = zip(KINDS, (_EMAIL, _SECRET, _IBAN, _DATE, _IP, _SSN, _PHONE, _CARD))
    chain = F.when(F.lit(False), "")
    for kind, pattern in tests:
        chain = chain.when(F.rlike(value, F.lit(rf"\A(?:{pattern})\z")), kind)
    return chain


def pseudonym(value: Column, key: str = KEY) -> Column:
    """Pseudonym of a found value; the value itself if its check sum, range or date is not valid."""
    def of(kind: Column) -> Column:
        def written(body: Column) -> Column:
            return F.when(body.isNotNull(), let(permute_text(body, key, kind), lambda b: _assembled(value, kind, b)))

        fresh = F.when(kind == "date", _date(value, key)).when(kind == "ip", _ip(value, key)).otherwise(let(_body(value, kind), written))
        return F.coalesce(fresh, value)

    return let(kind_of(value), of)


def _iban_ends(value: Column) -> Column:
    """A found IBAN with a mark where it ends, if it does before the last blank: at its country's length, else as late as it is valid."""
    def ends(groups: Column) -> Column:
        def head(j: Column) -> Column:
            return F.array_join(F.slice(groups, F.lit(1), j), "")

        def wanted(j: Column) -> Column:
            return F.contains(F.lit(_IBAN_LENGTHS), F.concat(F.substr(value, F.lit(1), F.lit(2)), F.length(head(j)).cast("string")))

        valid = F.filter(F.sequence(F.lit(1), F.size(groups)), lambda j: F.length(head(j)).between(12, 34) & (_mod97(head(j)) == 1))
        best = let(valid, lambda v: F.coalesce(F.array_max(F.filter(v, wanted)), F.array_max(v)))
        rest = F.size(groups)
        return let(best, lambda j: F.when(j < rest, F.concat(
            F.array_join(F.slice(groups, F.lit(1), j), " "), F.lit(_END + " "), F.array_join(F.slice(groups, j + 1, rest), " "))).otherwise(value))

    return F.when(F.rlike(value, F.lit(rf"\A(?:{_IBAN})\z")), let(F.split(value, " "), ends)).otherwise(value)


def _card_ends(value: Column) -> Column:
    """A found run of digits with marks around its card numbers: leftmost first, then the longest that is valid.

    One that ends at a blank goes before one that ends at a hyphen, inside what may be another number.
    """
    between = F.regexp_extract_all(value, F.lit("[ -]"), F.lit(0))

    def cards(groups: Column) -> Column:
        def card(i: Column, j: Column) -> Column:
            part = F.slice(groups, i + 1, j - i + 1)
            digits = F.array_join(part, "")
            return F.length(digits).between(13, 19) & ~F.array_contains(part, "") & F.call_function("luhn_check", digits)

        def step(known: Column, i: Column) -> Column:
            valid = F.filter(F.sequence(i, F.least(i + 18, F.size(groups) - 1)), lambda j: card(i, j))
            best = let(valid, lambda v: F.coalesce(F.array_max(F.filter(v, lambda j: F.coalesce(F.get(between, j), F.lit(" ")) == " ")), F.array_max(v)))
            last = F.when(i >= known["free"], best)
            return let(last, lambda j: F.when(j.isNull(), known).otherwise(F.struct(
                (j + 1).alias("free"), F.concat(known["first"], F.array(i)).alias("first"), F.concat(known["last"], F.array(j)).alias("last"))))

        none = F.array().cast("array<int>")
        found = F.aggregate(F.sequence(F.lit(0), F.size(groups) - 1), F.struct(F.lit(0).alias("free"), none.alias("first"), none.alias("last")), step)

        def marked(f: Column) -> Column:
            def mark(places: Column, i: Column) -> Column:
                return F.when(F.array_contains(places, i), _END).otherwise("")

            parts = F.transform(groups, lambda g, i: F.concat(mark(f["first"], i), g, mark(f["last"], i)))
            return F.array_join(F.zip_with(parts, between, lambda g, b: F.concat(g, F.coalesce(b, F.lit("")))), "")

        return let(found, marked)

    return F.when(F.rlike(value, F.lit(rf"\A(?:{_RUN})\z")) & ~F.rlike(value, F.lit(rf"\A(?:{_DATE}|{_SSN}|{_PHONE})\z")),
                  let(F.split(value, "[ -]"), cards)).otherwise(value)


def _ends(text: Column, holds: str, pattern: str, ends) -> Column:
    """The text with marks where the values of a kind begin or end inside what its pattern finds."""
    def put(found: Column) -> Column:
        return F.array_join(F.zip_with(F.split(text, pattern, -1), F.transform(found, ends), lambda p, v: F.concat(p, F.coalesce(v, F.lit("")))), "")

    return F.when(F.rlike(text, F.lit(holds)), let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), put)).otherwise(text)


def pseudonymize(docs: DataFrame, text_col: str = "text", key: str = KEY, count_col: str | None = None) -> DataFrame:
    """The documents with pseudonyms in their whole texts, all other columns as they are.

    Null and empty texts stay so; repeated rows are treated alike; an empty table stays empty. ``count_col`` adds the
    number of values that were replaced. No row is shuffled.
    """
    text = F.col(f"`{text_col}`")
    others = [F.col(f"`{c}`") for c in docs.columns if c != count_col]
    # A blank or hyphen may be followed by what is no part of the value.
    marked = docs.select(F.struct(*others).alias("_row"), F.replace(text, F.lit(_MIDDLE), F.lit(_MIDDLE * 2)).alias("_text"))
    marked = marked.select("_row", _ends(F.col("_text"), _IBAN, PATTERN, _iban_ends).alias("_text"))
    marked = marked.select("_row", _ends(F.col("_text"), _RUN, _RUNS, _card_ends).alias("_text"))
    # A text without a digit and without an at sign or a sign of assignment holds none of the formats.
    found = F.when(F.rlike("_text", F.lit("[0-9@=:]")), F.regexp_extract_all("_text", F.lit(_MARKED), F.lit(0)))
    stepped = marked.select("_row", "_text", found.alias("_found"))
    fresh = stepped.select("_row", "_text", "_found", F.when(F.size("_found") > 0, F.transform("_found", lambda v: pseudonym(v, key))).alias("_fresh"))
    text = F.col(f"_row.`{text_col}`")
    pieces = F.zip_with(F.split("_text", _MARKED, -1), "_fresh", lambda p, v: F.concat(p, F.coalesce(v, F.lit(""))))
    whole = F.when(F.col("_fresh").isNull(), text).otherwise(F.replace(F.replace(F.array_join(pieces, ""), F.lit(_END), F.lit("")), F.lit(_MIDDLE * 2), F.lit(_MIDDLE)))
    changed = F.coalesce(F.size(F.filter(F.zip_with("_found", "_fresh", lambda a, b: a != b), lambda x: x)), F.lit(0))
    columns = [whole.alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c != count_col]
    return fresh.select(*columns, *([F.when(F.col("_fresh").isNull(), 0).otherwise(changed).cast("int").alias(count_col)] if count_col else []))
