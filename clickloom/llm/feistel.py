"""Format-preserving pseudonyms for personal numbers and dates, in Spark expressions alone.

A value is found by its form and validated (check digits, calendar, ranges), turned into a list of
components with their radices (digits, octets, letters, a date's day number in two parts), permuted by a
keyed Feistel network over that list and written back in the form it had: separators, padding and letter
case stay, check digits are computed anew. Each round adds a keyed hash of one half, modulo each
component's radix, to the other half, so a network is a permutation of the kind's valid values: equal
values get equal pseudonyms in all documents and forms, different ones different pseudonyms.

Kinds: e-mail addresses (the local part; the domain is kept), IBANs, payment cards (first digit kept),
US social security numbers, North American and international phone numbers (country code kept), IPv4
addresses, and dates from 1900 to 2099 as 1999-12-31 (also before a time: 1999-12-31T10:00), 31.12.1999 and
12/31/1999. What is not valid is left as it is, as is all other text.

Null text stays null, empty text empty; texts without any value are returned unchanged. Rows are
independent, nothing is shuffled, and all other columns are passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import fresh_name, let

ROUNDS = 8
#: 1900-01-01 to 2099-12-31: days, and the two factors they are split into. Fixed values.
FIRST_DAY, DAY_RADICES = "1900-01-01", (17, 4297)

#: Characters of an IBAN by country, the whole registry. Fixed values.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HN": 28, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28,
    "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24,
    "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26,
    "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}

#: Assigned country codes of one and two digits; all others have three. Fixed values.
SHORT_CODES = ("[17]", "2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]")
#: Where a zero before the area code is part of the number.
ZERO_KEPT = "39|378|379"


def _iban_form() -> str:
    """Compact or with blanks; the country tells where it ends."""
    by_length: dict[int, list[str]] = {}
    for country, length in IBAN_LENGTHS.items():
        by_length.setdefault(length, []).append(country)
    return "|".join(f"(?:{'|'.join(names)})[0-9]{{2}}(?: ?[A-Z0-9]){{{length - 4}}}" for length, names in sorted(by_length.items()))


# Forms, as Java regular expressions. Repeats are bounded or possessive.
# A dot before a value may end a sentence or an abbreviation, but no number.
_START, _END = r"(?<![\p{L}\p{N}_@+-])(?<!\p{N}\.)", r"(?![\p{L}\p{N}_@]|[.-]\p{N})"
_DATE_END = rf"(?:{_END}|(?=[Tt][0-9]{{2}}|[Zz](?![\p{{L}}\p{{N}}_])))"
FORMS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}",
    "iban": _iban_form(),
    "nanp": r"(?:\+?1[ .-]?)?\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|\+1[ .-]?[0-9]{3}[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
    r"|(?:1[ .-])?[2-9][0-9]{2}[ .-][2-9][0-9]{2}[ .-][0-9]{4}",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "iso": r"(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}",
    "dotted": r"[0-9]{1,2}\.[0-9]{1,2}\.(?:19|20)[0-9]{2}",
    "slashed": r"[0-9]{1,2}/[0-9]{1,2}/(?:19|20)[0-9]{2}",
    "ipv4": r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}",
    "intl": r"\+[1-9][0-9]{0,2}(?:[ ./-]?[0-9]){6,12}|\+[1-9][0-9]{0,2} ?\([0-9]{1,5}\)(?:[ ./-]?[0-9]){4,12}",
    "card": r"[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}",
}
ANY = "|".join(f"{_START}{'(?:' + form + ')'}{_DATE_END if name == 'iso' else _END}" for name, form in FORMS.items())


def permute(values: Column, radices: Column, key: str, tweak: Column, rounds: int = ROUNDS) -> Column:
    """The list of components permuted: each stays below its radix."""

    def network(values: Column, radices: Column) -> Column:
        size = F.size(values)
        half = F.ceil(size / 2).cast("int")
        first = F.struct(
            F.slice(values, F.lit(1), half).alias("l"), F.slice(values, half + 1, F.greatest(size - half, F.lit(0))).alias("r")
        )

        def mixed(side: Column, by: Column, step: Column, skip: Column) -> Column:
            def one(value: Column, i: Column) -> Column:
                text = F.concat_ws("|", F.lit(key), tweak, size.cast("string"), step.cast("string"), i.cast("string"), F.array_join(by.cast("array<string>"), ","))
                number = F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("bigint")
                return F.pmod(value + number, F.get(radices, i + skip))

            return F.transform(side, one)

        def step(acc: Column, k: Column) -> Column:
            return F.when(
                k % 2 == 0, F.struct(mixed(acc["l"], acc["r"], k, F.lit(0)).alias("l"), acc["r"].alias("r"))
            ).otherwise(F.struct(acc["l"].alias("l"), mixed(acc["r"], acc["l"], k, half).alias("r")))

        return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), first, step, lambda acc: F.concat(acc["l"], acc["r"]))

    return let(F.struct(values.alias("v"), radices.alias("m")), lambda x: network(x["v"], x["m"]))


def _chars(text: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substring(text, i, F.lit(1)))


def _digits(text: Column) -> Column:
    """Digits of a text, as numbers."""
    return F.transform(_chars(F.regexp_replace(text, "[^0-9]", "")), lambda c: c.cast("bigint"))


def _refill(text: Column, digits: Column) -> Column:
    """The text with its digits replaced one by one."""

    def filled(x: Column) -> Column:
        start = F.struct(F.lit("").alias("out"), F.lit(0).alias("i"))

        def step(acc: Column, c: Column) -> Column:
            digit = c.between("0", "9")
            return F.struct(
                F.concat(acc["out"], F.when(digit, F.get(x["d"], acc["i"]).cast("string")).otherwise(c)).alias("out"),
                (acc["i"] + digit.cast("int")).alias("i"),
            )

        return F.aggregate(_chars(x["t"]), start, step, lambda acc: acc["out"])

    return let(F.struct(text.alias("t"), digits.alias("d")), filled)


def _repeat(value: int, size: Column) -> Column:
    return F.array_repeat(F.lit(value).cast("bigint"), size)


def _luhn_sum(payload: Column) -> Column:
    """Sum over a number without its check digit, doubling from the last digit on."""
    doubled = F.transform(
        F.reverse(payload),
        lambda d, i: F.when(i % 2 == 0, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d),
    )
    return F.aggregate(doubled, F.lit(0).cast("bigint"), lambda acc, d: acc + d)


def _card(text: Column, key: str) -> Column:
    def written(digits: Column) -> Column:
        size = F.size(digits)
        payload = F.slice(digits, F.lit(1), size - 1)
        valid = (F.pmod(_luhn_sum(payload) + F.get(digits, size - 1), F.lit(10)) == 0) & (F.get(digits, F.lit(0)) > 0)
        tweak = F.concat(F.lit("card"), F.get(digits, F.lit(0)).cast("string"))
        inner = permute(F.slice(digits, F.lit(2), size - 2), _repeat(10, size - 2), key, tweak)
        return F.when(valid, let(F.concat(F.slice(digits, F.lit(1), F.lit(1)), inner), checked))

    def checked(payload: Column) -> Column:
        return F.concat(payload, F.array(F.pmod(-_luhn_sum(payload), F.lit(10)).cast("bigint")))

    return let(_digits(text), lambda digits: let(written(digits), lambda new: F.when(new.isNotNull(), _refill(text, new))))


def _nanp(text: Column, key: str) -> Column:
    """Ten digits. Area and exchange start with 2 to 9; where one is written with 0 or 1, it keeps to these."""

    def written(digits: Column) -> Column:
        own = F.slice(digits, F.size(digits) - 9, F.lit(10))
        leads = [F.get(own, F.lit(i)) > 1 for i in (0, 3)]
        low = [F.when(leads[i // 3], 2).otherwise(0) if i in (0, 3) else F.lit(0) for i in range(10)]
        radix = [F.when(leads[i // 3], 8).otherwise(2) if i in (0, 3) else F.lit(10) for i in range(10)]
        low, radix = (F.array(*[x.cast("bigint") for x in xs]) for xs in (low, radix))
        tweak = F.concat_ws("/", F.lit("nanp"), *[x.cast("string") for x in leads])
        new = F.zip_with(permute(F.zip_with(own, low, lambda a, b: a - b), radix, key, tweak), low, lambda a, b: a + b)
        return _refill(text, F.concat(F.slice(digits, F.lit(1), F.size(digits) - 10), new))

    return let(_digits(text), written)


def _intl(text: Column, key: str) -> Column:
    """The country code is the assigned one, whatever the separators. A zero in brackets, as in +44 (0)20, takes no part."""

    def written(own: Column) -> Column:
        digits = _digits(own)
        bare = F.regexp_replace(own, "[^0-9]", "")
        code = F.when(bare.rlike(f"^(?:{SHORT_CODES[0]})"), 1).when(bare.rlike(f"^(?:{SHORT_CODES[1]})"), 2).otherwise(3)

        def moved(x: Column) -> Column:
            digits, code = x["d"], x["c"]
            size = F.size(digits) - code
            lead = F.slice(digits, F.lit(1), code)
            tweak = F.concat(F.lit("phone"), F.array_join(lead.cast("array<string>"), ""))
            return F.concat(lead, permute(F.slice(digits, code + 1, size), _repeat(10, size), key, tweak))

        new = F.translate(_refill(own, let(F.struct(digits.alias("d"), code.alias("c")), moved)), "~", "0")
        american = (F.length(bare) == 11) & bare.startswith("1")
        return F.when(american, _nanp(own, key)).when(F.length(bare).between(7, 15), new)

    return let(F.when(text.rlike(rf"^\+(?:{ZERO_KEPT}) ?\("), text).otherwise(F.regexp_replace(text, r"\(0", "(~")), written)


def _ssn(text: Column, key: str) -> Column:
    """Areas 001 to 899 without 666, groups from 01, serials from 0001."""
    area, group, serial = (F.split(text, "-")[i].cast("bigint") for i in range(3))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    index = F.when(area > 666, area - 2).otherwise(area - 1)
    radices = F.array(*[F.lit(x).cast("bigint") for x in (898, 99, 9999)])
    new = permute(F.array(index, group - 1, serial - 1), radices, key, F.lit("ssn"))

    def shown(x: Column) -> Column:
        first = F.get(x, F.lit(0))
        first = F.when(first > 664, first + 2).otherwise(first + 1)
        parts = [(first, 3), (F.get(x, F.lit(1)) + 1, 2), (F.get(x, F.lit(2)) + 1, 4)]
        return F.concat_ws("-", *[F.lpad(n.cast("string"), width, "0") for n, width in parts])

    return F.when(valid, let(new, shown))


def _ipv4(text: Column, key: str) -> Column:
    octets = F.transform(F.split(text, r"\."), lambda x: x.cast("bigint"))
    valid = F.forall(octets, lambda x: x <= 255) & ~text.rlike(r"(?:^|\.)0[0-9]")
    return F.when(valid, F.array_join(permute(octets, _repeat(256, F.lit(4)), key, F.lit("ipv4")).cast("array<string>"), "."))


def _date(date: Column, shown, key: str) -> Column:
    """``shown`` writes the permuted date; null if the date is not valid."""
    wide = DAY_RADICES[1]

    def moved(day: Column) -> Column:
        parts = F.array(F.floor(day / wide).cast("bigint"), F.pmod(day, F.lit(wide)).cast("bigint"))
        radices = F.array(*[F.lit(x).cast("bigint") for x in DAY_RADICES])
        new = permute(parts, radices, key, F.lit("date"))
        return let(new, lambda x: shown(F.date_add(F.lit(FIRST_DAY).cast("date"), (F.get(x, F.lit(0)) * wide + F.get(x, F.lit(1))).cast("int"))))

    return F.when(date.isNotNull(), let(F.datediff(date, F.lit(FIRST_DAY).cast("date")), moved))


def _parted_date(text: Column, mark: str, day: int, month: int, key: str) -> Column:
    parts = F.split(text, "[./]")
    date = F.concat_ws("-", parts[2], F.lpad(parts[month], 2, "0"), F.lpad(parts[day], 2, "0")).try_cast("date")
    order = ["dd", "MM"] if day < month else ["MM", "dd"]
    padded = mark.join([*order, "yyyy"])
    bare = mark.join([order[0][0], order[1][0], "yyyy"])
    full = (F.length(parts[0]) == 2) & (F.length(parts[1]) == 2)
    return _date(date, lambda d: F.when(full, F.date_format(d, padded)).otherwise(F.date_format(d, bare)), key)


def _mod97(text: Column) -> Column:
    """Remainder of the number that letters (A is 10) and digits spell."""

    def step(acc: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), (acc * 10 + c.cast("bigint")) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(_chars(text), F.lit(0).cast("bigint"), step)


def _letters_and_digits(text: Column, key: str, tweak: Column, first: str) -> Column:
    """Letters (from ``first`` on) and digits permuted within their classes; all else stays, and takes no part."""

    def written(chars: Column) -> Column:
        own = F.filter(chars, lambda c: c.rlike("[A-Za-z0-9]"))
        values = F.transform(own, lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - ord(first)).cast("bigint"))
        radices = F.transform(own, lambda c: F.when(c.between("0", "9"), 10).otherwise(26).cast("bigint"))

        def put(x: Column) -> Column:
            def step(acc: Column, c: Column) -> Column:
                number = F.get(x, acc["i"])
                shown = F.when(c.between("0", "9"), number.cast("string")).otherwise(F.char(number + ord(first)))
                moved = c.rlike("[A-Za-z0-9]")
                return F.struct(F.concat(acc["out"], F.when(moved, shown).otherwise(c)).alias("out"), (acc["i"] + moved.cast("int")).alias("i"))

            return F.aggregate(chars, F.struct(F.lit("").alias("out"), F.lit(0).alias("i")), step, lambda acc: acc["out"])

        # The classes are part of the tweak: texts of different shape never meet, so they can't collide.
        shape = F.array_join(F.transform(chars, lambda c: F.when(c.between("0", "9"), "9").when(c.rlike("[A-Za-z]"), "a").otherwise(c)), "")
        return let(permute(values, radices, key, F.concat_ws("/", tweak, shape)), put)

    return let(_chars(text), written)


def _iban(text: Column, key: str) -> Column:
    def written(bare: Column) -> Column:
        country, account = F.substring(bare, 1, 2), F.substring(bare, 5, 34)
        valid = _mod97(F.concat(account, F.substring(bare, 1, 4))) == 1
        new = _letters_and_digits(account, key, F.concat(F.lit("iban"), country), "A")

        def checked(account: Column) -> Column:
            check = 98 - _mod97(F.concat(account, country, F.lit("00")))
            return F.concat(country, F.lpad(check.cast("string"), 2, "0"), account)

        return F.when(valid, let(new, checked))

    def spaced(x: Column) -> Column:
        """The blanks of the original, between the same characters."""

        def step(acc: Column, c: Column) -> Column:
            blank = c == " "
            return F.struct(
                F.concat(acc["out"], F.when(blank, c).otherwise(F.substring(x, acc["i"], F.lit(1)))).alias("out"),
                (acc["i"] + (~blank).cast("int")).alias("i"),
            )

        return F.when(x.isNotNull(), F.aggregate(_chars(text), F.struct(F.lit("").alias("out"), F.lit(1).alias("i")), step, lambda acc: acc["out"]))

    return let(let(F.replace(text, F.lit(" "), F.lit("")), written), spaced)


def _email(text: Column, key: str) -> Column:
    """The same address in other case gets the same pseudonym, in that case."""
    local, domain = F.substring_index(text, "@", 1), F.substring_index(text, "@", -1)
    new = _letters_and_digits(F.lower(local), key, F.concat(F.lit("email"), F.lower(domain)), "a")

    def cased(x: Column) -> Column:
        chars = F.transform(
            F.sequence(F.lit(1), F.length(local)),
            lambda i: F.when(F.substring(local, i, F.lit(1)).between("A", "Z"), F.upper(F.substring(x, i, F.lit(1)))).otherwise(F.substring(x, i, F.lit(1))),
        )
        return F.concat(F.array_join(chars, ""), F.lit("@"), domain)

    return let(new, cased)


def pseudonym(found: Column, key: str) -> Column:
    """The pseudonym of a text that has one of the forms; the text itself if no form validates."""
    by_form = {
        "email": _email(found, key),
        "iban": _iban(found, key),
        "nanp": _nanp(found, key),
        "ssn": _ssn(found, key),
        "iso": _date(found.try_cast("date"), lambda d: F.date_format(d, "yyyy-MM-dd"), key),
        "dotted": _parted_date(found, ".", 0, 1, key),
        "slashed": _parted_date(found, "/", 1, 0, key),
        "ipv4": _ipv4(found, key),
        "intl": _intl(found, key),
        "card": _card(found, key),
    }
    out = F.lit(None).cast("string")
    for form in reversed(FORMS):
        out = F.when(found.rlike(f"^(?:{FORMS[form]})$"), by_form[form]).otherwise(out)
    return F.coalesce(out, found)


def pseudonymise(docs: DataFrame, key: str, text: str = "text", replaced: str | None = None) -> DataFrame:
    """``docs`` with pseudonyms in ``text``, and in ``replaced``, if named, the number of values changed.

    A column of the name ``replaced`` is overwritten.
    """
    body = F.col(text)
    parts, found, new = (fresh_name(docs.columns, name) for name in ("_parts", "_found", "_new"))
    # Few texts hold a digit or an @, and only those are searched.
    likely = body.rlike("[0-9@]")
    out = docs.withColumn(found, F.when(likely, F.regexp_extract_all(body, F.lit(ANY), F.lit(0))))
    out = out.withColumn(new, F.transform(F.col(found), lambda m: pseudonym(m, key)))
    out = out.withColumn(parts, F.when(F.size(found) > 0, F.split(body, ANY, -1)))
    joined = F.array_join(F.zip_with(F.col(new), F.slice(F.col(parts), F.lit(2), F.size(found)), lambda a, b: F.concat(a, b)), "")
    columns = {text: F.when(F.size(found) > 0, F.concat(F.get(F.col(parts), F.lit(0)), joined)).otherwise(body)}
    if replaced:
        changed = F.size(F.filter(F.zip_with(F.col(found), F.col(new), lambda a, b: a != b), lambda x: x))
        columns[replaced] = F.coalesce(changed, F.lit(0)).cast("long")
    return out.withColumns(columns).drop(parts, found, new)
