"""Personal data: format-preserving Feistel pseudonyms, in DataFrame expressions only.

Candidates are found by one pattern, validated, and replaced by a keyed permutation of the
values of their own format, so equal values keep an equal (and valid) pseudonym in every
document, different values stay different, and the length and punctuation stay (but for
e-mail addresses, which are hashed letter by letter: different short ones can meet). Whatever
fails validation is left as it is.

  kind    validated by                            permuted
  card    13 to 19 digits, Luhn check digit       all digits but the last, which is recomputed
  iban    the country's length (15 to 34 for      the digits after the check digits, recomputed
          unlisted countries), mod 97 = 1
  ip      four octets up to 255                   the 32-bit address
  ssn     area, group and serial in range         (area, group and serial)
  date    a day of 1900 to 2099; yyyy-mm-dd,      the day, within 1900 to 2099
          dd.mm.yyyy, dd/mm/yyyy or mm/dd/yyyy    (mm/dd only among those that aren't dd/mm)
  phone   + and 8 to 15 digits in any grouping;   the digits after the country code
          or 3-3-4 digits, plain, after 1 or with
          a bracketed area code
  email   name@host.tld                           letters and digits before the last dot are
                                                  replaced by keyed ones of their kind (long
                                                  names have no small domain to permute)

A Feistel round adds to one half a keyed hash of the other, modulo the half's size; halves
may have any two sizes a and b, so the permutation of 0 .. a*b-1 needs no cycle walking (only
days, whose number has no two like factors, walk on to the next day). The hash is SHA-256 over
key, kind, round and half.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pinwheel.llm.common import free_name

ROUNDS = 8
DEFAULT_KEY = "pinwheel"

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
EMAIL = r"[\p{L}0-9][\p{L}0-9._%+-]*@[A-Za-z0-9][A-Za-z0-9-]*(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
IP = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
#: IBAN lengths of the countries in the registry, and two-digit calling codes (1 and 7 have one digit, the rest three).
IBAN_LENGTHS = {15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
                22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
                26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
                30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
TWO_DIGIT_CODES = "2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
# A country's own length comes first, so that words after the number aren't taken into it.
IBAN = ("(?:" + "|".join(f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}(?![A-Z0-9])" for n, c in IBAN_LENGTHS.items())
        + "|[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)")
DATE = r"(?:19|20)[0-9]{2}-[01][0-9]-[0-3][0-9]|[0-3][0-9][./][0-3][0-9][./](?:19|20)[0-9]{2}"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
CARD = r"[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}"
_PLAIN = r"(?<![0-9][.-])(?:1[ .-])?[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?!-[0-9])"
# An international number of 8 digits or more ends before a separator that another candidate follows; a whole card is none.
_GROUPED = r"(?:[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}|[0-9]{13,19})(?![ -]?[0-9])"
_NEXT = rf"(?:(?![ .-](?:{_GROUPED}|(?:{DATE}|{SSN}|{_PLAIN})(?![0-9]))| {IP}(?!\.?[0-9]))[ .-])?"
_ABROAD = (rf"\+(?![0-9]{{1,3}}[ .-]{_GROUPED})[1-9](?:(?:[ .-]?[0-9]){{5}}(?:{_NEXT}[0-9]){{0,7}}"
           rf"|[0-9]{{0,2}}[ .-]?\([0-9]{{1,4}}\)(?:[ .-]?[0-9]){{3}}(?:{_NEXT}[0-9]){{0,5}}){_NEXT}[0-9]{{2}}")
PHONE = (r"\+[0-9]{1,3}[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}"
         rf"|{_ABROAD}|{_PLAIN}")
# A match starts and ends where no longer number, word or dotted sequence goes on.
PATTERN = (rf"(?<![\p{{L}}0-9_@])(?:{EMAIL}(?![A-Za-z0-9_@-])|(?:(?<![0-9][.-]){IP}(?!\.[0-9])|{IBAN}|(?<![0-9][.-]){DATE}"
           rf"|(?<![0-9]-){SSN}(?!-[0-9])|{PHONE}|{CARD})(?![\p{{L}}0-9_@]))")
LETTER = r"\p{L}"


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to the value, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _digits(s: str) -> str:
    return f"regexp_replace({s}, '[^0-9]', '')"


def feistel(number: str, a: int | str, b: int | str, kind: str, key: str) -> str:
    """SQL for the keyed permutation of 0 .. a*b-1 at ``number`` (a bigint expression)."""
    def hashed(half: str) -> str:
        return f"CAST(conv(substring(sha2(concat({_lit(key + '|' + kind + '|')}, i, '|', a, '|', b, '|', {half}), 256), 1, 15), 16, 10) AS BIGINT)"
    step = (f"CASE WHEN i % 2 = 1 THEN named_struct('l', pmod(s.l + pmod({hashed('s.r')}, a), a), 'r', s.r) "
            f"ELSE named_struct('l', s.l, 'r', pmod(s.r + pmod({hashed('s.l')}, b), b)) END")
    run = (f"aggregate(sequence(1, {ROUNDS}), named_struct('l', n DIV b, 'r', n % b), (s, i) -> {step}, s -> s.l * b + s.r)")
    return _let(f"CAST({number} AS BIGINT)", "n", _let(f"CAST({a} AS BIGINT)", "a", _let(f"CAST({b} AS BIGINT)", "b", run)))


def permuted_digits(digits: str, kind: str, key: str) -> str:
    """SQL for a permutation of the strings of as many (1 to 18) digits."""
    half = "CAST(pow(10, length(g) DIV 2) AS BIGINT)"
    rest = "CAST(pow(10, length(g) - length(g) DIV 2) AS BIGINT)"
    return _let(digits, "g", f"lpad(CAST({feistel('g', half, rest, kind, key)} AS STRING), length(g), '0')")


def refilled(shape: str, digits: str) -> str:
    """SQL for ``shape`` with its digits replaced, in turn, by ``digits``."""
    one = f"substring({shape}, p, 1)"
    seen = f"length({_digits(f'substring({shape}, 1, p)')})"
    return _let(digits, "f", f"array_join(transform(sequence(1, length({shape})), p -> CASE WHEN {one} RLIKE '[0-9]' "
                             f"THEN substring(f, {seen}, 1) ELSE {one} END), '')")


def luhn_sum(digits: str) -> str:
    """SQL for the Luhn sum of digits that end with a check digit."""
    d = "CAST(substring(h, length(h) - k, 1) AS INT)"
    return _let(digits, "h", f"aggregate(sequence(0, length(h) - 1), 0, (t, k) -> t + CASE WHEN k % 2 = 0 THEN {d} "
                             f"WHEN {d} > 4 THEN 2 * {d} - 9 ELSE 2 * {d} END)")


def mod97(text: str) -> str:
    """SQL for the remainder by 97 of a string of digits and capitals (A = 10 to Z = 35)."""
    v = "CAST(conv(c, 36, 10) AS INT)"
    return f"aggregate(filter(split({text}, ''), c -> c <> ''), 0, (t, c) -> CASE WHEN {v} > 9 THEN (t * 100 + {v}) % 97 ELSE (t * 10 + {v}) % 97 END)"


def _card(m: str, key: str) -> str:
    body = "substring(w, 1, length(w) - 1)"
    fresh = _let(permuted_digits(body, "card", key), "y",
                 f"concat(y, CAST(pmod(10 - {luhn_sum(chr(39).join(['concat(y, ', '0', ')']))} % 10, 10) AS STRING))")
    return _let(_digits(m), "w", f"CASE WHEN {luhn_sum('w')} % 10 = 0 THEN {refilled(m, fresh)} END")


def _iban(m: str, key: str) -> str:
    plain = f"replace({m}, ' ', '')"
    tail = "substring(w, 5)"
    runs = _digits(tail)
    # Digits after the check digits, 18 at a time, each block permuted; letters stay.
    blocks = f"array_join(transform(sequence(0, (length(e) - 1) DIV 18), q -> {permuted_digits('substring(e, 18 * q + 1, 18)', 'iban', key)}), '')"
    fresh_tail = _let(runs, "e", f"CASE WHEN length(e) > 0 THEN {refilled(tail, blocks)} ELSE {tail} END")
    check = f"lpad(CAST(98 - {mod97(chr(39).join(['concat(z, substring(w, 1, 2), ', '00', ')']))} AS STRING), 2, '0')"
    fresh = _let(fresh_tail, "z", f"concat({check}, z)")
    # Put back with the blanks of the original.
    spaced = _let(f"concat(substring(w, 1, 2), {fresh})", "x",
                  f"array_join(transform(sequence(1, length({m})), p -> CASE WHEN substring({m}, p, 1) = ' ' THEN ' ' "
                  f"ELSE substring(x, length(replace(substring({m}, 1, p), ' ', '')), 1) END), '')")
    valid = f"length(w) BETWEEN 15 AND 34 AND {mod97('concat(substring(w, 5), substring(w, 1, 4))')} = 1"
    return _let(plain, "w", f"CASE WHEN {valid} THEN {spaced} END")


def _ip(m: str, key: str) -> str:
    number = f"aggregate(split({m}, '[.]'), CAST(0 AS BIGINT), (t, o) -> t * 256 + CAST(o AS BIGINT))"
    return _let(feistel(number, 65_536, 65_536, "ip", key), "y",
                "concat_ws('.', CAST(y DIV 16777216 AS STRING), CAST(y DIV 65536 % 256 AS STRING), CAST(y DIV 256 % 256 AS STRING), CAST(y % 256 AS STRING))")


def _ssn(m: str, key: str) -> str:
    area, group, serial = (f"CAST(substring({m}, {at}, {n}) AS BIGINT)" for at, n in ((1, 3), (5, 2), (8, 4)))
    # Areas 001 to 899 without 666 are 898 values.
    number = f"(({area} - 1 - CASE WHEN {area} > 666 THEN 1 ELSE 0 END) * 99 + {group} - 1) * 9999 + {serial} - 1"
    back = "y DIV 989901"
    fresh = _let(feistel(number, 898, 989_901, "ssn", key), "y",
                 f"concat(lpad(CAST({back} + 1 + CASE WHEN {back} >= 665 THEN 1 ELSE 0 END AS STRING), 3, '0'), '-', "
                 f"lpad(CAST(y % 989901 DIV 9999 + 1 AS STRING), 2, '0'), '-', lpad(CAST(y % 9999 + 1 AS STRING), 4, '0'))")
    return f"CASE WHEN {area} BETWEEN 1 AND 899 AND {area} <> 666 AND {group} > 0 AND {serial} > 0 THEN {fresh} END"


DAYS = 73_049  # from 1900-01-01 to 2099-12-31; 229 * 319 is the next number with two like factors
# Steps along the permutation's cycle to a day of the form (at least three of five days are).
CYCLE = 64


def _date(m: str, key: str) -> str:
    parts = []
    for shape, form in ((r"^....-", "yyyy-MM-dd"), (r"^..\\.", "dd.MM.yyyy"), (r"^../", "dd/MM/yyyy"), (r"^../", "MM/dd/yyyy")):
        day = f"date_diff(CAST(try_to_timestamp({m}, '{form}') AS DATE), DATE'1900-01-01')"
        # A day that can only be mm/dd must not become one that reads as dd/mm.
        only = " AND day(date_add(DATE'1900-01-01', CAST(z AS INT))) > 12" if form == "MM/dd/yyyy" else ""
        later = _let(feistel("w.n", 229, 319, "date", key), "z", f"named_struct('n', z, 'ok', z < {DAYS}{only})")
        walk = (f"aggregate(sequence(1, {CYCLE}), named_struct('n', CAST({day} AS BIGINT), 'ok', false), "
                f"(w, j) -> CASE WHEN w.ok THEN w ELSE {later} END, w -> CASE WHEN w.ok THEN w.n END)")
        fresh = f"date_format(date_add(DATE'1900-01-01', CAST({walk} AS INT)), '{form}')"
        parts.append(f"CASE WHEN {m} RLIKE '{shape}' AND try_to_timestamp({m}, '{form}') IS NOT NULL THEN {fresh} END")
    return f"coalesce({', '.join(parts)})"


def _phone(m: str, key: str) -> str:
    code = (f"CASE WHEN {m} NOT LIKE '+%' THEN length(w) - 10 WHEN w RLIKE '^[17]' THEN 1 "
            f"WHEN w RLIKE '^({TWO_DIGIT_CODES})' THEN 2 ELSE 3 END")
    fresh = _let(code, "c", f"concat(substring(w, 1, c), {permuted_digits('substring(w, c + 1)', 'phone', key)})")
    return _let(_digits(m), "w", refilled(m, fresh))


def _email(m: str, key: str) -> str:
    """Every letter and digit ahead of the last dot by a keyed one of its kind."""
    value = f"CAST(conv(substring(sha2(concat({_lit(key + '|email|')}, lower({m}), '|', p DIV 8), 256), 1 + 7 * (p % 8), 7), 16, 10) AS BIGINT)"
    one = f"substring({m}, p, 1)"
    last = f"length({m}) - instr(reverse({m}), '.')"
    return (f"array_join(transform(sequence(1, length({m})), p -> CASE WHEN p > {last} THEN {one} "
            f"WHEN {one} RLIKE '[0-9]' THEN CAST({value} % 10 AS STRING) "
            f"WHEN {one} RLIKE '[A-Z]' THEN chr(65 + {value} % 26) WHEN {one} RLIKE {_lit(LETTER)} THEN chr(97 + {value} % 26) ELSE {one} END), '')")


KINDS = ("email", "ip", "date", "ssn", "iban", "phone", "card")


def pseudonym(m: str, key: str) -> str:
    """SQL for struct(kind, value) of a candidate; value is null if it isn't valid."""
    tests = (("email", f"instr({m}, '@') > 0", _email), ("ip", f"{m} RLIKE {_lit('^' + IP + '$')}", _ip),
             ("date", f"{m} RLIKE {_lit('^(?:' + DATE + ')$')}", _date), ("ssn", f"{m} RLIKE {_lit('^' + SSN + '$')}", _ssn),
             ("iban", f"{m} RLIKE '^[A-Z]'", _iban), ("phone", f"{m} RLIKE {_lit('^(?:' + PHONE + ')$')}", _phone),
             ("card", "true", _card))
    return "CASE " + " ".join(f"WHEN {test} THEN named_struct('kind', '{kind}', 'value', {make(m, key)})" for kind, test, make in tests) + " END"


def pseudonymise(df: DataFrame, text_col: str = "text", key: str = DEFAULT_KEY, found_col: str = "found") -> DataFrame:
    """``df`` with pseudonyms in ``text_col`` and ``found_col`` array<struct<kind, value>>: the
    pseudonyms put in, in text order (a column of that name is replaced).

    A null text stays null with no finding. Every row is treated alone, so repeated rows give
    repeated results; no shuffle.
    """
    text = F.col(f"`{text_col}`").cast("string")
    pattern = F.lit(PATTERN)
    maybe = text.rlike("[0-9@]") & text.rlike(PATTERN)
    none = F.expr("CAST(array() AS array<struct<old:string,kind:string,value:string>>)")
    got = F.when(maybe, F.transform(F.regexp_extract_all(text, pattern, 0), lambda m: F.struct(m.alias("old"), m.alias("raw")))) \
        .otherwise(F.expr("CAST(array() AS array<struct<old:string,raw:string>>)"))
    names = [c for c in df.columns if c != found_col]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), got.alias("got"))
    made = F.expr(f"transform(got, x -> {_let('x.old', 'm', 'named_struct(' + chr(39) + 'old' + chr(39) + ', m, ' + chr(39) + 'new' + chr(39) + ', ' + pseudonym('m', key) + ')')})")
    rows = rows.select("row", made.alias("made"))
    whole = F.col(f"row.`{text_col}`").cast("string")
    gaps = F.split(whole, PATTERN, -1)
    pieces = F.zip_with(gaps, F.col("made"), lambda g, x: F.concat(g, F.coalesce(x["new"]["value"], x["old"], F.lit(""))))
    text = F.when(F.size("made") > 0, F.array_join(pieces, "")).otherwise(whole)
    valid = F.transform(F.filter("made", lambda x: x["new"]["value"].isNotNull()), lambda x: x["new"])
    return rows.select(*[text.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in names], valid.alias(found_col))


def pii_documents(docs: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """doc_id, the pseudonymised text, n_replaced, and per kind how many were replaced."""
    out = pseudonymise(docs.select("doc_id", "text"), key=key)

    def number_of(kind):
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number_of(kind) for kind in KINDS]
    return out.select("doc_id", "text", F.size("found").cast("long").alias("n_replaced"), *counts)


def without_pii(docs: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """``docs`` with pseudonyms in ``text``; columns unchanged (``n_chars`` stays right, since
    pseudonyms keep their length but for addresses, and is counted anew)."""
    name = free_name(docs, "found")
    out = pseudonymise(docs, key=key, found_col=name).drop(name)
    if "n_chars" in out.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out.select(*docs.columns)
