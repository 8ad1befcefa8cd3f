"""Replace personal data by pseudonyms of the same format.

Validated values (check digits, octets, calendar days) are permuted within their format by a
keyed Feistel network.  A value gets the same pseudonym wherever it occurs, so documents stay
linked, and two values of one kind and format never share one.  A value that runs over a line end is not found.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from venuekit.llm.cluster import ship

ROUNDS = 8
DIGITS = "0123456789"
HEX = "0123456789abcdef"
LOWER = "abcdefghijklmnopqrstuvwxyz"
CODES = LOWER.upper() + DIGITS
#: Days that dates are permuted among: 1900 to 2099.
FIRST_DAY = dt.date(1900, 1, 1).toordinal()
DAYS = dt.date(2100, 1, 1).toordinal() - FIRST_DAY


@lru_cache(1 << 16)
def permute(value: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of ``range(size)``: a Feistel network on the next rectangle, walked until inside."""
    if size < 2:
        return value
    left = math.isqrt(size - 1) + 1
    right = -(-size // left)
    while True:
        a, b = divmod(value, right)
        sides = left, right
        for i in range(ROUNDS):
            # the halves swap roles; sizes alternate, so that each round stays a bijection
            code = hashlib.blake2b(f"{tweak}|{size}|{i}|{b}".encode(), key=key, digest_size=16).digest()
            a, b = b, (a + int.from_bytes(code, "big")) % sides[0]
            sides = sides[::-1]
        value = a * sides[1] + b
        if value < size:
            return value


def permute_text(text: str, key: bytes, tweak: str) -> str:
    """Permute letters among letters of their case and digits among digits; all else stays."""
    sizes = [10 if c in DIGITS else 26 if c.lower() in LOWER else 1 for c in text]
    value, size = 0, 1
    for c, n in zip(text, sizes):
        if n > 1:
            value, size = value * n + (int(c) if n == 10 else LOWER.index(c.lower())), size * n
    value = permute(value, size, key, f"{tweak}|{len(text)}|{''.join(str(n) for n in sizes)}")
    out = []
    for c, n in zip(reversed(text), reversed(sizes)):
        if n > 1:
            value, at = divmod(value, n)
            c = DIGITS[at] if n == 10 else LOWER[at].upper() if c.isupper() else LOWER[at]
        out.append(c)
    return "".join(reversed(out))


def _in_alphabet(text: str, alphabet: str, key: bytes, tweak: str) -> str:
    n, value = len(alphabet), 0
    for c in text:
        value = value * n + alphabet.index(c)
    value = permute(value, n ** len(text), key, f"{tweak}|{len(text)}")
    out = []
    for _ in text:
        value, at = divmod(value, n)
        out.append(alphabet[at])
    return "".join(reversed(out))


def _put_digits(text: str, digits: str) -> str:
    """``text`` with its digits replaced in order."""
    new = iter(digits)
    return "".join(next(new) if c in DIGITS else c for c in text)


def luhn_digit(body: str) -> str:
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def card(text: str, key: bytes) -> str | None:
    """A number with a valid check digit, of 13 to 19 digits: the first digit stays, the check digit is made anew."""
    digits = "".join(c for c in text if c in DIGITS)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    body = digits[0] + _in_alphabet(digits[1:-1], DIGITS, key, f"card{digits[0]}")
    return _put_digits(text, body + luhn_digit(body))


def iban(text: str, key: bytes) -> str | None:
    """A valid account number: the country stays, the rest is permuted by kind of character, the check digits are made anew."""
    plain = text.replace(" ", "")

    def remainder(body: str) -> int:
        return int("".join(str(int(c, 36)) for c in body)) % 97

    # check digits are 02 to 98, so that one body has one pair of them
    if not 15 <= len(plain) <= 34 or not 2 <= int(plain[2:4]) <= 98 or remainder(plain[4:] + plain[:4]) != 1:
        return None
    body = permute_text(plain[4:], key, f"iban{plain[:2]}")
    check = 98 - remainder(f"{body}{plain[:2]}00")
    new = iter(f"{plain[:2]}{check:02d}{body}")
    return "".join(" " if c == " " else next(new) for c in text)


def ipv4(text: str, key: bytes) -> str | None:
    octets = [int(p) for p in text.split(".")]
    if max(octets) > 255 or any(len(p) > 1 and p[0] == "0" for p in text.split(".")):
        return None
    value = permute(int.from_bytes(bytes(octets), "big"), 1 << 32, key, "ipv4")
    return ".".join(map(str, value.to_bytes(4, "big")))


def phone(text: str, key: bytes) -> str | None:
    """International numbers: the country code (the digits up to the first separator) stays."""
    head = re.match(r"\+\d{1,3}(?=[ .(-])|\+\d", text)[0]
    rest = text[len(head) :]
    digits = "".join(c for c in rest if c in DIGITS)
    if not 6 <= len(digits) <= 14:
        return None
    return head + _put_digits(rest, _in_alphabet(digits, DIGITS, key, f"phone{head}"))


def social(text: str, key: bytes) -> str | None:
    """Numbers like 123-45-6789 of valid parts, permuted among the valid ones."""
    area, group, serial = map(int, text.split("-"))
    areas = [a for a in range(1, 900) if a != 666]
    if area not in areas or not group or not serial:
        return None
    value = (areas.index(area) * 99 + group - 1) * 9999 + serial - 1
    value, serial = divmod(permute(value, len(areas) * 99 * 9999, key, "social"), 9999)
    area, group = divmod(value, 99)
    return f"{areas[area]:03d}-{group + 1:02d}-{serial + 1:04d}"


def _day(year: int, month: int, day: int, key: bytes) -> dt.date | None:
    try:
        n = dt.date(year, month, day).toordinal() - FIRST_DAY
    except ValueError:
        return None
    return dt.date.fromordinal(FIRST_DAY + permute(n, DAYS, key, "day")) if 0 <= n < DAYS else None


def date_ymd(text: str, key: bytes) -> str | None:
    new = _day(*map(int, (text[:4], text[5:7], text[8:10])), key)
    return new and f"{new.year:04d}{text[4]}{new.month:02d}{text[7]}{new.day:02d}"


def date_dmy(text: str, key: bytes) -> str | None:
    """Day before month, unless only the other order is a day of the calendar."""
    a, b, year = int(text[:2]), int(text[3:5]), int(text[6:10])
    if new := _day(year, b, a, key):
        return f"{new.day:02d}{text[2]}{new.month:02d}{text[5]}{new.year:04d}"
    new = _day(year, a, b, key)
    # a pseudonym that reads day first would stand for another day: walk on until it does not
    while new and new.day <= 12:
        new = _day(new.year, new.month, new.day, key)
    return new and f"{new.month:02d}{text[2]}{new.day:02d}{text[5]}{new.year:04d}"


def email(text: str, key: bytes) -> str:
    """The part before the at sign; the domain stays."""
    name, _, domain = text.rpartition("@")
    return f"{permute_text(name, key, f'email{domain.lower()}')}@{domain}"


def cloud_key(text: str, key: bytes) -> str:
    return text[:4] + _in_alphabet(text[4:], CODES, key, f"cloud{text[:4]}")


def secret(text: str, key: bytes) -> str:
    """The value after ``password=``, ``token = "`` and the like; hexadecimal values stay so, and others stay others."""
    at = re.match(r"""[A-Za-z_]+\s{0,3}[=:]\s{0,3}["']?""", text).end()
    value = text[at:]
    if not set(value) - set(HEX):
        return text[:at] + _in_alphabet(value, HEX, key, "secret")
    # walked until the image is not hexadecimal either, which keeps the two kinds apart and each one-to-one
    new = permute_text(value, key, "secret")
    while not set(new) - set(HEX):
        new = permute_text(new, key, "secret")
    return text[:at] + new


#: Kind, pattern and rule, first match first.  All repeats are bounded or of one class, so that long texts cost linear time.
RULES: tuple[tuple[str, str, Callable[[str, bytes], str | None]], ...] = (
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,6}\.[A-Za-z]{2,24}(?![A-Za-z0-9-])", email),
    ("cloud_key", r"(?<![A-Za-z0-9])A[KS]IA[A-Z0-9]{16}(?![A-Za-z0-9])", cloud_key),
    ("secret", r"""(?<![A-Za-z])(?i:password|passwd|pwd|secret|token|api_?key)\s{0,3}[=:]\s{0,3}["']?[A-Za-z0-9+/_-]{8,128}""", secret),
    ("ipv4", r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)", ipv4),
    ("date_ymd", r"(?<![\d/.-])\d{4}[-/.]\d{2}[-/.]\d{2}(?![\d/-])", date_ymd),
    ("date_dmy", r"(?<![\d/.-])\d{2}[-/.]\d{2}[-/.]\d{4}(?![\d/-])", date_dmy),
    ("phone", r"(?<![\w+])\+\d{1,3}(?:[ .-]?\(\d{1,4}\)|[ .-]?\d{1,4})(?:[ .-]?\d{2,4}){1,4}(?!\d)", phone),
    ("social", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", social),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", iban),
    ("card", r"(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-])", card),
)
_ANY = re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, pattern, _ in RULES), re.ASCII)
_RULE = {kind: rule for kind, _, rule in RULES}
_MARKS = re.compile(r"[0-9@=:]")


def _found(text: str) -> Iterator[re.Match]:
    """Matches of the rules, looked for only in lines that have a digit or one of ``@=:``."""
    at = 0
    while mark := _MARKS.search(text, at):
        end = text.find("\n", mark.end())
        end = len(text) if end < 0 else end
        yield from _ANY.finditer(text, max(at, text.rfind("\n", 0, mark.start()) + 1), end)
        at = end


def pseudonymise(text: str | None, key: bytes) -> tuple[str | None, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and kind, start and end of each in it.  What does not validate stays."""
    if not text:
        return text, []
    out, spans, at, size = [], [], 0, 0
    for m in _found(text):
        new = _RULE[m.lastgroup](m[0], key)
        if new is None:
            continue
        out += [text[at : m.start()], new]
        size += m.start() - at
        spans.append((m.lastgroup, size, size + len(new)))
        size, at = size + len(new), m.end()
    return "".join([*out, text[at:]]), spans


SPANS = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
)
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def replace_personal(docs: DataFrame, key: str, text_col: str = "text", spans_col: str | None = "spans") -> DataFrame:
    """``docs`` with pseudonyms in its texts and the places of these in ``spans_col``, if one is named.

    One row per input row.  Null and empty texts stay as they are, with no spans.  An input column
    called ``spans_col`` gives way.  Values found in copies of a text get the same pseudonyms.
    """
    ship(docs.sparkSession)
    secret_key = hashlib.blake2b(key.encode()).digest()
    kept = docs.drop(spans_col) if spans_col else docs
    at = kept.columns.index(text_col)

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                done = [pseudonymise(t, secret_key) for t in part.column(at).to_pylist()]
                part = part.set_column(at, part.schema.field(at), pa.array([t for t, _ in done], part.schema.field(at).type))
                if spans_col:
                    rows = [[dict(zip(("kind", "start", "end"), s)) for s in spans] for _, spans in done]
                    part = part.append_column(spans_col, pa.array(rows, _ARROW_SPANS))
                yield part

    schema = T.StructType([*kept.schema.fields, *([T.StructField(spans_col, SPANS)] if spans_col else [])])
    return kept.mapInArrow(replace, schema)
