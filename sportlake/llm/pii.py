"""Format-preserving pseudonyms of personal data by keyed Feistel permutations.

Each value found is reduced to its canonical form (its digits, its day, its address),
validated, and permuted within the set of valid values of its kind by a Feistel network
whose rounds are keyed BLAKE2b. Equal values, however written and in whatever text, get equal
pseudonyms in the writing of each place; whoever holds the key can reverse them.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
#: Days that dates are permuted within.
FIRST_DAY, DAYS = datetime.date(1900, 1, 1), 73_049
KINDS = ("email", "iban", "date", "ip", "ssn", "card", "phone", "number", "token")

_VALUE = re.compile(
    r"(?P<email>[\w.+-]+@\w[\w-]*(?:\.\w[\w-]*)+)"
    r"|(?P<token>(?<![0-9A-Za-z])[0-9a-fA-F]{32,}(?![0-9A-Za-z]))"
    r"|(?P<iban>(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z]))"
    r"|(?P<date>(?<![\d./-])(?:\d{4}(?P<s1>[-/.])\d{1,2}(?P=s1)\d{1,2}"
    r"|\d{1,2}(?P<s2>[-/.])\d{1,2}(?P=s2)\d{4})(?![\d/-]|\.\d))"
    r"|(?P<ip>(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
    r"|(?P<card>(?<![\d+])(?:\d{4}(?P<s3>[ -])\d{4}(?P=s3)\d{4}(?P=s3)\d{1,7}"
    r"|\d{4}(?P<s4>[ -])\d{6}(?P=s4)\d{5})(?!\d))"
    r"|(?P<phone>(?<![\d+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{2,4})[ .-]\d{2,4}"
    r"(?:[ .-]?\d{2,4}){1,3}(?!\d)|\+\d{8,15}(?!\d))"
    r"|(?P<number>(?<!\d)\d{9,}(?!\d))",
    re.ASCII,
)


def luhn(digits: str) -> int:
    """The check digit that follows ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 - i % 2)
        total += d - 9 * (d > 9)
    return -total % 10


def iban_check(country: str, rest: str) -> str:
    number = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{98 - int(number) % 97:02d}"


class Pseudonyms:
    """Keyed permutations of values within their format; ``back`` reverses them."""

    def __init__(self, key: bytes, back: bool = False):
        self.key, self.back = blake2b(key, digest_size=32).digest(), back

    def _round(self, tweak: bytes, number: int, half: int, modulus: int) -> int:
        size = modulus.bit_length() // 8 + 9
        seed = tweak + bytes([number]) + half.to_bytes(half.bit_length() // 8 + 1, "big")
        found, block = b"", 0
        while len(found) < size:
            found += blake2b(seed + block.to_bytes(4, "big"), key=self.key).digest()
            block += 1
        return int.from_bytes(found[:size], "big") % modulus

    def _feistel(self, kind: str, value: int, left: int, right: int) -> int:
        """Permutes 0 .. left * right - 1."""
        tweak = f"{kind}:{left}:{right}:".encode()
        a, b = divmod(value, right)
        for i in range(ROUNDS)[:: -1 if self.back else 1]:
            sign = -1 if self.back else 1
            if i % 2:
                b = (b + sign * self._round(tweak, i, a, right)) % right
            else:
                a = (a + sign * self._round(tweak, i, b, left)) % left
        return a * right + b

    def number(self, kind: str, value: int, size: int) -> int:
        """Permutes 0 .. size - 1, walking on while the Feistel value lies beyond."""
        left = max(1, int(size**0.5) if size < 1 << 50 else 1 << (size.bit_length() // 2))
        right = -(-size // left)
        while True:
            value = self._feistel(kind, value, left, right)
            if value < size:
                return value

    def digits(self, kind: str, digits: str) -> str:
        return str(self.number(f"{kind}{len(digits)}", int(digits), 10 ** len(digits))).zfill(len(digits))

    def mixed(self, kind: str, text: str) -> str:
        """Permutes letters among letters and digits among digits (case apart)."""
        low = text.lower()
        value, size, shape = 0, 1, ""
        for c in low:
            base, code = (10, ord(c) - 48) if "0" <= c <= "9" else (26, ord(c) - 97) if "a" <= c <= "z" else (1, 0)
            value, size = value * base + code, size * base
            shape += "9" if base == 10 else "a" if base == 26 else c
        value, found = self.number(f"{kind}{shape}", value, size) if size > 1 else 0, []
        for c in reversed(shape):
            if c in "9a":
                value, code = divmod(value, 10 if c == "9" else 26)
                c = chr(code + (48 if c == "9" else 97))
            found.append(c)
        return "".join(b.upper() if a.isupper() else b for a, b in zip(text, reversed(found), strict=True))

    def date(self, text: str) -> str | None:
        parts = re.split(r"([-/.])", text)
        year_first = len(parts[0]) == 4
        # Day first, unless only month first is possible.
        orders = [(0, 2, 4)] if year_first else [(4, 2, 0), (4, 0, 2)]
        for y, m, d in orders:
            try:
                found = datetime.date(*(int(parts[i]) for i in (y, m, d)))
            except ValueError:
                continue
            day = (found - FIRST_DAY).days
            if not 0 <= day < DAYS:
                return None
            return self._dated(parts, (y, m, d), day)
        return None

    def _dated(self, parts: list[str], order: tuple[int, int, int], day: int) -> str:
        """Permutes within the days that are read in the same order when they are written."""
        while True:
            day = self.number("date", day, DAYS)
            new = FIRST_DAY + datetime.timedelta(day)
            if order != (4, 0, 2) or new.day > 12:
                break
        out = list(parts)
        for i, value in zip(order, (new.year, new.month, new.day), strict=True):
            out[i] = str(value).zfill(len(parts[i]))
        return "".join(out)

    def replace(self, kind: str, text: str) -> tuple[str, str] | None:
        """Kind and pseudonym of a value found, or None if it isn't valid for its kind."""
        if kind == "email":
            local, _, domain = text.partition("@")
            return kind, f"{self.mixed(kind, local)}@{domain}"
        if kind == "token":
            value = self.number(f"token{len(text)}", int(text, 16), 16 ** len(text))
            new = f"{value:0{len(text)}x}"
            return kind, new.upper() if text.upper() == text else new
        if kind == "date":
            new = self.date(text)
            return new and (kind, new)
        if kind == "ip":
            parts = [int(x) for x in text.split(".")]
            if max(parts) > 255:
                return None
            value = self.number("ip", int.from_bytes(bytes(parts), "big"), 1 << 32)
            return kind, ".".join(map(str, value.to_bytes(4, "big")))
        if kind == "iban":
            plain = text.replace(" ", "")
            if iban_check(plain[:2], plain[4:]) != plain[2:4]:
                return None
            rest = self.mixed(kind, plain[4:])
            return kind, self._filled(text, plain[:2] + iban_check(plain[:2], rest) + rest, r"[0-9A-Z]")
        plain = re.sub(r"\D", "", text)
        if kind in ("card", "number"):
            if 13 <= len(plain) <= 19 and luhn(plain[:-1]) == int(plain[-1]):
                new = self.digits("card", plain[:-1])
                return "card", self._filled(text, new + str(luhn(new)), r"\d")
            if 13 <= len(plain) <= 19:
                # Not a card: permuted among the numbers that aren't either.
                new = plain
                while True:
                    new = self.digits("number", new)
                    if luhn(new[:-1]) != int(new[-1]):
                        break
                return "number", self._filled(text, new, r"\d")
            return "number", self._filled(text, self._last_ten(plain), r"\d")
        if kind == "phone":
            if not 8 <= len(plain) <= 15:
                return None
            kept = 1 if text[0] == "+" and len(plain) <= 10 else 0
            return kind, self._filled(text, plain[:kept] + self._last_ten(plain[kept:]), r"\d")
        return kind, self._filled(text, self._last_ten(plain), r"\d")

    def _last_ten(self, plain: str) -> str:
        """Digits with the last ten permuted, by their number alone, whatever they stand for."""
        own = min(10, len(plain))
        return plain[: len(plain) - own] + self.digits("digits", plain[len(plain) - own :])

    @staticmethod
    def _filled(text: str, values: str, pattern: str) -> str:
        """``text`` with its characters of the pattern replaced in turn."""
        fresh = iter(values)
        return re.sub(pattern, lambda _: next(fresh), text)

    def text(self, text: str) -> tuple[str, dict[str, int]]:
        """The text with its values replaced, and how many of each kind."""
        counts: dict[str, int] = {}

        def put(match: re.Match) -> str:
            kind = next(k for k in KINDS if match[k])
            found = self.replace(kind, match[0])
            if found is None:
                return match[0]
            counts[found[0]] = counts.get(found[0], 0) + 1
            return found[1]

        return _VALUE.sub(put, text), counts


_SUSPECT = re.compile(r"[\d@]")


def pseudonymised(docs: DataFrame, key: bytes) -> DataFrame:
    """``docs`` (doc_id, text, more columns) as ``doc_id, text, n_<kind> ..., n_values``.

    Social security, phone and other numbers of up to twelve digits are permuted by their digits alone, so one value has
    one pseudonym with or without signs between; of more than ten digits the first ones stay, and so does the first one
    after a plus sign. Kinds: e-mail addresses (the local part), IBANs, dates, IPv4 addresses, social security
    numbers, card numbers, phone numbers, other numbers of nine or more digits, and hex
    tokens. Cards keep a valid check digit, IBANs their country and a valid check, dates stay
    days of 1900 to 2099, phones keep a country prefix. Values that aren't valid for their
    format (a 13th month, an address part of 300, a wrong check) are left as they are.

    A row for each row; null and empty texts stay so with counts of 0. Rows repeated get the
    same result. Columns other than ``doc_id`` and ``text`` are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Pseudonyms(key)
        for batch in batches:
            texts, counts = [], []
            for text in batch.column(1).to_pylist():
                found: dict[str, int] = {}
                if text and _SUSPECT.search(text):
                    text, found = own.text(text)
                texts.append(text)
                counts.append(found)
            columns = [pa.array([c.get(k, 0) for c in counts], pa.int64()) for k in KINDS]
            total = pa.array([sum(c.values()) for c in counts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), *columns, total],
                names=["doc_id", "text", *(f"n_{k}" for k in KINDS), "n_values"],
            )

    kinds = ", ".join(f"n_{k} bigint" for k in KINDS)
    narrow = docs.select(F.col("doc_id").cast("long"), "text")
    return narrow.mapInArrow(run, f"doc_id bigint, text string, {kinds}, n_values bigint")
