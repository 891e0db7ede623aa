"""Format-preserving Feistel pseudonyms for personal data in texts (operator 6)."""

from __future__ import annotations

import calendar
import hashlib
import math
import re
from collections.abc import Callable, Iterator
from datetime import date
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
# characters around a digit or @ that are scanned, before widening to white space
REACH = 48
FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()
_MONTHS = "January February March April May June July August September October November December".split()
_MONTH = {m.lower(): i for i, m in enumerate(_MONTHS, 1)} | {m[:3].lower(): i for i, m in enumerate(_MONTHS, 1)}
_ACCENTED = "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþ"


class Feistel:
    """A keyed permutation of the numbers below ``n`` without fixed points (for n > 1).

    A balanced Feistel network over the next even number of bits, walked until the value is below n,
    gives a permutation E; x goes to E(E^-1(x) + 1 mod n), one cycle through all numbers.
    """

    def __init__(self, n: int, key: bytes, tag: str):
        self.n, self.key, self.tag = n, hashlib.blake2b(key, digest_size=32).digest(), tag.encode()
        self.half = max(1, ((n - 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1

    def _round(self, i: int, x: int) -> int:
        size = -(-self.half // 8)
        h = hashlib.blake2b(x.to_bytes(size, "little") + self.tag, key=self.key,
                            salt=i.to_bytes(16, "little"), digest_size=max(8, min(64, size))).digest()
        if size > 64:  # a longer half takes a block of output per counter, each of them from the whole other half
            h = b"".join(hashlib.blake2b(h, key=self.key, salt=i.to_bytes(16, "little"), person=n.to_bytes(16, "little")).digest()
                         for n in range(1, -(-size // 64) + 1))
        return int.from_bytes(h, "little") & self.mask

    def _forward(self, x: int) -> int:
        while True:
            left, right = x >> self.half, x & self.mask
            for i in range(ROUNDS):
                left, right = right, left ^ self._round(i, right)
            x = left << self.half | right
            if x < self.n:
                return x

    def _back(self, x: int) -> int:
        while True:
            left, right = x >> self.half, x & self.mask
            for i in reversed(range(ROUNDS)):
                left, right = right ^ self._round(i, left), left
            x = left << self.half | right
            if x < self.n:
                return x

    def encrypt(self, x: int) -> int:
        return self._forward((self._back(x) + 1) % self.n) if self.n > 1 else x

    def decrypt(self, x: int) -> int:
        return self._forward((self._back(x) - 1) % self.n) if self.n > 1 else x


def luhn_digit(body: str) -> str:
    """The check digit that makes ``body`` + digit pass the Luhn test."""
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _refill(text: str, digits: str) -> str:
    it = iter(digits)
    return "".join(next(it) if "0" <= c <= "9" else c for c in text)


def _permuted_digits(digits: str, key: bytes, tag: str) -> str:
    return str(Feistel(10 ** len(digits), key, f"{tag}{len(digits)}").encrypt(int(digits))).zfill(len(digits))


def _card(text: str, key: bytes) -> str | None:
    """Digit runs of 13 to 19 (groups of four allowed): Luhn-valid ones stay Luhn-valid."""
    digits = _digits(text)
    if luhn_digit(digits[:-1]) == digits[-1]:
        body = _permuted_digits(digits[:-1], key, "card")
        return _refill(text, body + luhn_digit(body))
    return _refill(text, _permuted_digits(digits, key, "account"))


def _number(text: str, key: bytes) -> str | None:
    return _refill(text, _permuted_digits(_digits(text), key, "account"))


def _social(text: str, key: bytes) -> str | None:
    area, group, serial = re.split(r"[- ]", text)
    if area in ("000", "666") or area[0] == "9" or group == "00" or serial == "0000":
        return None
    areas = [a for a in range(1, 900) if a != 666]
    n = len(areas) * 99 * 9999
    x = (areas.index(int(area)) * 99 + int(group) - 1) * 9999 + int(serial) - 1
    y = Feistel(n, key, "social").encrypt(x)
    return _refill(text, f"{areas[y // (99 * 9999)]:03d}{y // 9999 % 99 + 1:02d}{y % 9999 + 1:04d}")


def _phone(text: str, key: bytes) -> str | None:
    """The country code stays; the other digits are permuted."""
    lead = re.match(r"\+\d{1,3}(?=[^\d])", text)
    head = lead[0] if lead else ""
    digits = _digits(text[len(head):])
    if not 7 <= len(digits) <= 14:
        return None
    return head + _refill(text[len(head):], _permuted_digits(digits, key, "phone"))


def _address(text: str, key: bytes) -> str | None:
    parts = [int(p) for p in text.split(".")]
    if max(parts) > 255:
        return None
    x = int.from_bytes(bytes(parts), "big")
    return ".".join(map(str, Feistel(1 << 32, key, "ipv4").encrypt(x).to_bytes(4, "big")))


def _iban(text: str, key: bytes) -> str | None:
    compact = text.replace(" ", "").upper()
    rank = "".join(str(int(c, 36)) for c in compact[4:] + compact[:4])
    if int(rank) % 97 != 1:
        return None
    body = _characters(compact[4:], key, "iban").upper()
    check = 98 - int("".join(str(int(c, 36)) for c in body + compact[:2] + "00")) % 97
    it = iter(compact[:2] + f"{check:02d}" + body)
    return "".join(c if c == " " else next(it) for c in text)


def _mixed(values: list[int], sizes: list[int]) -> tuple[int, int]:
    """(number with these places, first place highest; how many such numbers there are), by halves."""
    if len(values) <= 32:
        x, n = 0, 1
        for v, s in zip(values, sizes):
            x, n = x * s + v, n * s
        return x, n
    half = len(values) // 2
    (a, m), (b, n) = _mixed(values[:half], sizes[:half]), _mixed(values[half:], sizes[half:])
    return a * n + b, m * n


def _places(x: int, sizes: list[int]) -> list[int]:
    """The places of a mixed-radix number, first place highest, by halves."""
    if len(sizes) <= 32:
        out = []
        for s in reversed(sizes):
            x, r = divmod(x, s)
            out.append(r)
        return out[::-1]
    half = len(sizes) // 2
    a, b = divmod(x, math.prod(sizes[half:]))
    return _places(a, sizes[:half]) + _places(b, sizes[half:])


def _characters(text: str, key: bytes, tag: str, hexadecimal: bool = False) -> str:
    """Letters and digits permuted within their classes as one mixed-radix number; the rest stays."""
    classes = ["0123456789abcdef"] if hexadecimal else ["0123456789", "abcdefghijklmnopqrstuvwxyz", _ACCENTED]
    slots = []
    for i, c in enumerate(text):
        own = next((k for k in classes if c.lower() in k), None)
        if own and len(c.lower()) == 1:
            slots.append((i, own))
    if not slots:
        return text
    sizes = [len(own) for _, own in slots]
    x, n = _mixed([own.index(text[i].lower()) for i, own in slots], sizes)
    shape = "".join(str(classes.index(own)) for _, own in slots)
    y = Feistel(n, key, f"{tag}:{shape}").encrypt(x)
    out = list(text)
    for (i, own), r in zip(slots, _places(y, sizes)):
        out[i] = own[r].upper() if text[i].isupper() else own[r]
    if hexadecimal and any(c.isupper() for c in text):
        return "".join(out).upper()
    return "".join(out)


def _email(text: str, key: bytes) -> str | None:
    """The local part is permuted; a local part with nothing to permute takes the domain's first label."""
    local, domain = text.rsplit("@", 1)
    new = _characters(local, key, "mail")
    if new != local:
        return f"{new}@{domain}"
    first, dot, rest = domain.partition(".")
    return f"{local}@{_characters(first, key, 'domain')}{dot}{rest}"


def _secret(text: str, key: bytes) -> str | None:
    if not re.search(r"\d", text) or not re.search(r"[A-Fa-f]", text):
        return None
    return _characters(text, key, "hex", hexadecimal=True)


def _date(text: str, key: bytes) -> str | None:
    """A calendar date from 1900 to 2099, in the same writing; day before month unless that is no date."""
    parts = re.split(r"[^0-9A-Za-z]+", text)
    names = [i for i, p in enumerate(parts) if p.isalpha()]
    if names:
        month = _MONTH.get(parts[names[0]].lower())
        order = ["m", "d", "y"] if names[0] == 0 else ["d", "m", "y"]
    else:
        month = None
        order = ["y", "m", "d"] if len(parts[0]) == 4 else ["d", "m", "y"]
    for way in ([order] if names or order[0] == "y" else [order, ["m", "d", "y"]]):
        at = {k: i for i, k in enumerate(way)}
        y, m, d = int(parts[at["y"]]), month or (0 if names else int(parts[at["m"]])), int(parts[at["d"]])
        if not (1900 <= y <= 2099 and 1 <= m <= 12 and 1 <= d <= calendar.monthrange(y, m)[1]):
            continue
        x = date(y, m, d).toordinal() - FIRST_DAY
        new = date.fromordinal(Feistel(LAST_DAY - FIRST_DAY + 1, key, "day").encrypt(x) + FIRST_DAY)
        values = {"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
        if names:
            old = parts[names[0]]
            name = _MONTHS[new.month - 1]
            name = name if len(old) > 3 or old.lower() == "may" else name[:3]
            values["m"] = name.upper() if old.isupper() else name
            values["d"] = str(new.day).zfill(len(parts[at["d"]]))
        it = iter(values[k] for k in way)
        return re.sub(r"[0-9A-Za-z]+", lambda _: next(it), text)
    return None


_MONTH_WORD = "(?:" + "|".join(sorted(_MONTH, key=len, reverse=True)) + ")"
# kinds in the order in which they are tried at a place
_KINDS: list[tuple[str, str, Callable[[str, bytes], str | None]]] = [
    ("email", r"(?<![\w.%+-])[\w.%+-]+@[\w-]+(?:\.[\w-]*[A-Za-z][\w-]*)+", _email),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b", _iban),
    ("secret", r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![0-9A-Za-z])", _secret),
    ("date", r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{1,2}(?P<ds>[/.-])\d{1,2}(?P=ds)\d{4}|\d{1,2} " + _MONTH_WORD
     + r",? \d{4}|" + _MONTH_WORD + r" \d{1,2}, \d{4})(?![\d/-]|\.\d)", _date),
    ("ipv4", r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)", _address),
    ("social", r"(?<![\d-])\d{3}(?P<ss>[- ])\d{2}(?P=ss)\d{4}(?![\d-])", _social),
    ("phone", r"\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)"
     r"|(?<![\d(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}(?P<ps>[.-])\d{3}(?P=ps)\d{4}(?![\d-])", _phone),
    ("card", r"(?<!\d)(?:\d{4}(?P<cs>[ -])\d{4}(?P=cs)\d{4}(?P=cs)\d{1,7}|\d{13,19})(?!\d)", _card),
    ("number", r"(?<![\d.,])\d{9,12}(?!\d|[.,]\d)", _number),
]
_SCAN = re.compile("|".join(f"(?P<{name}>{pattern})" for name, pattern, _ in _KINDS), re.IGNORECASE)
_ALONE = {name: re.compile(pattern, re.IGNORECASE) for name, pattern, _ in _KINDS}
_MAKE = {name: make for name, _, make in _KINDS}
_ORDER = [name for name, _, _ in _KINDS]


@lru_cache(maxsize=65_536)
def _pseudonym(kind: str, value: str, key: bytes) -> str | None:
    return _MAKE[kind](value, key)


def _regions(text: str) -> Iterator[tuple[int, int]]:
    """Stretches around digits and @, widened to white space: all values lie inside one."""
    start, end = -1, -1
    for m in re.finditer("[0-9@]", text):
        if start >= 0 and m.start() <= end + 2 * REACH:
            end = m.start()
            continue
        if start >= 0:
            yield start, end
        start = end = m.start()
    if start >= 0:
        yield start, end


def find(text: str, key: bytes) -> Iterator[tuple[str, int, int, str]]:
    """(kind, start, end, pseudonym) of each validated value, left to right."""
    at = 0
    for first, last in _regions(text):
        begin = max(0, first - REACH)
        while begin > 0 and not text[begin - 1].isspace():
            begin -= 1
        at = max(at, begin)
        stop = last + REACH
        while stop < len(text) and not text[stop].isspace():
            stop += 1
        while m := _SCAN.search(text, at, stop):
            kind, end, new = m.lastgroup, m.end(), _pseudonym(m.lastgroup, m[0], key)
            if new is None:  # not valid as this kind: the next kinds get their chance at the same place
                for name in _ORDER[_ORDER.index(kind) + 1:]:
                    other = _ALONE[name].match(text, m.start(), stop)
                    if other and (new := _pseudonym(name, other[0], key)) is not None:
                        kind, end = name, other.end()
                        break
                else:
                    at = m.start() + 1
                    continue
            yield kind, m.start(), end, new
            at = end


def replaced(text: str, key: bytes) -> tuple[str, list[tuple[str, int, int, str]]]:
    """The text with pseudonyms, and (kind, start, length, pseudonym) of each value in the old text."""
    out, last, found = [], 0, []
    for kind, start, end, new in find(text, key):
        out += [text[last:start], new]
        found.append((kind, start, end - start, new))
        last = end
    return "".join([*out, text[last:]]), found


def pseudonymised(docs: DataFrame, key: bytes) -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and the column ``pii`` (kind, start, length, pseudonym).

    Values are found whole (e-mail addresses, dates, network addresses, phone, card, account, social
    security and bank account numbers, hexadecimal secrets), validated (calendar, octets, Luhn, mod 97)
    and permuted within their format by a Feistel network under ``key``, which the caller keeps secret: who
    has it can turn pseudonyms back.  Equal values get equal pseudonyms in
    every document, different values of a format different ones, and none stays as it was, however long
    it is.  An empty key raises.  Only texts
    with a digit or an @ go through Python.  Texts without a value stay as they are, null texts stay
    null with an empty list; a column already named ``pii`` is replaced; all other columns and repeated
    rows stay.
    """
    if not key:
        raise ValueError("pseudonyms need a key")
    schema = "text string, pii array<struct<kind:string,start:int,length:int,pseudonym:string>>"

    @F.pandas_udf(schema)
    def work(texts: pd.Series) -> pd.DataFrame:
        rows = [replaced(t, key) if t is not None else (None, []) for t in texts]
        return pd.DataFrame({"text": [t for t, _ in rows],
                             "pii": [[{"kind": k, "start": s, "length": n, "pseudonym": p} for k, s, n, p in f]
                                     for _, f in rows]})

    names = [c for c in docs.columns if c != "pii"]
    asked = F.when(F.col("text").rlike("[0-9@]"), F.col("text"))
    done = docs.select(F.struct(*names).alias("_row"), work(asked).alias("_new"))
    return done.select(
        *[F.coalesce("_new.text", "_row.text").alias("text") if c == "text" else F.col("_row")[c].alias(c) for c in names],
        F.coalesce("_new.pii", F.array().cast("array<struct<kind:string,start:int,length:int,pseudonym:string>>")).alias("pii"))
