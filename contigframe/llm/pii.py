"""Personal data under format-preserving Feistel pseudonyms.

Values that a validator accepts are replaced by a keyed permutation of themselves within their own format: the same value gets
the same pseudonym in every document, two values never share one, and the holder of the key can go back. Card numbers keep
their length, separators and a valid check digit (Luhn), account numbers (IBAN) their country, letters where letters were and valid check digits, dates stay
dates of the same format, phone numbers, national identifiers and network addresses keep their grouping, and e-mail addresses their
shape and top-level domain.
"""

from __future__ import annotations

import datetime
import functools
import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contigframe.llm import tokens, util

ROUNDS = 10
#: The key is the deployment's secret; this one only serves the registered query and tests.
DEMO_KEY = b"demonstration key, not secret"
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


def _round(key: bytes, tweak: str, i: int, value: int, size: int) -> int:
    h = hashlib.blake2b(f"{tweak}|{i}|{value}|{size}".encode(), key=key[:64], digest_size=16).digest()
    return int.from_bytes(h, "big")


def feistel(value: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """A keyed permutation of 0..size-1: an alternating Feistel network over a x b >= size, walked until inside."""
    if size < 2:
        return value
    a = int(size**0.5)
    while a * a < size:
        a += 1
    b = -(-size // a)
    while True:
        left, right = divmod(value, b)
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if i % 2:
                right = (right + sign * _round(key, tweak, i, left, size)) % b
            else:
                left = (left + sign * _round(key, tweak, i, right, size)) % a
        value = left * b + right
        if value < size:
            return value


def _digits(s: str) -> str:
    return re.sub(r"\D", "", s)


def _refill(shape: str, digits: str) -> str:
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


def luhn_digit(body: str) -> str:
    total = 0
    for k, c in enumerate(reversed(body)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _permute_digits(d: str, key: bytes, tweak: str, back: bool) -> str:
    return str(feistel(int(d), 10 ** len(d), key, f"{tweak}{len(d)}", back)).zfill(len(d)) if d else d


def card(s: str, key: bytes, back: bool) -> str | None:
    d = _digits(s)
    if not 13 <= len(d) <= 19 or luhn_digit(d[:-1]) != d[-1] or len(set(d)) == 1:
        return None
    body = _permute_digits(d[:-1], key, "card", back)
    if len(set(body)) == 1:  # all digits alike isn't valid either way: go on to the next in the cycle
        body = _permute_digits(body, key, "card", back)
    return _refill(s, body + luhn_digit(body))


def long_number(s: str, key: bytes, back: bool) -> str | None:
    """Card-shaped numbers (16 digits) that fail the check digit: mistyped or invented, so replaced as digits that fail it too."""
    d = _digits(s)
    if len(d) != 16 or luhn_digit(d[:-1]) == d[-1]:
        return None
    miss = (int(d[-1]) - int(luhn_digit(d[:-1]))) % 10  # 1..9
    v = feistel(int(d[:-1]) * 9 + miss - 1, 9 * 10**15, key, "number16", back)
    body = str(v // 9).zfill(15)
    return _refill(s, body + str((int(luhn_digit(body)) + v % 9 + 1) % 10))


def _iban_value(s: str) -> int:
    return int("".join(str(int(c, 36)) for c in s))


def iban(s: str, key: bytes, back: bool) -> str | None:
    flat = s.replace(" ", "")
    if not 15 <= len(flat) <= 34 or _iban_value(flat[4:] + flat[:4]) % 97 != 1:
        return None
    permute = _permute_digits if flat[4:].isdigit() else _permute_letters
    body = permute(flat[4:], key, f"iban{flat[:2]}", back)
    check = 98 - _iban_value(body + flat[:2] + "00") % 97
    it = iter(f"{flat[:2]}{check:02d}{body}")
    return "".join(c if c == " " else next(it) for c in s)


def phone(s: str, key: bytes, back: bool) -> str | None:
    """The country code stays: what follows the plus up to the first separator."""
    head = re.match(r"\+\d{1,3}(?=\D)|", s)[0]
    d = _digits(s[len(head) :])
    if not 6 <= len(d) <= 14:
        return None
    return head + _refill(s[len(head) :], _permute_digits(d, key, f"phone{head}", back))


def domestic(s: str, key: bytes, back: bool) -> str | None:
    """A number with its leading nought, which stays, and no second one: with that it would be none on the way back."""
    d = _digits(s)
    if not 10 <= len(d) <= 12 or d[1] == "0":
        return None
    least = 10 ** (len(d) - 2)
    return "0" + _refill(s[1:], str(least + feistel(int(d[1:]) - least, 9 * least, key, f"domestic{len(d) - 1}", back)))


def national(s: str, key: bytes, back: bool) -> str | None:
    """Three groups 3-2-4: area not 000, 666 or 9xx, no group all zero."""
    a, b, c = s.split("-")

    def valid(x: int) -> bool:
        return 0 < x // 10**6 < 900 and x // 10**6 != 666 and x // 10**4 % 100 > 0 and x % 10**4 > 0

    v = int(a + b + c)
    if not valid(v):
        return None
    v = feistel(v, 10**9, key, "national", back)
    while not valid(v):
        v = feistel(v, 10**9, key, "national", back)
    d = f"{v:09d}"
    return f"{d[:3]}-{d[3:5]}-{d[5:]}"


def address(s: str, key: bytes, back: bool) -> str | None:
    parts = s.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    v = 0
    for p in parts:
        v = v * 256 + int(p)
    v = feistel(v, 2**32, key, "address", back)
    return ".".join(str(v >> k & 255) for k in (24, 16, 8, 0))


def _day_kind(day: datetime.date) -> tuple[bool, bool, bool]:
    """What the forms of a day depend on: whether it can't be a month, and whether day and month have one digit."""
    return day.day > 12, day.day < 10, day.month < 10


@functools.cache
def _days(kind: tuple[bool, bool, bool]) -> list[int]:
    """All days of a kind, ascending."""
    return [n for n in range(FIRST_DAY, LAST_DAY + 1) if _day_kind(datetime.date.fromordinal(n)) == kind]


def date(s: str, key: bytes, back: bool) -> str | None:
    """Year-month-day with hyphens or slashes; day.month.year with full stops; month/day/year or, where only that is valid, day/month/year.

    A day becomes a day of its kind, which reads back in the same order and has as many digits in every form; the permutation within a kind is
    one for all forms, so equal days stay linked.
    """
    sep = re.search(r"\D", s)[0]
    parts = s.split(sep)
    order = "ymd" if len(parts[0]) == 4 else "dmy" if sep == "." or int(parts[0]) > 12 else "mdy"
    given = dict(zip(order, parts, strict=True))
    try:
        day = datetime.date(int(given["y"]), int(given["m"]), int(given["d"]))
    except ValueError:
        return None
    if not FIRST_DAY <= day.toordinal() <= LAST_DAY:
        return None
    days = _days(kind := _day_kind(day))
    new = datetime.date.fromordinal(days[feistel(bisect_left(days, day.toordinal()), len(days), key, f"date{kind}", back)])
    value = {"y": f"{new.year:04d}", "m": str(new.month).zfill(len(given["m"])), "d": str(new.day).zfill(len(given["d"]))}
    return sep.join(value[k] for k in order)


def _permute_letters(s: str, key: bytes, tweak: str, back: bool) -> str:
    """Letters among letters and digits among digits, each place in its own alphabet; case stays."""
    bases = [26 if c.isalpha() else 10 for c in s if c.isascii() and c.isalnum()]
    value, size = 0, 1
    for c, b in zip((c for c in s if c.isascii() and c.isalnum()), bases, strict=True):
        value, size = value * b + (ord(c.lower()) - 97 if b == 26 else int(c)), size * b
    value = feistel(value, size, key, tweak + "".join("a" if b == 26 else "0" for b in bases), back)
    out = []
    for b in reversed(bases):
        value, r = divmod(value, b)
        out.append(chr(97 + r) if b == 26 else str(r))
    it = iter(reversed(out))
    return "".join((n.upper() if c.isupper() else n) if c.isascii() and c.isalnum() and (n := next(it)) else c for c in s)


def email(s: str, key: bytes, back: bool) -> str | None:
    local, _, domain = s.rpartition("@")
    host, dot, top = domain.rpartition(".")
    if not local or not dot or len(local) > 64 or len(domain) > 253:
        return None
    return f"{_permute_letters(local, key, 'local', back)}@{_permute_letters(host, key, 'host', back)}.{top}"


#: Lengths of account numbers by country; others are tried from the longest on.
IBAN_LENGTHS = {
    c: n
    for n, cs in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS VA",
        23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for c in cs.split()
}


def _borders(s: str, longest: int) -> Iterator[list[tuple[int, int]]]:
    """For each start of a group of ``s``, (how many signs, end) up to each end of a group, as far as ``longest``."""
    groups = [(m.start(), m.end()) for m in re.finditer(r"[^ -]+", s)]
    for i, (a, _) in enumerate(groups):
        n, ends = 0, []
        for x, y in groups[i:]:
            n += y - x
            if n > longest:
                break
            ends.append((n, y))
        yield [(0, a), *ends]


def card_windows(s: str) -> Iterator[tuple[int, int]]:
    """What may be a card in a run of digits: from each group on, the longest first."""
    for (_, a), *ends in _borders(s, 19):
        yield from ((a, b) for n, b in reversed(ends) if n >= 13)


def iban_windows(s: str) -> Iterator[tuple[int, int]]:
    """What may be an account number at the start of a run: the length of its country, then the longest first."""
    ends = [(n, b) for n, b in next(_borders(s, 34))[1:] if n >= 15]
    yield from ((0, b) for n, b in sorted(ends, key=lambda e: (e[0] != IBAN_LENGTHS.get(s[:2]), -e[0])))


#: Kinds whose pattern matches a run that may hold more than the value: what to try in it.
WINDOWS = {"iban": iban_windows, "card": card_windows}
#: (kind, pattern, pseudonym). The first pattern that matches at a place and whose value is valid wins.
KINDS = [
    ("email", r"[^\W_][\w.%+-]{0,63}@[^\W_][\w.-]{0,250}\.[A-Za-z]{2,24}(?![A-Za-z0-9])", email),
    ("iban", r"(?<![A-Za-z0-9])(?=([A-Z]{2}\d\d[A-Z0-9]{0,30}(?![A-Za-z0-9])(?: [A-Z0-9]{1,30}(?![A-Za-z0-9])){0,30}))[A-Z]{2}\d\d", iban),
    ("card", r"(?<![\d.-])\d+(?:[ -]\d+)*(?![\d-])", card),
    ("number16", r"(?<![\d.-])(?:\d{16}|\d{4}(?:[ -]\d{4}){3})(?![\d-])", long_number),
    ("phone", r"\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){1,4}(?!\d)|(?<![\d(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])", phone),
    ("domestic", r"(?<![\d.+/-])0[1-9]\d{1,3}[ /-]\d{3,8}(?:[ -]\d{3,6}){0,2}(?![\d/-]|\.\d)", domestic),
    ("national", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", national),
    ("address", r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)", address),
    ("date", r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4})(?![\d/-]|\.\d)", date),
]
#: Any match has an at sign, a digit among five signs of numbers, or the head of an account number; texts without are left at once.
_MAYBE = re.compile(r"@|\d[\d ./()-]{4}|[A-Z]{2}\d\d ?[A-Z]")
_PATTERNS = [(kind, re.compile(p), f) for kind, p, f in KINDS]


def pseudonymise(text: str, key: bytes, back: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
    """(text with pseudonyms, (kind, start, end) of each in the result)."""
    if not _MAYBE.search(text):
        return text, []
    found: list[tuple[int, int, str, Callable]] = []
    refused: list[tuple[int, int, Callable]] = []
    taken: list[tuple[int, int]] = []
    for kind, pattern, change in _PATTERNS:
        if kind == "email" and "@" not in text:
            continue
        last = 0
        for m in pattern.finditer(text):
            if kind not in WINDOWS:
                if not _overlaps(taken, m.start(), m.end()) and change(m[0], key, back) is not None:
                    found.append((m.start(), m.end(), kind, change))
                continue
            run = m[m.lastindex or 0]
            for a, b in WINDOWS[kind](run) if len(run) >= 13 else ():
                a, b = m.start() + a, m.start() + b
                if a < last or _overlaps(taken, a, b):
                    continue
                if change(text[a:b], key, back) is None:
                    refused.append((a, b, change))
                else:
                    found.append((a, b, kind, change))
                    last = b
                    if kind == "iban":
                        break
        taken = sorted((a, b) for a, b, _, _ in found)
    new = _changed(text, found, refused, key, back)
    out, spans, last, size = [], [], 0, 0
    for (a, b, kind, _), value in sorted(zip(found, new, strict=True), key=lambda f: f[0][:2]):
        out += [text[last:a], value]
        size += a - last
        spans.append((kind, size, size + len(value)))
        size += len(value)
        last = b
    return "".join([*out, text[last:]]), spans


def _changed(text: str, found: list[tuple[int, int, str, Callable]], refused: list[tuple[int, int, Callable]], key: bytes, back: bool) -> list[str]:
    """The pseudonym of each value. What was refused near a value has to be refused beside its pseudonym too, or the way back would
    read other values: a value walks on in its cycle until that holds. The way back goes through the values in reverse order."""
    refused = sorted(refused, key=lambda r: r[:2])
    starts, longest = [a for a, _, _ in refused], max((b - a for a, b, _ in refused), default=0)
    chars, new = list(text) if refused else [], [""] * len(found)
    for i in reversed(range(len(found))) if back else range(len(found)):
        a, b, _, change = found[i]
        near = [r for r in refused[bisect_left(starts, a - longest) : bisect_left(starts, b)] if r[1] > a]
        value = change(text[a:b], key, back)
        if near and len(value) == b - a:
            chars[a:b] = value
            while any(f("".join(chars[x:y]), key, back) is not None for x, y, f in near):
                value = change(value, key, back)
                chars[a:b] = value
        new[i] = value
    return new


def _overlaps(taken: list[tuple[int, int]], a: int, b: int) -> bool:
    k = bisect_left(taken, (a, a))
    return (k < len(taken) and taken[k][0] < b) or (k > 0 and taken[k - 1][1] > a)


def pseudonyms(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text", back: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, clean_text, n_found, spans (kind, start, end in ``clean_text``).

    Defined cases: a null text stays null with nothing found; an empty one stays empty. Values that no validator accepts stay as they
    are. Equal texts give equal results. Other columns are not read.
    """

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.slices(batch, "text"):
                rows = [(None, []) if t is None else pseudonymise(t, key, back) for t in part.column("text").to_pylist()]
                kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([t for t, _ in rows], pa.string()), pa.array([len(s) for _, s in rows], pa.int32()), pa.array([[dict(kind=k, start=a, end=b) for k, a, b in s] for _, s in rows], kinds)],
                    names=["doc_id", "clean_text", "n_found", "spans"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(change, "doc_id long, clean_text string, n_found int, spans array<struct<kind: string, start: int, end: int>>")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms(util.documents(spark, sf_dir), DEMO_KEY)
