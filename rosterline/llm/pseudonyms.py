"""Format-preserving pseudonyms: private values are permuted within their format by a keyed Feistel network."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
# The numbering rules of US social security numbers.
SSN_AREAS = [a for a in range(1, 900) if a != 666]
# First and last day of the dates that are permuted among themselves; years
# outside them, from 1000 on, are permuted among those.
NEAR_DATES = (dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal())
FAR_DATES = (dt.date(1000, 1, 1).toordinal(), dt.date(9999, 12, 31).toordinal())


def permute(value: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of 0 .. size - 1; values outside the format are walked past."""
    if size < 2:
        return value
    left_size = math.isqrt(size - 1) + 1
    right_size = -(-size // left_size)
    width = (max(left_size, right_size).bit_length() + 7) // 8
    state = hashlib.blake2b(f"{tweak}:{size}".encode(), key=key[:64], digest_size=32).digest()

    def noise(turn: int, half: int, modulus: int) -> int:
        data = state + bytes([turn]) + half.to_bytes(width, "big")
        size_of = min(64, width + 8)
        out = hashlib.blake2b(data, digest_size=size_of).digest()
        while len(out) < width + 8:
            out += hashlib.blake2b(out + data, digest_size=64).digest()
        return int.from_bytes(out, "big") % modulus

    while True:
        left, right = divmod(value, right_size)
        for turn in range(0, ROUNDS, 2):
            left = (left + noise(turn, right, left_size)) % left_size
            right = (right + noise(turn + 1, left, right_size)) % right_size
        value = left * right_size + right
        if value < size:
            return value


def _class(c: str) -> str:
    """The alphabet a character is permuted in; empty for one that stays."""
    if "0" <= c <= "9":
        return "0123456789"
    if "a" <= c <= "z":
        return "abcdefghijklmnopqrstuvwxyz"
    return "ABCDEFGHIJKLMNOPQRSTUVWXYZ" if "A" <= c <= "Z" else ""


def shuffled(text: str, key: bytes, tweak: str) -> str:
    """Digits become digits and letters letters of the same case; all other characters stay."""
    value, size = 0, 1
    for c in text:
        if alphabet := _class(c):
            value, size = value * len(alphabet) + alphabet.index(c), size * len(alphabet)
    shape = "".join(_class(c)[:1] or c for c in text)
    value = permute(value, size, key, f"{tweak}:{shape}")
    out = []
    for c in reversed(text):
        if alphabet := _class(c):
            value, at = divmod(value, len(alphabet))
            c = alphabet[at]
        out.append(c)
    return "".join(reversed(out))


def _refilled(text: str, digits: str) -> str:
    """text with its digits replaced in order."""
    new = iter(digits)
    return "".join(next(new) if "0" <= c <= "9" else c for c in text)


def luhn_sum(digits: str) -> int:
    """The Luhn checksum; 0 for a valid number."""
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10


def _card(text: str, key: bytes) -> str | None:
    digits = re.sub("[^0-9]", "", text)
    if luhn_sum(digits) or not 13 <= len(digits) <= 19 or len(set(digits)) == 1:
        return None
    body = shuffled(digits[:-1], key, "card")
    return _refilled(text, body + str(-luhn_sum(body + "0") % 10))


def _iban(text: str, key: bytes) -> str | None:
    plain = text.replace(" ", "")
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(plain) <= 34 or number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    body = shuffled(plain[4:], key, "iban:" + plain[:2])
    new = iter(plain[:2] + f"{98 - number(body + plain[:2] + '00') % 97:02d}" + body)
    return "".join(c if c == " " else next(new) for c in text)


def _ssn(text: str, key: bytes) -> str | None:
    area, group, serial = map(int, text.split("-"))
    if area not in (0, 666) and area < 900 and group and serial:
        value = (SSN_AREAS.index(area) * 99 + group - 1) * 9999 + serial - 1
        rest, serial = divmod(permute(value, len(SSN_AREAS) * 99 * 9999, key, "ssn"), 9999)
        return f"{SSN_AREAS[rest // 99]:03d}-{rest % 99 + 1:02d}-{serial + 1:04d}"
    return None


def _ip(text: str, key: bytes) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or p != str(int(p)) for p in parts):
        return None
    value = permute(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, key, "ip")
    return ".".join(map(str, value.to_bytes(4, "big")))


def _phone(text: str, key: bytes) -> str | None:
    """The country code of an international number and the first zero of a national one stay."""
    head = re.match(r"\+\d{1,3}(?=[ .\-(])|\+\d|0(?=[1-9][ .-])", text)
    cut = head.end() if head else 0
    if not 7 <= sum(c.isdigit() for c in text[cut:]) <= 14:
        return None
    digits = re.sub("[^0-9]", "", text[cut:])
    return text[:cut] + _refilled(text[cut:], shuffled(digits, key, "phone:" + text[:cut]))


def permuted_day(day: dt.date, key: bytes) -> dt.date:
    at, (low, high) = day.toordinal(), NEAR_DATES
    if low <= at <= high:
        return dt.date.fromordinal(low + permute(at - low, high - low + 1, key, "date"))
    first, last = FAR_DATES
    at = at - first if at < low else at - first - (high - low + 1)
    at = permute(at, last - first + 1 - (high - low + 1), key, "far date") + first
    return dt.date.fromordinal(at if at < low else at + (high - low + 1))


def _date(text: str, key: bytes) -> str | None:
    """Year first, or day and month in the order that makes a date (month first if both do)."""
    mark = re.search("[^0-9]", text)[0]
    parts = text.split(mark)
    orders = ("ymd",) if len(parts[0]) == 4 else ("dmy", "mdy") if mark == "." else ("mdy", "dmy")
    for order in orders:
        named = dict(zip(order, map(int, parts), strict=True))
        try:
            day = dt.date(named["y"], named["m"], named["d"])
        except ValueError:
            continue
        if day.year < 1000:
            return None
        new = permuted_day(day, key)
        value = {"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
        return mark.join(value[c] for c in order)
    return None


def _email(text: str, key: bytes) -> str:
    """The local part and the domain's labels but the last are permuted; case is folded first."""
    head, _, top = text.rpartition(".")
    return shuffled(head.lower(), key, "email:" + top.lower()) + "." + top


# In this order at each number: kind, what it looks like, its validation and replacement. Only ASCII
# letters and digits join a number: scripts without spaces write theirs directly beside it.
NUMBERS: list[tuple[str, re.Pattern, Callable[[str, bytes], str | None]]] = [
    ("iban", re.compile(r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", re.A), _iban),
    ("date", re.compile(r"\d{4}([-/.])\d{1,2}\1\d{1,2}(?![\w]|[-/.]\d)", re.A), _date),
    ("date", re.compile(r"\d{1,2}([-/.])\d{1,2}\1\d{4}(?![\w]|[-/.]\d)", re.A), _date),
    ("ip", re.compile(r"\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)", re.A), _ip),
    ("ssn", re.compile(r"\d{3}-\d{2}-\d{4}(?!\w|-\d)", re.A), _ssn),
    ("card", re.compile(r"\d(?:\d{11,17}|(?:[ -]?\d){11,17})\d(?![\w]|-\d)", re.A), _card),
    ("card", re.compile(r"\d{13,19}(?![\w]|-\d)", re.A), _card),
    ("card", re.compile(r"\d{4}(?:([ .-])\d{4}(?:\1\d{4}){2}(?:\1\d{1,3})?|([ .-])\d{6}\2\d{4,5})(?!\w)", re.A), _card),
    ("phone", re.compile(r"\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,5}(?![\w])", re.A), _phone),
    ("phone", re.compile(r"\(\d{3}\) ?\d{3}[ .-]\d{4}(?![\w])", re.A), _phone),
    ("phone", re.compile(r"\d{3}([ .-])\d{3}\1\d{4}(?!\w|-\d)", re.A), _phone),
    ("phone", re.compile(r"0[1-9]([ .-])\d{2}(?:\1\d{2}){3}(?!\w|\1\d)", re.A), _phone),
]
DIGITS = re.compile("[0-9]+")
# Letters of the Latin script, which mail addresses may have.
LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
LOCAL = re.compile(rf"[{LATIN}0-9][{LATIN}0-9._%+-]{{0,63}}\Z")
DOMAIN = re.compile(
    rf"[{LATIN}0-9](?:[{LATIN}0-9-]{{0,62}}\.)+[A-Za-z]{{2,24}}(?![{LATIN}0-9])|(?:[{LATIN}0-9-]{{1,63}}\.)+[A-Za-z]{{2,24}}(?![{LATIN}0-9])"
)


def _readings(kind: str, text: str) -> Iterator[str]:
    """What was found and then, for it may hold the words or numbers after a value, its shorter readings.

    They end where a group does, the longest first, down to the shortest that is legal; a card's
    groups, but for the last, have four digits or more.
    """
    yield text
    if kind not in ("iban", "card", "phone"):
        return
    for cut in reversed([m.start() for m in re.finditer(r" " if kind == "iban" else r"[ .-](?=\d)", text)]):
        part = text[:cut]
        if kind == "iban" and len(part.replace(" ", "")) < 15:
            return
        if kind == "card" and min(map(len, re.split(r"[ .-]", part)[:-1]), default=4) < 4:
            continue
        yield part


def _emails(text: str) -> list[tuple[int, int, str]]:
    found, at = [], text.find("@")
    while at >= 0:
        local, domain = LOCAL.search(text[max(0, at - 64) : at]), DOMAIN.match(text, at + 1)
        if local and domain:
            found.append((at - len(local[0]), domain.end(), "email"))
        at = text.find("@", at + 1)
    return found


def _joined(c: str) -> bool:
    return c.isascii() and (c.isalnum() or c == "_")


def pseudonymise(text: str | None, key: bytes) -> tuple[str | None, list[str]]:
    """The text with each validated private value replaced, and the kinds in text order."""
    if not text:
        return text, []
    emails = _emails(text)
    spans = [(s, e, k, _email(text[s:e], key)) for s, e, k in emails]
    taken, nth, done = emails + [(len(text) + 1, len(text) + 1, "")], 0, 0
    for m in DIGITS.finditer(text):
        at = m.start()
        if at < done:
            continue
        while taken[nth][1] <= at:
            nth += 1
        if taken[nth][0] <= at:
            continue
        starts = [at]
        if at and text[at - 1] == "(":
            starts.insert(0, at - 1)
        if at and text[at - 1] == "+":
            starts = [at - 1]
        if at >= 2 and "A" <= text[at - 2] <= "Z" and "A" <= text[at - 1] <= "Z":
            starts = [at - 2]
        for start in starts:
            if start and (_joined(text[start - 1]) or start == at and text[start - 1] in ".-/" and start > 1 and text[start - 2].isdigit()):
                continue
            hit = None
            for kind, look, replace in NUMBERS:
                if (found := look.match(text, start)) and found.end() <= taken[nth][0]:
                    said = ((r, replace(r, key)) for r in _readings(kind, found[0]))
                    hit = next(((start, start + len(r), kind, new) for r, new in said if new is not None), None)
                    if hit:
                        break
            if hit:
                spans.append(hit)
                done = hit[1]
                break
    spans.sort()
    out, last = [], 0
    for start, end, _, new in spans:
        if start >= last:
            out += [text[last:start], new]
            last = end
    return "".join([*out, text[last:]]), [k for _, _, k, _ in spans]


def pseudonyms(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """docs with its text pseudonymised, and `pseudonyms`, the kinds replaced in text order.

    Kinds: email addresses; card numbers (Luhn), IBANs (mod 97), social security numbers, IPv4
    addresses and dates (only values that are valid), international and US phone numbers. A
    number that is followed by other digits or words is read without them too. A
    number is mapped by a keyed permutation of its own format, check digits are computed anew,
    and a date stays a date in the same notation; so equal values get equal pseudonyms in all
    documents and none is made twice. Everything else in a text stays as it was, and so does a
    null or empty text. Whole texts are read. A column called `pseudonyms` is replaced, all
    others stay; repeated rows are treated alike; an empty table gives no rows.
    """
    if not key:
        raise ValueError("a key is needed")

    @F.arrow_udf("struct<text: string, kinds: array<string>>")
    def of(texts: pa.Array) -> pa.Array:
        pairs = [pseudonymise(t.as_py(), key) for t in texts]
        columns = [pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.list_(pa.string()))]
        return pa.StructArray.from_arrays(columns, ["text", "kinds"])

    columns = [c for c in docs.columns if c != "pseudonyms"]
    done = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), of(F.col(f"`{text}`")).alias("new"))
    kept = [(F.col("new.text") if c == text else F.col(f"row.`{c}`")).alias(c) for c in columns]
    return done.select(*kept, F.col("new.kinds").alias("pseudonyms"))
