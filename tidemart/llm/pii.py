"""Format-preserving pseudonyms for personal numbers and dates, by a keyed Feistel permutation.

A value counts only if it validates: payment cards by length and Luhn digit, IBANs modulo 97, dates by the calendar (1900
to 2099), US social security numbers by their reserved ranges, IPv4 addresses by their octets, telephone numbers by a
country code or the three-three-four layout, e-mail addresses by their syntax, hexadecimal secrets by the label in front.
All else stays as it is: a sixteen-digit number with a wrong check digit is no card. A pattern may take in the word or number
that follows, so an IBAN is cut to the length of its country, a telephone number ends before a date and where its country's
numbers end, and where no end validates the search goes on after the first character.

The value becomes a number below the count N of values of its kind and format, is permuted among them, and is printed in the
layout it had. Check digits are computed anew, so the pseudonym validates too. The permutation depends on the key, the
kind and the format alone: equal values have equal pseudonyms in all documents, also when they are grouped differently,
and no two values share one. F is a Feistel network on two halves of nearly equal range, walked until it falls below N;
the pseudonym of x is F'(F(x) + s mod N) with F' its inverse and a keyed shift s, so that no value stands for itself.

Null texts stay null, empty ones empty. Texts are read whole, by line; no value spans two lines. Rows are judged one by one,
so repeated rows agree; empty tables give empty results; only id and text are read.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
DAYS = datetime.date(2099, 12, 31).toordinal() - FIRST_DAY + 1

CANDIDATE = re.compile(
    r"(?P<email>[A-Za-z0-9][A-Za-z0-9._%+\-]*@(?:[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,24}(?![A-Za-z0-9]))"
    r"|(?P<label>\b(?:token|secret|password|passwd|api[_\-]?key|access[_\-]?key|key)\b[\"']?\s*[=:]\s*[\"']?)"
    r"(?P<secret>[0-9a-fA-F]{16,128})(?![0-9A-Za-z])"
    r"|(?P<iban>(?-i:(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])))"
    r"|(?P<phone>(?<![\w+])\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d(?:[ .\-]?\d){5,12}(?![\d])"
    r"|(?<![\w.\-])(?:\(\d{3}\) ?|\d{3}[.\-])\d{3}[.\-]\d{4}(?![\w\-]))"
    r"|(?P<ip>(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d))"
    r"|(?P<ssn>(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-]))"
    r"|(?P<date>(?<![\w.\-/])(?:\d{4}(?P<d1>[\-/.])\d{1,2}(?P=d1)\d{1,2}|\d{1,2}(?P<d2>[\-/.])\d{1,2}(?P=d2)\d{4})(?:(?=T\d)|(?![\w\-/]|\.\d)))"
    r"|(?P<card>(?<![\w.\-])(?:\d{4}(?P<c1>[ \-])\d{4}(?P=c1)\d{4}(?P=c1)\d{4}|\d{4}(?P<c2>[ \-])\d{6}(?P=c2)\d{5}|\d{13,19})(?![\w\-]|\.\d))", re.I)
POSSIBLE = re.compile(r"[0-9@]")
DATE = re.compile(r"(?:\d{4}([\-/.])\d{1,2}\1\d{1,2}|\d{1,2}([\-/.])\d{1,2}\2\d{4})(?!\d)")

# Characters of an IBAN by country.
IBAN_LENGTH = {country: int(n) for n, countries in (
    entry.split(":") for entry in (
        "15:NO 16:BE 18:DK,FO,FI,GL,NL,SD,FK 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,XK,MN 21:CH,HR,LI,LV "
        "22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA 23:AE,GI,IL,IQ,OM,SO,TL 24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG "
        "25:LY,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM 28:AL,AZ,BY,CY,DO,GT,HU,LB,NI,PL,SV 29:BR,EG,PS,QA,UA "
        "30:JO,KW,MU,YE 31:MT,SC 32:LC 33:RU").split()) for country in countries.split(",")}
# Digits of an international telephone number, country code included, where a country has one length.
PHONE_LENGTH = {"1": 11, "7": 11, "30": 12, "31": 11, "33": 11, "34": 11, "41": 11, "44": 12, "45": 10, "47": 10, "48": 11,
                "61": 11, "90": 12, "91": 12, "351": 12, "380": 12, "420": 12, "421": 12}
COMPLETE = 11  # digits after which, in other countries, a number of three digits or more is a new one


class Pseudonyms:
    """Keyed permutations of any number of values, and the pseudonyms of the kinds above."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32, person=b"pseudonyms").digest()
        self.permute = lru_cache(maxsize=200_000)(self._permute)

    def _round(self, tweak: str, number: int, value: int) -> int:
        data = f"{tweak}|{number}|{value}".encode()
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=64).digest(), "big")

    def _feistel(self, x: int, a: int, b: int, tweak: str, inverse: bool) -> int:
        """One pass over a x b values; the halves take turns, each moved by a keyed function of the other."""
        left, right = divmod(x, b)
        for number in (range(ROUNDS) if not inverse else reversed(range(ROUNDS))):
            sign = -1 if inverse else 1
            if number % 2 == 0:
                left = (left + sign * self._round(tweak, number, right)) % a
            else:
                right = (right + sign * self._round(tweak, number, left)) % b
        return left * b + right

    def _walk(self, x: int, n: int, tweak: str, inverse: bool) -> int:
        a = math.isqrt(n - 1) + 1
        b = -(-n // a)
        while True:
            x = self._feistel(x, a, b, tweak, inverse)
            if x < n:
                return x

    def _permute(self, x: int, n: int, tweak: str) -> int:
        if n < 2:
            return x
        tweak = f"{tweak}|{n}"
        shift = 1 + self._round(tweak, ROUNDS, 0) % (n - 1)
        return self._walk((self._walk(x, n, tweak, False) + shift) % n, n, tweak, True)

    def characters(self, text: str, tweak: str) -> str:
        """Letters become letters and digits digits; case and all other characters stay."""
        value, radixes = 0, []
        for c in text.lower():
            if "0" <= c <= "9" or "a" <= c <= "z":
                radix, digit = (10, ord(c) - 48) if c <= "9" else (26, ord(c) - 97)
                value, radixes = value * radix + digit, [*radixes, radix]
        layout = "".join("d" if r == 10 else "a" for r in radixes)
        value, out = self.permute(value, math.prod(radixes), f"{tweak}|{layout}"), []
        for radix in reversed(radixes):
            value, digit = divmod(value, radix)
            out.append(chr((48 if radix == 10 else 97) + digit))
        return _laid_out(text, "".join(reversed(out)))

    # One method a kind: the pseudonym, or None where the value does not validate.

    def email(self, text: str) -> str | None:
        local, _, domain = text.rpartition("@")
        return f"{self.characters(local, 'email')}@{domain}"

    def secret(self, text: str) -> str | None:
        if not re.search(r"\d", text):
            return None
        value = self.permute(int(text, 16), 16 ** len(text), "secret")
        out = f"{value:0{len(text)}x}"
        return out.upper() if text == text.upper() else out

    def iban(self, text: str) -> str | None:
        plain = text.replace(" ", "").upper()
        if not 15 <= len(plain) <= 34 or plain != text.replace(" ", "") or _mod97(plain) != 1:
            return None
        account = self.characters(plain[4:], f"iban|{plain[:2]}")
        account = account.upper()
        check = 98 - _mod97(f"{plain[:2]}00{account}")
        return _laid_out(text, f"{plain[:2]}{check:02d}{account}")

    def phone(self, text: str) -> str | None:
        digits = re.sub(r"\D", "", text)
        if not 8 <= len(digits) <= 15:
            return None
        code = 0
        if text[0] == "+":
            code = 1 if digits[0] in "17" else min(3, len(re.match(r"\+(\d+)", text)[1]))
            code = code if code < 4 and re.match(r"\+\d{1,3}\D", text) else min(code, 2)
        rest = digits[code:]
        value = self.permute(int(rest), 10 ** len(rest), f"phone|{digits[:code]}|{len(rest)}")
        return _laid_out(text, f"{digits[:code]}{value:0{len(rest)}d}")

    def ip(self, text: str) -> str | None:
        octets = [int(o) for o in text.split(".")]
        if max(octets) > 255:
            return None
        value = self.permute(int.from_bytes(bytes(octets), "big"), 1 << 32, "ip")
        return ".".join(str(o) for o in value.to_bytes(4, "big"))

    def ssn(self, text: str) -> str | None:
        area, group, serial = map(int, text.split("-"))
        if not (0 < area < 900 and area != 666 and group and serial):
            return None
        value = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
        value = self.permute(value, 898 * 99 * 9999, "ssn")
        value, serial = divmod(value, 9999)
        area, group = divmod(value, 99)
        area += 1 + (area >= 665)
        return f"{area:03d}-{group + 1:02d}-{serial + 1:04d}"

    def date(self, text: str) -> str | None:
        separator = re.search(r"\D", text)[0]
        parts = text.split(separator)
        orders = ("ymd",) if len(parts[0]) == 4 else ("dmy",) if separator == "." else ("mdy", "dmy")
        for order in orders:
            named = dict(zip(order, map(int, parts)))
            try:
                day = datetime.date(named["y"], named["m"], named["d"]).toordinal() - FIRST_DAY
            except ValueError:
                continue
            if 0 <= day < DAYS:
                new = datetime.date.fromordinal(FIRST_DAY + self.permute(day, DAYS, "date"))
                values = {"y": new.year, "m": new.month, "d": new.day}
                # A day below ten is written as the text writes numbers below ten: padded or not.
                padded = all(len(p) > 1 for p in parts)
                return separator.join(f"{values[o]:02d}" if padded else str(values[o]) for o in order)
        return None

    def card(self, text: str) -> str | None:
        digits = re.sub(r"\D", "", text)
        if not int(digits) or _luhn(digits[:-1]) != digits[-1]:
            return None
        body = digits[:-1]
        value = self.permute(int(body), 10 ** len(body), f"card|{len(digits)}")
        new = f"{value:0{len(body)}d}"
        return _laid_out(text, new + _luhn(new))


def _luhn(body: str) -> str:
    """The check digit that follows."""
    total = sum(d if i % 2 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(body))))
    return str(-total % 10)


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def _laid_out(text: str, value: str) -> str:
    """The characters of value in the places, and the case, of the ASCII letters and digits of text."""
    new = iter(value)
    return "".join((next(new).upper() if c.isupper() else next(new)) if c.isascii() and c.isalnum() else c for c in text)


def _phone_end(text: str, pseudonyms: Pseudonyms, after: str) -> int:
    """Where the number ends at the latest: before a date, and before a number that follows a complete one."""
    digits = re.sub(r"\D", "", text)
    length = next((PHONE_LENGTH[digits[:n]] for n in (1, 2, 3) if digits[:n] in PHONE_LENGTH), None)
    for gap in re.finditer(r" (?=(\d+))", text):
        before = text[:gap.start()]
        n = sum(map(str.isdigit, before))
        day = DATE.match(text + after, gap.end())
        if n >= 8 and day and pseudonyms.date(day[0]):
            return gap.start()
        pairs = len(gap[1]) < 3 and len(re.search(r"\d*$", before)[0]) < 3
        if n >= (length or COMPLETE) and not pairs or n == length:
            return gap.start()
    return len(text)


def _ends(kind: str, text: str, pseudonyms: Pseudonyms, after: str) -> Iterator[int]:
    """Ends to try, the likeliest first: a value ends with the match, or before a space in it."""
    latest = len(text)
    if kind == "iban":
        places = [i for i, c in enumerate(text, 1) if c != " "]
        length = IBAN_LENGTH.get(text[:2], 99)
        if length < len(places) and text[places[length - 1]] == " ":
            yield places[length - 1]
    elif kind == "phone" and text[0] == "+":
        latest = _phone_end(text, pseudonyms, after)
    yield latest
    if kind == "phone":
        yield from (i for i in range(latest - 1, 0, -1) if text[i] == " ")


def _valid(kind: str, text: str, pseudonyms: Pseudonyms, after: str) -> tuple[int, str] | None:
    """The end of the value in the match, and its pseudonym; None where no end validates."""
    for end in _ends(kind, text, pseudonyms, after):
        new = getattr(pseudonyms, kind)(text[:end])
        if new is not None:
            return end, new
    return None


def replaced(text: str, pseudonyms: Pseudonyms) -> tuple[str, list[dict]]:
    """The text with pseudonyms, and what was found: kind, start and end in the result."""
    if not POSSIBLE.search(text):
        return text, []
    out, found, at = [], [], 0
    for line in text.split("\n"):
        if POSSIBLE.search(line):
            parts, last, start, scan = [], 0, at, 0
            while m := CANDIDATE.search(line, scan):
                kind = m.lastgroup
                valid = _valid(kind, m[kind], pseudonyms, line[m.end():m.end() + 10])
                if valid is None:
                    scan = m.start() + 1
                    continue
                end, new = valid
                parts += [line[last:m.start(kind)], new]
                start += m.start(kind) - last
                found.append({"kind": kind, "start": start, "end": start + len(new)})
                start += len(new)
                last = scan = m.start(kind) + end
            line = "".join([*parts, line[last:]])
        out.append(line)
        at += len(line) + 1
    return "\n".join(out), found


FOUND = "array<struct<kind: string, start: long, end: long>>"
FOUND_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def pseudonymise(docs: DataFrame, secret: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, text (with pseudonyms), found (kind, start, end in the new text)."""

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pseudonyms = Pseudonyms(secret)
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                some = batch.slice(i, 1000)
                done = [(None, []) if t is None else replaced(t, pseudonyms) for t in some.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array([t for t, _ in done], pa.string()), pa.array([f for _, f in done], FOUND_TYPE)],
                    names=["doc_id", "text", "found"])

    thin = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return thin.mapInArrow(replace, f"doc_id {thin.schema['doc_id'].dataType.simpleString()}, text string, found {FOUND}")
