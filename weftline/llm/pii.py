"""Format-preserving Feistel pseudonyms.

Validated numbers and dates are permuted by a keyed Feistel network within their own format, so equal
values get equal pseudonyms in every document and the key's holder can turn them back. A network works
on [0, N) by cycle walking, and walks on until the value is valid again: card numbers keep their Luhn
check, IBANs their mod-97 check, dates their calendar and layout, IPv4 addresses their range.

A value is brought to one form before the network and its layout is restored afterwards, so that it stays
linked however it is written: dates are day numbers (days of the month up to 12 and over 12 are permuted
among themselves, since 17/05/2024 is told from 05/06/2024 by that), phone numbers are country code and
digits whatever stands between them (+49, 0049; the code stays; without one, three, three and four digits are taken
for +1), addresses are in small letters, cards and IBANs without spaces.

kinds: card numbers of 13 to 19 digits with a valid Luhn check, IBAN, US social security numbers, phone
numbers, IPv4, dates from 1900 to 2099 (2024-05-06, 06.05.2024, 05/06/2024), e-mail addresses (letters
stay letters, accented ones too, digits digits, the top-level domain stays), and hexadecimal secrets of 32
to 64 digits. Everything else in a text stays as it is, numbers without a valid check among it.

Defined results: a null text stays null and an empty one empty, each with n_replaced 0; repeated rows
are treated alike; an empty table stays empty; all columns are kept, in order, and `n_replaced` is added,
replacing a column of that name. Texts are processed whole.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ._batch import chunks

ROUNDS = 8
PATTERN = re.compile(
    r"""
    (?P<email>[A-Za-z0-9._%+\-À-ÖØ-öø-ÿ]+@[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?)*\.[A-Za-z]{2,24}(?![A-Za-z0-9]))
  | (?P<hex>(?<![0-9A-Za-z])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![0-9A-Za-z]))
  | (?P<iban>(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:[ ]?[0-9A-Z]{4}){2,7}(?:[ ]?[0-9A-Z]{1,3})?(?![0-9A-Za-z]))
  | (?P<date>(?<![0-9./\-])(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.(?:19|20)[0-9]{2}|[0-9]{2}/[0-9]{2}/(?:19|20)[0-9]{2})(?![0-9/\-]|\.[0-9]))
  | (?P<ip>(?<![0-9.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9]|\.[0-9]))
  | (?P<ssn>(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-]))
  | (?P<phone>(?<![0-9A-Za-z])(?:(?:\+|00)[0-9]{1,3}[ .\-]?)?(?:\([0-9]{2,4}\)[ .\-]?|[0-9]{3}[ .\-])[0-9]{3}[ .\-][0-9]{4}(?![0-9])|(?<![0-9A-Za-z])(?:\+[0-9]{1,3}(?:[ .\-]?[0-9]{2,4}){3,5}|00[1-9][0-9]{0,2}[ .\-][0-9]{2,4}(?:[ .\-]?[0-9]{2,4}){2,4})(?![0-9]))
  | (?P<number>(?<![0-9A-Za-z])[0-9](?:[ \-]?[0-9]){12,18}(?![0-9A-Za-z]))
    """,
    re.X,
)
_DAY0 = datetime.date(1900, 1, 1)
_DAYS = (datetime.date(2100, 1, 1) - _DAY0).days


class Feistel:
    """Keyed permutation of [0, size), by cycle walking over the even number of bits that holds it."""

    def __init__(self, key: bytes, size: int, tweak: str):
        self.size, self.half = size, max(1, (max(size - 1, 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1
        self.base = hashlib.blake2b(tweak.encode(), key=key, digest_size=32).digest()
        self.bytes = (self.half + 7) // 8

    def _f(self, i: int, x: int) -> int:
        out, n = b"", 0
        while len(out) < self.bytes:
            out += hashlib.blake2b(bytes([i, n]) + x.to_bytes(self.bytes, "big"), key=self.base).digest()
            n += 1
        return int.from_bytes(out[: self.bytes], "big") & self.mask

    def _once(self, x: int, back: bool) -> int:
        a, b = x >> self.half, x & self.mask
        if back:
            for i in reversed(range(ROUNDS)):
                a, b = b ^ self._f(i, a), a
        else:
            for i in range(ROUNDS):
                a, b = b, a ^ self._f(i, b)
        return a << self.half | b

    def __call__(self, x: int, back: bool = False, valid=lambda _: True) -> int:
        """The image of x; walks on while the image isn't in the range or isn't valid. x itself has to be valid."""
        if self.size < 2:
            return x
        while True:
            x = self._once(x, back)
            if x < self.size and valid(x):
                return x


def luhn_ok(digits: str) -> bool:
    odd = sum(int(c) for c in digits[-1::-2])
    return (odd + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])) % 10 == 0


def iban_ok(s: str) -> bool:
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _fill(shape: str, symbols: str, at: str) -> str:
    """shape with its characters of the class `at` replaced by symbols, one after another."""
    it = iter(symbols)
    return "".join(next(it) if c in at else c for c in shape)


_DIGITS = "0123456789"
#: Characters of addresses by the class that they are permuted in, in small letters.
_SETS = {c: s for s in ("abcdefghijklmnopqrstuvwxyz", _DIGITS, "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþ", "ßÿ") for c in s}
#: Country codes of one and two digits; all others have three.
_CODES = {"1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "53", "54", "55", "56", "57", "58", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98"}


def country_code(digits: str) -> str:
    return next((digits[:n] for n in (1, 2) if digits[:n] in _CODES), digits[:3])


class Pseudonyms:
    """The replacements under one key."""

    def __init__(self, key: bytes, back: bool = False):
        self.key, self.back = key, back
        self.value = lru_cache(1 << 16)(self._value)
        self.net = lru_cache(4096)(lambda size, tweak: Feistel(key, size, tweak))

    def _digits(self, shape: str, tweak: str, valid=lambda _: True) -> str:
        d = "".join(c for c in shape if c in _DIGITS)
        n = len(d)
        x = self.net(10**n, f"{tweak}:{n}")(int(d), self.back, lambda v: valid(str(v).zfill(n)))
        return _fill(shape, str(x).zfill(n), _DIGITS)

    def _date(self, s: str) -> str:
        sep = s[4] if s[4] in "-" else s[2]
        day_first = False
        try:
            if sep == "-":
                date = datetime.date.fromisoformat(s)
            else:
                a, b, y = (int(x) for x in s.split(sep))
                day_first = sep == "." or a > 12
                date = datetime.date(y, b, a) if day_first else datetime.date(y, a, b)
        except ValueError:
            return s
        late = date.day > 12
        x = self.net(_DAYS, "date")((date - _DAY0).days, self.back, lambda v: ((_DAY0 + datetime.timedelta(v)).day > 12) == late)
        date = _DAY0 + datetime.timedelta(x)
        return date.strftime("%Y-%m-%d" if sep == "-" else f"%d{sep}%m{sep}%Y" if day_first else f"%m{sep}%d{sep}%Y") if date.year >= 1000 else s

    def _iban(self, s: str) -> str:
        bare = s.replace(" ", "")
        if not (15 <= len(bare) <= 34 and iban_ok(bare)):
            return s
        body = self._digits(bare[4:], "iban:" + bare[:2] + re.sub("[0-9]", "9", bare[4:])) if any(c in _DIGITS for c in bare[4:]) else bare[4:]
        check = 98 - int("".join(str(int(c, 36)) for c in body + bare[:2] + "00")) % 97
        it = iter(bare[:2] + f"{check:02d}" + body)
        return "".join(c if c == " " else next(it) for c in s)

    def _email(self, s: str) -> str:
        head, _, top = s.rpartition(".")
        # all but the top-level domain as one mixed-radix number in small letters; what is no letter or digit stays in the tweak
        sets = [_SETS.get(c.lower(), c) for c in head]
        size, x = 1, 0
        for c, symbols in zip(head, sets):
            x = x * len(symbols) + (symbols.index(c.lower()) if len(symbols) > 1 else 0)
            size *= len(symbols)
        shape = "".join(symbols[0] for symbols in sets)
        x = self.net(size, "email:" + shape + "." + top.lower())(x, self.back)
        out = []
        for c, symbols in zip(reversed(head), reversed(sets)):
            x, d = divmod(x, len(symbols))
            new = symbols[d] if len(symbols) > 1 else c
            out.append(new.upper() if c.isupper() else new)
        return "".join(reversed(out)) + "." + top

    def _phone(self, s: str) -> str:
        """The country code stays; the digits behind it are permuted."""
        digits = "".join(c for c in s if c in _DIGITS)
        if s[0] == "+" or s.startswith("00"):
            skip = 0 if s[0] == "+" else 2
            code = country_code(digits[skip:])
            kept = skip + len(code)
        else:
            code, kept = "1" if len(digits) == 10 else "", 0
        if kept >= len(digits):
            return s
        return _fill(s, digits[:kept] + self._digits(digits[kept:], "phone:" + code), _DIGITS)

    def _value(self, kind: str, s: str) -> str:
        if kind == "email":
            return self._email(s)
        if kind == "hex":
            if s.isdigit() or not any(c in _DIGITS for c in s):
                return s
            mixed = lambda h: any(c > "9" for c in h) and any(c <= "9" for c in h)
            x = self.net(16 ** len(s), f"hex:{len(s)}:{s.isupper()}")(int(s, 16), self.back, lambda v: mixed(f"{v:x}".zfill(len(s))))
            return (f"{x:X}" if s.isupper() else f"{x:x}").zfill(len(s))
        if kind == "iban":
            return self._iban(s)
        if kind == "date":
            return self._date(s)
        if kind == "ip":
            o = [int(p) for p in s.split(".")]
            if max(o) > 255:
                return s
            x = self.net(1 << 32, "ip")(o[0] << 24 | o[1] << 16 | o[2] << 8 | o[3], self.back)
            return f"{x >> 24}.{x >> 16 & 255}.{x >> 8 & 255}.{x & 255}"
        if kind == "ssn":
            ok = lambda d: d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"
            return self._digits(s, "ssn", ok) if ok(s.replace("-", "")) else s
        if kind == "phone":
            return self._phone(s)
        digits = re.sub("[^0-9]", "", s)
        if not luhn_ok(digits):
            return s
        body = self._digits(digits[:-1], "card")
        return _fill(s, body + next(c for c in _DIGITS if luhn_ok(body + c)), _DIGITS)

    def text(self, t: str) -> tuple[str, int]:
        out, at, n = [], 0, 0
        for m in PATTERN.finditer(t):
            new = self.value(m.lastgroup, m[0])
            if new != m[0]:
                out += (t[at : m.start()], new)
                at, n = m.end(), n + 1
        return ("".join(out) + t[at:], n) if n else (t, 0)


_MAY = np.zeros(256, np.uint8)
_MAY[48:58] = 1
_MAY[ord("@")] = 1


def pseudonymise(docs: DataFrame, key: bytes, back: bool = False) -> DataFrame:
    """docs with private values in `text` replaced, and n_replaced. back: turns pseudonyms of that key into the values again."""
    src = docs.drop("n_replaced")
    schema = T.StructType([*src.schema.fields, T.StructField("n_replaced", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Pseudonyms(key, back)
        for batch, b, o in chunks(batches):
            i = batch.schema.get_field_index("text")
            column = batch.column(i)
            seen = np.concatenate([[0], np.cumsum(_MAY[b], dtype=np.int64)])
            rows = np.flatnonzero(seen[o[1:]] > seen[o[:-1]])
            counts, mask, new = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, bool), []
            for r in rows:
                t, n = names.text(column[int(r)].as_py())
                if n:
                    counts[r], mask[r] = n, True
                    new.append(t)
            if new:
                column = pc.replace_with_mask(column, pa.array(mask), pa.array(new, column.type))
            columns = [column if j == i else c for j, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts)], names=[*batch.schema.names, "n_replaced"])

    return src.mapInArrow(run, schema)
