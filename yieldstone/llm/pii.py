"""Pseudonyms for personal data that keep its format.

A validated value (card number, IBAN, social security number, phone number, IPv4 address, date, e-mail address) is
written as a whole number below the count of values its format has, permuted by a keyed Feistel network on exactly
that range, and written back in the same format with fresh check digits. Equal values get equal pseudonyms in every
document and every run under one key, different values different ones.
"""

from __future__ import annotations

import datetime as dt
import math
import re
from collections.abc import Callable, Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_slices, frugal

ROUNDS = 8
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()

_NUMBERS = re.compile(
    r"(?<![A-Za-z0-9_])(?:"
    r"(?P<iban>[A-Z]{2}[0-9]{2}(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?|[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30})"
    r"|(?P<date>[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}(?:\.[0-9]{1,2}\.|/[0-9]{1,2}/)[0-9]{4})"
    r"|(?P<ssn>[0-9]{3}-[0-9]{2}-[0-9]{4})"
    r"|(?P<ipv4>(?<![0-9]\.)[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.[0-9]))"
    r"|(?P<phone>\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}"
    r"|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|[0-9]{3}([-.])[0-9]{3}\6[0-9]{4})"
    r"|(?P<card>[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\8[0-9]{4}\8[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\9[0-9]{5})"
    r")(?![A-Za-z0-9_])"
)
_EMAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])(?P<local>[A-Za-z0-9._%+-]{1,64}+)@(?P<domain>(?:[A-Za-z0-9-]{1,63}+\.)+[A-Za-z]{2,24})(?![A-Za-z0-9_-])"
)

#: Letters and digits of an IBAN by country, as registered.
IBAN_SIZES = {
    country: size
    for size, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
        26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
        30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
#: Least and most national digits by country code; no code begins another.
PHONE_SIZES = {
    "1": (10, 10), "7": (10, 10), "20": (8, 10), "27": (9, 9), "30": (10, 10), "31": (9, 9), "32": (8, 9), "33": (9, 9), "34": (9, 9),
    "36": (8, 9), "39": (6, 11), "40": (9, 9), "41": (9, 9), "43": (5, 13), "44": (9, 10), "45": (8, 8), "46": (7, 9), "47": (8, 8),
    "48": (9, 9), "49": (5, 11), "51": (8, 9), "52": (10, 10), "54": (10, 11), "55": (10, 11), "56": (9, 9), "57": (10, 10), "60": (8, 10),
    "61": (9, 9), "62": (8, 12), "63": (9, 10), "64": (8, 10), "65": (8, 8), "66": (8, 9), "81": (9, 10), "82": (8, 10), "84": (9, 10),
    "86": (10, 11), "90": (10, 10), "91": (10, 10), "92": (9, 10), "351": (9, 9), "353": (7, 9), "354": (7, 9), "358": (5, 12),
    "359": (8, 9), "380": (9, 9), "385": (8, 9), "386": (8, 8), "420": (9, 9), "421": (9, 9), "852": (8, 8), "886": (8, 9), "966": (8, 9),
    "971": (8, 9), "972": (8, 9),
}


class Feistel:
    """A keyed permutation of 0 .. size - 1, for any size: a network on a * b >= size, walked until inside."""

    def __init__(self, key: bytes):
        self.key = key

    def _mix(self, tweak: bytes, turn: int, value: int, below: int) -> int:
        wide = (below.bit_length() + 71) // 8
        data = tweak + bytes([turn]) + value.to_bytes((value.bit_length() + 7) // 8, "big")
        seed, out = blake2b(data, key=self.key, digest_size=64).digest(), b""
        while len(out) < wide:
            out += seed
            seed = blake2b(seed, key=self.key, digest_size=64).digest()
        return int.from_bytes(out[:wide], "big") % below

    def permute(self, value: int, size: int, tweak: str, inverse: bool = False) -> int:
        if size < 2:
            return value
        a = math.isqrt(size - 1) + 1
        b = -(-size // a)
        label = f"{tweak}/{size}/".encode()
        turns = range(ROUNDS - 1, -1, -1) if inverse else range(ROUNDS)
        while True:
            left, right = divmod(value, b)
            for turn in turns:
                sign = -1 if inverse else 1
                if turn % 2:
                    right = (right + sign * self._mix(label, turn, left, b)) % b
                else:
                    left = (left + sign * self._mix(label, turn, right, a)) % a
            value = left * b + right
            if value < size:
                return value


def luhn_sum(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10


def iban_rest(compact: str) -> int:
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97


def _refill(shape: str, chars: str) -> str:
    """``chars`` in the places of the letters and digits of ``shape``."""
    found = iter(chars)
    return "".join(next(found) if c.isalnum() else c for c in shape)


def _classes(f: Feistel, text: str, tweak: str) -> str:
    """Letters become letters of the same case, digits digits, all permuted as one number in mixed radix."""
    value, size, bases = 0, 1, []
    for c in text:
        low, n = ("0", 10) if c.isdigit() else (("a", 26) if c.islower() else ("A", 26))
        bases.append((ord(low), n))
        value, size = value * n + ord(c) - ord(low), size * n
    value, out = f.permute(value, size, tweak), []
    for low, n in reversed(bases):
        value, digit = divmod(value, n)
        out.append(chr(low + digit))
    return "".join(reversed(out))


def _card(f: Feistel, text: str) -> str | None:
    digits = re.sub("[ -]", "", text)
    if luhn_sum(digits) or len(set(digits)) == 1:
        return None
    body = str(f.permute(int(digits[:-1]), 10 ** (len(digits) - 1), "card")).zfill(len(digits) - 1)
    if len(set(body)) == 1 and luhn_sum(body + body[0]) == 0:  # such a number is no valid one: one step on
        body = str(f.permute(int(body), 10 ** (len(digits) - 1), "card")).zfill(len(digits) - 1)
    return _refill(text, body + str(-luhn_sum(body + "0") % 10))


def _iban(f: Feistel, text: str) -> str | None:
    compact = text.replace(" ", "")
    if not 15 <= len(compact) <= 34 or iban_rest(compact) != 1:
        return None
    body = _classes(f, compact[4:], "iban" + compact[:2])
    return _refill(text, f"{compact[:2]}{98 - iban_rest(compact[:2] + '00' + body):02d}{body}")


def _ssn(f: Feistel, text: str) -> str | None:
    area, group, serial = map(int, text.split("-"))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    at = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    rest, serial = divmod(f.permute(at, 898 * 99 * 9999, "ssn"), 9999)
    area, group = divmod(rest, 99)
    return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def _ipv4(f: Feistel, text: str) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or str(int(p)) != p for p in parts):
        return None
    value = f.permute(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, "ipv4")
    return ".".join(map(str, value.to_bytes(4, "big")))


# Country codes of one and two digits; all others have three.
SHORT_CODES = ("1", "7")
TWO_DIGIT_CODES = (
    "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "53",
    "54", "55", "56", "57", "58", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93", "94",
    "95", "98",
)
#: Codes of plans that dial no zero before national numbers.
NO_TRUNK_ZERO = ("1", "39")


def country_code(digits: str) -> str:
    """The code that an international number begins with, however it is spaced."""
    return digits[:1] if digits[:1] in SHORT_CODES else digits[:2] if digits[:2] in TWO_DIGIT_CODES else digits[:3]


def _phone(f: Feistel, text: str) -> str | None:
    """The country code and a zero dialled before the national number stay, the other digits are permuted.

    What stays follows from the digits alone, so that a number has one pseudonym in whatever way it is written.
    """
    digits = re.sub("[^0-9]", "", text)
    if not 7 <= len(digits) <= 15:
        return None
    code = country_code(digits) if text.startswith("+") else ""
    own = digits[len(code) :]
    zero = "0" if code and code not in NO_TRUNK_ZERO and own.startswith("0") else ""
    own = own[len(zero) :]
    if not own:
        return None
    new = own
    while True:  # a number that doesn't begin with zero goes to one that doesn't
        new = str(f.permute(int(new), 10 ** len(own), "phone")).zfill(len(own))
        if not code or code in NO_TRUNK_ZERO or zero or not new.startswith("0") or len(own) == 1:
            return _refill(text, code + zero + new)


def _read_date(text: str) -> tuple[str, int] | None:
    """The format and the day; two numbers before the year are month/day with slashes if they can be, else day/month."""
    sep = re.search("[^0-9]", text).group()
    parts = text.split(sep)
    wide = "".join("2" if len(p) == 2 else "1" for p in parts if len(p) < 4)
    orders = {"-": ["ymd"], ".": ["dmy"], "/": ["mdy", "dmy"]}[sep]
    if "1" in wide and any(len(p) == 2 and p[0] == "0" for p in parts):
        return None  # one padded, one not
    for order in orders:
        v = dict(zip(order, map(int, parts), strict=True))
        try:
            day = dt.date(v["y"], v["m"], v["d"]).toordinal()
        except ValueError:
            continue
        return (sep + order + ("p" if "1" not in wide else "u"), day) if FIRST_DAY <= day <= LAST_DAY else None
    return None


def _write_date(style: str, day: int) -> str:
    d = dt.date.fromordinal(day)
    pad = 2 if style[4] == "p" else 1
    return style[0].join(f"{d.year:04d}" if c == "y" else str({"m": d.month, "d": d.day}[c]).zfill(pad) for c in style[1:4])


def _date(f: Feistel, text: str) -> str | None:
    """Walks on until the day reads back in the format it is written in, so that no two dates of a format meet."""
    read = _read_date(text)
    if read is None:
        return None
    style, day = read
    while True:
        day = FIRST_DAY + f.permute(day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, "date")
        new = _write_date(style, day)
        if _read_date(new) == (style, day):
            return new


def _email(f: Feistel, found: re.Match) -> str:
    """Letters and digits of the name and of the domain but its last label."""
    name, _, last = found["domain"].rpartition(".")
    parts = []
    for tweak, text in (("name", found["local"]), ("domain", name)):
        chars = "".join(c for c in text if c.isalnum())
        parts.append(_refill(text, _classes(f, chars, tweak)))
    return f"{parts[0]}@{parts[1]}.{last}"


_RULES: dict[str, Callable[[Feistel, str], str | None]] = {
    "iban": _iban, "date": _date, "ssn": _ssn, "ipv4": _ipv4, "phone": _phone, "card": _card,
}


def _borders(text: str) -> list[str]:
    """The text and what is left of it when groups are taken off its end, longest first."""
    return [text, *(text[: m.start()] for m in reversed(list(re.finditer("[ .-]", text))))]


def _iban_cuts(text: str) -> list[str]:
    """What the country's length leaves, else the whole; all that end with a group if the country isn't known."""
    size, cuts = IBAN_SIZES.get(text[:2]), _borders(text)
    return cuts if size is None else [c for c in cuts if len(c.replace(" ", "")) == size] + cuts[:1]


def _phone_cuts(text: str) -> list[str]:
    """First the longest of as many national digits as the country code allows, a leading zero not counted."""
    cuts, bare = _borders(text), re.sub("[^0-9+]", "", text)
    code = next((c for c in PHONE_SIZES if bare.startswith("+" + c)), None)
    if code is None:
        return cuts
    low, high = PHONE_SIZES[code]

    def fits(cut: str) -> bool:
        digits = re.sub("[^0-9]", "", cut)[len(code) :]
        return low <= len(digits) <= high or (code not in ("1", "39") and digits[:1] == "0" and low < len(digits) <= high + 1)

    return [c for c in cuts if fits(c)] + [c for c in cuts if not fits(c)]


#: A pattern may take in groups that follow the value: what may be the value instead, tried in this order.
_CUTS: dict[str, Callable[[str], list[str]]] = {"iban": _iban_cuts, "phone": _phone_cuts}


def replace_pii(text: str, f: Feistel) -> tuple[str, dict[str, int]]:
    """The text with pseudonyms, and how many values of each kind were replaced. Linear in the text."""
    counts: dict[str, int] = {}
    if "@" in text:
        def mail(found: re.Match) -> str:
            counts["email"] = counts.get("email", 0) + 1
            return _email(f, found)

        text = _EMAIL.sub(mail, text)
    out, done, at = [], 0, 0
    while found := _NUMBERS.search(text, at):
        kind = found.lastgroup
        for cut in _CUTS[kind](found.group()) if kind in _CUTS else [found.group()]:
            new = _RULES[kind](f, cut)
            if new is not None:
                break
        else:
            at = found.start() + 1
            continue
        counts[kind] = counts.get(kind, 0) + 1
        out += [text[done : found.start()], new]
        done = at = found.start() + len(cut)
    return ("".join(out) + text[done:] if out else text), counts


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text", result: str = "pii_counts") -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and, in ``result``, a map of kind to number of values replaced.

    A null text stays null with a null map; an empty text, or one without such values, stays as it is with an empty
    map. Repeated rows come out equal. Texts of any length are read whole. All other columns are untouched; a
    column already named like ``result`` is replaced.
    """
    shape = T.StructType([T.StructField("text", T.StringType()), T.StructField("counts", T.MapType(T.StringType(), T.IntegerType()))])

    counts = pa.map_(pa.string(), pa.int32())
    kind = pa.struct([("text", pa.string()), ("counts", counts)])

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        f = Feistel(key)
        for texts in batches:
            done = [pa.array([], kind)]
            for part in byte_slices([pa.RecordBatch.from_arrays([texts], ["text"])], 0):
                new = [(None, None) if x is None else replace_pii(x, f) for x in part[0].to_pylist()]
                found = pa.array([None if n is None else list(n.items()) for _, n in new], counts)
                done.append(pa.StructArray.from_arrays([pa.array([t for t, _ in new], pa.string()), found], fields=list(kind)))
            yield pa.concat_arrays(done)

    return (
        docs.withColumn("__found", F.arrow_udf(frugal(run), shape)(F.col(text)))
        .withColumns({text: F.col("__found.text"), result: F.col("__found.counts")})
        .drop("__found")
    )
