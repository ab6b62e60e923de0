"""Personal data: format-preserving pseudonyms by a keyed Feistel permutation.

A value is found by its form and checked (check digits, ranges, calendar). It is then
read as a number in the mixed radix of its characters' classes, so letters stay letters
and digits digits, and permuted by a Feistel network whose round function is keyed. A
permutation maps equal values to equal pseudonyms in every document, and different
values of one form to different ones. Check digits are recomputed, dates stay dates.
A date with strokes whose first number is above 12 has the day first; its pseudonym has
too, so neither reading gives an output of the other.
"""

from __future__ import annotations

import datetime
import hashlib
import ipaddress
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import lean

ROUNDS = 8
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()

#: The forms that are looked for, in the order in which they are tried.
FORMS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.)+(?:xn--[A-Za-z0-9-]+|[A-Za-z]{2,})(?![A-Za-z0-9-])",
    "private_key": r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----\s*(?:[A-Za-z0-9-]+: [^\n]*\n\s*)*+[A-Za-z0-9+/=\s\\]{16,}+-----END [A-Z0-9 ]*PRIVATE KEY-----",
    "cloud_key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "access_token": r"(?<![A-Za-z0-9])(?:gh[pousr]_[A-Za-z0-9]{36,}+|sk-[A-Za-z0-9_-]{20,}+)",
    "secret": r"(?:(?<![A-Za-z0-9])|(?<=[a-z])(?=[A-Z]))(?i:(?:password|passwd|passphrase|pwd|secret(?:[_-]?access)?(?:[_-]?key)?|token|(?:api|access|private)[_-]?key)[\"']?\s*[=:]\s*)[\"']?[A-Za-z0-9+/_.!@#$%^&*-]{6,}+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "date": r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4})(?![\d/-]|\.\d)",
    "ip6": r"(?<![A-Za-z0-9:.])(?=[0-9A-Fa-f]*:[0-9A-Fa-f]*:)[0-9A-Fa-f:]+(?![A-Za-z0-9:])",
    "ip": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\w+(])(?:\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}|\(\d{2,4}\) ?\d{3,4}[ .-]?\d{3,4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w-])",
    "card": r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])",
}
ANY = re.compile("|".join(f"(?P<{k}>{p})" for k, p in FORMS.items()))
#: Signed web tokens, access tokens as well; sought apart, so that a run of their characters is read once.
WEB_TOKEN = re.compile(r"eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+")
TOKEN_RUN, TOKEN_BEFORE = re.compile(r"[A-Za-z0-9_-]+"), re.compile(r"(?<![A-Za-z0-9])eyJ")
#: A value of any form has one of these, a digit of another script, or the name of a secret; most texts have none.
MARKS = (*"0123456789@", "AKIA", "ASIA", "PRIVATE KEY", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-", "eyJ", "::")

DIGIT = re.compile(r"\d")
NAMED = re.compile(r"(?i:passw|passphrase|pwd|secret|token|(?:api|access|private)[_-]?key)")
#: Characters of a long value that are permuted as one number.
BLOCK = 8192

_CLASSES = [(ord("0"), 10), (ord("a"), 26), (ord("A"), 26)]
_CLASS = {chr(low + k): (low, size) for low, size in _CLASSES for k in range(size)}


def blocks(text: str) -> Iterator[tuple[int, str, str]]:
    """(place, block, mark) of a long value; the mark depends on all blocks before, so the whole stays a permutation."""
    before = hashlib.blake2b(digest_size=16)
    for a in range(0, len(text), BLOCK):
        yield a, text[a : a + BLOCK], f"|{a}|{before.hexdigest()}" if a else ""
        before.update(text[a : a + BLOCK].encode("utf-8", "surrogatepass"))


class Pseudonyms:
    """Keyed permutations of integers, strings, and checked values."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def permute(self, value: int, size: int, tweak: str) -> int:
        """A permutation of 0..size-1: a Feistel network on a grid of at least that size, walked until inside."""
        if size < 2:
            return value
        rows = 1 << (size.bit_length() + 1) // 2
        columns = -(-size // rows)
        while True:
            left, right = divmod(value, columns)
            for r in range(0, ROUNDS, 2):
                left = (left + self._round(tweak, r, right, rows)) % rows
                right = (right + self._round(tweak, r + 1, left, columns)) % columns
            value = left * columns + right
            if value < size:
                return value

    def _round(self, tweak: str, r: int, half: int, size: int) -> int:
        n = size.bit_length() // 8 + 9  # 64 bits more than the size needs
        return int.from_bytes(hashlib.shake_128(self.key + f"{tweak}|{r}|{half:x}".encode()).digest(n), "big") % size

    def string(self, text: str, tweak: str, fixed: Callable[[int], bool] = lambda k: False) -> str:
        """Letters and digits permuted within their classes; all else, and what is ``fixed``, stays."""
        if len(text) > BLOCK:
            return "".join(self.string(x, f"{tweak}{mark}", lambda k, a=a: fixed(a + k)) for a, x, mark in blocks(text))
        own = [k for k, c in enumerate(text) if c in _CLASS and not fixed(k)]
        form, value, size = list(text), 0, 1
        for k in own:
            low, n = _CLASS[text[k]]
            value, size = value * n + ord(text[k]) - low, size * n
            form[k] = f"<{n}{chr(low)}>"
        form = "".join(form)
        value = self.permute(value, size, f"{tweak}|{form}")
        out = list(text)
        for k in reversed(own):
            low, n = _CLASS[text[k]]
            value, d = divmod(value, n)
            out[k] = chr(low + d)
        return "".join(out)

    def digits(self, text: str, tweak: str, last: int) -> str:
        """The digits of a text permuted, but for the ``last`` ones."""
        places = [k for k, c in enumerate(text) if c.isdigit()]
        places = places[: len(places) - last]
        new = self.permute(int("".join(text[k] for k in places)), 10 ** len(places), f"{tweak}|{len(places)}")
        out = list(text)
        for k, c in zip(places, f"{new:0{len(places)}d}"):
            out[k] = c
        return "".join(out)


def luhn(digits: str) -> int:
    """The Luhn sum modulo 10; 0 where the last digit is the right check digit."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10


def iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def _card(p: Pseudonyms, text: str) -> str | None:
    digits = re.sub(r"\D", "", text)
    if luhn(digits) or len(set(digits)) == 1:
        return None
    out = p.digits(text, "card", 1)
    return out[:-1] + str(-luhn(re.sub(r"\D", "", out[:-1]) + "0") % 10)


def _iban(p: Pseudonyms, text: str) -> str | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or iban_rest(plain) != 1:
        return None
    new = p.string(plain, "iban", lambda k: k < 4)
    new = iter(new[:2] + f"{98 - iban_rest(new[:2] + '00' + new[4:]):02d}" + new[4:])
    return "".join(c if c == " " else next(new) for c in text)


def _date(p: Pseudonyms, text: str) -> str | None:
    parts = re.split(r"([./-])", text)
    a, sign, b, _, c = parts
    y, m, d = (a, b, c) if sign == "-" else (c, b, a) if sign == "." else (c, a, b)
    swapped = False
    try:
        day = datetime.date(int(y), int(m), int(d))
    except ValueError:
        if sign != "/":
            return None
        try:
            day, swapped = datetime.date(int(y), int(d), int(m)), True
        except ValueError:
            return None
    if not FIRST_DAY <= day.toordinal() <= LAST_DAY:
        return None
    n = day.toordinal() - FIRST_DAY
    while True:  # on to a day that is written in as many digits and read in the same order
        n = p.permute(n, LAST_DAY - FIRST_DAY + 1, "date")
        new = datetime.date.fromordinal(FIRST_DAY + n)
        if sign == "-":
            return f"{new.year:04d}-{new.month:02d}-{new.day:02d}"
        first, second = (new.day, new.month) if sign == "." or swapped else (new.month, new.day)
        out = f"{first:0{len(a)}d}{sign}{second:0{len(b)}d}{sign}{new.year:04d}"
        if len(out) == len(text) and (not swapped or new.day > 12):
            return out


def _ip(p: Pseudonyms, text: str) -> str | None:
    octets = [int(x) for x in text.split(".")]
    if max(octets) > 255 or any(x != str(int(x)) for x in text.split(".")) or octets[0] in (0, 10, 127) or octets[0] > 223:
        return None  # no address, or one that names no host of its own
    value = (octets[0] << 24) | (octets[1] << 16) | (octets[2] << 8) | octets[3]
    while True:
        value = p.permute(value, 1 << 32, "ip")
        if (value >> 24) not in (0, 10, 127) and value >> 24 <= 223:
            return ".".join(str(value >> s & 255) for s in (24, 16, 8, 0))


def _ip6(p: Pseudonyms, text: str) -> str | None:
    """The 16-bit groups that aren't 0 are permuted; those that are stay, so the short form stays as short."""
    try:
        value = ipaddress.IPv6Address(text)
    except ValueError:
        return None
    groups = [int(g, 16) for g in value.exploded.split(":")]
    own = [k for k, g in enumerate(groups) if g]
    if len(own) < 2 or not _names_a_host(groups):
        return None
    n, size = 0, 1
    for k in own:
        n, size = n * 0xFFFF + groups[k] - 1, size * 0xFFFF
    while True:
        n = p.permute(n, size, f"ip6|{','.join(map(str, own))}")
        rest = n
        for k in reversed(own):
            rest, g = divmod(rest, 0xFFFF)
            groups[k] = g + 1
        if _names_a_host(groups):
            break
    new = ipaddress.IPv6Address(":".join(f"{g:x}" for g in groups))
    out = new.compressed if "::" in text else new.exploded if all(len(g) == 4 for g in text.split(":")) else ":".join(f"{g:x}" for g in groups)
    return out.upper() if any(c.isupper() for c in text) else out


def _names_a_host(groups: list[int]) -> bool:
    """Not multicast, nor an address of the link."""
    return groups[0] >> 8 != 0xFF and groups[0] & 0xFFC0 != 0xFE80


def _ssn(p: Pseudonyms, text: str) -> str | None:
    sound = lambda t: t[:3] not in ("000", "666") and t[0] != "9" and t[4:6] != "00" and t[7:] != "0000"
    if not sound(text):
        return None
    while True:
        text = p.digits(text, "ssn", 0)
        if sound(text):
            return text


def _phone(p: Pseudonyms, text: str) -> str | None:
    if not 7 <= sum(c.isdigit() for c in text) <= 15:
        return None
    country = re.match(r"\+\d{1,3}(?=[ .(-])", text)
    at = country.end() if country else 2 if text[0] == "+" else 0
    return text[:at] + p.digits(text[at:], "phone", 0)


def _email(p: Pseudonyms, text: str) -> str:
    top, marks = text.rindex("."), {m.start() + k for m in re.finditer(r"(?i)(?<=[@.])xn--", text) for k in range(4)}
    return p.string(text, "email", lambda k: k > top or k in marks)


def _digitless(name: str, value: str) -> bool:
    """Whether a value without digits is a secret: quoted, set by a bare "=", long, or of more than letters of one case."""
    letters = value.rstrip(".!")
    odd = any(not c.isalpha() and c not in ".-" for c in letters) or any(a.islower() and b.isupper() for a, b in zip(letters, letters[1:]))
    return name[-1] in "\"'" or name.rstrip("\"'").endswith("=") and " " not in name or len(letters) >= 16 or odd and len(letters) >= 8


def _secret(p: Pseudonyms, text: str) -> str | None:
    at = re.match(r"[^=:]+[=:]\s*[\"']?", text).end()
    value = text[at:]
    if not any(c.isdigit() for c in value) and not _digitless(text[:at], value):
        return None  # a word after "token:" is no secret
    if re.fullmatch(r"[0-9a-f]+", value):
        n = len(value)
        return text[:at] + "".join(f"{p.permute(int(x, 16), 16 ** len(x), f'hex|{n}{mark}'):0{len(x)}x}" for _, x, mark in blocks(value))
    return text[:at] + p.string(value, "secret")


def _cloud_key(p: Pseudonyms, text: str) -> str:
    return text[:4] + p.string(text[4:], "cloud_key")


def _access_token(p: Pseudonyms, text: str) -> str:
    return text[:3] + p.string(text[3:], "access_token")


def _private_key(p: Pseudonyms, text: str) -> str:
    a, b = text.index("KEY-----") + 8, text.index("-----END")
    a += re.match(r"\s*(?:[A-Za-z0-9-]+: [^\n]*\n\s*)*", text[a:b]).end()  # lines that say how the key is kept
    return text[:a] + "".join(p.string(x, "private_key") if k % 2 == 0 else x for k, x in enumerate(re.split(r"(\s+|\\[nr])", text[a:b]))) + text[b:]


_RULES = {"email": _email, "private_key": _private_key, "cloud_key": _cloud_key, "access_token": _access_token, "secret": _secret, "iban": _iban, "date": _date, "ip6": _ip6, "ip": _ip, "ssn": _ssn, "phone": _phone, "card": _card}


@lru_cache(maxsize=4)
def pseudonyms(key: bytes) -> Pseudonyms:
    return Pseudonyms(key)


def _web_token(text: str, at: int) -> re.Match | None:
    """The next signed web token. Where the first start in a run of its characters fails, later ones fail alike."""
    while m := TOKEN_BEFORE.search(text, at):
        if token := WEB_TOKEN.match(text, m.start()):
            return token
        at = TOKEN_RUN.match(text, m.start()).end()
    return None


def _in_script(rule: Callable[[Pseudonyms, str], str | None], p: Pseudonyms, text: str) -> str | None:
    """A rule applied to ASCII digits, its result in the digits of the text's own script."""
    if text.isascii() or not (other := [c for c in text if c.isdecimal() and not c.isascii()]):
        return rule(p, text)
    new = rule(p, "".join(str(unicodedata.decimal(c)) if c.isdecimal() else c for c in text))
    zero = ord(other[0]) - unicodedata.decimal(other[0])
    return new and "".join(chr(zero + int(c)) if c in "0123456789" else c for c in new)


def replace_in(text: str, p: Pseudonyms) -> tuple[str, list[tuple[str, int, int, str]]]:
    """The text with pseudonyms, and (kind, start, stop, pseudonym) by place in the old text."""
    if not any(m in text for m in MARKS) and (text.isascii() or not DIGIT.search(text)) and not (("=" in text or ":" in text) and NAMED.search(text)):
        return text, []
    out, found, at, scan = [], [], 0, 0
    token = _web_token(text, 0)
    m = ANY.search(text)
    while m or token:
        if token and token.start() < scan:
            token = _web_token(text, scan)
            continue
        if m and m.start() < scan:
            m = ANY.search(text, scan)
            continue
        if token and (not m or token.start() < m.start() or token.start() == m.start() and m.lastgroup not in ("email", "private_key", "cloud_key")):
            new = _access_token(p, token.group())
            out += [text[at : token.start()], new]
            found.append(("access_token", token.start(), token.end(), new))
            at = scan = token.end()
            continue
        new = _in_script(_RULES[m.lastgroup], p, m.group())
        if new is None:  # another form may start within it
            scan = m.start() + 1
            while scan < m.end() and text[scan].isalnum() and text[scan - 1].isalnum():
                scan += 1
            continue
        out += [text[at : m.start()], new]
        found.append((m.lastgroup, m.start(), m.end(), new))
        at = scan = m.end()
    return "".join(out) + text[at:], found


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("pseudonym", pa.string())]))


def pseudonymise(df: DataFrame, key: bytes, text: str = "text", into: str = "spans") -> DataFrame:
    """All columns of ``df`` with pseudonyms in ``text``, and the replaced spans in ``into``.

    A null text stays null and an empty one empty, with no spans. Rows are taken one by one,
    so repeated rows stay and equal values get equal pseudonyms in all of them. A column
    that already has the name ``into`` is replaced. An empty table gives an empty one.
    """
    kept = [c for c in df.columns if c != into]
    rows = df.select(*kept)
    at = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pseudonyms(key)
        for batch in batches:
            new, spans = [], []
            for t in batch.column(at).to_pylist():
                t, found = (None, []) if t is None else replace_in(t, p)
                new.append(t)
                spans.append([{"kind": k, "start": a, "stop": b, "pseudonym": v} for k, a, b, v in found])
            columns = [*batch.columns, pa.array(spans, _SPANS)]
            columns[at] = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, into])

    span = T.StructType().add("kind", "string").add("start", "long").add("stop", "long").add("pseudonym", "string")
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in rows.schema.fields]]).add(into, T.ArrayType(span))
    return rows.mapInArrow(lean(run), schema)
