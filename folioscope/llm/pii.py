"""Format-preserving pseudonyms: validated numbers and dates, permuted within their format by a keyed Feistel network.

A value is recognised by its format and validated (Luhn, modulo 97, number-plan and calendar rules).
Its digits are read as a number of the format's domain, which a keyed Feistel network permutes; when
the result is not of the domain, the permutation is applied again (cycle walking). Punctuation and
letter case stay, check digits are computed anew. The permutation depends on the key and the format
alone, so equal values have equal pseudonyms in all documents, different values different ones, and
the key's holder can invert it (``restore``). A phone number's last ten digits are one domain, whatever
its punctuation and country code, so all spellings of a number stay linked; numbers of the North American
plan stay valid. A day is one value in all spellings (year first, day first, or month first where only that is a date); a
card is one value with and without groups. Accounts are read in either case. An IPv6 address is permuted as a number and written in
its normal form.

The key has no default: callers pass it. ``session_key`` reads it from ``spark.folioscope.pseudonym.key``;
where that is unset it draws one for the run, which nobody keeps, so pseudonyms are linked within the run
and can't be inverted.

Mail addresses keep their domain; their local part's letters and digits are permuted the same way, as one value
whatever numbers or dates it holds. By the standard a local part has 64 characters at most and a label 63; what is
longer is no address and isn't touched.

Defined results: null text stays null and has no spans; empty text stays empty; an empty table gives no
rows; repeated rows get equal pseudonyms; a very long text is scanned once from its start to its end; a number that fails
its validation isn't touched. Of a card or account with further groups of digits or capitals behind it
only its own groups are replaced: those up to the first end, or the end of the country's length, that is valid. Extra columns are carried along; an output (or
``pii_found``) replaces a column of its name.
"""

from __future__ import annotations

import hashlib
import ipaddress
import logging
import re
import secrets
from datetime import date, timedelta
from functools import lru_cache
from math import isqrt

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm.common import fields, make_room, table

KEY_SETTING = "spark.folioscope.pseudonym.key"
ROUNDS = 8
FIRST_DAY, LAST_DAY = date(1900, 1, 1), date(2099, 12, 31)

FIND = re.compile(
    r"""(?P<email>(?<![\w.+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,63}(?![\w-]))
    |(?P<iban>(?<!\w)[A-Za-z]{2}\d{2}(?:\x20?[A-Za-z0-9]{4}){2,7}(?:\x20?[A-Za-z0-9]{1,3})?(?!\w))
    |(?P<ip6>(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:]|\.\d))
    |(?P<iso>(?<![\w-])\d{4}[-/.](?:0[1-9]|1[0-2])[-/.](?:0[1-9]|[12]\d|3[01])(?![\w-]))
    |(?P<dmy>(?<![\w.-])(?:0[1-9]|[12]\d|3[01])(?P<between>[-/.])(?:0[1-9]|[12]\d|3[01])(?P=between)\d{4}(?![\w-]))
    |(?P<ip>(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d))
    |(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))
    |(?P<phone>(?<![\w+])(?:\+\d{1,3}[\x20.-]?)?(?:\(\d{3}\)\x20?|\d{3}[\x20.-])\d{3}[\x20.-]\d{4}(?!\w)|(?<![\w+])\+\d{8,15}(?!\w))
    |(?P<card>(?<![\w.-])\d(?:[\x20-]?\d){12,18}(?![\w-]))""",
    re.VERBOSE | re.ASCII,
)
DIGIT = re.compile(r"[0-9]")
NAMES = ("email", "iban", "ip6", "iso", "dmy", "ip", "ssn", "phone", "card")


class Permutation:
    """A keyed permutation of 0 to size-1: an alternating Feistel network on two parts, with cycle walking."""

    def __init__(self, key: bytes, tweak: str, size: int):
        self.size = size
        self.left = isqrt(size - 1) + 1 if size > 1 else 1
        self.right = -(-size // self.left)
        self.state = hashlib.blake2b(tweak.encode() + size.to_bytes(48, "big"), key=hashlib.sha256(key).digest(), digest_size=32)

    def _round(self, i: int, half: int) -> int:
        state = self.state.copy()
        state.update(i.to_bytes(1, "big") + half.to_bytes(48, "big"))
        return int.from_bytes(state.digest(), "big")

    def _once(self, x: int, back: bool) -> int:
        a, b = divmod(x, self.right)
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if i % 2:
                b = (b + sign * self._round(i, a)) % self.right
            else:
                a = (a + sign * self._round(i, b)) % self.left
        return a * self.right + b

    def apply(self, x: int, belongs=None, back: bool = False) -> int:
        """The image of x; with ``belongs``, of the permutation of that subset."""
        while True:
            x = self._once(x, back)
            if x < self.size and (belongs is None or belongs(x)):
                return x


@lru_cache(maxsize=4096)
def _permutation(key: bytes, tweak: str, size: int) -> Permutation:
    return Permutation(key, tweak, size)


def luhn(digits: str) -> bool:
    total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def _put_digits(pattern: str, digits: str) -> str:
    """``pattern`` with its digits replaced in order."""
    new = iter(digits)
    return DIGIT.sub(lambda _: next(new), pattern)


def _check_digit(body: str) -> int:
    """The digit that makes ``body`` valid when it is put behind it."""
    total = sum(int(d) if i % 2 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(body)))
    return -total % 10


def _mixed(digits: str) -> bool:
    """No valid number of 13 digits or more at the start of ``digits`` is one digit repeated."""
    return not any(len(set(digits[:n])) == 1 and luhn(digits[:n]) for n in range(13, len(digits) + 1))


def _card_digits(digits: str, key: bytes, back: bool) -> str:
    """The digits of a card's pseudonym: valid at exactly the lengths from 13 on at which the card's digits are.

    From the thirteenth on a digit is told as its distance from the check digit of what stands before it, which is 0 where
    the number could end. Zeros stay and the rest is permuted, so where a card ends doesn't depend on its grouping. A longer
    number that begins with a valid one of 16 digits keeps those linked with that card; only what is behind them is permuted besides.
    """
    known = 16 if len(digits) > 16 and luhn(digits[:16]) else 0
    head = _card_digits(digits[:16], key, back) if known else digits[0]
    places = range(known or 1, len(digits))
    steps = [(int(digits[i]) - (_check_digit(digits[:i]) if i >= 12 else 0)) % 10 for i in places]
    bases = [10 if i < 12 else 9 if step else 1 for i, step in zip(places, steps)]
    x, size = 0, 1
    for base, step in zip(bases, steps):
        size *= base
        x = x * base + (step - 1 if base == 9 else step)

    def write(x: int) -> str:
        at = []
        for base in reversed(bases):
            x, digit = divmod(x, base)
            at.append(digit + 1 if base == 9 else digit)
        new = head
        for i, step in zip(places, reversed(at)):
            new += str((step + (_check_digit(new) if i >= 12 else 0)) % 10)
        return new

    source = (head if back else digits[:16]) if known else digits[0]
    tweak = f"card {source} {''.join('0' if base == 1 else '1' for base in bases)}"
    return write(Permutation(key, tweak, size).apply(x, lambda y: _mixed(write(y)), back))


def _card(value: str, key: bytes, back: bool) -> str | None:
    digits = "".join(DIGIT.findall(value))
    if not 13 <= len(digits) <= 19 or not luhn(digits) or not _mixed(digits):
        return None
    new = _card_digits(digits, key, back)
    return new and _put_digits(value, new)


def _plan(digits: str) -> bool:
    """North American number plan: area and exchange begin with 2 to 9 and don't end in 11."""
    return digits[0] >= "2" and digits[3] >= "2" and digits[1:3] != "11" and digits[4:6] != "11"


def _phone(value: str, key: bytes, back: bool) -> str | None:
    digits = "".join(DIGIT.findall(value))
    if not 8 <= len(digits) <= 15:
        return None
    n = 10 if len(digits) >= 10 else len(digits) - 1  # shorter ones keep their first digit, a part of the country code
    lead, rest = digits[:-n], digits[-n:]
    same = (lambda x: _plan(f"{x:010d}") == _plan(rest)) if n == 10 else None
    return _put_digits(value, lead + f"{_permutation(key, 'phone', 10**n).apply(int(rest), same, back):0{n}d}")


def _social(x: int) -> bool:
    area, group, serial = x // 1_000_000, x // 10_000 % 100, x % 10_000
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


def _ssn(value: str, key: bytes, back: bool) -> str | None:
    x = int(value.replace("-", ""))
    return _put_digits(value, f"{_permutation(key, 'ssn', 10**9).apply(x, _social, back):09d}") if _social(x) else None


def _ip(value: str, key: bytes, back: bool) -> str | None:
    parts = value.split(".")
    if any(int(p) > 255 or p != str(int(p)) for p in parts):
        return None
    x = _permutation(key, "ip", 1 << 32).apply(int.from_bytes(bytes(map(int, parts)), "big"), None, back)
    return ".".join(map(str, x.to_bytes(4, "big")))


def _ip6(value: str, key: bytes, back: bool) -> str | None:
    try:
        address = ipaddress.IPv6Address(value)
    except ValueError:
        return None
    if not int(address) >> 16:  # unspecified, loopback, and what may as well be punctuation
        return None
    return str(ipaddress.IPv6Address(_permutation(key, "ip6", 1 << 128).apply(int(address), lambda x: x >> 16 > 0, back)))


def _day(year: str, month: str, day: str, key: bytes, back: bool) -> date | None:
    """The pseudonym of a day. Days after the twelfth stay such days, so every spelling is read in the same order again."""
    try:
        found = date(int(year), int(month), int(day))
    except ValueError:
        return None
    if not FIRST_DAY <= found <= LAST_DAY:
        return None
    n = (LAST_DAY - FIRST_DAY).days + 1
    same = lambda x: ((FIRST_DAY + timedelta(x)).day > 12) == (found.day > 12)
    return FIRST_DAY + timedelta(_permutation(key, "date", n).apply((found - FIRST_DAY).days, same, back))


def _iso(value: str, key: bytes, back: bool) -> str | None:
    new = _day(value[:4], value[5:7], value[8:], key, back) if value[4] == value[7] else None
    return new and f"{new:%Y}{value[4]}{new:%m}{value[7]}{new:%d}"


def _dmy(value: str, key: bytes, back: bool) -> str | None:
    """Day first; month first where only that is a date."""
    a, b, year = value[:2], value[3:5], value[6:]
    day_first = int(b) <= 12
    new = _day(year, b if day_first else a, a if day_first else b, key, back)
    if new is None:
        return None
    first, second = (f"{new:%d}", f"{new:%m}") if day_first else (f"{new:%m}", f"{new:%d}")
    return f"{first}{value[2]}{second}{value[5]}{new:%Y}"


def _by_class(value: str, tweak: str, key: bytes, back: bool) -> str:
    """Digits, small letters and capitals permuted jointly, each position within its class."""
    bases = [(48, 10) if c.isdigit() else (97, 26) if c.islower() else (65, 26) if c.isupper() else None for c in value]
    size, x = 1, 0
    for c, base in zip(value, bases):
        if base:
            size *= base[1]
            x = x * base[1] + ord(c) - base[0]
    if size == 1:
        return value
    shape = "".join("0" if b == (48, 10) else "a" if b == (97, 26) else "A" if b else c for c, b in zip(value, bases))
    x = _permutation(key, f"{tweak} {shape}", size).apply(x, None, back)
    out = list(value)
    for i in reversed(range(len(value))):
        if bases[i]:
            x, digit = divmod(x, bases[i][1])
            out[i] = chr(bases[i][0] + digit)
    return "".join(out)


def _email(value: str, key: bytes, back: bool) -> str:
    local, _, domain = value.partition("@")
    return f"{_by_class(local, 'email', key, back)}@{domain}"


def _mod97(account: str) -> int:
    return int("".join(str(int(c, 36)) for c in account)) % 97


def _iban(value: str, key: bytes, back: bool) -> str | None:
    plain = value.replace(" ", "").upper()
    if not 15 <= len(plain) <= 34 or _mod97(plain[4:] + plain[:4]) != 1:
        return None
    body = _by_class(plain[4:], f"iban {plain[:2]}", key, back)
    check = 98 - _mod97(body + plain[:2] + "00")
    new = iter(plain[:2] + f"{check:02d}" + body)
    return "".join(c if c == " " else next(new).lower() if c.islower() else next(new) for c in value)


MAKE = {"email": _email, "iban": _iban, "ip6": _ip6, "iso": _iso, "dmy": _dmy, "ip": _ip, "ssn": _ssn, "phone": _phone, "card": _card}


#: Every value holds a digit or an at sign; these are rare in text and quick to find.
ANCHOR = re.compile(r"(?<![0-9])[0-9]|@", re.ASCII)
BEFORE_AT = re.compile(r"[A-Za-z0-9._%+-]{1,64}@", re.ASCII)
LOCAL_PART = re.compile(r"[A-Za-z0-9._%+-]{1,64}\Z", re.ASCII)


def _starts(text: str, anchor: int):
    """Positions where a value with this first digit or at sign can begin."""
    if text[anchor] == "@":
        local = LOCAL_PART.search(text, max(0, anchor - 64), anchor)
        if local:
            yield local.start()
        return
    # a mail address goes before what its local part may hold
    if BEFORE_AT.match(text, anchor) and (local := LOCAL_PART.search(text, max(0, anchor - 64), anchor)):
        if (match := FIND.match(text, local.start())) and match["email"]:
            yield local.start()
    if anchor >= 2 and text[anchor - 2 : anchor].isalpha():
        yield anchor - 2
    if ":" in text[max(0, anchor - 3) : anchor + 5]:
        start = anchor
        while start and start > anchor - 40 and text[start - 1] in "0123456789abcdefABCDEF:":
            start -= 1
        yield start
    if text[anchor - 1 : anchor] in ("+", "("):
        yield anchor - 1
    yield anchor


#: Lengths of the account numbers of each country.
IBAN_LENGTHS = {
    c: int(n)
    for n, countries in (x.split(":") for x in (
        "15:NO 16:BE 18:DK,FI,FK,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,HR,LI,LV 22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA "
        "23:AE,GI,IL,IQ,OM,SO,TL 24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:LY,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM "
        "28:AL,AZ,BY,CY,DO,GT,HU,LB,NI,PL,SV 29:BR,EG,PS,QA,UA 30:JO,KW,MU 31:MT,SC 32:LC 33:RU"
    ).split())
    for c in countries.split(",")
}


def _ends(kind: str, value: str) -> list[int]:
    """Where a match can end, in the order of trial: its own end, and for cards and accounts those of its groups.

    A card is tried from the shortest on, so what stands behind it has no say in where it ends; an
    account at its country's length, then from the longest on.
    """
    if kind not in ("card", "iban"):
        return [len(value)]
    ends = [i for i, c in enumerate(value) if c in " -"] + [len(value)]
    own = IBAN_LENGTHS.get(value[:2].upper())
    return ends if kind == "card" else sorted(ends, key=lambda e: (e - value.count(" ", 0, e) != own, -e))


def _value_at(text: str, start: int, key: bytes, back: bool) -> tuple[str, int, str] | None:
    """(kind, end, replacement) of the valid value that begins at ``start``."""
    for pattern in (FIND, FIND_CARD):
        if start >= 0 and (match := pattern.match(text, start)):
            kind = next(n for n in NAMES if match.re is FIND_CARD and n == "card" or match.re is FIND and match[n])
            value, make = match[0], MAKE[kind]
            ends = _ends(kind, value)
            for i, end in enumerate(ends):
                if (new := make(value[:end], key, back)) is None:
                    continue
                # as in the input, no end that is tried before may be valid: cycle walking, so that the pseudonym is found again
                while any(make((new + value[end:])[:e], key, back) is not None for e in ends[:i]):
                    new = make(new, key, back)
                return kind, start + end, new
    return None


def pseudonymise(text: str, key: bytes, back: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms (or, with ``back``, their originals), and (kind, start, end) of each in the input."""
    out, spans, last = [], [], 0
    for anchor in ANCHOR.finditer(text):
        if anchor.start() < last:
            continue
        for start in _starts(text, anchor.start()):
            if start >= last and (found := _value_at(text, start, key, back)):
                kind, end, new = found
                out += [text[last:start], new]
                spans.append((kind, start, end))
                last = end
                break
    return "".join([*out, text[last:]]) if out else text, spans


#: A card where another format was found first but isn't valid.
FIND_CARD = re.compile(r"(?<![\w.-])\d(?:[\x20-]?\d){12,18}(?![\w-])", re.ASCII)
OUTPUT = fields("text string, n_values int, spans string")


def session_key(spark: SparkSession) -> bytes:
    """The key of the session's setting, or one that is drawn for this run and kept nowhere."""
    if found := spark.conf.get(KEY_SETTING, None):
        return found.encode()
    logging.getLogger(__name__).warning("%s is unset: pseudonyms of this run can't be restored or linked with other runs", KEY_SETTING)
    return secrets.token_bytes(32)


def pseudonym_columns(df: DataFrame, key: bytes, text: str = "text", back: bool = False) -> DataFrame:
    """``df`` with the text replaced, ``n_values`` and ``spans`` (kind:start:end in code points of the input, comma-joined)."""
    df = make_room(df, "n_values", "spans", "pii_found")

    @F.pandas_udf(OUTPUT)
    def replace(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for raw in texts:
            new, spans = pseudonymise(raw, key, back) if raw else (raw, [])
            rows.append((new, len(spans), ",".join(f"{k}:{a}:{b}" for k, a, b in spans)))
        return pd.DataFrame(rows, columns=OUTPUT.names)

    done = df.withColumn("pii_found", replace(F.col(f"`{text}`")))
    kept = [F.col("pii_found.text").alias(text) if c == text else F.col(f"`{c}`") for c in df.columns]
    return done.select(*kept, "pii_found.n_values", "pii_found.spans")


def restore(df: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """The inverse of ``pseudonym_columns`` on its text column, for the key's holder."""
    return pseudonym_columns(df, key, text, back=True).drop("n_values", "spans")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with pseudonyms."""
    return pseudonym_columns(table(spark, sf_dir, "documents").select("doc_id", "text"), session_key(spark))
