"""Keyed permutations that keep the format of a value, so that equal values get equal pseudonyms in every document.

A Feistel network over a x b pairs permutes the numbers below a * b; walking the cycle until the result is below n permutes 0 .. n - 1.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import re
import string

ROUNDS = 10
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1), dt.date(2059, 12, 31)
#: Weights and check characters of 18-digit resident identity numbers (GB 11643, ISO 7064 MOD 11-2).
CN_WEIGHTS = (7, 9, 10, 5, 8, 4, 2, 1, 6, 3, 7, 9, 10, 5, 8, 4, 2)
CN_CHECK = "10X98765432"
#: Identity numbers with letters: national insurance, and German cards with their own alphabet. They have no check character.
NINO = re.compile(r"[A-Z]{2}[0-9]{6}[A-D]")
CARD = re.compile(r"(?=(?:[A-Z]*[0-9]){1,6}[A-Z]*$)[CFGHJKLMNPRTVWXYZ][CFGHJKLMNPRTVWXYZ0-9]{8}")


class Feistel:
    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, domain: int, i: int, half: int, tweak: bytes) -> int:
        data = b"%d/%d/%d/" % (domain, i, half) + tweak
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=16).digest(), "big")

    def number(self, x: int, n: int, tweak: bytes = b"", inverse: bool = False) -> int:
        """The image of x under a permutation of 0 .. n - 1; inverse undoes it."""
        if n < 2:
            return x
        a = math.isqrt(n - 1) + 1
        b = -(-n // a)
        while True:
            left, right = divmod(x, b)
            for i in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
                sign = -1 if inverse else 1
                if i % 2:
                    right = (right + sign * self._round(n, i, left, tweak)) % b
                else:
                    left = (left + sign * self._round(n, i, right, tweak)) % a
            x = left * b + right
            if x < n:
                return x

    def digits(self, s: str, tweak: bytes = b"", inverse: bool = False) -> str:
        return str(self.number(int(s), 10 ** len(s), tweak + b"d", inverse)).zfill(len(s)) if s else s

    def mixed(self, s: str, alphabets: list[str], tweak: bytes = b"", inverse: bool = False) -> str:
        """Each character has its own alphabet; all are permuted together, as one number."""
        x = 0
        for c, a in zip(s, alphabets):
            x = x * len(a) + a.index(c)
        x = self.number(x, math.prod(map(len, alphabets)), tweak + b"m", inverse)
        out = ""
        for a in reversed(alphabets):
            x, r = divmod(x, len(a))
            out = a[r] + out
        return out

    def date(self, d: dt.date, tweak: bytes = b"", inverse: bool = False) -> dt.date:
        span = (LAST_DAY - FIRST_DAY).days + 1
        return FIRST_DAY + dt.timedelta(self.number((d - FIRST_DAY).days, span, tweak + b"t", inverse))

    def tag(self, kind: str, value: str) -> str:
        """96 bits: among a billion different values two share one with a probability below 1e-10."""
        return hashlib.blake2b(f"{kind}/{value}".encode(), key=self.key, digest_size=12).hexdigest()


def parse_day(s: str) -> dt.date | None:
    """A date YYYYMMDD in the range that can be permuted."""
    try:
        d = dt.date(int(s[:4]), int(s[4:6]), int(s[6:8]))
    except ValueError:
        return None
    return d if FIRST_DAY <= d <= LAST_DAY else None


def cn_check(body: str) -> str:
    return CN_CHECK[sum(int(c) * w for c, w in zip(body, CN_WEIGHTS)) % 11]


def valid_cn_id(s: str) -> bool:
    return len(s) == 18 and s[:17].isascii() and s[:17].isdigit() and cn_check(s) == s[17].upper() and parse_day(s[6:14]) is not None


def pseudonym_cn_id(f: Feistel, s: str, inverse: bool = False) -> str:
    """The region stays, the date becomes another date, the serial another serial, and the check character fits."""
    day = f.date(parse_day(s[6:14]), s[:6].encode(), inverse).strftime("%Y%m%d")
    body = s[:6] + day + f.digits(s[14:17], b"cn" + s[:6].encode(), inverse)
    check = cn_check(body)
    return body + (check.lower() if s[17].islower() else check)


def pseudonym_digits(f: Feistel, s: str, keep: int = 0, inverse: bool = False) -> str:
    """All digits behind the first ``keep`` are permuted as one number of the same length; every other character keeps its place."""
    d = re.findall(r"[0-9]", s)
    kept = "".join(d[:keep])
    new = iter(kept + f.digits("".join(d[keep:]), b"p%d" % keep + kept.encode(), inverse))
    return re.sub(r"[0-9]", lambda _: next(new), s)


def pseudonym_id(f: Feistel, s: str, inverse: bool = False) -> str:
    """Letters and digits are permuted as one number, letters to letters and digits to digits; every other character keeps its place.

    The cycle is walked until the result is a national insurance number, a card number or neither as ``s`` is.
    """
    chars = "".join(re.findall(r"[0-9A-Z]", s))
    if chars.isdigit():
        return pseudonym_digits(f, s, inverse=inverse)
    kind = lambda c: (bool(NINO.fullmatch(c)), bool(CARD.fullmatch(c)))
    shape = re.sub("[A-Z]", "A", re.sub("[0-9]", "0", chars))
    new = chars
    while True:
        new = f.mixed(new, [string.digits if c == "0" else string.ascii_uppercase for c in shape], shape.encode(), inverse)
        if kind(new) == kind(chars):
            break
    rest = iter(new)
    return re.sub(r"[0-9A-Z]", lambda _: next(rest), s)
