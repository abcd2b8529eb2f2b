"""Credentials embedded in source code and configuration files: where they begin, and the source with them blanked.

Candidates are the values that stand where a credential would (by the name beside them), logins in URLs, private key blocks, and strings in
the format of a known token. Every string literal, value and word of a comment is also unwrapped, again and again until nothing comes off,
from base64, hex, percent signs, escapes and character references; what comes out is scanned in the same way, bytes are read by the grammar
of key containers, and a hit inside blanks the whole literal, in the codings it was written in.
Placeholders, masks, references to variables or stores, hashes, commits, ids and public keys are no credentials.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import itertools
import math
import re
from collections import Counter
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "REDACTED"
#: What an encoded literal holds once it is blanked: long enough to be told from a key when it is decoded.
INNER = "REDACTED REDACTED"

#: Published formats of tokens.
TOKEN = re.compile(
    r"(?<![A-Za-z0-9_])(?:A(?:KIA|SIA)[0-9A-Z]{16}(?![0-9A-Za-z])|gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{40,}|glpat-[A-Za-z0-9_-]{20,}|[sr]k_(?:live|test)_[A-Za-z0-9]{16,}"
    r"|xox[abprs]-[0-9A-Za-z-]{20,}|AIza[0-9A-Za-z_-]{35}(?![0-9A-Za-z_-])|ya29\.[0-9A-Za-z_-]{20,}|npm_[A-Za-z0-9]{36}|SG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}|eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,})"
)
PEM = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----")
PEM_END = re.compile(r"-----END (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----")
URL_LOGIN = re.compile(r"[A-Za-z][A-Za-z0-9+.-]{1,30}://([^\s:/@\"'`<>]*):([^\s/@\"'`]+)@(?=[\w\[{$<.-])")
PARAM = re.compile(r"(?i)(?<=[?&;])(?:password|passwd|pwd|pass|secret|token|api_?key|access_?key|sig)=([^&;\s\"'`<>]+)")
HEADER = re.compile(r"(?i)\b(?:Bearer|Basic|Token)[ ]+([A-Za-z0-9+/=._~-]{12,})")
DEFAULT = re.compile(r"\$\{([A-Za-z_][\w.-]*):[-=?]?([^{}\s\"']+)\}")
COMMENT = re.compile(r"(?m)^\s*(?://|#|\*|--|;)+(.*)$|(?<=\s)(?://|#) (.*)$")
CUE = re.compile(r"(?i)\b(?:key|keys|token|password|passwd|pwd|pw|pass|secret|login|credentials?|old value|rotation|auth)\b[^\n]*?(?:(?<=[\s:=/\"'`(])|^)([^\s\"'`(),;]{8,})")
STRING = re.compile(r'"""(?:[^\\]|\\.)*?"""|\'\'\'(?:[^\\]|\\.)*?\'\'\'|"(?:[^"\\\n]|\\.)*"|\'(?:[^\'\\\n]|\\.)*\'', re.S)
RUN = re.compile(r"[A-Za-z0-9+/=_%\\-]{16,}(?:[ \t\r]*\n[ \t]*[A-Za-z0-9+/=_%\\-]{16,})*(?:[ \t\r]*\n[ \t]*[A-Za-z0-9+/=_-]+(?=\s*(?:\n|$)))?")
JOIN = re.compile(r"[\s+\\()]*(?:(?://|#)\s*)?[\s+]*[rbfuRBFU]?")
NAME = r"[A-Za-z_$][\w$.-]*"
BEFORE = re.compile(rf"(?:[\"'](?P<q>[\w.$ -]+)[\"']\s*(?:\]\s*)?[:=,]|(?P<n>{NAME})(?:[ \t]*:[ \t]*[\w\[\], .<>|]+)?\s*(?::=|\?\?=|=>|[:=])|(?P<call>{NAME})\s*\(|[\"'](?P<h>[\w.-]+)[\"']\s*\]\s*=)\s*\(?\s*(?:new String\(|[\w.]*(?:decode|Decoder\(\)\.decode|b64decode|fromhex|unhexlify|unquote|getBytes)\w*\()*\s*[rbfuRBFU]?$")
LOGIN_CALL = re.compile(r"(?i)(?:open|connect|getconnection|login|createconnection|authenticate|basicauth|basic_auth|httpbasicauth|usernamepasswordcredentials|passwordauthentication|credentials|auth)\s*\([^()]*$")
CONFIG = re.compile(r"^(?P<lead>\s*(?:(?:#|//|;|--)+\s*)?(?:-\s+)?(?:export\s+|set\s+)?)(?P<key>[\"']?[A-Za-z_][\w.\-]*[\"']?)(?P<sep>\s*[:=]\s*)(?P<value>.*?)\s*$")
BLOCK = re.compile(r"[|>](?:[+-]?[1-9]?|[1-9][+-])(?:\s+#.*)?")
XML_PAIR = re.compile(r"(?:name|key|id)\s*=\s*[\"'](?P<key>[\w.\-]+)[\"'][^<>]*?\bvalue\s*=\s*[\"'](?P<value>[^\"'<>]*)[\"']|<(?P<tag>[\w.\-]+)(?:\s[^<>]*)?>(?P<text>[^<>]+)</(?P=tag)>|(?P<attr>[\w.\-]+)\s*=\s*[\"'](?P<av>[^\"'<>]*)[\"']")
SECRET_WORDS = frozenset("password passwd passphrase passcode pwd pass pw secret secrets token credential credentials cred creds apikey accesskey secretkey privatekey authkey apitoken authtoken clientsecret".split())
KEY_OWNERS = frozenset("api access partner private client signing auth encryption secret master service account shared storage app hmac crypto deploy license admin root push hook webhook session".split())
#: Words that make a name speak about a credential, instead of holding one.
ABOUT = frozenset("name names ttl policy ref reference type url uri path file filename dir length len size count expiry expires expiration timeout hint header field prefix suffix store manager provider max min limit enabled page next cursor public tokenizer label title id rotation interval algorithm alg format regex pattern scope issuer version status strength required".split())
PLACEHOLDER = re.compile(
    r"""(?ix)^(?:
      (.)\1*                                                        # a mask of one sign
    | [*x•#.\-_]+ | .*\*{4,}.* | .*(?:x{6,}|•{3,}|\.{3,}).*
    | <.*> | \[.*\] | \{\{.*\}\} | \$\{.*\} | \$\(.*\) | \#\{.*\} | %\(\w+\)[sd] | %[sd] | \$\w+ | %\w+% | @\w+@
    | .*\b(?:your|my|insert|replace|enter|put|add)[-_ ]?(?:own|this|the|with|your|a|an|key|secret|token|pass|password|api|client|auth|access|signing|hook|partner|push|[\w-]{0,40}here)\b.* | your[-_ ].* | .*[-_ ]here | insert[-_].*
    | change[-_ ]?(?:me|it|this).* | (?:ex|s)ample.* | .*[-_.]example | dummy.* | fake.* | placeholder.* | redacted.* | todo.* | tbd | fixme | none | null | nil | undefined | empty | true | false | yes | no | on | off | unset | n/?a | default
    | password|passwd|secret|token|key|changeit
    | (?:vault|ssm|secretsmanager|kms|gcpsm|arn|env|file|ref|op|keyring|k8s|sops|aws|azure)\s*[:/].* | !?(?:ref|sub|vault|env)\b.*
    | .*[-_.](?:ref|secret-ref|secretref) | .*\b(?:getenv|environ|getProperty|os\.|System\.|process\.env|secrets\.|vault\.|config\.).*
    | (?:min|max)[-_]length.* | \d+(?:\.\d+)?(?:ms|s|m|h|d|kb|mb|gb|%)? | /(?:[\w.-]+/)*[\w.-]* | \.{1,2}/.*
    )$"""
)
IDENTIFIER = re.compile(r"^(?:[A-Z][A-Z0-9]*(?:_[A-Z0-9]+)+|[a-z]+(?:[._-][a-z]+)*|[a-z]+(?:[A-Z][a-z]+)+)$")
UUID = re.compile(r"^[0-9a-f]{8}-[0-9a-f]{4}-(?:[0-9a-f]{4}-){0,2}[0-9a-f]{4,12}$", re.I)


def words_of(name: str) -> list[str]:
    """The words of an identifier, lower case: camel case, snake case, dots and dashes."""
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1 \2", name)
    s = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1 \2", s)
    return [w for w in re.split(r"[^A-Za-z0-9]+|(?<=[a-z])\d+$", s.lower()) if w]


def holds_credential(name: str) -> bool:
    """Whether a variable or property of this name holds a credential."""
    w = words_of(name)
    if w and w[0] in ("set", "with", "add", "put", "use"):
        w = w[1:]
    if not w or w[-1] in ABOUT or set(w) & {"public", "page", "next", "continuation", "csrf", "pagination"}:
        return False
    if set(w) & SECRET_WORDS:
        return True
    return any(a in KEY_OWNERS and b in ("key", "keys") for a, b in zip(w, w[1:]))


def entropy(s: str) -> float:
    n = len(s)
    return -sum(c / n * math.log2(c / n) for c in Counter(s).values()) if n else 0.0


def is_live(value: str) -> bool:
    """Whether a value in the place of a credential is one, and no placeholder, mask, reference or setting."""
    v = value.strip()
    if len(v) < 6 or PLACEHOLDER.match(v) or " " in v and not TOKEN.search(v) or UUID.match(v):
        return False
    if TOKEN.search(v):
        return True
    kinds = sum(bool(re.search(p, v)) for p in (r"[a-z]", r"[A-Z]", r"\d", r"[^A-Za-z0-9]"))
    if IDENTIFIER.match(v):
        return False
    if kinds >= 2 and re.search(r"\d|[^A-Za-z0-9._-]", v):
        return True
    return len(v) >= 10 and kinds >= 2 and entropy(v) > 2.8 and bool(re.search(r"[a-z][A-Z]|[A-Z]{2}[a-z]", v))


# --- unwrapping

_B64 = re.compile(r"^[A-Za-z0-9+/_-]{12,}={0,2}$")
_HEX = re.compile(r"^(?:0x)?(?:[0-9A-Fa-f]{2}){8,}$")
_ESCAPED = re.compile(r"\\(?:u\{?([0-9A-Fa-f]{4,6})\}?|x([0-9A-Fa-f]{2})|U([0-9A-Fa-f]{8})|([0-7]{3}))")


def readable(b: bytes) -> str | None:
    """The text of the bytes, if they are text."""
    try:
        t = b.decode("utf-8")
    except UnicodeDecodeError:
        return None
    ok = sum(c.isprintable() or c in "\r\n\t" for c in t)
    return t if len(t) >= 6 and ok == len(t) else None


#: Layers that only repeat the sign of the next one; they come off at once.
_NESTED = ((re.compile(r"%(?:25)+(?=[0-9A-Fa-f]{2})"), "%"), (re.compile(r"&(?:#(?:38|[xX]26);)+(?=#)"), "&"), (re.compile(r"\\(?:u005[cC])+(?=u[0-9A-Fa-f]{4})"), r"\\"))


def layers(value: str) -> list[tuple[str, str | bytes]]:
    """What the value is once one layer is taken off, in every way that applies, with the name of the coding."""
    out: list[tuple[str, str | bytes]] = []
    v = value.strip()
    for pattern, sign in _NESTED:
        v = pattern.sub(sign, v)
    if _ESCAPED.search(v):
        out.append(("escape", _ESCAPED.sub(lambda m: chr(min(int(m[1] or m[2] or m[3], 16), 0x10FFFF)) if m[4] is None else chr(int(m[4], 8)), v)))
    if "%" in v and re.search(r"%[0-9A-Fa-f]{2}", v):
        t = unquote(v, errors="ignore")
        if t != v:
            out.append(("percent", t))
    if "&#" in v:
        t = re.sub(r"&#(?:[xX]([0-9A-Fa-f]{1,6})|(\d{1,7}));", lambda m: chr(min(int(m[1], 16) if m[1] else int(m[2]), 0x10FFFF)), v)
        if t != v:
            out.append(("reference", t))
    flat = re.sub(r"\s+|\\n", "", v)
    if _HEX.match(flat):
        out.append(("hex", bytes.fromhex(flat.removeprefix("0x"))))
    elif _B64.match(flat):
        body = flat.rstrip("=").replace("-", "+").replace("_", "/")
        try:
            out.append(("base64", base64.b64decode(body + "=" * (-len(body) % 4), validate=True)))
        except (binascii.Error, ValueError):
            pass
    return out


ENCODERS = {
    "escape": lambda t: "".join(f"\\u{ord(c):04x}" for c in t),
    "percent": lambda t: "".join(f"%{b:02X}" for b in t.encode()),
    "reference": lambda t: "".join(f"&#{ord(c)};" for c in t),
    "hex": lambda t: t.encode().hex(),
    "base64": lambda t: base64.b64encode(t.encode()).decode(),
}


# --- key containers


def _der(b: bytes, at: int = 0) -> tuple[int, bytes, int] | None:
    """Tag, content and end of the DER element at ``at``."""
    if at + 2 > len(b):
        return None
    tag, n, at = b[at], b[at + 1], at + 2
    if n & 0x80:
        k = n & 0x7F
        if not 0 < k <= 4 or at + k > len(b):
            return None
        n, at = int.from_bytes(b[at : at + k], "big"), at + k
    return (tag, b[at : at + n], at + n) if at + n <= len(b) else None


def _children(content: bytes, most: int = 1 << 30) -> list[tuple[int, bytes]] | None:
    """Tags and contents of the elements that make up ``content``; none where it does not come out even."""
    out, at = [], 0
    while at < len(content) and len(out) < most:
        e = _der(content, at)
        if not e:
            return None
        out.append(e[:2])
        at = e[2]
    return out


class _Reader:
    """Big-endian fields one after the other; reading beyond the end raises EOFError."""

    def __init__(self, b: bytes, at: int):
        self.b, self.at = b, at

    def take(self, n: int) -> bytes:
        if self.at + n > len(self.b):
            raise EOFError
        self.at += n
        return self.b[self.at - n : self.at]

    def number(self, n: int) -> int:
        return int.from_bytes(self.take(n), "big")

    def block(self, size: int = 4) -> bytes:
        return self.take(self.number(size))


def _openssh_key(b: bytes) -> bool:
    """Cipher, derivation, its options, the number of keys, as many public keys, and the private part, which is not empty."""
    r = _Reader(b, len(b"openssh-key-v1\0"))
    cipher, derivation, _, n = r.block(), r.block(), r.block(), r.number(4)
    if not cipher or not derivation or not 0 < n < 1 << 16:
        return False
    return all(r.block() for _ in range(n)) and len(r.block()) >= 8


def _putty_key(b: bytes) -> bool:
    """Headers of ``Name: value``, of which Private-Lines says that private lines follow."""
    return any(m and int(m[1]) > 0 for m in (re.match(rb"Private-Lines:\s*(\d{1,6})\s*$", line) for line in b.split(b"\n")))


def _java_key(b: bytes) -> bool:
    """Whether an entry of a Java key store is a private (1) or a secret key (3), not a certificate (2)."""
    r = _Reader(b, 4)
    version, n = r.number(4), r.number(4)
    if version not in (1, 2):
        return False
    for _ in range(n):
        tag = r.number(4)
        r.block(2), r.take(8)  # alias and time
        if tag in (1, 3):
            return tag == 3 or len(r.block()) > 0
        if tag != 2:
            return False
        if version == 2:
            r.block(2)
        r.block()
    return False


_DATA = b"\x2a\x86\x48\x86\xf7\x0d\x01\x07\x01"
_BAG = b"\x2a\x86\x48\x86\xf7\x0d\x01\x0c\x0a\x01"


def _bags_hold_key(content: bytes) -> bool:
    """Whether safe contents have a key bag (1), a shrouded key bag (2) or a secret bag (5), also within nested contents (6)."""
    for tag, bag in _children(content) or ():
        parts = _children(bag) if tag == 0x30 else None
        if parts and len(parts) >= 2 and parts[0][0] == 6 and parts[0][1][:-1] == _BAG:
            kind = parts[0][1][-1]
            if kind in (1, 2, 5) or kind == 6 and any(_bags_hold_key(x) for t, x in _children(parts[1][1]) or () if t == 0x30):
                return True
    return False


def _pkcs12_key(safe: bytes) -> bool:
    """Whether the contents of a PKCS #12 store that are not encrypted as a whole have a key bag; certificates lie in encrypted ones."""

    def data(info: bytes) -> bytes | None:
        parts = _children(info)
        if not parts or len(parts) < 2 or parts[0] != (6, _DATA) or parts[1][0] != 0xA0:
            return None
        octets = _children(parts[1][1])
        return octets[0][1] if octets and octets[0][0] == 4 else None

    inner = data(safe)
    top = _children(inner) if inner else None
    if not top or top[0][0] != 0x30:
        return False
    contents = [data(info) for tag, info in _children(top[0][1]) or () if tag == 0x30]
    return any(_bags_hold_key(x) for c in contents if c for t, x in _children(c) or () if t == 0x30)


def is_private_key(b: bytes) -> bool:
    """PKCS #1, PKCS #8 (plain or encrypted), SEC 1, PKCS #12, OpenSSH, PuTTY and Java key stores with a key in them; public keys and stores
    of certificates are not."""
    try:
        if b.startswith(b"openssh-key-v1\0"):
            return _openssh_key(b)
        if b.startswith(b"PuTTY-User-Key-File-"):
            return _putty_key(b)
        if b.startswith((b"\xfe\xed\xfe\xed", b"\xce\xce\xce\xce")):
            return _java_key(b)
    except EOFError:
        return False
    top = _der(b)
    if not top or top[0] != 0x30 or top[2] < len(b) - 2:
        return False
    parts = _children(top[1], 12)
    if not parts:
        return False
    tags = [t for t, _ in parts]
    if tags[:3] == [2, 0x30, 4] and parts[0][1] in (b"\0", b"\1"):
        return True  # PKCS #8
    if len(tags) >= 6 and set(tags[:6]) == {2} and parts[0][1] in (b"\0", b"\1"):
        return True  # PKCS #1 and DSA
    if tags[:2] == [2, 4] and parts[0][1] == b"\1" and len(parts[1][1]) in (24, 28, 32, 48, 66):
        return True  # SEC 1
    if tags[:2] == [2, 0x30] and parts[0][1] == b"\3":
        return _pkcs12_key(parts[1][1])
    if tags == [0x30, 4]:
        inner = _der(parts[0][1])
        return bool(inner and inner[0] == 6 and inner[1].startswith(b"\x2a\x86\x48\x86\xf7\x0d\x01\x05"))  # encrypted PKCS #8: PBES
    return False


def codings(value: str, wanted: bool) -> list[str] | None:
    """The codings, from the outermost in, behind which a credential is in the value; none if there is none. wanted: the value stands where
    a credential would. Every layer makes the value shorter, so there is an end however many there are."""
    todo: list[tuple[str, list[str]]] = [(value, [])]
    seen = {value}
    while todo:
        text, trail = todo.pop()
        for name, inner in layers(text):
            here = [*trail, name]
            if isinstance(inner, bytes):
                if is_private_key(inner):
                    return here
                inner = readable(inner)
            if inner is None or inner in seen or len(inner) >= len(text):
                continue
            if wanted and is_live(inner) or has_credential(inner):
                return here
            seen.add(inner)
            todo.append((inner, here))
    return None


def hidden(value: str, wanted: bool) -> bool:
    return codings(value, wanted) is not None


def has_credential(text: str) -> bool:
    """Whether decoded text holds one: a key block, a login, a token or a setting."""
    return bool(PEM.search(text) or TOKEN.search(text) or any(is_live(m.group(2)) for m in URL_LOGIN.finditer(text)) or any(True for _ in settings(text, decoded=True)))


def judged(value: str, wanted: bool) -> bool:
    """A value that decodes to readable text is judged by that text, others by themselves."""
    if wanted:
        for _, inner in layers(value):
            text = readable(inner) if isinstance(inner, bytes) else inner
            if text and len(text) >= 6 and re.fullmatch(r"[\x20-\x7e\s]+", text) and (isinstance(inner, str) or entropy(text) > 1.5):
                return is_live(text) or hidden(value, True)
        if is_live(value):
            return True
    return bool(TOKEN.search(value)) or hidden(value, wanted)


# --- places

Hit = tuple[int, list[tuple[int, int]]]


def block_lines(lines: list[str], i: int) -> list[int]:
    """The lines of the YAML block scalar that line i opens: those indented deeper, blank ones between them included."""
    depth = lambda k: len(lines[k]) - len(lines[k].lstrip())
    out, k = [], i + 1
    while k < len(lines) and (not lines[k].strip() or depth(k) > depth(i)):
        if lines[k].strip():
            out.append(k)
        k += 1
    return out


def odd_end(piece: str) -> bool:
    """Whether it ends with a backslash that is not escaped, and so goes on in the next line."""
    return (len(piece) - len(piece.rstrip("\\"))) % 2 == 1


def settings(text: str, decoded: bool = False):
    """The spans of every live value of ``key = value`` and ``key: value`` lines: one, or one for each line of a block or continuation."""
    lines = text.split("\n")
    at = [0, *itertools.accumulate(len(x) + 1 for x in lines)]
    for i, line in enumerate(lines):
        m = CONFIG.match(line.rstrip("\r"))
        if not m:
            continue
        raw, key = m["value"], m["key"].strip("\"'")
        start = at[i] + m.start("value")
        if BLOCK.fullmatch(raw) and i + 1 < len(lines):
            if not holds_credential(key):
                continue
            body = block_lines(lines, i)
            joined = "".join(lines[k].strip() for k in body)
            if joined and not joined.startswith("-----") and judged(joined, True):
                inner = list(settings("\n".join(lines[k] for k in body), True))  # lines that are settings themselves have their own hit
                base = [0, *itertools.accumulate(len(lines[k]) + 1 for k in body)]
                own = {bisect.bisect_right(base, x) - 1 for spans in inner for x, _ in spans}
                spans = [(at[k] + len(lines[k]) - len(lines[k].lstrip()), at[k] + len(lines[k].rstrip())) for n, k in enumerate(body) if n not in own]
                if spans:
                    yield spans
            continue
        if raw and raw[0] in "\"'" and (close := raw.find(raw[0], 1)) > 0:
            spans = [(start + 1, start + close)]
        else:
            raw = re.split(r"\s+[#;]\s", raw)[0].rstrip(",").rstrip()
            spans, k = [(start, start + len(raw))], i
            while odd_end(raw) and k + 1 < len(lines):
                spans[-1] = spans[-1][0], spans[-1][1] - 1
                k += 1
                raw = lines[k].strip()
                x = at[k] + len(lines[k]) - len(lines[k].lstrip())
                spans.append((x, x + len(raw)))
            if odd_end(raw) and not decoded:
                spans[-1] = spans[-1][0], spans[-1][1] - 1
            if len(spans) > 1 and (q := text[start : start + 1]) in "\"'" and text[spans[-1][0] : spans[-1][1]].endswith(q):
                spans[0], spans[-1] = (start + 1, spans[0][1]), (spans[-1][0], spans[-1][1] - 1)
        raw = "".join(text[x:y] for x, y in spans)
        if raw and holds_credential(key) and not PEM.search(raw) and judged(raw, True):
            yield [(x, y) for x, y in spans if y > x]


def scan(source: str, path: str = "") -> list[Hit]:
    """Every credential: where it begins and the spans to blank (the whole literal, all its pieces). Spans do not overlap."""
    hits: list[Hit] = []
    taken: list[tuple[int, int]] = []
    ext = path.rsplit(".", 1)[-1].lower() if "." in path else ""

    def add(spans: list[tuple[int, int]]) -> None:
        spans = [(a, b) for a, b in spans if b > a]
        if spans and not any(a < y and x < b for a, b in spans for x, y in taken):
            taken.extend(spans)
            hits.append((spans[0][0], spans))

    for m in PEM.finditer(source):
        end = PEM_END.search(source, m.end())
        stop = end.start() if end else len(source)
        if any(x <= m.start() < y for x, y in taken):
            continue
        body = [(b.start() + m.end(), b.end() + m.end()) for b in re.finditer(r"(?<!\\)[A-Za-z0-9+/=]{8,}|(?<=\\n)[A-Za-z0-9+/=]{8,}", source[m.end() : stop])]
        text = "".join(source[a:b] for a, b in body)
        if len(text) < 24 or len(set(text)) < 8:  # only its name, or blanked already
            continue
        hits.append((m.start(), body))
        taken.append((m.start(), stop))
    for m in URL_LOGIN.finditer(source):
        if is_live(m.group(2)) or is_live(unquote(m.group(2))):
            add([m.span(2)])
    for m in PARAM.finditer(source):
        if is_live(unquote(m.group(1))):
            add([m.span(1)])
    for m in DEFAULT.finditer(source):
        line = source[source.rfind("\n", 0, m.start()) + 1 : m.start()]
        key = re.search(rf"({NAME})[\"']?\s*[:=]\s*[\"']?$", line)
        if (holds_credential(m.group(1)) or key and holds_credential(key.group(1))) and judged(m.group(2), True):
            add([m.span(2)])
    code = ext not in ("yml", "yaml", "properties", "env", "toml", "ini", "cfg", "conf")
    if ext in ("xml", "html"):
        for m in XML_PAIR.finditer(source):
            for k, v in (("key", "value"), ("tag", "text"), ("attr", "av")):
                if m[k] and judged(m[v].strip(), holds_credential(m[k])):
                    add([m.span(v)])
    elif code:
        literals(source, add)
    if not code or ext not in ("xml", "html", "java", "py", "json", "js", "ts", "kt", "go", "c", "cpp", "cs", "rb", "php", "scala"):
        for spans in settings(source):
            add(spans)
        for m in re.finditer(r"[A-Za-z0-9+/=_%\\-]{16,}", source):  # values under any name
            if not any(a <= m.start() < b for a, b in taken) and judged(m.group(), False):
                add([m.span()])
    for m in COMMENT.finditer(source):
        g = 1 if m[1] is not None else 2
        text, at = m[g], m.start(g)
        for x in re.finditer(r"[A-Za-z0-9+/=_%\\&#;-]{12,}", text):
            if hidden(x.group().strip(";"), False):
                add([(at + x.start(), at + x.start() + len(x.group().strip(";")))])
        for cue in CUE.finditer(text):
            for w in re.finditer(r"[^\s\"'`(),;]{8,}", text[cue.start() :]):
                v = w.group().rstrip(".:")
                kinds = sum(bool(re.search(p, v)) for p in (r"[a-z]", r"[A-Z]", r"\d"))
                told = re.search(r"[:=/]\s*$", text[: cue.start() + w.start()])  # behind a sign, as a value is
                if is_live(v) and "://" not in v and not re.search(r"[()<>\[\]]", v) and (kinds == 3 and entropy(v) > 2.5 or told and kinds >= 2 and re.search(r"\d", v)):
                    add([(at + cue.start() + w.start(), at + cue.start() + w.start() + len(v))])
            break
    for m in HEADER.finditer(source):
        v = m.group(1)
        if is_live(v) and (TOKEN.search(v) or hidden(v, True) or len(v) >= 16 and re.search(r"\d", v)):
            add([m.span(1)])
    for m in TOKEN.finditer(source):
        add([m.span()])
    return sorted(hits)


def wrapped(value: str) -> bool:
    """Whether every line but the last has one long piece, as encodings do that are cut into lines, and texts of words do not."""
    rows = [x.split() for x in value.split("\n") if x.strip()]
    return all(len(x) == 1 for x in rows) and all(len(x[0]) >= 16 for x in rows[:-1])


def literals(source: str, add) -> None:
    """String literals, those joined over several pieces as one."""
    pieces = list(STRING.finditer(source))
    i = 0
    while i < len(pieces):
        group = [pieces[i]]
        while i + 1 < len(pieces) and (gap := source[group[-1].end() : pieces[i + 1].start()]) and JOIN.fullmatch(gap) and ("\n" in gap or "+" in gap or not gap.strip("() \t")):
            if ")" in gap or "\n\n" in gap or ("\n" in gap and "+" not in gap and "\\" not in gap and source[max(0, group[0].start() - 200) : group[0].start()].rstrip()[-1:] not in "(,=+["):
                break
            i += 1
            group.append(pieces[i])
        i += 1
        first = group[0]
        quote = 3 if first.group()[:3] in ('"""', "'''") else 1
        inner = [(p.start() + (3 if p.group()[:3] in ('"""', "'''") else 1), p.end() - (3 if p.group()[:3] in ('"""', "'''") else 1)) for p in group]
        value = "".join(source[a:b] for a, b in inner)
        if len(value) < 6:
            continue
        if quote == 3 and " " in value.strip():
            for spans in settings(value):
                add([(inner[0][0] + a, inner[0][0] + b) for a, b in spans])
            flat = re.sub(r"\s+|\\n", "", value)
            if not _HEX.match(flat) and not (_B64.match(flat) and wrapped(value)):
                for a, b in inner:
                    for m in RUN.finditer(source, a, b):  # encodings inside a text, wrapped or not
                        pieces_of = [(m.start() + x.start(), m.start() + x.end()) for x in re.finditer(r"\S+", m.group())]
                        whole = len(pieces_of) > 1 and judged("".join(source[x:y] for x, y in pieces_of), False)
                        for spans in [pieces_of] if whole else [[x] for x in pieces_of if judged(source[x[0] : x[1]], False)]:
                            add(spans)
                continue
            # one encoding, wrapped and indented: the lines keep their places
            inner = [(a + x.start(), a + x.end()) for a, b in inner for x in re.finditer(r"\S+", source[a:b])]
            value = flat
        before = source[max(0, first.start() - 200) : first.start()]
        before = before[before.rfind(";") + 1 :]
        m = BEFORE.search(before)
        name = (m["q"] or m["n"] or m["call"] or m["h"] or "") if m else ""
        wanted = holds_credential(name) and not (m and m["call"] and words_of(m["call"])[0] in ("get", "is", "has", "require", "read", "load", "getenv"))
        if not wanted and m and m["q"] and re.search(r"(?:getenv|getProperty|setdefault|environ|get|put|property|header)\w*\(\s*$", before[: m.start()]):
            wanted = holds_credential(m["q"])
        if not wanted and (call := LOGIN_CALL.search(before)):
            args = STRING.findall(call.group())
            wanted = len(args) >= (1 if re.search(r"(?i)auth|credential|login", call.group()[:30]) else 2) and bool(re.search(r",\s*$", before))
        if judged(value, wanted):
            add(inner)


def line_of(source: str, at: int) -> int:
    return source.count("\n", 0, at) + 1


DECODED = re.compile(r"(?:(?P<hex>fromhex|unhexlify|parseHex|decodeHex)|(?P<base64>b64decode|decodeBase64|decodebytes|Decoder\(\)\.decode))\w*\(\s*[rbfuRBFU]?[\"']*$")


def blank_of(source: str, spans: list[tuple[int, int]]) -> str:
    """What a literal is blanked with: INNER in the codings that it is in, or that the call around it will take off, else BLANK."""
    value = "".join(source[a:b] for a, b in spans)
    called = DECODED.search(source, max(0, spans[0][0] - 80), spans[0][0])
    trail = codings(value, False) or codings(value, True) or ([called.lastgroup] if called else [])
    out = INNER if trail else BLANK
    for name in reversed(trail):
        out = ENCODERS[name](out)
    return "0x" + out if trail[:1] == ["hex"] and value.startswith("0x") else out


def blanked(source: str, hits: list[Hit]) -> str:
    """The source with every span blanked: the first of a literal holds its blank, further pieces are emptied, key bodies keep their shape."""
    edits = []
    for start, spans in hits:
        key = spans and spans[0][0] != start
        for k, (a, b) in enumerate(spans):
            edits.append((a, b, "X" * (b - a) if key else blank_of(source, spans) if k == 0 else ""))
    out, at = [], 0
    for a, b, new in sorted(edits):
        out += [source[at:a], new]
        at = b
    return "".join([*out, source[at:]])


SCANNED = "rec_no bigint, lines array<bigint>, source string"


def credentials(symbols: DataFrame) -> DataFrame:
    """(rec_no, lines, source): for every row the lines on which credentials begin (1-based, in order) and its source with them blanked.

    A null source stays null, without lines; an empty one is empty. Repeated rows are rows. file_path only tells the kind of file; where it
    is null, the source is read as code and as settings.
    """

    def run(batches):
        for batch in batches:
            lines, sources = [], []
            for path, src in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                hits = scan(src, path or "") if src else []
                lines.append(sorted({line_of(src, a) for a, _ in hits}))
                sources.append(blanked(src, hits) if hits else src)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.list_(pa.int64())), pa.array(sources, pa.string())], ["rec_no", "lines", "source"])

    return symbols.select(F.col("rec_no").cast("bigint"), "file_path", "source").mapInArrow(run, SCANNED)
