"""Personal information inside free text: found, typed, and replaced by placeholders with format-preserving pseudonyms.

Numbers are only taken for what they look like after validation (check characters, dates, lengths, what stands around them). Names are
recognised by the parts they are made of, learned from the table of contributors; a given name or its initial and a family name must meet.
Other names are told by their shape and by what stands around them: a naive Bayes model of both is learned from the names that were
recognised by their parts, in a bounded sample of the documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.language import SEEDS
from sievework.llm.pseudonym import Feistel, parse_day, pseudonym_cn_id, pseudonym_digits, pseudonym_id, valid_cn_id
from sievework.operators.ranking import bounded_sample

KINDS = ("name", "email", "phone", "id_number", "address")
#: Signs with a full-width form, mapped one to one so that positions stay.
PLAIN_OF = {i: i - 0xFEE0 for i in [*range(0xFF10, 0xFF1A), 0xFF08, 0xFF09, 0xFF0B, 0xFF0D, 0xFF0E, 0xFF0F, 0xFF20]} | {0x3000: 0x20, 0xA0: 0x20, 0x202F: 0x20, 0x2009: 0x20, 0x2010: 0x2D, 0x2011: 0x2D}

PLAIN = {chr(a): chr(b) for a, b in PLAIN_OF.items()}
WIDE = re.compile("[" + "".join(PLAIN) + "]")


def plain(text: str) -> str:
    return text if text.isascii() else WIDE.sub(lambda m: PLAIN[m.group()], text)


def name_parts(names: Iterable[str]) -> tuple[frozenset[str], frozenset[str]]:
    """Beginnings and endings that the names share: of each name the cut whose two parts are the most common among all names.

    Parts have at least two letters. A name whose endings no other name has is its own beginning, with an empty ending.
    """
    words = sorted({n.lower() for n in names if n and n.isalpha() and len(n) >= 4})
    heads, tails = Counter(), Counter()
    for w in words:
        for i in range(2, len(w) - 1):
            heads[w[:i]] += 1
            tails[w[i:]] += 1
    begin, end = set(), set()
    for w in words:
        shared, _, cut = max((heads[w[:i]] * tails[w[i:]] if tails[w[i:]] > 1 else 0, -abs(2 * i - len(w)), i) for i in range(2, len(w) - 1))
        if shared:
            begin.add(w[:cut])
            end.add(w[cut:])
        else:
            begin.add(w)
            end.add("")
    return frozenset(begin), frozenset(end)


@dataclass
class NameStock:
    given: tuple[frozenset[str], frozenset[str]] = (frozenset(), frozenset())
    family: tuple[frozenset[str], frozenset[str]] = (frozenset(), frozenset())
    han_given: tuple[str, ...] = ()
    han_family: tuple[str, ...] = ()
    known: dict[str, int] = field(default_factory=dict)
    context: ContextModel | None = None

    def kind(self, word: str) -> int:
        """1 for a given name, 2 for a family name, 4 and 8 if only the ending (of three letters or more) fits one; sums for several."""
        k = self.known.get(word)
        if k is None:
            w = word.lower()
            fits = lambda parts: any(w[:i] in parts[0] and w[i:] in parts[1] for i in range(2, len(w) + 1))
            ends = lambda parts: any(w[i:] in parts[1] for i in range(2, len(w) - 2))
            k = (1 if fits(self.given) else 4 if ends(self.given) else 0) | (2 if fits(self.family) else 8 if ends(self.family) else 0)
            if len(self.known) < 200_000:
                self.known[word] = k
        return k


def name_stock(contributors: DataFrame) -> NameStock:
    """Learned from the table of contributors, which has a fixed size (some hundred rows); null names are left out."""
    rows = contributors.select("given_name", "family_name", "script").collect()
    latn = [r for r in rows if r.script == "latn"]
    hani = [r for r in rows if r.script == "hani"]
    pick = lambda rs, c: sorted({r[c] for r in rs if r[c]})
    return NameStock(name_parts(pick(latn, "given_name")), name_parts(pick(latn, "family_name")), tuple(pick(hani, "given_name")), tuple(pick(hani, "family_name")))


# --- what things look like; all patterns run on the text with plain signs

AT = re.compile(r" ?[\[({<] ?(?:at|AT|At) ?[\])}>] ?|@| (?:at|AT) (?=[A-Za-z0-9-]+ (?:dot|DOT) )")
LOCAL = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9._%+'-]*[A-Za-z0-9_+-])?$")
DOT = r"(?:\.| ?[\[({] ?(?:dot|DOT) ?[\])}] ?| (?:dot|DOT) )"
LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?"
DOMAIN = re.compile(rf"{LABEL}(?:{DOT}{LABEL})+")
LAST_LABEL = re.compile(rf"{DOT}({LABEL})$")
#: Where a NUMBER may be: cheap to find. Every NUMBER that counts has eight characters of the class, its leading letters included.
CLUSTER = re.compile(r"(?=[\dA-Z ().+/-]{8})(?:[A-Z]{1,8} ?|[+(]{1,2})?\d[\dA-Z ().+/-]*[\dA-Za-z]?")
BORN_WORDS = ("born", "geboren", "birth", "DOB", "出生", "生日")
LABEL_WORDS = ("证件", "护照", "身份证", "税号", "assport", "SSN", "insurance no", "NINO", "ax number", "ax id", "ax ID", "TIN", "Ausweis", "Steuer", "idNo", ", id")
NUMBER = re.compile(
    r"""(?<![A-Za-z0-9_.+#/-])(?:
      (?P<cn>\d{6}[ ]?\d{8}[ ]?\d{3}[0-9Xx])(?![A-Za-z0-9])
    | (?P<nino>[A-Z]{2}[ ]?\d{2}[ ]?\d{2}[ ]?\d{2}[ ]?[A-D])(?![A-Za-z0-9])
    | (?P<ssn>\d{3}-\d{2}-\d{4})(?![A-Za-z0-9-])
    | (?P<pass>[A-Z]{2}\d{7})(?![A-Za-z0-9-])
    | (?P<card>[CFGHJKLMNPRTVWXYZ](?=[A-Z0-9]{0,7}\d)[CFGHJKLMNPRTVWXYZ0-9]{8})(?![A-Za-z0-9-])
    | (?P<mobile>(?:\(\+?86\)[ ]?|\+?86[ -]?|0086[ -]?)?1[2-9]\d[ -]?\d{4}[ -]?\d{4})(?![A-Za-z0-9]{0,3}\d|-\d)
    | (?P<us>(?:\(\+?1\)[ ]?|\+?1[ .-]|001[ .-]?)?(?:\(\d{3}\)[ ]?|\d{3}[.-])\d{3}[.-]\d{4}|(?:\+1[ ]?)\d{3}[ ]?\d{3}[ ]?\d{4})(?![A-Za-z0-9]{0,3}\d|[.-]\d)
    | (?P<uk>(?:\(\+44\)[ ]?|\+44[ ]?(?:\(0\)[ ]?)?|0044[ ]?|0)7\d{3}[ ]?\d{3}[ ]?\d{3})(?!\d)
    | (?P<fr>(?:\(\+33\)[ ]?|\+33[ ]?|0033[ ]?|0)[1-9](?:[ .]?\d{2}){4})(?!\d|[.]\d)
    | (?P<slash>0\d{2,4}[/][ ]?\d{5,9})(?!\d)
    | (?P<land>0\d{2,3}-\d{7,8})(?![\d-])
    | (?P<spaced>0\d{2,4}[ ]\d{3,4}[ ]\d{3,4})(?![A-Za-z0-9]|[ .-]\d)
    | (?P<plus>(?:\(\+[1-9]\d{0,2}\)|\+[1-9]\d{0,2})(?:[ .-]?\(?\d{1,5}\)?){2,5})(?!\d)
    | (?P<zero>00[1-9]\d{8,13})(?!\d)
    )""",
    re.X,
)
BORN = re.compile(r"(?:\bborn|\bgeboren(?: am)?|date of birth:?|\bDOB:?|出生于|出生日期[:：]?|生日[:：]?) ?((?:19|20)\d\d-\d\d-\d\d)(?!\d)")
LABELLED = re.compile(r"(?:证件(?:号码|号)?|身份证(?:号码|号)?|护照(?:号码|号)?|税号|[Pp]assport(?: no\.?| number)?|SSN|[Nn]ational insurance no\.?|NINO|[Tt]ax (?:number|id|ID)|TIN|Ausweisnummer|Steuernummer|Steuer-ID|\"idNo\"|, id)[\"' :：]{0,4}([A-Z0-9][A-Z0-9-]{5,19})(?![A-Za-z0-9-])")
ZH_ADDRESS = re.compile(r"市[一-鿿]{1,5}[区县镇][一-鿿]{1,8}(?:路|街|巷|道|弄|里|胡同|村)[ ]?\d+(?:号|弄)(?:[ ]?\d+(?:号楼|栋|幢|座|单元|楼|层|室))*")
LEAD_IN = re.compile(r".*(?:住在|住于|寄到|寄往|寄至|送到|送往|位于|地址是|地址为|地址|住址|家住|搬到|来自|[在到址往至于是为])")
EN_STREET = r"(?:Street|Road|Avenue|Lane|Boulevard|Drive|Court|Square|Terrace|Crescent|Place|Close|Way|Blvd\.?|St\.?|Rd\.?|Ave\.?|Ln\.?|Dr\.?|Ct\.?)"
EN_ADDRESS = re.compile(rf"(?<![A-Za-z0-9_.,/-])\d{{1,5}}[A-Z]?(?: [NSEW]\.?)?(?: [A-Z][a-z'’]+){{1,3}} {EN_STREET}(?![A-Za-z0-9_-])(?:,? (?:Apt|Suite|Unit|Flat)\.? ?\w{{1,6}}|,? #\w{{1,6}})?(?:(?:,[ ]?|\r?\n)(?:[A-Z][a-z]+)(?: [A-Z][a-z]+)?(?: \d{{5}})?(?![A-Za-z]))?")
DE_ADDRESS = re.compile(r"(?<![A-Za-zÄÖÜäöüß])(?:[A-ZÄÖÜ][a-zäöüß]+(?:er|en|e) (?:Weg|Straße|Strasse|Str\.|Gasse|Platz|Allee|Ring|Ufer|Damm)|[A-ZÄÖÜ][a-zäöüß]{2,}(?:weg|straße|strasse|str\.|gasse|platz|allee|ring|ufer|damm)) \d{1,4}[a-z]?(?![\w-])(?:, \d{5} [A-ZÄÖÜ][a-zäöüß]+)?")
#: German streets that are named by a place, with their postal code; Romance streets, the kind of the street first.
AT_ADDRESS = re.compile(r"(?<![A-Za-zÄÖÜäöüß])(?:Am|An der|Im|In der|In den|Zum|Zur|Beim|Auf dem|Auf der|Unter den|Hinter dem|Hinter der|Vor dem) [A-ZÄÖÜ][a-zäöüß-]+(?: [A-ZÄÖÜ][a-zäöüß-]+)? \d{1,4}[a-z]?, \d{5} [A-ZÄÖÜ][a-zäöüß]+")
_SMALL = r"(?:(?:de|du|des|la|le|les|del|los|las|da|do|dos|di|dei|della|delle) |l'|d'|l’|d’)*"
ROMANCE = r"[A-ZÀ-Þ][A-Za-zÀ-ÿ'’-]+(?: [A-ZÀ-Þ][A-Za-zÀ-ÿ'’-]+){0,2}"
FR_ADDRESS = re.compile(rf"(?<![A-Za-z0-9_.,/-])\d{{1,4}}(?: ?(?:bis|ter))?,? (?:[Rr]ue|[Aa]venue|[Bb]oulevard|[Pp]lace|[Aa]llée|[Cc]hemin|[Ii]mpasse|[Qq]uai|[Cc]ours) {_SMALL}{ROMANCE}(?:, \d{{5}} {ROMANCE})?")
ES_ADDRESS = re.compile(rf"(?<![A-Za-zÀ-ÿ])(?:Calle|Avenida|Plaza|Paseo|Via|Viale|Piazza|Corso|Rua|Praça) {_SMALL}{ROMANCE},? \d{{1,4}}(?![\w-])(?:, \d{{4,5}}(?:-\d{{3}})? {ROMANCE})?")
FR_WORDS = tuple(f"{w} " for a in ("rue", "avenue", "boulevard", "place", "allée", "chemin", "impasse", "quai", "cours") for w in (a, a.capitalize()))
ES_WORDS = ("Calle ", "Avenida ", "Plaza ", "Paseo ", "Via ", "Viale ", "Piazza ", "Corso ", "Rua ", "Praça ")
POSTAL = re.compile(r", \d{5} [A-ZÄÖÜ]")


def address_patterns(t: str) -> list[re.Pattern]:
    """The patterns of addresses that can be in the text, by what each of them needs."""
    out = [EN_ADDRESS, DE_ADDRESS]
    if POSTAL.search(t):
        out.append(AT_ADDRESS)
    if any(w in t for w in FR_WORDS):
        out.append(FR_ADDRESS)
    if any(w in t for w in ES_WORDS):
        out.append(ES_ADDRESS)
    return out


WORD = re.compile(r"(?<![A-Za-z0-9_@.+#`$-])[A-Z][A-Za-z]{3,}(?![A-Za-z0-9_@+])")
GLUED = re.compile(r"(?:[A-Z][a-z]{3,}|[A-Z]{4,})(?=[A-Z][a-z])")
INITIAL_BEFORE = re.compile(r"(?:(?<![A-Za-z0-9_.])([A-Z])\. ?)(?:[A-Z]\. ?)?$")
GIVEN_BEFORE = re.compile(r"(?<![A-Za-z0-9_@.+#`$-])([A-Z][A-Za-z]{2,})(?:[ ]+[A-Z]\.?)?[ ]+$")
GIVEN_AFTER = re.compile(r"(?:, ?| )(?:([A-Z][A-Za-z]{2,})(?![A-Za-z0-9_@])(?: [A-Z]\.(?![A-Za-z]))?|([A-Z])\.(?![A-Za-z0-9]))")

Span = tuple[int, int, str, str]


def domain_end(t: str, at: int) -> int:
    """Where the domain that begins at ``at`` ends, 0 if there is none. Versions are no domains; words glued to its end do not count."""
    m = DOMAIN.match(t, at)
    if not m or re.match(r"v?\d+\.\d", m.group()):
        return 0
    end = m.end()
    while last := LAST_LABEL.search(t[at:end]):
        top = last.group(1)
        if top.isalpha() and 2 <= len(top) <= 24 and (top.islower() or t[at:end].isupper() or top.isupper()):
            return end
        end = at + last.start()
    return 0


# --- names by shape and context

#: Documents that the model of context is learned from at most, and characters of each.
TRAIN_DOCUMENTS, TRAIN_CHARS = 2000, 4000
#: Log-odds from which on words are a name.
SURE = 1.0
#: It begins with a set of letters, which is fast to look for; what must not be before it is checked behind the first.
CAPITALS = re.compile(r"[A-ZÀ-Þ](?<![A-Za-zÀ-ÿ0-9_@.+#`$/'’-].)[a-zß-ÿ]+(?: [A-Z]\.)?(?:[ ][A-ZÀ-Þ][a-zß-ÿ]+(?:[-'’][A-ZÀ-Þ][a-zß-ÿ]+)?){1,2}(?![A-Za-zÀ-ÿ0-9_@(/-])")
#: The most common Chinese family names of one character.
SURNAMES = "王李张刘陈杨黄赵周吴徐孙马朱胡郭何高林罗郑梁谢宋唐许韩冯邓曹彭曾肖田董潘袁蔡蒋余杜叶程苏魏吕丁任卢姚沈钟姜崔谭陆范汪廖石金韦贾夏付方白邹熊孟秦邱江尹薛阎段雷侯龙史陶贺顾毛郝龚邵万钱严覃武戴莫孔向汤"
#: Signs that a person follows.
HAN_CUES = "由请找给与和、：系问叫谢据跟"
HAN_NAME = re.compile(f"[{SURNAMES}](?:(?<![一-鿿].)[一-鿿]{{1,2}}(?![一-鿿])|(?<=[{HAN_CUES}].)[一-鿿]{{2}}(?=[，。、；：）（]|负责|提供|反馈|确认|说|表示|处理|审批|跟进))")
TOKEN_BEFORE = re.compile(r"([^\W\d_]+|[^\w\s]|\n)[ \t]*$")
TOKEN_AFTER = re.compile(r"[ \t]*([^\W\d_]+|[^\w\s]|\n)")


def _around(t: str, a: int, b: int) -> tuple[str, str]:
    """The word or sign before and the one behind; of a run of ideographs the nearest one."""
    before, after = TOKEN_BEFORE.search(t, max(0, a - 40), a), TOKEN_AFTER.match(t, b)
    p, n = before.group(1) if before else "", after.group(1) if after else ""
    return p[-1:] if "一" <= p[-1:] <= "鿿" else p.lower(), n[:1] if "一" <= n[:1] <= "鿿" else n.lower()


class ContextModel:
    """Log-odds of name against other words, of the same shape, from what is before, what is behind, and how many of the words are also
    written in lower case."""

    def __init__(self, seen: dict[bool, list[tuple[str, ...]]], lower: frozenset[str]):
        self.lower = lower
        self.odds: dict[str, float] = {}
        counts = {y: Counter(f for features in rows for f in features) for y, rows in seen.items()}
        total = {y: len(rows) + 2 for y, rows in seen.items()}
        for f in counts[True] | counts[False]:
            if counts[True][f] + counts[False][f] >= 3:
                self.odds[f] = math.log((counts[True][f] + 1) / total[True]) - math.log((counts[False][f] + 1) / total[False])

    @staticmethod
    def features(t: str, a: int, b: int, lower: frozenset[str]) -> tuple[str, ...]:
        before, after = _around(t, a, b)
        out = [f"<{before}"] if before else []
        out += [f">{after}"] if after else []
        if t[a] < "一":
            out.append(f"={int(any(w.lower() in lower for w in re.findall(r"[^\W\d_]{2,}", t[a:b])))}")
        return tuple(out)

    def score(self, t: str, a: int, b: int) -> float:
        return sum(self.odds.get(f, 0.0) for f in self.features(t, a, b, self.lower))

    def han(self, t: str, a: int, b: int) -> bool:
        """Whether ideographs in the shape of a name stand where names stand: before is as before names, and behind speaks not against it."""
        before, after = _around(t, a, b)
        return bool(before) and (self.odds.get(f"<{before}", 0.0) > 0.5 or before in HAN_CUES) and self.odds.get(f">{after}", 0.0) >= 0


def learned(texts: Iterable[str | None], stock: NameStock) -> ContextModel:
    """From the names that the stock tells in these texts; words of the same shape that it does not know are no names. Words in lower case
    are those of these texts and of the seed texts of the languages."""
    han = han_pattern(stock)
    plains = [plain(t) for t in texts if t]
    lower = frozenset(w for t in (*plains, *SEEDS.values()) for w in re.findall(r"(?<!\S)[a-zß-ÿ]{2,}(?=[\s,.;:!?]|$)", t))
    seen: dict[bool, list[tuple[str, ...]]] = {True: [], False: []}
    for t in plains:
        names = [(a, b) for a, b, kind, _ in find(t, stock, han) if kind == "name"]
        for a, b in names:
            seen[True].append(ContextModel.features(t, a, b, lower))
        for m in (*CAPITALS.finditer(t), *HAN_NAME.finditer(t)):
            if not any(m.start() < y and x < m.end() for x, y in names):
                seen[False].append(ContextModel.features(t, *m.span(), lower))
    return ContextModel(seen, lower)


def with_context(stock: NameStock, documents: DataFrame) -> NameStock:
    """The stock with a model of context learned from a bounded sample of the documents."""
    some = bounded_sample(documents.where("text is not null").select("doc_id", "text"), TRAIN_DOCUMENTS, ["doc_id", "text"])
    stock.context = learned([r[0] for r in some.select(F.substring("text", 1, TRAIN_CHARS)).collect()], stock)
    return stock


def find(text: str, stock: NameStock, han: re.Pattern | None) -> list[Span]:
    """(start, end, kind, form) of every piece, in order, without overlaps. Positions count code points from 0."""
    t = plain(text)
    out: list[Span] = []
    taken: list[tuple[int, int]] = []

    def add(a: int, b: int, kind: str, form: str) -> None:
        if not any(a < y and x < b for x, y in taken):
            taken.append((a, b))
            out.append((a, b, kind, form))

    for m in AT.finditer(t):
        before = LOCAL.search(t, max(0, m.start() - 64), m.start())
        stop = domain_end(t, m.end())
        if not before or not stop:
            continue
        # a login in a URL, or the address of a repository
        run = t[max(0, before.start() - 200) : before.start()]
        if "://" in re.split(r"\s", run)[-1] or re.match(r":[A-Za-z0-9_~./-]*/", t[stop : stop + 40]):
            taken.append((before.start(), stop))
            continue
        add(before.start(), stop, "email", "")
    for m in (m for c in CLUSTER.finditer(t) for m in NUMBER.finditer(t, c.start(), min(len(t), c.end() + 4))):
        form, s = m.lastgroup, m.group()
        digits = re.sub(r"\D", "", s)
        if form == "cn":
            if valid_cn_id(s.replace(" ", "")):
                add(*m.span(), "id_number", form)
        elif form in ("nino", "ssn", "pass", "card"):
            if form == "card" and sum(c.isdigit() for c in s) > 6:
                continue
            add(*m.span(), "id_number", form)
        elif 8 <= len(digits) <= 15:
            add(*m.span(), "phone", form)
    for m in LABELLED.finditer(t) if any(w in t for w in LABEL_WORDS) else ():
        if any(c.isdigit() for c in m.group(1)):  # what the label says decides, not the shape
            add(*m.span(1), "id_number", "label")
    for m in ZH_ADDRESS.finditer(t):
        head = re.search(r"[一-鿿]{1,8}$", t[max(0, m.start() - 8) : m.start()])
        if not head:
            continue
        city = head.group()
        if lead := LEAD_IN.match(city):
            city = city[lead.end() :]
        elif len(city) > 4:
            city = city[-3:]
        if city:
            add(m.start() - len(city), m.end(), "address", "")
    for pattern in address_patterns(t):
        for m in pattern.finditer(t):
            add(*m.span(), "address", "")
    for m in BORN.finditer(t) if any(w in t for w in BORN_WORDS) else ():
        if parse_day(m.group(1).replace("-", "")):
            add(*m.span(1), "birth_date", "")
    end = 0
    for m in WORD.finditer(t):
        a, b = m.span()
        sure = stock.kind(m.group()) & 10
        if not sure and (part := GLUED.match(m.group())):  # the next sentence follows without a blank
            b = a + part.end()
            sure = stock.kind(part.group()) & 2 and 16
        if a < end or not sure:
            continue
        g = GIVEN_BEFORE.search(t, max(end, a - 40), a)
        if g and stock.kind(g.group(1)) & 5:
            a = g.start(1)
        elif sure & 2 and (i := INITIAL_BEFORE.search(t, max(end, a - 8), a)):
            a = i.start(1)
        else:
            g = GIVEN_AFTER.match(t, b)
            if not g or not sure & 2 or (g.group(1) and not stock.kind(g.group(1)) & 5):
                continue
            b = g.end()
        end = b
        add(a, b, "name", "")
    if han:
        for m in han.finditer(t):
            add(*m.span(), "name", "")
    if stock.context:
        for m in CAPITALS.finditer(t):
            a, b = m.span()
            first, _, rest = m.group().partition(" ")
            if " " in rest and first.lower() in stock.context.lower:  # the first word of a sentence
                a += len(first) + 1
            if stock.context.score(t, a, b) >= SURE:
                add(a, b, "name", "")
        for m in HAN_NAME.finditer(t) if not t.isascii() else ():
            if stock.context.han(t, *m.span()):
                add(*m.span(), "name", "")
    return sorted(out)


def han_pattern(stock: NameStock) -> re.Pattern | None:
    if not stock.han_family or not stock.han_given:
        return None
    f, g = ("|".join(map(re.escape, sorted(x, key=len, reverse=True))) for x in (stock.han_family, stock.han_given))
    return re.compile(f"(?:{f})[ ·•]?(?:{g})|(?:{g})[ ·•](?:{f})")


def placeholder(f: Feistel, kind: str, form: str, s: str) -> str:
    """The typed placeholder of a piece: numbers and dates become others of the same format, other pieces a keyed tag."""
    p = plain(s)
    if form == "cn":
        c = pseudonym_cn_id(f, p.replace(" ", ""))
        shown = f"{c[:6]} {c[6:14]} {c[14:]}" if " " in p else c
    elif kind == "birth_date":
        shown = f.date(parse_day(p.replace("-", "")), b"b").isoformat()
    elif kind == "id_number":
        shown = pseudonym_id(f, p)
    elif kind == "phone":
        keep = 0
        if m := re.match(r"\(?(\+|00)(\d+)", p):
            code = {"us": 1, "mobile": 2, "uk": 2, "fr": 2, "zero": 1}.get(form, min(2, len(m.group(2))))
            keep = code + (2 if m.group(1) == "00" else 0)  # the country stays
        shown = pseudonym_digits(f, p, keep)
    else:
        shown = f.tag(kind, re.sub(r"\s+", " ", p).lower())
    return f"[{kind.upper()} {shown}]"


def _scanner(stock: NameStock, key: bytes) -> Callable[[str | None], tuple[str | None, list[tuple[str, int, int, str]]]]:
    han, f = han_pattern(stock), Feistel(key)

    def scan(text):
        if not text:
            return text, []
        parts, rows, at = [], [], 0
        for a, b, kind, form in find(text, stock, han):
            new = placeholder(f, kind, form, text[a:b])
            parts += [text[at:a], new]
            rows.append((kind, a + 1, b - a, new))
            at = b
        return "".join([*parts, text[at:]]), rows

    return scan


FOUND = "doc_id bigint, text string, findings array<struct<kind:string,start_at:bigint,length:bigint,placeholder:string>>"


def redact(documents: DataFrame, contributors: DataFrame, key: bytes) -> DataFrame:
    """(doc_id, text, findings): every row's text with placeholders for what was found, and the findings with their 1-based positions.

    Kinds are those of KINDS, and birth_date for dates said to be of birth. Null and empty texts stay as they are and have no findings; a
    null doc_id stays null, repeated rows are rows. The key decides the pseudonyms; the same value has the same one in every document. Who
    has the key can undo them, so it is for the caller to choose and to keep; an empty one is an error.
    """
    if not key:
        raise ValueError("pseudonyms need a key")
    stock = with_context(name_stock(contributors), documents)

    def run(batches):
        scan = _scanner(stock, key)
        schema = pa.list_(pa.struct([("kind", pa.string()), ("start_at", pa.int64()), ("length", pa.int64()), ("placeholder", pa.string())]))
        for batch in batches:
            texts, found = [], []
            for text in batch.column(1).to_pylist():
                new, rows = scan(text)
                texts.append(new)
                found.append([dict(zip(("kind", "start_at", "length", "placeholder"), r)) for r in rows])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(found, schema)], ["doc_id", "text", "findings"])

    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, FOUND)


def findings(documents: DataFrame, contributors: DataFrame, key: bytes) -> DataFrame:
    """(doc_id, kind, start_at, length, placeholder): one row for each piece of the kinds in KINDS."""
    one = redact(documents, contributors, key).select("doc_id", F.explode("findings").alias("f")).select("doc_id", "f.*")
    return one.where(F.col("kind").isin(*KINDS))
