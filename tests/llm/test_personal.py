"""Personal information: kinds, positions, what is none, and pseudonyms."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sievework.llm import personal, pseudonym
from sievework.llm.pseudonym import Feistel

GIVEN = ["Zelune", "Zelika", "Ostika", "Ostora", "Jorael", "Jorika", "Kaelune", "Kaelael", "Havisk", "Tobisk"]
FAMILY = ["Nysby", "Nysshaw", "Lodkander", "Lodshaw", "Wexlowe", "Wexby", "Harglowe", "Hargshaw", "Korvath", "Thalvath", "Thalkander", "Korby"]
STOCK = personal.NameStock(personal.name_parts(GIVEN), personal.name_parts(FAMILY), ("棠筝", "旸野"), ("公冶", "淳于"))
ID = "11010519491231002X"


def found(text):
    return [(k, text[a:b]) for a, b, k, _ in personal.find(text, STOCK, personal.han_pattern(STOCK)) if k in personal.KINDS]


@pytest.mark.parametrize(
    "text,want",
    [
        ("cc Zelune Nysby, T. Lodshaw and Wexlowe, Ostika.", [("name", "Zelune Nysby"), ("name", "T. Lodshaw"), ("name", "Wexlowe, Ostika")]),
        ("Mrs Jorael HARGLOWE wrote; Kaelune Y. Korvath agreed.", [("name", "Jorael HARGLOWE"), ("name", "Kaelune Y. Korvath")]),
        ("感谢公冶棠筝和Tobika Thalkander的评审意见", [("name", "公冶棠筝"), ("name", "Tobika Thalkander")]),
        ("联系Kaelika Lodshaw（邮箱：x）和Ostika Wexby`go`，抄送Havisk W. HargloweMandateFactory 会", [("name", "Kaelika Lodshaw"), ("name", "Ostika Wexby"), ("name", "Havisk W. Harglowe")]),
        ("mail zelune.nysby+pricing@post.example.Then go", [("email", "zelune.nysby+pricing@post.example")]),
        ("a [at] b.example, c(at)d(dot)example, e at f dot example. g＠h.test", [("email", "a [at] b.example"), ("email", "c(at)d(dot)example"), ("email", "e at f dot example"), ("email", "g＠h.test")]),
        ("也可以发邮件到K-B@POST.EXAMPLE。", [("email", "K-B@POST.EXAMPLE")]),
        ("Tel. (415) 555-0143, +44 7700 900893, 030/23125763, 06 39 98 88 26, 0013125550125", [("phone", "(415) 555-0143"), ("phone", "+44 7700 900893"), ("phone", "030/23125763"), ("phone", "06 39 98 88 26"), ("phone", "0013125550125")]),
        ("手机：（+８６）１２１６５１２２３７３⏎", [("phone", "（+８６）１２１６５１２２３７３")]),
        ("call 124-9129-3445结果 or 617.555.0164 ext. 42", [("phone", "124-9129-3445"), ("phone", "617.555.0164")]),
        (f"证件 {ID} 未脱敏, SSN 945-88-3556, QQ 42 06 31 D列", [("id_number", ID), ("id_number", "945-88-3556"), ("id_number", "QQ 42 06 31 D")]),
        ("id XZ2637774, SSN: X0ZLLZN09", [("id_number", "XZ2637774"), ("id_number", "X0ZLLZN09")]),
        ("住在云栖洲市北汀区听潮大道1560号4单元，", [("address", "云栖洲市北汀区听潮大道1560号4单元")]),
        ("Ship to 1728 Dray Horse Street, Apt 9, Ombraville.", [("address", "1728 Dray Horse Street, Apt 9, Ombraville")]),
        ("geht an Lindwurmgasse 48, 00739 Tarnfeld, zu", [("address", "Lindwurmgasse 48, 00739 Tarnfeld")]),
    ],
)
def test_found(text, want):
    assert found(text) == want


@pytest.mark.parametrize(
    "text",
    [
        "Pinned to ledger-core@2.14.1 and router@0.9.0-rc3.VendorFactory", "Clone it from git@code.internal.test:session/amber.git", "amqp://nectar:Hn1z@quota.internal.test:5132/", "`${user}@${host}` and %s@%s @Service and @Retryable(times=3)",
        "快照编号 20231399887712345678 不是证件号码。", "Lease id 7f3a-99-0131, window 900-12-4400ms.", "Build 20240506123310 replaced build 20240429081502.", "Trace 4820193317745120443 links", "版本 10.4.2-1203 与构建号 1203-5510-88", "端口 18080-18099", "Peers: 203.0.113.14:8443", "Error codes 555-0199X and 4711-22",
        "touches 1482 lines in 14 Street-map fixtures.", "The `KorvathMapper` class and the `@ombra-bot` handle", "Nysby alone, and Zelune alone", "See Section 12, Table 4 and the Release Notes.", "区域路由表第 12 号规则优先。", "110105194912310021 has a wrong check",
    ],
)
def test_not_found(text):
    assert found(text) == []


def test_parts_learn_unseen_names():
    begin, end = STOCK.given
    assert "zel" in begin and "une" in end and STOCK.kind("Zelisk") & 1 and STOCK.kind("Hargby") & 2 and not STOCK.kind("Table")
    assert personal.name_parts([]) == (frozenset(), frozenset())


F = Feistel(b"key")


@settings(max_examples=150, deadline=None)
@given(st.integers(2, 10**18), st.data())
def test_feistel_is_a_permutation(n, data):
    x = data.draw(st.integers(0, n - 1))
    y = F.number(x, n)
    assert 0 <= y < n and F.number(y, n, inverse=True) == x


def test_feistel_covers_small_domains():
    for n in (2, 3, 7, 10, 100, 365):
        assert sorted(F.number(i, n) for i in range(n)) == list(range(n))
    assert [Feistel(b"a").number(i, 1000) for i in range(20)] != [Feistel(b"b").number(i, 1000) for i in range(20)]


@settings(max_examples=100, deadline=None)
@given(st.dates(dt.date(1900, 1, 1), dt.date(2059, 12, 31)), st.integers(0, 999), st.integers(100000, 999999))
def test_identity_numbers_stay_valid(day, serial, region):
    body = f"{region}{day:%Y%m%d}{serial:03d}"
    s = body + pseudonym.cn_check(body)
    p = pseudonym.pseudonym_cn_id(F, s)
    assert pseudonym.valid_cn_id(p) and p[:6] == s[:6] and pseudonym.pseudonym_cn_id(F, p, inverse=True) == s


def test_redaction_links_equal_values(spark):
    people = spark.createDataFrame([(g, f, "latn") for g, f in zip(GIVEN, FAMILY)] + [("棠筝", "公冶", "hani"), (None, None, "latn")], "given_name string, family_name string, script string")
    docs = [(1, f"Zelune Nysby, {ID}, +44 7700 900893, born 1987-04-12"), (2, f"cc Zelune Nysby; {ID[:6]} {ID[6:14]} {ID[14:]}"), (3, None), (4, ""), (5, "x" * 50_000), (1, "+44 7700 900893")]
    df = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id bigint, text string, findings string")
    rows = personal.redact(df, people, b"key").collect()
    assert len(rows) == 6
    one = next(r for r in rows if r.doc_id == 1 and len(r.findings) > 1)
    assert [f.kind for f in one.findings] == ["name", "id_number", "phone", "birth_date"]
    tag = one.findings[0].placeholder
    two = next(r for r in rows if r.doc_id == 2)
    assert two.findings[0].placeholder == tag and two.findings[1].placeholder.replace(" ", "") == one.findings[1].placeholder.replace(" ", "")
    assert any(r.text == one.findings[2].placeholder for r in rows) and one.findings[2].placeholder.startswith("[PHONE +44 ")
    assert "Zelune" not in one.text and ID not in one.text and one.findings[1].start_at == 15
    assert {(r.doc_id, r.text, len(r.findings)) for r in rows if r.doc_id in (3, 4)} == {(3, None, 0), (4, "", 0)}
    assert personal.findings(df.limit(0), people, b"key").count() == 0


@pytest.mark.parametrize("s,form", [("X0ZLLZN09", "card"), ("XZ2637774", "pass"), ("QQ 42 06 31 D", "nino"), ("AB-12345-CD6789", "label"), ("945-88-3556", "ssn")])
def test_letters_of_identity_numbers_are_permuted(s, form):
    p = pseudonym.pseudonym_id(F, s)
    shape = lambda x: ["A" if c.isalpha() else "0" if c.isdigit() else c for c in x]
    assert shape(p) == shape(s) and pseudonym.pseudonym_id(F, p, inverse=True) == s
    letters = lambda x: "".join(c for c in x if c.isalpha())
    assert not letters(s) or letters(p) != letters(s)
    assert personal.placeholder(F, "id_number", form, s) == f"[ID_NUMBER {p}]"
    if form in ("card", "pass", "nino"):
        assert personal.NUMBER.fullmatch(p).lastgroup == form


def test_spacing_does_not_change_a_pseudonym():
    assert pseudonym.pseudonym_id(F, "QQ 42 06 31 D").replace(" ", "") == pseudonym.pseudonym_id(F, "QQ420631D")
    values = [f"A{i}{c}" for i in range(10) for c in "ABCD"]
    assert len({pseudonym.pseudonym_id(F, v) for v in values}) == len(values)


@pytest.mark.parametrize("text,want", [("id card LTZ4K7M2P, ok", "LTZ4K7M2P"), ("卡号LTZKMNP4H。", "LTZKMNP4H"), ('"CFGHJKLM7"', "CFGHJKLM7"), ("x, id: AB-12345", "AB-12345"), ("x, id'A123456'", "A123456")])
def test_numbers_with_leading_letters(text, want):
    assert found(text) == [("id_number", want)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["LTZ4K7M2P", "CFGHJKLM7", "X0ZLLZN09", "QQ 42 06 31 D", "XZ2637774", "945-88-3556", "(+86) 12165122373", "030/2312576", "+44 7700 900893", "0013125550125", ID, ", ", " ", "a", "证", "Z", "7", "OK", "(", "-", "\n"]), max_size=8).map("".join))
def test_the_prefilter_loses_no_number(t):
    fits = lambda m: m.lastgroup not in ("us", "uk", "fr", "plus", "zero", "mobile", "slash", "land") or 8 <= sum(c.isdigit() for c in m.group()) <= 15
    want = {m.span() for m in personal.NUMBER.finditer(t) if fits(m)}
    assert want <= {m.span() for c in personal.CLUSTER.finditer(t) for m in personal.NUMBER.finditer(t, c.start(), min(len(t), c.end() + 4))}


TRAINING = [f"The patch of {g} {f} was merged. Please ask {g} {f} about it, or contact {f}, {g}." for g in GIVEN for f in FAMILY] + ["See Section 4 and the Release Notes. Die Liste wird sortiert. Der Eintrag bleibt.", "抄送：公冶棠筝、淳于旸野。由公冶旸野提供。"] * 30


@pytest.mark.parametrize(
    "text,want",
    [
        ("Please contact Elena Petrova about this.", "Elena Petrova"), ("Rajesh Gupta approved the change.", "Rajesh Gupta"), ("Ask Sarah Johnson about it.", "Sarah Johnson"),
        ("John Smith called.", "John Smith"), ("请联系王小明，谢谢。", "王小明"), ("抄送：王小明、公冶棠筝。", "王小明"), ("See Section 4", None), ("Die Methode", None), ("任务和安全性由高并发保证", None), ("the Release Notes", None),
    ],
)
def test_names_beyond_the_stock(text, want):
    stock = personal.NameStock(STOCK.given, STOCK.family, STOCK.han_given, STOCK.han_family)
    stock.context = personal.learned(TRAINING, stock)
    got = [text[a:b] for a, b, k, _ in personal.find(text, stock, personal.han_pattern(stock)) if k == "name"]
    assert got[:1] == ([want] if want else [])


@pytest.mark.parametrize("text,want", [("call 020 7946 0958 now", "020 7946 0958"), ("ring +81 3-1234-5678.", "+81 3-1234-5678"), ("at 12 Rue de la Paix, 75002 Paris today", "12 Rue de la Paix, 75002 Paris"), ("home Am Torfstich 187, 00252 Oberstenau.", "Am Torfstich 187, 00252 Oberstenau"), ("vive en Calle Mayor 5, 28013 Madrid", "Calle Mayor 5, 28013 Madrid"), ("Passport X0ZO5ZOTI was", "X0ZO5ZOTI"), ("National insurance no. X0ZU8DIIW, x", "X0ZU8DIIW")])
def test_more_forms(text, want):
    assert [w for _, w in found(text)] == [want]


def test_a_key_is_needed(spark):
    people = spark.createDataFrame([], "given_name string, family_name string, script string")
    docs = spark.createDataFrame([(1, "x")], "doc_id bigint, text string")
    with pytest.raises(ValueError):
        personal.redact(docs, people, b"")
    assert len(F.tag("name", "x")) == 24
