"""Defects of prompt and response pairs."""

from __future__ import annotations

import pytest

from sievework.llm import pair_defects
from sievework.llm.language import LANGUAGES, log_posteriors

EN = "The list is sorted before it is cut, which keeps pages stable. Only one branch touches the database; all others answer from memory."
DE = "Die Liste wird erst sortiert und dann gekürzt. Nur ein Zweig erreicht die Datenbank, alle anderen antworten aus dem Speicher."
ZH = "列表在截断之前排序，这样分页依旧稳定。只有一个分支会访问数据库，其余分支都由内存应答。"
FR = "La liste est triée avant d'être coupée. Seule cette branche interroge la base, les autres répondent depuis la mémoire."
Q = "How does `attachDigest` in StockPlanner behave during a rolling restart, given that a second retry reaches it?"
QZH = "为什么 StockPlanner 要在 `attachDigest` 里读取 `cache.ttl`？截止时间之后又会造成什么后果？"
CODE = "Like this:\n```java\nif (a == null) {\n    return b(1);\n}\n```"

CASES = [
    (Q, EN, None), (Q, DE, "other_language"), (Q, FR, "other_language"), (Q, ZH, "other_language"), (QZH, ZH, None), (QZH, EN, "other_language"),
    (QZH + "请用英文回答。", EN, None), (Q + " Please answer in Chinese.", ZH, None), (Q + " Please answer in Chinese.", EN, None), (Q, None, "empty"), (Q, " \n\u3000", "empty"),
    (Q, "……", "empty"), (Q, "```\n```", "empty"), (Q, "TODO", "empty"), (Q, "N/A", "empty"), (QZH, "无", "empty"), (Q, "()", "empty"),
    (Q, "I'm sorry, but I can't help with questions about StockPlanner.", "refusal"), (Q, "No answer can be given here; the topic of `cache.ttl` is off limits for this assistant.", "refusal"),
    (QZH, "很遗憾，我没有办法提供您需要的内容，请咨询相关负责人。", "refusal"), (QZH, "此类内容不予解答。", "refusal"),
    (Q, EN + ' The bot answers with "Sorry, I can\'t help with this request" and status 4.', None), (Q, "No, see `trimIntake`.", None), (Q, "The default is 0.", None), (QZH, "不会，见 `trimIntake`。", None),
    (Q, Q, "copied"), (Q, "> " + Q.lower(), "copied"), (Q, "Question: " + Q + "\n" + Q, "copied"), (Q, Q + " " + EN + EN, None),
    (Q, EN[:-14], "truncated"), (QZH, ZH[:-6], "truncated"), (Q, EN + "\n```java\nfor (Stock item :", "truncated"), (Q, CODE, None), (Q, EN + " Raising `cache.t", "truncated"), (QZH, ZH + "\n\n具体步骤如下：", "truncated"),
]


def test_cases(spark):
    filler = [(1000 + i, Q, t) for i, t in enumerate([EN, DE, ZH, CODE] * 40)]
    rows = [(i, q, a) for i, (q, a, _) in enumerate(CASES)]
    df = spark.createDataFrame([(*r, "clash") for r in rows + filler + [(5000, None, EN), (5001, None, None)]], "rec_no bigint, instruction string, answer string, defect string")
    got = {r.rec_no: r.defect for r in pair_defects.defects(df).where("rec_no < 1000 or rec_no >= 5000").collect()}
    want = {i: d for i, (_, _, d) in enumerate(CASES) if d} | {5001: "empty"}
    assert got == want, {i: (got.get(i), want.get(i), CASES[i][1] if i < 1000 else None) for i in set(got) | set(want) if got.get(i) != want.get(i)}


@pytest.mark.parametrize("text,lang", [(EN, "en"), (DE, "de"), (FR, "fr"), (ZH, "zh"), ("El método vuelve si no hay nada que hacer y espera otra señal.", "es"), ("これはテストです。よろしくお願いします。", "ja")])
def test_languages(text, lang):
    scores, letters = log_posteriors([text, ""])
    assert LANGUAGES[int(scores[0].argmax())] == lang and letters[1] == 0


def test_empty_table(spark):
    assert pair_defects.defects(spark.createDataFrame([], "rec_no bigint, instruction string, answer string")).count() == 0


def test_defects_have_no_greatest_length(spark):
    long_refusal = "I'm sorry, but I cannot discuss this topic. " + "Unfortunately I am unable to answer questions about StockPlanner and I must decline. " * 9 + "Please contact your team."
    rows = [(0, Q, long_refusal), (1, Q, " " * 80), (2, Q, "-" * 3000), (3, Q, "\n" * 70 + "TODO" + "." * 70), (4, Q, long_refusal + " " + EN * 3), (5, Q, "." * 100_000 + EN)]
    got = {r.rec_no: r.defect for r in pair_defects.defects(spark.createDataFrame(rows, "rec_no bigint, instruction string, answer string")).collect()}
    assert len(long_refusal) > 600 and got == {0: "refusal", 1: "empty", 2: "empty", 3: "empty"}


OTHERS = {
    "es": ("Solo una rama toca la base de datos; las demás responden desde la memoria.", "Lo siento, no puedo responder a esta pregunta."),
    "pt": ("Apenas um ramo acessa o banco de dados; os outros respondem da memória.", "Desculpe, não posso responder a esta pergunta."),
    "it": ("Solo un ramo tocca la base di dati; gli altri rispondono dalla memoria.", "Mi dispiace, non posso rispondere a questa domanda."),
    "pl": ("Tylko jedna gałąź korzysta z bazy danych, pozostałe odpowiadają z pamięci.", "Niestety nie mogę odpowiedzieć na to pytanie."),
    "sv": ("Endast en gren använder databasen, de andra svarar ur minnet.", "Tyvärr kan jag inte svara på den frågan."),
    "tr": ("Yalnızca bir dal veritabanına dokunur, diğerleri bellekten yanıt verir.", "Üzgünüm, bu soruya cevap veremiyorum."),
    "ru": ("Только одна ветвь обращается к базе данных, остальные отвечают из памяти.", "Извините, я не могу ответить на этот вопрос."),
    "ja": ("データベースに触れるのは一つの分岐だけで、ほかはメモリから答えます。", "申し訳ありませんが、この質問にはお答えできません。"),
    "ko": ("데이터베이스에 접근하는 분기는 하나뿐이며 나머지는 메모리에서 응답합니다.", "죄송하지만 이 질문에는 답변할 수 없습니다."),
    "el": ("Μόνο ένας κλάδος αγγίζει τη βάση δεδομένων, οι άλλοι απαντούν από τη μνήμη.", "Λυπάμαι, δεν μπορώ να απαντήσω σε αυτή την ερώτηση."),
    "ar": ("فرع واحد فقط يصل إلى قاعدة البيانات، والبقية تجيب من الذاكرة.", "عذرًا، لا أستطيع الإجابة عن هذا السؤال."),
    "hi": ("केवल एक शाखा डेटाबेस तक पहुँचती है, बाकी स्मृति से उत्तर देती हैं।", "क्षमा करें, मैं इस प्रश्न का उत्तर नहीं दे सकता।"),
    "th": ("มีเพียงสาขาเดียวที่เข้าถึงฐานข้อมูล สาขาอื่นตอบจากหน่วยความจำ", "ขออภัย ฉันไม่สามารถตอบคำถามนี้ได้"),
}


def test_other_scripts_and_languages(spark):
    rows, want = [], {}
    for k, (lang, (prose, refusal)) in enumerate(OTHERS.items()):
        rows += [(2 * k, Q, prose), (2 * k + 1, Q, refusal)]
        want |= {2 * k: "other_language", 2 * k + 1: "refusal"}
        assert LANGUAGES[int(log_posteriors([prose])[0][0].argmax())] in (lang, "fa" if lang == "ar" else lang)
    got = {r.rec_no: r.defect for r in pair_defects.defects(spark.createDataFrame(rows, "rec_no bigint, instruction string, answer string")).collect()}
    assert got == want


def test_repeated_questions_and_bare_items(spark):
    rows = [(0, Q, (Q + "\n") * 12), (1, Q, EN + "\n4."), (2, Q, EN[:-14] + "\n-")] + [(100 + i, Q, t) for i, t in enumerate([EN, DE, ZH, CODE] * 9)]
    got = {r.rec_no: r.defect for r in pair_defects.defects(spark.createDataFrame(rows, "rec_no bigint, instruction string, answer string")).where("rec_no < 100").collect()}
    assert got == {0: "copied", 2: "truncated"}


def test_copies_of_a_cut_answer_stay_truncated(spark):
    rows = [(i, Q, EN) for i in range(60)] + [(100 + i, Q, EN[:-14]) for i in range(40)]
    got = {r.rec_no: r.defect for r in pair_defects.defects(spark.createDataFrame(rows, "rec_no bigint, instruction string, answer string")).collect()}
    assert got == {100 + i: "truncated" for i in range(40)}


def test_labelled_rows_sharpen_the_model():
    from sievework.llm.language import fit, label_of

    assert [label_of(x) for x in ("EN", "en_US", " chinese ", "zh-CN", "mix", None, "")] == ["en", "en", "zh", "zh", None, None, None]
    model = fit([(EN + " " + Q, "en")] * 40 + [(DE, "de-DE"), (ZH, "en"), (None, "en"), (EN, None)])
    assert [LANGUAGES[i] for i in model.log_posteriors([EN, DE, ZH, FR])[0].argmax(axis=1)] == ["en", "de", "zh", "fr"]
