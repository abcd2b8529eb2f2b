"""Broken prompt and response pairs, each with the kind of its defect.

In this order: empty, refusal, copied, other_language, truncated. Languages are compared by the posteriors of a naive Bayes model over
character trigrams; truncation is told by the likelihood of an end behind the last characters of an answer, from character n-grams of all
different answers.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.language import LANGUAGES, LanguageModel, fit
from sievework.llm.shingles import Normal, blocks
from sievework.operators.ranking import bounded_sample

DEFECTS = ("empty", "truncated", "refusal", "copied", "other_language")
FENCE = re.compile(r"```.*?(?:```|\Z)", re.S)
CODE = re.compile(r"`[^`\n]*`|https?://\S+|\b\w*(?:_\w+|[a-z][A-Z]\w*|\d\w*)\b")
PLACEHOLDER = re.compile(r"(?i)\W*(?:todo|tbd|tba|fixme|n/?a|null|none|nil|nan|undefined|empty|placeholder|no answer|answer|your answer here|待补充|待定|待填写|无|暂无|空|略|未填写|占位符?|同上)?\W*")
ASKED = (
    (re.compile(r"(?i)\bin english\b|auf englisch|en anglais|英文|英语"), "en"),
    (re.compile(r"(?i)\bin (?:chinese|mandarin)\b|auf chinesisch|en chinois|中文|汉语"), "zh"),
    (re.compile(r"(?i)\bin german\b|auf deutsch|en allemand|德文|德语"), "de"),
    (re.compile(r"(?i)\bin french\b|auf französisch|en français|法文|法语"), "fr"),
    (re.compile(r"(?i)\bin spanish\b|auf spanisch|en espagnol|西班牙语"), "es"),
    (re.compile(r"(?i)\bin italian\b|auf italienisch|意大利语"), "it"),
    (re.compile(r"(?i)\bin japanese\b|auf japanisch|日文|日语|日本語で"), "ja"),
    (re.compile(r"(?i)\bin russian\b|auf russisch|俄语|俄文|по-русски"), "ru"),
    (re.compile(r"(?i)\bin korean\b|auf koreanisch|韩语|한국어로"), "ko"),
    (re.compile(r"(?i)\bin portuguese\b|auf portugiesisch|葡萄牙语|em português"), "pt"),
    (re.compile(r"(?i)\bin dutch\b|auf niederländisch|荷兰语"), "nl"),
    (re.compile(r"(?i)\bin arabic\b|auf arabisch|阿拉伯语"), "ar"),
    (re.compile(r"(?i)\btranslat|übersetz|traduis|翻译"), "*"),
)
QUOTED = re.compile(r"\"[^\"\n]*\"|“[^”\n]*”|„[^“”\n]*[“”]|«[^»\n]*»|「[^」\n]*」")
SENTENCE = re.compile(r"[^.!?。！？；।\n]+[.!?。！？；।\n]*")
#: A sentence that declines.
DECLINES = re.compile(
    r"""(?ix)
    \b(?:can(?:no|')t|can\ not|could(?:n't|\ not)|won't|will\ not|would\ (?:rather\ )?not|unable|not\ able|not\ (?:allowed|permitted|comfortable|authori[sz]ed|appropriate)|not\ something\ i|don't\ feel\ comfortable|do\ not\ feel\ comfortable)\b
    | \bdeclin|\brefus|\bmust\ pass|\bhave\ to\ pass|\boff\ limits|\bno\ answer\ can|\boutside\ (?:of\ )?(?:what|my|the\ scope)|\bbeyond\ my|\bas\ an?\ (?:ai|artificial|language)|\bguidelines|\bpolic(?:y|ies)\ (?:prevent|forbid|do)|\bno\ permission
    | 无法|不能(?:回答|提供|讨论|评价|作答|协助|帮|对|透露|告诉)|不便|恕难|恕我|恕不|婉拒|拒绝(?:回答|提供|这个|该)|不予|帮不上|没有办法|不在我|不提供|超出了我|爱莫能助|不方便
    | kann\ (?:ich\ )?[^.]*nicht|nicht\ (?:beantworten|möglich|erlaubt|gestattet|in\ der\ lage)|ablehnen|darf\ (?:ich\ )?[^.]*(?:nicht|keine)|leider\ (?:nicht|keine)
    | ne\ (?:peux|puis|suis|pouvons)\ [^.]*pas|refuser|désolé
    | no\ (?:puedo|podemos|me\ es\ posible|estoy\ autorizad[oa])\b|imposible\ (?:responder|ayudar)|me\ niego
    | não\ (?:posso|podemos|consigo|me\ é\ possível|estou\ autorizad[oa])\b|recuso
    | non\ (?:posso|possiamo|mi\ è\ possibile|sono\ autorizzat[oa])\b|mi\ rifiuto
    | kan\ (?:ik\ )?[^.]*niet|mag\ (?:ik\ )?[^.]*niet|weiger
    | nie\ (?:mogę|możemy|wolno\ mi)|odmawiam | kan\ (?:jag|jeg|vi)?\ ?[^.]*(?:inte|ikke)\b | nemohu|nemůžeme | nu\ pot\b | nem\ (?:tudok|tudunk|áll\ módomban) | en\ voi\b | (?:cevap\ ver|yardımcı\ ol|yanıtla)\w*(?:emiyorum|amıyorum|emem|amam) | tidak\ (?:dapat|bisa)\ (?:menjawab|membantu) | không\ thể\ (?:trả\ lời|giúp|cung\ cấp)
    | не\ (?:могу|можем|вправе|имею\ права)|отказ|не\ (?:можу|маю\ права)|відмов
    | できません|できかねます|いたしかねます|お断り|お答えできない
    | (?:할|드릴|답변할)\ 수\ 없|어렵습니다|거절
    | δεν\ μπορώ | لا\ (?:أستطيع|يمكنني|أقدر) | نمی‌?توانم | איני\ יכול|אני\ לא\ יכול|לא\ אוכל | नहीं\ (?:दे|कर|बता)\ सकता | ไม่สามารถ
    """
)
#: A sentence in which the one who answers speaks.
SPEAKER = re.compile(r"(?i)\b(?:i|i'm|my|me|we|our|sorry|unfortunately|regret|assistant|ich|mir|meine[rn]?|leider|je|désolé|puedo|podemos|siento|lamento|posso|podemos|desculpe|dispiace|possiamo|scusi|ik|helaas|mogę|niestety|jag|jeg|tyvärr|desværre|nemohu|bohužel|pot|nem|sajnos|voi|valitettavasti|üzgünüm|maaf|saya|xin lỗi|tôi|я|мы|мне|извините|сожалению|простите|можу|жаль|вибачте|μπορώ|λυπάμαι)\b|answer can be given|申し訳|すみません|恐れ入り|お答え|できません|죄송|답변|عذر|أستطيع|متأسف|نمی‌?توانم|מצטער|יכול|क्षमा|मैं|ขออภัย|ฉัน|ผม|cevap|我|抱歉|对不起|很遗憾|不予解答|不予回答|本助手|恕|婉拒|不提供|作为")
COURTESY = re.compile(
    r"(?ix)\b(?:sorry|thanks|thank\ you|unfortunately|apolog|please\ (?:contact|ask|try|reach)|anything\ else|another\ question|happy\ to\ help|contact\ your|hope\ you|understand)\b|抱歉|对不起|谢谢|感谢|请咨询|请联系|换一个|还有其他|请不要|请谅解|敬请|以上|bitte|danke|gern|verständnis|merci|veuillez|gracias|lo siento|por favor|obrigad|desculpe|grazie|mi dispiace|dank u|helaas|alstublieft|proszę|przepraszam|niestety|tack|tyvärr|tak\b|desværre|děkuji|prosím|mulțumesc|sajnálom|kiitos|üzgünüm|teşekkür|lütfen|maaf|terima kasih|xin lỗi|cảm ơn|извините|спасибо|пожалуйста|сожалению|обратитесь|вибачте|дякую|申し訳|すみません|ありがとう|お問い合わせ|ご了承|죄송|감사|문의|συγγνώμη|λυπάμαι|عذر|شكر|متأسف|מצטער|תודה|क्षमा|धन्यवाद|ขออภัย|ขอบคุณ"
)

# --- ends of texts

_PUNCT = "\n .。,，!！?？:：;；…()（）[]{}<>《》`'\"“”‘’「」-—_=+*/\\|&%$#@~^、·"


@cache
def _classes() -> np.ndarray:
    """Letters, digits and ideographs are one class each, every usual mark is its own, all others share one."""
    t = np.full(0x110000, 1, dtype=np.uint8)
    for i in range(0x3000):
        c = chr(i)
        t[i] = 2 if c.isalpha() else 3 if c.isdigit() else 5 if c.isspace() else 1
    t[0x3040:0xD7A4] = 4
    t[0x20000:0x32000] = 4
    for k, c in enumerate(_PUNCT):
        t[ord(c)] = 6 + k
    return t


WIDTH = 128
#: Slots of the table of n-grams; the upper half holds those that end in a mark, so that letters and marks never share one.
SLOTS = 1 << 18
#: Pseudo-counts: of the prior of a character's kind, and of a shorter n-gram behind a longer one.
KIND_WEIGHT, BACKOFF = 20.0, 200.0
#: Prior likelihood of an end behind a letter, digit or mark that opens or joins, and behind any other mark.
OPEN_PRIOR, CLOSED_PRIOR = 1e-4, 0.3
_OPENING = ",，:：;；、([{<（《“‘-—=+*/\\|&@#"
NGRAMS = (2, 3)


def _coded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the texts, each behind pads of 0, digits all as one, their classes, and the places of the last characters."""
    pad = "\0" * max(NGRAMS)
    codes = np.frombuffer("".join(pad + t for t in texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    classes = _classes()[codes]
    return np.where(classes == 3, np.uint32(ord("0")), codes), classes, np.cumsum([len(t) + len(pad) for t in texts]) - 1


def _slots(codes: np.ndarray, classes: np.ndarray, n: int) -> np.ndarray:
    """The slot of the n-gram that ends at each place from n - 1 on."""
    c = codes.astype(np.uint64)
    h = np.full(len(c) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        h = (h ^ c[k : len(c) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    mark = (classes[n - 1 :] >= 6) | (classes[n - 1 :] == 1)
    return (h >> np.uint64(47)).astype(np.int64) + np.where(mark, SLOTS // 2, 0)


def _tally(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """How often each pair of classes, and then each n-gram, ends a text, and stands anywhere in one."""
    codes, classes, ends = _coded(texts)
    inner = codes != 0
    keys = [classes[:-1].astype(np.int64) * WIDTH + classes[1:], *[_slots(codes, classes, n) for n in NGRAMS]]
    last, anywhere = [], []
    for k, (key, lead) in enumerate(zip(keys, (1, *[n - 1 for n in NGRAMS]))):
        size = SLOTS if k else WIDTH * WIDTH
        anywhere.append(np.bincount(key[inner[lead:]], minlength=size))
        last.append(np.bincount(key[ends - lead], minlength=size))
    return np.concatenate(last), np.concatenate(anywhere)


TALLIES = WIDTH * WIDTH + SLOTS * len(NGRAMS)


def end_counts(answers: DataFrame, text: str = "answer") -> np.ndarray:
    """2 x TALLIES: ``_tally`` of all different answers; repeated rows count once, or a text that is cut and copied would seem to end well.

    The table has a fixed size, whatever the corpus, and goes to every task.
    """

    def run(batches):
        total = np.zeros((2, TALLIES), dtype=np.int64)
        for batch in batches:
            rows = batch.column(0).to_pylist()
            lo = 0
            while lo < len(rows):  # about a million characters at a time
                hi, size = lo + 1, len(rows[lo])
                while hi < len(rows) and size + len(rows[hi]) <= 1 << 20:
                    size += len(rows[hi])
                    hi += 1
                total += _tally(rows[lo:hi])
                lo = hi
        at = np.flatnonzero(total[1])
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[0][at]), pa.array(total[1][at])], ["at", "last", "anywhere"])

    different = answers.select(F.rtrim(F.regexp_replace(text, r"(?U)\s+$", "")).alias("t")).where(F.length("t") > 1).distinct()
    rows = different.mapInArrow(run, "at int, last bigint, anywhere bigint").groupBy("at").agg(F.sum("last").alias("last"), F.sum("anywhere").alias("anywhere")).toPandas()
    out = np.zeros((2, TALLIES), dtype=np.int64)
    out[0, rows["at"]], out[1, rows["at"]] = rows["last"], rows["anywhere"]
    return out


def end_likelihoods(counts: np.ndarray, texts: list[str]) -> np.ndarray:
    """log P(text ends here | its last characters) of each text, that text itself left out: from the kind of the last character to the pair
    of kinds and on to longer n-grams, each shrunk to the one before by pseudo-counts. The least of them counts: where answers break off in
    the same words again and again, the longer n-grams take that for an end, but the kinds of characters do not."""
    if not texts:
        return np.zeros(0)
    codes, classes, ends = _coded([t[-max(NGRAMS) :] for t in texts])
    kind = classes[ends]
    opens = (kind >= 2) & (kind <= 4) | np.array([t[-1:] in _OPENING for t in texts])
    p = np.where(opens, OPEN_PRIOR, CLOSED_PRIOR)
    keys = [classes[ends - 1].astype(np.int64) * WIDTH + kind, *[WIDTH * WIDTH + k * SLOTS + _slots(codes, classes, n)[ends - n + 1] for k, n in enumerate(NGRAMS)]]
    least = np.ones(len(texts))
    for k, key in enumerate(keys):
        last, anywhere = np.maximum(counts[0, key] - 1, 0), np.maximum(counts[1, key] - 1, 0)
        weight = BACKOFF if k else KIND_WEIGHT
        p = (last + weight * p) / (anywhere + weight)
        least = np.minimum(least, p) if k else p
    return np.log(least)


#: A last line that is nothing but the sign of a list: what stands before it decides.
BARE_ITEM = re.compile(r"\n\s*(?:\d{1,3}[.)、]|[-*•])\s*\Z")


def open_structure(text: str) -> bool:
    """A code block that is not closed, or whose brackets are not."""
    parts = text.split("```")
    if len(parts) % 2 == 0:
        return True
    if len(parts) > 2 and not parts[-1].strip():
        code = re.sub(r"\"(?:\\.|[^\"\\\n])*\"|'(?:\\.|[^'\\\n])*'", "", parts[-2])
        return any(code.count(a) > code.count(b) for a, b in ("()", "{}", "[]"))
    return False


def is_refusal(answer: str) -> bool:
    """Every sentence declines or is a courtesy, and one declines in the answerer's own voice; words in quotes are not the answerer's."""
    if "```" in answer:
        return False
    # refusals may name code, so code keeps its place as a word
    text = re.sub(r"`[^`]*`", "X", QUOTED.sub("Q", answer))
    text = re.sub(r"(?<=\w)\.(?=\w)", "_", text)
    said = False
    for m in SENTENCE.finditer(text):
        s = m.group().strip()
        if not re.search(r"\w", s):
            continue
        declines = bool(SPEAKER.search(s)) and bool(DECLINES.search(s))
        said |= declines
        if not declines and not COURTESY.search(s):
            return False
    return said


def is_empty(text: str) -> bool:
    """Blank, or of marks or a placeholder only, however many marks stand around it."""
    first = re.search(r"\w", text)
    if not first:
        return True
    last = re.search(r"\w", text[::-1])
    return bool(PLACEHOLDER.fullmatch(text[first.start() : len(text) - last.start()]))


def prose(text: str) -> str:
    return CODE.sub(" ", FENCE.sub(" ", text))


#: Labelled rows that the language model is fitted on at most, and characters of each.
LABELLED_ROWS, LABELLED_CHARS = 2000, 4000


def language_model(labelled: DataFrame | None) -> LanguageModel:
    """Fitted on a bounded sample of (text, lang); on the seed texts alone where there is none."""
    if labelled is None:
        return fit([])
    keys = [c for c in ("doc_id", "text", "lang") if c in labelled.columns]
    some = bounded_sample(labelled.where("text is not null and lang is not null").select(*keys), LABELLED_ROWS, keys)
    return fit([tuple(r) for r in some.select(F.substring("text", 1, LABELLED_CHARS), "lang").collect()])


def defects(samples: DataFrame, labelled: DataFrame | None = None, margin: float = 4.0, least_letters: int = 8, least_end: float = -4.6, copied: float = 0.85) -> DataFrame:
    """(rec_no, defect): one row for each row of ``samples`` with a defect.

    A null or blank answer, or one of marks, an empty block or a placeholder only, is empty. A null instruction can be neither copied nor
    in another language. labelled: rows (text, lang) to fit the language model on, of which a bounded sample is read. margin: log-odds by which the answer's language must beat the instruction's, least_letters: letters of prose
    below which no language is told, least_end: log-likelihood of a complete end, copied: shares of shingles. Repeated rows are rows.
    """
    counts = samples.sparkSession.sparkContext.broadcast((end_counts(samples), language_model(labelled)))  # both of a fixed size

    def judge(recs, ins, ans):
        found: dict[int, str] = {}
        rest = []
        for i, a in enumerate(ans):
            a = a or ""
            inner = re.sub(r"```\w*\s*```", "", a)
            if is_empty(inner):
                found[i] = "empty"
            elif is_refusal(a):
                found[i] = "refusal"
            else:
                rest.append(i)
        if rest:
            nq, na = Normal([ins[i] for i in rest]), Normal([ans[i] for i in rest])
            (hq, cq), (ha, ca) = nq.shingles(), na.shingles()
            eq, ea = np.cumsum(cq), np.cumsum(ca)
            ends, model = counts.value
            pq, lq = model.log_posteriors([prose(ins[i] or "") for i in rest])
            pa_, la = model.log_posteriors([prose(ans[i]) for i in rest])
            bare = [BARE_ITEM.sub("", ans[i]).rstrip() for i in rest]
            ended = end_likelihoods(ends, bare)
            for k, i in enumerate(rest):
                if cq[k] >= 8 and ca[k] >= 8:
                    q, a = np.unique(hq[eq[k] - cq[k] : eq[k]]), np.unique(ha[ea[k] - ca[k] : ea[k]])
                    both = len(np.intersect1d(q, a, assume_unique=True))
                    if both >= copied * len(a) and both >= 0.5 * len(q):
                        found[i] = "copied"
                        continue
                if lq[k] >= least_letters and la[k] >= least_letters:
                    own, other = int(pq[k].argmax()), int(pa_[k].argmax())
                    if own != other and pa_[k, other] - pa_[k, own] >= margin and pq[k, own] - pq[k, other] >= margin:
                        asked = {lang for pattern, lang in ASKED if pattern.search(ins[i])}
                        if LANGUAGES[other] not in asked and "*" not in asked:
                            found[i] = "other_language"
                            continue
                if open_structure(bare[k]) or ended[k] < least_end:
                    found[i] = "truncated"
        return [(recs[i], d) for i, d in found.items()]

    def run(batches):
        for batch in batches:
            recs, ins, ans = (batch.column(c).to_pylist() for c in range(3))
            for lo, hi in blocks(len(recs), 500):
                rows = judge(recs[lo:hi], ins[lo:hi], ans[lo:hi])
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], ["rec_no", "defect"])

    return samples.select(F.col("rec_no").cast("bigint"), "instruction", "answer").mapInArrow(run, "rec_no bigint, defect string")
