"""Which language a text is in: naive Bayes over character trigrams, trained here.

Two streams of trigrams are counted: of the letters themselves, which tells languages of one script apart, and of their scripts, which tells
the rest whatever the words are. The model is fitted on a text of each language written for this purpose and, where there are any, on a
bounded sample of labelled rows; every language has the same total weight, however much of it was seen.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Sequence
from functools import cache

import numpy as np

#: Training text of each language: plain prose about software, written for this purpose.
SEEDS = {
    "en": """The method returns early if nothing has changed since the last run. When the queue is empty, the worker waits for a signal and then
tries again. Callers should not modify the returned list, because it is shared with other threads. If the value is missing, an exception is
thrown and the transaction is rolled back. This is why we check the argument before the lookup. Yes, it does; see the other class for details.
No, the default is used instead. There are three ways in which this could fail, and each of them has been seen in practice. First, the lock
may be held by another process. Second, the record could have been written twice. What happens to the rows which were already sent? They stay
as they are until the next run. How would you design a test for that? Please explain where the check should be placed and which of the two
shards wins. I think that we might want to keep a copy of the old state, so that an operator can restore it without much work. It was added
after the outage, and nobody has touched it since then. Does raising the limit help? Only when the network is the bottleneck.""",
    "de": """Die Methode kehrt sofort zurück, wenn sich seit dem letzten Lauf nichts geändert hat. Ist die Warteschlange leer, so wartet der Prozess auf
ein Signal und versucht es dann noch einmal. Aufrufer dürfen die gelieferte Liste nicht verändern, weil sie mit anderen Threads geteilt wird.
Fehlt der Wert, so wird eine Ausnahme geworfen und die Transaktion zurückgerollt. Deshalb prüfen wir das Argument vor der Suche. Ja, das ist
richtig; Einzelheiten stehen in der anderen Klasse. Nein, stattdessen wird der Vorgabewert benutzt. Es gibt drei Möglichkeiten, wie das
scheitern könnte, und jede davon ist schon vorgekommen. Erstens könnte die Sperre von einem anderen Vorgang gehalten werden. Was geschieht mit
den Zeilen, die bereits verschickt wurden? Sie bleiben, wie sie sind, bis zum nächsten Lauf. Wie würden Sie dafür einen Test entwerfen? Bitte
erklären Sie, wo die Prüfung stehen soll und welcher der beiden Teile gewinnt. Ich kann diese Frage leider nicht beantworten. Wir sollten eine
Kopie des alten Zustands aufbewahren, damit man ihn ohne große Mühe wiederherstellen kann. Hilft es, die Grenze zu erhöhen? Nur unter Last.""",
    "fr": """La méthode revient tout de suite si rien n'a changé depuis la dernière exécution. Quand la file est vide, le processus attend un signal puis
essaie de nouveau. Les appelants ne doivent pas modifier la liste renvoyée, car elle est partagée avec d'autres fils. Si la valeur manque, une
exception est levée et la transaction est annulée. C'est pourquoi nous vérifions l'argument avant la recherche. Oui, c'est exact ; voir l'autre
classe pour les détails. Non, la valeur par défaut est utilisée à la place. Il y a trois façons dont cela peut échouer, et chacune a été vue en
pratique. D'abord, le verrou peut être tenu par un autre processus. Qu'arrive-t-il aux lignes déjà envoyées ? Elles restent telles quelles
jusqu'au prochain passage. Comment écririez-vous un test pour cela ? Veuillez expliquer où placer le contrôle et laquelle des deux parties
l'emporte. Je ne peux malheureusement pas répondre à cette question. Nous devrions garder une copie de l'ancien état, afin qu'on puisse le
rétablir sans trop de peine. Une telle entrée signifie que le compteur dépasse la limite. Seule cette branche interroge la base.""",
    "es": """El método vuelve enseguida si nada ha cambiado desde la última ejecución. Cuando la cola está vacía, el proceso espera una señal y luego lo
intenta otra vez. Quienes llaman no deben modificar la lista devuelta, porque se comparte con otros hilos. Si falta el valor, se lanza una
excepción y se deshace la transacción. Por eso comprobamos el argumento antes de la búsqueda. Sí, es correcto; véase la otra clase para más
detalles. No, en su lugar se usa el valor por defecto. Hay tres maneras en que esto podría fallar, y cada una se ha visto en la práctica. ¿Qué
ocurre con las filas que ya se enviaron? Se quedan como están hasta la próxima ejecución. ¿Cómo diseñaría usted una prueba para eso? Explique
dónde debe estar la comprobación y cuál de las dos partes gana. Lo siento, no puedo responder a esta pregunta. Deberíamos guardar una copia.""",
    "it": """Il metodo ritorna subito se nulla è cambiato dall'ultima esecuzione. Quando la coda è vuota, il processo aspetta un segnale e poi riprova.
Chi chiama non deve modificare la lista restituita, perché è condivisa con altri thread. Se il valore manca, viene sollevata un'eccezione e la
transazione viene annullata. Per questo controlliamo l'argomento prima della ricerca. Sì, è giusto; si veda l'altra classe per i dettagli. No,
al suo posto si usa il valore predefinito. Ci sono tre modi in cui questo potrebbe fallire. Che cosa succede alle righe già inviate? Restano
come sono fino alla prossima esecuzione. Spiegare dove deve stare il controllo e quale delle due parti vince. Non posso rispondere.""",
    "nl": """De methode keert meteen terug als er sinds de laatste keer niets is veranderd. Als de wachtrij leeg is, wacht het proces op een signaal en
probeert het daarna opnieuw. Aanroepers mogen de teruggegeven lijst niet wijzigen, omdat die met andere draden wordt gedeeld. Ontbreekt de
waarde, dan wordt een uitzondering gegooid en de transactie teruggedraaid. Daarom controleren we het argument voor het zoeken. Ja, dat klopt;
zie de andere klasse. Nee, in plaats daarvan wordt de standaardwaarde gebruikt. Wat gebeurt er met de regels die al zijn verstuurd?""",
    "pt": """O método retorna logo se nada mudou desde a última execução. Quando a fila está vazia, o processo espera um sinal e depois tenta de novo.
Quem chama não deve modificar a lista devolvida, porque ela é compartilhada com outras threads. Se o valor falta, uma exceção é lançada e a
transação é desfeita. Por isso verificamos o argumento antes da busca. Sim, está certo; veja a outra classe. Não, em vez disso usa-se o valor
padrão. O que acontece com as linhas que já foram enviadas? Elas ficam como estão até a próxima execução. Não posso responder.""",
    "pl": """Metoda kończy się od razu, jeśli od ostatniego uruchomienia nic się nie zmieniło. Gdy kolejka jest pusta, proces czeka na sygnał, a potem próbuje
ponownie. Wywołujący nie powinni zmieniać zwróconej listy, ponieważ jest ona współdzielona z innymi wątkami. Jeżeli brakuje wartości, zgłaszany jest
wyjątek i transakcja zostaje wycofana. Dlatego sprawdzamy argument przed wyszukiwaniem. Tak, to prawda; szczegóły są w drugiej klasie. Co się dzieje z
wierszami, które już wysłano? Pozostają bez zmian do następnego przebiegu. Niestety nie mogę odpowiedzieć na to pytanie.""",
    "sv": """Metoden återvänder genast om ingenting har ändrats sedan förra körningen. När kön är tom väntar processen på en signal och försöker sedan igen.
Den som anropar får inte ändra listan som returneras, eftersom den delas med andra trådar. Om värdet saknas kastas ett undantag och transaktionen rullas
tillbaka. Därför kontrollerar vi argumentet före sökningen. Ja, det stämmer; se den andra klassen för detaljer. Vad händer med raderna som redan har
skickats? De förblir som de är till nästa körning. Tyvärr kan jag inte svara på den här frågan.""",
    "da": """Metoden vender straks tilbage, hvis intet er ændret siden den sidste kørsel. Når køen er tom, venter processen på et signal og prøver så igen. Den,
der kalder, må ikke ændre den liste, som returneres, fordi den deles med andre tråde. Hvis værdien mangler, kastes en undtagelse, og transaktionen rulles
tilbage. Derfor kontrollerer vi argumentet før opslaget. Ja, det er rigtigt; se den anden klasse. Hvad sker der med rækkerne, som allerede er sendt? De
bliver, som de er, til næste gang. Jeg kan desværre ikke svare på dette spørgsmål.""",
    "tr": """Son çalışmadan bu yana hiçbir şey değişmediyse yöntem hemen geri döner. Kuyruk boşsa süreç bir sinyal bekler ve sonra yeniden dener. Çağıranlar dönen
listeyi değiştirmemelidir, çünkü liste diğer iş parçacıklarıyla paylaşılır. Değer eksikse bir istisna fırlatılır ve işlem geri alınır. Bu yüzden aramadan
önce parametreyi denetliyoruz. Evet, doğru; ayrıntılar için öbür sınıfa bakın. Gönderilmiş olan satırlara ne olur? Bir sonraki çalışmaya kadar olduğu gibi
kalırlar. Ne yazık ki bu soruya cevap veremiyorum.""",
    "cs": """Metoda se vrátí hned, pokud se od posledního běhu nic nezměnilo. Když je fronta prázdná, proces čeká na signál a potom to zkusí znovu. Volající nesmí
měnit vrácený seznam, protože je sdílen s jinými vlákny. Chybí-li hodnota, vyvolá se výjimka a transakce se vrátí zpět. Proto kontrolujeme argument před
hledáním. Ano, je to tak; podrobnosti najdete v druhé třídě. Co se stane s řádky, které už byly odeslány? Zůstanou beze změny do příštího běhu. Na tuto
otázku bohužel nemohu odpovědět.""",
    "ro": """Metoda revine imediat dacă nimic nu s-a schimbat de la ultima rulare. Când coada este goală, procesul așteaptă un semnal și apoi încearcă din nou. Cei
care apelează nu trebuie să modifice lista returnată, fiindcă este împărțită cu alte fire. Dacă valoarea lipsește, se aruncă o excepție și tranzacția este
anulată. De aceea verificăm argumentul înainte de căutare. Da, așa este; vezi cealaltă clasă pentru detalii. Din păcate nu pot răspunde la această
întrebare.""",
    "hu": """A metódus azonnal visszatér, ha az utolsó futás óta semmi sem változott. Ha a sor üres, a folyamat jelre vár, majd újra próbálkozik. A hívók nem
módosíthatják a visszaadott listát, mert más szálakkal közösen használják. Ha az érték hiányzik, kivétel keletkezik, és a tranzakció visszagördül. Ezért
ellenőrizzük az argumentumot a keresés előtt. Igen, ez így van; a részletek a másik osztályban találhatók. Sajnos erre a kérdésre nem tudok válaszolni.""",
    "fi": """Metodi palaa heti, jos mikään ei ole muuttunut edellisen ajon jälkeen. Kun jono on tyhjä, prosessi odottaa merkkiä ja yrittää sitten uudelleen.
Kutsujat eivät saa muuttaa palautettua listaa, koska se jaetaan muiden säikeiden kanssa. Jos arvo puuttuu, heitetään poikkeus ja tapahtuma perutaan. Siksi
tarkistamme parametrin ennen hakua. Kyllä, näin on; katso toista luokkaa. Valitettavasti en voi vastata tähän kysymykseen.""",
    "vi": """Phương thức trả về ngay nếu không có gì thay đổi kể từ lần chạy trước. Khi hàng đợi trống, tiến trình chờ tín hiệu rồi thử lại. Người gọi không được sửa
danh sách trả về, vì nó được dùng chung với các luồng khác. Nếu thiếu giá trị, một ngoại lệ được ném ra và giao dịch bị hủy. Vì vậy chúng tôi kiểm tra
tham số trước khi tìm kiếm. Rất tiếc, tôi không thể trả lời câu hỏi này.""",
    "id": """Metode ini langsung kembali jika tidak ada yang berubah sejak terakhir kali dijalankan. Ketika antrean kosong, proses menunggu sinyal lalu mencoba lagi.
Pemanggil tidak boleh mengubah daftar yang dikembalikan karena daftar itu dipakai bersama oleh utas lain. Jika nilainya tidak ada, sebuah pengecualian
dilemparkan dan transaksi dibatalkan. Karena itu kami memeriksa argumen sebelum pencarian. Maaf, saya tidak dapat menjawab pertanyaan ini.""",
    "zh": """如果自上次运行以来没有任何变化，该方法会立即返回。队列为空时，进程等待信号然后重试。调用方不应修改返回的列表，因为它与其他线程共享。如果缺少该值，就会抛出异常并回滚事务。
因此我们在查找之前检查参数。是的，确实如此，详情见另一个类。已经发送的行会怎样？它们保持原样，直到下一次运行。请说明检查应该放在哪里。很抱歉，我无法回答这个问题。""",
    "ja": """前回の実行から何も変わっていなければ、このメソッドはすぐに戻ります。キューが空のとき、プロセスは信号を待ってからもう一度試します。返されたリストは他のスレッドと共有されているので、
呼び出し側は変更してはいけません。値がない場合は例外が投げられ、トランザクションは取り消されます。そのため、検索の前に引数を確認します。はい、その通りです。申し訳ありませんが、この質問にはお答えできません。""",
    "ko": """지난 실행 이후 변경된 것이 없으면 이 메서드는 바로 돌아옵니다. 큐가 비어 있으면 프로세스는 신호를 기다렸다가 다시 시도합니다. 반환된 목록은 다른 스레드와 공유되므로 호출자가 수정하면 안
됩니다. 값이 없으면 예외가 발생하고 트랜잭션이 되돌려집니다. 그래서 검색하기 전에 인수를 확인합니다. 죄송하지만 이 질문에는 답변할 수 없습니다.""",
    "ru": """Метод сразу возвращается, если с последнего запуска ничего не изменилось. Когда очередь пуста, процесс ждёт сигнала и затем пробует снова. Вызывающий код
не должен менять возвращённый список, потому что он используется и другими потоками. Если значения нет, выбрасывается исключение, и транзакция
откатывается. Поэтому мы проверяем аргумент до поиска. Да, это так; подробности в другом классе. К сожалению, я не могу ответить на этот вопрос.""",
    "uk": """Метод одразу повертається, якщо з останнього запуску нічого не змінилося. Коли черга порожня, процес чекає на сигнал і потім пробує знову. Той, хто
викликає, не повинен змінювати повернутий список, бо його використовують й інші потоки. Якщо значення немає, виникає виняток, і транзакція скасовується.
Тому ми перевіряємо аргумент перед пошуком. Так, це правда; подробиці в іншому класі. На жаль, я не можу відповісти на це питання.""",
    "el": """Η μέθοδος επιστρέφει αμέσως αν τίποτα δεν έχει αλλάξει από την τελευταία εκτέλεση. Όταν η ουρά είναι άδεια, η διεργασία περιμένει ένα σήμα και μετά
προσπαθεί ξανά. Αν λείπει η τιμή, προκαλείται εξαίρεση και η συναλλαγή ακυρώνεται. Δυστυχώς δεν μπορώ να απαντήσω σε αυτή την ερώτηση.""",
    "ar": """تعود الدالة فورًا إذا لم يتغير شيء منذ آخر تشغيل. عندما يكون الطابور فارغًا تنتظر العملية إشارة ثم تحاول مرة أخرى. لا يجوز للمستدعي تعديل القائمة
المعادة لأنها مشتركة مع خيوط أخرى. إذا كانت القيمة مفقودة يُرمى استثناء وتُلغى المعاملة. عذرًا، لا أستطيع الإجابة عن هذا السؤال.""",
    "fa": """اگر از آخرین اجرا چیزی تغییر نکرده باشد، این متد فوراً برمی‌گردد. وقتی صف خالی است، فرایند منتظر یک پیام می‌ماند و سپس دوباره تلاش می‌کند. اگر مقدار
وجود نداشته باشد، خطایی پرتاب می‌شود و تراکنش لغو می‌گردد. متأسفم، نمی‌توانم به این پرسش پاسخ بدهم.""",
    "he": """המתודה חוזרת מיד אם דבר לא השתנה מאז ההרצה האחרונה. כאשר התור ריק, התהליך ממתין לאות ואז מנסה שוב. אם הערך חסר, נזרקת חריגה והעסקה מתבטלת. מצטער, איני
יכול לענות על השאלה הזאת.""",
    "hi": """यदि पिछली बार से कुछ नहीं बदला है तो यह विधि तुरंत लौट आती है। जब कतार खाली होती है तो प्रक्रिया संकेत की प्रतीक्षा करती है और फिर दोबारा प्रयास करती है। यदि मान नहीं है तो
त्रुटि होती है और लेनदेन वापस हो जाता है। क्षमा करें, मैं इस प्रश्न का उत्तर नहीं दे सकता।""",
    "th": """เมธอดจะกลับทันทีหากไม่มีอะไรเปลี่ยนแปลงตั้งแต่การทำงานครั้งก่อน เมื่อคิวว่าง กระบวนการจะรอสัญญาณแล้วลองใหม่อีกครั้ง หากไม่มีค่าจะเกิดข้อผิดพลาดและธุรกรรมจะถูกยกเลิก ขออภัย ฉันไม่สามารถตอบคำถามนี้ได้""",
}
LANGUAGES = tuple(SEEDS)
BUCKETS = 1 << 16
#: Pseudo-count of a trigram, and the total weight of the trigrams of each language.
ALPHA, WEIGHT = 0.1, 1500.0
#: Of what the labelled rows say, the part that counts against the seed text.
LABELLED = 0.7
#: Labels as they are written, by the language they name; what follows a hyphen or underscore does not matter.
LABELS = {"english": "en", "eng": "en", "chinese": "zh", "zho": "zh", "german": "de", "deutsch": "de", "ger": "de", "french": "fr", "spanish": "es", "italian": "it", "japanese": "ja", "korean": "ko", "russian": "ru", "dutch": "nl", "portuguese": "pt"}


def label_of(label: str | None) -> str | None:
    """The language that a label names, none for missing, mixed and unknown ones."""
    word = re.split(r"[-_]", (label or "").strip().lower())[0]
    found = LABELS.get(word, word)
    return found if found in LANGUAGES else None


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For every code point the letter in lower case, and the number of its script; a blank and 0 for all that is no letter or mark on one."""
    letter, script = np.full(0x110000, 32, dtype=np.uint32), np.zeros(0x110000, dtype=np.uint8)
    numbers: dict[str, int] = {}
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha() or 0x300 <= i < 0x20000 and unicodedata.category(c) in ("Mn", "Mc"):
            low = c.lower()
            letter[i] = ord(low) if len(low) == 1 else i
            name = unicodedata.name(c, "OTHER").split()[0].split("-")[0]
            script[i] = 0 if name == "COMBINING" else numbers.setdefault(name, min(len(numbers) + 1, 255))
    return letter, script


def _hashed(codes: np.ndarray) -> np.ndarray:
    c = codes.astype(np.uint64)
    h = (c[:-2] * np.uint64(0x9E3779B1) + c[1:-1]) * np.uint64(0x85EBCA77) + c[2:]
    return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64)


def _grams(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Trigrams of letters and of scripts at every place, the starts of the texts, and the number of letters of each."""
    padded = [f"  {t}  " for t in texts]
    at = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter, script = (t[at] for t in _tables())
    starts = np.cumsum([0, *map(len, padded[:-1])])
    return _hashed(letter), _hashed(script), starts, np.add.reduceat((letter != 32).astype(np.int64), starts)


_BLANK = tuple(int(_hashed(np.full(3, c, dtype=np.uint32))[0]) for c in (32, 0))


def gram_counts(texts: Sequence[str]) -> np.ndarray:
    """2 x BUCKETS: how often each trigram of letters and of scripts is in the texts; those of blanks only do not count."""
    out = np.zeros((2, BUCKETS))
    if texts:
        for k, g in enumerate(_grams(texts)[:2]):
            out[k] = np.bincount(g, minlength=BUCKETS)
            out[k, _BLANK[k]] = 0
    return out


class LanguageModel:
    """Log-likelihoods of trigrams, streams x buckets x languages."""

    def __init__(self, more: dict[str, np.ndarray] | None = None):
        self.table = np.zeros((2, BUCKETS, len(LANGUAGES)), dtype=np.float32)
        for k, (lang, text) in enumerate(SEEDS.items()):
            share = lambda n: n / np.maximum(n.sum(axis=1, keepdims=True), 1)
            p = share(gram_counts([text]))
            if more and lang in more and more[lang].sum() > WEIGHT:
                p = (1 - LABELLED) * p + LABELLED * share(more[lang])
            n = p * WEIGHT + ALPHA
            self.table[:, :, k] = np.log(n / n.sum(axis=1, keepdims=True))
        for k, blank in enumerate(_BLANK):
            self.table[k, blank] = 0

    def log_posteriors(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(texts x languages, letters): log-posteriors under equal priors, and the number of letters of each text."""
        if not len(texts):
            return np.zeros((0, len(LANGUAGES))), np.zeros(0, dtype=np.int64)
        letters, scripts, starts, n = _grams(texts)
        # there are few different trigrams of scripts, so they are counted first
        few = np.flatnonzero(np.bincount(scripts, minlength=BUCKETS))
        place = np.zeros(BUCKETS, dtype=np.int64)
        place[few] = np.arange(len(few))
        owner = np.repeat(np.arange(len(texts)), np.diff([*starts, len(scripts)]))
        counts = np.bincount(owner * len(few) + place[scripts], minlength=len(texts) * len(few)).reshape(len(texts), len(few))
        scores = np.add.reduceat(self.table[0][letters], starts, axis=0) + counts @ self.table[1][few]
        return scores - np.logaddexp.reduce(scores, axis=1, keepdims=True), n


@cache
def seed_model() -> LanguageModel:
    return LanguageModel()


def fit(rows: Iterable[tuple[str | None, str | None]]) -> LanguageModel:
    """The model fitted on (text, label) as well; a row whose text the seed texts tell to be in another language has a wrong label and is
    left out, and so are rows without a label of a known language."""
    known = [(t, lang) for t, label in rows if t and (lang := label_of(label))]
    more: dict[str, np.ndarray] = {}
    if known:
        best = seed_model().log_posteriors([t for t, _ in known])[0].argmax(axis=1)
        for lang in {lang for _, lang in known}:
            right = [t for (t, x), b in zip(known, best) if x == lang and LANGUAGES[b] == lang]
            more[lang] = gram_counts(right)
    return LanguageModel(more)


def log_posteriors(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    return seed_model().log_posteriors(texts)
