"""Residue against hand-labelled texts, and edge cases."""

from pyspark.sql import functions as F

from rosta.llm.residue import coverage, fold, residue

YES = [
    "404 - Page not found", "Hiba 500 - Access denied", "Bad Gateway (502)", "undefined", "null - null", "[object Object]", "Kedves {{ nev }}!", "#[cim] új hozzászólás érkezett",
    "Köszönjük, hogy regisztrált itt: [felhasznalo]. Üdvözlettel: @@SITE@@ csapata", "Tisztelt {{ nev }}! {{ cim }} hirdetése lejár.", "KEDVES <%= NEV %>!", "Lorem ipsum dolor sit amet consectetur", "Cím helye...", "Teszt teszt 123 teszt", "Minta szöveg minta szöveg.",
    "A tartalom megjelenitesehez engedelyezze a JavaScriptet a bongeszojeben.", "Please enable JavaScript to view this page.", "Please&nbsp;enable\u00a0JavaScript  to view this page.", 'Traceback (most recent call last):\n  File "app.py", line 9, in render\nKeyError: \'body\'', "${datum} - {{cim}}",
]
NO = [
    "404-es hiba a Gonkel oldalán?", "Miért kell JavaScript a Durmont honlaphoz?", "Lorem ipsum: mire jó a fólia leírásában?", "A nyomdász lorem ipsum szöveget tett a plakátra, azon nevettünk.", "Köszi!", "off", "???", " ", "",
    "Melyik sablonmotorban jó a {{ nev }} jelölés, és mit ír ki üres érték esetén?", "[ELADÓ] fék", "A szerver 51 percig 503-at adott, aztán magától helyrejött.", "Up", "Darabja 400 Ft, 500 db van.", "Null pont, 3. rész", "Elkelt.",
]


def test_labelled_texts():
    for text in YES:
        inside, total = coverage(fold(text))
        assert inside >= 0.6 * total > 0, text
    for text in NO:
        inside, total = coverage(fold(text))
        assert inside < 0.6 * total or not inside, text


def frame(spark, texts):
    return spark.createDataFrame([(i, "h", t, "clash") for i, t in enumerate(texts)], "id int, host string, t string, _line string")


def test_operator_and_edges(spark):
    df = frame(spark, [*YES, *NO, None, "x " * 200_000])
    assert sorted(r.id for r in residue(df, ["id"], "host", "t").collect()) == [*range(len(YES))]
    assert residue(df.limit(0), ["id"], "host", "t").count() == 0
    hostless = df.withColumn("host", F.lit(None).cast("string"))
    assert residue(hostless.union(hostless), ["id"], "host", "t").count() == len(YES)


def test_recurrent_lines_are_subtracted(spark):
    posts = [f"Fórum » Kezdőlap » Lista és egyéb hosszú fejléc\nÉrtem, hogy a {i} jó." for i in range(40)]
    df = frame(spark, [*posts, "Fórum » Kezdőlap » Lista és egyéb hosszú fejléc\nBad Gateway"])
    assert [r.id for r in residue(df, ["id"], "host", "t").collect()] == [40]
    assert residue(df, ["id"], "host", "t", often=1000).count() == 0
    # of another host, until the line stands in enough records of all
    other = df.withColumn("host", F.when(F.col("id") == 40, "other").otherwise(F.concat(F.lit("h"), F.col("id"))))
    assert residue(other, ["id"], "host", "t", often=14).count() == 0 and residue(other, ["id"], "host", "t", often=13).count() == 1


def test_templates_recur_with_other_placeholders(spark):
    notices = [f"Tisztelt {{{{{n}}}}}! Hirdetése {i} nap múlva véglegesen törlődik a rendszerünkből, ha meg nem hosszabbítja." for i, n in enumerate(["nev", "cim", "datum", "user.name", "ar", "site"])]
    df = frame(spark, [*notices, "Tisztelt {{nev}}! Egyszer írtam egy hosszú levelet a hirdetésről, és más senki sem válaszolt rá az egész hónapban."])
    assert sorted(r.id for r in residue(df, ["id"], "host", "t").collect()) == [*range(6)]
    assert residue(df, ["id"], "host", "t", often=7).count() == 0


def test_no_size_decides():
    for words in (10, 100, 1000):
        for length in (150, 199, 200, 201, 250):
            line = ("szép " * words)[:length].strip()
            assert coverage(line) == (0, sum(map(len, line.split())))


def test_subtraction_brings_rows(spark):
    """On the tables themselves: rows that only the counted lines tell."""
    folder = "/root/testdata/sf0.1"
    posts = spark.read.parquet(f"{folder}/comments.parquet").select("row_id", "origin", F.col("data").alias("t"))
    with_it, without = ({r.row_id for r in residue(posts, ["row_id"], "origin", "t", often=n).collect()} for n in (5, 10**9))
    assert without < with_it and len(with_it - without) >= 30


# Written without a look at the tables.
RESIDUE = """404 Not Found
500 Internal Server Error
503 Service Temporarily Unavailable
Error 403: access to this resource is denied.
The page you requested could not be found: error 404
This page does not exist.
Your session has expired.
The requested file was not found on the server.
Connection to the database failed.
Request timed out
Access denied
You need to enable JavaScript to run this app.
JavaScript is required to use this website.
Please turn on cookies in your browser to continue.
This website requires cookies.
Your browser does not support JavaScript.
Please allow scripts on this page.
Lorem ipsum dolor sit amet, consectetur adipiscing elit.
Sed do eiusmod tempor incididunt ut labore
Enter your text here
Type the title here
Your content goes here.
Sample text
Placeholder
Click to edit title
Tap here to add description
Hello {{first_name}}!
Dear {customer_name}, welcome to %site_name%
${message}
<%= post.title %>
[[TITLE]]
{% block content %}
[object Object]
undefined undefined
NaN
null
Uncaught TypeError: x is not a function
NullPointerException: at line 12
Warning: Undefined index: name in /var/www/index.php on line 12
Traceback (most recent call last):
SQLSTATE[42S02]: Base table not found
asdf asdf
test test test
xxxxxx
TODO: text
A lap nem található.
Hiba: az oldal nem létezik
A szolgáltatás átmenetileg nem elérhető
A munkamenete lejárt
A hozzáférés megtagadva
Kérjük, engedélyezze a sütiket a böngészőben!
A weboldal működéséhez JavaScript szükséges.
A JavaScript le van tiltva, kapcsolja be!
Ide írja a szöveget
Ide jön a leírás
A kép helye
Kattintson ide a szöveg módosításához
Szerver hiba
Tisztelt {nev}!
Seite nicht gefunden
Fehler 500: Der Server ist nicht erreichbar
Zugriff verweigert
Ihre Sitzung ist abgelaufen
Bitte aktivieren Sie JavaScript
Für diese Seite ist JavaScript erforderlich.
Hier Text eingeben
Beispieltext
Страница не найдена
Ошибка сервера
Доступ запрещён
Включите JavaScript в браузере
Введите текст здесь""".split("\n")  # fmt: skip
CONTENT = """I got a 404 when I opened the link, any idea?
Why does my browser say access denied?
How do I enable JavaScript in Firefox?
The server in our office was down for two hours yesterday.
What does lorem ipsum mean?
My session was great, thanks for the lesson.
The gate is open and the dog ran away.
This page is really helpful.
I need a script for the school play.
She baked cookies for the children.
Please enter through the back door.
The title of the book is unknown to me.
We tested the engine twice.
Null problem, it works fine now.
The error was mine, sorry.
The file needs sharpening.
Click noise from the left speaker
Type 2 connector for sale
Nice picture, where was it taken?
Can I write here in English?
Miért ír ki hibát az oldal, ha belépek?
Nálam is lejárt a garancia.
A szerverünk tegnap egész nap állt.
Valaki tudja, hogyan kell bekapcsolni a sütiket?
Süti receptet keresek.
Szép oldal, gratulálok.
A hiba oka a kopott csapágy volt.
Az oldal tetején van a cím.
Ide jöttünk lakni húsz éve.
A kép szerintem gyönyörű.
Kértem tőle szöveget is a képhez.
Hozzáférhető áron eladó
Tesztelem a motort holnap.
Teszt: Bosch fúrógép
Elfogyott az üzemanyag
A {kapcsos} zárójel mire jó?
[OFF] Jó reggelt!
[eladó] Simson motor
Köszi!
ok
Warum kommt bei mir ein Fehler?
Wie aktiviere ich Cookies?
Der Fehler lag am Kabel.
Die Seite gefällt mir.
Hier regnet es seit Tagen.
Ich habe den Text gelesen.
Почему у меня ошибка?
Я нашёл ошибку в книге.
Здесь очень красиво.
Мой сервер работает.""".split("\n")  # fmt: skip


def test_held_out_recall_and_precision():
    judged = lambda t: (c := coverage(fold(t)))[0] > 0 and c[0] >= 0.6 * c[1]
    assert len(RESIDUE) + len(CONTENT) >= 100
    found, wrong = ([t for t in texts if judged(t)] for texts in (RESIDUE, CONTENT))
    assert len(found) >= 0.9 * len(RESIDUE), [t for t in RESIDUE if t not in found]
    assert len(found) >= 0.9 * (len(found) + len(wrong)), wrong


def test_repeated_test_words_are_tried():
    from rosta.llm.residue import coverage, fold

    for text in ("Teszt, teszt", "teszt 1 teszt 2", "teszt.teszt", "Test, test, test", "test 1 test 2 test 3"):
        inside, total = coverage(fold(text))
        assert inside >= 0.6 * total > 0, text
