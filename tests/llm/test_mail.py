"""Line labels on hand-labelled bodies of every form, and on edge cases."""

from rosta.llm.mail import label_lines, mail_lines, new_text, reduced

# each line begins with its label: n new, x not new
BODIES = """
nSziasztok!
n
nRégebben a sorozat volt a fontos.
n- ezt is
n-> meg ezt
n
x=====
xKis Zsolt
xBodzás Kft.
x06-31/176-2988
x
xDiese Nachricht ist vertraulich. Sollten Sie nicht der Empfänger sein,
xlöschen Sie sie bitte und informieren Sie den Absender.
---
nTisztelt Lista!
x
xOn Tue, Jan 25, 2022 at 02:15, Kis Piroska wrote:
x> Kértem rá ajánlatot, de még
x> alkudozunk.
n
nNem vagyok szakember, de jó.
x
x| Nekem nem működik.
n
nAzt írta, hogy a feladó: ismeretlen, a tárgy pedig üres volt.
x
xÜdvözlettel,
xKis Márton
---
nKöszönöm a tanácsot, holnap megpróbálom.
x
xBest regards,
xNagy Orsolya
xMobil: 06-30/182-1855
x
x-------- Original Message --------
xSubject: macska
xDate: 26.07.2024 13:31
xFrom: Kis Béla <kis27@posta.example>
x
xMielőtt bármit szétszednél, nézd meg.
x
xKösz,
xBéla
---
xKis Orsolya <kis@posta.example> ezt írta (időpont: 2022. febr. 10.,
xcsütörtök, 18:36):
x> A kép jó.
x>
x> Kösz,
x> Réka
n
nEzt a részt nem értem.
x
xKüldve a telefonomról
x
x_______________________________________________
xMűhely levelezőlista
xhttps://lista.muhely.example/info
"""


def bodies():
    for block in BODIES.strip("\n").split("\n---\n"):
        lines = block.split("\n")
        text = "\n".join(line[1:] for line in lines)
        yield text, {i for i, line in enumerate(lines, 1) if line[0] == "x" and line[1:].strip()}


def test_labelled_bodies():
    for text, want in bodies():
        for body in (text, text.replace("\n", "\r\n")):
            assert {i for i, label in label_lines(body) if label} == want


def test_new_text_keeps_what_is_new():
    text, _ = next(bodies())
    assert new_text(text) == "Sziasztok!\n\nRégebben a sorozat volt a fontos.\n- ezt is\n-> meg ezt"
    assert new_text(None) is None and new_text("") == ""


def test_edges(spark):
    cases = [(1, None), (2, ""), (3, " \n\r\n"), (4, "Szia!"), (4, "Szia!"), (None, "> a\nb"), (6, "szó " * 100_000), (7, "> x\n" * 5000)]
    df = spark.createDataFrame([(k, t, "clash") for k, t in cases], "k int, t string, label string")
    rows = mail_lines(df, "k", "t").collect()
    assert sum(r.k == 4 for r in rows) == 2 and sum(r.k == 7 for r in rows) == 5000
    assert [r.label for r in rows if r.k is None] == ["quoted", "new"]
    assert not {1, 2, 3} & {r.k for r in rows}
    assert mail_lines(df.limit(0), "k", "t").count() == 0
    assert reduced(df, "k", "t").count() == len(cases)


def test_a_forwarded_message_begins_at_its_mark():
    own = [f"Ez a {i}. sor, ezt én írtam most." for i in range(3)]
    far = [f"Ez a {i}. sora annak, amit régen írtak." for i in range(2000)]
    text = "\n".join(["Hello,", "", *own, "", "---------- Továbbított üzenet ----------", "Feladó: Kis Réka <kis@posta.test>", "Dátum: 2024. 10. 16. 15:20", "Tárgy: eke", "", *far])
    labels = dict(label_lines(text))
    assert [n for n, label in labels.items() if label == 0] == [1, 3, 4, 5]
