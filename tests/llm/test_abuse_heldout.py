"""Sentences written without a look at the tables: recall and precision of the scores, and what the automaton alone finds."""

from rosta.llm import abuse
from rosta.llm.abuse import LEAST, score

ABUSIVE = """te egy igazi barrom vagy
Remélem elpusztulsz te szánalmas alak
Ki kéne irtani az összes ilyen népséget
Te senkiházi, tűnj a szemem elől
Megöllek, ha még egyszer ide írsz
Olyan ostoba vagy, mint a föld
Agyonverlek, ha meglátlak az utcán
Te hüjle, ehhez nem értesz
Rohadj meg a családoddal együtt, te féreg
Ezek az emberek mind élősködők, gázba velük
Eltöröm a lábadat, ha nem hagyod abba
Te szerencsétlen idióóóta, írni se tudsz
Dögölj meg a kocsiddal együtt
Ezek nem emberek, patkányok, el kell pusztítani őket
Küldj magadról pucér képeket, cserébe fizetek
Te mocskos ribanc, senkinek sem kellesz
Húzz innen a fenébe, te nyomorék
Szétverem a fejed, ha szembe jössz velem
A fajtád csak lopni tud, menjenek haza mind, söpredék
Kinyírlak, te rohadék
Te bunkkó, ne oktass ki
Szopjál le, te kurva
Megfojtalak a két kezemmel
Vetkőzz le a kamera előtt, megmutatom a farkam, nézd a melleidet
Kuss, te degenerált állat
Te k.r.e.t.é.n, menj vissza az óvodába
You are a pathetic idoit
you stupid moron, nobody asked you
I will kill you if you come here again
Those people are vermin and should be exterminated
Shut up you worthless piece of trash
go kill yourself, loser
You're such an asssshole
All of them are animals, gas them, they should be wiped out
I'm going to break your legs, bastard
send me your nudes tonight, horny guy here
hot naked girls want sex tonight
you f u c k e r, get lost
What a brainless idiot you are
They are subhuman parasites, every one of them
Du bist ein Idiott
Halt die Klappe, du Trottel
Ich bring dich um, du Schwein
Verpiss dich, du Arschloch
Dieses Pack sind alle Ungeziefer, man sollte sie ausrotten
Du dumme Schlampe, verreck doch
Zeig mir heute deine Titten, ich bin geil
du hässlicher Wichser
Те просто идеот, ты дурак
Заткнись, тупой урод
Я тебя убью, тварь
Эти люди паразиты, их всех надо уничтожить
Сдохни, мразь
ты жалкое ничтожество, дебил
Пришли голые фото, хочу секс сегодня
Ты кретинн и мудак""".split("\n")  # fmt: skip

CLEAN = """A baromfi ára idén is emelkedett
Az elhullott állatokat el kell szállítani az udvarról
Ki kell irtani a gyomot, mielőtt magot hoz
A csigák ellen a sör is jó, a meztelen csiga szereti
Megölöm magam ezzel a motorral, annyit szereltem, de végre jó
Tegnap elvertem a port a szőnyegből
Hülyebiztos a beállítása, egy gyerek is meg tudja csinálni
Ostoba kérdés lehet, de hogyan kell kicserélni a szűrőt
A marha az istállóban van, az ökör a réten
Nagyon szép a kert, gratulálok neked
Te melyik olajat használod, vagy mindegy
Jobb lenne, ha a vevők előre fizetnének
A szemét elszállítása szerdán van
Beverem a szöget és kész a polc
Kitöröm az ágat, mert elszáradt
Eltört a keze a balesetben, most gipszben van
A kutyák mind egészségesek, oltva vannak
Menjenek vissza a boltba a hibás darabok
Az összes régi alkatrész eladó
A sertéstenyésztők találkozója vasárnap lesz
A szexálás a keltetőben történik
Mi a „kurva” szó eredete a magyar nyelvben
Idézet: „hülye” kifejezés, ezt nem illik leírni, mondta a tanár
Az egerek ellen csapda kell, el kell pusztítani őket
A tetveket permetezéssel pusztítjuk
Szegény kutya megdöglött a télen
A halott ágakat levágom
Az intimmosakodó ára emelkedett
Nézd meg a kezed, nem olajos-e
Fogd be a szálat a tokmányba
Ne haragudj, hogy csak most válaszolok
Kíváncsi vagyok a véleményedre
This tool will kill the weeds in your garden
The dog died last winter, we miss it
Can you help me break the rust on this bolt
You are right, the pump was broken
I hope it works for you
These people were very helpful at the shop
All of the parts should be replaced
The rats in the barn must be exterminated
Burn the old branches in autumn
It was a stupid mistake of mine, sorry
The hot water does not run tonight
Nobody answered my question yet
Der Rasen muss gemäht werden
Das Schwein wiegt hundert Kilo
Die Schnecken fressen alles, man muss sie ausrotten
Ich bringe dir morgen den Schlüssel
Du bist sehr freundlich, danke
Der Motor ist kaputt, was soll ich tun
Die alten Leute im Dorf sind nett
Спасибо, вы мне очень помогли
Как убить сорняки в огороде
Он очень устал сегодня
Мотор сломался, что делать
Эти люди живут в деревне""".split("\n")  # fmt: skip


def figures() -> tuple[float, float]:
    """(recall, precision) on the sentences."""
    found, wrong = (sum(score(t)[0] >= LEAST for t in texts) for texts in (ABUSIVE, CLEAN))
    return found / len(ABUSIVE), found / (found + wrong)


def test_recall_and_precision():
    assert len(ABUSIVE) + len(CLEAN) >= 100
    recall, precision = figures()
    assert recall >= 0.9 and precision >= 0.9


def test_the_automaton_brings_rows(monkeypatch):
    with_it = {t for t in ABUSIVE if score(t)[0] >= LEAST}
    monkeypatch.setattr(abuse, "looked_up", lambda word: None)
    abuse._PLAIN_WORDS.clear()
    abuse.meaning.cache_clear()
    without = {t for t in ABUSIVE if score(t)[0] >= LEAST}
    abuse._PLAIN_WORDS.clear()
    abuse.meaning.cache_clear()
    assert without < with_it and len(with_it - without) >= 3
