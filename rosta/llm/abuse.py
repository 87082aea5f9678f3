"""Abusive, hateful and sexually explicit language: a score for every text, and rates by source.

Terms of a lexicon are found in any spelling: without accents, in capitals, stretched, spaced out, masked with stars, with
digits for letters, and misspelled: a Levenshtein automaton for every word that is no known one is run over the trie of the
lexicon. Known words are the lexicon's, a fixed list of ordinary ones, and those the texts use too often for a misspelling. What surrounds a term decides what it counts: words of address raise it, quotation and
mention lower it. Sentences that threaten, wish death, degrade a group or are explicit are told by the classes of their words
within a window: a verb of harm and what is yours, a wish and a death, a plural of people and what is to be done with them.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Insulting terms, folded, with what each counts without context.
INSULTS = {
    "idiota": 0.7, "hulye": 0.6, "rohadek": 0.8, "szarhazi": 0.9, "barom": 0.6, "kreten": 0.7, "bunko": 0.6, "kurva": 0.7, "degeneralt": 0.7, "tetves": 0.6, "szemetlada": 0.8, "seggfej": 0.9, "geci": 0.9, "faszfej": 1.0, "faszkalap": 0.9,
    "kocsog": 0.9, "buzi": 0.8, "ribanc": 0.9, "csoves": 0.5, "fasz": 0.8, "picsa": 0.7, "imbecilis": 0.7, "debil": 0.7, "marha": 0.4, "okor": 0.4, "tahó": 0.6, "paraszt": 0.4, "nyomorek": 0.7, "szutyok": 0.4, "mocsok": 0.6, "cigany": 0.2, "fattyu": 0.7, "cafka": 0.8, "lotyo": 0.7, "szajha": 0.8,
    "moron": 0.8, "idiot": 0.7, "stupid": 0.5, "bastard": 0.9, "bitch": 0.9, "asshole": 1.0, "fuck": 0.9, "fucker": 1.0, "retard": 0.9, "scum": 0.8, "whore": 0.9, "slut": 0.9, "dumbass": 1.0, "cunt": 1.0, "worthless": 0.6, "trash": 0.4, "loser": 0.5,
    "arschloch": 1.0, "dummkopf": 0.8, "schlampe": 0.9, "hure": 0.9, "wichser": 1.0, "missgeburt": 1.0, "dummer": 0.5, "depp": 0.7, "trottel": 0.7, "schwein": 0.4, "hurensohn": 1.0, "blodmann": 0.8,
    "дурак": 0.7, "идиот": 0.7, "тварь": 0.8, "сука": 0.9, "мразь": 0.9, "дебил": 0.8, "урод": 0.7, "козел": 0.5, "ублюдок": 0.9, "шлюха": 0.9, "кретин": 0.7, "тупой": 0.5, "мудак": 0.9,
}
# General vocabulary by what it means in a sentence, folded: stem and weight. A stem that ends in a dash takes any ending,
# two words are a fixed expression, all others take case endings.
VOCABULARY = {
    # what someone says they will do to the other; alone only where the verb has the other as its object (-lak, -lek)
    "harm": {
        "megol-": 1.0, "agyonver-": 1.0, "agyonut-": 1.0, "agyonlo-": 1.0, "elver-": 0.8, "megver-": 0.8, "szetver-": 1.0, "osszever-": 0.9, "kinyir-": 1.0, "lelo-": 0.8, "megfojt-": 0.9, "kicsinal-": 0.9, "szetrug-": 0.9, "megkesel-": 1.0, "felpofoz-": 0.8,
        "eltor-": 0.8, "kitor-": 0.7, "betor-": 0.6, "bever-": 0.8, "kiver-": 0.8, "kiteker-": 0.8, "levag-": 0.6, "elvag-": 0.7, "kitep-": 0.7, "letep-": 0.7, "kitap-": 0.7, "felgyujt-": 0.8, "ragyujt-": 0.8, "elkap-": 0.4, "megtalal-": 0.4, "szetzuz-": 0.8,
        "kill": 0.8, "stab": 0.8, "strangle": 0.9, "beat": 0.4, "smash": 0.6, "break": 0.5, "burn": 0.5, "punch": 0.6, "shoot": 0.6, "umbring-": 0.9, "bring": 0.3, "erschlag-": 0.9, "brech-": 0.5, "schlag-": 0.5, "prugel-": 0.6, "verprugel-": 0.8, "erschiess-": 0.9, "erwurg-": 0.9, "убью": 0.9, "убить": 0.5, "зарежу": 0.9, "сломаю": 0.6, "задушу": 0.9, "изобью": 0.9, "прибью": 0.9, "сожгу": 0.6,
    },
    # what belongs to the other
    "yours": dict.fromkeys("kezed- labad- fejed- keped- pofad- nyakad- orrod- fogad- fogaid- bordad- bordaid- csontod- csontjaid- torkod- derekad- szemed- ujjaid- hazad- autod- kocsid- csaladod- gyereked- your dein- deine- твой твою твои твоего тебе".split(), 0.3),
    # death and ruin, wished for
    "death": {
        "dogolj-": 1.0, "dogoljel-": 1.0, "doglesz": 0.7, "megdogl-": 0.8, "pusztulj-": 0.9, "pusztulsz": 0.8, "elpusztul-": 0.6, "megdogol-": 0.8, "haljal": 0.9, "halj meg": 1.0, "meghalsz": 0.6, "meghaln-": 0.6, "rohadj-": 0.8, "megrohad-": 0.5, "gyullad-": 0.5, "leeg-": 0.4, "felfordul-": 0.5, "akaszd fel": 0.9, "kosd fel": 0.8, "ugorj": 0.2, "vonat ala": 0.6,
        "die": 0.6, "dead": 0.4, "cancer": 0.4, "hang yourself": 1.0, "kill yourself": 1.0, "rot in": 0.6, "verreck-": 1.0, "stirb": 0.9, "krepier-": 0.9, "сдохни": 1.0, "сдохнешь": 0.9, "сдох-": 0.8, "умри": 0.8, "гори в": 0.7,
    },
    "wish": dict.fromkeys("remelem barcsak kivanom kivanok legszivesebben inkabb megerdemeln- megerdemled jobb hope wish deserve better hoffe hoffentlich wunsche soll надеюсь желаю чтоб чтобы".split(), 0.2),
    "you": dict.fromkeys("te teged neked nektek rad rolad toled veled hozzad anyad- apad- you your youre yourself du dich dir euch ты тебя тебе вы вас".split(), 0.2),
    # whole groups, and plural nouns are found by their ending
    "group": dict.fromkeys("mind mindet mindegyik valamennyi osszes ilyenek ilyeneket ezek ezeket azok azoknak ezeknek oket nekik egytol nepseg- nep nepe nepet fajta- fajtaj- banda bandaj- csurhe- horda- all every them they these those their people alle diese sie leute pack gesindel все всех их они эти народ".split(), 0.3),
    # what takes the humanity of a group
    "subhuman": {
        "eloskod-": 0.8, "alja nep": 1.0, "nem emberek": 0.9, "allatok modjara": 0.7, "allatok": 0.4, "fereg": 0.6, "fergek": 0.7, "patkanyok": 0.5, "csocselek-": 0.8, "sopredek-": 0.9, "salak-": 0.4, "szemet nep-": 0.9, "mocskos nep-": 0.9, "alsobbrend-": 1.0, "barbar-": 0.5, "undorod-": 0.5, "gyulol-": 0.4, "tolvaj-": 0.3, "bunoz-": 0.4, "korcs-": 0.6, "fertoz-": 0.3,
        "subhuman-": 0.9, "vermin": 0.9, "parasites": 0.8, "cockroaches": 0.7, "animals": 0.4, "filth": 0.6, "rats": 0.5, "inferior": 0.6, "untermensch-": 1.0, "ungeziefer": 0.9, "parasiten": 0.8, "abschaum": 0.9, "schmarotzer": 0.8, "паразит-": 0.8, "недочеловек-": 1.0, "отброс-": 0.8, "скот": 0.6, "нелюд-": 0.9, "нелюди": 0.9,
    },
    # what should be done with a group
    "expel": {
        "kiirt-": 0.7, "irtani": 0.7, "kipusztit-": 0.7, "elpusztit-": 0.6, "pusztuln-": 0.7, "pusztuljanak": 0.9, "eltunn-": 0.5, "eltunjenek": 0.7, "gazba": 0.8, "gazkamra-": 0.9, "felkot-": 0.6, "kihajt-": 0.6, "hajtani": 0.5, "kidob-": 0.3, "kitoloncol-": 0.5, "kiuz-": 0.6, "elzavar-": 0.5, "takarodjanak": 0.9, "menjenek vissza": 0.8, "menjenek haza": 0.7, "visszakuld-": 0.4, "vissza kell": 0.4, "agyonloni": 0.8, "ki kell": 0.3, "ki kellene": 0.3, "ki kene": 0.3, "valo ide": 0.6, "semmi keresniv-": 0.5, "fold szinerol": 0.5,
        "exterminated": 0.9, "exterminate": 0.9, "wiped": 0.6, "wipe": 0.5, "eradicated": 0.8, "deported": 0.5, "go back": 0.4, "gassed": 0.9, "get rid": 0.5, "ausrott-": 0.8, "vergas-": 0.9, "vertreib-": 0.5, "abschieb-": 0.5, "raus": 0.4, "истребить": 0.9, "уничтожить": 0.7, "выгнать": 0.5, "вышвырнуть": 0.6, "гнать": 0.5, "перестрелять": 0.9,
    },
    # what people lawfully root out
    "pest": dict.fromkeys("csiga- csigak gyom- tetu tetvek tetveket tetvet leveltetv- hangya- vakond- eger egerek egeret ereg pocok pockok poloska- csotan- darazs- darazsak atka- moly- szunyog- legy legyek kartev- korokoz- gomba- parlagfu- fu fuvet bozot- gaz- weeds pests slugs ants aphids mosquitoes cockroach moles mice unkraut schnecken blattlause mause maulwurfe сорняк- слизн- тля муравь- крот- мыш- virus- vírus- program- bogar- fertozes-".split(), 1.0),
    # explicit words
    "sex": {
        "meztelen-": 0.6, "pucer-": 0.6, "porno-": 0.8, "szexpartner-": 1.0, "szex": 0.6, "szexel-": 0.7, "szexi-": 0.4, "lefekud-": 0.5, "lefekszel": 0.6, "vetkozz-": 0.6, "vetkozz le": 0.7, "melleid-": 0.8, "cicid-": 0.8, "cicik-": 0.6, "feneked-": 0.7, "segged-": 0.6, "punci-": 0.9, "puncid-": 1.0, "faszom-": 0.5, "nyalni": 0.3, "vegignyal-": 0.7, "kinyal-": 0.8, "megmarkol-": 0.3, "szopj-": 0.9, "szopd-": 0.9, "leszop-": 1.0, "magamhoz nyul-": 0.9, "kielegit-": 0.4, "orgazm-": 0.8, "erotik-": 0.5, "intim-": 0.4, "masszazs-": 0.3, "felnott": 0.2, "felnotteknek": 0.4, "boldog befejez-": 0.6, "nedves ejszak-": 0.7, "elvezni": 0.2, "testresz-": 0.3, "kefel-": 0.3, "megdug-": 0.9, "dugni": 0.3, "megbasz-": 0.9, "baszn-": 0.5, "szallj ram": 0.4, "durvan": 0.2, "nedves": 0.2, "izgat-": 0.1, "alsonadrag nelkul": 0.4,
        "naked": 0.7, "nude": 0.7, "nudes": 0.9, "porn-": 0.8, "sex": 0.6, "sexy": 0.4, "horny": 0.9, "boobs": 0.8, "tits": 0.8, "pussy": 0.9, "dick": 0.6, "cock": 0.5, "blowjob-": 1.0, "hot girls": 0.5, "girls": 0.2, "no strings": 0.4, "strip": 0.2, "cum": 0.6, "escort-": 0.3, "nackt-": 0.7, "titten": 0.9, "geil-": 0.4, "muschi": 0.8, "schwanz": 0.3, "blasen": 0.3, "ficken": 0.9, "sexkontakt-": 1.0, "erotisch-": 0.5, "голая": 0.7, "голые": 0.7, "голую": 0.7, "секс-": 0.7, "порно-": 0.8, "интим-": 0.7, "раздевай-": 0.7, "сиськи": 0.9, "трах-": 0.8, "шлюх-": 0.7,
    },
    # offers and requests beside explicit words
    "offer": dict.fromkeys("kuldj- kuldok mutatok mutass- keresek igerek ajanlok veled neked magadrol rolam ingyen diszkret privat- privatban ma este estere ejjel kepeket keped looking tonight free send show meet private want fuck with schick- zeig- suche heute treffen kostenlos privat хочу пришли покажи сегодня встретимся бесплатно ищу".split(), 0.4),
    # what makes an insult one of a whole group: birth and kin
    "kin": dict.fromkeys("gyereke- gyerekei- fajta- faja- vere- ver naluk szuletik szuletnek csaladja- ivadek- blood children breed born kids kinder blut brut geboren дети кровь порода".split(), 0.3),
    # what someone is called: beside a word that calls the other one by it
    "low": dict.fromkeys("ronda csunya szanalmas undorito ostoba buta sotet semmirekello senki senkihazi nulla hitvany gusztustalan visszataszito elmebeteg agyhalott agyatlan agyalagyult bolond fogyatekos nyomorult felesleges tehetsegtelen ertelmetlen gyoker bugyuta hulyegyerek ugly pathetic disgusting useless worthless brainless clueless hasslich- erbarmlich- dumm dummes widerlich- nutzlos жалкий жалкая тупой тупая уродливый ничтожество убогий бездарь".split(), 0.6),
    # dismissal and ill wishes to the other
    "away": {
        "takarodj-": 0.7, "kopj le": 0.6, "huzz el": 0.5, "huzz innen": 0.6, "pofa be": 0.6, "kuss": 0.6, "fogd be": 0.5, "fogd mar be": 0.5, "dugd fel": 0.7, "menj a fenebe": 0.5, "menj el a fenebe": 0.5, "menj a pokolba": 0.7, "senkinek sem hianyozn-": 0.7, "senkinek se hianyozn-": 0.7, "megszulett-": 0.2, "szegyelld": 0.4, "szegyeld": 0.4, "vetetett": 0.5, "eszed": 0.3, "ostobasag-": 0.2, "agyad": 0.3,
        "shut up": 0.5, "go to hell": 0.7, "get lost": 0.4, "nobody wants": 0.5, "piece of shit": 1.0, "piece of trash": 0.9, "screw you": 0.8, "fuck you": 1.0, "fuck off": 0.9, "halt die klappe": 0.7, "halt's maul": 0.9, "halts maul": 0.9, "verpiss-": 0.9, "hau ab": 0.5, "fick dich": 1.0, "заткнись": 0.7, "пошел вон": 0.7, "пошел ты": 0.7, "отвали": 0.6, "иди к черту": 0.7,
    },
}
# Words of address and of predication about a person (they raise a term near them), and of mention (they lower it).
ADDRESS = frozenset("te ti vagy vagytok anyad anyadba rad teged neked nektek magad magadnak eszed idefigyelj he na embert bolondja ir irsz irja forumtarsam szerencsetlen szanalmas mind tudod menj hallgass kepzeld you your youre are u du dich dir bist ihr euch ты вы тебя вас".split())
# Ordinary words, folded, that are as near to a term as a misspelling of it.
ORDINARY = frozenset(
    """harom baron karom varom zarom marom barok helye hulle kurta durva kuria kereten marka marna maria marta marja martha mocsot kocog kocsig kocsik picas pica pacsa csovek csovet csoven csovel csovei debit mobil
    panaszt faraszt maraszt parasit nyomorok szityok hattyu kafka lotto szajba szajra szajka szajna szajat modon mormon boron morog soron koron toron moros maroon idiom batch botch butch birch ditch hitch pitch witch itch
    tucker sucker pucker zucker bucker reward regard petard where whole shore chore whose wore whorl mirthless toothless crash brash thrash rash loses lower closer laser poser lover loner looser leser moser user lose
    schlappe wechsel wachser nummer hummer kummer summer dimmer drummer dumme trotter trotted schein schweiz sult бурак мазь дебит котел тугой скупой лупой чудак судак tettes terves rohadok rohadnek rohadik
    reten retek keten veten regeneralt regeneralta regeneralo generalta shut here""".split()
)
MENTION = frozenset("szo szot szavat szavak kifejezes kifejezest idezet idezem irta mondta nevezte hivta nevezett forditasa jelentese jelent szotar word words quote quoted said called means wort zitat sagte nannte слово цитата сказал".split())
#: What a misspelled term keeps of its weight by edits. A word is ordinary if at least OFTEN texts have it and at least SHARE times as many as have the term.
KEPT, OFTEN, SHARE = (1.0, 0.9, 0.8), 5, 0.25
#: Classes of words that make a sentence count, and the least weight of one of them in a sentence that does.
COUNTING, STRONG = frozenset(("harm", "death", "subhuman", "expel", "sex", "low", "away")), 0.4
#: What a term gains by address, keeps in quotation, and the score from which a text counts.
GAIN, QUOTED, LEAST = 0.5, 0.3, 1.0

_LETTERS = [*zip("áéíóöőúüűäàâèêëîïôûçñёй", "aeiooouuuaaaeeeiioucnеи", strict=True)]
_LEET = str.maketrans("0134578@$!", "oieastb" + "asi")
_WORD = re.compile(r"[^\W_]+")
_STAR = re.compile(r"(?<!\w)([^\W\d_])(\*{2,}|[*#]{2,}|-{3,}|_{2,})([^\W\d_]{1,3})(?!\w)")
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W_][ .\-_*·]{1,2}){3,}[^\W_](?![^\W_])")
_SIGNS = re.compile(r"[\d@$!]+")
_STRETCH = re.compile(r"([^\W\d_])\1{2,}")
_TRIPLES = tuple(c * 3 for c in "abcdefghijklmnopqrstuvwxyzаеиоуыдкрстн")
_QUOTE = re.compile(r"[„“”\"»«]([^„“”\"»«\n]+)[„“”\"»«]")
_ENDINGS = re.compile(r"^(?:[aeiouу]?k(?:at|et|nak|nek|kal|kel|rol|hoz)?|t|[aeo]t|nak|nek|val|vel|[a-z]al|[a-z]el|ba|be|ra|re|bol|tol|ja|je|d|m|s|es|n|er|en|e|ы|а|и|у|ом|ов)?$")


def fold(text: str) -> str:
    """Lower case without accents, any white space as one space."""
    text = text.lower()
    if not text.isascii():
        for letter, plain in _LETTERS:
            if letter in text:
                text = text.replace(letter, plain)
        text = text.replace("\u00a0", " ")
    for space in ("&nbsp;", "\n", "\t", "\r"):
        if space in text:
            text = text.replace(space, " ")
    while "  " in text:
        text = text.replace("  ", " ")
    return text


class Trie:
    """The lexicon as a trie; ``near`` intersects it with the Levenshtein automaton of a written word."""

    def __init__(self, words: list[str]) -> None:
        self.root: dict = {}
        for word in words:
            node = self.root
            for c in word:
                node = node.setdefault(c, {})
            node[""] = word

    def near(self, word: str, most: int, swaps: bool = False) -> list[tuple[str, int]]:
        """(term, distance) of all terms within ``most`` edits; with ``swaps`` two letters in each other's place are one edit."""
        return [(term, row[-1]) for term, row in self.rows(word, most, swaps) if row[-1] <= most]

    def rows(self, word: str, most: int, swaps: bool) -> list[tuple[str, list[int]]]:
        """(term, its distance to each prefix of ``word``) where one is within ``most``; states of the automaton are rows of distances cut at ``most``."""
        out: list[tuple[str, list[int]]] = []
        letters = set(word)
        stack = [(self.root, [*range(len(word) + 1)], [], "", 0)]
        while stack:
            node, row, before, last, missing = stack.pop()
            if "" in node and min(row) <= most:
                out.append((node[""], row))
            for c, below in node.items():
                # each letter of a term that the word lacks costs an edit
                lacks = missing + (c not in letters)
                if c and lacks <= most:
                    new = [row[0] + 1]
                    for i, w in enumerate(word):
                        cost = min(row[i + 1] + 1, new[i] + 1, row[i] + (w != c))
                        if swaps and before and i and w == last and word[i - 1] == c:
                            cost = min(cost, before[i - 1] + 1)
                        new.append(cost)
                    if min(new) <= most or (swaps and min(row) < most):
                        stack.append((below, new, row, c, lacks))
        return out


@lru_cache(1)
def _tools():  # noqa: ANN202
    import ahocorasick

    terms = {fold(k): v for k, v in INSULTS.items()}
    machine = ahocorasick.Automaton()
    for stem, entries in _stems().items():
        if " " in stem and any(kind in COUNTING and weight >= STRONG for kind, weight, _ in entries):
            machine.add_word(f" {stem}", ("expression", stem, 0.0))
    for term, weight in terms.items():
        machine.add_word(term, ("term", term, weight))
    machine.make_automaton()
    masks: dict[tuple[str, str, int], str] = {}
    for term in terms:
        for tail in (1, 2, 3):
            masks.setdefault((term[0], term[-tail:], len(term)), term)
    # words of the vocabulary that mean the same in every sentence are looked for in any spelling, too
    spelled = [w for c in ("subhuman", "sex", "low", "death") for w in VOCABULARY[c] if len(w) >= 6 and " " not in w and not w.endswith("-")]
    words = [*terms, *(w for w in spelled if w not in terms)]
    return terms, machine, masks, Trie(words), max(map(len, words))


@lru_cache(1)
def _stems() -> dict[str, list[tuple[str, float, bool]]]:
    """Stem to (class, weight, whether any ending follows); two words are joined by a space."""
    out: dict[str, list[tuple[str, float, bool]]] = {}
    for kind, words in VOCABULARY.items():
        for word, weight in words.items():
            out.setdefault(fold(word).rstrip("-"), []).append((kind, weight, word.endswith("-")))
    return out


#: Words that begin like a plural noun of people and are none.
_PLURAL = re.compile(r"(?:[aeo]k|[iu]k|ak|ek|ok)(?:at|et|ot|nak|nek|kal|kel|ra|re|rol|tol|bol|ban|ben|on|en|kozul)?$")


@lru_cache(200_000)
def meaning(word: str) -> tuple[tuple[str, str, float], ...]:
    """(class, stem, weight) of a folded word, or of two words joined by a space; one that is misspelled has the class of the word meant."""
    out = []
    stems = _stems()
    for cut in range(len(word), 1, -1):
        for kind, weight, any_ending in stems.get(word[:cut], ()):
            if cut == len(word) or any_ending or (" " not in word and _ENDINGS.match(word[cut:])):
                out.append((kind, word[:cut], weight))
    if not out and " " not in word and len(word) >= 6:
        near = looked_up(word)
        if near and near[1] and near[0] in stems:
            out = [(kind, near[0], weight * KEPT[near[1]]) for kind, weight, _ in stems[near[0]]]
    return tuple(out)


_PART = re.compile(r"[^.!?\n…]+[.!?…]*")
#: How far a word may stand from the word it belongs to, in words.
NEAR = 8


def sentence_values(words: list[str], before: frozenset[str] = frozenset()) -> dict[str, float]:
    """What the words of one sentence say about someone: value by kind (threat, curse, group, explicit, insult).

    before: classes of the sentence before, which a sentence without a noun of its own can go on about.
    """
    found: list[tuple[int, str, str, float]] = []
    for i, w in enumerate(words):
        for size in (4, 3, 2):  # fixed expressions
            if i + size <= len(words):
                found += [(i, kind, stem, weight) for kind, stem, weight in meaning(" ".join(words[i : i + size])) if stem.count(" ") == size - 1]
        found += [(i, kind, stem, weight) for kind, stem, weight in meaning(w)]
    if not any(kind in COUNTING and weight >= STRONG for _, kind, _, weight in found):
        return {}
    places: dict[str, list[int]] = {}
    for i, kind, _, _ in found:
        places.setdefault(kind, []).append(i)
    near = lambda i, kind, most=NEAR: any(abs(i - j) <= most for j in places.get(kind, ()))
    plural = any(_PLURAL.search(w) and len(w) >= 6 and not meaning(w) for w in words)
    out: dict[str, float] = {}

    def add(kind: str, stem: str, value: float) -> None:
        seen.setdefault((kind, stem), 0.0)
        seen[kind, stem] = max(seen[kind, stem], value)

    seen: dict[tuple[str, str], float] = {}
    for i, kind, stem, weight in found:
        if kind == "harm":
            if near(i, "pest", 20):
                continue
            mine = words[i].endswith(("lak", "lek"))
            first = words[i].endswith(("om", "em", "nam", "nem", "ok", "ek")) or not words[i].isascii() or words[i] == stem
            if mine:
                add("threat", stem, weight + (0.3 if weight >= 0.8 else 0.1))
            elif first and near(i, "yours") and (words[i] != stem or any(w in ("ill", "will", "gonna", "ich", "i") for w in words) or not words[i].isascii()):
                add("threat", stem, weight + 0.5)
            elif near(i, "you", 4) and words[i] == stem and any(w in ("ill", "will", "gonna", "ich", "я") or not w.isascii() for w in words):
                add("threat", stem, weight + 0.3)
        elif kind == "death":
            towards = near(i, "you") or near(i, "yours") or words[i].endswith(("sz", "nal", "nel"))
            add("curse", stem, weight + (0.5 if near(i, "wish", 12) and towards else 0.0))
        elif kind in ("subhuman", "expel"):
            if kind == "expel" and near(i, "pest", 20) or "pest" in places and kind == "subhuman":
                continue
            about = plural or "group" in places or "group" in before
            add("group", stem, weight * (1.0 if about else 0.4))
        elif kind == "sex":
            if not near(i, "pest", 2):  # naked slugs
                add("explicit", stem, weight)
        elif kind == "low":
            called = (i and words[i - 1] in ("te", "you", "du", "ty", "ты", "ilyen", "are", "bist", "so")) or (i + 1 < len(words) and words[i + 1] in ("vagy", "vagytok", "you")) or (i >= 2 and words[i - 2] in ("te", "you", "youre", "du", "ты"))
            if called:
                add("insult", stem, weight + (0.2 if near(i, "you") else 0.1))
        elif kind == "away":
            add("insult", stem, weight)
    for (kind, _), value in seen.items():
        out[kind] = out.get(kind, 0.0) + value
    if "group" in out and ("group" in places or plural):
        out["group"] += 0.3
    if "explicit" in out and any(near(i, "offer") for i, kind, _, _ in found if kind == "sex"):
        out["explicit"] += 0.4
    return out



@lru_cache(200_000)
def looked_up(word: str) -> tuple[str, int] | None:
    """(term, edits) of the term that a word is (0 edits) or misspells, with or without a case ending; None for ordinary words.

    One edit, a swap among them, up to eight letters, two from nine on. Of a term of four letters, one edit in which makes a
    great many ordinary words, only swaps and doubled letters are misspellings. Endings count behind six letters or more.
    """
    _, _, _, trie, longest = _tools()
    if not 4 <= len(word) <= longest + 7 or word in ORDINARY:
        return None
    term = _known(word)
    if term:
        return term, 0
    best: tuple[int, int, str] | None = None
    for term, row in trie.rows(word, 2 if len(word) >= 9 else 1, True):
        for j in range(len(word), 3, -1):
            if not 0 < row[j] <= (2 if j >= 9 and len(term) >= 6 else 1) or word[:j] in ORDINARY:
                continue
            if j < len(word) and (len(term) < 6 or j < 6 or not _ENDINGS.match(word[j:])):
                continue
            if len(term) == 4 and not (sorted(term) == sorted(word) or re.sub(r"(.)\1", r"\1", word) == re.sub(r"(.)\1", r"\1", term)):
                continue
            if best is None or (row[j], len(word) - j, term) < best:
                best = (row[j], len(word) - j, term)
    return (best[2], best[0]) if best else None


def hits(text: str, ordinary: frozenset[str] = frozenset(), wrong: dict[str, tuple[str, int]] | None = None) -> list[tuple[int, int, str, float]]:
    """(start, end, term, weight) of terms in a folded text, weights without context; ``ordinary`` words misspell none."""
    terms, machine, masks, *_ = _tools()
    out = []
    for end, (kind, term, weight) in machine.iter(text):
        if kind != "term":
            continue
        at = end - len(term) + 1
        if at and text[at - 1].isalnum():
            continue
        tail = end + 1
        while tail < len(text) and text[tail].isalnum():
            tail += 1
        if not _ENDINGS.match(text[end + 1 : tail]):
            continue
        out.append((at, end + 1, term, weight))
    if "*" in text or "#" in text or "--" in text or "__" in text:
        for m in _STAR.finditer(text):
            term = masks.get((m[1], m[3], len(m[1]) + len(m[2]) + len(m[3])))
            if term:
                out.append((*m.span(), term, terms[term]))
    for m in _SPACED.finditer(text):
        letters = re.sub(r"[^\w]|_", "", m.group())
        # a one-letter word may stand before or after the letters
        for word in (letters, letters[1:], letters[:-1], letters[1:-1]):
            term = _known(word)
            if term:
                out.append((*m.span(), term, terms[term]))
                break
    done = 0
    for m in _SIGNS.finditer(text):
        if m.start() < done or not (text[m.start() - 1 : m.start()].isalpha() or text[m.end() : m.end() + 1].isalpha()):
            continue
        a, done = _token(text, *m.span())
        term = _known(text[a:done].translate(_LEET))
        if term:
            out.append((a, done, term, terms[term]))
    for m in _STRETCH.finditer(text) if any(c in text for c in _TRIPLES) else ():
        a, b = _token(text, *m.span())
        term = _known(_plain(text[a:b], 1)) or _known(_plain(text[a:b], 2))
        if term:
            out.append((a, b, term, terms[term]))
    wrong = _telling(set(_WORD.findall(text)))[0] if wrong is None else wrong
    wrong = {w: near for w, near in wrong.items() if w not in ordinary}
    taken = [(a, b) for a, b, _, _ in out]
    for m in _WORD.finditer(text) if wrong else ():
        if m.group() in wrong and all(b <= m.start() or a >= m.end() for a, b in taken):  # one word counts once
            term, edits = wrong[m.group()]
            if term in terms:
                out.append((*m.span(), term, terms[term] * KEPT[edits]))
    return out


def _token(text: str, a: int, b: int) -> tuple[int, int]:
    """The token around a span; signs that stand for letters belong to it."""
    while a and (text[a - 1].isalnum() or text[a - 1] in "@$"):
        a -= 1
    while b < len(text) and (text[b].isalnum() or text[b] in "@$"):
        b += 1
    return a, b


def _plain(word: str, most: int) -> str:
    """Letters that stand three times or more, ``most`` times."""
    return re.sub(r"(.)\1{2,}", lambda m: m[1] * most, word)


def _known(word: str) -> str | None:
    """The term a word is, with a case ending or with a letter doubled by stretching."""
    terms = _tools()[0]
    for cut in range(len(word), max(3, len(word) - 5), -1):
        if word[:cut] in terms and _ENDINGS.match(word[cut:]):
            return word[:cut]
    return None


def score(text: str, ordinary: frozenset[str] = frozenset()) -> tuple[float, str | None]:
    """(score, what counts most) of a text; ``ordinary`` words misspell no term.

    A term counts by its weight and by the words around it: more where it addresses someone, less in a quotation that is talked
    about. Sentences count by what their words say together (``sentence_values``), but not those within quotation marks of a mention.
    """
    low = f" {fold(text)} "
    wrong, counts = _telling(set(_WORD.findall(low)))
    expressed = not counts and any(kind == "expression" for _, (kind, _, _) in _tools()[1].iter(low))
    found = hits(low, ordinary, wrong)
    if not found and not counts and not expressed:
        return 0.0, None
    quotes = [m.span(1) for m in _QUOTE.finditer(low)]
    words = [(m.start(), m.end(), m.group()) for m in _WORD.finditer(low)]
    values: dict[str, float] = {}  # of the occurrences of a term the one that counts most

    def mentioned(a: int, around: set[str]) -> bool:
        return bool(around & MENTION) and any(x <= a < y for x, y in quotes)

    for a, b, term, weight in found:
        around = {w for x, y, w in words if y > a - 40 and x < b + 30 and not (x >= a and y <= b)}
        value = weight + (GAIN if around & ADDRESS or _of_kin(low, a) else 0.0)
        values[term] = max(values.get(term, 0.0), value * (QUOTED if mentioned(a, around) else 1.0))
    if counts or expressed:
        before: frozenset[str] = frozenset()
        for m in _PART.finditer(low):
            part = _WORD.findall(m.group())
            said = sentence_values(part, before)
            before = frozenset({"group"}) if any(kind == "group" for w in part for kind, _, _ in meaning(w)) else frozenset()
            if said and quotes and mentioned(next((q[0] for q in quotes if m.start() <= q[0] < m.end()), -1), set(part)):
                said = {k: v * QUOTED for k, v in said.items()}
            for kind, value in said.items():
                values[kind] = max(values.get(kind, 0.0), value)
    if not values:
        return 0.0, None
    return round(sum(values.values()), 4), max(values, key=lambda k: (values[k], k))


def _of_kin(text: str, at: int) -> bool:
    """Whether the sentence around a place speaks of a group's birth or kin."""
    start = max(text.rfind(mark, 0, at) for mark in ".!?\n") + 1
    words = _WORD.findall(_PART.match(text, start).group()) if _PART.match(text, start) else []
    kinds = {kind for w in words for kind, _, _ in meaning(w)}
    return "kin" in kinds and ("group" in kinds or any(len(w) >= 6 and _PLURAL.search(w) for w in words))


#: Words without a part in any of this; only a cache, emptied when it is full.
_PLAIN_WORDS: set[str] = set()


def _telling(words: set[str]) -> tuple[dict[str, tuple[str, int]], bool]:
    """(misspelled words with the term and the edits, whether a word can make a sentence count) of the words of a text."""
    wrong: dict[str, tuple[str, int]] = {}
    counts = False
    for w in words - _PLAIN_WORDS:
        near = looked_up(w)
        if near and near[1]:
            wrong[w] = near
        strong = any(kind in COUNTING and weight >= STRONG for kind, _, weight in meaning(w))
        counts |= strong
        if not strong and not (near and near[1]):
            if len(_PLAIN_WORDS) > 500_000:
                _PLAIN_WORDS.clear()
            _PLAIN_WORDS.add(w)
    return wrong, counts


def frequent(df: DataFrame, text: str) -> frozenset[str]:
    """Words near a term that too many texts have for a misspelling of it. The driver receives one row per term and per such word of ``OFTEN`` texts."""

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        counts: Counter[str] = Counter()
        plain: set[str] = set()
        for given in batches:
            for t in given.column(0).to_pylist():
                for w in set(_WORD.findall(fold(t))) - plain:
                    if looked_up(w):
                        counts[w] += 1
                    elif len(plain) < 500_000:
                        plain.add(w)
        rows = [(*looked_up(w), w, n) for w, n in counts.items()]
        columns = [*zip(*rows, strict=True)] or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.string(), pa.int32(), pa.string(), pa.int64()], strict=True)], names=["term", "edits", "word", "n"])

    words = df.select(F.col(f"`{text}`").alias("_text")).filter("_text <> ''").mapInArrow(run, "term string, edits int, word string, n bigint")
    rows = words.groupBy("term", F.when(F.col("edits") > 0, F.col("word")).alias("word")).agg(F.sum("n").alias("n")).filter(f"word is null or n >= {OFTEN}").collect()
    of = {r.term: r.n for r in rows if r.word is None}
    return frozenset(r.word for r in rows if r.word is not None and r.n >= SHARE * of.get(r.term, 0))


def scored(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, score, term) for every row; a null or empty text scores 0.

    Scores from ``LEAST`` on mean that the text is abusive, hateful or explicit. Repeated rows give repeated results; further columns
    of any name are ignored. Whole texts of any length are read.
    """
    ordinary = frequent(df, text)

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for given in batches:
            rows = [score(t, ordinary) if t else (0.0, None) for t in given.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([given.column(0), pa.array([r[0] for r in rows], pa.float64()), pa.array([r[1] for r in rows], pa.string())], names=["_key", "score", "term"])

    kind = dict(df.dtypes)[key]
    out = df.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).mapInArrow(run, f"_key {kind}, score double, term string")
    return out.toDF(key, "score", "term")


def rates(df: DataFrame, key: str, source: str, text: str) -> DataFrame:
    """(source, texts, abusive, rate) for every source, null sources among them."""
    marked = df.select(F.struct(F.col(f"`{source}`").alias("source")).alias("_s"), F.col(f"`{text}`").alias("_t"))
    per = scored(marked, "_s", "_t").groupBy(F.col("_s.source").alias(source)).agg(F.count("*").alias("texts"), F.count_if(F.col("score") >= LEAST).alias("abusive"))
    return per.withColumn("rate", F.col("abusive") / F.col("texts"))
