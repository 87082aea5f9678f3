"""Personal information in free text: found by seeds and by the contexts that seeds induce, and replaced by typed placeholders.

Every place that has the outer form of an identifier is a mention: two words that can be a name, an address with any sign for the
``@``, digit groups of a telephone's length, a number of an identity number's shape, a word with a house number. A mention
has a head, by which its kind is told: the given name, the sign, the way the number begins, the label, the kind of public place. A few
heads of each kind are seeds. Around each mention stands its pattern, two words before and one after. Spark scores the graph of patterns
and heads in rounds: a pattern is as good as its heads, a head as good as its patterns are without it; heads that score
like seeds become seeds of the next round. Mentions with such heads are identifiers, in every text and in any case.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosta.session import written

# Seeds. The most frequent given names that stand behind the family name, and those that stand before it.
GIVEN_LAST = frozenset(
    """lászló istván józsef jános zoltán sándor gábor ferenc attila péter tamás zsolt tibor andrás csaba imre lajos györgy balázs gyula
    mária erzsébet katalin ilona éva anna zsuzsanna margit judit ágnes julianna andrea ildikó erika krisztina irén eszter magdolna mónika edit""".split()
)
GIVEN_FIRST = frozenset(
    """john mary michael james robert jennifer linda elizabeth william david richard susan joseph thomas karen sarah charles emily daniel matthew
    hans peter wolfgang klaus jürgen andreas stefan ursula monika petra sabine renate helga karin brigitte ingrid heike anja jens dieter
    иван александр сергей дмитрий алексей андрей николай владимир михаил елена ольга татьяна наталья ирина анна мария светлана екатерина юлия виктор""".split()
)
# Seeds of the other kinds: signs of e-mail addresses, beginnings of telephone numbers, labels of identity numbers, public places.
SEEDS = {
    "email": frozenset(["@"]),
    "phone": frozenset(["+", "00", "06"]),
    "id_number": frozenset("személ_szám taj adóazo adóazo_jel ssn securi person снилс паспор".split()),
    "address": frozenset("utca utcája út útja u tér tere street road avenue straße strasse ул".split()),
    "last": GIVEN_LAST,
    "first": GIVEN_FIRST,
}
# Words before a given name that are no family name.
NOT_FAMILY = frozenset(
    """szia sziasztok szevasz hello helló hali üdv üdvözlettel kedves tisztelt drága kösz köszi köszönöm köszönettel tisztelettel puszi és vagy meg a az ez én te ő mi ti ők hogy ha de mert is nem igen ja jó na no ó szerintem kollégám szomszéd
    feleségem férjem barátom apósom nagybátyám nagynéném testvérem bátyám öcsém nővérem húgom anyám apám fiam lányom név neve kapcsolat feladó címzett bérbeadó eladó vevő keresse beszéltem írta küldte mondta dr ifj id özv prof ing
    dear hi mr mrs ms from to by von an herr frau liebe lieber hallo sent subject feladó von re fw ma tegnap holnap január február március április május június július augusztus szeptember október november december pénzt számlát
    original message eredeti üzenet továbbított levél utca út tér köz sor sétány boldog szent mint majd pedig csak már még akkor itt ott üzlet bolt kft bt zrt rt nyrt""".split()
)
# Common family names without a telling ending, for texts in one case.
FAMILY = frozenset("nagy kovács tóth szabó horváth varga kiss kis molnár németh farkas balogh papp takács juhász mészáros simon rácz fekete szilágyi török fehér balázs gál pintér szűcs kocsis orsós fodor szalai sipos lukács gulyás bíró király katona jakab bogdán boros varró kelemen antal vass szekeres hegedűs orosz barta nemes vörös".split())
# Words that no label of a number ends in alone, so that the word before belongs to it.
COMMON_LABEL = frozenset("szám száma számom számú számot sz jel jele jelem jelű kártya kártyája kártyám azonosító azonosítóm azonosítója igazolvány igazolványom igazolványa ig az no nr number id".split())

_WORD = r"[^\W\d_]"
_PLAIN = dict(zip("áéíóöőúüű", "aeiooouuu", strict=True))
_ENTITY = "&nbsp;"
# what joins the two parts of an address
_AT = re.compile(r"\s?@\s?|\s?[(\[{<*]\s?(?:[^\W\d_]{1,8}|@|a t)\s?[)\]}>*]\s?|\s(?:kukac|at)\s|kukac|(?<=\w)[#¤&~§](?=\w)")
_DOT = r"(?:\.|\s?[(\[{<*]\s?(?:pont|dot|punkt|\.|точка)\s?[)\]}>*]\s?|\s(?:pont|dot)\s)"
_DOMAIN = re.compile(rf"\w[\w-]*(?:{_DOT}\w[\w-]*)*?(?:\.|\s?[(\[{{<*]\s?(?:pont|dot|punkt|\.|точка)\s?[)\]}}>*]\s?|\s(?:pont|dot)\s)[^\W\d_]{{2,}}(?!{_DOT}?\w)|\w[\w-]*(?:{_DOT}\w[\w-]*)+|(?<=kukac)[\w-]+?pont[^\W\d_]{{2,}}")
_NUMBER = re.compile(
    r"(?<![\w+/.,-])(?<!\d[\s ])(?:\(?\+|\(?o6[ \t\u00a0./()-]{0,3}|\(?)\d(?:[ \t\u00a0./()-]{0,3}\d){6,14}(?![\w/])(?![ \t\u00a0]\d)(?![.,-]\d)",
    re.I,
)
_DIGIT = "nulla|egy|kettő|két|három|négy|öt|hat|hét|nyolc|kilenc"
_SPOKEN = re.compile(rf"\bnulla[\s,-]+hat[\s,-]+(?:(?:{_DIGIT}|tíz|tizen\w+|húsz|huszon\w+|harminc\w*|negyven\w*|ötven\w*|hatvan\w*|hetven\w*|nyolcvan\w*|kilencven\w*|száz\w*)[\s,-]+){{4,}}(?:{_DIGIT}|\w*(?:tíz|ven|van|minc|húsz|{_DIGIT}))\b", re.I)
_FORMS = (
    re.compile(r"(?:\+|00)\s?36\)?[\s ./()-]{0,3}\(?(?:1|[2-9]\d)\)?[\s ./)-]{0,3}\d{2,4}(?:[\s .-]?\d{2,4}){1,2}"),
    re.compile(r"[0o]6\)?[\s ./()-]{0,3}\(?(?:1|[2-9]\d)\)?[\s ./)-]{0,3}\d{2,4}(?:[\s .-]?\d{2,4}){1,2}", re.I),
    re.compile(r"(?:20|30|31|50|70)\s?/\s?\d{3}[\s -]?\d{2}[\s -]?\d{2}|(?:20|30|31|50|70)[\s -]\d{3}[\s -]\d{2}[\s -]?\d{2}"),
    re.compile(r"\+(?!36)\d{1,3}[\s ()/-]{0,2}\d{1,4}(?:[\s ()/-]{1,2}\d{2,8}){1,4}"),
)
# Shapes of identity numbers.
_ID_VALUE = re.compile(r"(?<![\w/])(?:[1-8][\s -]?\d{6}[\s -]?\d{4}|\d{3}[\s -]?\d{3}[\s -]?\d{3}(?!\d)|8\d{9}|\d{6}[\s -]?[a-z]{2}(?!\w)|[a-z]{2}[\s -]?\d{6,7}|\d{3}-\d{2}-\d{4})(?![\d/])(?!-\d)")
_LABEL_AFTER = re.compile(rf"\s*(?:\(|,|-|–)?\s*(?:a |az )?((?:{_WORD}+\.?[\s-]*){{1,3}})")
_LABEL_BEFORE = re.compile(rf"({_WORD}+)\W*$")
_HOUSE = re.compile(rf"[\s ,]+(?P<no>\d{{1,4}})(?!\d)(?P<rest>(?:\s?[-/]\s?(?:\d{{1,4}}|{_WORD})(?!\w))?)(?P<after>\.?[\s ]?{_WORD}*)")
_HOUSE_FIRST = re.compile(rf"(?<![\w./,-])\d{{1,5}}[a-z]?\s+((?:{_WORD}+\s+){{1,2}}?)(street|road|avenue|lane|drive|square|way|close|st|rd|ave)\b\.?")
_STREET_RU = re.compile(rf"(?<!\w)(?:ул|улица|пр|проспект|пер|переулок)\.?\s+({_WORD}+(?:\s{_WORD}+)?),?\s+(?:д\.?\s?|дом\s)?\d{{1,4}}")
_JOINED_STREET = re.compile(rf"(?<!\w)({_WORD}{{2,}}?)(straße|strasse|str\.|gasse|platz|weg|allee)\s+\d{{1,4}}(?:\s?[a-z])?(?!\w)")
# Words that make a number after a public place something else, and words before one that are no name.
_UNITS = frozenset("km m cm mm kg g db ft perc óra nap hét hónap év éves forint eft méter kilométer százalék fok liter tag vége".split())
_NO_NAME = frozenset("a az egy két három sok több néhány minden ez ezt azt hosszú rövid első második utolsó rossz jó nagy kis hosszabb vissza ki be el fel le haza és vagy as es os ös -as vége a/az".split())
_PAIR = re.compile(r"(?<![\w.-])([^\W\d_]{2,}(?:-[^\W\d_]{2,})?)[ \t\u00a0]+([^\W\d_]{2,}(?:-[^\W\d_]{2,})?)(?![\w-])")
_TITLE_WORD = re.compile(r"(?<![\w.-])[A-ZÁÉÍÓÖŐÚÜŰÄА-ЯЁ][a-záéíóöőúüűäßа-яё]+(?:-[A-ZÁÉÍÓÖŐÚÜŰÄА-ЯЁ][a-záéíóöőúüűäßа-яё]+)?(?=[ \t\u00a0]+([A-ZÁÉÍÓÖŐÚÜŰÄА-ЯЁ][a-záéíóöőúüűäßа-яё]+(?:-[A-ZÁÉÍÓÖŐÚÜŰÄА-ЯЁ][a-záéíóöőúüűäßа-яё]+)?)(?![\w-]))")
_TOKEN = re.compile(r"\w+|[^\w\s]")
_CASE = r"(?:nak|nek|val|vel|t|ot|et|at|öt|ért|hoz|hez|höz|tól|től|ról|ről|ban|ben|ba|be|on|en|ön|ra|re|é|ék|ig|ként|nál|nél|i|[bcdfghjklmnprstvz]{1,2}[ae]l)?"

_CASED = re.compile(_CASE)
_ANY_DIGIT = re.compile(r"\d")

#: (kind, head, start, end, where its context ends before it) of a mention: a label is no context of its number.
Mention = tuple[str, str, int, int, int]


def words_before(low: str, at: int, most: int) -> list[tuple[int, int]]:
    """Places of up to ``most`` words before ``at``, nearest first, with nothing but white space between them; words of any length."""
    out: list[tuple[int, int]] = []
    while len(out) < most:
        while at and low[at - 1].isspace():
            at -= 1
        stop = at
        while at and (low[at - 1].isalnum() or low[at - 1] in "_.'-"):
            at -= 1
        while at < stop and not low[at].isalpha():  # a word begins with a letter
            at += 1
        if at >= stop:
            break
        out.append((at, stop))
    return out


def _emails(low: str) -> list[Mention]:
    """Addresses with whatever sign stands for the ``@``."""
    out: list[Mention] = []
    done = 0
    for m in _AT.finditer(low):
        if m.start() < done:
            continue
        a = m.start()
        while a > done and (low[a - 1].isalnum() or low[a - 1] in "_.+-"):
            a -= 1
        if a == m.start() or not (low[m.start() - 1].isalnum() or low[m.start() - 1] == "_"):
            continue
        sign = "".join(m.group().split())
        domain = _DOMAIN.match(low, m.end())
        if not domain:
            continue
        host = domain.group()
        if sign in ("kukac", "at") and m.group() == sign and "pont" not in host and "." not in host:
            continue
        if not re.search(r"[^\W\d_]{2,}$", host):
            continue
        plain = sign == "@" and not re.search(r"\s", m.group()) and not re.search(r"[\s(\[{<*]", host)
        head = "@" if plain else ("@~" if sign == "@" else ("~" + sign if m.group().strip() != m.group() else sign))
        out.append(("email", head, a, domain.end(), a))
        done = domain.end()
    return out


def _phones(low: str) -> list[Mention]:
    """Digit groups of a telephone number's length, by the way they begin, and numbers written in words."""
    out: list[Mention] = []
    for m in _NUMBER.finditer(low):
        a, b = m.span()
        shown = low[a:b]
        digits = sum(c.isdigit() for c in shown) + shown.startswith(("o6", "(o6"))
        if not 7 <= digits <= 15:
            continue
        bare = shown.lstrip("(")
        if bare.startswith("+"):
            head, fits = "+", _FORMS[0].fullmatch(bare) or _FORMS[3].fullmatch(bare)
        elif bare.startswith("00"):
            head, fits = "00", _FORMS[0].fullmatch(bare)
        elif bare.startswith(("06", "o6")):
            head, fits = bare[:2], _FORMS[1].fullmatch(bare)
        elif _FORMS[2].fullmatch(bare):
            head, fits = "area" + ("/" if "/" in bare else ""), True
        else:
            head, fits = "groups:" + re.sub(r"\d", "d", bare), True
        least = 12 if bare.startswith("0036") else 10 if bare.startswith(("06", "o6", "+36")) else 7 if head.startswith("groups") else 9
        if fits and digits >= least:
            out.append(("phone", head, a, b, a))
    if "nulla" in low:
        out += [("phone", "spoken", *m.span(), m.start()) for m in _SPOKEN.finditer(low)]
    return out


def _label(words: list[str]) -> tuple[str, int]:
    """Head of an identity number's label and its number of words: the last one, and those before it as far as they are common ones; cut to six letters."""
    words = [w.strip(".-_'").lower() for w in words]
    words = [w for w in words if w]
    if not words:
        return "", 0
    size = 1
    while size < len(words) and words[-size] in COMMON_LABEL:
        size += 1
    kept = words[-size:]
    return "_".join(re.sub(r"(?<=..)(?:om|em|ja|unk|m|a)$", "", w)[:6] if len(w) > 4 else w for w in kept), len(kept)


def _ids(low: str) -> list[Mention]:
    """Numbers of an identity number's shape with a word before or behind that can be their label."""
    out: list[Mention] = []
    for m in _ID_VALUE.finditer(low):
        at = m.start()
        while at and (low[at - 1].isspace() or low[at - 1] in ":=#.-("):
            at -= 1
        spans = words_before(low, at, 3)
        line = low.rfind("\n", 0, m.start())
        words = [(x.group(), a + x.start()) for a, b in reversed(spans) if a > line for x in re.finditer(rf"{_WORD}+", low[a:b])]
        while len(words) > 1 and words[-1][0] in ("az", "a", "sz", "nr", "no") and words[-2][0] not in ("adó", "szem", "személyi", "szig"):
            words.pop()
        head, size = _label([w for w, _ in words])
        if head:
            out.append(("id_number", head, *m.span(), words[-size][1]))
        after = _LABEL_AFTER.match(low, m.end())
        if after:
            behind = re.findall(rf"{_WORD}+", after[1])
            for k in (1, 2):
                other = _label(behind[:k])[0] if len(behind) >= k else head
                if other != head:
                    out.append(("id_number", other, *m.span(), m.start()))
    return out


def _addresses(low: str) -> list[Mention]:
    """A name, a kind of public place and a house number, in any of the orders of the languages."""
    out: list[Mention] = []
    for m in _HOUSE.finditer(low):
        spans = words_before(low, m.start(), 3)
        if len(spans) < 2 or "\n\n" in low[spans[1][0] : m.start()]:
            continue
        place = low[spans[0][0] : spans[0][1]]
        first = low[spans[1][0] : spans[1][1]]
        name, after = first.split()[-1].strip("."), m["after"].strip(". \t\n\u00a0")
        if name in _NO_NAME or after in _UNITS or len(name) < 2 or not place.rstrip(".").isalpha() or first.endswith("."):
            continue
        start = spans[2][0] if len(spans) > 2 and "\n" not in low[spans[2][0] : spans[1][0]] and not low[spans[2][1] - 1] == "." else spans[1][0]
        out.append(("address", place.rstrip("."), start, m.end("rest"), start))
    if "str" in low or "weg" in low or "platz" in low or "gasse" in low or "allee" in low:
        out += [("address", m[2].rstrip(".").replace("strasse", "straße"), m.start(), m.end(), m.start()) for m in _JOINED_STREET.finditer(low) if m[1] not in _NO_NAME]
    for m in _HOUSE_FIRST.finditer(low):
        out.append(("address", {"st": "street", "rd": "road", "ave": "avenue"}.get(m[2], m[2]), *m.span(), m.start()))
    if "ул" in low or "пр" in low or "пер" in low:
        out += [("address", "ул", *m.span(), m.start()) for m in _STREET_RU.finditer(low)]
    return out


def mentions(text: str, numbers: bool = True, houses: bool = True) -> list[Mention]:
    """Everything in a text that has the outer form of an identifier, but names; places are those of the text as it is.

    numbers, houses: whether telephone and identity numbers, and addresses, are looked for.
    """
    text, place = _written_spaces(text)
    if place is not None:
        return [(kind, head, place[a], place[b - 1] + 1, place[c]) for kind, head, a, b, c in mentions(text, numbers, houses)]
    low = lower(text)
    out = _emails(low) if "@" in low or "kukac" in low or any(c in low for c in "([{<*#¤&~§") or " at " in low else []
    if _ANY_DIGIT.search(low):
        if numbers:
            out += _phones(low) + _ids(low)
        if houses:
            out += _addresses(low)
    elif "nulla" in low and numbers:
        out += _phones(low)
    return out


def lower(text: str) -> str:
    """Lower case, letter by letter: one whose lower case is longer stays."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def name_pairs(text: str) -> list[tuple[str, str, int, int]]:
    """(first word, second word, start, end), folded to lower case, of adjacent capitalised words in any script that can be a name."""
    out = []
    for m in _TITLE_WORD.finditer(text):
        first, second = m.group().lower(), m[1].lower()
        if first not in NOT_FAMILY and second not in NOT_FAMILY and len(first) >= 3 and len(second) >= 2:
            out.append((first, second, m.start(), m.end(1)))
    return out


def seeds(text: str, accepted: dict[str, frozenset[str]] | None = None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the identifiers in a text whose heads are ``accepted``; the seeds where that is None."""
    heads = accepted or SEEDS
    out = [(kind, a, b) for kind, head, a, b, _ in mentions(text) if head in heads[kind]]
    return out + [("name", a, b) for a, b in names_in(text, heads["last"], heads["first"])]


@lru_cache(8)
def _name_machines(last: frozenset[str], first: frozenset[str]):  # noqa: ANN202
    """Automata of given names behind and before the family name, with the patterns of their cased forms."""
    import ahocorasick

    machines = []
    for names in (last, first):
        machine = ahocorasick.Automaton()
        for name in names | {"".join(_PLAIN.get(c, c) for c in n) for n in names}:  # also written without accents
            stem = name[:-1] if name[-1] in "ae" else name
            machine.add_word(stem, (name, re.compile(rf"{re.escape(stem)}(?:{name[-1]}|[{'aá' if name[-1] == 'a' else 'eé'}]{_CASE})(?!\w)" if name[-1] in "ae" else rf"{re.escape(name)}{_CASE}(?!\w)")))
        machine.make_automaton()
        machines.append(machine)
    return machines


def _written_spaces(text: str) -> tuple[str, list[int] | None]:
    """``text`` with written no-break spaces as one space, and the place of each of its characters before that; None where nothing changes."""
    if _ENTITY not in text:
        return text, None
    parts = text.split(_ENTITY)
    place, at = [], 0
    for part in parts:
        place += range(at, at + len(part) + 1)
        at += len(part) + len(_ENTITY)
    return " ".join(parts), place


def _family_before(text: str, low: str, at: int) -> tuple[int, str] | None:
    """(start, family name) of what stands before a given name at ``at``, if it can be its family name."""
    if at < 3 or not low[at - 1].isspace():
        return None
    spans = words_before(low, at, 1)
    if not spans:
        return None
    start, stop = spans[0]
    family = low[start:stop].lstrip(".'-_")
    start = stop - len(family)
    gap = low[stop:at]
    if gap.count("\n") > 1 or len(family) < 3 or not family.replace("-", "").isalpha() or family.endswith("-"):
        return None
    if family in NOT_FAMILY or family.split("-")[0] in NOT_FAMILY:
        return None
    telling = family.endswith("i") or family in FAMILY or family[-1] == "y"
    if "\n" in gap and not family.endswith("i"):
        return None
    big = (text[start].isupper(), text[at].isupper())
    if big[0] != big[1] or (not big[0] and not telling):
        return None
    if not telling and (start == 0 or low[:start].rstrip()[-1:] in ".!?"):
        return None
    return start, family


def _family_behind(text: str, low: str, at: int, end: int) -> int | None:
    """End of the family name behind a given name from ``at`` to ``end``, if one stands there."""
    if (at and (low[at - 1].isalnum() or low[at - 1] in "_-")) or not text[at].isupper():
        return None
    m = _TITLE_AFTER.match(text, end)
    if m and m[1].lower() not in NOT_FAMILY and (m[1].isupper() == text[at:end].isupper() or len(m[1]) < 2):
        return m.end(1)
    return None


def names_in(text: str, last: frozenset[str], first: frozenset[str]) -> list[tuple[int, int]]:
    """Spans of a family and a given name of the given ones, in any case; ``last``: behind the family name, ``first``: before it."""
    text, place = _written_spaces(text)
    low = lower(text)
    behind, before = _name_machines(last, first)
    out = []
    for end, (name, forms) in behind.iter(low) if len(behind) else ():
        at = end - len(name) + (name[-1] in "ae") + 1
        m = forms.match(low, at) if at >= 3 and low[at - 1].isspace() else None
        found = _family_before(text, low, at) if m else None
        if found and found[1] not in last:
            out.append((found[0], m.end()))
    for end, (name, forms) in before.iter(low) if len(before) else ():
        at = end - len(name) + (name[-1] in "ae") + 1
        m = forms.match(low, at)
        stop = _family_behind(text, low, at, m.end()) if m else None
        if stop:
            out.append((at, stop))
    return out if place is None else [(place[a], place[b - 1] + 1) for a, b in out]


def _given_of(word: str) -> set[str]:
    """The given names that a word can be a cased form of."""
    out: set[str] = set()
    for cut in range(2, len(word) + 1):
        if _CASED.fullmatch(word, cut):
            out.add(word[:cut])
            if word[cut - 1] in "áé":
                out.add(word[: cut - 1] + _PLAIN[word[cut - 1]])
    return {w for w in out if w == word or w[-1] not in "ae" or _CASED.fullmatch(word, len(w))}


_TITLE_AFTER = re.compile(r"[ \t\u00a0]+(?:[A-ZА-ЯЁ]\.[ \t]*|von |van )?([A-ZÁÉÍÓÖŐÚÜŰÄА-ЯЁ][\w'-]*[^\W\d_])")


def pattern(text: str, start: int, end: int) -> str:
    """The words around a span, lower case: two before within 40 characters, one after within 25; the ends of a text are words too."""
    before = ["^", *_TOKEN.findall(text[max(0, start - 40) : start].lower())][-2:]
    after = [*_TOKEN.findall(text[end : end + 25].lower()), "$"][0]
    return f"{' '.join(before)} _ {after}"


def _base(df: DataFrame, keys: list[str], text: str) -> tuple[DataFrame, list[str], str]:
    names = [f"_k{i}" for i in range(len(keys))]
    base = df.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names, strict=True)], F.col(f"`{text}`").alias("_text"))
    types = dict(base.dtypes)
    return base, names, ", ".join(f"{n} {types[n]}" for n in names)


def instances(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys as _k0.., kind, head, start, stop, instance, pattern) of all mentions; names give one of each order, kinds ``last`` and ``first``."""
    base, names, schema = _base(df, keys, text)

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for given in batches:
            at, rows = [], []
            for i, t in enumerate(given.column("_text").to_pylist()):
                for kind, head, a, b, c in mentions(t):
                    at.append(i)
                    rows.append((kind, head, a, b, re.sub(r"\W", "", t[a:b].lower()), pattern(t, c, b)))
                for first, second, a, b in name_pairs(t):
                    around = pattern(t, a, b)
                    at += [i, i]
                    rows += [("last", second, a, b, first, around), ("first", first, a, b, second, around)]
            columns = [*zip(*rows, strict=True)] or [()] * 6
            pick = pa.array(at, pa.int64())
            arrays = [pa.array(c, k) for c, k in zip(columns, [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string()], strict=True)]
            yield pa.RecordBatch.from_arrays([*[given.column(n).take(pick) for n in names], *arrays], names=[*names, "kind", "head", "start", "stop", "instance", "pattern"])

    return base.filter("_text is not null").mapInArrow(run, schema + ", kind string, head string, start int, stop int, instance string, pattern string")


#: What a head needs to be accepted: different instances, patterns, and the share of the seeds' median score.
INSTANCES, PATTERNS, LEAST = 5, 3, 1 / 3


def discovered(found: DataFrame, rounds: int = 3, least: float = LEAST, seeds_of: dict[str, frozenset[str]] | None = None) -> DataFrame:
    """(kind, head, round): heads that are no seeds and score like them.

    Each round scores every pattern by its heads' weights (seeds and accepted heads 1, others what they had, 0 at first) over all its
    mentions, and every head by the mean of its patterns' scores, each without the head's own part, unless it is a seed. A head's weight
    is its score as a share of the median seed's; from ``least`` on it is accepted. All steps are aggregates and equi-joins over distinct (head, pattern)
    edges; only heads with enough instances and patterns take part in the joins, so a pattern meets at most one edge of each of these.
    """
    given = seeds_of or SEEDS
    is_seed = F.lit(False)
    for kind, heads in given.items():
        is_seed |= (F.col("kind") == kind) & F.col("head").isin(*heads)
    edges = written(found.groupBy("kind", "head", "pattern").agg(F.count("*").alias("n"), F.approx_count_distinct("instance").alias("i")), "edges")
    totals = edges.groupBy("kind", "pattern").agg(F.sum("n").alias("total"))
    able = found.groupBy("kind", "head").agg(F.approx_count_distinct("instance").alias("i"), F.approx_count_distinct("pattern").alias("p"))
    able = able.withColumn("seed", is_seed).filter(F.col("seed") | ((F.col("i") >= INSTANCES) & (F.col("p") >= PATTERNS))).select("kind", "head", "seed")
    links = written(edges.join(able, ["kind", "head"]).join(totals, ["kind", "pattern"]).select("kind", "head", "pattern", "n", "seed", "total"), "links")
    weights = links.select("kind", "head", "pattern", "n", "seed", "total", F.col("seed").cast("double").alias("weight"))
    accepted = None
    for r in range(1, rounds + 1):
        patterns = weights.groupBy("kind", "pattern").agg(F.sum(F.col("n") * F.col("weight")).alias("good"))
        mine = weights.join(patterns, ["kind", "pattern"])
        # two mentions that are none stand in every pattern, one in every head: what is seen once proves little
        own = F.when(F.col("seed"), F.lit(0.0)).otherwise(F.col("n") * F.col("weight"))
        part = (F.col("good") - own) / (F.col("total") + 2)
        scores = mine.groupBy("kind", "head").agg((F.sum(F.col("n") * F.coalesce(part, F.lit(0.0))) / (F.sum("n") + 1)).alias("score"), F.first("seed").alias("seed"))
        medians = scores.filter("seed and score > 0").groupBy("kind").agg(F.percentile_approx("score", 0.5).alias("median"))
        fresh = scores.join(medians, "kind", "left").select("kind", "head", "seed", F.when(F.col("seed"), 1.0).otherwise(F.least(F.lit(1.0), F.coalesce(F.col("score") / F.col("median"), F.lit(0.0)))).alias("weight"))
        fresh = written(fresh, "weights")
        now = fresh.filter(~F.col("seed") & (F.col("weight") >= least)).select("kind", "head", F.lit(r).alias("round"))
        accepted = now if accepted is None else accepted.unionByName(now)
        weights = links.join(fresh.select("kind", "head", "weight"), ["kind", "head"])
    last = fresh.filter(~F.col("seed") & (F.col("weight") >= least)).select("kind", "head")
    return accepted.groupBy("kind", "head").agg(F.min("round").alias("round")).join(last, ["kind", "head"], "left_semi")


#: Accepted heads that are sent to the tasks; beyond these, mentions are joined with them instead.
SENT = 200_000


def accepted_heads(found: DataFrame, **options: object) -> tuple[dict[str, frozenset[str]] | None, DataFrame]:
    """(heads by kind, seeds among them, or None if they are more than ``SENT``; the same as a table)."""
    fresh = written(discovered(found, **options).select("kind", "head"), "heads")
    spark = found.sparkSession
    known = spark.createDataFrame([(k, h) for k, hs in SEEDS.items() for h in sorted(hs)], "kind string, head string")
    table = known.unionByName(fresh)
    rows = table.limit(SENT + 1).collect()
    if len(rows) > SENT:
        return None, table
    heads: dict[str, set[str]] = {k: set() for k in SEEDS}
    for r in rows:
        heads[r["kind"]].add(r["head"])
    return {k: frozenset(v) for k, v in heads.items()}, table


def personal(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, kind, start, stop): every identifier found in ``text``, seeds and discovered ones.

    start and stop count characters from 0. Kinds: email, phone, id_number, address, name. Null and empty texts give no rows;
    repeated rows give repeated results; further columns of any name are ignored. Whole texts of any length are read.
    """
    found = written(instances(df, keys, text), "instances")
    heads, table = accepted_heads(found)
    names = [f"_k{i}" for i in range(len(keys))]
    plain = found.filter(~F.col("kind").isin("last", "first")).join(table, ["kind", "head"], "left_semi").select(*names, "kind", "start", "stop")
    both = plain.unionByName(_named(df, keys, text, heads, table))
    return both.select(*[F.col(n).alias(k) for n, k in zip(names, keys, strict=True)], "kind", "start", "stop")


def _named(df: DataFrame, keys: list[str], text: str, heads: dict[str, frozenset[str]] | None, table: DataFrame) -> DataFrame:
    """(_k0.., kind, start, stop) of the names in all texts, in any case."""
    base, names, schema = _base(df, keys, text)
    base = base.filter("_text is not null")

    def with_heads(batches):  # noqa: ANN001, ANN202
        for given in batches:
            yield _spans(given, names, [[("name", a, b) for a, b in names_in(t, heads["last"], heads["first"])] for t in given.column("_text").to_pylist()])

    def with_words(batches):  # noqa: ANN001, ANN202 - too many heads to send: each pair of words names the heads it would need
        import pyarrow as pa

        for given in batches:
            at, rows = [], []
            for i, t in enumerate(given.column("_text").to_pylist()):
                for row in pair_heads(t):
                    at.append(i)
                    rows.append(row)
            columns = [*zip(*rows, strict=True)] or [()] * 5
            arrays = [pa.array(c, k) for c, k in zip(columns, [pa.string()] * 3 + [pa.int32()] * 2, strict=True)]
            yield pa.RecordBatch.from_arrays([*[given.column(n).take(pa.array(at, pa.int64())) for n in names], *arrays], names=[*names, "kind", "head", "family", "start", "stop"])

    if heads is not None:
        return base.mapInArrow(with_heads, schema + ", kind string, start int, stop int")
    # also written without accents
    written_heads = table.unionByName(table.filter("kind in ('last', 'first')").withColumn("head", F.translate("head", "".join(_PLAIN), "".join(_PLAIN.values())))).distinct()
    given_names = table.filter("kind = 'last'").select(F.col("head").alias("family"))
    each = base.mapInArrow(with_words, schema + ", kind string, head string, family string, start int, stop int").join(written_heads, ["kind", "head"], "left_semi")
    return each.join(given_names, "family", "left_anti").select(*names, F.lit("name").alias("kind"), "start", "stop").distinct()


def pair_heads(text: str) -> Iterable[tuple[str, str, str, int, int]]:
    """(kind, head, family, start, end) for every pair of words that would be a name if the head were accepted and the family were no given name."""
    text, place = _written_spaces(text)
    low = lower(text)
    for m in re.finditer(rf"{_WORD}{{2,}}(?!\w)", low):
        at, end = m.span()
        if at and (low[at - 1].isalpha()):
            continue
        spans = []
        found = _family_before(text, low, at)
        if found:
            spans.append(("last", found[1], found[0], end))
        stop = _family_behind(text, low, at, end)
        if stop:
            spans.append(("first", "", at, stop))
        for kind, family, a, b in spans:
            for name in _given_of(m.group()):
                yield kind, name, family, a if place is None else place[a], b if place is None else place[b - 1] + 1


def _spans(given, names: list[str], spans: list[list[tuple[str, int, int]]]):  # noqa: ANN001, ANN202
    """A batch of (keys, kind, start, stop) from the spans of each row of ``given``."""
    import pyarrow as pa

    at = pa.array([i for i, s in enumerate(spans) for _ in s], pa.int64())
    flat = [x for s in spans for x in s]
    arrays = [pa.array([x[k] for x in flat], t) for k, t in enumerate((pa.string(), pa.int32(), pa.int32()))]
    return pa.RecordBatch.from_arrays([*[given.column(n).take(at) for n in names], *arrays], names=[*names, "kind", "start", "stop"])


# The placeholders.
PLACEHOLDERS = {"email": "[EMAIL]", "phone": "[TELEFON]", "id_number": "[AZONOSÍTÓ]", "address": "[CÍM]", "name": "[NÉV]"}


def redacted(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, redacted) for every row: ``text`` with each identifier replaced by the placeholder of its kind.

    Where spans overlap the one that begins first, or else the longer one, counts. The accepted heads are sent to the tasks, so texts are
    not shuffled; only if there are more than ``SENT`` of them the spans are joined to the texts by ``keys``, which then must name a row.
    """
    heads, _ = accepted_heads(written(instances(df, keys, text), "instances"))
    base, names, schema = _base(df, keys, text)
    spans_type = "array<struct<kind: string, start: int, stop: int>>"
    if heads is None:
        spans = personal(df, keys, text).toDF(*names, "kind", "start", "stop").groupBy(*names).agg(F.collect_list(F.struct("kind", "start", "stop")).alias("_spans"))
        base = base.join(spans, names, "left")
    else:
        base = base.withColumn("_spans", F.lit(None).cast(spans_type))

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for given in batches:
            out = []
            for t, own in zip(given.column("_text").to_pylist(), given.column("_spans").to_pylist(), strict=True):
                spans = [(s["start"], s["stop"], s["kind"]) for s in own or []] if heads is None else [(a, b, kind) for kind, a, b in (seeds(t, heads) if t else [])]
                out.append(replace(t, spans))
            yield pa.RecordBatch.from_arrays([*[given.column(n) for n in names], pa.array(out, pa.string())], names=[*names, "redacted"])

    return base.mapInArrow(run, schema + ", redacted string").toDF(*keys, "redacted")


def replace(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    """``text`` with the spans replaced."""
    if text is None:
        return None
    out, at = [], 0
    for start, stop, kind in sorted(spans, key=lambda s: (s[0], -s[1])):
        if start >= at:
            out += [text[at:start], PLACEHOLDERS[kind]]
            at = stop
        elif stop > at:  # the tail of an overlapping span belongs to an identifier too
            at = stop
    return "".join(out) + text[at:]
