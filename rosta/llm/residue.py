"""Records that hold what a template, a filler or an error or script notice left there instead of content.

Lines are normalised (case, digits, white space) and counted by host over all records; lines that recur without being evidence
themselves (numbers of incidents, links back, requests to try again, greetings of a board) are boilerplate and are subtracted. What is left of a
record is measured against four kinds of evidence: error pages, unfilled placeholders, filler text, and notices that scripts are
required. Evidence is told by the sentence: a thing and its failure, a script and the demand for it, a placeholder, none of
them in a question or among words with which people talk. A line that recurs but for its placeholders is a template's as a whole.
A record is residue if evidence covers most of what is left.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosta.session import written

# Folding of the letters of the sites' languages (others stay).
FOLD = [*zip("áéíóöőúüűäàâèêëîïôûçñ", "aeiooouuuaaaeeeiioucn", strict=True)]


# Words of notices by what they mean, folded, as patterns of whole words; a sentence with one of each of two classes is a notice.
THINGS = r"\b(?:pages?|urls?|sites?|website|resources?|files?|documents?|server|service|gateway|requests?|session|access|connection|database|permission|link|oldal|oldalt|oldalhoz|lap|szerver\w*|kiszolgalo\w*|szolgaltatas\w*|keres|kerese?t?|kereseket|kerelem|munkamenet\w*|hozzaferes\w*|jogosultsag\w*|kapcsolat|adatbazis|tartalom|seite|server\w*|dienst|anfragen?|sitzung|zugriff\w*|verbindung|datei|страниц\w*|сервер\w*|сервис\w*|запрос\w*|доступ\w*|сесси\w*|ссылк\w*|соединени\w*)\b"
FAILURES = r"\b(?:not (?:be )?found|cannot be (?:found|displayed)|does not exist|no longer (?:exists|available)|errors?|denied|refused|forbidden|unauthorized|unavailable|expired|timed out|time-?out|failed|bad gateway|bad request|too many|not available|nem talalhato|nem letezik|nem erheto el|nem elerheto|nem jelenitheto meg|hiba|hiba tortent|\w*hiba|megtagadva|tiltott|lejart|sikertelen|tul sok|nincs jogosultsag\w*|megszakadt|nicht gefunden|nicht erreichbar|nicht verfugbar|existiert nicht|\w*fehler|verweigert|abgelaufen|zu viele|fehlgeschlagen|не найден\w*|не существует|недоступ\w*|запрещ\w*|ошибк\w*|истек\w*|слишком много)\b"
SCRIPTS = r"\b(?:java ?script\w*|scripts?|cookies?|szkript\w*|sutik?\w*|скрипт\w*|куки)\b"
DEMANDS = r"\b(?:enable|activate|allow|turn (?:it |them )?on|switch on|requires?|required|needs?|disabled|turned off|must be|not support\w*|engedelyez\w*|kapcsolja be|bekapcsol\w*|szukseges|tamogat\w*|letiltva|kikapcsolva|aktivier\w*|einschalten|erforderlich|benotigt|deaktiviert|unterstutzt|включит\w*|разрешите|требу\w*|отключ\w*)\b"
SLOTS = r"\b(?:here|ide|helye|hier|сюда|здесь)\b"
FILLS = r"\b(?:type|enter|insert|write|put|goes|comes|ird|irja|irjon|kerul|jon|illessze|gepelje|eingeben|einfugen|steht|schreiben|введите|вставьте|напишите)\b"
PARTS = r"\b(?:text|titles?|content|description|headline|message|szoveg\w*|cim|cime|cimet|leiras\w*|tartalom|tartalmat|bevezeto|kep|uzenet\w*|hozzaszolas\w*|titel|inhalt|beschreibung|uberschrift|текст|заголовок|описание)\b"
CLICKS, EDITS = r"\b(?:click|tap|double-click|kattints\w*|kattintson|klicken|нажмите)\b", r"\b(?:edit|add|change|szerkeszt\w*|hozzaad\w*|modosit\w*|bearbeiten|hinzufugen|изменить|редактир\w*)\b"
PAIRS = ((THINGS, FAILURES), (SCRIPTS, DEMANDS), (FILLS, PARTS), (CLICKS, EDITS))
# Words with which people talk about such things; no notice has them.
TALK = r"\b(?:en|nekem|nalam|nalunk|neked|nalad|szerintem|kaptam|kapok|kapom|irta|irja ki|mondta|jott|adott|adta|kerdes\w*|miert|hogyan|hogy kell|mire|melyik\w*|mit|mi a|valaki|valakinek|tudja|tudtok|tudom|aztan|percig|oraig|ma|tegnap|reggel|este|ota|regebben|sajnos|koszi|koszonom a|nevettunk|lattam|probaltam|megoldas\w*|amikor|mindig|neha|ha nekem|haver|szomszed\w*|i|i'm|my|me|we|our|got|why|how|what|when|yesterday|today|anyone|someone|solved|fixed|ich|mein\w*|mir|wir|warum|wie|wann|gestern|heute|jemand|я|мне|меня|мой|мы|почему|как|что|вчера|сегодня|кто)\b"
# Evidence within a sentence, each with the stems of which one stands in each of its matches.
MARKS = (
    (r"traceback \(most recent call last\):?", "traceback"),
    (r"file \"[^\"\n]+\", line \d+(?:, in \S+)?", "file \""),
    (r"\b[a-z]+(?:error|exception)(?: in thread)?: [^\n]*", "error:|exception"),
    (r"(?:warning|notice|fatal error|parse error|deprecated): [^\n]+ in \S+ on line \d+", "on line"),
    (r"sqlstate\[?\w*\]?:?[^\n]*", "sqlstate"),
    (r"\[object object\]", "[object"),
    (r"(?<![\w-])(?:undefined|null|nan)(?![\w-])", "undefined|null|nan"),
    (r"(?:\b(?:lorem|ipsum|dolor|sit|amet|consectetur|consectetuer|adipiscing|elit|sed|do|eiusmod|tempor|incididunt|ut|labore|et|dolore|magna|aliqua|enim|ad|minim|veniam|quis|nostrud|exercitation|ullamco|laboris|nisi|aliquip|ex|ea|commodo|consequat)\b[\s,.]*){3,}", "lorem|ipsum|dolor|amet|consecte|adipisc|eiusmod|incididunt|magna|veniam|nostrud|ullamco|aliquip"),
    (r"\b(?:lorem ipsum|consectetur|adipiscing elit)\b", "lorem|consectetur|adipiscing"),
    (r"\b(?:placeholder|sample|dummy|blind|filler|minta|teszt|proba|helykitolto|beispiel|platzhalter)[ -]?(?:text|szoveg\w*)\b(?: here)?", "text|szoveg"),
    (r"\b(?:your|the|a|ide|ihr) (?:\w+ )?(?:text|title|szoveg|cim|szovege)\w* (?:here|goes here|helye|jon|kerul|hier)\b|\b(?:cim|szoveg|kep|leiras|tartalom|bevezeto) helye\b|\bszoveg (?:jon|kerul) ide\b|\bplaceholder\b", "here| helye|jon|kerul| hier|placeholder"),
    (r"\bx{3,}\b", "xxx"),
    (r"(?:\bteszt\b[\s\d.,]*){2,}|(?:\btest\b[\s\d.,]*){3,}", "teszt|test"),
    (r"\b(?:todo|tbd|fixme):? ?[^\n]*(?:szoveg|text|potlas|cim|title|leiras|content)\w*|\b(?:todo|tbd|fixme):?\s*$", "todo|tbd|fixme"),
    (r"\b(?:coming soon|under construction|feltoltes alatt|szerkesztes alatt|hamarosan)\b", "coming soon|under construction| alatt|hamarosan"),
    (r"(?:asdf){1,}(?:ghjk?l?)?|qwertz\w*|qwerty\w*", "asdf|qwert"),
)
# Fixed value: a status code with the words around it; it counts only beside other evidence or behind such a word.
STATUS = r"\b(?:http|error|hiba|status|fehler|ошибка)[\s:]{1,2}[45]\d\d\b(?!-)|(?:^|(?<=\())\s*[45]\d\d(?=\s*(?:[-–—:.)]|$| [a-zа-я]))(?!-)"
PLACEHOLDER = r"\{\{[^{}\n]{0,40}\}\}|[$#]\{[^{}\n]{0,40}\}|@@[\w. ]{1,40}@@|<%=?[^<>%\n]{0,40}%>|\{%[^{}%\n]{0,60}%\}|(?<![\w%])%[a-z][\w.]{1,30}%(?!\w)|#?\[\[[^\[\]\n]{1,40}\]\]|#\[[\w.]{1,40}\]|(?<![\w\[])\[[a-z_][\w.]{1,30}\](?!\()|(?<![\w{])\{[a-z_][\w.]{1,30}\}|__[a-z][a-z_]{1,30}__"
# Tags in square brackets that people write.
TAGS = r"\[(?:elado|kerek|keresek|vennek|vetel|csere|ingyen|elkelt|megoldva|megoldas|off|ot|on|fixed|solved|link|kep|video|idezet|quote|url|img|b|i|u|code|spoiler|sic|unk|cls|sep|mask|pad)\]"
_MARKS = [re.compile(p, re.M) for p, _ in MARKS]
_PAIRS = [(re.compile(x), re.compile(y)) for x, y in PAIRS]
_TALK = re.compile(TALK)
_STATUS = re.compile(STATUS, re.M)
_PLACEHOLDER = re.compile(PLACEHOLDER)
_TAGS = re.compile(TAGS)
_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"[^.!?\n…]*(?:[.…](?=\S)[^.!?\n…]*)*[.!?…]*\n?")
#: Most words of a sentence that can be a notice as a whole; a longer one is an account of something.
NOTICE = 24

# One of these stands in every placeholder, and in every status code that counts alone.
SLOT_STEMS = ("{{", "${", "#{", "@@", "<%", "{%", "[", "{", "__", *[f"%{c}" for c in "abcdefghijklmnopqrstuvwxyz"])
STATUS_STEMS = tuple(f"{w}{c}{d}" for w in ("http", "error", "hiba", "status", "fehler", "ошибка") for c in (" ", ":", ": ") for d in "45")


def fold(text: str) -> str:
    """Lower case without the accents of the sites' languages, runs of spaces of any kind as one space."""
    text = text.lower()
    if not text.isascii():
        for letter, plain in FOLD:
            if letter in text:
                text = text.replace(letter, plain)
        text = text.replace("\u00a0", " ")
    if "&nbsp;" in text:
        text = text.replace("&nbsp;", " ")
    while "  " in text:
        text = text.replace("  ", " ")
    return text


# Stems of which one stands in each match of the first or the second of two classes; a text without any of them holds no notice.
PAIR_STEMS = (
    "not found|not be found|cannot be|exist|no longer|error|denied|refused|forbidden|unauthorized|unavailable|expired|time|failed|bad |too many|not available|talalhato|letezik|erheto|jelenitheto|hiba|megtagad|tiltott|lejart|sikertelen|tul sok|jogosultsag|megszakadt|gefunden|erreichbar|verfugbar|fehler|verweigert|abgelaufen|zu viele|fehlgeschlagen|найден|существует|недоступ|запрещ|ошибк|истек|слишком",
    "script|cookie|szkript|suti|скрипт|куки",
    "type|enter|insert|write|put|goes|comes|ird|irja|irjon|kerul|jon|illessze|gepelje|einge|einf|steht|schreib|введите|вставьте|напишите",
    "click|tap|kattint|klicken|нажмите",
)


@lru_cache(1)
def _stems():  # noqa: ANN202
    """Automaton of all stems; each has the numbers of what to try: marks from 0, -1 placeholders, -2 status, -10 and below pairs of classes."""
    import ahocorasick

    numbers: dict[str, set[int]] = {}
    for i, (_, stems) in enumerate(MARKS):
        for stem in stems.split("|"):
            numbers.setdefault(stem, set()).add(i)
    for i, stems in enumerate(PAIR_STEMS):
        for stem in stems.split("|"):
            numbers.setdefault(stem, set()).add(-10 - i)
    for stem in SLOT_STEMS:
        numbers.setdefault(stem, set()).add(-1)
    for stem in STATUS_STEMS:
        numbers.setdefault(stem, set()).add(-2)
    machine = ahocorasick.Automaton()
    for stem, of in numbers.items():
        machine.add_word(stem, frozenset(of))
    machine.make_automaton()
    return machine


def _tries(line: str) -> set[int]:
    out: set[int] = set()
    for _, numbers in _stems().iter(line):
        out |= numbers
    return out


def _spans(line: str, tries: set[int]) -> list[tuple[int, int]]:
    """Places of evidence in a folded line or text."""
    spans = [m.span() for i in tries if i >= 0 for m in _MARKS[i].finditer(line) if m.end() > m.start()]
    tags = {m.start() for m in _TAGS.finditer(line)} if -1 in tries else set()
    slots = [m.span() for m in _PLACEHOLDER.finditer(line) if m.start() not in tags and m.start() + 1 not in tags] if -1 in tries else []
    pairs = [pair for pair in (_PAIRS[-10 - i] for i in tries if i <= -10) if pair[1].search(line) and pair[0].search(line)]
    whole: list[tuple[int, int]] = []
    if slots or pairs:
        for m in _SENTENCE.finditer(line):
            a, b = m.span()
            if a == b:
                continue
            sentence = m.group()
            notice = any(a <= x < b for x, _ in slots) or any(p.search(sentence) and q.search(sentence) for p, q in pairs)
            if notice and len(_WORD.findall(sentence)) <= NOTICE and not sentence.rstrip().endswith("?") and not _TALK.search(sentence):
                whole.append((a, b))
    spans += slots + whole
    if spans or -2 in tries:
        spans += [m.span() for m in _STATUS.finditer(line)]
    return spans


def coverage(line: str) -> tuple[int, int]:
    """(characters of words within evidence, characters of all words) of a folded line or text."""
    tries = _tries(line)
    words = [m.span() for m in _WORD.finditer(line)]
    total = sum(b - a for a, b in words)
    spans = _spans(line, tries) if tries else []
    if not spans:
        return 0, total
    if not total:
        return 1, 1
    inside = bytearray(len(line))
    for a, b in spans:
        inside[a:b] = b"\1" * (b - a)
    return sum(b - a for a, b in words if inside[a]), total


def template(line: str) -> str | None:
    """Normalised form of a folded line that holds a placeholder, any of which is the same; None for lines without one and for talk."""
    tags = {m.start() for m in _TAGS.finditer(line)}
    found = [m.span() for m in _PLACEHOLDER.finditer(line) if m.start() not in tags and m.start() + 1 not in tags]
    if not found or line.rstrip().endswith("?") or _TALK.search(line):
        return None
    out, at = [], 0
    for a, b in found:
        out += [line[at:a], "\0"]
        at = b
    return " ".join(("".join(out) + line[at:]).split()).translate(_ZEROS)


_ZEROS = str.maketrans("123456789", "000000000")


def line_hash(line: Column) -> Column:
    """Hash of a normalised line: no case, digits as 0, white space as one space."""
    return F.xxhash64(F.translate(F.lower(F.trim(F.regexp_replace(line, r"[ \t\r ]+", " "))), "123456789", "000000000"))


def residue(df: DataFrame, keys: list[str], host: str, text: str, least: float = 0.6, often: int = 5, share: float = 1e-5) -> DataFrame:
    """``keys`` of the rows whose text is residue.

    least: share of the remaining words' characters that evidence must cover. often, share: a line is boilerplate of its host if
    it stands in at least ``often`` of the host's records, or of the software of several if it stands in three times as many records, and in
    that share of the host's (of all) records, unless evidence covers it. Null, empty and blank texts are no residue. Rows with equal keys are judged
    together; further columns of any name are ignored. Only lines of rows with evidence are looked up, so only these are counted and shuffled.
    """
    base = df.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], F.coalesce(F.col(f"`{host}`"), F.lit("")).alias("_host"), F.col(f"`{text}`").alias("_text")).filter("_text is not null")
    names = [f"_k{i}" for i in range(len(keys))]
    types = dict(base.dtypes)

    def judge(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for given in batches:
            texts = given.column("_text").to_pylist()
            at, lines, inside, total, slots = [], [], [], [], []
            for i, raw in enumerate(texts):
                low = fold(raw)
                tries = _tries(low)
                if not tries or not _spans(low, tries):
                    continue
                measured = [(line, *coverage(fold(line))) for line in raw.split("\n") if line.strip()]
                if any(c for _, c, _ in measured):
                    for line, c, t in measured:
                        at.append(i)
                        lines.append(line)
                        inside.append(c)
                        total.append(t)
                        slots.append(template(fold(line)) if 0 < c < t else None)
            pick = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([*[given.column(n).take(pick) for n in (*names, "_host")], pa.array(lines, pa.string()), pa.array(inside, pa.int32()), pa.array(total, pa.int32()), pa.array(slots, pa.string())], names=[*names, "_host", "_line", "_inside", "_total", "_slot"])

    schema = ", ".join(f"{n} {types[n]}" for n in (*names, "_host")) + ", _line string, _inside int, _total int, _slot string"
    found = written(base.mapInArrow(judge, schema).withColumn("_hash", line_hash(F.col("_line"))).withColumn("_slot", F.when(F.col("_slot").isNotNull(), F.xxhash64("_slot"))).drop("_line"), "evidence")
    # of all records' lines only those that could be subtracted from a row with evidence
    wanted = found.filter(F.col("_inside") < least * F.col("_total")).select("_hash").distinct()
    lines = base.select("_host", F.explode(F.array_distinct(F.transform(F.filter(F.split("_text", "\n"), lambda x: F.length(F.trim(x)) > 0), line_hash))).alias("_hash"))
    counts = lines.join(wanted, "_hash", "left_semi").groupBy("_host", "_hash").agg(F.count("*").alias("_n"))
    records = base.groupBy("_host").agg(F.count("*").alias("_records"))
    everything = base.count()

    def recurrent(counts: DataFrame, key: str, mark: str) -> DataFrame:
        """(_host, key, mark) of what recurs at its host or at all of them."""
        everywhere = counts.groupBy(key).agg(F.sum("_n").alias("_all"))
        rate = counts.join(records, "_host").join(everywhere, key)
        at_host = (F.col("_n") >= often) & (F.col("_n") >= share * F.col("_records"))
        at_all = (F.col("_all") >= 3 * often) & (F.col("_all") >= share * everything)
        return rate.filter(at_host | at_all).select("_host", key, F.lit(True).alias(mark))

    # a line with a placeholder that recurs with others in its place is a template's own, all of it
    slots = recurrent(found.filter("_slot is not null").groupBy("_host", "_slot").agg(F.count("*").alias("_n")), "_slot", "_template")
    found = found.join(slots, ["_host", "_slot"], "left").withColumn("_inside", F.when(F.col("_template"), F.col("_total")).otherwise(F.col("_inside")))
    left = found.join(recurrent(counts, "_hash", "_common"), ["_host", "_hash"], "left").filter(F.col("_common").isNull() | (F.col("_inside") >= least * F.col("_total")))
    measured = left.groupBy(*names).agg(F.sum("_inside").alias("_inside"), F.sum("_total").alias("_total"))
    out = measured.filter((F.col("_inside") > 0) & (F.col("_inside") >= least * F.col("_total")))
    return out.select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)])
