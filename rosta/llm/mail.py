"""Emails reduced to what their sender newly wrote.

Each line of a body gets one label by a linear-chain model: scores of each label for the line's own features (prefix,
punctuation, wording, length) and those of its neighbours and place, plus scores of moving from one line's label to the
next; the best labelling of the whole body is found by dynamic programming. The scores are fixed values, as there are no
labelled emails to fit them on.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABELS = ("new", "quoted", "intro", "forwarded", "signature", "notice")
NEW, QUOTED, INTRO, FORWARDED, SIGNATURE, NOTICE = range(6)

# Scores of moving from the label of a line (row) to that of the next line that is not blank (column), for
# lines of one paragraph and for lines with a blank one between them.
_NO = -30.0
WITHIN = [
    #  new  quoted intro forwarded signature notice
    [1.0, 0.0, -1.0, -4.0, -2.5, -3.0],  # new
    [0.0, 1.0, -1.0, -4.0, -3.0, -3.0],  # quoted
    [-3.0, 2.0, 1.0, -6.0, -6.0, -6.0],  # intro
    [_NO, 0.0, -2.0, 1.0, _NO, -1.0],  # forwarded
    [-6.0, 0.0, -1.0, -1.0, 1.0, -1.0],  # signature
    [-6.0, -1.0, -1.0, -1.0, -2.0, 1.0],  # notice
]
ACROSS = [
    [0.5, 0.0, -0.5, -2.0, -1.0, -1.5],
    [0.5, 0.5, -0.5, -2.0, -1.0, -1.5],
    [-3.0, 1.0, -1.0, -6.0, -6.0, -6.0],
    [_NO, 0.0, -2.0, 0.5, _NO, 0.0],
    [-5.0, -0.5, 0.0, 0.0, 0.5, 0.0],
    [-5.0, -0.5, 0.0, 0.0, -1.0, 0.5],
]
FIRST = [0.5, -0.5, -0.5, -3.0, -2.5, -2.5]
#: What new text is preferred by to forwarded text: a forwarded message begins at its mark and not before it, however long it is.
FIRST_MARK = 1e-7

# Words of closing formulas, of the lines that introduce earlier messages, of their headers, of devices'
# signatures and of notices, in Hungarian, English, German and Russian.
CLOSINGS = r"(?:(?:sok |baráti |szívélyes |szíves )?üdv(?:özlettel|özlet)?|tisztelettel|köszönettel|kösz(?:i|önöm)?|előre is köszönöm|sziasztok|szia|szép (?:napot|estét)|további szép napot|minden jót|puszi|pusza|ölel|hello|(?:best|kind|warm|with best) ?(?:regards|wishes)|regards|best|cheers|thanks|many thanks|thank you|sincerely|yours(?: sincerely)?|mit (?:freundlichen|besten|herzlichen) gr(?:ü|ue)(?:ß|ss)en|(?:viele|liebe|beste|schöne) grüße|(?:schönen )?gruß|mfg|lg|danke|с уважением|всего доброго|спасибо)"
HEADERS = r"(?:from|sent|to|cc|subject|date|reply-to|feladó|küldte|küldve|elküldve|címzett|másolat|tárgy|dátum|von|gesendet|an|betreff|datum|от|отправлено|кому|тема|дата)"
NOTICE_WORDS = (
    "bizalmas", "kizárólag a címzett", "címzettnek szól", "tévedésből kapta", "értesítse a feladót", "nem minősül", "felelősséget nem vállal", "feladó munkáltatója",
    "nyomtatás előtt", "a környezetre", "vírusmentes", "károkért azonban", "adatkezelési tájékoztató", "leiratkoz", "levelezőlista", "unsubscribe", "mailing list",
    "vertraulich", "der empfänger", "löschen sie", "informieren sie den absender", "confidential", "privileged", "disclosure", "dissemination", "intended recipient", "intended only", "intended solely", "unauthori", "is prohibited",
    "strictly prohibited", "received this", "by mistake", "in error", "consider the environment", "virus", "disclaimer", "addressee", "конфиденциальн", "получател", "abmelden", "abbestellen", "listinfo",
)
DEVICES = r"(?:(?:küldve|elküldve) (?:az? )?(?:\S+ ){0,3}\S*(?:mobilo|telefono|táblag|iphone|ipad|android|készülék)\S*|sent (?:from|via|with) (?:my|the)? ?.{2,40}|von mei\S+ .{2,40} gesendet|gesendet (?:von|mit) .{2,40}|отправлено с .{2,40}|get outlook for .{2,20})"

_CLOSING = re.compile(rf"^\s*{CLOSINGS}\s*[,.:!–-]*\s*$", re.I)
_PREFIX = re.compile(r"^\s{0,3}(?:[>|]\s?)")
_ANGLE = re.compile(r"^\s{0,3}>")
_DELIMITER = re.compile(r"^\s*(?:--\s?|—|={3,}|\*{3,}|-{3,}|_{3,}|~{3,})\s*$")
_RULE_TITLE = re.compile(r"^\s*-{2,}\s*\S.{2,60}?\s*-{2,}\s*$")
_MESSAGE = re.compile(r"üzenet|levél|message|mail|nachricht|сообщение", re.I)
_HEADER = re.compile(rf"^\s*\*?{HEADERS}\s?\*?\s*:\s*\*?\s*\S", re.I)
_WROTE = re.compile(r"(?:\b(?:írta|wrote|schrieb|writes|пишет|написал\(?а?\)?)\b.{0,60}:\s*$)|^\s*(?:idézet|quote|zitat|цитата)\b.{0,60}:\s*$|\bezt írta\b", re.I)
_WROTE_END = re.compile(r"(?:\b(?:írta|wrote|schrieb|пишет)\b[^.!?]{0,20}:|\d{1,2}:\d{2}(?::\d{2})?\)?\s*:)\s*$", re.I)
_INTRO_HEAD = re.compile(r"^\s*(?:on\s+\S.*\d|am\s+\S.*\d|\d{4}[-.].{0,40}|.{3,60}<\S+@\S+>|.*\bezt írta\b)", re.I)
_DEVICE = re.compile(rf"^\s*{DEVICES}\s*\.?\s*$", re.I)
_NOTICE = re.compile("|".join(map(re.escape, NOTICE_WORDS)), re.I)
_LINK = re.compile(r"^\s*<?(?:https?://|www\.)\S+>?\s*$", re.I)
_NAME = re.compile(r"^\s*(?:(?:dr|ifj|id|özv|prof|ing)\.?\s+)?[^\W\d_a-záéíóöőúüűäß][\w.'-]*(?:\s+[^\W\d_a-záéíóöőúüűäß][\w.'-]*){0,3}\s*(?:\(\S{1,20}\))?\s*$")
_CONTACT = re.compile(r"\S+@\S+\.\S+|^\s*(?:tel|mob|mobil|phone|fax|t|m|e-mail|email|cím|web)\.?\s*:|^\s*[+(]?[\do][\d\s()/. -]{6,}$|^\s*\d{4}\s+\w+,|^\s*[\"„].{3,80}[\"”]\s*$", re.I)
_SENTENCE = re.compile(r"[^\W\d_]{2,}[.!?…]+\s*$")
# one quick test decides whether a line has any feature at all
_ANY = re.compile(rf"^\s*[>|]|^\s*[-=*_~—]|:\s*$|^\s*\*?{HEADERS}\s?\*?\s*:|@|https?://|^.{{0,34}}$|[+(]?\d[\d\s()/.-]{{7,}}$|^\s*(?:on|am)\s|{'|'.join(map(re.escape, NOTICE_WORDS))}|{DEVICES}|\bírta\b|időpont", re.I)


def _scores(lines: list[str], i: int, near: list[int], place: int) -> list[float] | None:
    """Scores of the labels for line i by its own features and those of its neighbours; None if it has none."""
    line = lines[i]
    if not _ANY.search(line):
        return None
    sentence = len(line) > 45 or _SENTENCE.search(line) is not None
    s = [0.5, -6.0, -4.0, 0.5 - FIRST_MARK, -2.5 if sentence else -0.5, -3.0]
    after = lines[near[place + 1]] if place + 1 < len(near) else ""
    joined_after = place + 1 < len(near) and near[place + 1] == i + 1
    before = lines[near[place - 1]] if place else ""
    if _ANGLE.match(line):
        s[QUOTED] += 13
        s[NEW] -= 3
    elif _PREFIX.match(line):
        s[QUOTED] += 10
        s[NEW] -= 2
    if _WROTE.search(line) or (_WROTE_END.search(line) and _INTRO_HEAD.match(before)):
        s[INTRO] += 8
    elif joined_after and _WROTE_END.search(after) and _INTRO_HEAD.match(line):
        s[INTRO] += 8
    rule = bool(_DELIMITER.match(line))
    if _RULE_TITLE.match(line) and _MESSAGE.search(line):
        s[FORWARDED] += 9
    if _HEADER.match(line) and (_HEADER.match(after) or _HEADER.match(before) or _MESSAGE.search(before)):
        s[FORWARDED] += 8
    if rule:
        s[NEW] -= 2
        s[SIGNATURE] += 2
        if _HEADER.match(after):
            s[FORWARDED] += 9
        elif _NOTICE.search(after) or _LINK.match(after):
            s[NOTICE] += 8
        elif len(line.strip()) <= 3 or len(after) < 45:
            s[SIGNATURE] += 4
    if _CLOSING.match(line):
        follows = not after or _NAME.match(after) or _DELIMITER.match(after) or _CONTACT.search(after)
        s[SIGNATURE] += 6 if follows and place else 1
    if _DEVICE.match(line):
        s[SIGNATURE] += 8
    if _NOTICE.search(line):
        s[NOTICE] += 7
    elif _LINK.match(line) and _NOTICE.search(before):
        s[NOTICE] += 6
    if _NAME.match(line) and len(line) < 40:
        s[SIGNATURE] += 2
    if _CONTACT.search(line) and len(line) < 60:
        s[SIGNATURE] += 2
    return s


def label_lines(text: str) -> list[tuple[int, int]]:
    """(1-based line number, label) of every line that is not blank."""
    lines = [(line[:-1] if line.endswith("\r") else line).replace("&nbsp;", " ").replace("\u00a0", " ") for line in text.split("\n")]
    near = [i for i, line in enumerate(lines) if line.strip()]
    scores = [_scores(lines, i, near, k) for k, i in enumerate(near)]
    if not any(scores):
        return [(i + 1, NEW) for i in near]
    plain = (1.0, -6.0, -4.0, 1.0 - FIRST_MARK, -3.0, -3.0)
    n = len(LABELS)
    total = [a + b for a, b in zip(FIRST, scores[0] or plain, strict=True)]
    back: list[list[int]] = []
    for k in range(1, len(near)):
        move = WITHIN if near[k] == near[k - 1] + 1 else ACROSS
        own = scores[k] or plain
        now, came = [], []
        for j in range(n):
            best, at = total[0] + move[0][j], 0
            for f in range(1, n):
                v = total[f] + move[f][j]
                if v > best:
                    best, at = v, f
            now.append(best + own[j])
            came.append(at)
        total = now
        back.append(came)
    at = total.index(max(total))
    out = [at]
    for came in reversed(back):
        at = came[at]
        out.append(at)
    return [(i + 1, label) for i, label in zip(near, reversed(out), strict=True)]


def mail_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no, label) for every line of each body that is not blank; labels as in ``LABELS``.

    Lines end with LF or CR LF and are numbered from 1, blank ones included. A null, empty or blank body gives no rows.
    Repeated rows give repeated results; further columns of any name are ignored. Bodies of any length are labelled whole.
    """

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for given in batches:
            keys, numbers, labels = [], [], []
            for k, body in zip(given.column(0).to_pylist(), given.column(1).to_pylist(), strict=True):
                if body:
                    rows = label_lines(body)
                    keys += [k] * len(rows)
                    numbers += [r[0] for r in rows]
                    labels += [LABELS[r[1]] for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array(keys, given.column(0).type), pa.array(numbers, pa.int32()), pa.array(labels, pa.string())], names=["_key", "line_no", "label"])

    kind = dict(df.dtypes)[key]
    out = df.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).mapInArrow(run, f"_key {kind}, line_no int, label string")
    return out.toDF(key, "line_no", "label")


def new_text(text: str | None) -> str | None:
    """The newly written lines of a body; null stays null."""
    if text is None:
        return None
    lines = text.replace("\r\n", "\n").split("\n")
    drop = {number for number, label in label_lines(text) if label != NEW}
    kept = "\n".join(line for i, line in enumerate(lines, 1) if i not in drop)
    return re.sub(r"\n{3,}", "\n\n", kept).strip("\n")


def reduced(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, new_text) for every row: the body without quotes, signatures and notices."""

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for given in batches:
            yield pa.RecordBatch.from_arrays([given.column(0), pa.array([new_text(t) for t in given.column(1).to_pylist()], pa.string())], names=["_key", "_new"])

    kind = dict(df.dtypes)[key]
    out = df.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).mapInArrow(run, f"_key {kind}, _new string")
    return out.toDF(key, "new_text")
