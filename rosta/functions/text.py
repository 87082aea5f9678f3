"""Scalar functions on text, as columns of built-in expressions; each maps null to null unless it says otherwise."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed value: what counts as white space, as a character class that Java and RE2 read alike.
SPACE_CHARS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SPACES, WORD = f"[{SPACE_CHARS}]+", f"[^{SPACE_CHARS}]+"
ENDS = f"^[{SPACE_CHARS}]+|[{SPACE_CHARS}]+$"


def strip(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(text, f"(?s){ENDS}".replace("$", r"\z"), "")


def clean_text(text: Column, around_breaks: str = "") -> Column:
    """Carriage returns leave, no-break spaces become spaces, runs of blanks one space, three line feeds and more two; stripped.

    around_breaks: "after" also trims blanks after a line feed, "both" those before it, too. Null gives the empty text.
    """
    out = F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), " \r", " "), r"[ \t]+", " ")
    if around_breaks:
        out = F.regexp_replace(out, r"\n[ \t]+", "\n")
    if around_breaks == "both":
        out = F.regexp_replace(out, r"[ \t]+\n", "\n")
    return strip(F.regexp_replace(out, r"\n{3,}", "\n\n"))


def clean_multiline(text: Column) -> Column:
    """Every line cleaned, empty ones dropped."""
    lines = F.transform(F.split(F.regexp_replace(F.coalesce(text, F.lit("")), "\r", ""), "\n"), lambda x: strip(F.regexp_replace(F.translate(x, " ", " "), r"[ \t]+", " ")))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def one_line(text: Column) -> Column:
    """Runs of white space as one space, stripped."""
    return strip(F.regexp_replace(text, SPACES, " "))


def words(text: Column) -> Column:
    """Runs of visible characters as an array."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def count_words(text: Column) -> Column:
    """Number of runs of visible characters."""
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def preview(text: Column, most: int = 120) -> Column:
    """At most ``most`` characters; a longer text is cut, its end stripped, and three dots added."""
    cut = F.regexp_replace(F.substring(text, 1, most - 3), f"(?s)[{SPACE_CHARS}]+\\z", "")
    return F.when(F.length(text) <= most, text).otherwise(F.concat(cut, F.lit("...")))


def first_integer(text: Column, signed: bool = True) -> Column:
    """The first integer after dots and spaces left the whole text; null without one or beyond 64 bits."""
    return F.regexp_substr(F.translate(text, ". ", ""), F.lit("-?[0-9]+" if signed else "[0-9]+")).try_cast("bigint")


def last_integer(text: Column) -> Column:
    """The last run of digits."""
    return F.try_element_at(F.regexp_extract_all(text, F.lit("[0-9]+"), F.lit(0)), F.lit(-1)).try_cast("bigint")


def split_name(name: Column) -> Column:
    """struct(name, family, given): two words and more are a family name and given names, one is a name; none is the name ''."""
    parts = F.filter(F.split(F.coalesce(name, F.lit("")), SPACES), lambda x: x != "")
    several = F.size(parts) >= 2
    return F.struct(
        F.when(~several, F.coalesce(F.try_element_at(parts, F.lit(1)), F.lit(""))).alias("name"),
        F.when(several, F.try_element_at(parts, F.lit(1))).alias("family"),
        F.when(several, F.array_join(F.slice(parts, 2, 1_000_000), " ")).alias("given"),
    )


def without_rating(seller: Column) -> Column:
    """A seller without a number in brackets at the end."""
    return strip(F.regexp_replace(seller, r"\s*\([0-9]+\)\s*$", ""))


def html_head(page: Column) -> Column:
    """The head element of a page, null without one."""
    return F.regexp_substr(page, F.lit(r"(?is)<head\b[^>]*>.*?</head>"))


def quote_line(line: Column) -> Column:
    """Whether a line quotes someone: ``... írta:`` at either end, ``>``, ``[quote]`` before or ``[/quote]`` behind; blank lines do not."""
    shown = clean_text(line)
    return F.lower(shown).rlike(r"(?s)^(?:írta:|>|\[quote\])|(?:írta:|\[/quote\])\z")


def without_quote_lines(text: Column) -> Column:
    """Leading lines that are blank or quote someone dropped; quote marks and white space trimmed at both ends."""
    lines = F.transform(F.split(text, "\n"), lambda x: clean_text(x))
    first = F.array_position(F.transform(lines, lambda x: ~quote_line(x) & (x != "")), True)
    kept = F.when(first > 0, F.array_join(F.slice(lines, F.greatest(first, F.lit(1)).cast("int"), F.size(lines)), "\n")).otherwise(F.lit(""))
    return F.regexp_replace(kept, "(?s)^[\\s'\"„”«»]+|[\\s'\"„”«»]+\\z", "")


# The forms of reply headers, each with the numbers of its groups for author, parent and number (0: none).
REPLIES = (
    (r"(?i)^\s*(.+?)\s+válasza\s+(.+?)\s+hozzászólására(?:\s*\(?#?(\d+)\)?)?", 1, 2, 3),
    (r"(?i)^\s*([^(]*?)\s*\(.*?válaszként erre:\s*(\d+)\.?\s*-\s*(.+?)\)\s*$", 1, 3, 2),
    (r"(?i)^\s*Válasz\s+(.+?)\s+#(\d+)\.\s*hozzászólására\s*$", 0, 1, 2),
    (r"(?i)(?:^|\W)Előzmény\s+(.+?)\s*$", 0, 1, 0),
    (r"(?i)^\s*#\d+\s+(.+?)\s*>\s*(.+?)\s*#(\d+)", 1, 2, 3),
)


def reply_header(text: Column) -> Column:
    """struct(author, parent, number) of a reply header; nulls where it has none.

    Forms: ``A válasza B hozzászólására (#n)``, ``A (válaszként erre: n. - B)``, ``Válasz B #n. hozzászólására``, ``Előzmény B`` and
    ``#k A > B #n``. The first form that matches counts.
    """
    out = {"author": None, "parent": None, "number": None}
    for pattern, *groups in reversed(REPLIES):
        hit = text.rlike(pattern)
        for name, group in zip(out, groups, strict=True):
            value = F.nullif(F.regexp_extract(text, pattern, group), F.lit("")) if group else F.lit(None).cast("string")
            out[name] = F.when(hit, value) if out[name] is None else F.when(hit, value).otherwise(out[name])
    return F.struct(out["author"].alias("author"), out["parent"].alias("parent"), out["number"].try_cast("bigint").alias("number"))


def answer_author(header: Column, shown: Column) -> Column:
    """Author of an answer: from a header ``n/m NAME válasza:``, else ``anonim`` if the header says so, else the name shown, else ``ismeretlen``."""
    named = F.nullif(one_line(F.regexp_extract(header, r"(?i)^\s*\d+/\d+\s+(.+?)\s+válasza:", 1)), F.lit(""))
    return F.coalesce(named, F.when(F.contains(F.lower(header), F.lit("anonim")), "anonim"), F.nullif(one_line(shown), F.lit("")), F.lit("ismeretlen"))


# What sites put around titles.
TITLE_ENDS = (r"(?i)\s*\(beszélgetés\)\s*$", r"(?i)\s+(?:ma|tegnap|tegnapelőtt|\d{4}\.\s*\d{2}\.\s*\d{2}\.?).*$", r"(?i)\s+\d+[\d .]*\s*db$")
TITLE_HEADS = (r"(?i)^\s*Téma:\s*", r"(?i)^\s*Fórum\s*»\s*")


def bare_title(title: Column, sites: tuple[str, ...] = (), activity: bool = False) -> Column:
    """A title without the captions before it, ``(beszélgetés)`` and `` - SITE ...`` behind it; with ``activity`` also without a last activity and a count."""
    out = title
    for head in TITLE_HEADS:
        out = F.regexp_replace(out, head, "")
    for site in sites:
        out = F.regexp_replace(out, rf"(?i)\s*-\s*{re.escape(site)}.*$", "")
    for end in TITLE_ENDS if activity else TITLE_ENDS[:1]:
        out = F.regexp_replace(out, end, "")
    return strip(out)


# Ranks that stand beside authors' names.
RANKS = ("tag", "őstag", "ostag", "senior tag", "aktív tag", "aktiv tag", "félisten", "felisten", "veterán", "veteran", "addikt", "nagyúr", "nagyur", "újonc", "ujonc", "csendes tag", "titán", "titan")


def author_line(text: Column) -> Column:
    """First line that is no rank and no message number; null without one."""
    lines = F.filter(F.transform(F.split(clean_text(text), "\n"), strip), lambda x: (x != "") & ~F.lower(x).isin(*RANKS) & ~x.startswith("#"))
    return F.try_element_at(lines, F.lit(1))


def unique_blocks(blocks: Column) -> Column:
    """Different blocks of a body in their order, a blank line between them; null where nothing is left."""
    return F.nullif(strip(F.array_join(F.array_distinct(blocks), "\n\n")), F.lit(""))


def kept_paragraphs(blocks: Column) -> Column:
    """Blocks cleaned, blank ones dropped, repeated ones kept."""
    return F.filter(F.transform(blocks, lambda x: clean_text(x)), lambda x: x != "")


def dated_node(texts: Column) -> Column:
    """Last of several texts that shows a time of day or a day relative to now; null without one."""
    return F.try_element_at(F.filter(F.reverse(texts), lambda x: x.rlike(r"\b\d{1,2}:\d{2}\b|(?iU)\b(?:ma|tegnap|tegnapelőtt)\b")), F.lit(1))


def cell(cells: Column, place: int, least: int = 1) -> Column:
    """Cell of a row by its place from 0, or from -1 at its end; null for rows of fewer than ``least`` cells."""
    return F.when(F.size(cells) >= least, F.try_element_at(cells, F.lit(place + 1 if place >= 0 else place)))


def upper(text: Column) -> Column:
    """Capitals, accented letters among them."""
    return F.upper(text)


def last_activity(text: Column) -> Column:
    """struct(message, user) of a last cell: ``TIME USER`` with a time of day, ``USER DAY ...`` with a date or a day relative to now, else all as the message."""
    shown = clean_text(text)
    first, second = r"^(.*?\d{1,2}:\d{2})\s+(.+)$", r"(?i)^(.*?)\s+((?:ma|tegnapelőtt|tegnap|\d{4}\.\d{2}\.\d{2}\.?|\d{4}-\d{2}-\d{2}).*)$"
    part = lambda p, n: clean_text(F.regexp_extract(shown, p, n))
    message = F.when(shown.rlike(second), part(second, 2)).when(shown.rlike(first), part(first, 1)).otherwise(shown)
    user = F.when(shown.rlike(second), part(second, 1)).when(shown.rlike(first), part(first, 2))
    return F.struct(message.alias("message"), user.alias("user"))


def index_of_total(text: Column) -> Column:
    """struct(index, total) of the first ``(n / m)``; nulls without one."""
    part = lambda n: F.nullif(F.regexp_extract(text, r"\((\d+)\s*/\s*(\d+)\)", n), F.lit("")).try_cast("bigint")
    return F.struct(part(1).alias("index"), part(2).alias("total"))


# What sites write before or behind their counts.
COUNTS = {
    "items": (r"(?i)/\s*([\d .]+)\s+összesen", r"(?i)([\d .]+)\s+összesen"),
    "topics": (r"(?i)Témák:\s*([\d\s.]+)",),
    "comments": (r"(?i)Hozzászólások:\s*([\d\s.]+)",),
    "authors": (r"(?i)Hozzászólók:\s*(\d+)",),
    "replies": (r"(?i)Válaszok:\s*([0-9 .]+)",),
    "views": (r"(?i)Olvasva:\s*([0-9 .]+)",),
    "likes": (r"(?i)\bLike(?:ok)?\s*[:\-]?\s*(\d+)\b", r"(?i)\bTetszik\s*[:\-]?\s*(\d+)\b"),
    "dislikes": (r"(?i)\bDislike(?:ok)?\s*[:\-]?\s*(\d+)\b", r"(?i)\bNem tetszik\s*[:\-]?\s*(\d+)\b"),
}


def shown_count(text: Column, what: str) -> Column:
    """A count that a page shows, by ``COUNTS``; the first pattern that matches counts. ``Nem tetszik 3`` also shows 3 likes, as its second word does."""
    found = [F.nullif(F.regexp_extract(text, p, 1), F.lit("")) for p in COUNTS[what]]
    return first_integer(F.coalesce(*found), False)


def largest_number(text: Column) -> Column:
    """Largest number of a text, with dots between thousands; null without one."""
    numbers = F.regexp_extract_all(text, F.lit(r"\b\d{1,3}(?:\.\d{3})*\b"), F.lit(0))
    return F.array_max(F.transform(numbers, lambda x: F.translate(x, ".", "").try_cast("bigint")))


def indicators(texts: Column) -> Column:
    """Different page indicators in their order."""
    return F.array_distinct(texts)


# Characters that file names must not have, and what stands for them.
FILE_CHARS = {":": " -", "/": "-", "\\": "-", "|": "-", "<": "(", ">": ")", "?": "", "*": "", '"': ""}


def safe_name(name: str | None, most: int = 180, default: str = "ismeretlen") -> str:
    """A file name: accents dropped, forbidden characters replaced, white space as one space, dots and blanks at the end cut, also behind the cut to ``most``."""
    text = "".join(c for c in unicodedata.normalize("NFKD", name or "") if not unicodedata.combining(c))
    text = " ".join("".join(FILE_CHARS.get(c, c) for c in text).split())
    return text.rstrip(". ")[:most].rstrip(" .") or default


@F.pandas_udf(StringType())
def safe_file_name(names: pd.Series) -> pd.Series:
    """``safe_name`` in Arrow batches, as there is no built-in decomposition."""
    return names.map(lambda x: safe_name(x) if x is None or isinstance(x, str) else safe_name(None))
