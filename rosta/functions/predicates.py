"""Predicates on rows, pages and lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosta.functions.text import clean_text, one_line, strip, without_rating


def title_has(title: Column, part: str) -> Column:
    """Literal containment without regard to case; null titles have nothing."""
    return F.coalesce(F.contains(F.lower(title), F.lit(part.lower())), F.lit(False))


def allowed(value: Column, allow: list[str] | None = None, deny: list[str] | None = None) -> Column:
    """Whether a value is in the allow list, if there is one, and not in the deny list."""
    out = F.lit(True)
    if allow:
        out &= F.coalesce(value.isin(allow), F.lit(False))
    if deny:
        out &= ~F.coalesce(value.isin(deny), F.lit(False))
    return out


# Marks of pages that are no content, lower case.
CAPTCHA_MARKS = ("captcha", "cloudflare", "cf-challenge", "challenge-platform", "verify you are human", "ellenőrizze, hogy ember", "igazolja, hogy nem robot", "nem vagy robot")
OVERLOAD_MARKS = ("excessive load policy", "cannot access this network segment")
EMPTY_MARKS = ("nincs találat", "nem található hirdetés", "nincs több hirdetés", "nincsenek hirdetések")


def _any_of(low: Column, marks: tuple[str, ...]) -> Column:
    """Whether a lower-cased text has one of the marks."""
    out = F.lit(False)
    for mark in marks:
        out |= F.contains(low, F.lit(mark))
    return out


def page_class(html: Column) -> Column:
    """captcha, overload, missing, messages, empty or unknown, tested in this order, for a captured page; null for none.

    Messages go before empty: a post that quotes the notice of an empty page does not empty its page.
    """
    low = F.lower(html)
    return (
        F.when(_any_of(low, CAPTCHA_MARKS), "captcha")
        .when(_any_of(low, OVERLOAD_MARKS), "overload")
        .when(low.rlike(r"<title>[^<]*404|404 not found|a kért oldal nem létezik"), "missing")
        .when(low.rlike(r'class="[^"]*\b(?:msg|message|comment|hozzaszolas)\b|<article'), "messages")
        .when(_any_of(low, EMPTY_MARKS), "empty")
        .when(html.isNotNull(), "unknown")
    )


def fatal_page(page: Column) -> Column:
    """``page_class`` of a page; the query fails on a captcha or an overload notice, which end a crawl."""
    kind = page_class(page)
    return F.when(kind.isin("captcha", "overload"), F.raise_error(F.concat(F.lit("fatal page: "), kind)).cast("string")).otherwise(kind)


def body_line(line: Column) -> Column:
    """Whether a line of a comment's body is content: no bare time, message number, reply button or reply header."""
    return ~F.coalesce(line.rlike(r"^(?:\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}:\d{2}|#\d+|Válasz erre)$") | line.rlike(r"(?i)^Válasz\s+.+?\s+#\d+\.\s*hozzászólására$"), F.lit(False))


def body_text(text: Column) -> Column:
    """A body's lines, each on one line's white space, without blank ones and those that are no content."""
    lines = F.filter(F.transform(F.split(text, "\n"), one_line), lambda x: x != "")
    return F.array_join(F.filter(lines, body_line), "\n")


# Fragments that a seller's name never has, lower case.
NO_SELLER = ("client:", "cookie", "cookiebot", "usercentrics", "süti", "adatkezel", "beleegyez", "partner", "értékel", "minősítés", "visszajelzés", "eladó követése", "eladó termékei", "szabálytalan hirdetés", "megosztás")
SHOWN_DATE = r"\d{4}\.\d{2}\.\d{2}\.?\s+\d{2}:\d{2}:\d{2}"


def seller_like(text: Column) -> Column:
    """Whether a text can be a seller's name: 2 to 80 characters, no date in it, no page fragment and no technical value."""
    name = without_rating(text)
    bad = _any_of(F.lower(name), NO_SELLER) | name.rlike(SHOWN_DATE) | name.rlike(r"^[A-Za-z]+:[0-9a-fA-F]{4,}$")
    return F.coalesce(F.length(name).between(2, 80) & ~bad, F.lit(False))


# Captions that are no paragraph of a description, and what such captions contain.
NO_PARAGRAPH = ("eladó leírása a termékről", "leírás", "keresés a leírásban is", "keresés a leírásban")
NO_PARAGRAPH_PARTS = ("szabálytalan hirdetés", "megosztás", "eladó termékei", "vissza az oldal tetejére")


def paragraph(text: Column) -> Column:
    """Whether a text is a paragraph of a description and no caption or button of its page."""
    low = F.lower(one_line(clean_text(text)))
    return F.coalesce((low != "") & ~low.isin(*NO_PARAGRAPH) & ~_any_of(low, NO_PARAGRAPH_PARTS), F.lit(False))


# Titles of search pages and boards, and what the titles of search pages contain.
NO_TITLE = ("keresés", "kereses", "forum", "fórum")
NO_TITLE_PARTS = ("keresés", "kereses", "találat", "search")


def resolved_title(title: Column, boards: tuple[str, ...] = ()) -> Column:
    """Whether a title that a page shows is a topic's own and not that of a search page or of one of the ``boards`` (lower case)."""
    low = F.lower(clean_text(title))
    return F.coalesce((low != "") & ~low.isin(*NO_TITLE, *boards) & ~_any_of(low, NO_TITLE_PARTS), F.lit(False))


# Path parts of pages that are no product, texts of links that lead to no topic.
NO_PRODUCT = ("/user/", "/help/", "/login", "/belepes", "/registration", "/index-c")
NO_TOPIC_LINK = ("ok", "belépés", "regisztráció", "elfelejtett jelszó", "új kérdés a topikon belül", "keresés", "fórum")


def product_url(url: Column, host: str) -> Column:
    """Whether an address is a product's page: on ``host`` or relative, its path ends in ``.html`` and names no other page."""
    where, path = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)?([^?#]*)", 1))
    return F.coalesce(((where == "") | F.contains(where, F.lit(host))) & path.endswith(".html") & ~_any_of(path, NO_PRODUCT), F.lit(False))


def topic_link(href: Column, text: Column) -> Column:
    """Whether a link probably leads to a topic: an address below ``/forum/`` and a text that is no caption."""
    target, label = strip(F.coalesce(href, F.lit(""))), F.lower(clean_text(text))
    return (target != "") & (label != "") & ~target.startswith("javascript:") & ~target.startswith("#") & F.contains(F.lower(target), F.lit("/forum/")) & ~label.isin(*NO_TOPIC_LINK)


def no_pagination(url: Column) -> Column:
    """Whether an address is no further page of a question."""
    return ~F.coalesce(F.contains(url, F.lit("__oldal-")), F.lit(False))


def rule_topic(title: Column, rules: str) -> Column:
    """Whether a topic is the board's rules, by its exact title (lower case ``rules``)."""
    return F.coalesce(F.lower(title) == rules, F.lit(False))


def long_enough(title: Column, least: int) -> Column:
    """Whether a title has at least ``least`` characters."""
    return F.coalesce(F.length(title) >= least, F.lit(False))


def page_count_like(number: Column) -> Column:
    """Whether a number of a pager can be a page: 2 to 100000."""
    return F.coalesce(number.between(2, 100_000), F.lit(False))


def kept_comment(text: Column, comment_id: Column, author: Column, date: Column, rule: str) -> Column:
    """Whether a comment stays: ``body`` with a body; ``id``: with an id or a body; ``any``: with a body, author or date; ``all``: always."""
    has = lambda c: clean_text(c) != ""
    return {"body": has(text), "id": has(text) | has(comment_id), "any": has(text) | has(author) | has(date), "all": F.lit(True)}[rule]
