"""Scalar functions on addresses; built-in expressions wherever they can say it."""

from __future__ import annotations

import re
from urllib.parse import parse_qsl, urlencode, urljoin, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from rosta.functions.text import clean_text


def without_fragment(url: Column) -> Column:
    """Up to the first ``#``."""
    return F.substring_index(url, "#", 1)


def _query(url: Column) -> Column:
    """What stands between the first ``?`` and the fragment; empty without one."""
    return F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)


def query_param(url: Column, key: str) -> Column:
    """First value of a query parameter, decoded: all behind its first ``=``; blank values are skipped; null without one."""
    raw = F.nullif(F.regexp_extract(_query(url), rf"(?:^|&){re.escape(key)}=([^&]+)", 1), F.lit(""))
    return F.coalesce(F.try_url_decode(raw), raw)


def without_param(url: Column, *keys: str) -> Column:
    """Without fragment and without any occurrence of the parameters ``keys``; the others stay as they are."""
    kept = F.array_join(F.filter(F.split(_query(url), "&"), lambda p: ~F.substring_index(p, "=", 1).isin(*keys) & (p != "")), "&")
    base = F.regexp_extract(url, r"^[^?#]*", 0)
    return F.when(kept == "", base).otherwise(F.concat(base, F.lit("?"), kept))


#: Ways in which sites compare the addresses of topics: what the key of an address is made of. Case always counts.
VISITED_RULES = ("fragment", "slash", "path", "page", "pg", "start", "rowstart", "p", "range")


def visited_key(url: Column, rule: str = "fragment") -> Column:
    """The form in which visited addresses are compared.

    ``fragment``: without fragment; ``slash``: and without slashes at the end; ``path``: also without query; ``range``: also
    without the file that names a range of messages or the latest ones; any other rule: without fragment and that parameter.
    """
    if rule == "fragment":
        return without_fragment(url)
    if rule == "slash":
        return F.regexp_replace(without_fragment(url), "/+$", "")
    if rule == "path":
        return F.regexp_replace(F.regexp_extract(url, r"^[^?#]*", 0), "/+$", "")
    if rule == "range":
        return F.regexp_replace(F.regexp_replace(without_fragment(url), "/+$", ""), r"(?i)/(?:friss|hsz_[0-9]+-[0-9]+)\.html$", "")
    return without_param(url, rule)


def visited_key_by(url: Column, origin: Column, rules: dict[str, str], default: str = "fragment") -> Column:
    """``visited_key`` by the rule of the address's origin; origins without one follow ``default``."""
    out = visited_key(url, default)
    for rule in sorted(set(rules.values()), reverse=True):
        out = F.when(origin.isin([o for o, r in rules.items() if r == rule]), visited_key(url, rule)).otherwise(out)
    return out


def kept_params(url: Column, keys: tuple[str, ...]) -> Column:
    """Address for comparing list pages: no slash at the end of the path and only the parameters ``keys``, in their order."""
    shown = lambda k: F.filter(F.split(_query(url), "&"), lambda p: p.startswith(f"{k}=") & (F.length(p) > len(k) + 1))
    kept = F.array_join(F.concat(*map(shown, keys)), "&")
    base = visited_key(url, "path")
    return F.when(kept == "", base).otherwise(F.concat(base, F.lit("?"), kept))


def page_number(url: Column, key: str = "page", default: int = 1) -> Column:
    """Page number of an address."""
    return F.coalesce(query_param(url, key).try_cast("bigint"), F.lit(default).cast("bigint"))


def page_url(base: Column, page: Column, key: str = "page") -> Column:
    """Address of a page: pages up to the first are the base itself."""
    joint = F.when(F.contains(base, F.lit("?")), "&").otherwise("?")
    return F.when(page <= 1, base).otherwise(F.concat(base, joint, F.lit(f"{key}="), page.cast("string")))


def anchored(url: Column, comment_id: Column, prefix: str = "comment-") -> Column:
    """Address of a comment within its page; the page's own where there is no id."""
    has = F.coalesce(comment_id, F.lit("")) != ""
    return F.when(has, F.concat(without_fragment(url), F.lit(f"#{prefix}"), comment_id)).otherwise(url)


def ad_id(url: Column) -> Column:
    """Id of an ad: the number before ``.html``, else the last number of the path, else its last part."""
    path = F.regexp_replace(F.substring_index(without_fragment(url), "?", 1), "^[a-z]+://[^/]*", "")
    number = F.nullif(F.regexp_extract(path, r"_([0-9]+)\.html$", 1), F.lit(""))
    last = F.try_element_at(F.regexp_extract_all(path, F.lit("[0-9]+"), F.lit(0)), F.lit(-1))
    return F.coalesce(number, last, F.nullif(F.substring_index(F.regexp_replace(path, "/+$", ""), "/", -1), F.lit("")))


def ad_key(identity: Column, url: Column, title: Column) -> Column:
    """Key of an ad by what it has: its id, else its address, else its title, each cleaned and in its own case; the title's key may be empty."""
    first, second = clean_text(identity), clean_text(url)
    return F.when(first != "", F.concat(F.lit("uadid:"), first)).when(second != "", F.concat(F.lit("url:"), second)).otherwise(F.concat(F.lit("title:"), clean_text(title)))


def previous_range(url: Column, step: int = 100) -> Column:
    """Address of the range of messages before one of the form ``hsz_S-E``; null before the first."""
    start, end = (F.regexp_extract(url, r"hsz_([0-9]+)-([0-9]+)", n).try_cast("bigint") for n in (1, 2))
    head, tail = F.regexp_extract(url, r"^(.*hsz_)[0-9]+-[0-9]+", 1), F.regexp_extract(url, r"hsz_[0-9]+-[0-9]+([^#]*)", 1)
    made = F.concat(head, (start - step).cast("string"), F.lit("-"), (end - step).cast("string"), tail, F.lit("#msg"), (end - step + 1).cast("string"))
    return F.when((start - step >= 1) & (end - step >= 1), made)


def next_start(url: Column, start: str = "na_start", step: str = "na_step") -> Column:
    """Start of the next page: start plus step, null unless both are digits."""
    digits = lambda k: F.when(query_param(url, k).rlike("^[0-9]+$"), query_param(url, k).try_cast("bigint"))
    return digits(start) + digits(step)


def shape(url: Column) -> Column:
    """What an address leads to: ad, thread, topic, list or other."""
    return (
        F.when(url.rlike(r"(?i)_[0-9]+\.html(?:[?#]|$)") & url.rlike("(?i)hirdetes"), "ad")
        .when(url.rlike(r"(?i)[?&]thread_id=[0-9]+"), "thread")
        .when(F.contains(url, F.lit("/tema/")) & ~F.contains(url, F.lit("/temak/")), "topic")
        .when(url.rlike(r"(?i)/forum/[^/]+/t[0-9]+"), "topic")
        .when(url.rlike(r"(?i)/csoport/"), "list")
        .otherwise("other")
    )


def _with(url: str, key: str, value: str | None, fragment: bool = False) -> str:
    parts = urlsplit(url)
    pairs, seen = [], False
    for k, v in parse_qsl(parts.query):
        if k != key:
            pairs.append((k, v))
        elif value is not None and not seen:
            pairs.append((k, value))
            seen = True
    if value is not None and not seen:
        pairs.append((key, value))
    return urlunsplit((parts.scheme, parts.netloc, parts.path, urlencode(pairs), parts.fragment if fragment else ""))


@F.pandas_udf(StringType())
def with_param(urls: pd.Series, keys: pd.Series, values: pd.Series) -> pd.Series:
    """Query parameter set in place or appended, the query encoded anew, blanks and fragment dropped; a null value removes it."""
    return pd.Series([None if u is None else _with(u, k, v) for u, k, v in zip(urls, keys, values, strict=True)], dtype="object")


@F.pandas_udf(StringType())
def with_param_and_fragment(urls: pd.Series, keys: pd.Series, values: pd.Series) -> pd.Series:
    """As ``with_param``, the fragment kept."""
    return pd.Series([None if u is None else _with(u, k, v, True) for u, k, v in zip(urls, keys, values, strict=True)], dtype="object")


def resume_url(url: Column, start: str = "na_start", step: str = "na_step") -> Column:
    """Address of the page behind that of the last saved comment: its start moved on by its step; null unless both are digits."""
    following = next_start(url, start, step)
    moved = with_param(with_param(url, F.lit(start), following.cast("string")), F.lit(step), query_param(url, step).try_cast("bigint").cast("string"))
    return F.when(following.isNotNull(), moved)


@F.pandas_udf(StringType())
def absolute(bases: pd.Series, links: pd.Series) -> pd.Series:
    """A relative address resolved against its page."""
    return pd.Series([None if b is None or x is None else urljoin(b, x) for b, x in zip(bases, links, strict=True)], dtype="object")
