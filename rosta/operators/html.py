"""Rows from captured pages: a lenient parser in Arrow batches, driven by a description of the page instead of code per site."""

from __future__ import annotations

from dataclasses import dataclass, field
from html.parser import HTMLParser
from urllib.parse import urljoin

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT = frozenset(("script", "style"))


class Node:
    """An element with its attributes and children (elements and texts)."""

    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]) -> None:
        self.tag, self.attrs, self.children = tag, attrs, []

    def walk(self):  # noqa: ANN201
        """This element and all below it, in document order."""
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def texts(self, skip: frozenset[str] = SILENT, without: tuple[str, ...] = ()) -> list[str]:
        """Stripped texts below, in order; elements of the tags ``skip`` and those that match a selector of ``without`` left out."""
        out, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                if node.strip():
                    out.append(node.strip())
            elif node.tag not in skip and not any(node.matches(s) for s in without):
                stack += reversed(node.children)
        return out

    def matches(self, selector: str) -> bool:
        """``tag``, ``.class``, ``#id``, ``tag.class`` or ``tag[attr]``."""
        if "[" in selector:
            tag, attr = selector[:-1].split("[", 1)
            name, _, value = attr.partition("=")
            return (not tag or self.tag == tag) and name in self.attrs and (not value or self.attrs[name] == value)
        tag, dot, cls = selector.partition(".")
        if "#" in tag:
            tag, _, ident = tag.partition("#")
            if self.attrs.get("id") != ident:
                return False
        return (not tag or self.tag == tag) and (not dot or cls in (self.attrs.get("class") or "").split())

    def select(self, selector: str) -> list[Node]:
        """Elements below that match the last step of a path of selectors, each within a match of the step before."""
        found = [self]
        for step in selector.split():
            inner = []
            for node in found:
                inner += [n for n in node.walk() if n is not node and n.matches(step)]
            found = list(dict.fromkeys(inner))
        return found


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        node = Node(tag, {k: v or "" for k, v in attrs})
        if tag in ("p", "li", "tr", "td", "th", "option") and self.open[-1].tag == tag:
            self.open.pop()
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.open[-1].children.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def parse(html: str | None) -> Node:
    """The tree of a page; what is not closed is closed at the end, what was not open is not closed."""
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


@dataclass(frozen=True)
class Extraction:
    """What to take from a page: one row for each element that ``rows`` selects, and for each field the first way that gives something.

    A way is ``selector``, ``selector@attribute`` or ``@attribute`` (of the row itself); '' is the row's own text. Addresses (href,
    src) are made absolute. without: selectors of elements that give no text.
    """

    rows: str
    fields: dict[str, tuple[str, ...]]
    without: tuple[str, ...] = ()
    needs: tuple[str, ...] = field(default=())

    def take(self, node: Node, ways: tuple[str, ...], base: str) -> str | None:
        """The first value that is not empty."""
        for way in ways:
            selector, at, attribute = way.partition("@")
            found = node.select(selector) if selector else [node]
            for hit in found:
                if at:
                    value = (hit.attrs.get(attribute) or "").strip()
                    value = urljoin(base, value) if value and attribute in ("href", "src") else value
                else:
                    value = "\n".join(hit.texts(without=self.without))
                if value:
                    return value
        return None

    def rows_of(self, html: str | None, base: str) -> list[dict[str, str | None]]:
        """The rows of a page; those that lack a needed field are left out."""
        out = []
        for node in parse(html).select(self.rows):
            row = {name: self.take(node, ways, base) for name, ways in self.fields.items()}
            if all(row[n] for n in self.needs):
                out.append(row)
        return out


def between_headings(html: str | None, heading: str, stop_parts: tuple[str, ...] = ()) -> list[str]:
    """Texts of the paragraphs behind the heading whose text contains ``heading`` (lower case) up to the next heading, or to a section whose text contains one of ``stop_parts``."""
    out, inside, done = [], False, set()
    for node in parse(html).walk():
        if id(node) in done:
            continue
        if node.tag in ("h1", "h2", "h3", "h4"):
            if inside:
                break
            inside = heading in " ".join(" ".join(node.texts()).split()).lower()
        elif inside and node.tag in ("section", "aside", "nav", "footer", "header"):
            if any(part in " ".join(node.texts()).lower() for part in stop_parts):
                break
        elif inside and node.tag == "p":
            out.append("\n".join(node.texts()))
            done |= {id(n) for n in node.walk()}
    return [t for t in out if t]


LINKS = Extraction("a[href]", {"url": ("@href",), "title": ("", "@title")}, needs=("url",))
COMMENTS = Extraction(".comment", {"comment_id": ("@data-id", "@id"), "author": (".author",), "date": (".date", "time@datetime"), "data": (".body",), "parent": (".reply@data-parent",)}, without=("blockquote", "button"))
TOPICS = Extraction("tr.topic", {"title": ("td.title a", "td.title"), "url": ("td.title a@href",), "comments": ("td.count",), "last": ("td.last",)}, needs=("title",))
ADS = Extraction(".ad", {"title": (".title", "h2"), "url": ("a@href",), "seller": (".seller",), "price": (".price",)}, needs=("url",))
GROUPS = Extraction(".group", {"title": ("a.title", "a"), "url": ("a.title@href", "a@href"), "topics": (".topics",), "comments": (".comments",), "parent": ("@data-parent",)}, needs=("title", "url"))
PAGE_TITLE = Extraction("html", {"title": ("h1.title", "h1", "h2.title", "meta[property=og:title]@content", "title")})
TOPIC_META = Extraction("html", {"opener": (".opened .author", ".opener"), "opened": (".opened .date", ".opened time@datetime"), "counts": (".counts", ".topic-info")})
HEADERS = Extraction(".comment .header", {"author": (".author", "a"), "date": (".date", "time@datetime", "div"), "parent": (".reply-to", "a.parent"), "votes": (".votes",), "rating": ("@data-rating", "a[title]@title")})
PAGER = Extraction(".pager a", {"url": ("@href",), "label": ("",), "rel": ("@rel",)}, needs=("url",))
AD_PAGE = Extraction("html", {"title": ("h1.title", "h1"), "seller": (".seller-name", ".seller a", ".seller"), "date": (".date", "time@datetime"), "description": (".description", "#description", "meta[name=description]@content")})


def next_of_pager(links: list[dict[str, str | None]], current: int, words: tuple[str, ...] = ("következő", "next", "->", "→", "»", ">")) -> str | None:
    """Address that a pager gives for the page behind ``current``: the link labelled so or with that number, else the smallest larger number."""
    for link in links:
        if link.get("rel") == "next" or any(w in (link["label"] or "").lower() for w in words):
            return link["url"]
    numbered = sorted((int(x["label"]), x["url"]) for x in links if (x["label"] or "").isdecimal())
    return next((url for number, url in numbered if number > current), None)


def safe_rows(what: Extraction, page: str | None, where: str | None) -> list[dict[str, str | None]]:
    """The rows of a page; a page that cannot be read (a broken address in it, nesting beyond the limit) gives none and stops no other."""
    try:
        return what.rows_of(page, where or "") if page else []
    except (ValueError, RecursionError):
        return []


def extract(pages: DataFrame, keys: list[str], html: str, url: str, what: Extraction) -> DataFrame:
    """(keys, place, one column per field) for every row found in each page; a null or empty page gives none."""
    names = [f"_k{i}" for i in range(len(keys))]
    base = pages.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names, strict=True)], F.col(f"`{html}`").alias("_html"), F.col(f"`{url}`").alias("_url"))
    types, fields = dict(base.dtypes), [*what.fields]

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for given in batches:
            at, place, rows = [], [], []
            for i, (page, where) in enumerate(zip(given.column("_html").to_pylist(), given.column("_url").to_pylist(), strict=True)):
                for p, row in enumerate(safe_rows(what, page, where)):
                    at.append(i)
                    place.append(p)
                    rows.append(row)
            pick = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([*[given.column(n).take(pick) for n in names], pa.array(place, pa.int32()), *[pa.array([r[f] for r in rows], pa.string()) for f in fields]], names=[*names, "place", *fields])

    schema = ", ".join(f"{n} {types[n]}" for n in names) + ", place int, " + ", ".join(f"`{f}` string" for f in fields)
    return base.mapInArrow(run, schema).withColumnsRenamed(dict(zip(names, keys, strict=True)))
