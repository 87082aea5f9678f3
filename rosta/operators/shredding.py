"""Nested JSON documents to an adjacency table, and from it to related flat tables.

Every value of a document becomes one row that stores its node number, its parent, the label and ordinal under which the parent
holds it, its kind and, for scalars, its text. Rows also name their owner, the nearest enclosing element of an array (or the
root), and the labels that lead from the owner down to them, so that a record and its parts meet in one equi-join at any depth.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosta.session import written

NODE_COLUMNS = "node int, parent int, owner int, label string, ordinal int, path array<string>, kind string, scalar string"


class _Number(str):
    """A number as it is written."""


def _refuse(word: str) -> None:
    raise ValueError(word)


def parse(raw: str | None, strict: bool = True) -> tuple[bool, object]:
    """(True, value) of a text that is valid JSON, else (False, None); numbers keep their text. NaN and Infinity are not JSON, but valid without ``strict``."""
    if raw is None:
        return False, None
    try:
        return True, json.loads(raw, parse_int=_Number, parse_float=_Number, parse_constant=_refuse if strict else _Number)
    except (ValueError, RecursionError):
        return False, None


def walk(value: object) -> Iterator[tuple]:
    """The nodes of one document, parents before children."""
    stack, count = [(value, -1, -1, None, 0, ())], 0
    while stack:
        here, parent, owner, label, ordinal, path = stack.pop()
        node, count = count, count + 1
        if isinstance(here, dict):
            kind, scalar = "object", None
        elif isinstance(here, list):
            kind, scalar = "array", None
        elif here is None:
            kind, scalar = "null", None
        elif isinstance(here, bool):
            kind, scalar = "boolean", "true" if here else "false"
        else:
            kind, scalar = ("number" if isinstance(here, _Number) else "string"), str(here)
        yield node, parent, owner, label, ordinal, path, kind, scalar
        if kind in ("object", "array"):
            element = parent < 0 or label is None
            below, way = (node, ()) if element else (owner, path)
            parts = [(v, k) for k, v in here.items()] if kind == "object" else [(v, None) for v in here]
            stack += [(v, node, below, k, i, (*way, k)) for i, (v, k) in reversed([*enumerate(parts)])]


def shred(docs: DataFrame, key: str, raw: str) -> DataFrame:
    """The adjacency table of all documents: (key, node, parent, owner, label, ordinal, path, kind, scalar).

    A null, empty or invalid document (also one nested deeper than the JSON reader goes) gives no rows. Of a repeated key in an
    object the last value counts. Repeated rows are shredded each on its own; further columns of any name are ignored. Lone
    surrogates become U+FFFD.
    """

    def nodes(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        names = ["node", "parent", "owner", "label", "ordinal", "path", "kind", "scalar"]
        types = [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.list_(pa.string()), pa.string(), pa.string()]

        def batch(keys: list, rows: list) -> pa.RecordBatch:
            columns = [*zip(*rows, strict=True)] or [()] * len(names)
            try:
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            except UnicodeEncodeError:
                mend = lambda s: s if s is None else s.encode("utf-8", "surrogatepass").decode("utf-8", "replace")
                arrays = [pa.array([mend(v) for v in c], t) if t == pa.string() else pa.array([[mend(x) for x in v] for v in c], t) if t == types[5] else pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(keys, key_type), *arrays], names=["_key", *names])

        for given in batches:
            key_type = given.schema.field(0).type
            keys, rows = [], []
            for k, text in zip(given.column(0).to_pylist(), given.column(1).to_pylist(), strict=True):
                valid, value = parse(text)
                for row in walk(value) if valid else ():
                    keys.append(k)
                    rows.append(row)
                    if len(rows) >= 20_000:
                        yield batch(keys, rows)
                        keys, rows = [], []
            if rows:
                yield batch(keys, rows)

    kind = dict(docs.dtypes)[key]
    out = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{raw}`").alias("_raw")).mapInArrow(nodes, f"_key {kind}, {NODE_COLUMNS}")
    return out.withColumnRenamed("_key", key)


def _at(*labels: str | None) -> Column:
    """Whether a node is reached from its owner by these labels; None stands for an element of an array."""
    out = F.size("path") == len(labels)
    for i, label in enumerate(labels):
        step = F.get("path", F.lit(i))
        out &= step.isNull() if label is None else step == label
    return out


def records(nodes: DataFrame, key: str, label: str) -> DataFrame:
    """(key, node, place): the objects in the root object's array ``label``, with their 0-based places."""
    return nodes.filter((F.col("owner") == 0) & _at(label, None) & (F.col("kind") == "object")).select(key, "node", F.col("ordinal").alias("place"))


def entity(nodes: DataFrame, items: DataFrame, key: str, fields: dict[str, tuple[str, ...]]) -> DataFrame:
    """One row per record of ``items`` with a column for each field: the scalar at that way below the record, else null."""
    names = [*fields]
    role = F.coalesce(*[F.when(_at(*way), F.lit(n)) for n, way in fields.items()])
    scalars = nodes.filter(F.col("kind").isin("string", "number", "boolean")).select(key, F.col("owner").alias("node"), role.alias("role"), "scalar").filter("role is not null")
    joined = items.join(scalars, [key, "node"], "left")
    return joined.groupBy(key, "node", "place").agg(*[F.max(F.when(F.col("role") == n, F.col("scalar"))).alias(n) for n in names])


def children(nodes: DataFrame, items: DataFrame, key: str) -> DataFrame:
    """(key, node, place, child, child_key, scalar): authors, details, crumbs, own and parent ids below each record."""
    kept = F.col("kind") != "null"
    detail = (F.size("path") > 2) & (F.get("path", F.lit(0)) == "extra") & (F.get("path", F.lit(1)) == "details") & ~F.exists("path", lambda x: x.isNull()) & (F.col("kind") != "object")
    scalar = F.col("kind").isin("string", "number", "boolean")
    child = (
        F.when(_at("authors", None) & kept, F.lit("author"))
        .when(_at("authors") & (F.col("kind") == "object"), F.lit("author"))
        .when(detail, F.lit("detail"))
        .when(_at("extra", "breadcrumb", None) & kept, F.lit("crumb"))
        .when(_at("extra", "comment_id") & scalar, F.lit("id"))
        .when(_at("extra", "parent_comment_id") & scalar, F.lit("reply"))
    )
    child_key = (
        F.when(F.col("child") == "detail", F.array_join(F.slice("path", 3, 1_000_000), "/"))
        .when(F.col("child").isin("id", "reply"), F.col("scalar"))
        .when(F.size("path") == 1, F.lit("0"))
        .otherwise(F.col("ordinal").cast("string"))
    )
    typed = nodes.filter(F.col("owner") > 0).withColumn("child", child).filter("child is not null").select(key, F.col("owner").alias("node"), "child", child_key.alias("child_key"), "scalar", F.col("node").alias("child_node"))
    return items.join(typed, [key, "node"])


def child_records(docs: DataFrame, key: str, raw: str, label: str = "comments") -> DataFrame:
    """(key, place, child, child_key): the rows of all flat tables, each pointing to its file and record.

    Only a root object with an array under ``label`` gives rows. ``comment`` has one row per object of the array; ``author``
    the 0-based place of each entry that is not null (a lone object has place 0); ``detail`` the joined keys of each value that
    is no object; ``crumb`` like ``author``; ``reply`` the parent's id where an earlier record of the document has that id.
    A document key that repeats is no unit: give each document its own.
    """
    nodes = written(shred(docs, key, raw), "nodes")
    items = records(nodes, key, label)
    parts = children(nodes, items, key)
    linked = F.min(F.when(F.col("child") == "id", F.col("place"))).over(_same(key))
    ids = parts.filter(F.col("child").isin("id", "reply")).withColumn("first", linked).filter((F.col("child") == "reply") & (F.col("first") < F.col("place")))
    own = items.select(key, "place", F.lit("comment").alias("child"), F.lit("").alias("child_key"))
    rest = parts.filter(F.col("child").isin("author", "detail", "crumb"))
    return own.unionByName(rest.select(key, "place", "child", "child_key")).unionByName(ids.select(key, "place", "child", "child_key"))


def _same(key: str):  # noqa: ANN202
    return Window.partitionBy(key, "child_key")


def flat_tables(docs: DataFrame, key: str, raw: str, label: str = "comments") -> dict[str, DataFrame]:
    """comments, authors, details, crumbs and replies as tables, each row with its document's key and its record's place."""
    nodes = written(shred(docs, key, raw), "nodes")
    items = records(nodes, key, label)
    parts = children(nodes, items, key)
    simple = ("data", "likes", "dislikes", "score", "rating", "date", "url", "language")
    nested = ("comment_id", "parent_comment_id", "parent_author", "title", "price", "seller_name", "listing_location")
    comments = entity(nodes, items, key, {n: (n,) for n in simple} | {n: ("extra", n) for n in nested})
    author = parts.filter("child = 'author'").select(key, F.col("child_node").alias("node"), F.col("place").alias("comment_pos"), F.col("child_key").cast("int").alias("place"))
    # an author in an array owns its scalars; a lone one leaves them to its record
    lone = nodes.filter((F.size("path") == 2) & (F.get("path", F.lit(0)) == "authors")).select(key, F.col("parent").alias("node"), F.get("path", F.lit(1)).alias("label2"), F.col("scalar").alias("value"))
    own = nodes.filter(F.size("path") == 1).select(key, F.col("owner").alias("node"), F.get("path", F.lit(0)).alias("label2"), F.col("scalar").alias("value"))
    named = author.join(lone.unionByName(own), [key, "node"], "left").groupBy(key, "node", "comment_pos", "place")
    authors = named.agg(*[F.max(F.when(F.col("label2") == n, F.col("value"))).alias(n) for n in ("name", "family", "given")])
    linked = F.min(F.when(F.col("child") == "id", F.col("place"))).over(_same(key))
    replies = parts.filter(F.col("child").isin("id", "reply")).withColumn("parent_pos", linked).filter((F.col("child") == "reply") & (F.col("parent_pos") < F.col("place")))
    return {
        "comments": comments.drop("node").withColumnRenamed("place", "comment_pos"),
        "authors": authors.drop("node"),
        "details": parts.filter("child = 'detail'").select(key, F.col("place").alias("comment_pos"), F.col("child_key").alias("name"), F.col("scalar").alias("value")),
        "crumbs": parts.filter("child = 'crumb'").select(key, F.col("place").alias("comment_pos"), F.col("child_key").cast("int").alias("place"), F.col("scalar").alias("value")),
        "replies": replies.select(key, F.col("place").alias("comment_pos"), "parent_pos", F.col("child_key").alias("parent_comment_id")),
    }
