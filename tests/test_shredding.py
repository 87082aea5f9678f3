"""Shredding against a plain walk over the parsed documents."""

import json

import pytest

from rosta.operators.shredding import child_records, flat_tables, shred


def brute(raw):
    try:
        doc = json.loads(raw, parse_constant=lambda x: 1 / 0)
    except Exception:
        return set()
    out = set()
    if not isinstance(doc, dict) or not isinstance(doc.get("comments"), list):
        return out
    seen = set()
    text = lambda v: json.dumps(v) if isinstance(v, bool) else str(v)

    def leaves(v, way):
        for k, x in v.items():
            if isinstance(x, dict):
                leaves(x, [*way, k])
            else:
                out.add((pos, "detail", "/".join([*way, k])))

    for pos, item in enumerate(doc["comments"]):
        if not isinstance(item, dict):
            continue
        out.add((pos, "comment", ""))
        authors = item.get("authors")
        authors = [authors] if isinstance(authors, dict) else authors if isinstance(authors, list) else []
        out |= {(pos, "author", str(i)) for i, a in enumerate(authors) if a is not None}
        extra = item.get("extra")
        if not isinstance(extra, dict):
            continue
        if isinstance(extra.get("details"), dict):
            leaves(extra["details"], [])
        crumbs = extra.get("breadcrumb")
        out |= {(pos, "crumb", str(i)) for i, c in enumerate(crumbs if isinstance(crumbs, list) else []) if c is not None}
        parent = extra.get("parent_comment_id")
        if parent is not None and not isinstance(parent, dict | list) and text(parent) in seen:
            out.add((pos, "reply", text(parent)))
        if extra.get("comment_id") is not None and not isinstance(extra["comment_id"], dict | list):
            seen.add(text(extra["comment_id"]))
    return out


def rows(df):
    return sorted((r.file_id, r.place, r.child, r.child_key) for r in df.collect())


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_tables_against_brute_force(spark, size):
    docs = spark.read.parquet(f"/root/testdata/{size}/topic_docs.parquet")
    want = sorted((r.file_id, *x) for r in docs.collect() for x in brute(r.raw))
    assert rows(child_records(docs, "file_id", "raw")) == want


CASES = [
    '{"comments":[{"extra":{"comment_id":5,"details":{"a":{"b":{},"c":null},"d":[{"e":1}]},"breadcrumb":[null,"x"]}},7,{"authors":{"name":"n"},"extra":{"parent_comment_id":"5"}}]}',
    '{"comments":[{"authors":[null,{"family":"K","given":"A"},"x"],"extra":{"parent_comment_id":"9","comment_id":"9"}}]}',
    '{"comments":{}}', "[]", '{"comments":[NaN]}', '{"comments":[{"a":1}]} x', "", None, '{"a":"\\ud800","comments":[{"authors":["\\ud800"]}]}',
    '{"comments":[],"comments":[{}]}', "[" * 100_000, '{"comments":[{"data":"' + "é" * 200_000 + '"}]}',
]


def test_edges(spark):
    docs = spark.createDataFrame([(i, c, "clash", 1) for i, c in enumerate(CASES)], "file_id bigint, raw string, node string, child int")
    want = sorted((i, *x) for i, c in enumerate(CASES) if c is not None for x in brute(c))
    assert rows(child_records(docs, "file_id", "raw")) == want
    assert child_records(docs.limit(0), "file_id", "raw").count() == 0
    twice = shred(docs.union(docs), "file_id", "raw").count()
    assert twice == 2 * shred(docs, "file_id", "raw").count()


def test_flat_tables_keep_links(spark):
    docs = spark.createDataFrame([(i, c) for i, c in enumerate(CASES)], "file_id bigint, raw string")
    tables = flat_tables(docs, "file_id", "raw")
    got = sorted((r.file_id, r.comment_pos, r.place, r.name, r.family) for r in tables["authors"].collect())
    assert (0, 2, 0, "n", None) in got and (1, 0, 1, None, "K") in got
    assert [(r.file_id, r.comment_pos, r.parent_pos) for r in tables["replies"].collect()] == [(0, 2, 0)]
    assert sorted((r.name, r.value) for r in tables["details"].collect()) == [("a/c", None), ("d", None)]
    assert tables["comments"].filter("file_id = 0 and comment_pos = 0").first().comment_id == "5"


def test_flat_tables_are_queries(spark, sf_dir):
    from rosta.plans.general import QUERIES

    found = {r.child: r["count"] for r in QUERIES["p2_found"](spark, sf_dir).groupBy("child").count().collect()}
    got = {name: QUERIES[f"p2_{name}"](spark, sf_dir).count() for name in ("comments", "authors", "details", "crumbs", "replies")}
    children = ("comment", "author", "detail", "crumb", "reply")
    assert got == dict(zip(got, [found.get(c, 0) for c in children], strict=True))
