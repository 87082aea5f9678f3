"""The one form against the standard library's normalisation and a pairwise comparison."""

import random
import unicodedata

from rosta.llm.lookalikes import INVISIBLE, LOOKALIKES, canonical, canonical_by_joins, lookalike_classes, lookalike_pairs, unify

PLAIN = {c: latin for latin, others in LOOKALIKES.items() for c in others}


def brute(text):
    """Step by step, one character at a time."""
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    text = "".join(c for c in text if not any(a <= ord(c) <= b for a, b in INVISIBLE))
    out = ""
    for c in text:
        given = unicodedata.decomposition(c)
        wide = given.startswith(("<wide>", "<narrow>")) or given in ("<compat> 0020", "<noBreak> 0020") or c in "ﬁﬂⅣµ"
        out += unicodedata.normalize("NFKD" if wide else "NFD", c)
    return unicodedata.normalize("NFC", "".join(PLAIN.get(c, c) for c in unicodedata.normalize("NFD", out)))


def test_random_strings():
    rng = random.Random(3)
    alphabet = "aeoőű áÁ\n\r\t²½ｅＡ１　  ​﻿̧̣́̈̋аеоӧёՏոӏԁ日本각각ﬁⅣµ-‑ß"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(6000)]
    got = unify([*texts, None, ""])
    assert got[-2:] == [None, ""]
    bad = [(t, g, brute(t)) for t, g in zip(texts, got, strict=False) if g != brute(t)]
    assert not bad, [ascii(x) for x in bad[0]]
    assert unify(got) == got


def test_all_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [r for r in docs.collect() if r.text is not None]
    keep = [r for r in rows if "‍" not in r.text]
    got = {r.doc_id: r.canonical for r in canonical(docs, "doc_id", "text").collect()}
    assert all(got[r.doc_id] == brute(r.text) for r in keep)
    want = {(a.doc_id, b.doc_id) for a in rows for b in rows if a.doc_id < b.doc_id and len(got[a.doc_id]) == len(got[b.doc_id]) and got[a.doc_id] == got[b.doc_id] and a.text != b.text and got[a.doc_id].strip()}
    found = [(r.doc_a, r.doc_b) for r in lookalike_pairs(docs, "doc_id", "text").collect()]
    assert sorted(found) == sorted(want)


def test_edges(spark):
    texts = ["Tornyó", "Tornyó", "Тоrnyó", "tornyó", "Tornyó ", "Tornyó", "​", " ", "", None, "x" * 200_000, "ｘ" + "x" * 199_999, "👩‍🌾", "👩🌾", "m²", "m2"]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "k int, t string, look string")
    pairs = sorted((r.doc_a, r.doc_b) for r in lookalike_pairs(df, "k", "t").collect())
    assert pairs == [(0, 1), (0, 2), (1, 2), (1, 5), (2, 5), (10, 11)]
    assert lookalike_pairs(df.limit(0), "k", "t").count() == 0
    assert lookalike_pairs(df.union(df), "k", "t").count() == len(pairs)
    assert [r.canonical for r in canonical(df.filter("k in (8, 9)"), "k", "t").orderBy("k").collect()] == ["", None]


def test_quads_are_spaces():
    assert unify(["a\u2000b", "a\u2001b", "a\u2002b", "a\u2003b", "a b"]) == ["a b"] * 5


def test_joins_give_the_same_form(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").filter("text is null or not text rlike '\\u200d'")
    by_joins, by_arrays = ({r.doc_id: r.canonical for r in f(docs, "doc_id", "text").collect()} for f in (canonical_by_joins, canonical))
    bad = [(k, v, by_joins.get(k)) for k, v in by_arrays.items() if by_joins.get(k) != v]
    assert not bad, ascii(bad[0])


def test_classes_and_pairs_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    pairs = [(r.doc_a, r.doc_b) for r in lookalike_pairs(docs, "doc_id", "text").collect()]
    rows = lookalike_classes(docs, "doc_id", "text").collect()
    links = {}
    for a, b in pairs:
        links[a], links[b] = links.get(a, 0) + 1, links.get(b, 0) + 1
    assert {r.doc_id: r.links for r in rows} == links
    of = {r.doc_id: (r.class_id, r.variant_no) for r in rows}
    assert all(of[a][0] == of[b][0] and of[a][1] != of[b][1] for a, b in pairs)
    assert lookalike_classes(docs.limit(0), "doc_id", "text").count() == 0


def test_more_look_alikes():
    assert unify(["ꓮꓐꓚ", "Αα", "ꓝꓖꓣ"]) == ["ABC", "Aa", "FGR"]
