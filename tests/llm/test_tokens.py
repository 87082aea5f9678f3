"""Our encoding against the public library, on all documents and on awkward strings."""

import random

import pytest

from rosta.llm.tokens import TOKENIZERS, encode, encoder, token_counts

ODD = ["", " ", "  ", "\n", "a's b're c'll 's 'S ' 'd", " 's", "x''s", "'re're'", "1'd2", "  \n x", "a \n\n b  ", "<|endoftext|>", "é̈ ﬁ ½²", "日本語 テスト", "​ 　x　", "'", "''", "a'", "'l", "I'lll", "\r\n\r\n", "🙂🙂 🇭🇺", "'ve\n've", "a" * 5000, "xyz " * 30, "!?" * 200, "  \u0085 a", "á'ſ"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return t


def check(texts, library):
    coder = encoder(f"{TOKENIZERS}/byte_bpe_50k.tiktoken")
    ids, bounds, _ = coder.encode_batch(texts)
    got = [ids[bounds[i] : bounds[i + 1]].tolist() for i in range(len(texts))]
    want = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    bad = [(t, g, w) for t, g, w in zip(texts, got, want, strict=True) if g != w]
    assert not bad, bad[0]
    assert all(coder.decode(g) == (t or "") for g, t in zip(got, texts, strict=True))


def test_odd_strings(library):
    check(ODD + [None], library)
    rng = random.Random(5)
    alphabet = "aés'trevlmd  \n\t1٣½!.-ő🙂 　日"
    check(["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(4000)], library)


def test_all_documents(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r.ids for r in encode(docs, "doc_id", "text").collect()}
    rows = docs.select("doc_id", "text").collect()
    want = library.encode_batch([r.text or "" for r in rows], add_special_tokens=False)
    assert len(got) == len(rows)
    assert all(got[r.doc_id] == w.ids for r, w in zip(rows, want, strict=True))


def test_edges(spark):
    df = spark.createDataFrame([(1, None, 7), (2, "", 7), (3, "a b", 7), (3, "a b", 7), (None, "it's", 7)], "k int, t string, ids int")
    rows = sorted((str(r.k), r.ids, r.offsets) for r in encode(df, "k", "t", offsets=True).collect())
    assert [(k, len(i), o) for k, i, o in rows] == [("1", 0, []), ("2", 0, []), ("3", 2, [0, 1]), ("3", 2, [0, 1]), ("None", 2, [0, 2])]
    assert encode(df.limit(0), "k", "t").count() == 0


def test_counts_of_every_tokenizer(spark):
    df = spark.createDataFrame([(1, "Szia világ"), (2, None)], "k int, t string")
    names = ["byte_bpe_50k", "byte_bpe_multi_50k", "word_bpe_49k", "piece_bpe_32k"]
    rows = token_counts(df, "k", "t", names).collect()
    assert len(rows) == 8 and all((r.tokens > 0) == (r.k == 1) for r in rows)
