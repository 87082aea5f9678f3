"""Scores against the labelled log, spellings, context, and edge cases."""

from collections import Counter

import pytest

from rosta.llm.abuse import LEAST, Trie, fold, rates, score, scored


def test_moderation_log(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/moderation_log.parquet").collect()
    right = Counter((r.verdict == "remove") == (score(r.text)[0] >= LEAST) for r in rows)
    assert right[True] >= 0.98 * len(rows)


SPELLINGS = ["hülye", "HÜLYE", "hulye", "hüüüülye", "h.ü.l.y.e", "h ü l y e", "h***e", "hüly3"]


@pytest.mark.parametrize("word", [*SPELLINGS, "k r e t é n", "szarházi", "5z4rház1", "szharházi", "degeneráltt"])
def test_spellings(word):
    assert score(f"Na, te {word}, ehhez meg mit konyítasz?")[0] >= LEAST


@pytest.mark.parametrize("text", ["A használati utasítás hülyebiztos.", "A baromfi udvarban 7 jérce van.", "A meztelen csigák ellen a hamu vált be.", "A csibék szexálása.", "Marha jó lett a pörkölt, a disznó hízik.", "Verjük be a karót, öljük ki a gyomot.", 'A „hülye” szó jelentése.', "Három helyen jó.", "te a kombájnt akarod eladni", ""])
def test_ordinary_words(text):
    assert score(text)[0] < LEAST


def test_trie_is_the_levenshtein_distance():
    def distance(a, b):
        row = [*range(len(b) + 1)]
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    words = ["kutya", "kuty", "macska", "makk", "maci"]
    trie = Trie(words)
    for w in ("kuta", "mak", "macsak", "xxx", ""):
        assert sorted(trie.near(w, 2)) == sorted((t, distance(w, t)) for t in words if distance(w, t) <= 2)


def test_edges(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "Te hülye!", "b"), (3, "Te hülye!", "b"), (None, "x" * 300_000, None)]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "id int, t string, o string, score double")
    got = scored(df, "id", "t").collect()
    assert sorted((r.id or 0, r.score >= LEAST) for r in got) == [(0, False), (1, False), (2, False), (3, True), (3, True)]
    assert {r.o: (r.texts, r.abusive) for r in rates(df, "id", "o", "t").collect()} == {"a": (2, 0), "b": (2, 2), None: (1, 0)}
    assert scored(df.limit(0), "id", "t").count() == 0
    assert fold("Árvíz  X") == "arviz x"


@pytest.mark.parametrize("text", ["Egy rohaddek vagy.", "Te huyle, ehhez mit értesz?", "Idoita vagy, hallgass.", "Micsoda barrom vagy.", "Bnukó vagy, te.", "Hülje, aki ezt írta, te vagy az.", "you are a mroon", "Szarházzi, menj innen, vagy szólok."])
def test_misspelled_anywhere(text):
    assert score(text)[0] >= LEAST


@pytest.mark.parametrize("text", ["Te három helyen keresd, vagy itt.", "Durva vagy kurta legyen, te döntesz.", "You know where the shore is.", "Te is láttál hattyút, vagy csak szajkó volt?", "Ha neked jó helye van, vagy marad."])
def test_ordinary_words_near_a_term(text):
    assert score(text)[0] < LEAST


def test_swaps_are_one_edit():
    trie = Trie(["hulye", "idiota"])
    assert trie.near("huyle", 1, True) == [("hulye", 1)] and trie.near("huyle", 1) == []
    assert trie.near("idoita", 1, True) == [("idiota", 1)] and trie.near("diiota", 1, True) == [("idiota", 1)] and trie.near("idioat", 1, True) == [("idiota", 1)]


def test_frequent_words_are_no_misspellings(spark):
    rows = [(i, "Te a moson ülsz.") for i in range(6)] + [(6, "Te moran!")]
    assert {r.id: r.score >= LEAST for r in scored(spark.createDataFrame(rows, "id int, t string"), "id", "t").collect()} == {**{i: False for i in range(6)}, 6: True}


def test_strongest_occurrence_counts():
    text = "Azt írtad: „idióta” szó. " + "Ma sokat esett, és a kerti munka elmaradt a hétvégén. " * 2
    assert score(text)[0] < LEAST <= score(text + "Te vagy az idióta.")[0]
