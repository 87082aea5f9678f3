"""Statistics against a plain count, the prose model, and edge cases."""

import random

import numpy as np
from pyspark.sql import functions as F

from rosta.llm.quality import LEAST, STATISTICS, core, measured, scored, statistics

COMMON = [("hu", w) for w in ("a", "az", "és", "hogy", "nem", "is", "egy", "de", "ha")] + [("en", w) for w in ("the", "and", "is", "of", "it")]
PROSE = "Az {} már a múlt héten is {} volt, de nem hiszem, hogy ez egy nagy baj. Ha {} lesz, akkor is jó, és nem kérek {} helyette."
WORDS = "eke kapa motor gumi kuplung fék rugó lánc panel szűrő régi szép nagy apró ritka".split()


def prose(rng):
    text = " ".join(PROSE.format(*rng.choices(WORDS, k=4)) for _ in range(rng.randrange(1, 4)))
    return text.lower().replace(",", "").replace(".", "") if rng.random() < 0.35 else text


def test_statistics_by_plain_count():
    table = {"a": 1, "az": 1, "the": 2}
    text = "Az eke, a kapa.\nThe X9\n\n12 kg"
    values, counts, language = statistics([text, "??"], table, 2)
    got = dict(zip(STATISTICS, values[0], strict=True))
    assert counts[0].tolist() == [len(text), 8, 3] and language.tolist() == [0, -1]
    assert np.isclose(got["common_share"], 2 / 8) and np.isclose(got["digit_ratio"], 3 / len(text)) and np.isclose(got["end_share"], 1 / 3)
    assert np.isclose(got["mixed_share"], 2 / 8) and np.isclose(got["separator_rate"], 1 / 8) and got["symbol_ratio"] == 0
    assert np.isclose(got["vowel_share"], 7 / 16)


def test_lists_and_junk_are_far_from_prose(spark):
    rng = random.Random(2)
    good = [prose(rng) for _ in range(400)]
    bad = [
        "\n".join(f"- {rng.choice(WORDS)} {rng.randrange(60)} db" for _ in range(8)), "Szín: 8 cm\nSúly: 5 kg\nÁr: 7 Ft\nÉv: 2015\nHossz: 4 m", "a | b | c\n1 | 2 | 3\n4 | 5 | 6\n7 | 8 | 9\nx | y | z", "eladó " * 20,
        "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(150)), "?!" * 40, "🚜 " * 30, "\n".join(f"https://kep.example/{rng.randrange(10**6)}" for _ in range(8)) + "\nHívj: 06 30 123 45 67",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)], "id int, t string")
    rows = {r.id: r for r in scored(df, ["id"], "t", COMMON).collect()}
    assert [i for i in range(len(bad)) if rows[len(good) + i].distance < LEAST] == []
    assert np.mean([rows[i].distance >= LEAST for i in range(len(good))]) < 0.03
    assert all(abs(sum(r.contributions) - r.distance) < 1e-6 * max(1, r.distance) for r in rows.values())


def test_no_length_decides(spark):
    """Prose of 50 to 5,000 words, on one line and in paragraphs, under the model of the posts; lists of any length beside it."""
    folder, rng = "/root/testdata/sf0.01", random.Random(5)
    common = [(r.lang, r.word) for r in spark.read.parquet(f"{folder}/common_words.parquet").collect()]
    posts = [(None, r.data) for r in spark.read.parquet(f"{folder}/comments.parquet").filter("length(data) between 20 and 2000").select("data").collect()]
    pieces = [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").filter("lang = 'hu' and kind = 'post' and length(text) between 60 and 400").collect()]
    judged = {r.id: r.distance for r in scored(spark.createDataFrame([*enumerate(pieces), *posts], "id int, t string").filter("id is not null or t is not null"), ["id"], "t", common).collect() if r.id is not None}
    pieces = [" ".join(p.split()) for i, p in enumerate(pieces) if judged.get(i, 99) < 15 and "\n" not in p and p[0].isupper() and p.rstrip()[-1] in ".!?"]
    long = []
    for size in (50, 200, 400, 800, 1600, 5000):
        for joint in (" ", "\n", "\n\n"):
            text = rng.choice(pieces)
            while len(text.split()) < size:
                text += joint + rng.choice(pieces)
            long.append(text)
    lists = ["\n".join(f"- {rng.choice(WORDS)} {rng.randrange(60)} db" for _ in range(n)) for n in (8, 100, 1000)]
    rows = {r.id: r.distance for r in scored(spark.createDataFrame([*enumerate(long + lists), *posts], "id int, t string"), ["id"], "t", common).collect()}
    assert [(len(long[i].split()), rows[i]) for i in range(len(long)) if rows[i] >= LEAST] == []
    assert min(rows[len(long) + i] for i in range(len(lists))) >= LEAST


def test_contact_data_at_any_length():
    for size in (50, 189, 209, 400):
        text = ("szép " * size)[:size].strip()
        assert core(f"{text} 06 30 123 45 67").strip() == text
        assert core(f"{text}\n06 30 123 45 67\nkis@posta.test\n06 30 123 45 67\n06 30 123 45 67\nFő utca 2\n{'e' * 200}@posta.test") == text


def test_core_and_edges(spark):
    assert core("Kapcsolat: Kisi Béla\nTelefon: 06 30 123 45 67\n- a\n- b") == "- a\n- b"
    assert core("06 30 123 45 67\nkis@posta.test") != ""
    rows = [(1, None), (2, ""), (3, "rövid"), (4, " " * 50), (5, "x" * 100_000), (6, "Ez egy elég hosszú mondat, nem lista."), (6, "Ez egy elég hosszú mondat, nem lista."), (None, "Ez egy elég hosszú mondat, nem lista.")]
    df = spark.createDataFrame(rows, "id int, t string").withColumn("words", F.lit("clash")).withColumn("distance", F.lit(0))
    out = scored(df, ["id"], "t", COMMON).collect()
    assert sorted(r.id or 0 for r in out) == [0, 5, 6, 6]
    assert scored(df.limit(0), ["id"], "t", COMMON).count() == 0
    assert measured(df, ["id"], "t", []).count() == 4


def test_every_text_has_a_row(spark):
    long = "Kapcsolat: Kisi Béla\nTelefon: 06 30 123 45 67\n" + PROSE.format(*WORDS[:4])
    rows = [(1, None, False), (2, "", False), (3, " \n ", False), (4, "rövid", False), (5, "06 30 123 45 67", False), (6, long, False), (7, "The best of it is the end and the rest.", True), (7, "&nbsp;", False), (None, "rövid", False)]
    rows += [(10 + i, prose(random.Random(i)), False) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, t string, mail boolean")
    out = scored(df, ["id", "mail"], "t", COMMON, least=None, within="not mail and text_chars >= 20").collect()
    assert len(out) == len(rows)
    at = {(r.id, r.mail): r for r in out}
    assert at[1, False].text_chars is None and at[1, False].text_statistics is None and at[1, False].words == 0 and at[1, False].distance is None
    assert all(at[k, False].text_chars == n and at[k, False].words == at[k, False].text_lines == 0 and at[k, False].distance is None for k, n in ((2, 0), (3, 3), (7, 6)))
    assert all(abs(sum(at[k].contributions) - at[k].distance) < 1e-6 * max(1, at[k].distance) for k in ((4, False), (5, False), (7, True), (None, False)))
    assert at[5, False].contact and at[5, False].text_words == at[5, False].words == 5 and not at[6, False].contact
    values, counts, _ = statistics([long], {w: 1 for _, w in COMMON[:9]}, 1)
    assert [at[6, False][c] for c in ("text_chars", "text_words", "text_lines")] == counts[0].tolist() and at[6, False].lines == 1
    assert np.allclose(at[6, False].text_statistics, values[0])


def test_query_has_all_texts(spark, sf_dir):
    from rosta.llm.queries import p7_found, p7_statistics

    got = p7_statistics(spark, sf_dir)
    tables = [spark.read.parquet(f"{sf_dir}/{t}.parquet").select(F.lit(t).alias("src"), "row_id", F.col(c).alias("t")) for t, c in (("comments", "data"), ("ad_details", "description"))]
    texts = tables[0].unionByName(tables[1])
    assert got.count() == texts.count() and texts.join(got, ["src", "row_id"], "left_anti").count() == 0
    assert got.join(texts.filter("length(t) > 0 and t rlike '[a-z]'"), ["src", "row_id"]).filter("distance is null or text_chars <> length(t)").count() == 0
    found = p7_found(spark, sf_dir).join(got.filter("not mail and text_chars >= 20"), ["src", "row_id"], "left_anti")
    assert found.count() == 0
