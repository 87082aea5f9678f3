"""Core operators on literal cases."""

import json

import pytest
from pyspark.sql import functions as F

from rosta.functions import predicates, text, urls
from rosta.operators import corpus, html, items, paging, state
from rosta.sources import readers, writers
from rosta.streaming import loads


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("column", "value", "want"),
    [
        (text.clean_text, "a\r\n\n\n\nb \tc ", "a\n\nb c"),
        (text.clean_text, None, ""),
        (lambda x: text.clean_text(x, "both"), "a  \n  b", "a\nb"),
        (text.clean_multiline, " a \r\n\n  b", "a\nb"),
        (text.one_line, " a  \n\x1cb ", "a b"),
        (text.count_words, "egy  kettő\nhárom", 3),
        (lambda x: text.preview(x, 10), "abcdefghijk", "abcdefg..."),
        (text.first_integer, "1.234 hsz", 1234),
        (text.first_integer, "-5", -5),
        (text.first_integer, "9" * 30, None),
        (lambda x: text.first_integer(x, False), "-5", 5),
        (text.last_integer, "a1b22", 22),
        (text.last_integer, "x", None),
        (lambda x: text.split_name(x)["given"], "Nagy Bela Pal", "Bela Pal"),
        (lambda x: text.split_name(x)["name"], "", ""),
        (lambda x: text.safe_file_name(x), "Árvíz: a/b?", "Arviz - a-b"),
        (lambda x: text.safe_file_name(x), None, "ismeretlen"),
        (text.without_quote_lines, "Béla írta:\n> x\n„Szia”", "Szia"),
        (lambda x: text.reply_header(x)["parent"], "A válasza B C hozzászólására (#12)", "B C"),
        (text.html_head, "<HTML><head a>x</head>", "<head a>x</head>"),
        (urls.without_fragment, "https://a.test/x?y=1#c", "https://a.test/x?y=1"),
        (lambda x: urls.query_param(x, "q"), "https://a.test/?p=1&q=a%20b", "a b"),
        (lambda x: urls.query_param(x, "q"), "https://a.test/?q=&q=2", "2"),
        (lambda x: urls.query_param(x, "q"), "https://a.test/?q=a=b&q=c#?q=d", "a=b"),
        (lambda x: urls.query_param(x, "q"), "https://a.test/?r=1?q=2", None),
        (lambda x: urls.query_param(x, "q"), "https://a.test/?q=5%", "5%"),
        (lambda x: urls.without_param(x, "p"), "https://a.test/?p=1&p=2", "https://a.test/"),
        (lambda x: urls.without_param(x, "p"), "https://a.test/?P=1&p=2&pp=3", "https://a.test/?P=1&pp=3"),
        (lambda x: urls.kept_params(x, ("t", "a")), "https://a.test/X/?a=1&b=2&t=3#c", "https://a.test/X?t=3&a=1"),
        (lambda x: urls.visited_key(x, "page"), "https://A.test/x?p=7&page=3#c", "https://A.test/x?p=7"),
        (lambda x: urls.visited_key(x, "path"), "https://A.test/X/?p=7#c", "https://A.test/X"),
        (lambda x: urls.visited_key(x, "range"), "https://a.test/t/HSZ_1-100.html/#m", "https://a.test/t"),
        (lambda x: urls.ad_key(F.lit(" 5 "), F.lit("u"), x), "T", "uadid:5"),
        (lambda x: urls.ad_key(F.lit(None), F.lit(""), x), " Régi Ágy", "title:Régi Ágy"),
        (urls.resume_url, "https://a.test/?na_start=30&na_step=030&t=1#c", "https://a.test/?na_start=60&na_step=30&t=1"),
        (urls.resume_url, "https://a.test/?na_start=x&na_step=30", None),
        (lambda x: urls.without_param(x, "p"), "https://a.test/?p=1&q=2#z", "https://a.test/?q=2"),
        (urls.visited_key, "https://A.test/x/?page=3#c", "https://A.test/x/?page=3"),
        (urls.previous_range, "https://a.test/t/hsz_201-300.html", "https://a.test/t/hsz_101-200.html#msg201"),
        (urls.previous_range, "https://a.test/t/hsz_1-100.html", None),
        (urls.next_start, "https://a.test/?na_start=30&na_step=30", 60),
        (urls.ad_id, "https://a.test/x_3502.html", "3502"),
        (urls.ad_id, "https://a.test/a9/b7", "7"),
        (lambda x: urls.with_param(x, F.lit("page"), F.lit("4")), "https://a.test/?page=1&q=2&z=#c", "https://a.test/?page=4&q=2"),
        (lambda x: urls.absolute(F.lit("https://a.test/b/c"), x), "../d", "https://a.test/d"),
        (predicates.page_class, "<title>404</title>", "missing"),
        (predicates.page_class, '<div class="msg x">', "messages"),
        (predicates.seller_like, "Color:ff00ff", False),
        (lambda x: predicates.title_has(x, "100%"), "Ez 100% jó", True),
        (predicates.seller_like, "Kis Béla (12)", True),
        (predicates.seller_like, "Eladó termékei", False),
        (predicates.seller_like, "Anna 2024.01.02. 10:11:12", False),
        (predicates.page_class, '<div class="msg x">nincs találat</div>', "messages"),
        (predicates.page_class, "Nincs találat.", "empty"),
        (predicates.page_class, "<p>Sorry, EXCESSIVE load policy", "overload"),
        (predicates.page_class, "<title>Captcha!</title>", "captcha"),
        (predicates.page_class, None, None),
        (predicates.body_text, "2024-01-02 10:11:12\n#5\nVálasz erre\nválasz Kis Béla #4. hozzászólására\n egy  kettő\n2024.01.02.", "egy kettő\n2024.01.02."),
        (predicates.paragraph, "Leírás", False),
        (predicates.paragraph, "Megosztás Facebookon", False),
        (predicates.paragraph, "Szép leírás", True),
        (predicates.resolved_title, "Álláskeresés", False),
        (predicates.resolved_title, "Eke", True),
        (lambda x: predicates.product_url(x, "a.test"), "https://www.A.test/x_1.HTML?y=1", True),
        (lambda x: predicates.product_url(x, "a.test"), "/index-c12.html", False),
        (lambda x: predicates.product_url(x, "a.test"), "https://b.test/x.html", False),
        (lambda x: predicates.topic_link(x, F.lit("Eke")), "/Forum/1", True),
        (lambda x: predicates.topic_link(x, F.lit(" Belépés ")), "/forum/1", False),
        (lambda x: predicates.topic_link(x, F.lit("Eke")), "#/forum/", False),
        (predicates.no_pagination, "https://a.test/x__oldal-2", False),
        (lambda x: predicates.kept_comment(x, F.lit("1"), F.lit(None), F.lit(None), "id"), " ", True),
        (lambda x: predicates.kept_comment(x, F.lit("1"), F.lit(None), F.lit(None), "body"), " ", False),
        (lambda x: text.safe_file_name(x), "a" * 179 + "." + "b", "a" * 179),
        (lambda x: text.reply_header(x)["parent"], "Kis Béla (válaszként erre: 12. - Nagy)", "Nagy"),
        (lambda x: text.reply_header(x)["number"], "Kis Béla (válaszként erre: 12. - Nagy)", 12),
        (lambda x: text.reply_header(x)["parent"], "Válasz Nagy Pál #7. hozzászólására", "Nagy Pál"),
        (lambda x: text.reply_header(x)["parent"], "tegnap Előzmény Nagy Pál", "Nagy Pál"),
        (lambda x: text.reply_header(x)["author"], "#13 Kis > Nagy #12 2024", "Kis"),
        (lambda x: text.reply_header(x)["author"], "semmi", None),
        (text.without_quote_lines, "valami [/quote]\n\nSzia", "Szia"),
        (lambda x: text.answer_author(x, F.lit("")), "2/5 Mad Max2 válasza:", "Mad Max2"),
        (lambda x: text.answer_author(x, F.lit("")), "Egy ANONIM felelt", "anonim"),
        (lambda x: text.answer_author(x, F.lit(None)), None, "ismeretlen"),
        (lambda x: text.bare_title(x, ("Fórum A",)), "Téma: Eke (beszélgetés)", "Eke"),
        (lambda x: text.bare_title(x, ("Fórum A",)), "Eke - Fórum A - 2. oldal", "Eke"),
        (lambda x: text.bare_title(x, (), True), "Eke 1 200 db", "Eke"),
        (text.author_line, "#12\nŐstag\nkis bela\nx", "kis bela"),
        (lambda x: text.last_activity(x)["user"], "kis bela tegnap 10:11", "kis bela"),
        (lambda x: text.last_activity(x)["user"], "2024. máj. 1. 10:11 kis bela", "kis bela"),
        (lambda x: text.last_activity(x)["message"], "régen", "régen"),
        (lambda x: text.index_of_total(x)["total"], "x (3 / 40)", 40),
        (lambda x: text.shown_count(x, "items"), "1. oldal / 2 407 összesen", 2407),
        (lambda x: text.shown_count(x, "likes"), "Nem tetszik 3", 3),
        (lambda x: text.shown_count(x, "comments"), "Hozzászólások: 1.234", 1234),
        (text.largest_number, "12 és 1.234 meg 7", 1234),
        (lambda x: text.dated_node(F.split(x, ";")), "ma;x;10:11;y", "10:11"),
        (lambda x: text.dated_node(F.split(x, ";")), "Tegnap;mama", "Tegnap"),
        (lambda x: text.cell(F.split(x, ";"), 3, 4), "a;b;c;d", "d"),
        (lambda x: text.cell(F.split(x, ";"), 3, 4), "a;b", None),
        (lambda x: text.unique_blocks(F.split(x, ";")), "a;b;a", "a\n\nb"),
        (lambda x: corpus.closed(x), '{"comments": [\n]\n}\n', True),
        (lambda x: corpus.closed(x), '{"comments": [ {', False),
        (lambda x: corpus.closed(x, "status"), '{"comments":[],"extra":{"scrape_status":"finished"}}', True),
        (lambda x: corpus.closed(x, "status"), '{"comments":{},"extra":{"scrape_status":"finished"}}', False),
        (corpus.has_items, '{"comments": [ ]}', False),
        (lambda x: corpus.last_saved(x)["offset"], '{"list_offset": 50, "list_offset": 150}', 150),
        (corpus.repaired, '{"comments": [\n,\n  {"a":1},\n,{"b":2}]}', '{"comments": [\n\n  {"a":1},\n,{"b":2}]}'),
        (corpus.repaired, '{"comments": [ ,{"a":1}]}', '{"comments": [ ,{"a":1}]}'),
        (corpus.repaired, '{"comments": [\r\n ,{"a":1}]}', '{"comments": [\r\n{"a":1}]}'),
        (lambda x: corpus.last_field(x, "url"), '{"url": "a", "x": {"url":"b"}}', "b"),
    ],
)
def test_scalars(spark, column, value, want):
    assert one(spark, value, column) == want


def test_resume_policies(spark):
    rows = [("t", 1, 0, "11"), ("t", 1, 1, "12"), ("t", 2, 0, "21"), ("t", 2, 1, "22"), ("t", 2, 2, "23"), ("t", 3, 0, "31"), ("u", 1, 0, "1")]
    df = spark.createDataFrame(rows, "topic string, page int, pos int, id string")

    def ids(page, marker, policy):
        m = spark.createDataFrame([("t", page, marker)], "topic string, _page int, _marker string")
        return sorted(r.id for r in state.resumed(df, m, "topic", "page", "pos", "id", policy).filter("topic = 't'").collect())

    assert ids(2, "22", "new") == ["23", "31"] and ids(2, "99", "new") == ["21", "22", "23", "31"]
    assert ids(1, "21", "advance") == ["22", "23", "31"] and ids(1, "99", "advance") == []
    assert ids(2, "99", "skip") == ["31"] and ids(2, "22", "skip") == ["23", "31"]
    none = spark.createDataFrame([], "topic string, _page int, _marker string")
    assert state.resumed(df, none, "topic", "page", "pos", "id", "skip").count() == len(rows)


def test_guards(spark):
    pages = spark.createDataFrame([("t", n, f, r) for n, f, r in ((1, "a", 2), (2, "b", 1), (3, "a", 0), (4, "c", 1))], "topic string, page int, fingerprint string, rows int")
    assert sorted(r.page for r in state.until_repeat(pages, "topic", "page").collect()) == [1, 2]
    runs = spark.createDataFrame([("t", i, n) for i, n in enumerate([1, 0, 0, 1, 0, 0, 0, 1])], "topic string, page int, n int")
    assert sorted(r.page for r in state.until_empty_run(runs, "topic", "page", "n").collect()) == [0, 3]
    firsts = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 3, "z")], "k string, o int, v string")
    assert sorted((r.k or "", r.v) for r in state.first_of(firsts, ["k"], ["o"]).collect()) == [("", "z"), ("a", "y")]
    seen = spark.createDataFrame([("a",), (None,)], "k string")
    assert [r.k for r in state.unvisited(firsts, F.col("k"), seen, F.col("k")).collect()] == [None]


def test_corpus_tools(spark):
    raws = ['{"data":{"content":"egy kettő"},"comments":[{"data":"három"},{"data":5}]}', '{"data":null}', '{"comments":["x"]}', '{"comments":{}}', "[1]", "{", None, '{"a":NaN}', '{"data":{"content":"négy"},"comments":null}']
    docs = corpus.documents(spark.createDataFrame([*enumerate(raws)], "id int, raw string"), "id", "raw").cache()
    assert [r.status for r in docs.orderBy("id").collect()] == ["complete"] * 5 + ["badformat"] * 2 + ["complete"] * 2
    assert {r.id: r.words for r in corpus.word_counts(docs, "id").collect()} == {0: 3, 3: 0, 7: 0, 8: 1}
    assert {r.status: r.files for r in corpus.totals(docs).collect()} == {"complete": 7, "badformat": 2, None: 9}
    assert tuple(corpus.word_totals(docs).first()) == (4, 4, 5) and tuple(corpus.word_totals(docs.limit(0)).first()) == (0, 0, 0)
    assert [r["item"] for r in corpus.dump(docs, "id").orderBy("id", "text_no", "place").collect()] == ["egy", "kettő", "három", "négy"]
    assert [r["item"] for r in corpus.dump(docs, "id", rows=True).orderBy("id", "text_no").collect()] == ["egy kettő", "három", "négy"]


def test_html(spark):
    page = """<table><tr class=topic><td class=title><a href="/t/1?x=1&amp;y=2">Els&ocirc; téma</a><td class=count>12</td></tr>
    <tr class="topic"><td class="title"><a href='b'>Más</a></td></tr></table><script>"</p>"</script>
    <div class="comment new" data-id="5"><b class=author>Kis A</b><div class=body>egy<blockquote>nem</blockquote><p>két<br>há</div></div>"""
    df = spark.createDataFrame([(1, page, "https://a.test/f/"), (2, None, None)], "id int, html string, url string")
    topics = html.extract(df, ["id"], "html", "url", html.TOPICS).collect()
    assert [(t.place, t.title, t.url, t.comments) for t in topics] == [(0, "Elsô téma", "https://a.test/t/1?x=1&y=2", "12"), (1, "Más", "https://a.test/f/b", None)]
    comment = html.extract(df, ["id"], "html", "url", html.COMMENTS).first()
    assert (comment.comment_id, comment.author, comment.data) == ("5", "Kis A", "egy\nkét\nhá")
    assert html.extract(df, ["id"], "html", "url", html.LINKS).count() == 2


def test_items_sources_and_sinks(spark, tmp_path):
    raw = spark.createDataFrame([("t", 1, p, str(p), a, None, 3, None, None, None, p, 2, p == 1, "u", "szia") for p, a in enumerate(["Kis Anna", "bela"])], "topic string, page int, pos int, comment_id string, author string, date string, likes int, dislikes int, rating string, parent_author string, index int, index_total int, is_offtopic boolean, url string, data string")
    docs = items.topic_documents(raw, "topic", "page", "pos", items.comment_item()).withColumn("origin", F.lit("o/p"))
    writers.write_documents(docs, str(tmp_path / "docs"))
    back = readers.document_files(spark, str(tmp_path / "docs"))
    read = json.loads(back.first().raw)
    assert [c["data"] for c in read["comments"]] == ["szia", "szia"] and read["comments"][0]["authors"][0]["family"] == "Kis" and read["comments"][1]["tags"] == ["offtopic"]
    assert read["comments"][0]["score"] == 3 and read["comments"][0]["rating"] is None
    cells = spark.createDataFrame([([["a:", "1"], ["x"], ["b", "", "2"], ["a", "3"]],)], "c array<array<string>>")
    assert cells.select(items.details(F.col("c")).alias("d")).first().d == {"b": "2", "a": "3"}
    keys = spark.createDataFrame([("a",), ("",), ("a",), ("b",)], "key string")
    assert writers.append_visited(keys, str(tmp_path / "v")).count() == 2
    writers.append_visited(keys.union(spark.createDataFrame([("c",)], "key string")), str(tmp_path / "v"))
    assert sorted(r.key for r in readers.visited(spark, str(tmp_path / "v")).collect()) == ["a", "b", "c"]
    assert [r.page for r in readers.listing_pages(spark, 100, 300, 100).collect()] == [100, 200, 300]
    with pytest.raises(ValueError):
        readers.listing_pages(spark, 50, 300, 100)


def test_stream_loads_each_key_once(spark, tmp_path):
    source, out, seen, check = (str(tmp_path / n) for n in ("in", "out", "seen", "check"))
    first = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3)], "url string, n int")
    first.write.mode("append").parquet(source)
    for _ in range(2):
        loads.load_new(loads.arriving(spark, source, first), "url", out, seen, check).awaitTermination()
        assert spark.read.parquet(out).count() == 3
    spark.createDataFrame([("b", 2), ("c", 4)], "url string, n int").write.mode("append").parquet(source)
    loads.load_new(loads.arriving(spark, source, first), "url", out, seen, check).awaitTermination()
    assert sorted(r.url or "" for r in spark.read.parquet(out).collect()) == ["", "a", "b", "c"]


def test_ranges_of_pages(spark, monkeypatch):
    monkeypatch.setattr(state, "RANGE", 3)
    numbers = [1, 2, 3, 4, 7, 8, 20, 21, 1_000_000_007]
    pages = spark.createDataFrame([("t", n, "a" if n in (3, 8) else str(n), n % 5) for n in numbers] + [("u", 5, "a", 1)], "topic string, page long, fingerprint string, rows long")
    near = {r.page: (r.p, r.n) for r in state.with_next(state.with_previous(pages, "topic", "page", "page", "p"), "topic", "page", "n").filter("topic = 't'").collect()}
    assert near == {n: (p, q) for p, n, q in zip([None, *numbers], numbers, [*numbers[1:], None], strict=False)}
    totals = {r.page: r.total for r in state.running_total(pages, "topic", "page", "rows").filter("topic = 't'").collect()}
    assert totals == {n: sum(m % 5 for m in numbers[: i + 1]) for i, n in enumerate(numbers)}
    assert sorted(r.page for r in state.until_repeat(pages, "topic", "page").filter("topic = 't'").collect()) == [1, 2, 3, 4, 7]
    assert sorted(r.page for r in state.until_empty_run(pages, "topic", "page", "rows", first=1).collect()) == [1, 2, 3, 4, 7, 8]
    assert state.until_empty_run(pages, "topic", "page", "rows", first=1).filter("topic = 'u'").count() == 0


def test_paging(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y"), ("y", None)], "page string, nxt string")
    starts = spark.createDataFrame([("a",), ("x",), ("z",)], "start string")
    walked = sorted((r.start, r.step, r.page) for r in paging.link_chain(edges, starts, "page", "nxt", 10).collect())
    assert walked == [("a", 0, "a"), ("a", 1, "b"), ("a", 2, "c"), ("x", 0, "x"), ("x", 1, "y"), ("z", 0, "z")]
    assert sorted(r.page for r in paging.link_chain(edges, starts.limit(1), "page", "nxt", 2).collect()) == ["a", "b"]
    pages = spark.createDataFrame([("t", n) for n in (1, 2, 3, 5)] + [("u", 1)], "topic string, n int")
    back = paging.walked_backwards(pages, "topic", "n", spark.createDataFrame([("t", 2)], "topic string, _last int"))
    assert sorted((r.topic, r.n, r.step) for r in back.collect()) == [("t", 2, 3), ("t", 3, 2), ("t", 5, 0), ("u", 1, 0)]
    assert one(spark, "3,7,9", lambda x: paging.next_page(F.transform(F.split(x, ","), lambda v: v.cast("int")), F.lit(6))) == 7
    assert one(spark, "3,8,9", lambda x: paging.next_page(F.transform(F.split(x, ","), lambda v: v.cast("int")), F.lit(9))) is None


def test_pages_of_each_kind(spark):
    group = '<div class="group" data-parent="g"><a class="title" href="/c/1">Gép</a><span class="topics">Témák: 12</span></div>'
    assert html.GROUPS.rows_of(group, "https://a.test/") == [{"title": "Gép", "url": "https://a.test/c/1", "topics": "Témák: 12", "comments": None, "parent": "g"}]
    page = """<html><head><title>Cím - A</title><meta property="og:title" content="Cím"></head><h2 class="title">Eke</h2><div class="opened"><b class="author">x</b><i class="date">2024</i></div>
    <div class="pager"><a href="?p=1">1</a><a href="?p=3">3</a></div><div class="comment"><div class="header" data-rating="8/10"><b class="author">A</b><span class="reply-to">B</span></div></div></html>"""
    assert html.PAGE_TITLE.rows_of(page, "")[0]["title"] == "Eke"
    assert html.PAGE_TITLE.rows_of(page.replace("h2", "div"), "")[0]["title"] == "Cím"
    assert html.TOPIC_META.rows_of(page, "")[0]["opener"] == "x"
    links = html.PAGER.rows_of(page, "https://a.test/")
    assert html.next_of_pager(links, 1) == "https://a.test/?p=3" and html.next_of_pager(links, 3) is None
    assert html.next_of_pager([*links, {"url": "n", "label": "Következő", "rel": None}], 3) == "n"
    assert html.HEADERS.rows_of(page, "")[0]["parent"] == "B" and html.HEADERS.rows_of(page, "")[0]["rating"] == "8/10"
    ad = "<h1>Eke</h1><h3>Eladó leírása a termékről</h3><div><p>Egy<br>két</p></div><p>Há</p><aside>Hirdetés</aside><p>négy</p><footer>Hasonló termékek</footer><p>nem</p>"
    assert html.between_headings(ad, "eladó leírása", ("hasonló termékek",)) == ["Egy\nkét", "Há", "négy"]
    assert html.between_headings(None, "x") == []
    bad = spark.createDataFrame([(1, '<a href="https://[x">z</a>', "https://a.test"), (2, '<a href="b">z</a>', "https://a.test")], "id int, html string, url string")
    assert [r.id for r in html.extract(bad, ["id"], "html", "url", html.LINKS).collect()] == [2]


def test_reports_and_joins(spark, tmp_path):
    docs = corpus.documents(spark.createDataFrame([("b/1", '{"comments":[{"data":"egy"}]}'), ("a", "{")], "path string, raw string"), "path", "raw")
    lines = writers.validity_report(docs, "path")
    writers.write_report(lines, str(tmp_path / "r"))
    assert [r.value for r in spark.read.text(str(tmp_path / "r")).collect() if r.value] and lines.count() == 6
    words = writers.word_report(corpus.word_counts(docs, "path"), corpus.word_totals(docs), "path")
    assert sorted(r.line for r in words.collect()) == ["", "Hibás fájlok: 1", "Sikeres fájlok: 1", "b/1 -> 1 szó", "Összesen -> 1 szó"]
    writers.word_dump(corpus.dump(docs, "path"), "path", str(tmp_path / "w"))
    assert [r.value for r in spark.read.text(str(tmp_path / "w")).collect()] == ["===== b/1 =====", "egy"]
    details = spark.createDataFrame([("u", "", None), ("v", "ismeretlen", "7"), ("w", "T", "8")], "url string, title string, ad_id string")
    cards = spark.createDataFrame([("u", "A", "1"), ("v", "B", "2")], "url string, title string, ad_id string")
    got = {r.url: (r.title, r.ad_id) for r in paging.enriched(details, cards, "url", ["ad_id"], ["title"], {"title": "ismeretlen"}).collect()}
    assert got == {"u": ("A", "1"), "v": ("B", "2"), "w": ("T", "8")}
    bytes_ = spark.createDataFrame([("aéb",), ("",), (None,)], "raw string")
    assert [r.t for r in bytes_.select(readers.tail("raw", 2).alias("t")).collect()] == ["b", "", None]
    with pytest.raises(Exception, match="fatal page"):
        one(spark, "captcha", predicates.fatal_page)


def test_shared_folder_is_required_on_a_cluster():
    from rosta.session import work_dir

    class Conf(dict):
        def set(self, key, value):
            self[key] = value

    class Session:
        conf = Conf({"spark.master": "spark://host:7077"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(Session())
