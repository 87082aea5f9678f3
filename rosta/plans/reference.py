"""Queries over the captured tables, one for each operator, each with equivalent SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosta.functions import predicates, text, urls
from rosta.functions.text import ENDS, SPACES, WORD
from rosta.operators import corpus, html, items, state
from rosta.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):  # noqa: ANN201
    """Registers a query under its name, with its SQL."""

    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def scalar(name: str, source: str, key: str, column: str, f, sql: str) -> None:  # noqa: ANN001
    """Registers a query that maps one column of a table by a scalar; ``sql`` has x for the column."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return table(spark, sf_dir, source).select(key, f(F.col(column)).alias("value"))

    QUERIES[name] = run
    ORACLES[name] = f"SELECT {key}, {sql.replace('{x}', column)} AS value FROM {source}"


def _strip(inner: str) -> str:
    """SQL of stripping."""
    return f"regexp_replace({inner}, '{ENDS}', '', 'g')"


def _clean(before: str = "", after: str = "") -> str:
    """SQL of the cleaning of text."""
    inner = "regexp_replace(translate(coalesce({x}, ''), chr(160) || chr(13), ' '), '[ \\t]+', ' ', 'g')"
    for pattern in (before, after):
        if pattern:
            inner = f"regexp_replace({inner}, '{pattern}', chr(10), 'g')"
    return _strip(f"regexp_replace({inner}, '\\n{{3,}}', chr(10) || chr(10), 'g')")


# the first pair of the query whose name is ``page`` and whose value is not blank
_PAGE_SQL = "list_filter(string_split(regexp_extract({x}, '^[^?#]*\\?([^#]*)', 1), '&'), lambda p: split_part(p, '=', 1) = 'page' AND length(p) > 5)[1][6:]"

scalar("clean_text_base", "comments", "row_id", "data", text.clean_text, _clean())
scalar("clean_text_after", "comments", "row_id", "data", lambda x: text.clean_text(x, "after"), _clean("\\n[ \\t]+"))
scalar("clean_text_both", "comments", "row_id", "data", lambda x: text.clean_text(x, "both"), _clean("\\n[ \\t]+", "[ \\t]+\\n"))
scalar("one_line_text", "ad_details", "row_id", "description", text.one_line, _strip(f"regexp_replace({{x}}, '{SPACES}', ' ', 'g')"))
scalar("word_count_per_document", "documents", "doc_id", "text", text.count_words, f"CAST(len(regexp_extract_all({{x}}, '{WORD}')) AS BIGINT)")
scalar("preview_120", "documents", "doc_id", "text", text.preview, f"CASE WHEN length({{x}}) <= 120 THEN {{x}} ELSE regexp_replace(substr({{x}}, 1, 117), '{SPACES.replace('+', '+')}$', '') || '...' END")
scalar("first_integer_signed", "topic_info", "row_id", "topic_title", text.first_integer, "TRY_CAST(nullif(regexp_extract(translate({x}, '. ', ''), '-?[0-9]+'), '') AS BIGINT)")
scalar("first_integer_unsigned", "topic_info", "row_id", "topic_title", lambda x: text.first_integer(x, False), "TRY_CAST(nullif(regexp_extract(translate({x}, '. ', ''), '[0-9]+'), '') AS BIGINT)")
scalar("last_integer_of_url", "comments", "row_id", "url", text.last_integer, "TRY_CAST(regexp_extract_all({x}, '[0-9]+')[-1] AS BIGINT)")
scalar("seller_without_rating", "ad_details", "row_id", "seller", text.without_rating, _strip("regexp_replace({x}, '\\s*\\([0-9]+\\)\\s*$', '')"))
scalar("url_without_fragment", "comments", "row_id", "url", urls.without_fragment, "split_part({x}, '#', 1)")
scalar("url_query_param", "comments", "row_id", "url", lambda x: urls.query_param(x, "page"), _PAGE_SQL)
scalar("url_page_number", "comments", "row_id", "url", urls.page_number, f"coalesce(TRY_CAST({_PAGE_SQL} AS BIGINT), 1)")
scalar("url_without_param", "comments", "row_id", "url", lambda x: urls.without_param(x, "page"), "CASE WHEN {x} IS NULL THEN NULL ELSE regexp_extract({x}, '^[^?#]*') || coalesce('?' || nullif(array_to_string(list_filter(string_split(regexp_extract({x}, '^[^?#]*\\?([^#]*)', 1), '&'), lambda p: p <> '' AND split_part(p, '=', 1) <> 'page'), '&'), ''), '') END")
scalar("url_ad_id", "ad_details", "row_id", "url", urls.ad_id, "coalesce(nullif(regexp_extract({x}, '_([0-9]+)\\.html$', 1), ''), regexp_extract_all(regexp_replace({x}, '^[a-z]+://[^/]*', ''), '[0-9]+')[-1])")
scalar("title_has_part", "topic_info", "row_id", "topic_title", lambda x: predicates.title_has(x, "TALÁLKOZÓ"), "coalesce(contains(lower({x}), 'találkozó'), false)")
scalar("address_hash", "topic_info", "row_id", "topic_url", F.sha1, "sha1({x})")
scalar("last_saved_url", "topic_docs", "file_id", "raw", lambda x: corpus.last_field(x, "url"), "nullif(regexp_extract(regexp_extract_all({x}, '\"url\"\\s*:\\s*\"[^\"]*\"')[-1], ':\\s*\"([^\"]*)\"$', 1), '')")
scalar("literal_count", "topic_docs", "file_id", "raw", lambda x: F.regexp_count(x, F.lit('"comment_id":')).cast("bigint"), "CAST(len(regexp_extract_all({x}, '\"comment_id\":')) AS BIGINT)")


@query(
    f"""SELECT row_id, CASE WHEN len(p) < 2 THEN coalesce(p[1], '') END AS name, CASE WHEN len(p) >= 2 THEN p[1] END AS family,
    CASE WHEN len(p) >= 2 THEN array_to_string(p[2:], ' ') END AS given
    FROM (SELECT row_id, regexp_extract_all(coalesce(seller, ''), '{WORD}') AS p FROM ad_details)"""
)
def split_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sellers as name parts."""
    return table(spark, sf_dir, "ad_details").select("row_id", text.split_name(F.col("seller")).alias("s")).select("row_id", "s.name", "s.family", "s.given")


@query()
def safe_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names of titles, made once for each title."""
    return table(spark, sf_dir, "topic_info").select("topic_title").distinct().select("topic_title", text.safe_file_name(F.col("topic_title")).alias("file_name"))


@query("SELECT topic_url, p AS page, CASE WHEN p <= 1 THEN topic_url ELSE topic_url || CASE WHEN contains(topic_url, '?') THEN '&' ELSE '?' END || 'page=' || p END AS url FROM (SELECT DISTINCT topic_url, CAST(page_no AS BIGINT) AS p FROM comments WHERE topic_url IS NOT NULL)")
def page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of all pages of the topics."""
    pages = table(spark, sf_dir, "comments").filter("topic_url is not null").select("topic_url", F.col("page_no").cast("bigint").alias("page")).distinct()
    return pages.withColumn("url", urls.page_url(F.col("topic_url"), F.col("page")))


@query("SELECT row_id, CASE WHEN coalesce(extra.comment_id, '') <> '' THEN split_part(url, '#', 1) || '#msg' || extra.comment_id ELSE url END AS url FROM comments")
def anchored_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of comments within their pages."""
    return table(spark, sf_dir, "comments").select("row_id", urls.anchored(F.col("url"), F.col("extra.comment_id"), "msg").alias("url"))


@query(
    """SELECT shape, count(*) AS n FROM (SELECT CASE WHEN regexp_matches(url, '(?i)_[0-9]+\\.html(?:[?#]|$)') AND regexp_matches(url, '(?i)hirdetes') THEN 'ad' WHEN regexp_matches(url, '(?i)[?&]thread_id=[0-9]+') THEN 'thread'
    WHEN contains(url, '/tema/') AND NOT contains(url, '/temak/') THEN 'topic' WHEN regexp_matches(url, '(?i)/forum/[^/]+/t[0-9]+') THEN 'topic' WHEN regexp_matches(url, '(?i)/csoport/') THEN 'list' ELSE 'other' END AS shape
    FROM (SELECT url FROM comments UNION ALL SELECT url FROM ad_details UNION ALL SELECT group_url FROM topic_info)) GROUP BY shape"""
)
def url_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses by what they lead to."""
    all_urls = table(spark, sf_dir, "comments").select("url").unionAll(table(spark, sf_dir, "ad_details").select("url")).unionAll(table(spark, sf_dir, "topic_info").select("group_url"))
    return all_urls.groupBy(urls.shape(F.col("url")).alias("shape")).agg(F.count("*").alias("n"))


@query("SELECT row_id, origin FROM comments WHERE origin IN ('mezogep_forum', 'vetito_forum') AND origin NOT IN ('vetito_forum')")
def allow_and_deny(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of allowed sites."""
    return table(spark, sf_dir, "comments").filter(predicates.allowed(F.col("origin"), ["mezogep_forum", "vetito_forum"], ["vetito_forum"])).select("row_id", "origin")


@query(
    """SELECT row_id, CASE WHEN likes IS NOT NULL OR dislikes IS NOT NULL THEN coalesce(likes, 0) - coalesce(dislikes, 0) END AS score, CASE WHEN coalesce(extra.is_offtopic, false) THEN 'offtopic' ELSE '' END AS tags,
    TRY_CAST(nullif(regexp_extract(rating, '^\\s*([0-9]+)\\s*/', 1), '') AS BIGINT) AS rated, TRY_CAST(nullif(regexp_extract(rating, '/\\s*([0-9]+)', 1), '') AS BIGINT) AS rated_of FROM comments"""
)
def comment_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score, tags and rating of comments."""
    number = lambda p: F.nullif(F.regexp_extract("rating", p, 1), F.lit("")).try_cast("bigint")
    c = table(spark, sf_dir, "comments")
    return c.select("row_id", items.vote_score(F.col("likes"), F.col("dislikes")).alias("score"), F.array_join(items.tags(F.col("extra.is_offtopic")), ",").alias("tags"), number(r"^\s*([0-9]+)\s*/").alias("rated"), number(r"/\s*([0-9]+)").alias("rated_of"))


def _comment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    author = F.coalesce(F.get("authors", F.lit(0))["name"], F.concat_ws(" ", F.get("authors", F.lit(0))["family"], F.get("authors", F.lit(0))["given"]))
    c = table(spark, sf_dir, "comments")
    extra = [F.col(f"extra.{n}").alias(n) for n in ("comment_id", "parent_author", "index", "index_total", "is_offtopic")]
    return c.select("row_id", "topic_url", "page_no", "pos", author.alias("author"), "date", "likes", "dislikes", "rating", "url", "data", *extra)


@query("SELECT row_id, data, CASE WHEN likes IS NOT NULL OR dislikes IS NOT NULL THEN coalesce(likes, 0) - coalesce(dislikes, 0) END AS score, 'hu' AS language, extra.comment_id AS comment_id, extra.\"index\" AS \"index\" FROM comments")
def comment_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments as output items, some of their parts."""
    return _comment_rows(spark, sf_dir).select("row_id", items.comment_item().alias("i")).select("row_id", "i.data", "i.score", "i.language", "i.extra.comment_id", "i.extra.index")


@query("SELECT row_id, title, description AS data, url, seller, ad_id, 'hu' AS language FROM ad_details")
def ad_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ads as output items, some of their parts."""
    return table(spark, sf_dir, "ad_details").select("row_id", items.ad_item().alias("i")).select("row_id", "i.title", "i.data", "i.url", "i.extra.seller", "i.extra.ad_id", "i.language")


@query("SELECT row_id, e.key AS name, e.value AS value FROM (SELECT row_id, unnest(map_entries(extra.details)) AS e FROM comments WHERE extra.details IS NOT NULL)")
def detail_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail tables of ads as rows."""
    return table(spark, sf_dir, "comments").select("row_id", F.explode("extra.details").alias("name", "value"))


@query("SELECT row_id, CAST(i - 1 AS BIGINT) AS place, b[i] AS crumb FROM (SELECT row_id, extra.breadcrumb AS b, unnest(range(1, len(extra.breadcrumb) + 1)) AS i FROM comments WHERE extra.breadcrumb IS NOT NULL)")
def crumb_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Breadcrumbs with their places."""
    return table(spark, sf_dir, "comments").select("row_id", F.posexplode("extra.breadcrumb").alias("place", "crumb")).withColumn("place", F.col("place").cast("bigint"))


@query()
def document_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each topic document that can be read."""
    docs = table(spark, sf_dir, "topic_docs").select("file_id", "file_name", "raw")
    counted = corpus.word_counts(corpus.documents(docs, "file_id", "raw"), "file_id")
    return docs.select("file_id", "file_name").join(counted, "file_id")


@query()
def validity_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per validity and all of them."""
    return corpus.totals(corpus.documents(table(spark, sf_dir, "topic_docs"), "file_id", "raw"))


@query()
def document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row dump of the topic documents."""
    return corpus.dump(corpus.documents(table(spark, sf_dir, "topic_docs"), "file_id", "raw"), "file_id", rows=True)


@query()
def repaired_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validity before and after the repair of a leading comma."""
    docs = table(spark, sf_dir, "topic_docs").select("file_id", "raw", corpus.repaired(F.col("raw")).alias("fixed"))
    before, after = (corpus.documents(docs, "file_id", c).select("file_id", F.col("status").alias(c)) for c in ("raw", "fixed"))
    return before.join(after, "file_id").groupBy("raw", "fixed").agg(F.count("*").alias("files"))


@query(f"SELECT doc_id, CAST(i - 1 AS BIGINT) AS place, w[i] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(text, '{WORD}') AS w FROM documents))")
def word_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the documents with their places."""
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(text.words(F.col("text"))).alias("place", "word")).withColumn("place", F.col("place").cast("bigint"))


@query("SELECT topic_url, row_id, topic_title, origin FROM (SELECT *, row_number() OVER (PARTITION BY topic_url ORDER BY row_id) AS n FROM topic_info) WHERE n = 1")
def first_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First listing of each topic."""
    return state.first_of(table(spark, sf_dir, "topic_info").select("topic_url", "row_id", "topic_title", "origin"), ["topic_url"], ["row_id"])


@query("SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents WHERE text IS NOT NULL GROUP BY sha1(text)")
def exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First document of each text and its copies; texts are hashed before they are shuffled."""
    return table(spark, sf_dir, "documents").filter("text is not null").groupBy(F.sha1("text").alias("h")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")).drop("h")


_ONE_LINE_TITLE = _strip(f"regexp_replace(topic_title, '{SPACES}', ' ', 'g')")


@query(f"SELECT min(row_id) AS row_id, count(*) AS spellings FROM topic_info WHERE topic_title IS NOT NULL GROUP BY lower({_ONE_LINE_TITLE})")
def same_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First row of each title without regard to case and white space."""
    return table(spark, sf_dir, "topic_info").filter("topic_title is not null").groupBy(F.lower(text.one_line(F.col("topic_title"))).alias("k")).agg(F.min("row_id").alias("row_id"), F.count("*").alias("spellings")).drop("k")


@query("SELECT row_id, url FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY ingested_at, row_id) AS n FROM comments) WHERE n = 1")
def delivered_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments without their repeated deliveries."""
    return state.first_of(table(spark, sf_dir, "comments").select("row_id", "url", "ingested_at"), ["url"], ["ingested_at", "row_id"]).select("row_id", "url")


@query("SELECT row_id, topic_url FROM topic_info WHERE topic_url IS NULL OR regexp_replace(split_part(topic_url, '#', 1), '/+$', '') NOT IN (SELECT regexp_replace(split_part(topic_url, '#', 1), '/+$', '') FROM comments WHERE topic_url IS NOT NULL AND scraped_at < TIMESTAMP '2023-01-01')")
def unvisited_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed topics of which no comment was captured before 2023."""
    topics = table(spark, sf_dir, "topic_info").select("row_id", "topic_url")
    seen = table(spark, sf_dir, "comments").filter("scraped_at < timestamp_ntz '2023-01-01 00:00:00'").select(F.col("topic_url").alias("url"))
    return state.unvisited(topics, urls.visited_key(F.col("topic_url"), "slash"), seen, urls.visited_key(F.col("url"), "slash"))


@query(
    """WITH seen AS (SELECT 'uadid:' || ad_id AS k FROM ad_details WHERE scraped_at < TIMESTAMP '2024-01-01' AND ad_id IS NOT NULL UNION SELECT 'title:' || title FROM ad_details WHERE scraped_at < TIMESTAMP '2024-01-01' AND title IS NOT NULL)
    SELECT row_id FROM ad_details WHERE scraped_at >= TIMESTAMP '2024-01-01' AND coalesce('uadid:' || ad_id, '') NOT IN (SELECT k FROM seen) AND coalesce('title:' || title, '') NOT IN (SELECT k FROM seen)"""
)
def new_ads_by_any_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ads captured from 2024 on whose id and title were both unknown before."""
    ads = table(spark, sf_dir, "ad_details").select("row_id", "ad_id", "title", "scraped_at")
    keys = [F.concat(F.lit("uadid:"), F.col("ad_id")), F.concat(F.lit("title:"), F.col("title"))]
    old, new = (ads.filter(f"scraped_at {op} timestamp_ntz '2024-01-01 00:00:00'") for op in ("<", ">="))
    seen = old.select(F.explode(F.array_compact(F.array(*keys))).alias("k"))
    return state.unvisited_by_any(new, ["row_id"], keys, seen, "k").select("row_id")


def _signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _comment_rows(spark, sf_dir).filter("topic_url is not null")
    return rows.withColumn("_sign", state.signature(F.col("comment_id"), F.col("author"), F.col("date"), F.col("data"), F.col("index")))


_SIGN = (
    "concat_ws('|', coalesce(extra.comment_id, ''), coalesce(coalesce(authors[1].name, concat_ws(' ', authors[1].family, authors[1].given)), ''), coalesce(date, ''), coalesce(CAST(extra.\"index\" AS VARCHAR), ''), substr("
    + _clean().replace("{x}", "data")
    + ", 1, 300))"
)
_PAGES = f"SELECT topic_url, page_no, sha1(string_agg(s, chr(10) ORDER BY pos, row_id)) AS fingerprint, count(*) AS rows FROM (SELECT *, {_SIGN} AS s FROM comments WHERE topic_url IS NOT NULL) GROUP BY topic_url, page_no"


@query(_PAGES)
def page_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of each captured page."""
    return state.fingerprints(_signed(spark, sf_dir), ["topic_url", "page_no"], ["pos", "row_id"], F.col("_sign"))


@query(
    f"""WITH p AS ({_PAGES}), m AS (SELECT *, row_number() OVER (PARTITION BY topic_url, fingerprint ORDER BY page_no) > 1 AS again, coalesce(lag(fingerprint) OVER (PARTITION BY topic_url ORDER BY page_no) = fingerprint, false) AS same_as_previous FROM p),
    s AS (SELECT *, min(CASE WHEN again THEN page_no END) OVER (PARTITION BY topic_url) AS stop FROM m) SELECT topic_url, page_no, fingerprint, rows, same_as_previous FROM s WHERE stop IS NULL OR page_no < stop"""
)
def pages_until_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of each topic before the first repeated one."""
    return state.until_repeat(page_fingerprints(spark, sf_dir), "topic_url", "page_no")


@query("SELECT *, sum(rows) OVER (PARTITION BY topic_url ORDER BY page_no ROWS UNBOUNDED PRECEDING) AS total FROM (SELECT topic_url, page_no, count(*) AS rows FROM comments WHERE topic_url IS NOT NULL GROUP BY ALL)".replace("sum(rows)", "CAST(sum(rows)").replace("PRECEDING) AS", "PRECEDING) AS BIGINT) AS"))
def running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments of each topic up to each page."""
    pages = table(spark, sf_dir, "comments").filter("topic_url is not null").groupBy("topic_url", "page_no").agg(F.count("*").alias("rows"))
    return state.running_total(pages, "topic_url", "page_no", "rows")


@query(
    """WITH c AS (SELECT topic_url, page_no, count(*) AS n FROM comments WHERE topic_url IS NOT NULL GROUP BY ALL), a AS (SELECT topic_url, unnest(range(1, m + 1)) AS p FROM (SELECT topic_url, max(page_no) AS m FROM c GROUP BY topic_url)),
    f AS (SELECT a.topic_url, CAST(a.p AS INTEGER) AS page_no, coalesce(n, 0) AS rows FROM a LEFT JOIN c ON c.topic_url = a.topic_url AND c.page_no = a.p),
    r AS (SELECT *, sum(CASE WHEN rows = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY topic_url ORDER BY page_no ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS run FROM f),
    s AS (SELECT *, min(CASE WHEN run = 3 THEN page_no END) OVER (PARTITION BY topic_url) AS stop FROM r) SELECT topic_url, page_no, rows FROM s WHERE rows > 0 AND (stop IS NULL OR page_no < stop)"""
)
def pages_until_empty_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of each topic before three empty ones in a row."""
    counted = table(spark, sf_dir, "comments").filter("topic_url is not null").groupBy("topic_url", "page_no").agg(F.count("*").alias("rows"))
    return state.until_empty_run(counted, "topic_url", "page_no", "rows", first=1)


_MARKERS = "SELECT topic_url, arg_min(page_no, (scraped_at, row_id)) AS mp, arg_min(extra.comment_id, (scraped_at, row_id)) AS mk FROM comments WHERE topic_url IS NOT NULL AND extra.comment_id IS NOT NULL GROUP BY topic_url"
_RESUME = f"""WITH m AS ({_MARKERS}), j AS (SELECT c.row_id, c.topic_url, c.page_no, c.pos, c.extra.comment_id AS cid, m.mp, m.mk FROM comments c LEFT JOIN m ON m.topic_url = c.topic_url WHERE c.topic_url IS NOT NULL),
    f AS (SELECT topic_url, min(page_no * 1000000 + pos) AS fp FROM j WHERE cid = mk AND page_no >= mp GROUP BY topic_url), k AS (SELECT j.*, fp FROM j LEFT JOIN f ON f.topic_url = j.topic_url)
    SELECT row_id FROM k WHERE mk IS NULL OR """


def _resume(policy: str):  # noqa: ANN202
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = table(spark, sf_dir, "comments").filter("topic_url is not null").select("row_id", "topic_url", "page_no", "pos", "scraped_at", F.col("extra.comment_id").alias("cid"))
        first = F.min_by(F.struct("page_no", "cid"), F.struct("scraped_at", "row_id"))
        markers = rows.filter("cid is not null").groupBy("topic_url").agg(first.alias("m")).select("topic_url", F.col("m.page_no").alias("_page"), F.col("m.cid").alias("_marker"))
        return state.resumed(rows, markers, "topic_url", "page_no", "pos", "cid", policy).select("row_id")

    return run


for _policy, _rule in (
    ("new", "page_no > mp OR (page_no = mp AND (fp IS NULL OR fp // 1000000 <> mp OR page_no * 1000000 + pos > fp))"),
    ("advance", "coalesce(page_no * 1000000 + pos > fp, false)"),
    ("skip", "page_no > mp OR (page_no = mp AND fp // 1000000 = mp AND page_no * 1000000 + pos > fp)"),
):
    QUERIES[f"resumed_{_policy}"], ORACLES[f"resumed_{_policy}"] = _resume(_policy), _RESUME + f"({_rule})"


@query(
    """SELECT group_url, count(*) AS members, bool_and(done) AS complete FROM (SELECT t.group_url, s.topic_url IS NOT NULL AS done FROM topic_info t LEFT JOIN (SELECT DISTINCT topic_url FROM comments) s ON s.topic_url = t.topic_url) GROUP BY group_url"""
)
def complete_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of which every topic was captured."""
    seen = table(spark, sf_dir, "comments").filter("topic_url is not null").select("topic_url", F.lit(True).alias("_seen")).distinct()
    return state.all_done(table(spark, sf_dir, "topic_info").select("group_url", "topic_url").join(seen, "topic_url", "left"), "group_url", F.col("_seen"))


@query("SELECT row_id, group_url FROM (SELECT *, row_number() OVER (PARTITION BY group_url ORDER BY row_id) AS n FROM topic_info) WHERE n <= 100")
def first_hundred_per_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First hundred topics of each list, the limit of a listing page."""
    return table(spark, sf_dir, "topic_info").select("row_id", "group_url").withColumn("n", F.row_number().over(Window.partitionBy("group_url").orderBy("row_id"))).filter("n <= 100").drop("n")


@query(
    """SELECT topic_url, arg_min(i, (t, i)) AS small_index, min(t) AS small_total, arg_max(i, (t, i)) AS large_index, max(t) AS large_total FROM (SELECT topic_url, extra."index" AS i, extra.index_total AS t FROM comments WHERE topic_url IS NOT NULL AND extra."index" IS NOT NULL AND extra.index_total IS NOT NULL) GROUP BY topic_url"""
)
def page_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smallest and largest ``n / m`` indicator of each topic, by total and then by number."""
    rows = table(spark, sf_dir, "comments").filter("topic_url is not null").select("topic_url", F.col("extra.index").alias("i"), F.col("extra.index_total").alias("t")).filter("i is not null and t is not null")
    both = rows.groupBy("topic_url").agg(F.min(F.struct("t", "i")).alias("a"), F.max(F.struct("t", "i")).alias("b"))
    return both.select("topic_url", F.col("a.i").alias("small_index"), F.col("a.t").alias("small_total"), F.col("b.i").alias("large_index"), F.col("b.t").alias("large_total"))


@query(
    """SELECT topic_url, page_no, lead(page_no) OVER (PARTITION BY topic_url ORDER BY page_no) AS next_page, CAST(greatest(max(page_no) OVER (PARTITION BY topic_url), ceil(sum(n) OVER (PARTITION BY topic_url) / 100.0)) AS BIGINT) AS pages FROM (SELECT topic_url, page_no, count(*) AS n FROM comments WHERE topic_url IS NOT NULL GROUP BY ALL)"""
)
def next_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next captured page after each, and the estimated number of pages of its topic."""
    pages = table(spark, sf_dir, "comments").filter("topic_url is not null").groupBy("topic_url", "page_no").agg(F.count("*").alias("n"))
    whole = pages.groupBy("topic_url").agg(F.greatest(F.max("page_no").cast("bigint"), F.ceil(F.sum("n") / 100)).alias("pages"))
    return state.with_next(pages.select("topic_url", "page_no"), "topic_url", "page_no", "_n").withColumnRenamed("_n", "next_page").join(whole, "topic_url")


@query("SELECT c.row_id, p.row_id AS parent_row FROM comments c JOIN comments p ON c.topic_url = p.topic_url AND c.extra.parent_comment_id = p.extra.comment_id")
def reply_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies with their parents within a topic."""
    c = table(spark, sf_dir, "comments").select("row_id", "topic_url", F.col("extra.comment_id").alias("cid"), F.col("extra.parent_comment_id").alias("pid"))
    child, parent = c.filter("pid is not null").select("row_id", "topic_url", F.col("pid").alias("id")), c.filter("cid is not null").select(F.col("row_id").alias("parent_row"), "topic_url", F.col("cid").alias("id"))
    return child.join(parent, ["topic_url", "id"]).select("row_id", "parent_row")


@query("SELECT DISTINCT key FROM (SELECT 'url:' || url AS key FROM ad_details WHERE url IS NOT NULL UNION ALL SELECT 'uadid:' || ad_id FROM ad_details WHERE ad_id IS NOT NULL UNION ALL SELECT 'title:' || title FROM ad_details WHERE title IS NOT NULL)")
def visited_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All keys under which ads are known."""
    keys = F.array_compact(F.array(F.concat(F.lit("url:"), F.col("url")), F.concat(F.lit("uadid:"), F.col("ad_id")), F.concat(F.lit("title:"), F.col("title"))))
    return table(spark, sf_dir, "ad_details").select(F.explode(keys).alias("key")).distinct()


@query()
def html_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments rendered as pages and extracted again."""
    escape = lambda c: F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    rows = _comment_rows(spark, sf_dir)
    page = F.concat(F.lit('<html><div class="comment" data-id="'), F.coalesce("comment_id", F.lit("")), F.lit('"><b class="author">'), escape(F.col("author")), F.lit('</b><div class="body">'), escape(F.col("data")), F.lit("</div></div></html>"))
    return html.extract(rows.select("row_id", page.alias("html"), "url"), ["row_id"], "html", "url", html.COMMENTS).select("row_id", "comment_id", "author", "data")


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, sum(value) AS total FROM events GROUP BY ALL".replace("sum(value)", "CAST(round(sum(value), 2) AS DOUBLE)"))
def event_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by hour and type (an addition)."""
    return table(spark, sf_dir, "events").groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("start"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
