"""Queries on crawl state, pagers, predicates and reports, each with SQL written from the rule it follows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosta.functions import predicates, text, urls
from rosta.functions.text import ENDS, SPACES, WORD
from rosta.operators import corpus, html, items, paging, state
from rosta.session import table
from rosta.sources import readers, writers

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
    """Registers a query that maps one column of a table by a scalar; ``sql`` has {x} for the column."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return table(spark, sf_dir, source).select(key, f(F.col(column)).alias("value"))

    run.__doc__ = f"{f.__doc__ or name} Over {source}.{column}."
    QUERIES[name] = run
    ORACLES[name] = f"SELECT {key}, {sql.replace('{x}', column)} AS value FROM {source}"


def strip_sql(x: str) -> str:
    """SQL of stripping."""
    return f"regexp_replace({x}, '{ENDS}', '', 'g')"


def clean_sql(x: str) -> str:
    """SQL of the cleaning of text."""
    inner = f"regexp_replace(translate(coalesce({x}, ''), chr(160) || chr(13), ' '), '[ \\t]+', ' ', 'g')"
    return strip_sql(f"regexp_replace({inner}, '\\n{{3,}}', chr(10) || chr(10), 'g')")


def line_sql(x: str) -> str:
    """SQL of the one-line form."""
    return strip_sql(f"regexp_replace({x}, '{SPACES}', ' ', 'g')")


def any_sql(low: str, marks: tuple[str, ...]) -> str:
    """SQL: whether a text has one of the marks."""
    return "(" + " OR ".join(f"contains({low}, '{m}')" for m in marks) + ")"


def in_sql(x: str, values: tuple[str, ...]) -> str:
    """SQL: whether a text is one of the values."""
    return f"{x} IN (" + ", ".join(f"'{v}'" for v in values) + ")"


# -- predicates -------------------------------------------------------------------------------------------------------

scalar("page_classes", "comments", "row_id", "data", predicates.page_class, f"CASE WHEN {any_sql('lower({x})', predicates.CAPTCHA_MARKS)} THEN 'captcha' WHEN {any_sql('lower({x})', predicates.OVERLOAD_MARKS)} THEN 'overload' WHEN regexp_matches(lower({{x}}), '<title>[^<]*404') OR contains(lower({{x}}), '404 not found') OR contains(lower({{x}}), 'a kért oldal nem létezik') THEN 'missing' WHEN regexp_matches(lower({{x}}), 'class=\"[^\"]*\\b(?:msg|message|comment|hozzaszolas)\\b|<article') THEN 'messages' WHEN {any_sql('lower({x})', predicates.EMPTY_MARKS)} THEN 'empty' WHEN {{x}} IS NOT NULL THEN 'unknown' END")
scalar("fatal_pages", "topic_info", "row_id", "topic_title", predicates.fatal_page, "CASE WHEN {x} IS NULL THEN NULL WHEN contains(lower({x}), '404 not found') OR contains(lower({x}), 'a kért oldal nem létezik') THEN 'missing' WHEN regexp_matches(lower({x}), '" + "|".join(predicates.EMPTY_MARKS) + "') THEN 'empty' ELSE 'unknown' END")
scalar("body_texts", "comments", "row_id", "data", predicates.body_text, f"array_to_string(list_filter(list_transform(string_split({{x}}, chr(10)), lambda l: {line_sql('l')}), lambda l: l <> '' AND NOT regexp_matches(l, '^(?:[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}\\s+[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}|#[0-9]+|Válasz erre)$') AND NOT regexp_matches(l, '(?i)^Válasz\\s+.+?\\s+#[0-9]+\\.\\s*hozzászólására$')), chr(10))")
_SELLER = strip_sql("regexp_replace(seller, '\\s*\\([0-9]+\\)\\s*$', '')")
scalar("seller_candidates", "ad_details", "row_id", "seller", predicates.seller_like, f"coalesce(length({_SELLER}) BETWEEN 2 AND 80 AND NOT {any_sql(f'lower({_SELLER})', predicates.NO_SELLER)} AND NOT regexp_matches({_SELLER}, '[0-9]{{4}}\\.[0-9]{{2}}\\.[0-9]{{2}}\\.?\\s+[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}') AND NOT regexp_matches({_SELLER}, '^[A-Za-z]+:[0-9a-fA-F]{{4,}}$'), false)")
scalar("description_paragraphs", "ad_details", "row_id", "description", predicates.paragraph, f"coalesce({clean_sql('{x}')} <> '' AND NOT {in_sql('lower(' + line_sql(clean_sql('{x}')) + ')', predicates.NO_PARAGRAPH)} AND NOT {any_sql('lower(' + line_sql(clean_sql('{x}')) + ')', predicates.NO_PARAGRAPH_PARTS)}, false)")
scalar("resolvable_titles", "topic_info", "row_id", "topic_title", lambda x: predicates.resolved_title(x, ("kertkapu fórum",)), f"{clean_sql('{x}')} <> '' AND NOT {in_sql('lower(' + clean_sql('{x}') + ')', (*predicates.NO_TITLE, 'kertkapu fórum'))} AND NOT {any_sql('lower(' + clean_sql('{x}') + ')', predicates.NO_TITLE_PARTS)}")
scalar("product_urls", "ad_details", "row_id", "url", lambda x: predicates.product_url(x, "borze.example"), f"coalesce(contains(lower(regexp_extract({{x}}, '^[a-zA-Z]+://([^/?#]*)', 1)), 'borze.example') AND regexp_matches(lower({{x}}), '^[^?#]*\\.html(?:[?#]|$)') AND NOT {any_sql('lower(regexp_extract({x}, ' + chr(39) + '^[^?#]*' + chr(39) + '))', predicates.NO_PRODUCT)}, false)")
scalar("own_page_urls", "comments", "row_id", "url", predicates.no_pagination, "coalesce(NOT contains({x}, '__oldal-'), true)")
scalar("rule_topics", "topic_info", "row_id", "topic_title", lambda x: predicates.rule_topic(x, "kövölgyi eke találkozó"), "coalesce(lower({x}) = 'kövölgyi eke találkozó', false)")
scalar("long_titles", "ad_details", "row_id", "title", lambda x: predicates.long_enough(x, 5), "coalesce(length({x}) >= 5, false)")
scalar("page_like_counts", "topic_info", "row_id", "reply_count_hint", predicates.page_count_like, "coalesce({x} BETWEEN 2 AND 100000, false)")


@query(f"SELECT row_id, (topic_url IS NOT NULL AND topic_url <> '' AND {clean_sql('topic_title')} <> '' AND contains(lower(topic_url), '/forum/') AND NOT {in_sql('lower(' + clean_sql('topic_title') + ')', predicates.NO_TOPIC_LINK)}) AS value FROM topic_info")
def topic_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed links that probably lead to a topic."""
    return table(spark, sf_dir, "topic_info").select("row_id", predicates.topic_link(F.col("topic_url"), F.col("topic_title")).alias("value"))


@query(f"SELECT row_id, {clean_sql('data')} <> '' AS body, {clean_sql('data')} <> '' OR coalesce(extra.comment_id, '') <> '' AS id, {clean_sql('data')} <> '' OR coalesce(authors[1].name, '') <> '' OR {clean_sql('date')} <> '' AS any FROM comments")
def kept_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which comments stay by the rules on empty bodies."""
    parts = (F.col("data"), F.col("extra.comment_id"), F.get("authors", F.lit(0))["name"], F.col("date"))
    return table(spark, sf_dir, "comments").select("row_id", *[predicates.kept_comment(*parts, rule).alias(rule) for rule in ("body", "id", "any")])


# -- numbers, titles and headers from text ------------------------------------------------------------------------------

for _what, _patterns in text.COUNTS.items():
    _found = ", ".join(f"nullif(regexp_extract({{x}}, '{p}', 1), '')" for p in _patterns)
    scalar(f"shown_{_what}", "comments", "row_id", "data", lambda x, w=_what: text.shown_count(x, w), f"TRY_CAST(nullif(regexp_extract(translate(coalesce({_found}), '. ', ''), '[0-9]+'), '') AS BIGINT)")
scalar("largest_numbers", "topic_info", "row_id", "topic_title", text.largest_number, "list_max(list_transform(regexp_extract_all({x}, '\\b[0-9]{1,3}(?:\\.[0-9]{3})*\\b'), lambda n: TRY_CAST(replace(n, '.', '') AS BIGINT)))")
scalar("bare_titles", "topic_info", "row_id", "topic_title", lambda x: text.bare_title(x, ("Durmont",)), strip_sql("regexp_replace(regexp_replace(regexp_replace(regexp_replace({x}, '(?i)^\\s*Téma:\\s*', ''), '(?i)^\\s*Fórum\\s*»\\s*', ''), '(?i)\\s*-\\s*Durmont.*$', ''), '(?i)\\s*\\(beszélgetés\\)\\s*$', '')"))
scalar("upper_titles", "topic_info", "row_id", "topic_title", text.upper, "upper({x})")
scalar("author_lines", "comments", "row_id", "data", text.author_line, f"list_filter(list_transform(string_split({clean_sql('{x}')}, chr(10)), lambda l: {strip_sql('l')}), lambda l: l <> '' AND NOT {in_sql('lower(l)', text.RANKS)} AND NOT starts_with(l, '#'))[1]")
scalar("quote_lines", "comments", "row_id", "data", text.quote_line, f"regexp_matches(lower({clean_sql('{x}')}), '(?s)^(?:írta:|>|\\[quote\\])') OR regexp_matches(lower({clean_sql('{x}')}), '(?s)(?:írta:|\\[/quote\\])\\z')")


@query("SELECT row_id, regexp_extract(h, '\\((\\d+)\\s*/\\s*(\\d+)\\)', 1)::BIGINT AS \"index\", regexp_extract(h, '\\((\\d+)\\s*/\\s*(\\d+)\\)', 2)::BIGINT AS total FROM (SELECT row_id, '#' || extra.comment_id || ' (' || extra.\"index\" || ' / ' || extra.index_total || ')' AS h FROM comments WHERE extra.\"index\" IS NOT NULL AND extra.index_total IS NOT NULL AND extra.comment_id IS NOT NULL)")
def indexes_of_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places ``(n / m)`` read from comment headers."""
    shown = F.concat(F.lit("#"), F.col("extra.comment_id"), F.lit(" ("), F.col("extra.index").cast("string"), F.lit(" / "), F.col("extra.index_total").cast("string"), F.lit(")"))
    rows = table(spark, sf_dir, "comments").select("row_id", shown.alias("h")).filter("h is not null")
    return rows.select("row_id", text.index_of_total(F.col("h")).alias("p")).select("row_id", "p.index", "p.total")


_AUTHOR = "coalesce(authors[1].name, concat_ws(' ', authors[1].family, authors[1].given))"


@query(f"SELECT row_id, form, {line_sql('a')} AS author, {line_sql('p')} AS parent, n AS number FROM (SELECT row_id, unnest(['answer', 'bracket', 'reply', 'earlier', 'arrow']) AS form, unnest([a, a, NULL, NULL, a]) AS a, p, unnest([12, 12, 12, NULL, 12]::BIGINT[]) AS n FROM (SELECT row_id, {line_sql('seller')} AS a, 'Öreg Róka' AS p FROM ad_details) WHERE regexp_matches(a, '^[A-Za-z_0-9 ÁÉÍÓÖŐÚÜŰáéíóöőúüű]+$'))")
def reply_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Author, parent and number read back from headers of every form."""
    a, p = F.col("a"), F.lit("Öreg Róka")
    forms = {
        "answer": F.concat(a, F.lit(" válasza "), p, F.lit(" hozzászólására (#12)")),
        "bracket": F.concat(a, F.lit(" (válaszként erre: 12. - "), p, F.lit(")")),
        "reply": F.concat(F.lit("Válasz "), p, F.lit(" #12. hozzászólására")),
        "earlier": F.concat(F.lit("#1 Előzmény "), p),
        "arrow": F.concat(F.lit("#13 "), a, F.lit(" > "), p, F.lit(" #12 2024-01-02")),
    }
    rows = table(spark, sf_dir, "ad_details").select("row_id", text.one_line(F.col("seller")).alias("a")).filter(r"a rlike '^[A-Za-z_0-9 ÁÉÍÓÖŐÚÜŰáéíóöőúüű]+$'")
    each = rows.select("row_id", F.explode(F.create_map(*[x for k, v in forms.items() for x in (F.lit(k), v)])).alias("form", "h"))
    return each.select("row_id", "form", text.reply_header(F.col("h")).alias("r")).select("row_id", "form", "r.author", "r.parent", "r.number")


@query(f"SELECT row_id, coalesce(nullif({line_sql('s')}, ''), CASE WHEN contains(lower(coalesce(seller, '')), 'anonim') THEN 'anonim' END, 'ismeretlen') AS author FROM (SELECT row_id, seller, seller AS s FROM ad_details)")
def answer_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authors of answers read from their headers."""
    header = F.concat(F.lit("1/5 "), F.col("seller"), F.lit(" válasza:"))
    return table(spark, sf_dir, "ad_details").select("row_id", text.answer_author(F.when(text.one_line(F.col("seller")) != "", header), F.col("seller")).alias("author"))


@query("SELECT row_id, CASE WHEN u IS NOT NULL THEN d || ' 10:11' ELSE d END AS message, u AS user FROM (SELECT row_id, '2024-01-02' AS d, CASE WHEN row_id % 3 > 0 THEN 'kis bela' END AS u FROM topic_info)")
def last_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time and user read from last cells of each form."""
    shown = F.when(F.col("row_id") % 3 == 0, "2024-01-02").when(F.col("row_id") % 3 == 1, "kis bela 2024-01-02 10:11").otherwise("2024-01-02 10:11 kis bela")
    rows = table(spark, sf_dir, "topic_info").select("row_id", text.last_activity(shown).alias("c"))
    return rows.select("row_id", "c.message", "c.user")


@query(f"SELECT row_id, list_distinct_blocks AS body, kept FROM (SELECT row_id, nullif({strip_sql('array_to_string(list_filter(b, lambda x, i: NOT list_contains(b[:i - 1], x)), chr(10) || chr(10))')}, '') AS list_distinct_blocks, CAST(len(list_filter(list_transform(b, lambda x: {clean_sql('x')}), lambda x: x <> '')) AS INTEGER) AS kept FROM (SELECT row_id, string_split(data, chr(10)) AS b FROM comments))")
def body_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies of their different blocks, and the number of blocks that are not blank."""
    blocks = F.split("data", "\n")
    return table(spark, sf_dir, "comments").select("row_id", text.unique_blocks(blocks).alias("body"), F.size(text.kept_paragraphs(blocks)).alias("kept")).withColumn("kept", F.when(F.col("kept") >= 0, F.col("kept")))


@query("SELECT row_id, CASE WHEN n > 0 THEN n END AS containers, CASE WHEN n >= 2 THEN authors[2].name END AS second, authors[-1].name AS last FROM (SELECT row_id, authors, CAST(coalesce(len(authors), 0) AS INTEGER) AS n FROM comments)")
def cell_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements taken by their place, and their number."""
    names = F.transform("authors", lambda a: a["name"])
    return table(spark, sf_dir, "comments").select("row_id", items.container_count(F.col("authors")).alias("containers"), text.cell(names, 1, 2).alias("second"), text.cell(names, -1).alias("last"))


@query("SELECT row_id, CASE WHEN rating IS NOT NULL THEN coalesce(likes, 0) - coalesce(dislikes, 0) END AS score FROM comments")
def block_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of pages that show a block of votes."""
    return table(spark, sf_dir, "comments").select("row_id", items.vote_score_of_block(F.col("rating").isNotNull(), F.col("likes"), F.col("dislikes")).alias("score"))


# -- addresses ------------------------------------------------------------------------------------------------------------

_Q = "string_split(regexp_extract({x}, '^[^?#]*\\?([^#]*)', 1), '&')"
_BASE = "regexp_extract({x}, '^[^?#]*')"


def _without_sql(keys: tuple[str, ...]) -> str:
    kept = f"array_to_string(list_filter({_Q}, lambda p: p <> '' AND NOT {in_sql(chr(115) + 'plit_part(p, ' + chr(39) + '=' + chr(39) + ', 1)', keys)}), '&')"
    return f"CASE WHEN {{x}} IS NULL THEN NULL ELSE {_BASE} || CASE WHEN {kept} <> '' THEN '?' || {kept} ELSE '' END END"


scalar("url_thread", "comments", "row_id", "topic_url", lambda x: urls.query_param(F.concat(x, F.lit("&q=a=b+c&q=2&thread_id=9#thread_id=8")), "thread_id"), "CASE WHEN {x} IS NULL THEN NULL ELSE coalesce(nullif(list_filter(string_split(regexp_extract({x} || '&q=a=b+c&q=2&thread_id=9', '^[^?#]*\\?([^#]*)', 1), '&'), lambda p: starts_with(p, 'thread_id='))[1][11:], '')) END")
scalar("url_value_with_sign", "comments", "row_id", "topic_url", lambda x: urls.query_param(F.concat(x, F.lit("?q=a=b+c&q=2")), "q"), "CASE WHEN {x} IS NULL THEN NULL WHEN contains({x}, '?') THEN NULLIF(list_filter(string_split(split_part({x} || '?q=a=b+c&q=2', '?', 2) || '?' || split_part({x} || '?q=a=b+c&q=2', '?', 3), '&'), lambda p: starts_with(p, 'q='))[1][3:], '') ELSE 'a=b c' END")
scalar("url_without_params", "comments", "row_id", "url", lambda x: urls.without_param(F.concat(F.regexp_replace(x, "#.*", ""), F.lit("&page=7&Page=8")), "page", "thread_id"), _without_sql(("page", "thread_id")).replace("{x}", "(regexp_replace({x}, '#.*', '') || '&page=7&Page=8')"))
scalar("url_list_key", "comments", "row_id", "url", lambda x: urls.kept_params(x, ("page", "thread_id")), f"CASE WHEN {{x}} IS NULL THEN NULL ELSE regexp_replace({_BASE}, '/+$', '') || coalesce('?' || nullif(array_to_string(list_concat(list_filter({_Q}, lambda p: starts_with(p, 'page=') AND length(p) > 5), list_filter({_Q}, lambda p: starts_with(p, 'thread_id=') AND length(p) > 10)), '&'), ''), '') END")
scalar("url_path_key", "comments", "row_id", "url", lambda x: urls.visited_key(x, "path"), f"regexp_replace({_BASE}, '/+$', '')")
scalar("url_range_key", "topic_info", "row_id", "topic_url", lambda x: urls.visited_key(F.concat(x, F.lit("/hsz_201-300.html#msg250")), "range"), "{x}")
scalar("url_with_fragment_kept", "comments", "row_id", "url", lambda x: urls.with_param_and_fragment(x, F.lit("page"), F.lit("4")), "CASE WHEN {x} IS NULL THEN NULL WHEN regexp_matches({x}, '[?&]page=[^&#]+') THEN regexp_replace({x}, '([?&])page=[^&#]+', '\\1page=4') WHEN contains(split_part({x}, '#', 1), '?') THEN split_part({x}, '#', 1) || '&page=4' || CASE WHEN contains({x}, '#') THEN '#' || split_part({x}, '#', 2) ELSE '' END ELSE split_part({x}, '#', 1) || '?page=4' || CASE WHEN contains({x}, '#') THEN '#' || split_part({x}, '#', 2) ELSE '' END END")
scalar("url_resumed", "topic_info", "row_id", "topic_url", lambda x: urls.resume_url(F.concat(F.regexp_replace(x, r"\?.*", ""), F.lit("?na_start=30&na_step=30#c"))), "regexp_replace({x}, '\\?.*', '') || '?na_start=60&na_step=30'")

#: How each origin compares addresses of topics.
RULES = {"mezogep_forum": "page", "hangfal_forum": "page", "kertkapu_forum": "path", "szilva_forum": "page", "csavarhuzo_forum": "fragment", "vetito_forum": "slash", "gazdi_valasz": "start"}


@query(
    f"""WITH k AS (SELECT DISTINCT origin, CASE WHEN origin IN ('mezogep_forum', 'hangfal_forum', 'szilva_forum') THEN {_without_sql(('page',))} WHEN origin = 'kertkapu_forum' THEN regexp_replace({_BASE}, '/+$', '')
    WHEN origin = 'vetito_forum' THEN regexp_replace(split_part({{x}}, '#', 1), '/+$', '') WHEN origin = 'gazdi_valasz' THEN {_without_sql(('start',))} ELSE split_part({{x}}, '#', 1) END AS key FROM comments) SELECT origin, count(*) AS keys, count(DISTINCT lower(key)) AS folded FROM k GROUP BY origin""".replace("{x}", "url")
)
def visited_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visited keys of each origin by its own rule, and how many would be left without regard to case."""
    keys = table(spark, sf_dir, "comments").select("origin", urls.visited_key_by(F.col("url"), F.col("origin"), RULES).alias("key")).distinct()
    return keys.groupBy("origin").agg(F.count("*").alias("keys"), F.count_distinct(F.lower("key")).alias("folded"))


@query(f"SELECT row_id, CASE WHEN {clean_sql('ad_id')} <> '' THEN 'uadid:' || {clean_sql('ad_id')} WHEN {clean_sql('url')} <> '' THEN 'url:' || {clean_sql('url')} ELSE 'title:' || {clean_sql('title')} END AS key FROM ad_details")
def ad_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key under which each ad is visited."""
    return table(spark, sf_dir, "ad_details").select("row_id", urls.ad_key(F.col("ad_id"), F.col("url"), F.col("title")).alias("key"))


# -- pagers and guards --------------------------------------------------------------------------------------------------------


@query(
    """WITH n AS (SELECT row_id, page_no, topic_url, list_distinct(list_transform(regexp_extract_all(data, '[0-9]+'), lambda x: TRY_CAST(x AS BIGINT))) AS c FROM comments WHERE topic_url IS NOT NULL AND page_no IS NOT NULL),
    p AS (SELECT *, list_min(list_filter(c, lambda x: x > page_no)) AS larger, coalesce(list_contains(c, page_no + 1), false) AS exact FROM n)
    SELECT row_id, CASE WHEN exact THEN page_no + 1 ELSE larger END AS page, coalesce(CASE WHEN exact THEN 'p' || (page_no + 1) ELSE 'p' || larger END, topic_url || '#' || (page_no + 1)) AS link FROM p"""
)
def next_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next page among the numbers of each comment: the exact one, else the smallest larger one, else a built address."""
    rows = table(spark, sf_dir, "comments").filter("topic_url is not null and page_no is not null")
    numbers = F.array_compact(F.transform(F.regexp_extract_all("data", F.lit("[0-9]+"), F.lit(0)), lambda x: x.try_cast("bigint")))
    rows = rows.select("row_id", "topic_url", F.col("page_no").cast("bigint").alias("n"), F.coalesce(numbers, F.array().cast("array<bigint>")).alias("c"))
    links = F.transform("c", lambda x: F.struct(x.alias("page"), F.concat(F.lit("p"), x.cast("string")).alias("url")))
    return rows.select("row_id", paging.next_page(F.col("c"), F.col("n")).alias("page"), paging.next_link(links, F.col("n"), F.concat("topic_url", F.lit("#"), (F.col("n") + 1).cast("string"))).alias("link"))


_PAGES = "SELECT DISTINCT topic_url, page_no FROM comments WHERE topic_url IS NOT NULL AND page_no IS NOT NULL"


@query(f"WITH p AS ({_PAGES}) SELECT topic_url, page_no, CASE WHEN n = page_no + 1 THEN 'next' WHEN n IS NOT NULL THEN 'larger' ELSE 'end' END AS step, n AS next_page FROM (SELECT *, lead(page_no) OVER (PARTITION BY topic_url ORDER BY page_no) AS n FROM p)")
def page_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each captured page leads on: to the next number, to a larger one, or nowhere."""
    pages = table(spark, sf_dir, "comments").select("topic_url", "page_no").filter("topic_url is not null and page_no is not null").distinct()
    out = state.with_next(pages, "topic_url", "page_no", "next_page")
    return out.select("topic_url", "page_no", F.when(F.col("next_page") == F.col("page_no") + 1, "next").when(F.col("next_page").isNotNull(), "larger").otherwise("end").alias("step"), "next_page")


@query(
    """WITH RECURSIVE e AS (SELECT group_url, row_id AS page, lead(row_id) OVER (PARTITION BY group_url ORDER BY row_id) AS nxt FROM topic_info WHERE group_url IS NOT NULL), f AS (SELECT group_url, min(row_id) AS start FROM topic_info WHERE group_url IS NOT NULL GROUP BY 1),
    c AS (SELECT start, start AS page, 0 AS step FROM f UNION ALL SELECT c.start, e.nxt, c.step + 1 FROM c JOIN e ON e.page = c.page WHERE e.nxt IS NOT NULL AND c.step + 1 < 20) SELECT start, page, step FROM c"""
)
def listing_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing rows that next links lead to from the first one of each list, twenty at most."""
    rows = table(spark, sf_dir, "topic_info").select("group_url", "row_id").filter("group_url is not null")
    edges = state.with_next(rows, "group_url", "row_id", "_n").select("row_id", F.col("_n").alias("nxt"))
    return paging.link_chain(edges, rows.groupBy("group_url").agg(F.min("row_id").alias("start")).select("start"), "row_id", "nxt", 20)


@query(f"WITH p AS ({_PAGES}), l AS (SELECT topic_url, min(page_no) AS last FROM comments WHERE topic_url IS NOT NULL AND extra.comment_id IS NOT NULL AND scraped_at < TIMESTAMP '2024-01-01' GROUP BY 1), m AS (SELECT topic_url, max(page_no) AS newest FROM p GROUP BY 1) SELECT p.topic_url, p.page_no, CAST(newest - p.page_no AS BIGINT) AS step FROM p JOIN m USING (topic_url) LEFT JOIN l USING (topic_url) WHERE last IS NULL OR p.page_no >= last")
def backwards_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages from the newest back to the one read last."""
    rows = table(spark, sf_dir, "comments").filter("topic_url is not null")
    last = rows.filter("extra.comment_id is not null and scraped_at < timestamp_ntz '2024-01-01 00:00:00'").groupBy("topic_url").agg(F.min("page_no").alias("_last"))
    return paging.walked_backwards(rows.filter("page_no is not null").select("topic_url", "page_no").distinct(), "topic_url", "page_no", last)


@query(f"WITH p AS ({_PAGES}) SELECT topic_url, page_no FROM p WHERE page_no BETWEEN 2 AND 5")
def bounded_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages within a start and an end page."""
    return table(spark, sf_dir, "comments").select("topic_url", "page_no").filter("topic_url is not null").filter(paging.within_bounds(F.col("page_no"), 2, 5)).distinct()


@query("SELECT topic_url, row_id, page_no FROM (SELECT c.topic_url, c.row_id, c.page_no, row_number() OVER (PARTITION BY c.topic_url ORDER BY c.page_no, c.pos, c.row_id) AS n FROM comments c WHERE c.topic_url IN (SELECT topic_url FROM topic_info)) WHERE n = 1")
def first_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each listed topic the first captured row that leads to it."""
    links = table(spark, sf_dir, "comments").select("topic_url", "row_id", "page_no", "pos")
    return paging.first_link(links, table(spark, sf_dir, "topic_info"), "topic_url", ["page_no", "pos", "row_id"]).select("topic_url", "row_id", "page_no")


@query(
    """WITH c AS (SELECT url, arg_min(ad_id, row_id) AS ad_id, arg_min(title, row_id) AS title FROM (SELECT row_id, url, coalesce(ad_id, '') AS ad_id, coalesce(title, '') AS title FROM ad_details) GROUP BY url)
    SELECT d.row_id, coalesce(nullif(nullif(d.title, ''), 'ismeretlen hirdetés'), nullif(c.title, ''), d.title) AS title, coalesce(nullif(c.ad_id, ''), nullif(d.ad_id, '')) AS ad_id FROM ad_details d LEFT JOIN c ON c.url = d.url"""
)
def ads_with_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ads with what their first listing card knows of title and id."""
    ads = table(spark, sf_dir, "ad_details").select("row_id", "url", "title", "ad_id")
    cards = state.first_of(ads.fillna("", ["title", "ad_id"]), ["url"], ["row_id"])
    return paging.enriched(ads, cards, "url", ["ad_id"], ["title"], {"title": "ismeretlen hirdetés"}).select("row_id", "title", "ad_id")


_JSON = "(SELECT file_id, file_name, raw, CASE WHEN json_valid(raw) THEN raw::JSON END AS j FROM topic_docs)"


@query(
    f"""WITH r AS (SELECT json_extract_string(j, '$.data.url') AS topic_url, arg_max(json_extract_string(j, '$.title'), file_id) AS resolved FROM {_JSON} WHERE json_type(j) = 'OBJECT' AND json_type(j, '$.title') = 'VARCHAR' AND json_extract_string(j, '$.data.url') IS NOT NULL GROUP BY 1)
    SELECT t.row_id, CASE WHEN {clean_sql('r.resolved')} <> '' AND NOT {in_sql('lower(' + clean_sql('r.resolved') + ')', predicates.NO_TITLE)} AND NOT {any_sql('lower(' + clean_sql('r.resolved') + ')', predicates.NO_TITLE_PARTS)} THEN r.resolved ELSE t.topic_title END AS title FROM topic_info t LEFT JOIN r ON r.topic_url = t.topic_url"""
)
def resolved_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed topics under the title of their last document, where that is a topic's own."""
    docs = table(spark, sf_dir, "topic_docs").select("file_id", F.get_json_object("raw", "$.title").alias("resolved"), F.get_json_object("raw", "$.data.url").alias("topic_url"))
    names = docs.filter("topic_url is not null and resolved is not null").groupBy("topic_url").agg(F.max_by("resolved", "file_id").alias("resolved"))
    joined = table(spark, sf_dir, "topic_info").select("row_id", "topic_url", "topic_title").join(names, "topic_url", "left")
    return joined.select("row_id", F.when(predicates.resolved_title(F.col("resolved")), F.col("resolved")).otherwise(F.col("topic_title")).alias("title"))


# -- documents: state, resuming, reports ------------------------------------------------------------------------------------------


@query(
    """SELECT file_id, coalesce(regexp_matches(raw, '(?s)\\](?:\\r?\\n)?\\}\\s*\\z'), false) AS tail, coalesce(json_valid(raw) AND json_extract_string(CASE WHEN json_valid(raw) THEN raw::JSON END, '$.extra.scrape_status') = 'finished' AND json_type(CASE WHEN json_valid(raw) THEN raw::JSON END, '$.comments') = 'ARRAY', false) AS status,
    coalesce(regexp_matches(raw, '"comments"\\s*:\\s*\\[\\s*\\{'), false) AS items FROM topic_docs"""
)
def document_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each document is finished by its tail or its status, and whether it holds any item."""
    raw = F.col("raw")
    valid = corpus.documents(table(spark, sf_dir, "topic_docs").select("file_id", "raw"), "file_id", "raw").select("file_id", (F.col("status") == "complete").alias("_valid"))
    rows = table(spark, sf_dir, "topic_docs").select("file_id", corpus.closed(raw).alias("tail"), corpus.closed(raw, "status").alias("_status"), corpus.has_items(raw).alias("items"))
    return rows.join(valid, "file_id").select("file_id", "tail", (F.col("_status") & F.col("_valid")).alias("status"), "items")


_LAST = "regexp_extract(regexp_extract_all(raw, '\"{f}\"\\s*:\\s*\"[^\"]*\"')[-1], ':\\s*\"([^\"]*)\"$', 1)"


@query(f"SELECT file_id, nullif({_LAST.replace('{f}', 'comment_id')}, '') AS comment_id, nullif({_LAST.replace('{f}', 'url')}, '') AS url, nullif({_LAST.replace('{f}', 'next_resume_url')}, '') AS next_url, greatest(100, TRY_CAST(regexp_extract_all(raw, '\"list_offset\"\\s*:\\s*([0-9]+)', 1)[-1] AS BIGINT)) AS \"offset\" FROM topic_docs WHERE NOT coalesce(regexp_matches(raw, '(?s)\\](?:\\r?\\n)?\\}}\\s*\\z'), false)")
def resume_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each document that is not finished is resumed; finished ones are skipped."""
    docs = table(spark, sf_dir, "topic_docs").select("file_id", "raw")
    left = docs.filter(~corpus.closed(F.col("raw"))).select("file_id", corpus.last_saved(F.col("raw")).alias("s"))
    return left.select("file_id", "s.comment_id", "s.url", "s.next_url", corpus.resume_offset(F.lit(100).cast("bigint"), F.col("s.offset")).alias("offset"))


@query("SELECT t.row_id FROM topic_info t WHERE t.topic_url IS NULL OR t.topic_url NOT IN (SELECT u FROM (SELECT json_extract_string(j, '$.data.url') AS u FROM (SELECT CASE WHEN json_valid(raw) THEN raw::JSON END AS j FROM topic_docs) WHERE json_extract_string(j, '$.extra.scrape_status') = 'finished' AND json_type(j, '$.comments') = 'ARRAY') WHERE u IS NOT NULL)")
def topics_not_finished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed topics without a finished document."""
    valid = corpus.documents(table(spark, sf_dir, "topic_docs").select("file_id", "raw"), "file_id", "raw").filter("status = 'complete'").select("file_id")
    done = table(spark, sf_dir, "topic_docs").filter(corpus.closed(F.col("raw"), "status")).join(valid, "file_id", "left_semi").select(F.get_json_object("raw", "$.data.url").alias("topic_url"))
    return state.unfinished(table(spark, sf_dir, "topic_info").select("row_id", "topic_url"), "topic_url", done).select("row_id")


@query("SELECT file_id, regexp_replace(right(hex(encode(raw)), 1024), '^(?:[89AB][0-9A-F]){1,3}', '') AS tail FROM topic_docs")
def byte_tails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last 512 bytes of each document, in hexadecimal form."""
    return table(spark, sf_dir, "topic_docs").select("file_id", F.hex(readers.tail("raw", 512)).alias("tail"))


@query("SELECT topic_url, count(*) AS saved_comment_count, max(extra.list_offset) AS last_offset, 'finished' AS scrape_status FROM comments WHERE topic_url IS NOT NULL GROUP BY topic_url")
def finished_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics written as documents with header, items and trailer, their parts counted together."""
    rows = table(spark, sf_dir, "comments").filter("topic_url is not null").select("topic_url", "page_no", "pos", "data", F.col("extra.list_offset").alias("list_offset"))
    docs = items.topic_documents(rows, "topic_url", "page_no", "pos", F.struct("data", "list_offset"))
    closed = writers.closed_documents(writers.stream_documents(docs, ["topic_url"]))
    return closed.groupBy("topic_url", F.col("extra.scrape_status").alias("scrape_status")).agg(F.sum("extra.saved_comment_count").alias("saved_comment_count"), F.max("extra.last_offset").alias("last_offset"))


_READABLE = f"""SELECT file_id, file_name, list_concat([CASE WHEN json_type(j, '$.data.content') = 'VARCHAR' THEN json_extract_string(j, '$.data.content') END], CASE WHEN json_type(j, '$.comments') = 'ARRAY' THEN list_transform(json_extract(j, '$.comments[*]'), lambda x: CASE WHEN json_type(x, '$.data') = 'VARCHAR' THEN json_extract_string(x, '$.data') END) ELSE [] END) AS texts FROM {_JSON}
    WHERE json_type(j) = 'OBJECT' AND coalesce(json_type(j, '$.data'), 'OBJECT') = 'OBJECT' AND (coalesce(json_type(j, '$.comments'), '') <> 'ARRAY' OR len(list_filter(json_extract(j, '$.comments[*]'), lambda x: json_type(x) <> 'OBJECT')) = 0)"""
_WORDS = f"CAST(list_sum(list_transform(list_filter(texts, lambda t: t IS NOT NULL), lambda t: len(regexp_extract_all(t, '{WORD}')))) AS BIGINT)"
#: SQL of queries that were registered elsewhere.
DOCUMENT_SQL = {
    "document_words": f"SELECT file_id, file_name, coalesce({_WORDS}, 0) AS words FROM ({_READABLE})",
    "validity_totals": "SELECT CASE WHEN grouping(s) = 0 THEN s END AS status, count(*) AS files FROM (SELECT CASE WHEN coalesce(json_valid(raw), false) THEN 'complete' ELSE 'badformat' END AS s FROM topic_docs) GROUP BY ROLLUP (s)",
    "document_rows": f"SELECT file_id, CAST(i - 1 AS INTEGER) AS text_no, 0 AS place, {line_sql('t[i]')} AS item FROM (SELECT file_id, t, unnest(range(1, len(t) + 1)) AS i FROM (SELECT file_id, list_filter(texts, lambda t: t IS NOT NULL) AS t FROM ({_READABLE}))) WHERE {line_sql('t[i]')} <> ''",
    "repaired_documents": "SELECT CASE WHEN coalesce(json_valid(raw), false) THEN 'complete' ELSE 'badformat' END AS raw, CASE WHEN coalesce(json_valid(f), false) THEN 'complete' ELSE 'badformat' END AS fixed, count(*) AS files FROM (SELECT raw, regexp_replace(raw, '(\"comments\"\\s*:\\s*\\[\\s*)\\r?\\n\\s*,(\\s*\\{)', '\\1' || chr(10) || '\\2') AS f FROM topic_docs) GROUP BY 1, 2",
    "safe_titles": "SELECT topic_title, coalesce(nullif(regexp_replace(regexp_replace(trim(regexp_replace(translate(replace(strip_accents(coalesce(topic_title, '')), ':', ' -'), '/\\|<>?*\"', '---()'), '\\s+', ' ', 'g')), '[. ]+$', '')[:180], '[. ]+$', ''), ''), 'ismeretlen') AS file_name FROM (SELECT DISTINCT topic_title FROM topic_info)",
    "html_round_trip": f"SELECT row_id, nullif(coalesce(extra.comment_id, ''), '') AS comment_id, nullif({strip_sql(f'replace({_AUTHOR}, chr(13), chr(10))')}, '') AS author, nullif({strip_sql('data')}, '') AS data FROM comments",
}


@query(f"WITH w AS (SELECT {_WORDS} AS n FROM ({_READABLE})) SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS words, count(*) AS processed, (SELECT count(*) FROM topic_docs) - count(*) AS failed FROM w")
def word_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, and how many documents could be read."""
    return corpus.word_totals(corpus.documents(table(spark, sf_dir, "topic_docs"), "file_id", "raw"))


@query("SELECT count(*) AS seen, count(*) FILTER (regexp_replace(raw, '(\"comments\"\\s*:\\s*\\[\\s*)\\r?\\n\\s*,(\\s*\\{)', '\\1' || chr(10) || '\\2') <> raw) AS changed FROM topic_docs")
def repair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that the repair saw and changed."""
    return corpus.repair_counts(table(spark, sf_dir, "topic_docs"), "raw")


@query(
    """WITH s AS (SELECT file_name, CASE WHEN coalesce(json_valid(raw), false) THEN 'complete' ELSE 'badformat' END AS status FROM topic_docs), t AS (SELECT count(*) AS n, count(*) FILTER (status = 'complete') AS c, count(*) FILTER (status = 'badformat') AS b FROM s)
    SELECT 0 AS place, file_name AS key, file_name || chr(9) || status AS line FROM s UNION ALL SELECT 1, '', '' UNION ALL SELECT 2, '', 'total' || chr(9) || n FROM t UNION ALL SELECT 3, '', 'complete' || chr(9) || c FROM t UNION ALL SELECT 4, '', 'badformat' || chr(9) || b FROM t"""
)
def validity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the report on validity."""
    docs = table(spark, sf_dir, "topic_docs").select("file_id", "file_name", "raw")
    return writers.validity_report(docs.select("file_id", "file_name").join(corpus.documents(docs, "file_id", "raw"), "file_id"), "file_name")


@query(
    f"""WITH w AS (SELECT file_name, coalesce({_WORDS}, 0) AS n FROM ({_READABLE})) SELECT 0 AS place, file_name AS key, file_name || ' -> ' || n || ' szó' AS line FROM w UNION ALL SELECT 1, '', ''
    UNION ALL SELECT 2, '', 'Összesen -> ' || coalesce(sum(n), 0) || ' szó' FROM w UNION ALL SELECT 3, '', 'Sikeres fájlok: ' || count(*) FROM w UNION ALL SELECT 4, '', 'Hibás fájlok: ' || ((SELECT count(*) FROM topic_docs) - count(*)) FROM w"""
)
def word_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the report on words."""
    docs = table(spark, sf_dir, "topic_docs").select("file_id", "file_name", "raw")
    read = corpus.documents(docs, "file_id", "raw")
    counts = docs.select("file_id", "file_name").join(corpus.word_counts(read, "file_id"), "file_id")
    return writers.word_report(counts, corpus.word_totals(read), "file_name")


@query("SELECT topic_url, coalesce(max(TRY_CAST(extra.comment_id AS BIGINT)), max(list_max(list_transform(regexp_extract_all(data, '\\b[0-9]{1,3}(?:\\.[0-9]{3})*\\b'), lambda n: TRY_CAST(replace(n, '.', '') AS BIGINT))))) AS comments FROM comments WHERE topic_url IS NOT NULL GROUP BY topic_url")
def largest_comment_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest comment id of each topic, else the largest number that its comments show."""
    rows = table(spark, sf_dir, "comments").filter("topic_url is not null")
    return rows.groupBy("topic_url").agg(F.coalesce(F.max(F.col("extra.comment_id").try_cast("bigint")), F.max(text.largest_number(F.col("data")))).alias("comments"))


# -- further scalars and whole records --------------------------------------------------------------------------------------------

scalar("clean_lines", "comments", "row_id", "data", text.clean_multiline, f"array_to_string(list_filter(list_transform(string_split(replace(coalesce({{x}}, ''), chr(13), ''), chr(10)), lambda l: {strip_sql(chr(114) + 'egexp_replace(replace(l, chr(160), chr(32)), ' + chr(39) + '[ \\t]+' + chr(39) + ', chr(32), ' + chr(39) + 'g' + chr(39) + ')')}), lambda l: l <> ''), chr(10))")
scalar("page_heads", "topic_info", "row_id", "topic_title", lambda x: text.html_head(F.concat(F.lit("<HTML><Head a>"), x, F.lit("</head><body></body>"))), "'<Head a>' || {x} || '</head>'")
scalar("head_of_file", "topic_docs", "file_id", "raw", lambda x: F.hex(F.substring(F.encode(x, "UTF-8"), 1, 512)), "left(hex(encode({x})), 1024)")
scalar("earlier_ranges", "topic_info", "row_id", "row_id", lambda x: urls.previous_range(F.concat(F.lit("https://a.test/t/hsz_"), ((x % 7) * 100 + 1).cast("string"), F.lit("-"), ((x % 7) * 100 + 100).cast("string"), F.lit(".html"))), "CASE WHEN {x} % 7 > 0 THEN 'https://a.test/t/hsz_' || (({x} % 7) * 100 - 99) || '-' || (({x} % 7) * 100) || '.html#msg' || (({x} % 7) * 100 + 1) END")
scalar("next_starts", "topic_info", "row_id", "thread_id", lambda x: urls.next_start(F.concat(F.lit("https://a.test/?na_start="), x, F.lit("&na_step=30"))), "CASE WHEN regexp_matches({x}, '^[0-9]+$') THEN CAST({x} AS BIGINT) + 30 END")
scalar("absolute_links", "ad_details", "row_id", "url", lambda x: urls.absolute(F.lit("https://zsibi.test/a/b?c=1#d"), F.regexp_replace(x, "^https://[^/]*/[^/]*", "..")), "regexp_replace({x}, '^https://[^/]*/[^/]*', 'https://zsibi.test')")
scalar("url_with_page", "topic_info", "row_id", "topic_url", lambda x: urls.with_param(F.concat(x, F.lit("#c")), F.lit("page"), F.lit("4")), "{x} || CASE WHEN contains({x}, '?') THEN '&' ELSE '?' END || 'page=4'")


@query(f"SELECT row_id, {line_sql('replace(replace(t, chr(38), chr(38)), chr(13), chr(10))')} AS title FROM (SELECT row_id, topic_title AS t FROM topic_info WHERE topic_title IS NOT NULL AND {line_sql('topic_title')} <> '' AND NOT contains(topic_title, '<') AND NOT contains(topic_title, '&'))")
def titles_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles read back from pages whose heading, named second in the chain, holds them."""
    shown = table(spark, sf_dir, "topic_info").filter("not contains(topic_title, '<') and not contains(topic_title, '&')").filter(text.one_line(F.col("topic_title")) != "")
    pages = shown.select("row_id", F.concat(F.lit("<html><body><h1>"), F.col("topic_title"), F.lit("</h1></body></html>")).alias("html"), F.lit("https://a.test/").alias("url"))
    return html.extract(pages, ["row_id"], "html", "url", html.PAGE_TITLE).select("row_id", text.one_line(F.col("title")).alias("title"))


@query("SELECT row_id, 0 AS place, topic_url AS url, 'x' AS title FROM topic_info WHERE topic_url IS NOT NULL UNION ALL SELECT row_id, 1, 'https://a.test/b/c', 'y' FROM topic_info WHERE topic_url IS NOT NULL")
def harvested_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of a page, absolute and with their places; one without an address is none."""
    page = F.concat(F.lit('<a name="n">z</a><p><a href="'), F.col("topic_url"), F.lit('">x</a><a href="../b/c" title="y"></a>'))
    pages = table(spark, sf_dir, "topic_info").filter("topic_url is not null").select("row_id", page.alias("html"), F.lit("https://a.test/d/e").alias("url"))
    return html.extract(pages, ["row_id"], "html", "url", html.LINKS).select("row_id", "place", "url", "title")


@query("SELECT row_id, page_no + 1 AS next_page FROM comments WHERE page_no IS NOT NULL")
def pagers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next pages read from pagers that show the pages around the current one."""
    link = lambda n: F.concat(F.lit('<a href="?page='), n.cast("string"), F.lit('">'), n.cast("string"), F.lit("</a>"))
    n = F.col("page_no")
    page = F.concat(F.lit('<div class="pager">'), link(n - 1), F.lit("<b>"), n.cast("string"), F.lit("</b>"), link(n + 2), link(n + 1), F.lit("</div>"))
    pages = table(spark, sf_dir, "comments").filter("page_no is not null").select("row_id", "page_no", page.alias("html"), F.lit("https://a.test/t").alias("url"))
    links = html.extract(pages, ["row_id", "page_no"], "html", "url", html.PAGER).groupBy("row_id", "page_no").agg(F.collect_list(urls.page_number(F.col("url"))).alias("c"))
    return links.select("row_id", paging.next_page(F.col("c"), F.col("page_no").cast("bigint")).cast("int").alias("next_page"))


@query(
    f"""SELECT row_id, {_AUTHOR} AS shown, CASE WHEN len(p) < 2 THEN p[1] END AS name, CASE WHEN len(p) >= 2 THEN p[1] END AS family, CASE WHEN len(p) >= 2 THEN array_to_string(p[2:], ' ') END AS given, likes, dislikes, rating, date, url, CASE WHEN coalesce(extra.is_offtopic, false) THEN 'offtopic' ELSE '' END AS tags,
    extra.parent_author AS parent_author, extra.index_total AS index_total, extra.is_offtopic AS is_offtopic, 'szerzői jog' AS rights FROM (SELECT *, regexp_extract_all({_AUTHOR}, '{WORD}') AS p FROM comments)"""
)
def whole_comment_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other parts of comments as output items, and the constant rights note."""
    author = F.coalesce(F.get("authors", F.lit(0))["name"], F.concat_ws(" ", F.get("authors", F.lit(0))["family"], F.get("authors", F.lit(0))["given"]))
    rows = table(spark, sf_dir, "comments")
    extra = [F.col(f"extra.{n}").alias(n) for n in ("comment_id", "parent_author", "index", "index_total", "is_offtopic")]
    rows = rows.select("row_id", author.alias("author"), "date", "likes", "dislikes", "rating", "url", "data", *extra)
    made = rows.select("row_id", F.col("author").alias("shown"), items.comment_item().alias("i"), items.rights("szerzői jog"))
    first = F.get("i.authors", F.lit(0))
    return made.select("row_id", "shown", first["name"].alias("name"), first["family"].alias("family"), first["given"].alias("given"), "i.likes", "i.dislikes", "i.rating", "i.date", "i.url", F.array_join("i.tags", ",").alias("tags"), "i.extra.parent_author", "i.extra.index_total", "i.extra.is_offtopic", "rights")


@query("SELECT row_id, extra.seller_name AS seller, extra.comment_id AS ad_id, extra.details['Állapot'] AS state, CAST(coalesce(cardinality(extra.details), 0) AS INTEGER) AS details FROM comments WHERE extra.details IS NOT NULL")
def ads_with_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classified ads as output items with their details map."""
    rows = table(spark, sf_dir, "comments").filter("extra.details is not null")
    rows = rows.select("row_id", F.col("extra.title").alias("title"), F.col("extra.seller_name").alias("seller"), "date", F.col("data").alias("description"), "url", F.col("extra.comment_id").alias("ad_id"), F.col("extra.details").alias("details"))
    made = rows.select("row_id", items.ad_item(with_details=True).alias("i"))
    return made.select("row_id", "i.extra.seller", "i.extra.ad_id", F.try_element_at("i.extra.details", F.lit("Állapot")).alias("state"), F.size("i.extra.details").alias("details"))


@query("SELECT row_id FROM (SELECT row_id, row_number() OVER (PARTITION BY topic_url, page_no, coalesce(extra.comment_id, ''), coalesce(date, ''), substr(" + clean_sql("data") + ", 1, 300) ORDER BY row_id) AS n FROM comments WHERE topic_url IS NOT NULL) WHERE n = 1")
def first_of_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First comment of each signature on a page; signatures are hashed before they are shuffled."""
    rows = table(spark, sf_dir, "comments").filter("topic_url is not null")
    sign = state.signature(F.col("extra.comment_id"), F.lit(None).cast("string"), F.col("date"), F.col("data"))
    keyed = rows.select("topic_url", "page_no", F.sha1(sign).alias("sign"), "row_id")
    return state.first_of(keyed, ["topic_url", "page_no", "sign"], ["row_id"]).select("row_id")


@query("SELECT origin, group_title, topic_url, page_no, count(*) AS comments FROM (SELECT DISTINCT origin, group_title, topic_url FROM topic_info) JOIN (SELECT topic_url, page_no FROM comments) USING (topic_url) GROUP BY ALL")
def comments_by_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments counted along group, topic and page; comments are counted by page before they are joined."""
    topics = table(spark, sf_dir, "topic_info").select("origin", "group_title", "topic_url").distinct()
    pages = table(spark, sf_dir, "comments").filter("topic_url is not null").groupBy("topic_url", "page_no").agg(F.count("*").alias("n"))
    return topics.join(pages, "topic_url").groupBy("origin", "group_title", "topic_url", "page_no").agg(F.sum("n").alias("comments"))
