"""What a crawl keeps as state, as window and aggregate expressions: first occurrences, fingerprints, resuming, guards.

A topic may hold a large share of all rows, and of all pages. What needs its pages in order runs in ranges of page numbers: a window
holds one range, and one over a whole topic only a row per range, from which sums or last pages are carried into the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosta.functions.text import clean_text
from rosta.session import written


def first_of(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row for each key, the first by ``order``; by aggregation, so that a key that many rows share is combined early."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def unvisited(df: DataFrame, key: Column, visited: DataFrame, visited_key: Column) -> DataFrame:
    """Rows of ``df`` whose key is not among the visited ones; rows without a key stay."""
    known = visited.select(visited_key.alias("_visited")).filter("_visited is not null").distinct()
    return df.withColumn("_visited", key).join(known, "_visited", "left_anti").drop("_visited")


def unvisited_by_any(df: DataFrame, identity: list[str], keys: list[Column], visited: DataFrame, visited_key: str) -> DataFrame:
    """Rows of ``df`` none of whose keys is visited; ``identity`` names a row."""
    each = df.select(*identity, F.explode(F.array_compact(F.array(*keys))).alias("_key"))
    known = visited.select(F.col(visited_key).alias("_key")).distinct()
    return df.join(each.join(known, "_key", "left_semi").select(*identity).distinct(), identity, "left_anti")


def signature(comment_id: Column, author: Column, date: Column, text: Column, index: Column | None = None) -> Column:
    """``id|author|date|[index|]first 300 characters`` of a comment; nulls are empty."""
    parts = [comment_id, author, date] + ([index.cast("string")] if index is not None else [])
    return F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts], F.substring(clean_text(text), 1, 300))


def fingerprints(df: DataFrame, page: list[str], order: list[str], sign: Column) -> DataFrame:
    """One row per page with ``fingerprint``: the hash of its signatures in page order, and ``rows``."""
    collected = F.sort_array(F.collect_list(F.struct(*order, sign.alias("_sign"))))
    return df.groupBy(*page).agg(F.sha1(F.array_join(F.transform(collected, lambda x: x["_sign"]), "\n")).alias("fingerprint"), F.count("*").alias("rows"))


#: Page numbers of one range.
RANGE = 4096


def with_neighbour(pages: DataFrame, topic: str, number: str, value: str, name: str, before: bool = True) -> DataFrame:
    """``pages`` with ``name``: the value of the topic's page before (or behind), null for its first (last); topics are no nulls."""
    held = F.struct(F.col(value).alias("v"))
    ranged = pages.withColumn("_range", F.floor(F.col(number) / RANGE))
    pick, order = (F.max_by, F.col) if before else (F.min_by, lambda c: F.col(c).desc())
    edges = ranged.groupBy(topic, "_range").agg(pick(held, number).alias("_edge"))
    carried = edges.select(topic, "_range", F.lag("_edge").over(Window.partitionBy(topic).orderBy(order("_range"))).alias("_carried"))
    inner = Window.partitionBy(topic, "_range").orderBy(order(number))
    out = ranged.join(carried, [topic, "_range"]).withColumn("_near", F.coalesce(F.lag(held).over(inner), F.when(F.row_number().over(inner) == 1, F.col("_carried"))))
    return out.withColumn(name, F.col("_near.v")).select(*pages.columns, name)


def with_previous(pages: DataFrame, topic: str, number: str, value: str, name: str) -> DataFrame:
    """``with_neighbour`` of the page before."""
    return with_neighbour(pages, topic, number, value, name)


def with_next(pages: DataFrame, topic: str, number: str, name: str) -> DataFrame:
    """``pages`` with ``name``: the number of the topic's next page, null for its last."""
    return with_neighbour(pages, topic, number, number, name, before=False)


def until_repeat(pages: DataFrame, topic: str, number: str) -> DataFrame:
    """Pages of each topic before the first whose fingerprint occurred before, with ``same_as_previous`` for the comparison alone.

    The pages are written once, as several steps read them.
    """
    pages = written(pages, "pages")
    marked = with_previous(pages, topic, number, "fingerprint", "_before").withColumn("same_as_previous", F.coalesce(F.col("_before") == F.col("fingerprint"), F.lit(False))).drop("_before")
    # the second page of a fingerprint is its first repetition
    again = pages.groupBy(topic, "fingerprint").agg(F.min(number).alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    later = pages.join(again, [topic, "fingerprint"]).filter(F.col(number) > F.col("_first"))
    stop = later.groupBy(topic).agg(F.min(number).alias("_stop"))
    return marked.join(stop, topic, "left").filter(F.col("_stop").isNull() | (F.col(number) < F.col("_stop"))).drop("_stop").select(*pages.columns, "same_as_previous")


def resumed(df: DataFrame, markers: DataFrame, topic: str, number: str, place: str, identity: str, policy: str) -> DataFrame:
    """Comments that are new after each topic's marker (columns ``topic``, ``_page``, ``_marker``: the page to resume at and the last id).

    Pages before the resumed one are old. ``new``: on that page those after the marker are new, all of them if it is not there.
    ``advance``: those after the marker wherever it first appears from that page on, none if it never does. ``skip``: on that page
    those after the marker, none if it is not there; later pages are new. A topic without a marker is new as a whole.
    """
    at = F.struct(number, place)
    joined = df.join(markers, topic, "left")
    hit = joined.filter((F.col(identity) == F.col("_marker")) & (F.col(number) >= F.col("_page")))
    first = hit.groupBy(topic).agg(F.min(at).alias("_found"))
    joined = joined.join(first, topic, "left")
    here, later = F.col(number) == F.col("_page"), F.col(number) > F.col("_page")
    after = at > F.col("_found")
    on_page = F.coalesce(F.col("_found")[number] == F.col("_page"), F.lit(False))
    rule = {
        "new": later | (here & (~on_page | F.coalesce(after, F.lit(False)))),
        "advance": F.coalesce(after, F.lit(False)),
        "skip": later | (here & on_page & F.coalesce(after, F.lit(False))),
    }[policy]
    return joined.filter(F.col("_marker").isNull() | rule).select(*df.columns)


def until_empty_run(pages: DataFrame, topic: str, number: str, rows: str, most: int = 3, first: int | None = None) -> DataFrame:
    """Pages of each topic that are not empty and stand before the first run of ``most`` empty ones; pages that are missing are empty.

    first: number of the first page of every topic; where None it is the first one given. Only the gaps between pages are looked at,
    so a page of a very large number costs nothing.
    """
    full = pages.filter(F.col(rows) > 0)
    begin = pages.groupBy(topic).agg(F.min(number).alias("_begin")) if first is None else pages.select(topic).distinct().withColumn("_begin", F.lit(first))
    gaps = with_previous(full, topic, number, number, "_before").join(begin, topic)
    gap = F.col(number) - F.coalesce(F.col("_before") + 1, F.col("_begin"))
    stop = gaps.filter(gap >= most).groupBy(topic).agg(F.min(number).alias("_stop"))
    return full.join(stop, topic, "left").filter(F.col("_stop").isNull() | (F.col(number) < F.col("_stop"))).select(*pages.columns)


def running_total(pages: DataFrame, topic: str, number: str, rows: str) -> DataFrame:
    """Pages with the running total of their rows within the topic."""
    ranged = pages.withColumn("_range", F.floor(F.col(number) / RANGE))
    sums = ranged.groupBy(topic, "_range").agg(F.sum(rows).alias("_sum"))
    before = Window.partitionBy(topic).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(topic, "_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_carried"))
    inner = Window.partitionBy(topic, "_range").orderBy(number).rowsBetween(Window.unboundedPreceding, 0)
    return ranged.join(carried, [topic, "_range"]).withColumn("total", F.col("_carried") + F.sum(rows).over(inner)).select(*pages.columns, "total")


def finished(df: DataFrame, status: str) -> DataFrame:
    """Documents marked as finished; those that are already stay as they are."""
    return df.withColumn(status, F.lit("finished"))


def unfinished(df: DataFrame, key: str, done: DataFrame) -> DataFrame:
    """Rows whose document is not among the finished ones: those are skipped without a look at their pages."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def all_done(df: DataFrame, group: str, done: Column) -> DataFrame:
    """(group, members, complete): whether every member of a group is done."""
    return df.groupBy(group).agg(F.count("*").alias("members"), F.every(F.coalesce(done, F.lit(False))).alias("complete"))
