"""Which page comes next: link chains, pagers, guards against loops, and lookups of links, all over captured pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosta.session import written


def link_chain(edges: DataFrame, starts: DataFrame, page: str, following: str, most: int) -> DataFrame:
    """(start, page, step): the pages that following links lead to from each start, up to ``most`` of them, each page once.

    edges: (page, following), one row per page, null at the end of a chain; starts: (start). A chain ends where it leads nowhere, or
    back to a page it has had. Links are doubled in each round, so a chain of n pages takes about log2(n) rounds of equi-joins.
    """
    jump = edges.select(F.col(page).alias("_from"), F.col(following).alias("_to")).filter("_to is not null and _from is not null")
    found = starts.select(F.col(starts.columns[0]).alias("start"), F.col(starts.columns[0]).alias("page"), F.lit(0).alias("step"))
    reach = 1
    while reach < most:
        ahead = found.join(jump, F.col("page") == F.col("_from")).select("start", F.col("_to").alias("page"), (F.col("step") + reach).alias("step"))
        found = written(found.unionByName(ahead).groupBy("start", "page").agg(F.min("step").alias("step")), "chain")
        onward = jump.alias("a").join(jump.alias("b"), F.col("a._to") == F.col("b._from")).select(F.col("a._from").alias("_from"), F.col("b._to").alias("_to"))
        jump, reach = written(onward, "jump"), reach * 2
    return found.filter(F.col("step") < most)


def smallest_larger(candidates: Column, current: Column) -> Column:
    """Smallest of the candidate numbers that is larger than the current one: a crawl only moves on; null without one."""
    return F.array_min(F.filter(candidates, lambda x: x > current))


def next_page(candidates: Column, current: Column) -> Column:
    """The page after the current one if it is among the candidates, else the smallest larger one."""
    return F.when(F.array_contains(candidates, current + 1), current + 1).otherwise(smallest_larger(candidates, current))


def next_link(links: Column, current: Column, built: Column) -> Column:
    """Address of the next page from links array<struct<page, url>>: the first of the exact next page, else of the smallest larger one, else ``built``."""
    wanted = next_page(F.transform(links, lambda x: x["page"]), current)
    return F.coalesce(F.try_element_at(F.filter(links, lambda x: x["page"] == wanted), F.lit(1))["url"], built)


def within_bounds(page: Column, start: int | None = None, end: int | None = None) -> Column:
    """Whether a page lies between the start and the end page, both included; no bound where None."""
    out = F.lit(True)
    if start is not None:
        out &= page >= start
    if end is not None:
        out &= page <= end
    return out


def walked_backwards(pages: DataFrame, topic: str, number: str, last: DataFrame) -> DataFrame:
    """Pages of each topic from its newest back to the one that was read last (``last``: topic, ``_last``), with their ``step`` in that walk.

    A topic without a last page is walked to its first one. The step is the distance of page numbers, so no topic is sorted.
    """
    newest = pages.groupBy(topic).agg(F.max(number).alias("_newest"))
    joined = pages.join(newest, topic).join(last, topic, "left")
    return joined.filter(F.col("_last").isNull() | (F.col(number) >= F.col("_last"))).withColumn("step", (F.col("_newest") - F.col(number)).cast("bigint")).select(*pages.columns, "step")


def first_link(links: DataFrame, target: DataFrame, url: str, order: list[str]) -> DataFrame:
    """For each target address the first link by ``order`` that leads to it; targets without one are left out."""
    rest = [c for c in links.columns if c != url]
    best = links.join(target.select(F.col(url)).distinct(), url, "left_semi").groupBy(url).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(url, *[F.col(f"_row.{c}").alias(c) for c in rest])


def enriched(details: DataFrame, cards: DataFrame, key: str, prefer_card: list[str], fill: list[str], unknown: dict[str, str] | None = None) -> DataFrame:
    """Detail rows with what their listing cards know: ``prefer_card`` columns from the card where it has them, ``fill`` columns only where the detail has none.

    cards: one row per key. unknown: texts that mean that a detail page showed nothing, by column.
    """
    has = lambda c: F.nullif(c, F.lit(""))
    columns = [*dict.fromkeys([*prefer_card, *fill])]
    joined = details.join(cards.select(key, *[F.col(c).alias(f"_card_{c}") for c in columns]), key, "left")
    for c in columns:
        own, card = has(F.col(c)), has(F.col(f"_card_{c}"))
        if c in prefer_card:
            joined = joined.withColumn(c, F.coalesce(card, own))
        else:
            if c in (unknown or {}):
                own = F.nullif(own, F.lit(unknown[c]))
            joined = joined.withColumn(c, F.coalesce(own, card, F.col(c)))
    return joined.select(*details.columns)
