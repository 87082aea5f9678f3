"""Records shaped for output: comment and ad items, topic documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosta.functions.text import split_name

AUTHORS = "array<struct<name:string,family:string,given:string>>"


def author_list(name: Column) -> Column:
    """A displayed name as a list of one author; an empty name as an empty list."""
    return F.when(F.coalesce(F.trim(name), F.lit("")) == "", F.array().cast(AUTHORS)).otherwise(F.array(split_name(name)).cast(AUTHORS))


def tags(offtopic: Column) -> Column:
    """``offtopic`` as the only tag of what is off topic."""
    return F.when(F.coalesce(offtopic, F.lit(False)), F.array(F.lit("offtopic"))).otherwise(F.array().cast("array<string>"))


def vote_score(likes: Column, dislikes: Column) -> Column:
    """Likes less dislikes; null only where both are."""
    return F.when(likes.isNotNull() | dislikes.isNotNull(), F.coalesce(likes, F.lit(0)) - F.coalesce(dislikes, F.lit(0)))


def vote_score_of_block(block: Column, likes: Column, dislikes: Column) -> Column:
    """Likes less dislikes where a page has a block of votes, missing ones as 0; null without the block. A shown -3 on the dislike side adds 3."""
    return F.when(block, F.coalesce(likes, F.lit(0)) - F.coalesce(dislikes, F.lit(0)))


def container_count(items: Column) -> Column:
    """Number of items of a page; null for none."""
    return F.nullif(F.size(F.coalesce(items, F.array())), F.lit(0))


def comment_item(language: str = "hu") -> Column:
    """An output item from the columns comment_id, author, date, likes, dislikes, rating, parent_author, index, index_total, is_offtopic, url, data."""
    return F.struct(
        author_list(F.col("author")).alias("authors"),
        F.col("data"),
        F.col("likes"),
        F.col("dislikes"),
        vote_score(F.col("likes"), F.col("dislikes")).alias("score"),
        F.col("rating"),
        F.col("date"),
        F.col("url"),
        F.lit(language).alias("language"),
        tags(F.col("is_offtopic")).alias("tags"),
        F.struct("comment_id", "parent_author", "index", "index_total", "is_offtopic").alias("extra"),
    )


def rights(text: str) -> Column:
    """The constant rights note of a document."""
    return F.lit(text).alias("rights")


def ad_item(language: str = "hu", with_details: bool = False) -> Column:
    """An output item from the columns title, seller, date, description, url, ad_id, and the map details on demand."""
    none = F.lit(None)
    return F.struct(
        F.col("title"),
        author_list(F.col("seller")).alias("authors"),
        F.col("description").alias("data"),
        none.cast("int").alias("likes"),
        none.cast("int").alias("dislikes"),
        none.cast("int").alias("score"),
        none.cast("string").alias("rating"),
        F.col("date"),
        F.col("url"),
        F.lit(language).alias("language"),
        F.array().cast("array<string>").alias("tags"),
        F.struct("seller", "ad_id", *([F.col("details")] if with_details else [])).alias("extra"),
    )


def details(cells: Column) -> Column:
    """Map of a details table: first cell of each row with two cells and more, without colons at its end, to the last cell; the last of equal keys wins."""
    rows = F.transform(F.filter(cells, lambda r: F.size(r) >= 2), lambda r: F.struct(F.regexp_replace(F.get(r, F.lit(0)), ":+$", "").alias("k"), F.element_at(r, -1).alias("v")))
    keys = F.transform(rows, lambda x: x["k"])
    last = F.filter(F.transform(rows, lambda x, i: F.struct(x["k"], x["v"], i.alias("i"))), lambda x: ~F.array_contains(F.slice(keys, x["i"] + 2, F.size(keys)), x["k"]))
    return F.map_from_entries(F.transform(last, lambda x: F.struct(x["k"], x["v"])))


def topic_documents(items: DataFrame, topic: str, number: str, place: str, item: Column, per_document: int = 5000) -> DataFrame:
    """(topic, part, comments): the items of each topic in order, in parts of ``per_document`` places of its pages at most.

    A topic of any size is written as several documents, so that none has to be held by one task.
    """
    part = F.floor((F.col(number) * 100 + F.col(place)) / per_document)
    rows = items.select(topic, part.alias("part"), F.struct(F.col(number).alias("n"), F.col(place).alias("p"), item.alias("item")).alias("_row"))
    return rows.groupBy(topic, "part").agg(F.transform(F.sort_array(F.collect_list("_row")), lambda x: x["item"]).alias("comments"))
