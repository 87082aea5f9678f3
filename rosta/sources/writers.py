"""Sinks: documents, item tables, visited keys, reports. Writes are committed as a whole by Spark's protocol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosta.functions.text import safe_file_name


def write_documents(docs: DataFrame, folder: str, mode: str = "errorifexists") -> None:
    """One JSON document per line, nulls kept, in folders by ``origin`` where that is a column."""
    by = ["origin_dir"] if "origin" in docs.columns else []
    out = docs.withColumn("origin_dir", safe_file_name(F.col("origin"))) if by else docs
    out.write.mode(mode).option("ignoreNullFields", "false").partitionBy(*by).json(folder)


def append_items(items: DataFrame, folder: str, by: list[str]) -> None:
    """Items appended to a Parquet table partitioned by sanitised labels."""
    named = items
    for column in by:
        named = named.withColumn(f"{column}_dir", safe_file_name(F.col(column)))
    named.write.mode("append").partitionBy(*[f"{c}_dir" for c in by]).parquet(folder)


def append_visited(keys: DataFrame, folder: str) -> DataFrame:
    """New keys only appended to a visited table; returns them. ``keys`` has one column ``key``."""
    spark = keys.sparkSession
    fresh = keys.filter("key <> ''").distinct()
    try:
        fresh = fresh.join(spark.read.text(folder).toDF("key"), "key", "left_anti")
    except Exception as error:  # the table does not exist yet
        if "PATH_NOT_FOUND" not in str(error):
            raise
    fresh.write.mode("append").text(folder)
    return fresh


def stream_documents(items: DataFrame, header: list[str], status: str = "running") -> DataFrame:
    """Documents (header columns, ``comments``, ``part``) with header, items and trailer in the order of a streamed file.

    The header holds the columns ``header``, the trailer ``extra``: the status, the number of items and the last offset where items have one.
    """
    fields = items.schema["comments"].dataType.elementType.fieldNames()
    offset = F.array_max(F.transform("comments", lambda c: c["list_offset"])) if "list_offset" in fields else F.lit(None).cast("int")
    extra = F.struct(F.lit(status).alias("scrape_status"), F.size("comments").alias("saved_comment_count"), offset.alias("last_offset"))
    return items.select(*header, "part", "comments", extra.alias("extra"))


def closed_documents(docs: DataFrame) -> DataFrame:
    """Documents whose trailer says that they are finished; one that does already stays as it is."""
    return docs.withColumn("extra", F.col("extra").withField("scrape_status", F.lit("finished")))


def report_lines(rows: DataFrame, key: str, text: Column, totals: DataFrame) -> DataFrame:
    """(place, key, line): the lines of a report (place 0, by key), an empty one (1), and those of ``totals`` (place from 2 on, line)."""
    body = rows.select(F.lit(0).alias("place"), F.col(key).cast("string").alias("key"), text.alias("line"))
    gap = rows.sparkSession.range(1).select(F.lit(1).alias("place"), F.lit("").alias("key"), F.lit("").alias("line"))
    return body.unionByName(gap).unionByName(totals.select("place", F.lit("").alias("key"), "line"))


def _lines(totals: DataFrame, shown: list[tuple[str, str]]) -> DataFrame:
    """One row of figures as lines (place, line): a caption before each of its columns."""
    each = F.array(*[F.struct(F.lit(i + 2).alias("place"), F.concat(F.lit(caption), F.col(c).cast("string")).alias("line")) for i, (caption, c) in enumerate(shown)])
    return totals.select(F.inline(each))


def validity_report(docs: DataFrame, path: str) -> DataFrame:
    """``path<TAB>status`` of every document, and the numbers of all, complete and unreadable ones."""
    counts = docs.agg(F.count("*").alias("total"), F.count_if(F.col("status") == "complete").alias("complete"), F.count_if(F.col("status") == "badformat").alias("badformat"))
    return report_lines(docs, path, F.concat_ws("\t", path, "status"), _lines(counts, [(f"{n}\t", n) for n in ("total", "complete", "badformat")]))


def word_report(counts: DataFrame, totals: DataFrame, path: str) -> DataFrame:
    """``path -> n szó`` of every readable document, and the totals (columns words, processed, failed)."""
    captions = [("Összesen -> ", "shown"), ("Sikeres fájlok: ", "processed"), ("Hibás fájlok: ", "failed")]
    shown = totals.withColumn("shown", F.concat(F.col("words").cast("string"), F.lit(" szó")))
    return report_lines(counts, path, F.concat(F.col(path), F.lit(" -> "), F.col("words").cast("string"), F.lit(" szó")), _lines(shown, captions))


def write_report(lines: DataFrame, folder: str) -> None:
    """A report's lines as text, in their order: sorted by place and path, part by part."""
    lines.orderBy("place", F.split("key", "/")).select(F.col("line").alias("value")).write.mode("overwrite").text(folder)


def write_pages(pages: DataFrame, html: str, folder: str) -> None:
    """Captured pages as text, for debugging."""
    pages.select(F.col(html).alias("value")).filter("value is not null").write.mode("overwrite").option("lineSep", "\n\f\n").text(folder)


def word_dump(items: DataFrame, key: str, folder: str) -> None:
    """One line per word or row, each document's after a header, all in order; a document of any length is never one row."""
    heads = items.select(key).distinct().select(key, F.lit(-1).alias("text_no"), F.lit(-1).alias("place"), F.concat(F.lit("===== "), F.col(key).cast("string"), F.lit(" =====")).alias("item"))
    both = heads.unionByName(items.select(key, F.col("text_no").cast("int").alias("text_no"), F.col("place").cast("int").alias("place"), "item"))
    both.orderBy(key, "text_no", "place").select(F.col("item").alias("value")).write.mode("overwrite").text(folder)


def post_blocks(df: DataFrame, folder: str) -> None:
    """Plain blocks of a post and its comments (columns ``post``, ``comments`` array<struct<author, text>>), closed by a rule of dashes."""
    answers = F.transform("comments", lambda c: F.concat(F.lit("Comment by "), F.coalesce(c["author"], F.lit("ismeretlen")), F.lit(": "), F.coalesce(c["text"], F.lit(""))))
    block = F.concat_ws("\n", F.concat(F.lit("Post: "), F.coalesce("post", F.lit(""))), F.array_join(answers, "\n"), F.repeat(F.lit("-"), 80))
    df.select(block.alias("value")).write.mode("overwrite").text(folder)
