"""Queries of the general problems: nested records (p2) and displayed times (p3)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosta.operators.instants import resolve_instants
from rosta.operators.shredding import child_records, flat_tables
from rosta.session import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every child record of the topic documents."""
    out = child_records(table(spark, sf_dir, "topic_docs"), "file_id", "raw")
    return out.select("file_id", F.col("place").alias("comment_pos"), "child", "child_key")


def _flat(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """Query of one flat table of the topic documents."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return flat_tables(table(spark, sf_dir, "topic_docs"), "file_id", "raw")[name]

    query.__doc__ = f"The {name} of all topic documents, with file_id and comment_pos."
    return query


def dated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """comments and ad_details as (src, row_id, origin, date, scraped_at, zone)."""
    columns = ["row_id", "origin", "date", "scraped_at"]
    both = [table(spark, sf_dir, t).select(F.lit(t).alias("src"), *columns) for t in ("comments", "ad_details")]
    zones = table(spark, sf_dir, "sites").groupBy("origin").agg(F.min("zone").alias("zone"))
    return both[0].unionByName(both[1]).join(zones, "origin", "left")


def p3_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dated row with its instant or null, chosen by its source's chain among all readings; the stated rules are costs in it."""
    return resolve_instants(dated_rows(spark, sf_dir), ["src", "row_id"], ["src", "origin"], "row_id", "date", "scraped_at", "zone", pruned=False)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose date fixes an instant."""
    return p3_instants(spark, sf_dir).filter("utc_ms is not null").select("src", "row_id", "utc_ms")


def p3_chained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dated row with the instant that its source's chain chooses where no rule states the order of day and month or the side of a clock change."""
    rows = dated_rows(spark, sf_dir)
    return resolve_instants(rows, ["src", "row_id"], ["src", "origin"], "row_id", "date", "scraped_at", "zone", day_first=None, first_side=None)


FLAT = ("comments", "authors", "details", "crumbs", "replies")
QUERIES = {"p2_found": p2_found, "p3_found": p3_found, "p3_chained": p3_chained} | {f"p2_{name}": _flat(name) for name in FLAT}
ORACLES: dict[str, str] = {}
