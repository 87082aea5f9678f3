"""Sources: JSON document files, visited keys, listing pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosta.functions.text import SPACE_CHARS


def document_files(spark: SparkSession, folder: str, recursive: bool = True, pattern: str = "*.json") -> DataFrame:
    """(path, raw) of all document files below a folder; ``raw`` is null where the bytes are no UTF-8."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", pattern).load(folder)
    text = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string"))
    return files.select("path", text.alias("raw"))


def by_path(df: DataFrame) -> DataFrame:
    """Rows in the order of their paths, part by part."""
    return df.orderBy(F.split("path", "/"))


def visited(spark: SparkSession, path: str, column: int = 0) -> DataFrame:
    """(key) of a visited file, one key per line or tab-separated columns; blank and repeated keys dropped."""
    field = F.get(F.split("value", "\t"), F.lit(column))
    key = F.regexp_replace(field, f"^[{SPACE_CHARS}]+|[{SPACE_CHARS}]+$", "")
    return spark.read.text(path).select(key.alias("key")).filter("key <> ''").distinct()


def listing_pages(spark: SparkSession, start: int, end: int, step: int = 1) -> DataFrame:
    """(page) from ``start`` to ``end``, both included, by ``step``; with a step of 100 both must be multiples of it."""
    if start > end or step < 1 or (step > 1 and (start % step or end % step)):
        raise ValueError(f"no range of pages: {start} to {end} by {step}")
    return spark.range(start, end + 1, step).withColumnRenamed("id", "page")


def head(raw: str, size: int):  # noqa: ANN201
    """First ``size`` bytes of a text column as text."""
    return F.decode(F.substring(F.encode(F.col(raw), "UTF-8"), 1, size), "UTF-8")


def tail(raw: str, size: int):  # noqa: ANN201
    """Last ``size`` bytes of a text column as text; a character that the cut splits is left out."""
    kept = F.expr(f"substring(encode(`{raw}`, 'UTF-8'), greatest(octet_length(`{raw}`) - {int(size)} + 1, 1))")
    # bytes of the form 10xxxxxx at the head belong to a character that begins before the cut
    bare = F.regexp_replace(F.hex(kept), "^(?:[89AB][0-9A-F]){1,3}", "")
    return F.unhex(bare).cast("string")
