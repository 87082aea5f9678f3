"""Incremental loads: new items of arriving files, each once, with the visited keys as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rosta.operators.state import first_of


def arriving(spark: SparkSession, folder: str, like: DataFrame) -> DataFrame:
    """A stream of the Parquet files that arrive in a folder."""
    return spark.readStream.schema(like.schema).parquet(folder)


def load_new(stream: DataFrame, key: str, out: str, visited: str, checkpoint: str, order: list[str] | None = None) -> StreamingQuery:
    """Appends the rows of each batch whose key was not seen before; of equal keys in a batch the first by ``order``. Rows without a key are all kept.

    Each batch overwrites folders named by its number, in the items and in the visited table, so that a batch that is run again after
    a failure replaces what it wrote. Items are written before keys: a failure between them repeats the batch and loses nothing.
    """

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        rest = order or [c for c in rows.columns if c != key]
        fresh = first_of(rows.filter(F.col(key).isNotNull()), [key], rest)
        fs = spark._jvm.org.apache.hadoop.fs.Path(visited).getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(visited)):
            # of the visited keys only those of the batch, so what is joined is as small as the batch
            known = spark.read.parquet(visited).filter(F.col("batch") < number).select(key).join(fresh.select(key), key, "left_semi")
            fresh = fresh.join(known, key, "left_anti")
        fresh = fresh.persist()
        try:
            fresh.unionByName(rows.filter(F.col(key).isNull())).write.mode("overwrite").parquet(f"{out}/batch={number}")
            fresh.select(key).write.mode("overwrite").parquet(f"{visited}/batch={number}")
        finally:
            fresh.unpersist()

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time: str, by: str, size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Rows per tumbling window and group of a stream, rows later than ``late`` left out."""
    return stream.withWatermark(time, late).groupBy(F.window(time, size), by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), by, "n")
