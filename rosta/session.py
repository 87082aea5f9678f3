"""Session helpers shared by all operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory, whole; columns are pruned by the plan that uses it."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where that is unset, a folder of our own serves a session that runs in this one process, as in tests; on a cluster it would lie on
    each machine apart, so there the setting is required.
    """
    given = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not given:
        if not (spark.conf.get("spark.master", "") or "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        given = tempfile.mkdtemp(prefix="rosta-work-")
        atexit.register(shutil.rmtree, given, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", given)
    return given.rstrip("/")


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage by a Parquet table in the shared folder: it survives the loss of any executor, and is removed when the driver ends."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/rosta-{label}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    df.write.parquet(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.parquet(path)
