"""Access to the input tables of a data folder, and tables of our own in the shared folder."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from .shipping import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table `name` of the folder; read by Spark only, so any store it knows will do."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, what: str) -> str:
    """A fresh path in the folder of spark.checkpoint.dir, removed when the driver ends.

    Unset, it is an error on a cluster, where a folder of one machine is another one on each node; with one process (as in
    tests) a temporary folder is set.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root and context._jsc.sc().getCheckpointDir().isDefined():
        root = context._jsc.sc().getCheckpointDir().get()
    if not root:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="siltstone-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root}/siltstone-{what}-{uuid.uuid4().hex}"
    atexit.register(remove, spark, path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the cluster's store, if Spark still runs."""
    context = spark.sparkContext
    if context._jvm is None or context._jsc is None:
        return
    try:
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
    except Exception:  # the JVM has gone already; the folder is scratch space
        pass


def written(df: DataFrame, what: str, *partition_by: str) -> DataFrame:
    """`df` written once to the shared folder and read again: what follows computes nothing of it anew."""
    path = shared_folder(df.sparkSession, what)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
