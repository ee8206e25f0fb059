"""Intermediate tables in the folder that a cluster shares."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can read, from ``spark.checkpoint.dir``.

    Only where that setting is missing and the master is local (tests) a temporary folder is used: on a cluster it
    would be a folder of each machine's own.
    """
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = getattr(spark, "_docloom_shared", None)
    if own is None:
        own = "file://" + tempfile.mkdtemp(prefix="docloom-")
        spark._docloom_shared = own
    return own


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session is gone; the folder belongs to the job and goes with it
        pass


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the program ends."""
    path = f"{shared_dir(spark)}/docloom/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    This cuts the lineage; executors may be lost afterwards without loss of data.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
