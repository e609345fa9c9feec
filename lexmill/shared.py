"""Helpers shared by all operators: table access and lineage cuts that survive lost executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables of ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or in local mode one of our own."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="lexmill-")
        sc.setCheckpointDir(found)
        found = "file://" + found
    return found.rstrip("/")


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that later stages neither recompute it
    nor depend on the executors that made it. The files go when the JVM's file system closes."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lexmill/{uuid.uuid4().hex}-{label}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return spark.read.schema(df.schema).parquet(path)


def partitions(df: DataFrame, at_least: int = 8) -> int:
    """A number of partitions for a re-distribution of ``df``, from the session's setting."""
    return max(at_least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that Python workers anywhere can import it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="lexmill-"), "lexmill.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(here)))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)
