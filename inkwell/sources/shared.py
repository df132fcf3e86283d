"""Cutting lineage between steps through the folder that driver and executors share."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> None:
    """Takes the cluster's folder; only a local session without one gets a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", "")
    if not spark.sparkContext.getCheckpointDir():
        if not named and not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="inkwell-ckpt-"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share."""
    checkpoint_folder(spark)
    return (spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()).rstrip("/")


def dealt(df: DataFrame, key: str) -> DataFrame:
    """df by key over all cores if its files make fewer partitions than that, else as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def settled(df: DataFrame) -> DataFrame:
    """df written once as a compressed table in the shared folder, with a plan that only reads it, and of it only the
    columns that are asked for. The files go when this process ends, or with `let_go`."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/settled-{uuid.uuid4().hex}"
    _written[path] = spark
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Folders that `settled` has written and nobody has removed, with their sessions.
_written: dict[str, SparkSession] = {}


def written() -> list[str]:
    """What `settled` has written and is there yet."""
    return list(_written)


def let_go(paths: list[str]) -> None:
    """Removes what `settled` wrote there; tables that read it can't be read any more."""
    for path in paths:
        if spark := _written.pop(path, None):
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@atexit.register
def _end() -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone
        let_go(written())
