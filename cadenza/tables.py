"""Table access by directory, and the shared folder for written intermediates."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a local one only where none is named (tests, laptops)."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), "cadenza-shared")


_WRITTEN: list[tuple[SparkSession, str]] = []


def written(df: DataFrame, label: str) -> DataFrame:
    """Writes a table into the shared folder and reads it back: a cut in the lineage that survives lost executors. It stays
    until ``discard`` is called or the driver's process ends, as any number of plans may still read it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _WRITTEN.append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard() -> None:
    """Deletes all tables that ``written`` has made in this process; plans that read them can't be run any more."""
    while _WRITTEN:
        spark, path = _WRITTEN.pop()
        try:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # noqa: BLE001, S112 - a session that is gone can't delete; the shared folder's owner may
            continue


atexit.register(discard)


def small_side(df: DataFrame, label: str, rows: int = 100_000) -> DataFrame:
    """A join's side that is small as a rule but has no bound: written once, counted, and broadcast up to ``rows`` rows;
    beyond that the planner joins it by shuffling."""
    from pyspark.sql import functions as F

    side = written(df, label)
    return F.broadcast(side) if side.count() <= rows else side


def spread(df: DataFrame) -> DataFrame:
    """For costly work over a table that came in fewer pieces than the cluster has cores (a single small file): in as many
    pieces as cores. Larger tables pass as they are, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
