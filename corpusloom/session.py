"""Session helpers: table access and lineage cuts that survive the loss of an executor."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of a data directory (a file or a folder of files)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A small table in few files over all cores, for work that is bound by the processor; large ones stay as they lie."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    Where none is set, a local session (tests) gets a folder of its own that goes when the process ends; a cluster is
    refused, as a folder of one machine would be lost with it. Set spark.cleaner.referenceTracking.cleanCheckpoints to
    have Spark delete checkpoints that nothing refers to any more.
    """
    sc = spark.sparkContext
    known = sc._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="corpusloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut lineage with a reliable checkpoint, never a local one."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager)
