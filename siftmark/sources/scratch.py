"""The folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared checkpoint folder; a temporary one only in local mode."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="siftmark-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name inside the checkpoint folder, which all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/siftmark-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read back.

    For a frame that several later passes read: it is computed once, later passes read
    only their columns, and a lost executor costs no more than re-reading a file.
    """
    folder = scratch_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def _file_system(spark: SparkSession, path: str) -> tuple[object, object]:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def folder_exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of tables, in whatever store it is."""
    files, place = _file_system(spark, path)
    files.delete(place, True)
