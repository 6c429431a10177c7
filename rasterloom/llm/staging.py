"""Intermediate tables in the shared folder that the cluster names in spark.checkpoint.dir.

Staged tables cut lineage: a lost executor costs no more than the stage that reads them.
They are Parquet, so later steps read only the columns that they use.  Frames are lazy, so the tables
live as long as the application; they go when its driver ends, or with `release`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a local folder on local masters and the warehouse elsewhere."""
    conf = spark.sparkContext.getConf()
    folder = conf.get("spark.checkpoint.dir", None)
    if not folder:
        local = conf.get("spark.master", "").split("[")[0] == "local"
        folder = "file:///tmp/checkpoints" if local else spark.conf.get("spark.sql.warehouse.dir")
    return f"{folder.rstrip('/')}/rasterloom/{spark.sparkContext.applicationId}"


def staged(frame: DataFrame, name: str) -> DataFrame:
    """Writes the frame as a Parquet table in the shared folder and returns a frame that reads it."""
    folder = shared_folder(frame.sparkSession)
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    _files(frame.sparkSession, folder, lambda files, own: files.deleteOnExit(own))
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Removes all tables that this application has staged; frames that read them end with it."""
    _files(spark, shared_folder(spark), lambda files, own: files.delete(own, True))


def _files(spark: SparkSession, folder: str, use) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    use(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path)
