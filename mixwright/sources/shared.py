"""Tables that cut lineage, in the folder that the driver and all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, else the context's checkpoint folder, else the warehouse: shared by definition."""
    given = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if given:
        return given
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    return held.get() if not held.isEmpty() else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate"


def written(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet and read again: a lost executor costs a reread."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def drop(*tables: DataFrame) -> None:
    """Delete what ``written`` has written of ``tables``."""
    for one in tables:
        if path := getattr(one, "written_to", None):
            remove(one.sparkSession, path)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder: readers see the whole of it or nothing."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path(target).getParent())
    if not system.rename(path(source), path(target)):
        raise OSError(f"{source} can't be renamed to {target}")


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
