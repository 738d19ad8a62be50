"""Where intermediate tables go."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see, as ``spark.checkpoint.dir`` names it; a local session may go without one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{spark.conf.get('spark.local.dir', '/tmp').split(',')[0]}/spark-{spark.sparkContext.applicationId}"


def cut(df: DataFrame) -> DataFrame:
    """A frame that later steps read several times: a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, removed when the driver ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{name}-{uuid4().hex}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return f"{path.toString()}/rows"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table of the shared folder: computed once, where a checkpoint computes a map twice."""
    path = fresh_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
