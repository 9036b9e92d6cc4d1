"""Session defaults and the shared folder for materialised tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a cluster run should have; none of them changes a result.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
}


def local_session(cpus: str = "*", shuffle_partitions: int = 8, **extra) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("lociweave")
    settings = {
        **RECOMMENDED,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees, as the session names it.

    Only a local session without one, as in tests, gets a folder of its own, which goes when the
    process ends. On a cluster a missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    jsc = spark.sparkContext._jsc.sc()
    current = jsc.getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    own = tempfile.TemporaryDirectory(prefix="lociweave-", ignore_cleanup_errors=True)
    atexit.register(own.cleanup)
    folder = own.name
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/lociweave/{uuid.uuid4().hex}/{name}"


def materialise(df: DataFrame, name: str, partitions: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, cutting its lineage.

    The written files outlive any executor, so a lost one costs a re-read and not
    a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.coalesce(partitions) if partitions else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared file system, whichever that is."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


class Scratch:
    """Intermediate tables of one run below one folder of the shared file system.

    ``keep`` writes a table there and reads it back; ``clear`` deletes the folder. Frames read from
    it must not be used after that.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.path = spark, scratch_path(spark, "run")

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        remove_folder(self.spark, self.path)
