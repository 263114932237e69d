"""Tables that cut the lineage of rounds, in the folder that all machines share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session, else the context's; a new one only in local mode, where neither is set."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    existing = spark.sparkContext._jsc.sc().getCheckpointDir()
    if named or existing.isDefined():
        return named or existing.get()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    made = f"file:///tmp/checkpoints/{uuid.uuid4().hex}"
    spark.sparkContext.setCheckpointDir(made)
    return made


class Scratch:
    """Written tables of one computation by name; a new version of a name replaces the one before it."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}
        self.root = f"{shared_folder(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
        self.written = 0

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        """Write and read back; the version before, which df may read, goes when the new one is whole."""
        self.written += 1
        path = f"{self.root}/{name}-{self.written}"
        df.write.option("compression", "zstd").parquet(path)
        self.drop(name)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        path = self.paths.pop(name, None)
        if path is not None:
            location = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            location.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(location, True)
