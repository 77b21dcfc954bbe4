"""Intermediate tables in the folder that the whole cluster shares."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir.

    Where that is unset, a session in local mode (as in tests) gets a temporary folder of its own; on a
    cluster, whose executors don't share such a folder, this is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="strandline-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/strandline/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write df as Parquet to shared storage and read it again: this cuts the lineage and survives lost executors."""
    path = path or scratch(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a stored table that nothing will read again."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class Workspace:
    """Stored tables of one operator, deleted one by one with `drop` or all at the end of a with block.

    What outlives the block has to be stored outside of it first.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch(self.spark, name)
        out = stored(df, name, path)
        self.paths[id(out)] = (path, out)  # holds the frame, so that its id stays its own
        return out

    def drop(self, *frames: DataFrame) -> None:
        for frame in frames:
            remove(self.spark, self.paths.pop(id(frame))[0])

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *error) -> None:
        for path, _ in self.paths.values():
            remove(self.spark, path)
        self.paths = {}
