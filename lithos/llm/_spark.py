"""Session helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Since Spark 4.1: an execution's shuffle files go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir`` or the context's checkpoint folder.

    A folder of our own only where both are unset and driver and executors are one process (``local[...]``, as in
    tests); on a cluster that is an error, as each machine would write to its own disk.
    """
    context = spark.sparkContext._jsc.sc()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        held = context.getCheckpointDir()
        if not held.isDefined() and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = held.get() if held.isDefined() else tempfile.mkdtemp(prefix="lithos-")
    if not context.getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def _no_shuffle_files_left(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def written(df: DataFrame, name: str, compression: str = "lz4") -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with _no_shuffle_files_left(spark):
        df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables that one operator writes to the shared folder and removes once nothing reads them any more."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.held: list[tuple[DataFrame, str]] = []

    def write(self, df: DataFrame, name: str, compression: str = "lz4") -> DataFrame:
        path = new_path(self.spark, name)
        with _no_shuffle_files_left(self.spark):
            df.write.option("compression", compression).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.held.append((out, path))
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete the files of these tables."""
        for table, path in [h for h in self.held if any(h[0] is t for t in tables)]:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
            self.held = [h for h in self.held if h[0] is not table]

    def last(self, df: DataFrame, name: str, compression: str = "lz4") -> DataFrame:
        """``df`` written as the operator's result; all tables written before it are deleted."""
        out = written(df, name, compression)
        self.drop(*[t for t, _ in self.held])
        return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
