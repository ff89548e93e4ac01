"""Steps of a job as tables in the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

from branchledger.session import shared_folder

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _write(df: DataFrame, name: str) -> str:
    spark = df.sparkSession
    path, own = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}", spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if own is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, own)
    return path


def stepped(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read back; the shuffle files that it took go at once.

    Spark keeps shuffle files until the driver happens to collect its garbage; the next step would
    add its own to them.
    """
    return df.sparkSession.read.schema(df.schema).parquet(_write(df, name))


@contextmanager
def passing_step(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``stepped`` for the steps inside the block; the folder, which nothing else knows, goes with it."""
    spark, path = df.sparkSession, _write(df, name)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
