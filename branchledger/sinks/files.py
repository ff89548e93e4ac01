"""File writers: exports for people, and the ledger partitioned by run period."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def export_files(df: DataFrame, folder: str, name: str, fmt: str = "csv") -> str:
    """Write ``<folder>/Data<name>`` as a directory of part files with a header."""
    path = f"{folder}/Data{name}"
    writer = df.write.mode("overwrite")
    (writer.option("header", True).csv if fmt == "csv" else writer.parquet)(path)
    return path


def run_folder(path: str, run_year: int, run_month: int) -> str:
    return f"{path}/run_year={run_year}/run_month={run_month}"


def write_ledger_month(ledger: DataFrame, path: str, run_year: int, run_month: int) -> None:
    """Replace one run's partition of the ledger, also by no rows; other runs are untouched.

    Rows are sorted by posting date inside each file, so date filters skip row groups.
    """
    rows = ledger.sortWithinPartitions(F.asc_nulls_last("posting_date"))
    rows.write.mode("overwrite").parquet(run_folder(path, run_year, run_month))


def read_ledger(spark: SparkSession, path: str, run_year: int | None = None) -> DataFrame:
    """All runs, or those of a year; the year is a partition filter."""
    ledger = spark.read.parquet(path)
    return ledger if run_year is None else ledger.filter(F.col("run_year") == run_year)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def closing_years(spark: SparkSession, path: str, run_year: int, run_month: int) -> set[int]:
    """The years that the rows of one run close in; none for a run that was never written."""
    folder = run_folder(path, run_year, run_month)
    if not exists(spark, folder):
        return set()
    years = spark.read.parquet(folder).select("closing_year").dropna().distinct()
    return {r[0] for r in years.collect()}
