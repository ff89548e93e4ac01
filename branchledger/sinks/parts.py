"""Tables kept in parts, one folder each, behind a view that names the folders that count.

A writer puts new folders for the parts it touches beside the old ones and then replaces the view:
readers switch in one step, parts that did not change keep their files, a run that dies before the
switch leaves nothing that is read. The view's text is the manifest: its folders, and its version in
a table property. One writer at a time. Folders that no view names any more are left for readers
still at work; they are the caller's to remove.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from branchledger.operators.latest import replace_groups, upsert

PART, NONE = "__part", "none"


def part_of(column: str, fmt: str = "yyyy-MM") -> Column:
    """The month of a date or timestamp as a part's name."""
    return F.date_format(column, fmt)


class PartedTable:
    """``schema.table`` in parts named by ``part``, an expression over its columns; None: a single part."""

    def __init__(self, spark: SparkSession, table: str, schema: str = "stg", part: Column | None = None):
        self.spark, self.name, self.schema = spark, f"`{schema}`.`{table}`", schema
        self.part = F.lit("all") if part is None else F.coalesce(part.cast("string"), F.lit(NONE))
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        self.root = f"{base}/{schema}.parts/{table}"
        self.exists = spark.catalog.tableExists(f"{schema}.{table}")

    def _property(self, row: str) -> str:
        found = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").where(F.col("col_name") == row).first()
        return found.data_type if found else ""

    def is_view(self) -> bool:
        return self.exists and self._property("Type") == "VIEW"

    def folders(self) -> dict[str, str]:
        """Part -> folder, from the view's text; nothing for a table that is not kept in parts."""
        if not self.is_view():
            return {}
        text = self._property("View Text")
        return {m[2]: f"{self.root}/{m[1]}/{PART}={m[2]}" for m in re.finditer(rf"([0-9a-f]{{32}})/{PART}=([^,}}`]+)", text)}

    def read(self, folders: dict[str, str]) -> DataFrame:
        schema = self.spark.table(self.name).schema
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders.values())

    def write(self, df: DataFrame) -> dict[str, str]:
        """Folders of the parts of ``df``, which no reader sees yet."""
        run = f"{self.root}/{uuid.uuid4().hex}"
        df.withColumn(PART, self.part).write.partitionBy(PART).parquet(run)
        schema = StructType([*df.schema.fields, StructField(PART, StringType())])
        names = self.spark.read.schema(schema).parquet(run).select(PART).distinct()
        return {r[0]: f"{run}/{PART}={r[0]}" for r in names.collect()}

    def switch(self, folders: dict[str, str], like: DataFrame) -> None:
        """Let the view show just these parts. ``like`` has the table's columns."""
        parts = {n: f.removeprefix(f"{self.root}/") for n, f in folders.items()}
        # A folder without rows holds the schema, so that a table may lose its last part.
        shape = f"{uuid.uuid4().hex}-schema"
        self.spark.createDataFrame([], like.schema).coalesce(1).write.parquet(f"{self.root}/{shape}")
        version = int((re.search(r"parts_version=(\d+)", self._property("Table Properties")) or [0, 0])[1]) + 1 if self.is_view() else 1
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.schema}`")
        if self.exists and not self.is_view():  # a plain table of an earlier release
            self.spark.sql(f"DROP TABLE {self.name}")
        glob = f"{self.root}/{{{','.join([shape, *parts.values()])}}}"
        columns = ", ".join(f"`{c}`" for c in like.columns)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name} TBLPROPERTIES ('parts_version' = '{version}') AS SELECT {columns} FROM parquet.`{glob}`"
        )
        self.exists = True

    def touched(self, updates: DataFrame, keys: Sequence[str], folders: dict[str, str]) -> set[str]:
        """Parts that hold an update's row or a row of its key."""
        own = {r[0] for r in updates.select(self.part.alias(PART)).distinct().collect()}
        known = self.read(folders).withColumn(PART, self.part).select(*keys, PART)
        other = known.join(updates.select(*keys).distinct(), list(keys), "left_semi").select(PART).distinct()
        return own | {r[0] for r in other.collect()}

    def apply(self, updates: DataFrame, keys: Sequence[str], merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Rewrite the touched parts as ``merge(their rows, updates)``. Updates are evaluated once."""
        staged = f"{self.root}/{uuid.uuid4().hex}-updates"
        updates.write.parquet(staged)
        updates = self.spark.read.schema(updates.schema).parquet(staged)
        if not self.exists:
            merged, folders, gone = merge(updates.limit(0), updates), {}, set()
        elif not self.is_view() or set(self.spark.table(self.name).columns) != set(updates.columns):
            merged, folders, gone = merge(self.spark.table(self.name), updates), {}, set()
        else:
            folders = self.folders()
            gone = self.touched(updates, keys, folders)
            merged = merge(self.read({n: f for n, f in folders.items() if n in gone}), updates)
        fresh = self.write(merged)
        self.switch({n: f for n, f in folders.items() if n not in gone} | fresh, merged)


def upsert_parts(
    spark: SparkSession,
    table: str,
    updates: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    schema: str = "stg",
    part: Column | None = None,
    log: bool = False,
) -> None:
    """Apply updates to a table kept in parts; the first load is one as well.

    With ``log`` the updates replace whole groups of ``keys`` and every line is kept.
    """

    def merge(existing: DataFrame, new: DataFrame) -> DataFrame:
        return replace_groups(existing, new, keys) if log else upsert(existing, new, keys, order)

    PartedTable(spark, table, schema, part).apply(updates, keys, merge)
