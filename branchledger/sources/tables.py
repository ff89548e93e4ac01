"""Catalog tables and the spec-driven staging of order and warehouse exports."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from branchledger.functions.parsing import SHORT_STAMP_FMT, STAMP_FMT
from branchledger.sources import schemas
from branchledger.sources.reports import read_sheet
from branchledger.sources.schemas import Layout


class StagingSpec(NamedTuple):
    """An export, the table it feeds and its timestamp column with format."""

    path: str
    table: str
    layout: Layout
    stamp: str | None = None
    stamp_fmt: str | None = None
    key: tuple[str, ...] = ()
    # An event log: a drop replaces all lines of the documents it holds, and keeps every line.
    log: bool = False


WAREHOUSE_SPECS = [
    StagingSpec("orders", "orders", schemas.ORDERS, "created_at", SHORT_STAMP_FMT,
                ("order_code",)),
    StagingSpec("inbound", "inbound", schemas.INBOUND, "created_at", STAMP_FMT,
                ("slip_code",)),
    StagingSpec("outbound", "outbound", schemas.OUTBOUND, "created_at", STAMP_FMT,
                ("slip_code",)),
    StagingSpec("lading", "lading", schemas.LADING, "created_at", SHORT_STAMP_FMT,
                ("waybill",)),
    StagingSpec("stock_history", "stock_history", schemas.STOCK_HISTORY, "occurred_at",
                SHORT_STAMP_FMT, ("ref_code",), True),
]


def read_spec(spark: SparkSession, base: str, spec: StagingSpec) -> DataFrame:
    df = read_sheet(spark, f"{base}/{spec.path}", spec.layout)
    if spec.stamp is None:
        return df
    return df.withColumn(spec.stamp, F.to_timestamp_ntz(F.col(spec.stamp), F.lit(spec.stamp_fmt)))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
