"""Catalog writers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, functions as F

from branchledger.sinks.parts import PartedTable
from branchledger.sources.naming import report_headers, stage_columns


def stage_table(
    df: DataFrame,
    table: str,
    schema: str = "stg",
    headers: dict[str, str] | None = None,
    totals: Mapping[str, Column] | None = None,
    keep_empty: bool = False,
) -> dict[str, object]:
    """Write a staging table with normalised names; an empty frame writes nothing.

    ``headers`` turns the jobs' English names back into report headers first, so the
    staged names are the de-accented report headers. Returns what was observed while writing:
    ``n_rows`` and the aggregates of ``totals``, over the frame's own columns; nothing if the frame
    was empty and left the table as it was (``keep_empty``: replaces it even then).

    The frame runs once. Its rows are written beside the old ones and switched in afterwards.
    """
    seen = Observation()
    watched = df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *[c.alias(n) for n, c in (totals or {}).items()])
    named = stage_columns(report_headers(watched, headers) if headers else watched)
    target = PartedTable(df.sparkSession, table, schema)
    folders = target.write(named)
    found = seen.get
    if not found["n_rows"] and not keep_empty:
        return {}
    target.switch(folders, named)
    return found


def staged(df: DataFrame, table: str, schema: str = "stg") -> DataFrame:
    """Stage a frame and continue from the table, so that reports are parsed once."""
    return df.sparkSession.table(f"{schema}.{table}") if stage_table(df, table, schema) else df


def build_table(df: DataFrame, table: str, schema: str, mode: str = "overwrite") -> DataFrame:
    """Create or replace a catalog table; returns it as a DataFrame."""
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`")
    df.write.mode(mode).format("parquet").saveAsTable(f"`{schema}`.`{table}`")
    return df.sparkSession.table(f"{schema}.{table}")
