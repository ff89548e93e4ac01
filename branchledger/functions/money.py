"""Exact money: marts add decimals, so totals do not depend on summation order."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def cents(column: str | Column) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return c.cast("decimal(18,2)")
