"""Control totals and invariants, all as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from branchledger.functions.money import cents


def control_totals(ledger: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Row count, column count, gross and net revenue (exact decimals)."""
    return ledger.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(ledger.columns)).cast("bigint").alias("n_columns"),
        F.coalesce(F.sum(cents("total_payment")), F.lit(0)).alias("gross_revenue"),
        F.coalesce(F.sum(cents("net_revenue")), F.lit(0)).alias("net_revenue"),
    )


def net_mismatches(ledger: DataFrame) -> DataFrame:
    """Rows whose net revenue is not total payment minus VAT."""
    return ledger.filter(
        ~F.col("net_revenue").eqNullSafe(F.col("total_payment") - F.col("vat"))
    )


def unresolved_staff(ledger: DataFrame) -> DataFrame:
    """Salespeople without an employee code, with the number of their lines."""
    return (
        ledger.filter(F.col("employee_code").isNull())
        .groupBy("dept", "salesperson")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
