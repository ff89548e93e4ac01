"""Marts over the ledger and the dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from branchledger.functions.money import cents
from branchledger.operators.scoring import quintile_scores
from branchledger.operators.stack import aligned_sums, growth


def rfm(ledger: DataFrame, as_of: date) -> DataFrame:
    """Recency (days), frequency (vouchers) and monetary (net revenue) per customer."""
    return (
        ledger.filter(F.col("customer_code").isNotNull())
        .groupBy("customer_code")
        .agg(
            F.date_diff(F.lit(as_of), F.max("posting_date")).cast("bigint").alias("recency"),
            F.countDistinct("voucher_no").alias("frequency"),
            F.sum(cents("net_revenue")).alias("monetary"),
        )
    )


def rfm_segments(ledger: DataFrame, as_of: date) -> DataFrame:
    """RFM with scores 1..5 per measure (see ``quintile_scores``) and their total."""
    base = rfm(ledger, as_of).withColumn(
        "monetary_cents", (F.col("monetary") * 100).cast("bigint")
    )
    scored = quintile_scores(
        base, {"recency": "desc", "frequency": "asc", "monetary_cents": "asc"}, "customer_code"
    )
    total = F.col("recency_score") + F.col("frequency_score") + F.col("monetary_cents_score")
    return scored.select(
        "customer_code",
        "recency",
        "frequency",
        "monetary",
        "recency_score",
        "frequency_score",
        F.col("monetary_cents_score").alias("monetary_score"),
        total.alias("rfm_total"),
    )


def product_yoy(ledger: DataFrame) -> DataFrame:
    """Net revenue per product and closing year beside the year before."""
    yearly = (
        ledger.filter(F.col("closing_year").isNotNull())
        .groupBy("product_code", "closing_year")
        .agg(F.sum(cents("net_revenue")).alias("revenue"))
    )
    before = yearly.withColumn("closing_year", F.col("closing_year") + 1)
    both = aligned_sums(
        {"revenue": yearly, "last_year": before}, ["product_code", "closing_year"], "revenue"
    )
    return both.filter(F.col("revenue").isNotNull()).withColumn(
        "growth", growth(F.col("revenue"), F.col("last_year"))
    )


def dept_attainment(ledger: DataFrame, targets: DataFrame) -> DataFrame:
    """Per department and period: actual, same period last year, target, attainment.

    ``targets`` is long form with ``yyyy-MM`` periods; the total row takes no part.
    """
    keys = ["dept", "period"]
    actual = (
        ledger.filter(F.col("period").isNotNull())
        .groupBy(*keys)
        .agg(F.sum(cents("net_revenue")).alias("amount"))
    )
    next_year = F.concat((F.substring("period", 1, 4).cast("int") + 1), F.substring("period", 5, 3))
    monthly = targets.filter(F.col("period").rlike(r"^\d{4}-\d{2}$")).select(
        *keys, cents("target").alias("amount")
    )
    wide = aligned_sums(
        {
            "actual": actual,
            "last_year": actual.withColumn("period", next_year),
            "target": monthly,
        },
        keys,
        "amount",
    )
    kept = wide.filter(F.col("actual").isNotNull() | F.col("target").isNotNull())
    return kept.withColumn(
        "attainment",
        F.try_divide("actual", F.nullif(F.col("target"), F.lit(0).cast("decimal(18,2)"))),
    )


def overview(ledger: DataFrame, by: Sequence[str] = ("dept",)) -> DataFrame:
    """Net revenue, quantity, lines and active customers per branch or region."""
    return ledger.groupBy(*by).agg(
        F.sum(cents("net_revenue")).alias("net_revenue"),
        F.sum("net_qty").alias("net_qty"),
        F.count(F.lit(1)).alias("n_lines"),
        F.countDistinct("customer_code").alias("n_customers"),
    )


def headcount(employees: DataFrame, left_status: Sequence[str] = ("Đã Nghỉ",)) -> DataFrame:
    """Employees per department: all, active, left."""
    gone = F.coalesce(F.col("work_status").isin(*left_status), F.lit(False)) | F.col(
        "left_on"
    ).isNotNull()
    return employees.groupBy("dept").agg(
        F.count(F.lit(1)).alias("employees"),
        F.count(F.when(~gone, F.lit(1))).alias("active"),
        F.count(F.when(gone, F.lit(1))).alias("left_company"),
    )


def masked(df: DataFrame, columns: Sequence[str], salt: str | None = None) -> DataFrame:
    """Identifiers as MD5, or salted SHA-256; null stays null."""

    def digest(c: str) -> Column:
        text = F.col(c).cast("string")
        return F.md5(text) if salt is None else F.sha2(F.concat(F.lit(salt), text), 256)

    return df.withColumns({c: digest(c) for c in columns})


def noise_factor(key: Column, spread: float, salt: str = "") -> Column:
    """Factor in ``[1 - spread, 1 + spread)`` fixed per key, from the MD5 of the key."""
    head = F.conv(F.substring(F.md5(F.concat(F.lit(salt), key.cast("string"))), 1, 8), 16, 10)
    unit = head.cast("bigint") / F.lit(2.0**32)
    return F.lit(1.0 - spread) + F.lit(2 * spread) * unit


def noised(
    df: DataFrame, money: Mapping[str, str] | Sequence[str], key: str, spread: float = 0.1, salt: str = ""
) -> DataFrame:
    """Scale money columns by one factor per key: growth rates within a key are unchanged."""
    factor = F.coalesce(noise_factor(F.col(key), spread, salt), F.lit(1.0))
    return df.withColumns({c: F.col(c) * factor for c in money})
