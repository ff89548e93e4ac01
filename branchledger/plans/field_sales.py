"""Field-sales indicators: visits, accounts opened, portfolio."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from branchledger import values as v
from branchledger.functions.parsing import in_month, lenient_time, minutes_between, strict_stamp
from branchledger.functions.rules import cap, flag, guarded_ratio, not_in_keep_null, recode
from branchledger.functions.text import split_pair
from branchledger.operators.lookup import lookup_join
from branchledger.operators.margins import counts_by_case_with_total, counts_with_total
from branchledger.operators.stack import stack

MAX_VISIT_MINUTES = 60.0
VISIT_KEYS = ["dept", "employee_code", "employee_name"]
STATUSES = {"pending": v.PENDING, "approved": v.APPROVED, "rejected": v.REJECTED}


def merged_dept(c: Column) -> Column:
    return recode(c, v.MERGED_OFFICES)


# --- visits -------------------------------------------------------------------------


def visit_rows(visits: DataFrame) -> DataFrame:
    """Visit detail at row grain: check-in/out, flags, capped minutes, support depts out."""
    check_in, check_out = split_pair(F.col("visit_time"), " - ")
    has_out = F.col("check_out").isNotNull() & (F.col("check_out") != "")
    return (
        visits.withColumns({"check_in": check_in, "check_out": check_out})
        .withColumns(
            {
                "complete": flag(F.col("check_in").isNotNull() & has_out),
                "incomplete": flag(F.col("check_in").isNotNull() & ~has_out),
                "minutes": cap(
                    minutes_between(lenient_time(F.col("check_in")), lenient_time(F.col("check_out"))),
                    MAX_VISIT_MINUTES,
                ),
                "dept": merged_dept(F.col("dept")),
            }
        )
        .filter(not_in_keep_null(F.col("dept"), v.SUPPORT_DEPTS))
    )


def visit_kpis(rows: DataFrame) -> DataFrame:
    """All visit indicators per employee from one grouping of ``visit_rows``.

    The exact distinct count is split by customer before it reaches the employee's group.
    Rows with a null key are left out.
    """
    kpis = (
        rows.dropna(subset=VISIT_KEYS)
        .groupBy(*VISIT_KEYS)
        .agg(
            F.sum("complete").alias("complete"),
            F.sum("incomplete").alias("incomplete"),
            F.countDistinct("customer_code").alias("distinct_customers"),
            F.count("customer_code").alias("visits"),
            F.coalesce(F.sum("minutes"), F.lit(0.0)).alias("minutes"),
        )
    )
    return kpis.withColumn("avg_minutes", F.try_divide(F.col("minutes"), F.col("visits")))


def visit_flags(kpis: DataFrame) -> DataFrame:
    return kpis.select(*VISIT_KEYS, "complete", "incomplete")


def visit_customers(kpis: DataFrame) -> DataFrame:
    return kpis.select(*VISIT_KEYS, "distinct_customers")


def visit_time(kpis: DataFrame) -> DataFrame:
    return kpis.select(*VISIT_KEYS, "visits", "minutes", "avg_minutes")


def visit_summary_rows(summary: DataFrame) -> DataFrame:
    """Visit summary at row grain with guarded averages."""
    return summary.filter(not_in_keep_null(F.col("dept"), v.SUPPORT_DEPTS)).withColumns(
        {
            "avg_customer_visits": guarded_ratio(F.col("customer_visits"), F.col("customers")),
            "avg_prospect_visits": guarded_ratio(F.col("prospect_visits"), F.col("prospects")),
        }
    )


def visit_averages(rows: DataFrame) -> DataFrame:
    return rows.select(
        "employee_name", "employee_code", "dept", "avg_customer_visits", "avg_prospect_visits"
    )


def kilometers(rows: DataFrame) -> DataFrame:
    return rows.select("employee_name", "employee_code", "dept", "kilometers")


# --- accounts -----------------------------------------------------------------------


def sales_accounts(accounts: DataFrame, owner: str | None = None) -> DataFrame:
    """Accounts of sales departments with a parsed opening time.

    ``owner`` sets one owner for every row (the shared pool).
    """
    out = accounts.filter(F.col("dept").isin(*v.SALES_DEPTS)).withColumns(
        {"dept": merged_dept(F.col("dept")), "opened_at": strict_stamp(F.col("opened_at"))}
    )
    return out if owner is None else out.withColumn("owner", F.lit(owner))


def with_owner_code(counts: DataFrame, staff: DataFrame) -> DataFrame:
    """Employee code by (owner, dept); total and pool rows stay without a code."""
    merged = staff.withColumn("dept", merged_dept(F.col("dept")))
    return lookup_join(
        counts, merged, {"owner": "employee_name", "dept": "dept"}, ["employee_code"]
    )


def account_status(
    accounts: DataFrame,
    staff: DataFrame,
    year: int,
    month: int,
    statuses: Mapping[str, str] = STATUSES,
) -> DataFrame:
    """Accounts opened in a month per status, dept and owner, with a total per status.

    All statuses come from one grouping; ``status_report`` cuts one out.
    """
    opened = sales_accounts(accounts).filter(in_month(F.col("opened_at"), year, month))
    counts = counts_by_case_with_total(
        opened,
        ["dept", "owner"],
        "account_code",
        {name: F.col("status") == text for name, text in statuses.items()},
        "status",
        "n_accounts",
    )
    return with_owner_code(counts, staff).select(
        "status", "dept", "employee_code", "owner", "n_accounts"
    )


def status_report(counts: DataFrame, status: str) -> DataFrame:
    return counts.filter(F.col("status") == status).drop("status")


def pool_labels(counts: DataFrame, labels: Mapping[str, str] = v.SHARED_POOL_LABELS) -> DataFrame:
    """Owner of shared-pool rows by department; departments without a label keep the pool."""
    is_pool = F.col("owner") == v.SHARED_POOL
    label = recode(F.col("dept"), labels, default=F.lit(v.SHARED_POOL))
    return counts.withColumn("owner", F.when(is_pool, label).otherwise(F.col("owner")))


def portfolio(accounts: Sequence[DataFrame], staff: DataFrame) -> DataFrame:
    """Accounts held per dept and owner, with a total row.

    ``accounts`` are outputs of ``sales_accounts``: own and shared customers give the
    customer portfolio, adding own and shared prospects gives the full one. Pool owners
    are labelled after counting and before the staff lookup.
    """
    columns = ["account_code", "owner", "dept"]
    counts = counts_with_total(
        stack([a.select(*columns) for a in accounts]), ["dept", "owner"], "account_code", "n_accounts"
    )
    return with_owner_code(pool_labels(counts), staff).select(
        "dept", "employee_code", "owner", "n_accounts"
    )
