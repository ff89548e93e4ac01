"""The three batch jobs from report folders to tables.

Each job may be rerun: partitions and tables are replaced, never appended to.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from branchledger import values as v
from branchledger.functions.money import cents
from branchledger.operators.checks import control_totals
from branchledger.operators.periods import Calendar
from branchledger.operators.stack import stack
from branchledger.plans import dims, field_sales, inventory, ledger, targets
from branchledger.sinks.files import closing_years, export_files, read_ledger, write_ledger_month
from branchledger.sinks.parts import part_of, upsert_parts
from branchledger.sinks.tables import build_table, stage_table, staged
from branchledger.sources import schemas
from branchledger.sources.naming import report_headers
from branchledger.sources.reports import (
    TEMP_PREFIX, drop_last_columns, missing_offices, present_files, read_labelled, read_offices, read_report, read_sheet,
)
from branchledger.sources.tables import WAREHOUSE_SPECS, StagingSpec, read_spec


def read_staff(spark: SparkSession, folder: str, offices: Mapping[str, str] = v.OFFICE_FILES) -> DataFrame:
    return dims.staff_stack(read_offices(spark, folder, schemas.ACCOUNTING_STAFF, offices))


def month_job(
    spark: SparkSession,
    report_folder: str,
    staff_folder: str,
    ledger_path: str,
    year: int,
    month: int,
    head_file: str,
    head_calendar: Calendar,
    office_files: Mapping[str, str],
    office_calendar: Calendar,
    exclude_codes: Sequence[str] = (),
) -> DataFrame:
    """Build one month of the ledger, refresh the year tables, return the year's totals.

    The month is written once. Rows belong to the year they close in, whatever run brought them: all
    years that the run's rows close in, now or before a rerun, are refreshed from all runs of the
    ledger, not from exports.
    """
    staff = read_staff(spark, staff_folder)
    head = read_offices(spark, report_folder, schemas.SALES, {v.HEAD_OFFICE: head_file})
    branches = read_offices(spark, report_folder, schemas.SALES, office_files)
    lines = ledger.month_ledger(
        [
            ledger.head_office_ledger(head, staff, head_calendar, exclude_codes=exclude_codes),
            ledger.province_ledger(branches, staff, office_calendar, exclude_codes=exclude_codes),
        ]
    )
    before = closing_years(spark, ledger_path, year, month)
    write_ledger_month(lines, ledger_path, year, month)
    for closed in sorted(before | closing_years(spark, ledger_path, year, month) | {year}):
        year_job(spark, ledger_path, closed)
    return control_totals(year_rows(spark, ledger_path, year))


def year_rows(spark: SparkSession, ledger_path: str, year: int) -> DataFrame:
    """Rows of all runs that close in a year; files without any are skipped by their statistics."""
    return ledger.ledger_year(read_ledger(spark, ledger_path), year).select(*ledger.LEDGER_COLUMNS)


def year_job(spark: SparkSession, ledger_path: str, year: int) -> dict[str, object]:
    """Refresh one year's table; its row count and totals come from the write."""
    revenue = {c: F.sum(cents(c)) for c in ("total_payment", "net_revenue")}
    return stage_table(
        year_rows(spark, ledger_path, year), f"sales_ledger{year}", headers=schemas.LEDGER_HEADERS, totals=revenue, keep_empty=True
    )


def missing_reports(spark: SparkSession, folder: str, offices: Mapping[str, str]) -> DataFrame:
    return missing_offices(spark, folder, offices)


VISIT_EXPORTS = {
    "_CHECK_IN_CHECK_OUT": field_sales.visit_flags,
    "_UNIQUE_CUSTOMERS": field_sales.visit_customers,
    "_TIME_CALC": field_sales.visit_time,
}
SUMMARY_EXPORTS = {
    "_AVG_KH_TN": field_sales.visit_averages,
    "_KILOMETERS": field_sales.kilometers,
}
STATUS_EXPORTS = {"pending": "pending", "approved": "accepted", "rejected": "cancelling"}


def field_sales_job(
    spark: SparkSession, raw_folder: str, staff_path: str, export_folder: str, year: int, month: int
) -> list[str]:
    """Field indicators of one month as export folders.

    Each indicator set is computed once into a staging table; the exports are cuts of it.
    """
    rows = field_sales.visit_rows(read_report(spark, f"{raw_folder}/visits", schemas.VISITS))
    visits = staged(rows, "visit_detail")
    summary_report = read_report(spark, f"{raw_folder}/visit_summary", schemas.VISIT_SUMMARY)
    summary = staged(field_sales.visit_summary_rows(summary_report), "visit_summary")

    feeds = read_feeds(spark, raw_folder)
    staff = read_sheet(spark, staff_path, schemas.FIELD_STAFF)
    kpis = build_table(field_sales.visit_kpis(visits), "visit_kpis", "stg")
    frames = {name: cut(kpis) for name, cut in VISIT_EXPORTS.items()}
    frames |= {name: cut(summary) for name, cut in SUMMARY_EXPORTS.items()}
    for kind, feed in (("KH", "customers"), ("TN", "prospects")):
        status = field_sales.account_status(feeds[feed], staff, year, month)
        counts = build_table(status, f"account_status_{feed}", "stg")
        for name, word in STATUS_EXPORTS.items():
            frames[f"__{kind}_{word}"] = field_sales.status_report(counts, name)

    held = {
        name: field_sales.sales_accounts(df, v.SHARED_POOL if name.startswith("shared_") else None)
        for name, df in feeds.items()
    }
    customers = [held["shared_customers"], held["customers"]]
    prospects = [held["shared_prospects"], held["prospects"]]
    frames["__ALL_KH"] = field_sales.portfolio(customers, staff)
    frames["__ALL_KH_TN"] = field_sales.portfolio(prospects + customers, staff)
    return [export_files(df, export_folder, name) for name, df in frames.items()]


def read_feeds(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The four account feeds, each tagged with its label in ``feed``."""
    layouts = {
        "customers": schemas.FIELD_CUSTOMERS,
        "prospects": schemas.FIELD_PROSPECTS,
        "shared_customers": schemas.shared(schemas.FIELD_CUSTOMERS),
        "shared_prospects": schemas.shared(schemas.FIELD_PROSPECTS),
    }
    labelled = read_labelled(
        spark, {v.FEED_LABELS[n]: (f"{folder}/{n}", layout) for n, layout in layouts.items()}, "feed"
    )
    return {name: labelled[v.FEED_LABELS[name]] for name in layouts}


def warehouse_job(
    spark: SparkSession, folder: str, specs: Sequence[StagingSpec] = WAREHOUSE_SPECS
) -> None:
    """Insert-or-update the order and warehouse tables from a drop of exports.

    They are kept by month of their timestamp; a drop rewrites the months that it touches.
    """
    for spec in specs:
        rows = read_spec(spark, folder, spec)
        if not spec.key:
            stage_table(rows, spec.table)
            continue
        order = [] if spec.stamp is None or spec.stamp in spec.key else [spec.stamp]
        part = None if spec.stamp is None else part_of(spec.stamp)
        upsert_parts(spark, spec.table, rows, spec.key, order, part=part, log=spec.log)


def dimension_job(
    spark: SparkSession,
    accounting_folder: str,
    field_folder: str,
    hand_folder: str,
    labels: dims.Platforms = dims.Platforms(),
    offices: Mapping[str, str] = v.OFFICE_FILES,
    target_year: int | None = None,
) -> None:
    """Stage every report and build the dimensions in dependency order.

    Customers read the finished employee dimension. Every step after staging reads tables.
    """

    def offices_of(kind: str, layout: schemas.Layout) -> DataFrame:
        return read_offices(spark, f"{accounting_folder}/{kind}", layout, offices)

    def sheet(folder: str, layout: schemas.Layout) -> DataFrame:
        return read_sheet(spark, folder, layout)

    staff = staged(read_staff(spark, f"{accounting_folder}/employees", offices), "accounting_employees")
    acc_customers = staged(offices_of("customers", schemas.ACCOUNTING_CUSTOMERS), "accounting_customers")
    acc_products = staged(offices_of("products", schemas.ACCOUNTING_PRODUCTS), "accounting_products")
    field_staff = staged(sheet(f"{field_folder}/employees", schemas.FIELD_STAFF), "field_employees")
    field_products = staged(sheet(f"{field_folder}/products", schemas.FIELD_PRODUCTS), "field_products")
    feeds = {
        name: staged(df, f"field_{name}")
        for name, df in read_feeds(spark, f"{field_folder}/customers").items()
    }
    hr = drop_last_columns(sheet(f"{hand_folder}/employees", schemas.HR_STAFF), 2)
    hr = staged(hr, "hr_employees")
    hand_customers = staged(sheet(f"{hand_folder}/customers", schemas.HAND_CUSTOMERS), "hand_customers")
    hand_products = staged(sheet(f"{hand_folder}/products", schemas.HAND_PRODUCTS), "hand_products")

    build_table(dims.product_dim(field_products, acc_products, hand_products, labels), "products", "int")
    clean_hr = build_table(dims.hr_clean(hr), "clean_hr_employees", "stg")
    employees = build_table(
        dims.employee_dim(staff, field_staff, clean_hr, labels), "employees", "int"
    )
    unified = build_table(dims.unified_customers(feeds), "clean_field_customers", "stg")
    build_table(
        dims.customer_dim(unified, hand_customers, acc_customers, employees, labels),
        "customers",
        "int",
    )
    if target_year is not None:
        target_job(spark, f"{hand_folder}/targets", target_year)


def target_job(spark: SparkSession, folder: str, year: int) -> None:
    """Company and team targets of a year in long form.

    Month columns differ per year and per team, so each sheet is read with its own header (one
    small sheet a team; their names come from a listing).
    """
    names = {"Phòng ban": "dept", "Tên nhân viên": "employee_name"}

    def sheets(part: str) -> list[DataFrame]:
        files = sorted(r.office_file for r in present_files(spark, f"{folder}/{part}").collect())
        reader = spark.read.option("header", True)
        return [
            report_headers(reader.option("pathGlobFilter", file).csv(f"{folder}/{part}"), names)
            for file in files if not file.startswith(TEMP_PREFIX)
        ]

    stage_table(targets.company_targets(stack(sheets("company")), year), f"company_targets_{year}")
    stage_table(targets.employee_targets(sheets("teams"), year), f"employee_targets_{year}")


def inventory_job(spark: SparkSession) -> None:
    """Movement detail from the staged warehouse tables and the finished dimensions."""
    stg = {name: spark.table(f"stg.{name}") for name in
           ("stock_history", "orders", "inbound", "outbound", "lading")}
    detail = inventory.inventory_detail(
        stg["stock_history"], stg["orders"], stg["inbound"], stg["outbound"], stg["lading"],
        spark.table("int.products"), spark.table("int.customers"),
    )
    build_table(detail, "inventory_detail", "int")
