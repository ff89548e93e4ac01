"""Accounting sales ledger: head office, provinces, year roll-up.

Input is a sales report (text columns of ``schemas.SALES``); output the 26 report columns
plus customer type, net revenue and net quantity. No step sorts or collects: the ledger
stays one scan, one lookup join and one broadcast range join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from branchledger import values as v
from branchledger.functions.parsing import lenient_long, strict_date
from branchledger.functions.rules import Rule, first_match, recode
from branchledger.functions.text import strip_suffixes, title_letters
from branchledger.operators.lookup import drop_codes, lookup_join
from branchledger.operators.periods import Calendar, Closing, assign_period
from branchledger.operators.stack import stack, stack_tagged
from branchledger.operators.steps import passing_step, stepped
from branchledger.session import compiled
from branchledger.sources.schemas import LEDGER_HEADERS

QTY = ["qty_sold", "qty_returned"]
MONEY = ["unit_price", "gross_sales", "discount", "return_value", "vat", "total_payment"]
LEDGER_COLUMNS = list(LEDGER_HEADERS)
#: Hash of a row without its employee code, and the name that the staff list knows.
ROW_HASH, RAW_NAME = "__row_hash", "__raw_name"
#: Parts of a narrow ledger that pass the lookup one after the other.
SLICES = 2
HASHED_COLUMNS = [c for c in LEDGER_COLUMNS if c != "employee_code"]


def dept_by_name(name: Column, default: str = v.OTHER_DEPT) -> Column:
    """Department of a head-office salesperson; exact names first, then patterns."""
    return first_match(name, [*v.DEPT_BY_EXACT_NAME, *v.DEPT_BY_NAME], default)


def customer_type(
    code: Column,
    distributors: Sequence[str],
    rules: Sequence[Rule] = tuple(v.CUSTOMER_TYPES),
    default: str | None = v.OTHER_CUSTOMER,
) -> Column:
    """Distributor list first, then the code patterns; a null code is ``default``."""
    listed = [Rule("isin", list(distributors), v.DISTRIBUTOR)] if distributors else []
    return first_match(code, [*listed, *rules], default)


def with_employee_code(
    sales: DataFrame,
    staff: DataFrame,
    exclude: Sequence[str] = (),
    name: str = "salesperson",
    spread_by: Sequence[str] = ("voucher_no", "product_code"),
) -> DataFrame:
    """Employee code by (``name``, dept). The staff list may repeat a name."""
    return lookup_join(
        sales,
        drop_codes(staff, "employee_code", exclude),
        {name: "employee_name", "dept": "dept"},
        ["employee_code"],
        spread_by=spread_by,
    )


def _typed(sales: DataFrame) -> DataFrame:
    compiled(sales.sparkSession)
    return sales.withColumns(
        {"posting_date": strict_date(F.col("posting_date"))}
        | {c: lenient_long(F.col(c)) for c in QTY}
        | {c: F.col(c).cast("double") for c in MONEY}
    )


def _derived(ledger: DataFrame, distributors: Sequence[str], salesperson: Column) -> DataFrame:
    return ledger.withColumns(
        {
            "customer_type": customer_type(F.col("customer_code"), distributors),
            "net_revenue": F.col("total_payment") - F.col("vat"),
            "net_qty": F.col("qty_sold") - F.col("qty_returned"),
            "salesperson": salesperson,
        }
    )


def _finish(ledger: DataFrame, distributors: Sequence[str], salesperson: Column) -> DataFrame:
    return _derived(ledger, distributors, salesperson).select(*LEDGER_COLUMNS)


def head_office_ledger(
    sales: DataFrame,
    staff: DataFrame,
    calendar: Calendar,
    distributors: Sequence[str] = tuple(v.HEAD_OFFICE_DISTRIBUTORS),
    exclude_codes: Sequence[str] = (),
) -> DataFrame:
    """Department per salesperson; no calendar rule -> month of the posting date.

    The lookup sees the raw name (the staff list carries the same suffixes); names are
    cleaned last.
    """
    lines = _typed(sales).withColumn("dept", dept_by_name(F.col("salesperson")))
    coded = with_employee_code(lines, staff, exclude_codes)
    dated = assign_period(coded, calendar, fallback="month")
    name = recode(strip_suffixes(F.col("salesperson"), v.NAME_SUFFIXES), v.NAME_RECODE)
    return _finish(dated, distributors, name)


def province_ledger(
    sales: DataFrame,
    staff: DataFrame,
    calendar: Calendar,
    distributors: Sequence[str] = tuple(v.PROVINCE_DISTRIBUTORS),
    exclude_codes: Sequence[str] = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Department from the file (column ``dept``); no calendar rule -> null period.

    All offices run as one job: ``calendar`` holds every office. ``columns`` asks for a narrow ledger
    (see ``_narrow_provinces``).
    """
    if columns is not None:
        return _narrow_provinces(sales, staff, calendar, distributors, exclude_codes, columns)
    coded = with_employee_code(_typed(sales), staff, exclude_codes)
    dated = assign_period(coded, calendar, fallback=None)
    return _finish(dated, distributors, title_letters(F.col("salesperson")))


def _narrow_provinces(
    sales: DataFrame,
    staff: DataFrame,
    calendar: Calendar,
    distributors: Sequence[str],
    exclude_codes: Sequence[str],
    columns: Sequence[str],
) -> DataFrame:
    """The province ledger's ``columns``, its employee code and ``ROW_HASH``, from the same steps.

    The lookup comes last: by then a hash stands for the columns not asked for, and a lookup too
    large to be broadcast does not shuffle these. Its rows are read twice, by the sketch and the join,
    so they are written before; they pass in slices, which take a part of the disk each.
    """
    lines = _typed(sales).withColumn(RAW_NAME, F.col("salesperson"))
    dated = assign_period(lines, calendar, fallback=None)
    rows = _derived(dated, distributors, title_letters(F.col("salesperson")))
    asked = [c for c in dict.fromkeys([*columns, "dept"]) if c != "employee_code"]
    narrow = rows.select(*asked, RAW_NAME, F.xxhash64(*HASHED_COLUMNS).alias(ROW_HASH))
    number = F.pmod(F.xxhash64(F.lit("slice"), ROW_HASH), F.lit(SLICES))
    with passing_step(narrow, "ledger-lines") as written:
        slices = [
            stepped(
                with_employee_code(written.filter(number == i), staff, exclude_codes, RAW_NAME, [ROW_HASH])
                .select(*dict.fromkeys([*columns, "employee_code"]), ROW_HASH),
                "ledger-rows",
            )
            for i in range(SLICES)
        ]
    return stack(slices)


def one_office(
    sales: DataFrame, office: str, closings: Sequence[Closing]
) -> tuple[DataFrame, Calendar]:
    """A single province file as ``province_ledger`` input.

    With a constant department the period join scans the office's own few closings.
    """
    return sales.withColumn("dept", F.lit(office)), {office: closings}


def month_ledger(parts: Sequence[DataFrame]) -> DataFrame:
    return stack(parts)


def union_offices(offices: Mapping[str, DataFrame], tag: str = "dept") -> DataFrame:
    return stack_tagged(offices, tag)


def ledger_year(ledger: DataFrame, year: int) -> DataFrame:
    """Rows that close in ``year`` (by accounting period, not by posting date)."""
    return ledger.filter(F.col("closing_year") == year)


def sorted_for_export(ledger: DataFrame) -> DataFrame:
    """Posting-date order, nulls last. The tie-break spreads a hot date over tasks.

    A sort reads its rows twice, first for the bounds of its ranges. ``ledger`` is whole, and then
    written before, or narrow with both of these columns, and then a table already.
    """
    if ROW_HASH not in ledger.columns:
        ledger = stepped(ledger.withColumn(ROW_HASH, F.xxhash64(*HASHED_COLUMNS)), "ledger-rows")
    return ledger.orderBy(F.asc_nulls_last("posting_date"), "voucher_no", ROW_HASH, "employee_code").drop(ROW_HASH)


def net_by_period(ledger: DataFrame, by: Sequence[str] = ("dept", "period")) -> DataFrame:
    """Net revenue, quantity, lines and lines with a known employee."""
    return ledger.groupBy(*by).agg(
        F.sum(F.col("net_revenue").cast("decimal(18,2)")).alias("net_revenue"),
        F.sum("net_qty").alias("net_qty"),
        F.count(F.lit(1)).alias("n_lines"),
        F.count("employee_code").alias("n_coded"),
    )
