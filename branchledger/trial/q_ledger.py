"""Ledger queries over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from branchledger import values as v
from branchledger.functions.parsing import strict_date
from branchledger.functions.rules import first_match
from branchledger.functions.text import norm_code
from branchledger.operators.checks import control_totals
from branchledger.operators.lookup import duplicate_keys
from branchledger.operators.periods import assign_period
from branchledger.operators.stack import stack
from branchledger.plans import ledger as L
from branchledger.plans.dims import staff_stack
from branchledger.trial import sql as S
from branchledger.trial.inputs import DISTRIBUTORS
from branchledger.trial.registry import query


def head(sales: DataFrame, staff: DataFrame) -> DataFrame:
    return L.head_office_ledger(sales, staff_stack(staff), S.HEAD_CALENDAR, DISTRIBUTORS)


def provinces(sales: DataFrame, staff: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return L.province_ledger(sales, staff_stack(staff), S.OFFICE_CALENDAR, DISTRIBUTORS, columns=columns)


def month(sales: DataFrame, staff: DataFrame) -> DataFrame:
    return L.month_ledger([head(sales, staff), provinces(sales, staff)])


NET = """SELECT dept, period, CAST(sum(CAST(net_revenue AS DECIMAL(18,2))) AS DOUBLE) AS net_revenue,
 CAST(sum(net_qty) AS BIGINT) AS net_qty, count(*) AS n_lines,
 count(employee_code) AS n_coded FROM {0} GROUP BY dept, period"""

query("ledger_net_by_period", f"{S.head_ledger('sales_lines')} {NET.format('head')}",
      ("sales_lines", "staff"))(lambda s, st: L.net_by_period(head(s, st)))

query("head_office_ledger", f"{S.head_ledger()} SELECT * FROM head", ("sales", "staff"))(head)

query("province_ledger", f"{S.province_ledger()} SELECT * FROM prov", ("sales", "staff"))(provinces)

query("ledger_year", f"{S.both_ledgers()} SELECT * FROM ledger WHERE closing_year = 1998",
      ("sales", "staff"))(lambda s, st: L.ledger_year(month(s, st), 1998))

query("year_rollup", f"""{S.both_ledgers()}
SELECT closing_year, closing_month, count(*) AS n_rows,
 CAST(sum(CAST(net_revenue AS DECIMAL(18,2))) AS DOUBLE) AS net_revenue
FROM ledger WHERE closing_year = 1997 GROUP BY ALL""", ("sales", "staff"))(
    lambda s, st: L.ledger_year(month(s, st), 1997)
    .groupBy("closing_year", "closing_month")
    .agg(F.count(F.lit(1)).alias("n_rows"),
         F.sum(F.col("net_revenue").cast("decimal(18,2)")).alias("net_revenue"))
)

query("control_totals", f"""{S.both_ledgers()}
SELECT count(*) AS n_rows, CAST(29 AS BIGINT) AS n_columns,
 CAST(sum(CAST(total_payment AS DECIMAL(18,2))) AS DOUBLE) AS gross_revenue,
 CAST(sum(CAST(net_revenue AS DECIMAL(18,2))) AS DOUBLE) AS net_revenue
FROM ledger WHERE closing_year = 1998""", ("sales", "staff"))(
    lambda s, st: control_totals(L.ledger_year(month(s, st), 1998))
)


# --- accounting periods ---------------------------------------------------------------

_PERIOD_COLUMNS = ["voucher_no", "product_code", "dept", "posting_date", "period",
                   "closing_month", "closing_year"]


def _dated(lines: DataFrame, calendar, fallback) -> DataFrame:
    parsed = lines.withColumn("posting_date", strict_date(F.col("posting_date")))
    return assign_period(parsed, calendar, fallback=fallback).select(*_PERIOD_COLUMNS)


def _period_sql(calendar, dept: str, fallback: str) -> str:
    return f""", t AS (SELECT voucher_no, product_code, {dept} AS dept,
 CAST(strptime(posting_date, '%d/%m/%Y') AS DATE) AS posted FROM sales_lines),
p AS (SELECT t.*, {S.period_case(calendar, 't.dept', 't.posted', fallback)} AS cm FROM t)
SELECT voucher_no, product_code, dept, CAST(posted AS VARCHAR) AS posting_date,
 strftime(cm, '%Y-%m') AS period, CAST(month(cm) AS INTEGER) AS closing_month, CAST(year(cm) AS INTEGER) AS closing_year FROM p"""


query("period_intervals_head_office",
      _period_sql(S.HEAD_CALENDAR, S.dept_case("salesperson", "Khác"), S.MONTH_OF_DATE),
      ("sales_lines",))(
    lambda s: _dated(s.withColumn("dept", L.dept_by_name(F.col("salesperson"))), S.HEAD_CALENDAR, "month")
)
query("period_intervals_province", _period_sql(S.OFFICE_CALENDAR, "dept", "NULL"), ("sales_lines",))(
    lambda s: _dated(s, S.OFFICE_CALENDAR, None)
)


@query("period_loop_equivalence", f""", t AS (SELECT d AS office, cast(o_orderdate AS DATE) AS posted
 FROM orders, (VALUES {', '.join(f"('{d}')" for d in S.OFFICE_CALENDAR)}) AS x(d)),
p AS (SELECT t.*, {S.period_case(S.OFFICE_CALENDAR, 't.office', 't.posted', 'NULL')} AS cm FROM t)
SELECT office AS dept, CAST(posted AS VARCHAR) AS posting_date, strftime(cm, '%Y-%m') AS period,
 count(*) AS n FROM p GROUP BY ALL""", ("orders",))
def period_loop_equivalence(orders: DataFrame) -> DataFrame:
    """Every order date against every office calendar."""
    offices = F.explode(F.array(*[F.lit(d) for d in S.OFFICE_CALENDAR]))
    dates = (
        orders.groupBy(F.col("o_orderdate").cast("date").alias("posting_date"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("dept", offices)
    )
    return assign_period(dates, S.OFFICE_CALENDAR, fallback=None).select(
        "dept", "posting_date", "period", "n"
    )


# --- classification and lookup --------------------------------------------------------

query("dept_classifier", f"""SELECT salesperson, {S.dept_case('salesperson', 'Khác')} AS ledger_dept,
 {S.dept_case('salesperson', 'Hà Nội', exact=False)} AS staff_dept, count(*) AS n_lines
FROM sales_lines GROUP BY ALL""", ("sales_lines",))(
    lambda s: s.groupBy("salesperson").agg(F.count(F.lit(1)).alias("n_lines")).select(
        "salesperson",
        L.dept_by_name(F.col("salesperson")).alias("ledger_dept"),
        first_match(F.col("salesperson"), v.DEPT_BY_NAME, v.HEAD_OFFICE).alias("staff_dept"),
        "n_lines",
    )
)

query("customer_type_contains", f"""SELECT order_code, account_code AS customer_code,
 {S.customer_type_case('account_code')} AS customer_type FROM order_headers""", ("order_headers",))(
    lambda o: o.select("order_code", F.col("account_code").alias("customer_code"),
                       L.customer_type(F.col("account_code"), DISTRIBUTORS).alias("customer_type"))
)

query("customer_type_like", """SELECT order_code, account_code AS customer_code,
 CASE WHEN account_code LIKE '%_DL_%' THEN 'Đại lý' WHEN account_code LIKE '%_BS_%' THEN 'Beauty Salon' END
 AS customer_type FROM order_headers""", ("order_headers",))(
    lambda o: o.select("order_code", F.col("account_code").alias("customer_code"),
                       first_match(F.col("account_code"), v.CUSTOMER_TYPES_LIKE, None).alias("customer_type"))
)

query("uid_lookup", f""", {S.STACKED}, {S.LOOKUP}, typed AS (
 SELECT voucher_no, product_code, salesperson, dept FROM sales_lines)
SELECT t.*, s.employee_code FROM typed t
LEFT JOIN staff_lookup s ON t.salesperson = s.employee_name AND t.dept = s.staff_dept""",
      ("sales_lines", "staff"))(
    lambda s, st: L.with_employee_code(
        s.select("voucher_no", "product_code", "salesperson", "dept"), staff_stack(st)
    ).select("voucher_no", "product_code", "salesperson", "dept", "employee_code")
)

query("staff_stack", f""", {S.STACKED} SELECT * FROM stacked""", ("staff",))(
    lambda st: staff_stack(st).select("employee_code", "employee_name", "dept")
)

query("office_stacks", """SELECT r_name AS office, 'customer' AS kind, count(*) AS n_rows, CAST(sum(c_custkey) AS BIGINT) AS keys
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL
UNION ALL SELECT r_name, 'supplier', count(*), CAST(sum(s_suppkey) AS BIGINT)
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""",
      ("customer", "supplier", "nation", "region"))(
    lambda c, s, n, r: stack([
        c.select(F.lit("customer").alias("kind"), F.col("c_nationkey").alias("n_nationkey"), F.col("c_custkey").alias("key")),
        s.select(F.lit("supplier").alias("kind"), F.col("s_nationkey").alias("n_nationkey"), F.col("s_suppkey").alias("key")),
    ]).join(n, "n_nationkey").join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    .groupBy(F.col("r_name").alias("office"), "kind")
    .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("key").alias("keys"))
)

query("office_union_tagged", """SELECT account_code, account_name, dept, 'Khách hàng' AS feed FROM customers
UNION ALL SELECT account_code, account_name, dept, 'Tiềm năng' FROM prospects
UNION ALL SELECT account_code, account_name, dept, 'Khách hàng chung' FROM shared_customers
UNION ALL SELECT account_code, account_name, dept, 'Tiềm năng chung' FROM shared_prospects""",
      ("customers", "prospects", "shared_customers", "shared_prospects"))(
    lambda c, p, sc, sp: L.union_offices(
        {label: df.select("account_code", "account_name", "dept")
         for label, df in zip(v.FEED_LABELS.values(), (c, p, sc, sp), strict=True)}, "feed")
)

query("distinct_codes", f"""SELECT DISTINCT {S.normed('product_code')} AS product_code, 'ACCOUNTING' AS platform FROM accounting_products
UNION SELECT DISTINCT {S.normed('product_code')}, 'FIELD' FROM field_products""",
      ("accounting_products", "field_products"))(
    lambda a, f: _codes(a, "ACCOUNTING").unionByName(_codes(f, "FIELD")).distinct()
)


def _codes(df: DataFrame, label: str) -> DataFrame:
    return df.select(norm_code(F.col("product_code")).alias("product_code"), F.lit(label).alias("platform"))


EXPORTED = ["posting_date", "voucher_no", "product_code", "dept"]

query("sorted_nulls_last", f"""{S.province_ledger()} SELECT posting_date, voucher_no, product_code, dept FROM prov""",
      ("sales", "staff"))(
    lambda s, st: L.sorted_for_export(provinces(s, st, EXPORTED)).select(EXPORTED)
)

query("lookup_duplicates", f""", {S.STACKED}
SELECT employee_name, dept, count(*) AS n_rows FROM stacked GROUP BY ALL HAVING count(*) > 1""", ("staff",))(
    lambda st: duplicate_keys(staff_stack(st), ["employee_name", "dept"])
)
