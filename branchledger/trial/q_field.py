"""Field-sales queries: visits, accounts, portfolio."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from branchledger import values as v
from branchledger.functions.parsing import in_month
from branchledger.operators.margins import counts_with_total
from branchledger.plans import field_sales as K
from branchledger.trial.q_columns import SALES, SUPPORT
from branchledger.trial.registry import query

MERGED = "CASE dept WHEN 'VP Hưng Yên' THEN 'VP Hải Dương' ELSE dept END"
CLOCK = "try_strptime({0}, '%H:%M:%S')"
ROWS = f""", parts AS (
 SELECT {MERGED} AS dept, employee_code, employee_name, customer_code, visit_time,
  string_split(visit_time, ' - ') AS p FROM visits),
cut AS (SELECT *, p[1] AS check_in, p[2] AS check_out FROM parts WHERE dept IS NULL OR dept NOT IN ({SUPPORT})),
timed AS (SELECT *, (epoch({CLOCK.format('check_out')}) - epoch({CLOCK.format('check_in')})) / 60.0 AS raw_minutes FROM cut),
visit_rows AS (SELECT dept, employee_code, employee_name, customer_code, visit_time, check_in, check_out,
  CASE WHEN check_in IS NOT NULL AND check_out IS NOT NULL AND check_out <> '' THEN 1 ELSE 0 END AS complete,
  CASE WHEN check_in IS NOT NULL AND (check_out IS NULL OR check_out = '') THEN 1 ELSE 0 END AS incomplete,
  CAST(CASE WHEN raw_minutes > 60 THEN 60 ELSE raw_minutes END AS DOUBLE) AS minutes FROM timed),
keyed AS (SELECT * FROM visit_rows WHERE dept IS NOT NULL AND employee_code IS NOT NULL AND employee_name IS NOT NULL)"""
KEYS = "dept, employee_code, employee_name"


def kpis(visits: DataFrame) -> DataFrame:
    return K.visit_kpis(K.visit_rows(visits))


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Minute totals are sums of doubles; six decimals are independent of the order."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


query("visit_detail_rows", f"{ROWS} SELECT * FROM visit_rows", ("visits",))(K.visit_rows)

query("visit_flags", f"""{ROWS} SELECT {KEYS}, CAST(sum(complete) AS BIGINT) AS complete, CAST(sum(incomplete) AS BIGINT) AS incomplete
FROM keyed GROUP BY {KEYS}""", ("visits",))(lambda x: K.visit_flags(kpis(x)))

query("visit_distinct_customers", f"""{ROWS} SELECT {KEYS}, count(DISTINCT customer_code) AS distinct_customers
FROM keyed GROUP BY {KEYS}""", ("visits",))(lambda x: K.visit_customers(kpis(x)))

TIME = """count(customer_code) AS visits, round(coalesce(sum(minutes), 0), 6) AS minutes,
 round(coalesce(sum(minutes), 0) / nullif(count(customer_code), 0), 6) AS avg_minutes"""

query("visit_minutes", f"{ROWS} SELECT {KEYS}, {TIME} FROM keyed GROUP BY {KEYS}", ("visits",))(
    lambda x: rounded(K.visit_time(kpis(x)), "minutes", "avg_minutes")
)

query("visit_kpis", f"""{ROWS} SELECT {KEYS}, CAST(sum(complete) AS BIGINT) AS complete, CAST(sum(incomplete) AS BIGINT) AS incomplete,
 count(DISTINCT customer_code) AS distinct_customers, {TIME} FROM keyed GROUP BY {KEYS}""", ("visits",))(
    lambda x: rounded(kpis(x), "minutes", "avg_minutes")
)

SUMMARY = f""", s AS (SELECT *,
 CASE WHEN customers = 0 THEN 0 ELSE customer_visits / customers END AS avg_customer_visits,
 CASE WHEN prospects = 0 THEN 0 ELSE prospect_visits / prospects END AS avg_prospect_visits
 FROM visit_summary WHERE dept IS NULL OR dept NOT IN ({SUPPORT}))"""

query("visit_averages", f"""{SUMMARY} SELECT employee_name, employee_code, dept, avg_customer_visits,
 avg_prospect_visits FROM s""", ("visit_summary",))(lambda x: K.visit_averages(K.visit_summary_rows(x)))

query("visit_kilometers", f"{SUMMARY} SELECT employee_name, employee_code, dept, kilometers FROM s",
      ("visit_summary",))(lambda x: K.kilometers(K.visit_summary_rows(x)))

query("visit_summary_kpis", f"{SUMMARY} SELECT * FROM s", ("visit_summary",))(K.visit_summary_rows)

STAFF = f""", owners AS (SELECT employee_name, {MERGED} AS staff_dept, min(employee_code) AS employee_code
 FROM field_staff GROUP BY ALL)"""
CODED = """SELECT {0} c.dept, o.employee_code, c.owner, c.n_accounts FROM {1} c
LEFT JOIN owners o ON c.owner = o.employee_name AND c.dept = o.staff_dept"""


def opened(source: str, name: str, month: str) -> str:
    return f"""{name} AS (SELECT {MERGED} AS dept, owner, status, account_code FROM {source}
 WHERE dept IN ({SALES}) AND date_trunc('month', strptime(opened_at, '%H:%M:%S %d/%m/%Y')) = DATE '{month}-01'
 AND dept IS NOT NULL AND owner IS NOT NULL)"""


def margin(source: str, status: str, text: str, kind: str) -> str:
    where = f"FROM {source} WHERE status = '{text}'"
    return f"""SELECT '{kind}' AS kind, '{status}' AS status, dept, owner, count(account_code) AS n_accounts {where} GROUP BY dept, owner
UNION ALL SELECT '{kind}', '{status}', 'TOTAL', '', count(account_code) {where}"""


ALL_MARGINS = " UNION ALL ".join(
    margin(src, name, text, kind)
    for src, kind in (("kh", "customer"), ("tn", "prospect"))
    for name, text in K.STATUSES.items()
)
STATUS_SQL = f""", {opened('customers', 'kh', '1998-03')}, {opened('prospects', 'tn', '2024-01')}{STAFF},
counted AS ({ALL_MARGINS}) {CODED.format('c.kind, c.status,', 'counted')}"""


def account_status(customers: DataFrame, prospects: DataFrame, staff: DataFrame) -> DataFrame:
    return (
        K.account_status(customers, staff, 1998, 3)
        .withColumn("kind", F.lit("customer"))
        .unionByName(K.account_status(prospects, staff, 2024, 1).withColumn("kind", F.lit("prospect")))
    )


query("account_status", STATUS_SQL, ("customers", "prospects", "field_staff"))(account_status)

query("account_status_margin", f""", {opened('customers', 'kh', '1998-03')}, {opened('prospects', 'tn', '2024-01')},
counted AS ({ALL_MARGINS}) SELECT * FROM counted""", ("customers", "prospects", "field_staff"))(
    lambda c, p, st: account_status(c, p, st).drop("employee_code")
)

query("account_status_margin_empty", """SELECT 'TOTAL' AS dept, '' AS owner, count(*) AS n_accounts
FROM customers WHERE strptime(opened_at, '%H:%M:%S %d/%m/%Y') >= DATE '2050-01-01'""", ("customers",))(
    lambda c: counts_with_total(
        K.sales_accounts(c).filter(in_month(F.col("opened_at"), 2050, 1)),
        ["dept", "owner"], "account_code", "n_accounts")
)

POOL = "CASE dept " + " ".join(f"WHEN '{d}' THEN '{x}'" for d, x in v.SHARED_POOL_LABELS.items()) + " ELSE 'Kho Chung' END"


def held(name: str, sources: list[tuple[str, str]]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT {MERGED} AS dept, {owner} AS owner, account_code FROM {src} WHERE dept IN ({SALES})"
        for src, owner in sources
    )
    return f"""{name}_rows AS ({rows}), {name} AS (
 SELECT dept, CASE WHEN owner = 'Kho Chung' THEN {POOL} ELSE owner END AS owner, n_accounts FROM (
  SELECT dept, owner, count(account_code) AS n_accounts FROM {name}_rows WHERE owner IS NOT NULL GROUP BY dept, owner)
 UNION ALL SELECT 'TOTAL', '', count(account_code) FROM {name}_rows WHERE owner IS NOT NULL)"""


KH = [("shared_customers", "'Kho Chung'"), ("customers", "owner")]
TN = [("shared_prospects", "'Kho Chung'"), ("prospects", "owner")]
FEEDS = ("customers", "shared_customers", "prospects", "shared_prospects", "field_staff")


def portfolios(c: DataFrame, sc: DataFrame, p: DataFrame, sp: DataFrame, staff: DataFrame) -> tuple[DataFrame, DataFrame]:
    held_customers = [K.sales_accounts(sc, v.SHARED_POOL), K.sales_accounts(c)]
    held_prospects = [K.sales_accounts(sp, v.SHARED_POOL), K.sales_accounts(p)]
    return K.portfolio(held_customers, staff), K.portfolio(held_prospects + held_customers, staff)


query("portfolio_shared_pool", f", {held('kh', KH)}{STAFF} {CODED.format('', 'kh')}", FEEDS)(
    lambda *feeds: portfolios(*feeds)[0]
)
query("portfolio", f", {held('both_kinds', TN + KH)}{STAFF} {CODED.format('', 'both_kinds')}", FEEDS)(
    lambda *feeds: portfolios(*feeds)[1]
)
