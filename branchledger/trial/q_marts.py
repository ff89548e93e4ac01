"""Mart queries over the ledger and the dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from branchledger.plans import marts as M
from branchledger.trial import q_dims, sql as S
from branchledger.trial.q_dims import EMPLOYEE_INPUTS, EMPLOYEES, LONG
from branchledger.trial.q_ledger import head
from branchledger.trial.registry import query

HEAD = S.head_ledger()
LINES = ("sales", "staff")
DEC = "CAST({0} AS DECIMAL(18,2))"
AS_OF = date(2001, 12, 31)


def score(x: str, order: str) -> str:
    """Fifths with the customer code as tie-break."""
    nulls = "NULLS FIRST" if order == "ASC" else "NULLS LAST"
    return f"ntile(5) OVER (ORDER BY {x} {order} {nulls}, customer_code)"


query("rfm_segments", f"""{HEAD},
c AS (SELECT customer_code, date_diff('day', max(CAST(posting_date AS DATE)), DATE '{AS_OF}') AS recency,
 count(DISTINCT voucher_no) AS frequency, sum({DEC.format('net_revenue')}) AS monetary
 FROM head WHERE customer_code IS NOT NULL GROUP BY 1),
s AS (SELECT customer_code, recency, frequency, CAST(monetary AS DOUBLE) AS monetary,
 {score('recency', 'DESC')} AS recency_score, {score('frequency', 'ASC')} AS frequency_score,
 {score('CAST(monetary * 100 AS BIGINT)', 'ASC')} AS monetary_score FROM c)
SELECT *, recency_score + frequency_score + monetary_score AS rfm_total FROM s""", LINES)(
    lambda s, st: M.rfm_segments(head(s, st), AS_OF)
)

query("product_yoy", f"""{HEAD},
y AS (SELECT product_code, closing_year, sum({DEC.format('net_revenue')}) AS revenue FROM head
 WHERE closing_year IS NOT NULL GROUP BY ALL)
SELECT a.product_code, CAST(a.closing_year AS INTEGER) AS closing_year, CAST(a.revenue AS DOUBLE) AS revenue, CAST(b.revenue AS DOUBLE) AS last_year,
 round(CAST(a.revenue - b.revenue AS DOUBLE) / CAST(nullif(b.revenue, 0) AS DOUBLE), 6) AS growth
FROM y a LEFT JOIN y b ON a.product_code = b.product_code AND a.closing_year = b.closing_year + 1""", LINES)(
    lambda s, st: M.product_yoy(head(s, st))
)

TOTALS = f"""t AS (SELECT dept, period, sum({DEC.format('net_revenue')}) AS actual FROM head WHERE period IS NOT NULL GROUP BY ALL),
g AS (SELECT dept, period, sum({DEC.format('target')}) AS target FROM long WHERE regexp_matches(period, '^\\d{{4}}-\\d{{2}}$') GROUP BY ALL),
k AS (SELECT dept, period FROM t UNION SELECT dept, period FROM g WHERE target IS NOT NULL)"""

query("targets_vs_actual", f"""{HEAD}, {LONG}, {TOTALS}
SELECT k.dept, k.period, CAST(t.actual AS DOUBLE) AS actual, CAST(p.actual AS DOUBLE) AS last_year,
 CAST(g.target AS DOUBLE) AS target, round(CAST(t.actual AS DOUBLE) / CAST(nullif(g.target, 0) AS DOUBLE), 6) AS attainment
FROM k LEFT JOIN t ON t.dept IS NOT DISTINCT FROM k.dept AND t.period = k.period
LEFT JOIN t p ON p.dept IS NOT DISTINCT FROM k.dept
 AND CAST(CAST(left(p.period, 4) AS INT) + 1 AS VARCHAR) || substr(p.period, 5) = k.period
LEFT JOIN g ON g.dept IS NOT DISTINCT FROM k.dept AND g.period = k.period""", (*LINES, "target_matrix"))(
    lambda s, st, m: M.dept_attainment(head(s, st), q_dims.company(m))
)

query("branch_overview", f"""{HEAD} SELECT dept, CAST(sum({DEC.format('net_revenue')}) AS DOUBLE) AS net_revenue,
 CAST(sum(net_qty) AS BIGINT) AS net_qty, count(*) AS n_lines, count(DISTINCT customer_code) AS n_customers
FROM head GROUP BY dept""", LINES)(lambda s, st: M.overview(head(s, st)))

query("headcount", f""", {EMPLOYEES}, e AS (SELECT dept,
 (coalesce(work_status = 'Đã Nghỉ', false) OR left_on IS NOT NULL) AS gone FROM employees)
SELECT dept, count(*) AS employees, count(*) FILTER (NOT gone) AS active, count(*) FILTER (gone) AS left_company
FROM e GROUP BY dept""", EMPLOYEE_INPUTS)(lambda *e: M.headcount(q_dims.employees(*e)))


def factor(key: str) -> str:
    return f"(0.9::DOUBLE + 0.2::DOUBLE * (CAST(CAST('0x' || substr(md5('s1' || {key}), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0::DOUBLE))"


query("noise_growth", f"""{HEAD} SELECT product_code, posting_date, voucher_no,
 net_revenue * coalesce({factor('product_code')}, 1.0) AS net_revenue FROM head""", LINES)(
    lambda s, st: M.noised(head(s, st), ["net_revenue"], "product_code", 0.1, "s1")
    .select("product_code", "posting_date", "voucher_no", "net_revenue")
)


def masked_ledger(sales: DataFrame, staff: DataFrame) -> DataFrame:
    return M.masked(head(sales, staff), ["salesperson", "customer_code", "customer_name"]).select(
        "voucher_no", "product_code", "salesperson", "customer_code", "customer_name"
    )


query("mask_ledger", f"""{HEAD} SELECT voucher_no, product_code, md5(salesperson) AS salesperson,
 md5(customer_code) AS customer_code, md5(customer_name) AS customer_name FROM head""", LINES)(masked_ledger)
