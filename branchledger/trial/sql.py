"""SQL fragments for the oracles, written against the rules and not from the library code."""

from __future__ import annotations

from datetime import date

from branchledger import values as v
from branchledger.operators.periods import Calendar, Closing
from branchledger.trial.inputs import DISTRIBUTORS, OFFICES

# Head-office departments with a closing calendar; other departments have none.
_HEAD_DEPTS = ["Bán Buôn HN", "Beauty HN", "VP Thái Nguyên", "Phòng KDT", "Nội Bộ"]


def _closings(i: int, n: int = 9) -> list[Closing]:
    """Eight-month closings with gaps, overlaps and, for even ``i``, an open end."""

    def day(months: int, d: int) -> date:
        return date(1995 + months // 12, months % 12 + 1, d)

    out = []
    for q in range(n):
        start = day(q * 8 + i % 4, 3 + i)
        end = day(q * 8 + i % 4 + 8, (3 + i, 1, 25)[q % 3])
        last_open = q == n - 1 and i % 2 == 0
        month = q * 8 + i % 4 + 1
        out.append(Closing(start, None if last_open else end, f"{1995 + month // 12}-{month % 12 + 1:02d}"))
    return out


HEAD_CALENDAR: Calendar = {d: _closings(i) for i, d in enumerate(_HEAD_DEPTS)}
# The last office has no calendar and the one before an empty list.
OFFICE_CALENDAR: Calendar = {d: _closings(i) for i, d in enumerate(OFFICES[:-2])} | {OFFICES[-2]: []}


def _month(period: str, shift: int) -> str:
    return f"CAST(DATE '{period}-01' + INTERVAL ({shift}) MONTH AS DATE)"


def period_case(calendar: Calendar, dept: str, d: str, fallback: str) -> str:
    """The closing rule as an ordered CASE chain: first day of the accounting month."""
    depts = []
    for name, closings in calendar.items():
        if not closings:
            continue
        tests = []
        for c in closings:
            start, end = f"DATE '{c.start}'", f"DATE '{c.end or '2099-12-31'}'"
            tests.append(f"WHEN {d} <= {start} THEN {_month(c.period, -1)}")
            tests.append(f"WHEN {d} > {start} AND {d} <= {end} THEN {_month(c.period, 0)}")
            if c == closings[-1]:
                tests.append(f"WHEN {d} > {end} THEN {_month(c.period, 1)}")
        depts.append(f"WHEN '{name}' THEN CASE {' '.join(tests)} ELSE {fallback} END")
    return f"CASE {dept} {' '.join(depts)} ELSE {fallback} END"


def dept_case(n: str, default: str, exact: bool = True) -> str:
    overrides = f"""
 WHEN {n} IN ('NGUYEN VĂN TN', 'CAO THI TN') THEN 'VP Thái Nguyên'
 WHEN {n} IN ('Nguyễn Văn A', 'Trần Văn B', 'Trần Toàn M') THEN 'VP Hải Dương'"""
    return f"""CASE{overrides if exact else ''}
 WHEN contains({n}, 'Nguyễn Văn A') THEN 'Phòng Marketing'
 WHEN {n} LIKE '% TN' THEN 'VP Thái Nguyên'
 WHEN {n} LIKE '%.' THEN 'Beauty HN'
 WHEN {n} LIKE '% Bb' THEN 'Bán Buôn HN'
 WHEN contains({n}, 'Nguyễn Thị Q') THEN 'Phòng KD3'
 WHEN contains({n}, ' ABC') THEN 'Nội Bộ'
 WHEN {n} LIKE '%-T' THEN 'Phòng KDT'
 ELSE '{default}' END"""


def customer_type_case(c: str) -> str:
    listed = ", ".join(f"'{x}'" for x in DISTRIBUTORS)
    return f"""CASE WHEN {c} IN ({listed}) THEN 'Nhà phân phối'
 WHEN contains({c}, '_DL_') THEN 'Đại lý' WHEN contains({c}, '_BS_') THEN 'Beauty Salon'
 ELSE 'Khác' END"""


def stripped(n: str) -> str:
    out = f"trim({n})"
    for suffix in (" TN", " Bb", r"\.", "-T", r" \."):
        out = f"trim(regexp_replace({out}, '{suffix}$', ''))"
    return out


def titled(c: str, letters: str = r"\p{L}") -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({c}, '[{letters}]+|[^{letters}]+'), "
        "lambda w: upper(w[1]) || lower(w[2:])), '')"
    )


INITCAP = r"\p{L}\p{N}"


def normed(c: str) -> str:
    return f"replace(upper({c}), ' ', '')"


def whole_number(c: str) -> str:
    return f"CAST(trunc(coalesce(TRY_CAST({c} AS DOUBLE), 0)) AS BIGINT)"


LOOKUP = """staff_lookup AS (
 SELECT employee_name, dept AS staff_dept, min(employee_code) AS employee_code
 FROM stacked WHERE employee_name IS NOT NULL AND dept IS NOT NULL GROUP BY ALL)"""

STACKED = f"""stacked AS (
 SELECT employee_code, employee_name, CASE WHEN dept = 'Hà Nội'
   THEN {dept_case('employee_name', 'Hà Nội', exact=False)} ELSE dept END AS dept FROM staff)"""

_REPORT = """voucher_no, product_group_code, product_group_name, general_note, note, customer_code,
 customer_name, product_code, product_name, unit, allowance"""


def typed_sales(source: str, dept: str) -> str:
    """Parsed ledger lines; ``dept`` is an expression over the raw line."""
    money = ", ".join(
        f"CAST({c} AS DOUBLE) AS {c}"
        for c in ("unit_price", "gross_sales", "discount", "return_value", "vat", "total_payment")
    )
    return f"""typed AS (
 SELECT CAST(strptime(posting_date, '%d/%m/%Y') AS DATE) AS posted, {_REPORT}, {money},
  {whole_number('qty_sold')} AS qty_sold, {whole_number('qty_returned')} AS qty_returned,
  salesperson, {dept} AS dept FROM {source})"""


def ledger(name: str, calendar: Calendar, fallback: str, salesperson: str, keep_customers: bool = True) -> str:
    """Full ledger CTE from ``typed`` and ``staff_lookup``."""
    return f"""{name}_dated AS (
 SELECT t.*, s.employee_code, {period_case(calendar, 't.dept', 't.posted', fallback)} AS cm
 FROM typed t LEFT JOIN staff_lookup s ON t.salesperson = s.employee_name AND t.dept = s.staff_dept),
{name} AS (
 SELECT CAST(posted AS VARCHAR) AS posting_date, {_REPORT}, qty_sold, unit_price, gross_sales, discount,
  qty_returned, return_value, vat, total_payment, {salesperson} AS salesperson, employee_code, dept,
  CAST(month(cm) AS INTEGER) AS closing_month, CAST(year(cm) AS INTEGER) AS closing_year, strftime(cm, '%Y-%m') AS period,
  {customer_type_case('customer_code')} AS customer_type,
  total_payment - vat AS net_revenue, qty_sold - qty_returned AS net_qty
 FROM {name}_dated)"""


MONTH_OF_DATE = "CAST(date_trunc('month', t.posted) AS DATE)"
HEAD_NAME = (
    f"CASE {stripped('salesperson')} WHEN 'Tạ Thị ABC' THEN 'Tạ Thị ABC (tk new)' "
    f"ELSE {stripped('salesperson')} END"
)


def head_ledger(source: str = "sales") -> str:
    """CTEs from raw ``sales`` and ``staff`` to ``head`` (starts with a comma)."""
    return (
        f", {STACKED}, {LOOKUP}, {typed_sales(source, dept_case('salesperson', 'Khác'))}, "
        + ledger("head", HEAD_CALENDAR, MONTH_OF_DATE, HEAD_NAME)
    )


def province_ledger(source: str = "sales") -> str:
    return (
        f", {STACKED}, {LOOKUP}, {typed_sales(source, 'dept')}, "
        + ledger("prov", OFFICE_CALENDAR, "NULL", titled("salesperson"))
    )


def both_ledgers() -> str:
    """``head`` and ``prov`` over the same lines, and their union ``ledger``."""
    prov = province_ledger()
    prov = prov[prov.index("typed AS"):].replace("typed AS", "typed_p AS", 1).replace("FROM typed t", "FROM typed_p t")
    return f"{head_ledger()}, {prov}, ledger AS (SELECT * FROM head UNION ALL SELECT * FROM prov)"


def tagless(name: str) -> str:
    """A name without the ending that dimensions cut off, and without the tag they drop anywhere."""
    return f"replace(regexp_replace({name}, '{v.DIM_NAME_TAIL}', ''), '{v.DIM_NAME_ANYWHERE}', '')"
