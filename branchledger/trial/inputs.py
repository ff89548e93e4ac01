"""Report-shaped inputs derived from the test tables.

Each input is one projection written in SQL that Spark and the oracle engine both read,
so the two sides start from the same rows. Dirty values (spaces, lower case, nulls, bad
numbers, suffixes) are derived from keys; every input covers its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


# Declared, so that reading a table starts no schema-inference job.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def _case(key: str, values: list[str | None]) -> str:
    """Value number ``key`` modulo the list length; None becomes null."""
    picked = f"split_part('{'|'.join(v or '' for v in values)}', '|', CAST({key} % {len(values)} + 1 AS INT))"
    return f"nullif({picked}, '')" if None in values else picked


def _half(key: str) -> str:
    """Keys 2j and 2j+1 share a person, so staff lists repeat names."""
    return f"CAST(({key} - {key} % 2) / 2 AS BIGINT)"


def person(key: str) -> str:
    j = _half(key)
    names = [
        "Nguyễn Văn A", "lê thị bích", "TRẦN o`minh", "phạm văn-đức", "Nguyễn Thị Q",
        "Tạ Thị ABC", "hoàng x.thu", "Đỗ  hạnh", "Trần Văn B", "bùi LAN",
    ]
    number = f"(CASE WHEN {j} % 10 IN (5, 8) THEN '' ELSE ' ' || CAST(floor({key} / 20) AS BIGINT) END)"
    suffix = _case(j, ["", " TN", ".", " Bb", "-T", " .", " Bb.", "  "])
    return f"({_case(j, names)} || {number} || {suffix})"


OFFICES = [
    "VP Cần Thơ", "VP Đà Nẵng", "VP Đăk Lăk", "VP Đồng Nai", "VP Hải Dương", "VP Hải Phòng",
    "VP Nam Định", "VP Nha Trang", "VP Sài Gòn", "VP Thanh Hóa", "VP Vinh",
]
FIELD_DEPTS = [
    "VP Sài Gòn", "VP Hưng Yên", "Beauty HN", "VP Đắk Lắk", "Marketing", "Bán buôn HN", "KD3",
    "Phòng KDT", "Vận hành", None, "VP Thái Nguyên", "VP Vinh", "Nhà máy",
]


def office(key: str) -> str:
    return _case(_half(key), OFFICES)


def field_dept(key: str) -> str:
    return _case(_half(key), FIELD_DEPTS)


def code(prefix: str, key: str) -> str:
    """The same code in three spellings."""
    low, key = prefix.lower(), f"({key})"
    return f"(CASE {key} % 3 WHEN 0 THEN '{prefix}' || {key} WHEN 1 THEN ' {low} ' || {key} ELSE '{low}' || {key} END)"


def two(x: str) -> str:
    return f"lpad(CAST({x} AS STRING), 2, '0')"


def day_text(ts: str) -> str:
    return f"({two(f'day({ts})')} || '/' || {two(f'month({ts})')} || '/' || CAST(year({ts}) AS STRING))"


def iso_text(ts: str) -> str:
    return f"(CAST(year({ts}) AS STRING) || '-' || {two(f'month({ts})')} || '-' || {two(f'day({ts})')})"


def seconds(ts: str) -> str:
    return f"(CAST(hour({ts}) AS BIGINT) * 3600 + CAST(minute({ts}) AS BIGINT) * 60 + CAST(second({ts}) AS BIGINT))"


def clock_text(sec: str) -> str:
    h = f"CAST(({sec} - {sec} % 3600) / 3600 AS BIGINT)"
    m = f"CAST(({sec} % 3600 - {sec} % 60) / 60 AS BIGINT)"
    return f"({two(h)} || ':' || {two(m)} || ':' || {two(f'{sec} % 60')})"


def stamp_text(ts: str) -> str:
    return f"({clock_text(seconds(ts))} || ' ' || {day_text(ts)})"


CUSTOMER_CODE = """(CASE o_custkey % 6 WHEN 0 THEN 'HN_DL_' || o_custkey WHEN 1 THEN 'HN_BS_' || o_custkey
 WHEN 2 THEN 'aXDLY' || o_custkey WHEN 3 THEN NULL WHEN 4 THEN 'NPP_DL_' || (o_custkey % 24)
 ELSE 'kh ' || o_custkey END)"""
DISTRIBUTORS = ["NPP_DL_4", "NPP_DL_10"]

# Amounts with exactly two decimals, from exact decimal arithmetic.
GROSS = "CAST(l_extendedprice AS DECIMAL(12,2))"
DISCOUNT = f"round({GROSS} * CAST(l_discount AS DECIMAL(4,2)), 2)"
VAT = f"round(({GROSS} - {DISCOUNT}) * CAST(l_tax AS DECIMAL(4,2)), 2)"


def text(x: str) -> str:
    return f"CAST({x} AS STRING)"


_SALES_COLUMNS = f"""
    {day_text('l_shipdate')} AS posting_date,
    'BH' || l_orderkey AS voucher_no,
    'N' || (l_partkey % 25) AS product_group_code,
    'Nhóm ' || (l_partkey % 25) AS product_group_name,
    'Bán hàng ' || l_returnflag AS general_note,
    l_linestatus AS note,
    {{customer}} AS customer_code,
    {{customer_name}} AS customer_name,
    'SP' || l_partkey AS product_code,
    'Sản phẩm ' || l_partkey AS product_name,
    'Chai' AS unit,
    (CASE WHEN l_partkey % 97 = 0 THEN 'x' WHEN l_partkey % 89 = 0 THEN NULL
          WHEN l_partkey % 83 = 0 THEN CAST(l_quantity AS BIGINT) || '.9'
          ELSE {text('CAST(l_quantity AS BIGINT)')} END) AS qty_sold,
    {text('l_partkey % 900 + 100')} AS unit_price,
    {text(GROSS)} AS gross_sales,
    {text(DISCOUNT)} AS discount,
    (CASE l_returnflag WHEN 'R' THEN '1' WHEN 'A' THEN '0' END) AS qty_returned,
    (CASE l_returnflag WHEN 'R' THEN {text(GROSS)} ELSE '0' END) AS return_value,
    l_returnflag AS allowance,
    {text(VAT)} AS vat,
    {text(f'{GROSS} - {DISCOUNT} + {VAT}')} AS total_payment,
    {person('l_suppkey')} AS salesperson,
    {office('l_suppkey')} AS dept"""

_STAFF_COLUMNS = f"""
    {code('NV', 's_suppkey')} AS employee_code,
    {person('s_suppkey')} AS employee_name,
    {_case('s_suppkey', ['Nam', 'Nữ', None])} AS gender,
    'nhân VIÊN kinh doanh ' || (s_suppkey % 4) AS title"""

_ACCOUNT_REST = """
    'Số ' || ({k} % 90) AS address,
    'Tỉnh ' || ({k} % 60) AS province,
    '84' || (900000000 + {k}) AS phone,
    (CASE {k} % 3 WHEN 0 THEN 'Salon' WHEN 1 THEN 'Đại lý' ELSE 'Spa Salon' END) AS customer_kind"""


def _account_rest(key: str) -> str:
    return _ACCOUNT_REST.format(k=key)


# ``{table}`` stands for a test table; a trailing ``dept`` of sales is the office file tag.
INPUTS = {
    # Accounting ledger lines with the customer of their order.
    "sales": f"""
SELECT {_SALES_COLUMNS.format(customer=CUSTOMER_CODE, customer_name="'Khách ' || o_custkey")}
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""",
    # The same lines without customers (no join), for questions that need none.
    "sales_lines": f"""
SELECT {_SALES_COLUMNS.format(customer="CAST(NULL AS STRING)", customer_name="CAST(NULL AS STRING)")}
FROM {{lineitem}}""",
    # Accounting staff: everyone in the head-office file and in a branch file.
    "staff": f"""
SELECT {_STAFF_COLUMNS}, 'Hà Nội' AS dept FROM {{supplier}}
UNION ALL SELECT {_STAFF_COLUMNS}, {office('s_suppkey')} AS dept FROM {{supplier}}""",
    "visits": f"""
SELECT {field_dept('user_id')} AS dept, 'NV' || user_id AS employee_code,
    {person('user_id')} AS employee_name,
    (CASE WHEN event_id % 13 = 0 THEN NULL ELSE 'KH' || (event_id * 7 % 500) END) AS customer_code,
    (CASE WHEN event_id % 17 = 0 THEN {clock_text(seconds('ts'))}
          WHEN event_id % 19 = 0 THEN {clock_text(seconds('ts'))} || ' - '
          WHEN event_id % 23 = 0 THEN 'sáng - chiều'
          WHEN event_id % 29 = 0 THEN NULL
          ELSE {clock_text(seconds('ts'))} || ' - ' ||
               {clock_text(f"(({seconds('ts')} + CAST(floor(value * 20) AS BIGINT)) % 86400)")} END) AS visit_time
FROM {{events}}""",
    "visit_summary": f"""
SELECT {person('user_id')} AS employee_name, 'NV' || user_id AS employee_code,
    {field_dept('user_id')} AS dept,
    CAST(count(DISTINCT CASE WHEN event_type = 'purchase' AND user_id % 7 > 0 THEN event_id % 40 END) AS DOUBLE) AS customers,
    CAST(count(CASE WHEN event_type = 'purchase' THEN 1 END) AS DOUBLE) AS customer_visits,
    CAST(count(DISTINCT CASE WHEN event_type = 'signup' THEN event_id % 30 END) AS DOUBLE) AS prospects,
    CAST(count(CASE WHEN event_type = 'signup' THEN 1 END) AS DOUBLE) AS prospect_visits,
    CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS kilometers
FROM {{events}} GROUP BY user_id""",
    # Field-sales accounts: own customers, shared customers, own and shared prospects.
    "customers": f"""
SELECT {code('KH', 'o_custkey')} AS account_code, 'Khách ' || o_custkey AS account_name,
    {person('o_custkey')} AS owner,
    (CASE o_orderstatus WHEN 'F' THEN 'Đã duyệt' WHEN 'O' THEN 'Chờ duyệt' ELSE 'Từ chối' END) AS status,
    {stamp_text('o_orderdate')} AS opened_at, {field_dept('o_custkey')} AS dept,{_account_rest('o_custkey')}
FROM {{orders}}""",
    "shared_customers": f"""
SELECT {code('KH', 'c_custkey + 700')} AS account_code, c_name AS account_name,
    (CASE WHEN c_acctbal < 0 THEN 'Chờ duyệt' ELSE 'Đã duyệt' END) AS status,
    '08:30:00 0' || (1 + c_custkey % 9) || '/03/1998' AS opened_at,
    {field_dept('c_custkey')} AS dept,{_account_rest('c_custkey')}
FROM {{customer}}""",
    "prospects": f"""
SELECT {code('TN', 'event_id')} AS account_code, 'Tiềm năng ' || event_id AS account_name,
    {person('user_id')} AS owner,
    (CASE event_type WHEN 'purchase' THEN 'Đã duyệt' WHEN 'error' THEN 'Từ chối' ELSE 'Chờ duyệt' END) AS status,
    {stamp_text('ts')} AS opened_at, {field_dept('user_id')} AS dept,{_account_rest('event_id')}
FROM {{events}}""",
    "shared_prospects": f"""
SELECT {code('TN', 'p_partkey')} AS account_code, p_name AS account_name, 'Chờ duyệt' AS status,
    '17:05:09 1' || (p_partkey % 9) || '/01/2024' AS opened_at,
    {field_dept('p_partkey')} AS dept,{_account_rest('p_partkey')}
FROM {{part}}""",
    # Field-sales staff list.
    "field_staff": f"""
SELECT {code('NV', 'c_custkey')} AS employee_code, {person('c_custkey')} AS employee_name,
    '84' || (c_custkey % 1000) || '84' AS login, '84' || (900000000 + c_custkey) AS phone,
    '01/02/1990' AS born_on, {_case('c_custkey', ['Nữ', None, 'Nam'])} AS gender,
    {field_dept('c_custkey')} AS dept,
    {_case('c_custkey', [None, 'giám SÁT bán hàng', 'NHÂN VIÊN'])} AS title
FROM {{customer}}""",
    # HR sheet: several rows per code.
    "hr": f"""
SELECT (CASE WHEN event_id % 31 = 0 THEN NULL ELSE {code('NV', 'user_id * 2')} END) AS employee_code,
    {person('user_id')} AS employee_name,
    {_case('user_id', ['đang làm việc', 'đã nghỉ', 'THAI sản'])} AS work_status,
    {_case('user_id', ['VP  Vinh', 'Phòng  Beauty HN', 'KD3', 'Vận hành'])} AS dept,
    'CN  ' || (user_id % 3) AS branch,
    {_case('user_id', ['bán hàng', 'chăm-sóc 24h', None])} AS specialty,
    {_case('user_id', [None, 'Nam', 'Nữ', 'Nam'])} AS gender,
    (CASE event_id % 4 WHEN 0 THEN {iso_text('ts')} || ' 00:00:00' WHEN 1 THEN {day_text('ts')}
         WHEN 2 THEN 'không rõ' ELSE '2024-02-31' END) AS born_on,
    (CASE event_id % 3 WHEN 0 THEN {iso_text('ts')} WHEN 1 THEN {day_text('ts')} END) AS hired_on,
    (CASE WHEN user_id % 3 = 1 THEN {iso_text('ts')} END) AS left_on
FROM {{events}}""",
    "hand_customers": f"""
SELECT {code('KH', 'c_custkey + 300')} AS customer_code, c_name AS customer_name,
    (CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE {person('c_custkey')} END) AS owner,
    {_case('c_custkey', ['VP Vinh', 'Beauty HN', None])} AS dept, 'Ngõ ' || (c_custkey % 70) AS address,
    {_case('c_custkey', ['BS', 'ĐL', None, 'BS lẻ'])} AS customer_kind
FROM {{customer}}""",
    "accounting_customers": f"""
SELECT {code('KH', 'o_custkey * 2')} AS customer_code, 'KT ' || o_custkey AS customer_name,
    'Phố ' || (o_custkey % 50) AS address,
    (CASE WHEN o_custkey % 4 = 0 THEN 'nv' || (o_custkey % 97) END) AS owner_code,
    {person('o_custkey')} AS owner, {iso_text('o_orderdate')} AS created_on,
    {office('o_custkey')} AS dept
FROM {{orders}}""",
    "field_products": f"""
SELECT {code('SP', 'p_partkey')} AS product_code, p_name AS product_name,
    (CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_brand END) AS brand, p_type AS category,
    (1 + p_partkey % 9) || '.' || lpad(CAST(p_partkey * 37 % 1000 AS STRING), 3, '0') || '.000VND' AS list_price,
    (CASE p_partkey % 4 WHEN 0 THEN p_size || 'ml' WHEN 1 THEN '1.' || (100 + p_size) || 'g'
         WHEN 2 THEN 'hộp ' || p_size END) AS volume
FROM {{part}}""",
    "accounting_products": f"""
SELECT {code('SP', 'l_partkey')} AS product_code, 'KT ' || l_partkey AS product_name,
    {_case('l_partkey', ['Chai', 'Hộp', None])} AS unit,
    {_case('l_partkey', ['Có', 'Không'])} AS discontinued
FROM {{lineitem}}""",
    "hand_products": f"""
SELECT {code('SP', 'p_partkey * 2')} AS product_code, 'TAY ' || p_name AS product_name,
    {_case('p_partkey', ['Đang bán', 'Ngừng', None])} AS status,
    {_case('p_partkey', [None, 'Tuýp'])} AS unit, 'T' || p_brand AS brand,
    'Nhóm ' || (p_size % 7) AS group_2, p_type AS product_group_name
FROM {{part}}""",
    # Orders and warehouse documents. Document numbers overlap only in part.
    "order_headers": f"""
SELECT {code('DH', 'o_orderkey')} AS order_code, 'Khách ' || o_custkey AS account_name,
    {CUSTOMER_CODE} AS account_code,
    (CASE o_orderstatus WHEN 'F' THEN 'VD' || (o_orderkey * 3) END) AS waybill,
    CAST(o_orderkey % 9 AS DOUBLE) AS n_products, o_totalprice AS amount,
    CAST(o_orderkey % 50 AS DOUBLE) AS discount, o_totalprice AS paid,
    'NV' || (o_custkey % 90) AS created_by, o_orderstatus AS status, o_orderdate AS created_at
FROM {{orders}}""",
    "stock_history": f"""
SELECT {code('DH', 'l_orderkey + 40')} AS ref_code,
    {_case('l_suppkey', ['Kho HN', 'Kho SG', None])} AS warehouse,
    {_case('l_partkey', ['Khách lẻ', 'Phiếu Mượn Hàng Mẫu 1', None, 'Đại lý'])} AS partner,
    l_shipdate AS occurred_at, {code('SP', 'l_partkey')} AS product_code,
    'Sản phẩm ' || l_partkey AS product_name, l_returnflag AS movement, '100ml' AS volume,
    l_quantity AS qty
FROM {{lineitem}}""",
    "inbound": f"""
SELECT {code('DH', 'o_orderkey + 20')} AS slip_code, 'Nhập ' || o_orderpriority AS slip_type,
    'NV' || (o_custkey % 70) AS created_by, o_orderdate AS created_at, 'Nhập kho' AS status
FROM {{orders}}""",
    "outbound": f"""
SELECT {code('DH', 'o_orderkey + 30')} AS slip_code, 'Xuất ' || o_orderpriority AS slip_type,
    'NV' || (o_custkey % 60) AS created_by, o_orderdate AS created_at, 'Xuất kho' AS status
FROM {{orders}}""",
    "lading": """
SELECT 'VD' || (o_orderkey * 6) AS waybill, 'Xe ' || (o_custkey % 12) AS carrier,
    o_orderpriority AS status, o_orderdate AS created_at
FROM {orders}""",
    # Month matrix of targets: one row per employee, departments repeat.
    "target_matrix": f"""
SELECT (CASE WHEN s_suppkey % 25 = 24 THEN 'Chỉ tiêu 2026' ELSE {_case('s_suppkey', ['Phòng Bán Buôn HN', 'Phòng Beauty HN', 'Phòng KD Tỉnh', 'VP Thái Nguyên', 'Khác', None])} END) AS dept,
    {person('s_suppkey')} AS employee_name,
    CAST(100000 + s_suppkey * 1000 AS STRING) AS m1,
    CAST(NULL AS STRING) AS m2, CAST(200000 + s_suppkey AS STRING) AS m3,
    CAST(300000.5 + s_suppkey AS STRING) AS m_total, '7' AS m_other
FROM {{supplier}}""",
}
# Header text of the matrix columns (not writable as neutral SQL names).
TARGET_LABELS = {
    "m1": "Tháng 1", "m2": "Tháng 2", "m3": "Tháng 3, 1999", "m_total": "Tổng", "m_other": "Ghi chú",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input, or a test table, as a DataFrame."""
    if name not in INPUTS:
        return table(spark, sf_dir, name)
    sql = INPUTS[name]
    used = {t: table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in sql}
    return spark.sql(sql, **used)


def oracle_ctes(*names: str) -> str:
    """The inputs as CTEs of an oracle query (``WITH`` not included)."""
    plain = {t: t for t in TABLES}
    return ",\n".join(f"{n} AS ({INPUTS[n].format(**plain)})" for n in names)
