"""Column-level queries: text, number and date expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from branchledger import values as v
from branchledger.functions import parsing as P, rules as R, text as T
from branchledger.functions.money import cents
from branchledger.operators.latest import upsert
from branchledger.plans.dims import literal_renames
from branchledger.trial import sql as S
from branchledger.trial.registry import query

NAME_KEY = ("voucher_no", "salesperson")

query("suffix_strip_names", f"""SELECT salesperson, {S.HEAD_NAME} AS clean_name, count(*) AS n
FROM sales_lines GROUP BY ALL""", ("sales_lines",))(
    lambda s: s.groupBy("salesperson").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "clean_name", R.recode(T.strip_suffixes(F.col("salesperson"), v.NAME_SUFFIXES), v.NAME_RECODE))
)

query("title_case_names", f"""SELECT account_code, owner, {S.titled('owner')} AS title_letters,
 {S.titled('owner', S.INITCAP)} AS title_words, {S.titled('customer_kind')} AS kind FROM customers""",
      ("customers",))(
    lambda c: c.select("account_code", "owner", T.title_letters(F.col("owner")).alias("title_letters"),
                       T.title_words(F.col("owner")).alias("title_words"),
                       T.title_letters(F.col("customer_kind")).alias("kind"))
)

query("sentence_case", """SELECT employee_code, upper(substr(title, 1, 1)) || lower(substr(title, 2)) AS title
FROM field_staff""", ("field_staff",))(
    lambda f: f.select("employee_code", T.sentence_case(F.col("title")).alias("title"))
)

query("code_norm", f"SELECT {S.normed('ref_code')} AS code, count(*) AS n FROM stock_history GROUP BY ALL",
      ("stock_history",))(
    lambda h: h.groupBy(T.norm_code(F.col("ref_code")).alias("code")).agg(F.count(F.lit(1)).alias("n"))
)

query("unit_strip_int", """SELECT product_code, TRY_CAST(replace(replace(list_price, 'VND', ''), '.', '') AS BIGINT) AS price,
 TRY_CAST(replace(replace(replace(volume, 'ml', ''), 'g', ''), '.', '') AS BIGINT) AS volume FROM field_products""",
      ("field_products",))(
    lambda p: p.select("product_code",
                       T.unit_int(F.col("list_price"), v.PRICE_UNITS).cast("bigint").alias("price"),
                       T.unit_int(F.col("volume"), v.VOLUME_UNITS).cast("bigint").alias("volume"))
)

query("login_prefix", "SELECT employee_code, regexp_replace(left(login, 50), '^84', '0') AS login FROM field_staff",
      ("field_staff",))(
    lambda f: f.select("employee_code", T.swap_prefix(F.col("login"), "84", "0").alias("login"))
)

query("lenient_numeric", f"""SELECT voucher_no, product_code, {S.whole_number('qty_sold')} AS qty_sold,
 {S.whole_number('qty_returned')} AS qty_returned FROM sales_lines""", ("sales_lines",))(
    lambda s: s.select("voucher_no", "product_code", P.lenient_long(F.col("qty_sold")).alias("qty_sold"),
                       P.lenient_long(F.col("qty_returned")).alias("qty_returned"))
)

MIXED = """CASE WHEN regexp_matches({0}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN CAST(TRY_CAST(left({0}, 10) AS DATE) AS VARCHAR)
 WHEN regexp_matches({0}, '^\\d{{2}}/\\d{{2}}/\\d{{4}}') THEN CAST(CAST(try_strptime(left({0}, 10), '%d/%m/%Y') AS DATE) AS VARCHAR) END"""
ISO = """CASE WHEN regexp_matches({0}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN CAST(TRY_CAST(left({0}, 10) AS DATE) AS VARCHAR) END"""

query("mixed_date_parse", f"""SELECT employee_code, born_on AS raw, {MIXED.format('born_on')} AS born_on,
 {ISO.format('hired_on')} AS hired_on FROM hr""", ("hr",))(
    lambda h: h.select("employee_code", F.col("born_on").alias("raw"),
                       P.mixed_date(F.col("born_on")).alias("born_on"), P.iso_date(F.col("hired_on")).alias("hired_on"))
)

query("date_shape_test", """SELECT regexp_matches(born_on, '^\\d{4}-\\d{2}-\\d{2}')::INT AS iso,
 regexp_matches(born_on, '^\\d{2}/\\d{2}/\\d{4}')::INT AS dmy, count(*) AS n FROM hr GROUP BY ALL""", ("hr",))(
    lambda h: h.groupBy(F.col("born_on").rlike(r"^\d{4}-\d{2}-\d{2}").cast("int").alias("iso"),
                        F.col("born_on").rlike(r"^\d{2}/\d{2}/\d{4}").cast("int").alias("dmy"))
    .agg(F.count(F.lit(1)).alias("n"))
)

query("strict_timestamp_parse", """SELECT account_code, CAST(strptime(opened_at, '%H:%M:%S %d/%m/%Y') AS VARCHAR) AS opened_at
FROM prospects""", ("prospects",))(
    lambda p: p.select("account_code", P.strict_stamp(F.col("opened_at")).alias("opened_at"))
)

query("strict_casts", """SELECT voucher_no, product_code, CAST(strptime(posting_date, '%d/%m/%Y') AS DATE)::VARCHAR AS posting_date,
 CAST(vat AS DOUBLE) AS vat, CAST(unit_price AS BIGINT) AS unit_price FROM sales_lines""", ("sales_lines",))(
    lambda s: s.select("voucher_no", "product_code", P.strict_date(F.col("posting_date")).alias("posting_date"),
                       F.col("vat").cast("double").alias("vat"), F.col("unit_price").cast("bigint").alias("unit_price"))
)

# Labels as people write them, from order dates; some orders give malformed ones, some the total's.
MONTH_LABEL = """CASE WHEN o_orderkey % 11 = 0 THEN 'Tổng' WHEN o_orderkey % 13 = 0 THEN 'Ghi chú ' || month(o_orderdate)
 WHEN o_orderkey % 17 = 0 THEN 'Tháng, ' || o_orderpriority WHEN o_orderkey % 2 = 0 THEN 'Tháng ' || month(o_orderdate)
 WHEN o_orderkey % 3 = 0 THEN 'Tháng  ' || month(o_orderdate) || ',  ' || year(o_orderdate)
 ELSE 'Tháng ' || month(o_orderdate) || ', ' || year(o_orderdate) END"""

query("month_label_key", f"""SELECT {MONTH_LABEL} AS label, CASE
 WHEN o_orderkey % 11 = 0 THEN 'Tổng' WHEN o_orderkey % 13 = 0 OR o_orderkey % 17 = 0 THEN NULL
 WHEN o_orderkey % 2 = 0 THEN '2026-' || strftime(o_orderdate, '%m') ELSE strftime(o_orderdate, '%Y-%m') END AS period,
 count(*) AS n FROM orders GROUP BY ALL""", ("orders",))(
    lambda o: o.groupBy(F.expr(MONTH_LABEL).alias("label")).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "period", P.month_label_key(F.col("label"), 2026))
)

query("month_parts", """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS n
FROM orders GROUP BY ALL""", ("orders",))(
    lambda o: o.groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    .agg(F.count(F.lit(1)).alias("n"))
)

query("month_shift", """SELECT strftime(o_orderdate, '%Y-%m') AS month, strftime(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH, '%Y-%m') AS before,
 strftime(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH, '%Y-%m') AS after, count(*) AS n FROM orders GROUP BY ALL""",
      ("orders",))(
    lambda o: o.withColumn("m", P.month_floor(F.col("o_orderdate"))).groupBy(
        P.month_text(F.col("m")).alias("month"), P.month_text(F.add_months("m", -1)).alias("before"),
        P.month_text(F.add_months("m", 1)).alias("after")).agg(F.count(F.lit(1)).alias("n"))
)

query("coalesce_nullif", """SELECT account_code, coalesce(nullif(CASE WHEN status = 'Từ chối' THEN '' ELSE owner END, ''), dept, '?') AS owner
FROM customers""", ("customers",))(
    lambda c: c.select("account_code", R.survivor(
        [F.when(F.col("status") == v.REJECTED, "").otherwise(F.col("owner")), F.col("dept"), F.lit("?")],
        blank_first=True).alias("owner"))
)

query("regex_suffix_clean", f"SELECT employee_code, {S.tagless(S.titled('employee_name', S.INITCAP))} AS employee_name FROM field_staff",
      ("field_staff",))(
    lambda f: f.select("employee_code", T.drop_name_tags(
        T.title_words(F.col("employee_name")), v.DIM_NAME_TAIL, v.DIM_NAME_ANYWHERE).alias("employee_name"))
)

query("literal_recode", """SELECT account_code, replace(customer_kind, 'Salon', 'Beauty Salon') AS customer_kind,
 CASE dept WHEN 'VP Hưng Yên' THEN 'VP Hải Dương' ELSE dept END AS dept FROM customers""", ("customers",))(
    lambda c: c.select("account_code", literal_renames(F.col("customer_kind"), v.FIELD_KIND_RENAMES).alias("customer_kind"),
                       R.recode(F.col("dept"), v.MERGED_OFFICES).alias("dept"))
)

SUPPORT = ", ".join(f"'{d}'" for d in v.SUPPORT_DEPTS)
SALES = ", ".join(f"'{d}'" for d in v.SALES_DEPTS)

query("exclude_depts_keep_null", f"""SELECT dept, count(*) AS n FROM visits
WHERE dept IS NULL OR dept NOT IN ({SUPPORT}) GROUP BY ALL""", ("visits",))(
    lambda x: x.filter(R.not_in_keep_null(F.col("dept"), v.SUPPORT_DEPTS)).groupBy("dept").agg(F.count(F.lit(1)).alias("n"))
)

query("include_depts", f"SELECT dept, count(*) AS n FROM visits WHERE dept IN ({SALES}) GROUP BY ALL", ("visits",))(
    lambda x: x.filter(F.col("dept").isin(*v.SALES_DEPTS)).groupBy("dept").agg(F.count(F.lit(1)).alias("n"))
)

query("not_equal_keep_null", "SELECT dept, employee_name FROM target_matrix WHERE dept IS DISTINCT FROM 'Chỉ tiêu 2026'",
      ("target_matrix",))(
    lambda m: m.filter(R.not_equal_keep_null(F.col("dept"), v.COMPANY_TARGET_ROW)).select("dept", "employee_name")
)

query("upsert_latest", """, stacked AS (
 SELECT user_id, event_type, ts, value, event_id FROM events WHERE event_type <> 'purchase'
 UNION ALL SELECT user_id, 'purchase', ts, value + 1, event_id FROM events WHERE event_type = 'purchase'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM stacked)
SELECT user_id, event_type, event_id, value FROM ranked WHERE rn = 1""", ("events",))(
    lambda e: upsert(
        e.filter("event_type <> 'purchase'").select("user_id", "event_type", "ts", "value", "event_id"),
        e.filter("event_type = 'purchase'").select("user_id", "event_type", "ts", (F.col("value") + 1).alias("value"), "event_id"),
        ["user_id"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")
)

query("mask_md5", "SELECT c_custkey, md5(c_name) AS c_name, md5(CAST(c_nationkey AS VARCHAR)) AS nation FROM customer", ("customer",))(
    lambda c: _masked(c)
)


def _masked(customer: DataFrame) -> DataFrame:
    from branchledger.plans.marts import masked

    named = customer.select("c_custkey", "c_name", F.col("c_nationkey").alias("nation"))
    return masked(named, ["c_name", "nation"])


query("money_totals_exact", """SELECT l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS gross
FROM lineitem GROUP BY ALL""", ("lineitem",))(
    lambda li: li.groupBy("l_returnflag").agg(F.sum(cents("l_extendedprice")).alias("gross"))
)
