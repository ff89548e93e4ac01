"""The three batch jobs end to end on a handful of report files."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from branchledger import values as v
from branchledger.operators.periods import Closing
from branchledger.plans import jobs, ledger
from branchledger.plans.field_sales import visit_kpis, visit_rows
from branchledger.sources import schemas


def drop(folder, name, layout, rows):
    """Write one report in its export layout; rows are dicts by job column name."""
    folder.mkdir(parents=True, exist_ok=True)
    lines = ["Báo cáo" + "," * (len(layout.columns) - 1)] * layout.header_row + [",".join(layout.columns.values())]
    if layout.skip_first:
        lines += ["," * (len(layout.columns) - 1) + "0"] * layout.skip_first
    lines += [",".join(str(r.get(c, "")) for c in layout.columns) for r in rows]
    if layout.footer:
        lines.append("Tổng" + "," * (len(layout.columns) - 1))
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def sale(day, who, total=110, vat=10, **more):
    return {"posting_date": day, "salesperson": who, "total_payment": total, "vat": vat, "unit_price": 1, "gross_sales": 1,
            "discount": 0, "return_value": 0, "qty_sold": "3.7", "qty_returned": "x", **more}


HEAD_CALENDAR = {"Bán Buôn HN": [Closing(dt.date(2026, 1, 3), dt.date(2026, 2, 3), "2026-01")]}
OFFICE_CALENDAR = {"VP Vinh": [Closing(dt.date(2026, 1, 5), None, "2026-01")]}
OFFICES = {"VP Vinh": "vinh.csv", "VP Nha Trang": "nha trang.csv", "VP Cần Thơ": "can tho.csv"}


@pytest.fixture(scope="module")
def month(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("month")
    staff = base / "staff"
    drop(staff, "ha noi.csv", schemas.ACCOUNTING_STAFF,
         [{"employee_code": "HN1", "employee_name": "Lan Bb"}, {"employee_code": "HN0", "employee_name": "Lan Bb"}])
    drop(staff, "vinh.csv", schemas.ACCOUNTING_STAFF, [{"employee_code": "V1", "employee_name": "văn-anh"}])
    reports = base / "T1_2026"
    drop(reports, "Ha Noi.csv", schemas.SALES, [
        sale("04/01/2026", "Lan Bb", customer_code="X_DL_1"),
        sale("03/01/2026", "Lan Bb", customer_code="abc"),
        sale("15/06/2026", "Hoa"),
    ])
    drop(reports, "vinh.csv", schemas.SALES, [sale("06/01/2026", "văn-anh"), sale("05/01/2026", "Khác")])
    drop(reports, "can tho.csv", schemas.SALES, [sale("06/01/2026", "Minh")])
    drop(reports, "stranger.csv", schemas.SALES, [sale("06/01/2026", "Ai")])
    return base


def run_month(spark, base, exclude=()):
    return jobs.month_job(spark, str(base / "T1_2026"), str(base / "staff"), str(base / "ledger"), 2026, 1,
                          "Ha Noi.csv", HEAD_CALENDAR, OFFICES, OFFICE_CALENDAR, exclude)


def test_month_job(spark, month):
    totals = run_month(spark, month).first()
    # Rows closing in 2026; the others close in 2025-12 or have no period.
    assert (totals.n_rows, totals.n_columns, float(totals.net_revenue)) == (3, 29, 300.0)
    rows = {(r.salesperson, str(r.posting_date)): r for r in spark.read.parquet(str(month / "ledger")).collect()}
    assert len(rows) == 6
    first = rows["Lan", "2026-01-04"]
    assert (first.dept, first.employee_code, first.period, first.customer_type) == ("Bán Buôn HN", "HN0", "2026-01", "Đại lý")
    assert (first.qty_sold, first.qty_returned, first.net_qty, first.net_revenue) == (3, 0, 3, 100.0)
    assert (rows["Lan", "2026-01-03"].period, rows["Lan", "2026-01-03"].customer_type) == ("2025-12", "Nhà phân phối")
    assert (rows["Hoa", "2026-06-15"].dept, rows["Hoa", "2026-06-15"].period) == ("Khác", "2026-06")
    vinh = rows["Văn-Anh", "2026-01-06"]
    assert (vinh.dept, vinh.employee_code, vinh.period) == ("VP Vinh", "V1", "2026-01")
    assert rows["Minh", "2026-01-06"].period is None


def test_month_job_can_be_rerun(spark, month):
    before = run_month(spark, month).first()
    assert run_month(spark, month).first() == before
    staged = spark.table("stg.sales_ledger2026")
    assert staged.count() == 3
    assert {"ngay_hach_toan", "ky_cong_no", "loai_khach_hang", "doanh_thu_rong", "thuc_xuat"} <= set(staged.columns)
    run_month(spark, month, exclude=["HN0"])
    codes = spark.read.parquet(str(month / "ledger")).filter("salesperson = 'Lan'").select("employee_code").distinct()
    assert [r[0] for r in codes.collect()] == ["HN1"]


def test_rows_that_close_in_a_neighbouring_year_reach_its_table(spark, month):
    run_month(spark, month)
    rows = {r.ky_cong_no for r in spark.table("stg.sales_ledger2025").collect()}
    assert rows == {"2025-12"}
    # A rerun that closes nothing in 2025 any more empties that table, and keeps the other.
    only = {"VP Vinh": OFFICE_CALENDAR["VP Vinh"]} | {d: [Closing(dt.date(2026, 1, 1), None, "2026-01")] for d in ("VP Vinh", "Bán Buôn HN")}
    jobs.month_job(spark, str(month / "T1_2026"), str(month / "staff"), str(month / "ledger"), 2026, 1, "Ha Noi.csv", only, OFFICES, only)
    assert spark.table("stg.sales_ledger2025").count() == 0
    assert spark.table("stg.sales_ledger2026").count() == 5


def test_missing_reports(spark, month):
    missing = jobs.missing_reports(spark, str(month / "T1_2026"), OFFICES).collect()
    assert [r.office for r in missing] == ["VP Nha Trang"]


def test_single_office(spark):
    sales = spark.createDataFrame([tuple("05/01/2026" if c == "posting_date" else "1" for c in schemas.SALES.columns)],
                                  schemas.SALES.text_schema)
    staff = spark.createDataFrame([("V1", "1", "VP Vinh")], "employee_code string, employee_name string, dept string")
    tagged, calendar = ledger.one_office(sales, "VP Vinh", OFFICE_CALENDAR["VP Vinh"])
    row = ledger.province_ledger(tagged, staff, calendar).first()
    assert (row.dept, row.period, row.employee_code) == ("VP Vinh", "2025-12", "V1")
    assert ledger.sorted_for_export(ledger.province_ledger(tagged, staff, calendar)).count() == 1


def test_ledgers_run_compiled_in_any_session(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    for own, want in ((None, "8000"), ("20000", "20000")):
        session = spark.newSession()
        session.conf.unset(key)
        if own:
            session.conf.set(key, own)
        sales = session.createDataFrame([], schemas.SALES.text_schema).withColumn("dept", F.lit("VP Vinh"))
        staff = session.createDataFrame([], "employee_code string, employee_name string, dept string")
        lines = ledger.head_office_ledger(sales, staff, HEAD_CALENDAR)
        assert lines.filter("period is not null").count() == 0
        assert session.conf.get(key) == want
        ledger.province_ledger(sales, staff, OFFICE_CALENDAR)
        assert session.conf.get(key) == want


def test_a_narrow_export_has_the_rows_of_the_whole_one_and_sorts_few_columns(spark):
    def line(**own):
        given = {"posting_date": "05/01/2026", "total_payment": "3", "vat": "1", "salesperson": "văn-anh"} | own
        return (*[given.get(c, "1") for c in schemas.SALES.columns], given.get("dept", "VP Vinh"))

    lines = [line(posting_date=None), line(voucher_no=None), line(voucher_no="0", salesperson=None), line(product_code="2"), line(product_code="2"),
             line(posting_date="04/01/2026", dept=None), line(salesperson="VĂN-ANH"), line(vat="2"), line(salesperson="Khác")]
    sales = spark.createDataFrame(lines, f"{schemas.SALES.text_schema.simpleString()[7:-1]}, dept:string")
    staff = spark.createDataFrame([("V2", "văn-anh", "VP Vinh"), ("V1", "văn-anh", "VP Vinh"), ("V3", "VĂN-ANH", "VP Vinh"), ("V4", None, None)],
                                  "employee_code string, employee_name string, dept string")
    columns = ["posting_date", "voucher_no", "product_code", "employee_code", "salesperson"]
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    for size in (before, "-1"):  # a lookup that is broadcast, one that is shuffled
        spark.conf.set(threshold, size)
        try:
            whole = ledger.province_ledger(sales, staff, OFFICE_CALENDAR)
            narrow = ledger.sorted_for_export(ledger.province_ledger(sales, staff, OFFICE_CALENDAR, columns=columns))
            got = [tuple(r) for r in narrow.select(columns).collect()]
            assert narrow.columns == columns
            assert sorted(got, key=repr) == sorted((tuple(r) for r in whole.select(columns).collect()), key=repr)
            assert [r[:2] for r in got] == sorted((r[:2] for r in got), key=lambda r: (r[0] is None, r[0] or dt.date.min, r[1] is not None, r[1] or ""))
            assert {r[3:] for r in got} == {("V1", "Văn-Anh"), ("V3", "Văn-Anh"), (None, "Văn-Anh"), (None, "Khác"), (None, None)}
            export = ledger.sorted_for_export(whole)
            assert export.columns == ledger.LEDGER_COLUMNS and [tuple(r) for r in export.select(columns).collect()] == got
            # What the sort deals out for a few of the columns is these and its tie-break.
            for df in (narrow, export):
                plan = df.select(columns[:3])._jdf.queryExecution().executedPlan().toString()
                read = next(x for x in plan.splitlines() if "FileScan" in x)
                assert "Join" not in plan and "product_name" not in read and "net_revenue" not in read
        finally:
            spark.conf.set(threshold, before)


def visit(dept, code, customer, time):
    return {"dept": dept, "employee_code": code, "employee_name": f"n{code}", "customer_code": customer, "visit_time": time}


VISITS = [
    visit("VP Hưng Yên", "1", "K1", "08:00:00 - 08:30:00"), visit("VP Hưng Yên", "1", "K1", "08:00:00 - 10:00:00"),
    visit("VP Hải Dương", "1", "K2", "09:00:00"), visit("VP Hải Dương", "1", "K3", "10:00:00 - "),
    visit("VP Hải Dương", "1", "", "10:00:00 - 09:00:00"), visit("VP Hải Dương", "1", "K4", "sáng - chiều"),
    visit("VP Hải Dương", "1", "K4", ""), visit("Digital", "2", "K5", "08:00:00 - 08:30:00"),
    visit("", "3", "K6", "08:00:00 - 08:30:00"), visit("VP Vinh", "4", "", ""),
]


def test_visit_rules(spark):
    df = spark.createDataFrame([tuple(x[c] or None for c in schemas.VISITS.columns) for x in VISITS], schemas.VISITS.schema)
    rows = visit_rows(df)
    # The support department is gone, the row without a department stays.
    assert rows.count() == 9
    kpis = {r.employee_code: r for r in visit_kpis(rows).collect()}
    one = kpis["1"]
    assert (one.dept, one.complete, one.incomplete, one.distinct_customers, one.visits) == ("VP Hải Dương", 4, 2, 4, 6)
    assert (one.minutes, one.avg_minutes) == (30.0, 5.0)
    four = kpis["4"]
    assert (four.visits, four.minutes, four.avg_minutes) == (0, 0.0, None)
    assert set(kpis) == {"1", "4"}


def account(code, owner, status, day, dept="VP Vinh"):
    return {"account_code": code, "owner": owner, "status": status, "opened_at": f"08:00:00 {day}", "dept": dept,
            "customer_kind": "Salon"}


@pytest.fixture(scope="module")
def field_folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("field")
    drop(base / "visits", "a.csv", schemas.VISITS, VISITS)
    drop(base / "visit_summary", "a.csv", schemas.VISIT_SUMMARY,
         [{"employee_name": "n1", "employee_code": "1", "dept": "VP Vinh", "customers": 0, "customer_visits": 3,
           "prospects": 2, "prospect_visits": 3, "kilometers": 12.5}])
    drop(base / "customers", "a.csv", schemas.FIELD_CUSTOMERS,
         [account("K1", "Lan", v.APPROVED, "05/03/2026"), account("K2", "Lan", v.PENDING, "05/03/2026"),
          account("K3", "Lan", v.APPROVED, "05/04/2026"), account("K4", "Lan", v.APPROVED, "05/03/2026", "Digital")])
    drop(base / "prospects", "a.csv", schemas.FIELD_PROSPECTS, [account("T1", "Hoa", v.REJECTED, "31/03/2026")])
    drop(base / "shared_customers", "a.csv", schemas.shared(schemas.FIELD_CUSTOMERS),
         [account("K9", "", v.APPROVED, "05/03/2026"), account("K8", "", v.APPROVED, "05/03/2026", "KD3")])
    drop(base / "shared_prospects", "a.csv", schemas.shared(schemas.FIELD_PROSPECTS), [account("T9", "", v.PENDING, "05/03/2026")])
    drop(base / "staff", "a.csv", schemas.FIELD_STAFF,
         [{"employee_code": "E1", "employee_name": "Lan", "dept": "VP Vinh"}, {"employee_code": "E2", "employee_name": "Lan", "dept": "KD3"}])
    return base


def test_field_sales_job(spark, field_folder, tmp_path):
    paths = jobs.field_sales_job(spark, str(field_folder), str(field_folder / "staff"), str(tmp_path), 2026, 3)
    assert len(paths) == 13

    def read(name):
        return {tuple(r) for r in spark.read.option("header", True).csv(f"{tmp_path}/Data{name}").collect()}

    assert read("__KH_accepted") == {("VP Vinh", "E1", "Lan", "1"), ("TOTAL", None, None, "1")}
    assert read("__KH_cancelling") == {("TOTAL", None, None, "0")}
    assert read("__TN_cancelling") == {("VP Vinh", None, "Hoa", "1"), ("TOTAL", None, None, "1")}
    assert read("__ALL_KH") == {("VP Vinh", "E1", "Lan", "3"), ("VP Vinh", None, "Kho chung V", "1"),
                                ("KD3", None, "Kho Chung", "1"), ("TOTAL", None, None, "5")}
    assert ("TOTAL", None, None, "7") in read("__ALL_KH_TN")
    assert ("VP Vinh", None, "Kho chung V", "2") in read("__ALL_KH_TN")
    assert read("_AVG_KH_TN") == {("n1", "1", "VP Vinh", "0.0", "1.5")}
    assert spark.table("stg.visit_detail").count() == 9


def test_dimension_and_inventory_jobs(spark, field_folder, tmp_path):
    acc, fld, hand = tmp_path / "acc", tmp_path / "fld", tmp_path / "hand"
    drop(acc / "employees", "vinh.csv", schemas.ACCOUNTING_STAFF, [{"employee_code": "e 1", "employee_name": "lan TN", "title": "KẾ toán"}])
    drop(acc / "customers", "vinh.csv", schemas.ACCOUNTING_CUSTOMERS, [{"customer_code": "k 1", "customer_name": "KT", "owner": "lan TN"}])
    drop(acc / "products", "vinh.csv", schemas.ACCOUNTING_PRODUCTS, [{"product_code": "P1", "product_name": "Kem", "unit": "Hộp"}])
    drop(fld / "employees", "a.csv", schemas.FIELD_STAFF, [{"employee_code": "E1", "employee_name": "lan TN", "dept": "KD3", "login": "84984"}])
    drop(fld / "products", "a.csv", schemas.FIELD_PRODUCTS, [{"product_code": "p 1", "product_name": "Kem F", "list_price": "1.200VND", "volume": "50ml"}])
    for feed in ("customers", "prospects", "shared_customers", "shared_prospects"):
        source = field_folder / feed / "a.csv"
        target = fld / "customers" / feed
        target.mkdir(parents=True)
        (target / "a.csv").write_text(source.read_text(encoding="utf-8"), encoding="utf-8")
    drop(hand / "employees", "a.csv", schemas.HR_STAFF, [{"employee_code": "E2", "employee_name": "hoa", "work_status": "đã nghỉ",
                                                          "hired_on": "2020-01-02", "left_on": "2024-05-06", "dept": "VP  Vinh"}])
    drop(hand / "customers", "a.csv", schemas.HAND_CUSTOMERS, [{"customer_code": "K1", "customer_kind": "BS"}])
    drop(hand / "products", "a.csv", schemas.HAND_PRODUCTS, [{"product_code": "P2", "product_name": "Tay"}])
    (hand / "targets" / "company").mkdir(parents=True)
    (hand / "targets" / "company" / "a.csv").write_text(
        'Phòng ban,Tháng 1,"Tháng 3, 2025",Tổng\nPhòng KD Tỉnh,5,,9\nChỉ tiêu 2026,1,1,1\n', encoding="utf-8")
    (hand / "targets" / "teams").mkdir()
    (hand / "targets" / "teams" / "a.csv").write_text("Phòng ban,Tên nhân viên,Tháng 2\nX,Lan,7\n", encoding="utf-8")
    for _ in range(2):  # a rerun replaces every table
        jobs.dimension_job(spark, str(acc), str(fld), str(hand), offices={"VP Vinh": "vinh.csv"}, target_year=2026)

    people = {r.employee_code: r for r in spark.table("int.employees").collect()}
    assert (people["E1"].employee_name, people["E1"].dept, people["E1"].title, people["E1"].login, people["E1"].platforms) == (
        "Lan", "Phòng KD3", "Kế toán", "0984", "ACCOUNTING, FIELD")
    assert (people["E2"].work_status, str(people["E2"].left_on), people["E2"].dept) == ("Đã Nghỉ", "2024-05-06", "VP Vinh")
    customers = {r.customer_code: r for r in spark.table("int.customers").collect()}
    assert set(customers) == {"K1", "K2", "K3", "K4", "K8", "K9", "T1", "T9"}
    assert (customers["K1"].customer_kind, customers["K1"].employee_code, customers["K1"].platforms) == (
        "Beauty Salon", "E1", "ACCOUNTING, FIELD, FILE")
    products = {r.product_code: r for r in spark.table("int.products").collect()}
    assert (products["P1"].product_name, products["P1"].list_price, products["P1"].volume, products["P1"].unit) == ("Kem F", 1200, 50, "Hộp")
    company = {(r.month_label, r.target, r.period) for r in spark.table("stg.company_targets_2026").collect()}
    assert company == {("Tháng 1", 5.0, "2026-01"), ("Tháng 3, 2025", None, "2025-03"), ("Tổng", 9.0, "Tổng")}
    assert spark.table("stg.employee_targets_2026").first().period == "2026-02"

    wh = tmp_path / "wh"
    drop(wh / "orders", "a.csv", schemas.ORDERS, [
        {"order_code": "dh 1", "account_code": "K1", "waybill": "V1", "paid": 9, "created_at": "08:00 01/01/2026"},
        {"order_code": "DH2", "account_code": "K_DL_1", "created_at": "08:00 01/01/2026"}])
    drop(wh / "inbound", "a.csv", schemas.INBOUND, [{"slip_code": "PN1", "slip_type": "Nhập", "created_at": "08:00:00 01/01/2026"}])
    drop(wh / "outbound", "a.csv", schemas.OUTBOUND, [{"slip_code": "DH1", "slip_type": "Xuất", "created_at": "08:00:00 01/01/2026"}])
    drop(wh / "lading", "a.csv", schemas.LADING, [{"waybill": "V1", "carrier": "Xe", "created_at": "08:00 01/01/2026"}])
    drop(wh / "stock_history", "a.csv", schemas.STOCK_HISTORY, [
        {"ref_code": "DH1", "product_code": "p1", "warehouse": "Kho", "occurred_at": "08:00 01/01/2026", "qty": 2},
        {"ref_code": "PN1", "product_code": "P9", "partner": "Mượn Hàng Mẫu", "occurred_at": "08:00 01/01/2026", "qty": 1}])
    for _ in range(2):  # the second drop updates and adds nothing
        jobs.warehouse_job(spark, str(wh))
    assert spark.table("stg.orders").count() == 2
    jobs.inventory_job(spark)
    detail = {r.doc_code: r for r in spark.table("int.inventory_detail").collect()}
    assert set(detail) == {"DH1", "DH2", "PN1"}
    one, two, slip = detail["DH1"], detail["DH2"], detail["PN1"]
    assert (one.list_price, one.slip_type, one.carrier, one.dept, one.movement_origin, one.platforms) == (
        1200, "Xuất", "Xe", "VP Vinh", "Kho - ", "FILE_INVENTORY, FILE_ORDER")
    assert (two.customer_type, two.platforms, two.movement_origin) == ("Đại lý", "FILE_ORDER", " - ")
    assert (slip.slip_type, slip.goods_class, slip.platforms) == ("Nhập", "Hàng mẫu", "FILE_INVENTORY")
