from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from branchledger.session import shared_folder
from branchledger.sinks.files import export_files, read_ledger, write_ledger_month
from branchledger.sinks.parts import PartedTable, part_of, upsert_parts
from branchledger.sinks.tables import build_table, stage_table, staged
from branchledger.sources import schemas
from branchledger.sources.naming import capitalize_columns, report_headers, stage_columns, staged_name
from branchledger.sources.reports import (
    drop_last_columns, missing_offices, read_folder, read_labelled, read_offices, read_report, read_sheet, read_year,
)
from branchledger.sources.schemas import Layout
from branchledger.sources.tables import StagingSpec, read_spec, read_table

REPORT = Layout({"code": "Mã", "name": "Tên"}, header_row=2, footer=True)
SHEET = Layout({"code": "Mã", "name": "Tên"})


def report_text(rows, titles=2, footer=True):
    lines = [f"Báo cáo {i}," for i in range(titles)] + ["Mã,Tên"] + [f'{c},"{n}"' for c, n in rows]
    return "\n".join(lines + (["Tổng cộng,"] if footer else [])) + "\n"


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_report_drops_titles_header_and_footer(spark, tmp_path, rows):
    write(tmp_path / "a b.csv", report_text([("1", "x, y"), ("2", 'q ""z""')]))
    write(tmp_path / "c.csv", report_text([("3", " w ")]))
    write(tmp_path / "~$c.csv", report_text([("9", "temp")]))
    got = read_report(spark, str(tmp_path), REPORT, file_column="file")
    assert rows(got) == [("1", "x, y", "a b.csv"), ("2", 'q "z"', "a b.csv"), ("3", " w ", "c.csv")]


def test_report_without_rows(spark, tmp_path):
    write(tmp_path / "empty.csv", report_text([]))
    write(tmp_path / "header only.csv", report_text([], footer=False))
    assert read_report(spark, str(tmp_path), REPORT).count() == 0


def test_report_skips_first_data_row(spark, tmp_path, rows):
    layout = REPORT._replace(footer=False, skip_first=1)
    write(tmp_path / "a.csv", report_text([("sum", "-"), ("1", "x"), ("2", "y")], footer=False))
    assert rows(read_report(spark, str(tmp_path), layout)) == [("1", "x"), ("2", "y")]


def test_report_of_very_many_columns(spark, tmp_path, rows):
    """More columns than any fixed number, the wanted ones last; rows shorter and longer than the header."""
    names = [f"extra {i}" for i in range(150)] + list(REPORT.columns.values())
    cells = [str(i) for i in range(150)]
    lines = [",".join(names), ",".join([*cells, "1", '"x, ""y"""']), ",".join([*cells, "2"]), ",".join([*cells, "3", "z", "more", "cells"]), ",".join(['""', *cells[1:], " 4 ", ""])]
    write(tmp_path / "a.csv", "\ufefftitle\n\n" + "\r\n".join(lines) + "\n")
    assert rows(read_report(spark, str(tmp_path), REPORT._replace(footer=False))) == [(" 4 ", None), ("1", 'x, "y"'), ("2", None), ("3", "z")]


def test_report_edges_are_broadcast_and_rows_stay_where_they_are(spark, tmp_path):
    write(tmp_path / "a.csv", report_text([("1", "x")]))
    plan = read_report(spark, str(tmp_path), REPORT)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning") == 1  # of the edges


def test_report_with_line_breaks_in_cells(spark, tmp_path, rows):
    write(tmp_path / "a.csv", report_text([("1", "x\ny"), ("2", "z")]))
    assert rows(read_report(spark, str(tmp_path), REPORT, multiline=True)) == [("1", "x\ny"), ("2", "z")]


def test_large_report_is_read_in_splits(spark, tmp_path):
    data = [(str(i), f"name {i}") for i in range(20000)]
    write(tmp_path / "big.csv", report_text(data))
    write(tmp_path / "small.csv", report_text([("s", "t")]))
    settings = {"spark.sql.files.maxPartitionBytes": "32k", "spark.sql.files.openCostInBytes": "1k"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df = read_report(spark, str(tmp_path), REPORT)
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
        got = sorted(tuple(r) for r in df.collect())
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert got == sorted([*data, ("s", "t")])


def test_numbers_are_cast(spark, tmp_path):
    layout = Layout({"a": "A", "b": "B"}, numbers=("b",))
    write(tmp_path / "a.csv", "A,B\nx,1.5\ny,\n")
    assert sorted(tuple(r) for r in read_sheet(spark, str(tmp_path), layout).collect()) == [("x", 1.5), ("y", None)]


def test_offices(spark, tmp_path, rows):
    write(tmp_path / "can tho.csv", report_text([("1", "x")]))
    write(tmp_path / "vinh.csv", report_text([("2", "y")]))
    write(tmp_path / "other.csv", report_text([("3", "z")]))
    offices = {"VP Cần Thơ": "can tho.csv", "VP Vinh": "vinh.csv", "VP Nha Trang": "nha trang.csv"}
    got = read_offices(spark, str(tmp_path), REPORT, offices)
    assert rows(got) == [("1", "x", "VP Cần Thơ"), ("2", "y", "VP Vinh")]
    assert rows(missing_offices(spark, str(tmp_path), offices).select("office")) == [("VP Nha Trang",)]


def test_no_office_file_at_all(spark, tmp_path):
    write(tmp_path / "other.csv", report_text([("3", "z")]))
    assert read_offices(spark, str(tmp_path), REPORT, {"VP Vinh": "vinh.csv"}).count() == 0


def test_year_glob(spark, tmp_path, rows):
    for folder, name, code in [("T1_2026", "Tong_Hop_Sale.csv", "1"), ("T12_2026", "ABC_Tong_Hop.csv", "2"),
                               ("T1_2025", "Tong_Hop.csv", "3"), ("T2_2026", "~$Tong_Hop.csv", "4"), ("T2_2026", "Chi tiet.csv", "5")]:
        write(tmp_path / folder / name, f"Mã,Tên\n{code},x\n")
    assert rows(read_year(spark, str(tmp_path), 2026, SHEET)) == [("1", "x"), ("2", "x")]


def test_folder_and_column_list(spark, tmp_path, rows):
    write(tmp_path / "kho 1.csv", "Mã,Tên\n1,x\n")
    write(tmp_path / "~$kho 1.csv", "Mã,Tên\n2,x\n")
    assert rows(read_folder(spark, str(tmp_path), SHEET, ["code"])) == [("1", "kho 1.csv")]
    assert read_folder(spark, str(tmp_path), SHEET).columns == ["code", "name", "department"]


def test_labelled_feeds(spark, tmp_path, rows):
    write(tmp_path / "a.csv", "Mã,Tên\n1,x\n")
    got = read_labelled(spark, {"Khách hàng": (str(tmp_path / "a.csv"), SHEET)}, "feed")
    assert rows(got["Khách hàng"]) == [("1", "x", "Khách hàng")]


def test_columns_are_found_by_header(spark, tmp_path, rows):
    write(tmp_path / "a.csv", "Báo cáo\n\nTên,Khác,Mã\nx,?,1\ny,?,2\nTổng,,\n")
    write(tmp_path / "b.csv", report_text([("3", "z")]))
    assert rows(read_report(spark, str(tmp_path), REPORT)) == [("1", "x"), ("2", "y"), ("3", "z")]


def test_missing_header_and_bad_number_fail(spark, tmp_path):
    write(tmp_path / "a" / "a.csv", "Mã,Khác\n1,x\n")
    with pytest.raises(Exception, match="no row with the headers"):
        read_sheet(spark, str(tmp_path / "a"), SHEET).collect()
    write(tmp_path / "b" / "b.csv", "A\n1.200.000\n")
    with pytest.raises(Exception, match="no number"):
        read_sheet(spark, str(tmp_path / "b"), Layout({"a": "A"}, numbers=("a",))).collect()


def test_drop_last_columns(frame):
    assert drop_last_columns(frame("a int, b int, c int", (1, 2, 3)), 2).columns == ["a"]


def test_spec_driven_staging(spark, tmp_path):
    header = ",".join(schemas.LADING.columns.values())
    write(tmp_path / "lading" / "x.csv", f"{header}\nVD1,Xe,OK,08:30 31/12/2025\n")
    spec = StagingSpec("lading", "lading", schemas.LADING, "created_at", "HH:mm dd/MM/yyyy")
    row = read_spec(spark, str(tmp_path), spec).first()
    assert row.created_at == dt.datetime(2025, 12, 31, 8, 30)
    plain = read_spec(spark, str(tmp_path), spec._replace(stamp=None)).first()
    assert plain.created_at == "08:30 31/12/2025"


def test_names():
    assert staged_name("Tỉnh/Thành") == "tinh/thanh"
    assert staged_name("Dung tích - Khối lượng") == "dung_tich_-_khoi_luong"
    assert staged_name("Ngày vào làm (m/d/y)") == "ngay_vao_lam_(m/d/y)"


def test_column_names(frame):
    df = frame("`Mã Hàng` int, `ĐVT` int", (1, 2))
    assert stage_columns(df).columns == ["ma_hang", "dvt"]
    assert df.columns == ["Mã Hàng", "ĐVT"]
    assert capitalize_columns(df).columns == ["Mã hàng", "Đvt"]
    assert report_headers(frame("code int, z int", (1, 2)), SHEET.columns).columns == ["Mã", "z"]
    with pytest.raises(ValueError, match="collide"):
        stage_columns(frame("`Ma` int, `Mã` int", (1, 2)))


def test_stage_table(spark, frame, rows):
    df = frame("code string, name string", ("1", "x"))
    assert stage_table(df, "t_stage", headers=SHEET.columns)
    assert read_table(spark, "stg.t_stage").columns == ["ma", "ten"]
    assert not stage_table(df.limit(0), "t_none")
    assert not spark.catalog.tableExists("stg.t_none")
    stage_table(frame("code string", ("2",)), "t_stage")
    assert rows(spark.table("stg.t_stage")) == [("2",)]
    assert rows(staged(df.limit(0), "t_none")) == []
    assert rows(spark.table("stg.t_stage")) == [("2",)]
    assert stage_table(frame("code string", ("2",)).limit(0), "t_stage", keep_empty=True) == {"n_rows": 0}
    assert rows(spark.table("stg.t_stage")) == []


def test_staging_runs_a_frame_once_and_sees_its_totals(spark, frame):
    met = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            met.add(batch.num_rows)
            yield batch

    df = frame("`Mã` string, qty int", ("1", 2), ("2", 5)).mapInArrow(count, "`Mã` string, qty int")
    assert stage_table(df, "t_seen", totals={"qty": F.sum("qty")}) == {"n_rows": 2, "qty": 7}
    assert met.value == 2 and spark.table("stg.t_seen").columns == ["ma", "qty"]


def files_of(spark, table):
    parted = PartedTable(spark, table, part=part_of("d"))
    return {n: sorted(r[0] for r in spark.read.parquet(f).select(F.input_file_name()).distinct().collect()) for n, f in parted.folders().items()}


def test_upsert_rewrites_touched_months_only(spark, frame, rows):
    schema = "k string, t int, d date, x string"
    jan, feb, mar = (dt.date(2026, m, 5) for m in (1, 2, 3))

    def load(*data, log=False):
        upsert_parts(spark, "t_up", frame(schema, *data), ["k"], ["t"], part=part_of("d"), log=log)

    load(("a", 1, jan, "old"), ("b", 1, feb, "keep"), (None, 1, None, "loose"))
    assert rows(spark.table("stg.t_up")) == [("a", 1, jan, "old"), ("b", 1, feb, "keep"), (None, 1, None, "loose")]
    before, reader = files_of(spark, "t_up"), spark.table("stg.t_up")
    load(("a", 2, mar, "moved"))
    after = files_of(spark, "t_up")
    assert rows(spark.table("stg.t_up")) == [("a", 2, mar, "moved"), ("b", 1, feb, "keep"), (None, 1, None, "loose")]
    assert set(after) == {"2026-02", "2026-03", "none"} and after["2026-02"] == before["2026-02"] and after["none"] == before["none"]
    assert ("a", 1, jan, "old") in rows(reader)  # a reader that began before the switch
    for _ in range(2):  # the same drop again changes nothing
        load(("a", 1, jan, "older"), ("c", 1, feb, "add"))
        assert rows(spark.table("stg.t_up")) == [("a", 2, mar, "moved"), ("b", 1, feb, "keep"), ("c", 1, feb, "add"), (None, 1, None, "loose")]
    load(("c", 1, feb, "line 1"), ("c", 1, feb, "line 2"), log=True)
    assert [r[3] for r in rows(spark.table("stg.t_up")) if r[0] == "c"] == ["line 1", "line 2"]
    assert spark.sql("SHOW TBLPROPERTIES stg.t_up").where("key = 'parts_version'").first().value == "5"


def test_upsert_that_dies_before_the_switch_changes_nothing(spark, frame, rows, monkeypatch):
    schema = "k string, t int"
    upsert_parts(spark, "t_dies", frame(schema, ("a", 1)), ["k"], ["t"])
    with monkeypatch.context() as m:
        m.setattr(PartedTable, "switch", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            upsert_parts(spark, "t_dies", frame(schema, ("a", 2), ("b", 1)), ["k"], ["t"])
    assert rows(spark.table("stg.t_dies")) == [("a", 1)]
    upsert_parts(spark, "t_dies", frame(schema, ("a", 2), ("b", 1)), ["k"], ["t"])
    assert rows(spark.table("stg.t_dies")) == [("a", 2), ("b", 1)]


def test_upsert_of_a_plain_table_and_of_new_columns(spark, frame, rows):
    build_table(frame("k string, t int", ("a", 1)), "t_plain", "stg")
    upsert_parts(spark, "t_plain", frame("k string, t int", ("b", 1)), ["k"], ["t"])
    assert rows(spark.table("stg.t_plain")) == [("a", 1), ("b", 1)]
    upsert_parts(spark, "t_plain", frame("k string, t int, n int", ("b", 2, 7)), ["k"], ["t"])
    assert rows(spark.table("stg.t_plain").select("k", "t", "n")) == [("a", 1, None), ("b", 2, 7)]
    upsert_parts(spark, "t_none", frame("k string, t int").limit(0), ["k"], ["t"])
    assert rows(spark.table("stg.t_none")) == []


def test_exports(spark, frame, tmp_path, rows):
    path = export_files(frame("a string, b int", ("x", 1)), str(tmp_path), "_KPI")
    assert path.endswith("Data_KPI")
    assert rows(spark.read.option("header", True).csv(path)) == [("x", "1")]
    parquet = export_files(frame("a string", ("x",)), str(tmp_path), "_P", "parquet")
    assert rows(spark.read.parquet(parquet)) == [("x",)]


def test_ledger_month_replaces_only_its_partition(spark, frame, tmp_path):
    path = str(tmp_path / "ledger")
    schema = "posting_date date, n int"
    day = dt.date(2026, 1, 1)
    write_ledger_month(frame(schema, (day, 1)), path, 2026, 1)
    write_ledger_month(frame(schema, (day, 2)), path, 2026, 2)
    write_ledger_month(frame(schema, (day, 3), (None, 4)), path, 2026, 1)
    write_ledger_month(frame(schema, (day, 5)), path, 2025, 1)
    got = read_ledger(spark, path, 2026)
    assert sorted(r.n for r in got.collect()) == [2, 3, 4]
    write_ledger_month(frame(schema).limit(0), path, 2026, 1)
    assert sorted(r.n for r in read_ledger(spark, path).collect()) == [2, 5]
    assert "PartitionFilters: [isnotnull(run_year" in got._jdf.queryExecution().executedPlan().toString()


def test_shared_folder_is_the_session_setting(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
