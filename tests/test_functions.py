from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from branchledger import values as v
from branchledger.functions import parsing as P, rules as R, text as T
from branchledger.plans.ledger import customer_type, dept_by_name
from branchledger.plans.marts import noise_factor


def test_norm_code(values):
    assert values(T.norm_code, [" ab 01", "AB01", None, ""]) == ["AB01", "AB01", None, ""]


def test_strip_suffixes_in_order(values):
    names = ["Lan TN", "Lan Bb", "Lan.", "Lan .", "Lan -T", " Lan ", "Lan TN Bb", "Lan Bb TN", "a.TN", None, "", "TN"]

    def expected(name):
        if name is None:
            return None
        name = name.strip()
        for s in v.NAME_SUFFIXES:
            name = name.removesuffix(s).strip()
        return name

    assert values(lambda c: T.strip_suffixes(c, v.NAME_SUFFIXES), names) == [expected(n) for n in names]


@pytest.mark.parametrize("blank", [" ", "\t", " ", "\n"])
def test_strip_blanks(values, blank):
    assert values(T.strip, [f"{blank}Lan{blank}"]) == ["Lan"]


def test_title_letters_equals_python_title(values):
    names = ["văn-anh o'neil ĐỖ x.tn", "NGUYỄN", "a1b c", "", None, "  hai  ba", "x-y-z", "đ", "9a", "ß"]
    assert values(T.title_letters, names)[:-1] == [n and n.title() if n is not None else None for n in names][:-1]


def test_title_words_keeps_digits_inside_words(values):
    assert values(T.title_words, ["a1b x.tn -t", "24h chăm"]) == ["A1b X.Tn -T", "24h Chăm"]


def test_sentence_case(values):
    assert values(T.sentence_case, ["nhân VIÊN", "A", "", None]) == ["Nhân viên", "A", "", None]


def test_drop_name_tags(values):
    names = ["Lan Tn", "Lan Bb", "Lan.", "Lan .", "Lan-T", "Lan Tn Hoa", "Lan"]
    clean = values(lambda c: T.drop_name_tags(c, v.DIM_NAME_TAIL, v.DIM_NAME_ANYWHERE), names)
    assert clean == ["Lan", "Lan", "Lan", "Lan", "Lan", "Lan Hoa", "Lan"]


def test_unit_int(values):
    assert values(lambda c: T.unit_int(c, v.PRICE_UNITS), ["1.200.000VND", "x", None]) == [1200000, None, None]
    assert values(lambda c: T.unit_int(c, v.VOLUME_UNITS), ["500ml", "200g", "1.100g", "hộp"]) == [500, 200, 1100, None]


def test_swap_prefix_is_anchored(values):
    assert values(lambda c: T.swap_prefix(c, "84", "0"), ["84984", "0984", None]) == ["0984", "0984", None]


def test_split_pair(values):
    items = ["08:00:00 - 08:30:00", "09:00:00", "10:00:00 - ", None]
    assert values(lambda c: T.split_pair(c, " - ")[0], items) == ["08:00:00", "09:00:00", "10:00:00", None]
    assert values(lambda c: T.split_pair(c, " - ")[1], items) == ["08:30:00", None, "", None]


def test_join_or_blank(frame, rows):
    df = frame("a string, b string", ("x", "y"), (None, "y"), ("x", None), (None, None))
    got = rows(df.select(T.join_or_blank(F.col("a"), F.col("b"), " - ")))
    assert got == [(" - ",), (" - y",), ("x - ",), ("x - y",)]


def test_deaccent(values):
    assert values(T.deaccent, ["Đăk Lăk Nguyễn", None]) == ["Dak Lak Nguyen", None]
    assert T.plain_text("Mã Khách hàng/Tiềm năng") == "Ma Khach hang/Tiem nang"


def test_lenient_long(values):
    items = ["1.9", "-1.9", "x", "1,000", None, "", "1d", "nan", "1e3", " 7 "]
    assert values(P.lenient_long, items) == [1, -1, 0, 0, 0, 0, 0, 0, 1000, 7]


def test_strict_parse_fails_on_bad_text(values):
    assert values(P.strict_date, ["31/12/2025", None]) == [dt.date(2025, 12, 31), None]
    with pytest.raises(Exception, match="CANNOT_PARSE|cannot|could not"):
        values(P.strict_date, ["2025-12-31"])
    with pytest.raises(Exception):
        values(lambda c: c.cast("double"), ["1,5"])


def test_strict_stamp(values):
    assert values(P.strict_stamp, ["17:05:09 01/02/2026"]) == [dt.datetime(2026, 2, 1, 17, 5, 9)]


def test_mixed_date(values):
    items = ["2024-02-29 00:00:00", "29/02/2024", "31/02/2024", "2024-02-31", "không rõ", None]
    day = dt.date(2024, 2, 29)
    assert values(P.mixed_date, items) == [day, day, None, None, None, None]
    assert values(P.iso_date, items) == [day, None, None, None, None, None]


def test_month_label_key(values):
    items = ["Tháng 1", "Tháng 3, 2025", "Tháng 12", "Tổng", "Ghi chú", "Tháng, x", None]
    assert values(lambda c: P.month_label_key(c, 2026), items) == [
        "2026-01", "2025-03", "2026-12", "Tổng", None, None, None,
    ]


def test_in_month(values):
    items = [dt.datetime(2026, 3, 1), dt.datetime(2026, 3, 31, 23, 59), dt.datetime(2026, 4, 1), None]
    assert values(lambda c: P.in_month(c, 2026, 3), items, "timestamp_ntz") == [True, True, False, None]
    assert values(lambda c: P.in_month(c, 2026, 12), [dt.datetime(2027, 1, 1)], "timestamp_ntz") == [False]


def test_null_keeping_filters(values):
    assert values(lambda c: R.not_in_keep_null(c, ["a"]), ["a", "b", None]) == [False, True, True]
    assert values(lambda c: R.not_equal_keep_null(c, "a"), ["a", "b", None]) == [False, True, True]


def test_cap_and_ratio(values, frame, rows):
    assert values(lambda c: R.cap(c, 60.0), [90.0, 5.0, -60.0, None], "double") == [60.0, 5.0, -60.0, None]
    df = frame("n double, d double", (4.0, 2.0), (4.0, 0.0), (4.0, None), (None, 2.0))
    assert rows(df.select(R.guarded_ratio(F.col("n"), F.col("d")))) == [(0.0,), (2.0,), (None,), (None,)]


def test_recode_is_exact(values):
    names = ["KD3", "Phòng KD3", None, "Khác"]
    once = values(lambda c: R.recode(c, v.DIM_DEPT_NAMES), names)
    assert once == ["Phòng KD3", "Phòng KD3", None, "Khác"]
    assert values(lambda c: R.recode(c, v.DIM_DEPT_NAMES), once) == once


def test_customer_type(values):
    codes = ["X_DL_1", "X_BS_1", "aXDLYb", "abc", None, "X_DL_BS_"]
    assert values(lambda c: customer_type(c, v.HEAD_OFFICE_DISTRIBUTORS), codes) == [
        "Đại lý", "Beauty Salon", "Khác", "Nhà phân phối", "Khác", "Đại lý",
    ]
    like = values(lambda c: R.first_match(c, v.CUSTOMER_TYPES_LIKE, None), codes)
    assert like == ["Đại lý", "Beauty Salon", "Đại lý", None, None, "Đại lý"]


def test_dept_by_name(values):
    names = ["Nguyễn Văn A", "Nguyễn Văn A TN", "Lan TN", "Lan.", "Lan Bb", "Nguyễn Thị Q 2", "Tạ ABC", "Lan-T",
             "CAO THI TN", "Trần Văn B", "Lan", None]
    assert values(dept_by_name, names) == [
        "VP Hải Dương", "Phòng Marketing", "VP Thái Nguyên", "Beauty HN", "Bán Buôn HN", "Phòng KD3", "Nội Bộ",
        "Phòng KDT", "VP Thái Nguyên", "VP Hải Dương", "Khác", "Khác",
    ]


def test_survivor(frame, rows):
    df = frame("a string, b string", ("", "y"), (None, "y"), ("x", "y"))
    assert rows(df.select(R.survivor([F.col("a"), F.col("b")], blank_first=True))) == [("x",), ("y",), ("y",)]
    assert rows(df.select(R.survivor([F.col("a"), F.col("b")]))) == [("",), ("x",), ("y",)]


def test_noise_factor_is_fixed_per_key_and_bounded(values):
    got = values(lambda c: noise_factor(c, 0.1, "s"), ["a", "b", "a"])
    assert got[0] == got[2] != got[1]
    assert all(0.9 <= x < 1.1 for x in got)
