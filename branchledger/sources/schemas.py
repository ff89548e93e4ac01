"""Report layouts: header text in column order, with the name the jobs use for it.

Everything is read as text; the jobs parse. Fixed values: the headers.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql.types import DoubleType, StringType, StructField, StructType


class Layout(NamedTuple):
    """``header_row`` counts from 0; ``footer`` marks a trailing total row."""

    columns: dict[str, str]  # job name -> report header
    header_row: int = 0
    footer: bool = False
    skip_first: int = 0
    numbers: tuple[str, ...] = ()

    @property
    def text_schema(self) -> StructType:
        return StructType([StructField(c, StringType()) for c in self.columns])

    @property
    def schema(self) -> StructType:
        return StructType(
            [
                StructField(c, DoubleType() if c in self.numbers else StringType())
                for c in self.columns
            ]
        )


SALES = Layout(
    {
        "posting_date": "Ngày hạch toán",
        "voucher_no": "Số chứng từ",
        "product_group_code": "Mã nhóm VTHH",
        "product_group_name": "Tên nhóm VTHH",
        "general_note": "Diễn giải chung",
        "note": "Diễn giải",
        "customer_code": "Mã khách hàng",
        "customer_name": "Tên khách hàng",
        "product_code": "Mã hàng",
        "product_name": "Tên hàng",
        "unit": "ĐVT",
        "qty_sold": "Số lượng bán",
        "unit_price": "Đơn giá",
        "gross_sales": "Doanh số bán",
        "discount": "Chiết khấu",
        "qty_returned": "Số lượng trả lại",
        "return_value": "Giá trị trả lại",
        "allowance": "Giá trị giảm giá",
        "vat": "Thuế GTGT",
        "total_payment": "Tổng tiền thanh toán",
        "salesperson": "NV bán hàng",
    },
    header_row=2,
    footer=True,
)
# Columns the ledger adds to a sales report.
LEDGER_HEADERS = SALES.columns | {
    "employee_code": "Mã nhân viên",
    "dept": "Phòng ban",
    "closing_month": "Tháng chốt công nợ",
    "closing_year": "Năm chốt công nợ",
    "period": "Kỳ công nợ",
    "customer_type": "Loại khách hàng",
    "net_revenue": "Doanh thu ròng",
    "net_qty": "Thực xuất",
}
ACCOUNTING_STAFF = Layout(
    {
        "employee_code": "Mã nhân viên",
        "employee_name": "Tên nhân viên",
        "gender": "Giới tính",
        "born_on": "Ngày sinh",
        "title": "Chức danh",
        "unit_code": "Mã đơn vị",
        "unit_name": "Tên đơn vị",
    },
    header_row=1,
    footer=True,
)
ACCOUNTING_CUSTOMERS = Layout(
    {
        "customer_code": "Mã khách hàng",
        "customer_name": "Tên khách hàng",
        "address": "Địa chỉ",
        "owner_code": "Nhân viên",
        "owner": "Tên nhân viên",
        "created_on": "Ngày tạo",
    },
    header_row=1,
    footer=True,
)
ACCOUNTING_PRODUCTS = Layout(
    {
        "product_code": "Mã",
        "product_name": "Tên",
        "unit": "ĐVT chính",
        "discontinued": "Ngừng theo dõi",
    },
    header_row=1,
    footer=True,
)
VISITS = Layout(
    {
        "dept": "Phòng ban",
        "employee_code": "Mã nhân viên",
        "employee_name": "Nhân viên ghé thăm",
        "customer_code": "Mã Khách hàng/Tiềm năng",
        "visit_time": "Thời điểm ghé thăm",
    },
    header_row=2,
)
VISIT_SUMMARY = Layout(
    {
        "employee_name": "Tên nhân viên",
        "employee_code": "Mã nhân viên",
        "dept": "Phòng ban",
        "customers": "Tổng KH ghé thăm",
        "customer_visits": "Tổng số lần ghé thăm KH",
        "prospects": "Tổng TN ghé thăm",
        "prospect_visits": "Tổng số lần ghé thăm TN",
        "kilometers": "Tổng km di chuyển",
    },
    header_row=2,
    skip_first=1,
    numbers=("customers", "customer_visits", "prospects", "prospect_visits", "kilometers"),
)
_ACCOUNT_TAIL = {
    "address": "Địa chỉ",
    "province": "Tỉnh/Thành",
    "phone": "Số điện thoại",
    "customer_kind": "Loại KH",
}
FIELD_CUSTOMERS = Layout(
    {
        "account_code": "Mã khách hàng",
        "account_name": "Tên khách hàng",
        "owner": "Người phụ trách",
        "status": "Trạng thái thông tin",
        "opened_at": "Ngày chuyển đổi",
        "dept": "Phòng ban",
    }
    | _ACCOUNT_TAIL
)
FIELD_PROSPECTS = Layout(
    {
        "account_code": "Mã tiềm năng",
        "account_name": "Tên tiềm năng",
        "owner": "Người phụ trách",
        "status": "Trạng thái",
        "opened_at": "Ngày tạo",
        "dept": "Phòng ban",
    }
    | _ACCOUNT_TAIL
)


def shared(layout: Layout) -> Layout:
    """The shared-pool variant of an account layout: no owner column."""
    return layout._replace(columns={k: v for k, v in layout.columns.items() if k != "owner"})


FIELD_STAFF = Layout(
    {
        "employee_code": "Mã nhân viên",
        "employee_name": "Tên nhân viên",
        "login": "Tài khoản đăng nhập",
        "phone": "Số điện thoại",
        "born_on": "Ngày tháng năm sinh",
        "gender": "Giới tính",
        "dept": "Phòng ban",
        "title": "Chức danh",
    }
)
FIELD_PRODUCTS = Layout(
    {
        "product_code": "Mã nội bộ",
        "product_name": "Tên sản phẩm",
        "brand": "Thương hiệu",
        "category": "Danh mục",
        "list_price": "Giá niêm yết",
        "volume": "Dung tích - Khối lượng",
    }
)
HR_STAFF = Layout(
    {
        "employee_code": "Mã nhân viên",
        "employee_name": "Họ và tên",
        "work_status": "Tình trạng",
        "dept": "Phòng ban",
        "branch": "Chi nhánh",
        "specialty": "Chuyên môn phụ trách",
        "gender": "Giới tính",
        "born_on": "Ngày sinh",
        "hired_on": "Ngày vào làm (m/d/y)",
        "left_on": "Ngày nghỉ",
        # Two trailing helper columns that the job drops by position.
        "helper_1": "Phụ 1",
        "helper_2": "Phụ 2",
    }
)
HAND_CUSTOMERS = Layout(
    {
        "customer_code": "Mã khách hàng",
        "customer_name": "Tên khách hàng",
        "owner": "Người phụ trách",
        "dept": "Phòng ban",
        "address": "Địa chỉ",
        "customer_kind": "Loại KH",
        "converted_on": "Ngày chuyển đổi",
    }
)
HAND_PRODUCTS = Layout(
    {
        "product_code": "Mã sản phẩm",
        "product_name": "Tên sản phẩm",
        "status": "Trạng thái",
        "unit": "Đơn vị tính",
        "brand": "Thương hiệu",
        "group_2": "Nhóm cấp 2",
        "product_group_name": "Tên nhóm VTHH",
    }
)
ORDERS = Layout(
    {
        "order_code": "Mã đơn hàng",
        "account_name": "Khách hàng/Tiềm năng",
        "account_code": "Mã khách hàng/Tiềm năng",
        "waybill": "Vận đơn",
        "n_products": "Số lượng sản phẩm",
        "amount": "Tổng tiền",
        "discount": "Chiết khấu",
        "paid": "Tiền thanh toán",
        "created_by": "Người tạo",
        "status": "Trạng thái",
        "created_at": "Ngày tạo",
    },
    numbers=("n_products", "amount", "discount", "paid"),
)
INBOUND = Layout(
    {
        "slip_code": "Mã phiếu",
        "slip_type": "Loại phiếu nhập",
        "created_by": "Người tạo",
        "created_at": "Thời gian tạo",
        "status": "Trạng thái",
    }
)
OUTBOUND = INBOUND._replace(columns=INBOUND.columns | {"slip_type": "Loại phiếu xuất"})
LADING = Layout(
    {
        "waybill": "Mã vận đơn",
        "carrier": "Vận chuyển",
        "status": "Trạng thái",
        "created_at": "Ngày tạo",
    }
)
STOCK_HISTORY = Layout(
    {
        "ref_code": "Phiếu/Đơn hàng",
        "warehouse": "Tên kho hàng",
        "partner": "Đối tượng liên quan",
        "occurred_at": "Thời gian phát sinh",
        "product_code": "Mã sản phẩm",
        "product_name": "Tên sản phẩm",
        "movement": "Hình thức",
        "volume": "Dung tích - Khối lượng",
        "qty": "Số lượng",
    },
    numbers=("qty",),
)
