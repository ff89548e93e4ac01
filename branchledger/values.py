"""Business vocabulary that results must carry unchanged.

They are the defaults of the jobs' arguments; a company passes its own lists. Names of people and
codes of partners are those that the rules are stated with.
"""

from __future__ import annotations

from branchledger.functions.rules import Rule

# --- Fixed values: offices and the report file of each office ---------------------
HEAD_OFFICE = "Hà Nội"
OFFICE_FILES = {
    "Hà Nội": "ha noi.csv",
    "VP Cần Thơ": "can tho.csv",
    "VP Đà Nẵng": "da nang.csv",
    "VP Đăk Lăk": "dak lak.csv",
    "VP Đồng Nai": "dong nai.csv",
    "VP Hải Dương": "hai duong.csv",
    "VP Hải Phòng": "hai phong.csv",
    "VP Nam Định": "nam dinh.csv",
    "VP Nha Trang": "nha trang.csv",
    "VP Sài Gòn": "sai gon.csv",
    "VP Thanh Hóa": "thanh hoa.csv",
    "VP Vinh": "vinh.csv",
}

# --- Fixed values: departments -----------------------------------------------------
SALES_DEPTS = [
    "VP Sài Gòn", "VP Cần Thơ", "VP Vinh", "VP Hưng Yên", "Beauty HN", "VP Đắk Lắk",
    "VP Hải Phòng", "VP Đà Nẵng", "VP Nam Định", "VP Đồng Nai", "VP Hải Dương",
    "VP Nha Trang", "Bán buôn HN", "KD3", "VP Thanh Hóa", "Phòng KDT", "VP Thái Nguyên",
]
SUPPORT_DEPTS = [
    "Hỗ trợ vận hành", "Vận hành", "Giao nhận", "Digital", "Marketing", "Kế toán Hà Nội",
    "Kỹ thuật", "Hành chính nhân sự", "Ban Giám Đốc",
]
MERGED_OFFICES = {"VP Hưng Yên": "VP Hải Dương"}
DIM_DEPT_NAMES = {
    "Phòng Beauty HN": "Beauty HN",
    "Phòng Bán Buôn HN": "Bán Buôn HN",
    "Bán buôn HN": "Bán Buôn HN",
    "KD3": "Phòng KD3",
    "Vận hành": "Phòng vận hành",
    "VP Đắk Lắk": "VP Đăk Lăk",
}
TARGET_DEPT_NAMES = {
    "Phòng Bán Buôn HN": "Bán Buôn HN",
    "Phòng Beauty HN": "Beauty HN",
    "Phòng KD Tỉnh": "Phòng KDT",
}

# --- Fixed values: salesperson name -> department (head office) --------------------
DEPT_BY_NAME = [
    Rule("contains", "Nguyễn Văn A", "Phòng Marketing"),
    Rule("endswith", " TN", "VP Thái Nguyên"),
    Rule("endswith", ".", "Beauty HN"),
    Rule("endswith", " Bb", "Bán Buôn HN"),
    Rule("contains", "Nguyễn Thị Q", "Phòng KD3"),
    Rule("contains", " ABC", "Nội Bộ"),
    Rule("endswith", "-T", "Phòng KDT"),
]
# Exact names are tested before the patterns above.
DEPT_BY_EXACT_NAME = [
    Rule("isin", ["NGUYEN VĂN TN", "CAO THI TN"], "VP Thái Nguyên"),
    Rule("isin", ["Nguyễn Văn A", "Trần Văn B", "Trần Toàn M"], "VP Hải Dương"),
]
OTHER_DEPT = "Khác"
NAME_SUFFIXES = [" TN", " Bb", ".", "-T", " ."]
NAME_RECODE = {"Tạ Thị ABC": "Tạ Thị ABC (tk new)"}
#: The same endings where a dimension cuts them off a name.
DIM_NAME_TAIL = "(" + "|".join(suffix.replace(".", r"\.") for suffix in NAME_SUFFIXES) + ")$"
DIM_NAME_ANYWHERE = " Tn"

# --- Fixed values: customer types --------------------------------------------------
CUSTOMER_TYPES = [
    Rule("contains", "_DL_", "Đại lý"),
    Rule("contains", "_BS_", "Beauty Salon"),
]
# The warehouse report matches with LIKE, where an underscore is a wildcard.
CUSTOMER_TYPES_LIKE = [
    Rule("like", "%_DL_%", "Đại lý"),
    Rule("like", "%_BS_%", "Beauty Salon"),
]
OTHER_CUSTOMER = "Khác"
DISTRIBUTOR = "Nhà phân phối"
HEAD_OFFICE_DISTRIBUTORS = ["abc", "xyz", "mna", "sad"]
PROVINCE_DISTRIBUTORS = [
    "HN_DL_MYPHAMHONGNHUNG", "HN_DL_THANGMUNG", "HN_DL_MYPHAMTUANTHAO",
    "HN_DL_KDT_DL_DAILYQUYNHANH", "HN_DL_NGOCMAI", "HN_DL_TUANLAI",
    "HN_DL_THUYHOANG", "HN_DL_TUANTUYET",
]
FIELD_KIND_RENAMES = [("Salon", "Beauty Salon")]
FILE_KIND_RENAMES = [("BS", "Beauty Salon"), ("ĐL", "Đại lý")]

# --- Fixed values: account states, shared pool, labels -----------------------------
PENDING, APPROVED, REJECTED = "Chờ duyệt", "Đã duyệt", "Từ chối"
SHARED_POOL = "Kho Chung"
SHARED_POOL_LABELS = {
    "Beauty HN": "Kho chung BS",
    "Bán buôn HN": "Kho chung BB",
    "Phòng KDT": "Kho chung KDT",
    "VP Cần Thơ": "Kho chung CT",
    "VP Hải Dương": "Kho chung HD",
    "VP Hải Phòng": "Kho chung HP",
    "VP Nam Định": "Kho chung ND",
    "VP Nha Trang": "Kho chung NT",
    "VP Sài Gòn": "Kho chung SG",
    "VP Thanh Hóa": "Kho chung TH",
    "VP Thái Nguyên": "Kho chung TN",
    "VP Vinh": "Kho chung V",
    "VP Đà Nẵng": "Kho chung DNG",
    "VP Đắk Lắk": "Kho chung DL",
    "VP Đồng Nai": "Kho chung DNI",
}
TOTAL_LABELS = ("TOTAL", "")
CONVERTED, CREATED = "Ngày chuyển đổi", "Ngày tạo"
FEED_LABELS = {
    "customers": "Khách hàng",
    "prospects": "Tiềm năng",
    "shared_customers": "Khách hàng chung",
    "shared_prospects": "Tiềm năng chung",
}
SAMPLE_PARTNER, SAMPLE_GOODS, SOLD_GOODS = "%Mượn Hàng Mẫu%", "Hàng mẫu", "Hàng bán"
COMPANY_TARGET_ROW = "Chỉ tiêu 2026"

# --- Fixed values: units stripped from prices and volumes ---------------------------
PRICE_UNITS = ["VND", "."]
VOLUME_UNITS = ["ml", "g", "."]
