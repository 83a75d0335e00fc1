"""Schemas of the raw sources, the stream messages and the canonical advert."""

from __future__ import annotations

from pyspark.sql import types as T

_S = T.StringType()
_A = T.ArrayType(_S)


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, _S) for n in names]


# Board A: detail page record.  The extras are an open key/value object, hence a map.
BOARD_A = T.StructType(
    [
        *_strings("url", "ten_cong_ty", "tieu_de", "ngay_dang_tuyen", "luong", "kinh_nghiem", "cap_bac"),
        T.StructField("nganh_nghe", _A),
        T.StructField("phuc_loi", _A),
        *_strings("mo_ta_cong_viec", "yeu_cau_cong_viec"),
        T.StructField("dia_diem_lam_viec", T.StructType(_strings("thanh_pho", "dia_chi_day_du"))),
        T.StructField("thong_tin_khac", T.MapType(_S, _S)),
        *_strings("timestamp", "cach_thuc_lam_viec"),
    ]
)
# Board B has neither company nor posting date.
BOARD_B = T.StructType([f for f in BOARD_A if f.name not in ("ten_cong_ty", "ngay_dang_tuyen")])

# Board C: list and detail page record.
BOARD_C = T.StructType(
    [
        *_strings("url", "tieu_de", "luong", "cong_ty", "dia_diem", "ngay_dang"),
        T.StructField("ky_nang", _A),
        *_strings("trang_thai", "mo_ta", "yeu_cau"),
        T.StructField("phuc_loi", T.ArrayType(T.StructType(_strings("tieu_de", "mo_ta")))),
        T.StructField("dia_diem_chi_tiet", _A),
        *_strings("ngay_dang_chi_tiet", "cap_bac", "nganh_nghe"),
        T.StructField("ky_nang_chi_tiet", _A),
        *_strings("linh_vuc", "ngon_ngu", "kinh_nghiem", "quoc_tich"),
    ]
)

# Board D: record with company details; the misspelt name is the one on the wire.
BOARD_D = T.StructType(
    [
        *_strings("job_title", "company_name", "salary", "company_location", "woring_model",
                  "post_time", "job_description", "your_skill_and_experience", "benefit"),
        T.StructField("skills_list", _A),
        T.StructField("job_expertise", _A),
        T.StructField("job_domain", _A),
        T.StructField("company_detail", T.MapType(_S, _S)),
        *_strings("source", "crawled_at", "url"),
    ]
)

BOARDS = {"a": BOARD_A, "b": BOARD_B, "c": BOARD_C, "d": BOARD_D}

# Stream messages.  The second one accepts both spellings that collectors send.
STREAM_MESSAGE = T.StructType(
    _strings("url", "job_title", "company_name", "salary", "company_location", "job_description",
             "job_requirements", "post_time", "source", "crawled_at")
)
STREAM_MESSAGE_SKILLS = T.StructType(
    [
        *_strings("job_title", "company_name", "salary", "company_location", "working_model",
                  "woring_model", "post_date", "post_time"),
        T.StructField("skills_list", _A),
        *_strings("crawled_at", "source", "url"),
    ]
)

# Company details: key on the page -> column.
COMPANY_FIELDS = {
    "company_name": "company",
    "declaration": "declaration",
    "Company type": "company_type",
    "Company industry": "company_industry",
    "Company size": "company_size",
    "Country": "country",
    "Working days": "working_days",
    "Overtime policy": "overtime_policy",
}

ROLE = T.StructType(
    [
        T.StructField("job_title", _S),
        T.StructField("skills", _A),
        T.StructField("certificates", _A),
    ]
)
RESUME = T.StructType(
    [
        T.StructField("resume_id", T.LongType()),
        T.StructField("name", _S),
        T.StructField("skills", _A),
    ]
)

# The canonical advert every board is brought to.
CANONICAL = T.StructType(
    [
        *_strings("url", "source", "title", "company", "location_raw", "city", "salary_raw"),
        T.StructField("salary_min", T.LongType()),
        T.StructField("salary_max", T.LongType()),
        *_strings("level", "work_mode", "working_hours"),
        T.StructField("skills", _A),
        T.StructField("benefits", _A),
        *_strings("description", "requirements", "posted_raw"),
        T.StructField("posted_date", T.DateType()),
    ]
)

# Display names for reports, only used at the edge.
DISPLAY_NAMES = {
    "company": "Tên công ty",
    "location_raw": "Địa chỉ",
    "city": "Thành phố",
    "title": "Vị trí công việc",
    "level": "Cấp bậc",
    "salary_raw": "Lương (VND)",
    "working_hours": "Thời gian làm việc",
    "work_mode": "Cách thức làm việc",
    "skills": "Danh sách kỹ năng yêu cầu",
    "posted_date": "Ngày đăng tuyển",
    "description": "Mô tả công việc",
    "benefits": "Phúc lợi",
    "url": "Đường dẫn",
}
