"""Raw board records → canonical adverts → cleaned adverts.  No actions here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobmart import rules, schemas
from jobmart.functions import dates, items, level, location, salary, skills, text, workmode
from jobmart.functions.company import recover_company
from jobmart.operators import dedup, shape


def _canonical(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    return df.select(*[
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.CANONICAL
    ])


def _with_range(df: DataFrame, salary_text: Column) -> DataFrame:
    return df.withColumn("_range", salary.salary_range(salary_text))


def normalise_board_a(df: DataFrame, source: str = "board_a") -> DataFrame:
    """Board A (and B, whose records lack company and date)."""
    c = F.col
    has = set(df.columns)
    column = lambda name: c(name) if name in has else F.lit(None).cast("string")
    extra = lambda name: F.try_element_at(c("thong_tin_khac"), F.lit(name))
    pay = F.coalesce(extra("lương"), shape.placeholder_to_null(c("luong")))
    rows = _with_range(df, pay)
    place = location.collapse_city_aliases(c("dia_diem_lam_viec.thanh_pho"))
    posted = shape.placeholder_to_null(column("ngay_dang_tuyen"))
    return _canonical(rows, {
        "url": c("url"),
        "source": F.lit(source),
        "title": shape.placeholder_to_null(c("tieu_de")),
        "company": recover_company(column("ten_cong_ty"), c("mo_ta_cong_viec")),
        "location_raw": place,
        "city": location.province(place),
        "salary_raw": pay,
        "salary_min": c("_range.salary_min"),
        "salary_max": c("_range.salary_max"),
        "level": level.level(c("tieu_de")),
        "work_mode": F.lit(rules.WORK_MODE_OTHER),
        "working_hours": F.coalesce(
            extra("thời_gian_làm_việc"), extra("thoi_gian_lam_viec"), F.lit(rules.WORKING_HOURS_DEFAULT)
        ),
        "skills": skills.extract_skills(c("yeu_cau_cong_viec"), c("mo_ta_cong_viec")),
        "benefits": items.clean_items(c("phuc_loi")),
        "description": c("mo_ta_cong_viec"),
        "requirements": c("yeu_cau_cong_viec"),
        "posted_raw": posted,
        "posted_date": dates.parse_date(posted),
    })


def normalise_board_c(df: DataFrame, source: str = "board_c") -> DataFrame:
    c = F.col
    place = F.coalesce(
        shape.placeholder_to_null(c("dia_diem")), text.blank_to_null(F.array_join("dia_diem_chi_tiet", ", "))
    )
    posted = F.coalesce(text.blank_to_null(c("ngay_dang_chi_tiet")), shape.placeholder_to_null(c("ngay_dang")))
    return _canonical(_with_range(df, c("luong")), {
        "url": shape.placeholder_to_null(c("url")),
        "source": F.lit(source),
        "title": shape.placeholder_to_null(c("tieu_de")),
        "company": shape.placeholder_to_null(c("cong_ty")),
        "location_raw": place,
        "city": location.city_five(place),
        "salary_raw": c("luong"),
        "salary_min": c("_range.salary_min"),
        "salary_max": c("_range.salary_max"),
        "level": level.level_six(c("tieu_de")),
        "work_mode": workmode.work_mode(c("mo_ta"), place),
        "working_hours": F.lit(rules.WORKING_HOURS_DEFAULT),
        "skills": F.array_distinct(F.concat(
            items.clean_items(c("ky_nang")), items.clean_items(c("ky_nang_chi_tiet"))
        )),
        "benefits": items.benefit_titles(c("phuc_loi")),
        "description": c("mo_ta"),
        "requirements": c("yeu_cau"),
        "posted_raw": posted,
        "posted_date": dates.parse_date(posted),
    })


def normalise_board_d(df: DataFrame, source: str = "board_d") -> DataFrame:
    c = F.col
    return _canonical(_with_range(df, c("salary")), {
        "url": c("url"),
        "source": F.coalesce(c("source"), F.lit(source)),
        "title": c("job_title"),
        "company": c("company_name"),
        "location_raw": c("company_location"),
        "city": location.city_by_pattern(c("company_location")),
        "salary_raw": c("salary"),
        "salary_min": c("_range.salary_min"),
        "salary_max": c("_range.salary_max"),
        "level": level.level(c("job_title")),
        "work_mode": c("woring_model"),
        "working_hours": F.try_element_at("company_detail", F.lit("Working days")),
        "skills": items.clean_items(c("skills_list")),
        "benefits": items.clean_items(F.split("benefit", "\n")),
        "description": c("job_description"),
        "requirements": c("your_skill_and_experience"),
        "posted_raw": c("post_time"),
        "posted_date": dates.parse_date(c("post_time")),
    })


NORMALISERS = {
    "a": normalise_board_a,
    "b": normalise_board_a,
    "c": normalise_board_c,
    "d": normalise_board_d,
}


def composed(df: DataFrame) -> DataFrame:
    """Texts, and texts in structs, in Unicode NFC."""
    changed = {}
    for field in df.schema:
        if isinstance(field.dataType, T.StringType):
            changed[field.name] = text.nfc(F.col(f"`{field.name}`"))
        elif isinstance(field.dataType, T.StructType):
            for inner in field.dataType:
                if isinstance(inner.dataType, T.StringType):
                    whole = changed.get(field.name, F.col(f"`{field.name}`"))
                    changed[field.name] = whole.withField(inner.name, text.nfc(F.col(f"`{field.name}`")[inner.name]))
    return df.withColumns(changed)


def normalise(df: DataFrame, board: str, source: str | None = None) -> DataFrame:
    """Raw records of one board → canonical adverts.  All rules work on composed (NFC) text."""
    return NORMALISERS[board](composed(df), source or f"board_{board}")


def clean(df: DataFrame, deduplicate: bool = True) -> DataFrame:
    """Complete, classified, de-duplicated adverts.

    Rows without address, title or posting date go; salary may be missing.  Text keys are
    compared in NFC, so composed and decomposed spellings of a name are the same company.
    """
    rows = shape.require(df)
    rows = rows.withColumns({
        name: text.nfc(F.col(name)) for name in ("title", "company", "location_raw")
    })
    if deduplicate:
        rows = dedup.keep_latest(rows)
    return rows.withColumns({
        "city": location.province(F.col("location_raw")),
        "level": level.level(F.col("title")),
    })
