"""Stored pages → records.  Input is a table with ``url`` and ``html``.

The records of a board are read off the nodes in the pass that parses the pages (or from ``nodes``, if the pages
come parsed): a reader per board picks elements and texts, Spark columns make the fields of them.  Everything else
adds one array column per page.  Nothing is shuffled.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobmart import rules
from jobmart.functions import dates, dom, items
from jobmart.functions.location import split_city_address
from jobmart.functions.text import bind

# Send the Python functions of this module to executors by value: they need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def with_nodes(pages: DataFrame, html: str = "html", keep: Sequence[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default) plus ``nodes``, NULL for a bad page, and ``page_error``."""
    kept = list(keep) if keep is not None else pages.columns
    schema = T.StructType([
        *[pages.schema[c] for c in kept],
        T.StructField("nodes", T.ArrayType(dom.NODE)),
        T.StructField("page_error", T.StringType()),
    ])
    return pages.select(*dict.fromkeys([*kept, html])).mapInArrow(dom.page_parser(html, kept), schema)


def quarantined(parsed: DataFrame) -> DataFrame:
    """Pages that could not be parsed, with the reason."""
    return parsed.filter(F.col("page_error").isNotNull()).drop("nodes")


def titled(records: DataFrame, title: str = "title") -> DataFrame:
    """Records that have a title."""
    return records.filter(F.col(title).isNotNull() & (F.col(title) != ""))


def _records(pages: DataFrame, read: Callable[[dom.Page], list[tuple]], fields: dict[str, str], keep: Sequence[str] = ("url",)) -> DataFrame:
    """``keep`` and the texts of the rows that ``read`` finds in each good page, parsed already or not."""
    source = "nodes" if "nodes" in pages.columns else "html"
    schema = T.StructType([
        *[pages.schema[c] for c in keep], *[T.StructField(name, T.DataType.fromDDL(kind)) for name, kind in fields.items()]])
    reader = dom.record_reader(read, fields, list(keep), None if source == "nodes" else source)
    return pages.select(*dict.fromkeys([*keep, source])).mapInArrow(reader, schema)


def page_outline(parsed: DataFrame, *keep: str) -> DataFrame:
    """Title, first heading, navigation texts, and paragraph count of any page."""
    n = F.col("nodes")
    return parsed.filter(F.col("page_error").isNull()).select(
        *keep,
        dom.text_of(n, dom.find(n, "title")).alias("page_title"),
        dom.text_of(n, dom.find(n, "h1")).alias("heading"),
        F.array_join(dom.texts_of(n, bind_nodes(n, "a", "nav")), "|").alias("nav_items"),
        F.size(dom.find_all(n, "p")).alias("n_paragraphs"),
    )


def bind_nodes(nodes: Column, tag: str, container: str) -> Column:
    """Elements inside the first container."""
    return bind(dom.find(nodes, container), lambda box: dom.find_all(nodes, tag, inside=box))


def site_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^(https?://[^/]+)", 1)


def harvested_links(parsed: DataFrame, base: str | None = None) -> DataFrame:
    """(page url, link) rows of the anchors, repeats included; relative links get the page's own site."""
    anchors = F.transform(dom.find_all(F.col("nodes"), "a"), lambda n: n["link"])
    found = parsed.select("url", F.explode(anchors).alias("href"))
    site = F.lit(base) if base else site_of(F.col("url"))
    link = F.when(F.startswith("href", F.lit("/")), F.concat(site, F.col("href"))).otherwise(F.col("href"))
    return found.select("url", link.alias("link")).filter(F.startswith("link", F.lit("http")))


def page_links(parsed: DataFrame, base: str | None = None) -> DataFrame:
    """Distinct (page url, link) rows."""
    return harvested_links(parsed, base).distinct()


def job_links(parsed: DataFrame, tag: str, cls_like: str | None, base: str, cut: str | None = None) -> DataFrame:
    """Distinct job links of list pages, from anchors or card elements, by class pattern if given."""
    n = F.col("nodes")
    found = dom.links(n, dom.find_all(n, tag, cls_like=cls_like))
    link = items.absolute_url(F.col("href"), base, cut)
    return (
        parsed.select(F.explode(found).alias("href"))
        .select(link.alias("url"))
        .filter(F.startswith("url", F.lit("http")))
        .distinct()
    )


def _read_a(page: dom.Page) -> list[tuple]:
    header, place = page.first("div", "job-desc"), page.first("div", "info-place-detail")
    labels = [(at, page.text_of(at)) for at in page.within(page.first("div", "bg-blue"), "strong")]

    def facts(label: str) -> list[int]:
        """The paragraphs right after a label in the blue box."""
        after = [page.next_element(at, "p") for at, text in labels if label in text]
        return [at for at in after if at is not None]

    def fact(label: str) -> str | None:
        return page.text_of(dom.get(facts(label), 0))

    def anchors(label: str) -> list[str]:
        return [text for at in facts(label) for text in page.texts_of(page.within(at, "a"))]

    def section(label: str) -> str:
        mark = page.headed(label, "h2", "detail-title")
        return "\n".join(page.texts_of(page.next_siblings(mark, "p"), "\n"))

    def listed(label: str, heading: str, box: str, cls: str) -> list[str]:
        holder = dom.get(page.next_siblings(page.headed(label, heading, "detail-title"), box, cls), 0)
        return page.texts_of(page.within(holder, "li"))

    return [(
        page.text_of(page.first_within(header, "a", "job-company-name")), page.text_of(page.first_within(header, "h1", "title")),
        fact("Ngày cập nhật"), fact("Lương"), fact("Cấp bậc"), anchors("Ngành nghề"),
        listed("Phúc lợi", "h2", "ul", "welfare-list"), section("Mô tả Công việc"), section("Yêu Cầu Công Việc"),
        dom.get(anchors("Địa điểm"), 0), page.text_of(page.first_within(place, "span")),
        listed("Thông tin khác", "h3", "div", "content_fck"),
    )]


def board_a(pages: DataFrame) -> DataFrame:
    """Detail page with a header box, a blue fact box and headed sections."""
    found = _records(pages, _read_a, {
        "ten_cong_ty": "string", "tieu_de": "string", "ngay_dang_tuyen": "string", "luong": "string", "cap_bac": "string",
        "nganh_nghe": "array<string>", "phuc_loi": "array<string>", "mo_ta_cong_viec": "string", "yeu_cau_cong_viec": "string",
        "thanh_pho": "string", "dia_chi_day_du": "string", "khac": "array<string>",
    })
    return found.select(
        "url", "ten_cong_ty", "tieu_de", "ngay_dang_tuyen", "luong",
        F.lit(None).cast("string").alias("kinh_nghiem"),  # these pages do not state it
        "cap_bac", "nganh_nghe", "phuc_loi", "mo_ta_cong_viec", "yeu_cau_cong_viec",
        F.struct("thanh_pho", "dia_chi_day_du").alias("dia_diem_lam_viec"),
        items.key_value_map(F.col("khac")).alias("thong_tin_khac"))


def _read_b(page: dom.Page) -> list[tuple]:
    def value_after(label: str, kind: str) -> str | None:
        mark = page.headed(label, "div", f"{kind}-title")
        return page.text_of(dom.get(page.next_siblings(mark, "div", f"{kind}-value"), 0))

    boxes = [(at, page.text_of(page.first_within(at, "h3")) or "") for at in page.all("div", "job-description__item")]

    def content(label: str) -> int | None:
        box = next((at for at, text in boxes if label in text), None)
        return page.first_within(box, "div", "job-description__item--content")

    return [(
        page.text_of(page.first("h1", "job-detail__title")), value_after("Mức lương", "job-detail__info--section-content"),
        value_after("Kinh nghiệm", "job-detail__info--section-content"), value_after("Cấp bậc", "box-general-group-info"),
        page.texts_of(page.within(content("Quyền lợi"), "p")), page.text_of(content("Mô tả công việc"), "\n") or "",
        page.text_of(content("Yêu cầu ứng viên"), "\n") or "",
        page.text_of(page.first_within(content("Địa điểm làm việc"), "div")), page.text_of(content("Thời gian làm việc")),
    )]


def board_b(pages: DataFrame) -> DataFrame:
    """Detail page with titled description items and label/value boxes."""
    found = _records(pages, _read_b, {
        "tieu_de": "string", "luong": "string", "kinh_nghiem": "string", "cap_bac": "string", "quyen_loi": "array<string>",
        "mo_ta_cong_viec": "string", "yeu_cau_cong_viec": "string", "dia_diem": "string", "gio": "string",
    })
    city_address = bind(F.col("dia_diem"), split_city_address)
    return found.select(
        "url", "tieu_de", "luong", "kinh_nghiem", "cap_bac", items.clean_items(F.col("quyen_loi")).alias("phuc_loi"),
        "mo_ta_cong_viec", "yeu_cau_cong_viec",
        bind(city_address, lambda c: F.struct(c["city"].alias("thanh_pho"), c["address"].alias("dia_chi_day_du"))).alias("dia_diem_lam_viec"),
        F.when(F.col("gio").isNotNull(), F.create_map(F.lit("thoi_gian_lam_viec"), "gio"))
        .otherwise(F.create_map().cast("map<string,string>")).alias("thong_tin_khac"))


# Class patterns of board C's list cards and detail boxes.
CARD = r"job-item|search_list|view_job_item|job-card"
CARD_COMPANY = r"company|sc-cdaca"
EMPLOYER_LINK = "/nha-tuyen-dung/"
CARD_FIELDS = {
    "luong": [("span", r"salary|sc-fgSWkL|gKHoAZ"), ("div", r"salary")],
    "dia_diem": [("span", r"location|sc-kzkBiZ|hAkUGp"), ("div", r"location")],
    "ngay_dang": [("div", r"date|time|sc-fnLEGM|fVEuMk"), ("span", r"date|time")],
}
CARD_SKILLS = [("label", r"skill|tag|sc-cgjDci|brZjJh"), ("span", r"skill|tag")]
DETAIL_DESCRIPTION = r"sc-1671001a-1"
DETAIL_SECTION = r"sc-1671001a-4"
DETAIL_BODY = r"sc-1671001a-6"
DETAIL_BENEFITS = r"sc-c683181c-0"
DETAIL_BENEFIT = r"sc-c683181c-1"
DETAIL_BENEFIT_TEXT = r"sc-c683181c-2"
DETAIL_INFOS = r"sc-7bf5461f-0"
DETAIL_INFO = r"sc-7bf5461f-1"
DETAIL_PLACES = r"sc-a137b890-0"
DETAIL_PLACE = r"sc-a137b890-1"
PARAGRAPH_TITLE = r"sc-ab270149-0[^\n\r]*jlpjAq"
PARAGRAPH_LABEL = r"sc-ab270149-0[^\n\r]*dfyRSX"
PARAGRAPH_VALUE = r"sc-ab270149-0[^\n\r]*cLLblL"


def _read_c_list(page: dom.Page) -> list[tuple]:
    """Cards are told by class or, on a page without such, by ``data-job-id``."""
    cards = page.all("div", like=CARD) or [at for at in page.all("div") if page.kind[at][4] is not None]

    def first_of(card: int, options: list[tuple[str, str]]) -> str | None:
        found = (page.text_of(page.first_within(card, tag, like=pattern)) for tag, pattern in options)
        return next((text for text in found if text is not None), None)

    rows = []
    for card in cards:
        heading = dom.get([*page.within(card, "h2")[:1], *page.within(card, "h3")[:1], *page.within(card, "a", like=r"job-title|title")[:1]], 0)
        anchor = heading if heading is not None and page.kind[heading][0] == "a" else page.first_within(heading, "a")
        firm = page.first_within(card, "div", like=CARD_COMPANY)
        if firm is not None:
            firm = dom.get([*page.within(firm, "a")[:1], firm], 0)
        else:
            firm = next((at for at in page.within(card, "a") if EMPLOYER_LINK in (page.kind[at][2] or "")), None)
        skills = next((found for tag, pattern in CARD_SKILLS if (found := page.within(card, tag, like=pattern))), [])
        rows.append((
            None if anchor is None else page.kind[anchor][2], page.text_of(anchor), page.text_of(firm),
            *(first_of(card, options) for options in CARD_FIELDS.values()), page.texts_of(skills)))
    return rows


def board_c_list(pages: DataFrame, base: str | None = None) -> DataFrame:
    """List page → one row per job card with a title; relative links get ``base`` or the page's own site.

    Pages without a trace of a card, such as detail pages in the same table, are not parsed for it.
    """
    if "nodes" not in pages.columns:
        # A class with an entity in it may be a card's whatever its letters.
        pages = pages.filter(F.col("html").rlike(rf"{CARD}|&|(?i:data-job-id)"))
    found = _records(pages, _read_c_list, {
        "href": "string", "tieu_de": "string", "cong_ty": "string", **dict.fromkeys(CARD_FIELDS, "string"), "ky_nang": "array<string>"})
    rows = found.select(
        items.absolute_url(F.col("href"), base if base else site_of(F.col("url"))).alias("url"),
        items.strip_new_marker(F.col("tieu_de")).alias("tieu_de"), "cong_ty", *CARD_FIELDS,
        items.clean_items(F.col("ky_nang")).alias("ky_nang"))
    return titled(rows, "tieu_de")


def _read_c_detail(page: dom.Page) -> list[tuple]:
    def boxed(box: str, pattern: str) -> list[int]:
        """Elements inside the first box of that kind."""
        return page.within(page.first("div", like=box), "div", like=pattern)

    def body(section: str, position: int) -> str:
        part = dom.get(page.all("div", like=section), position)
        return page.text_of(page.first_within(part, "div", like=DETAIL_BODY), "\n") or ""

    def field(box: int, pattern: str, tag: str) -> str | None:
        return page.text_of(page.first_within(box, tag, like=pattern))

    def pairs(boxes: list[int], names: tuple[str, str], first: tuple[str, str], second: tuple[str, str]) -> list[dict]:
        found = [dict(zip(names, (field(at, *first), field(at, *second)))) for at in boxes]
        return [p for p in found if None not in p.values()]

    return [(
        body(DETAIL_DESCRIPTION, 0), body(DETAIL_SECTION, 1),
        pairs(boxed(DETAIL_BENEFITS, DETAIL_BENEFIT), ("tieu_de", "mo_ta"), (PARAGRAPH_TITLE, "p"), (DETAIL_BENEFIT_TEXT, "div")),
        [text for at in boxed(DETAIL_PLACES, DETAIL_PLACE) if (text := field(at, PARAGRAPH_VALUE, "p"))],
        pairs(boxed(DETAIL_INFOS, DETAIL_INFO), ("label", "value"), (PARAGRAPH_LABEL, "label"), (PARAGRAPH_VALUE, "p")),
    )]


def board_c_detail(pages: DataFrame) -> DataFrame:
    """Detail page → the twelve detail fields."""
    found = _records(pages, _read_c_detail, {
        "mo_ta": "string", "yeu_cau": "string", "phuc_loi": "array<struct<tieu_de:string,mo_ta:string>>",
        "dia_diem_chi_tiet": "array<string>", "info": "array<struct<label:string,value:string>>"})
    labels, values = F.col("info.label"), F.col("info.value")
    order = [label for label, _ in rules.DETAIL_LABELS]
    facts = {
        name: items.label_value(labels, values, label, exclude=order[: order.index(label)])
        for label, name in rules.DETAIL_LABELS
    }
    text = lambda name: F.coalesce(facts[name], F.lit(""))
    return found.select(
        "url", "mo_ta", "yeu_cau", "phuc_loi", "dia_diem_chi_tiet",
        text("posted_raw").alias("ngay_dang_chi_tiet"),
        text("level_raw").alias("cap_bac"),
        text("industry").alias("nganh_nghe"),
        F.coalesce(items.split_items(facts["skills_raw"]), F.array().cast("array<string>")).alias("ky_nang_chi_tiet"),
        text("field").alias("linh_vuc"),
        text("language").alias("ngon_ngu"),
        text("experience").alias("kinh_nghiem"),
        text("nationality").alias("quoc_tich"))


def board_c(list_rows: DataFrame, detail_rows: DataFrame) -> DataFrame:
    """List rows with their details; a card without a stored detail page keeps its own fields."""
    return list_rows.join(detail_rows, "url", "left")


# Class attributes of board D's detail page.
TAG_ROW = "imb-4 imb-xl-3 d-flex flex-column flex-xl-row igap-3 align-items-xl-baseline"
DOMAIN_TAG = "itag bg-light-grey itag-sm cursor-default"
SECTION = "imy-5 paragraph"
DECLARATION = "imt-5 imt-xl-4"
EMPLOYER = r"\bjob-show-employer-info\b"
EMPLOYER_ROW = r"\brow ipy-2\b"


def _read_d(page: dom.Page) -> list[tuple]:
    info = page.first("div", "job-show-info")
    spans = page.texts_of(page.within(info, "span"))
    rows = page.within(info, "div", TAG_ROW)
    sections = page.all("div", SECTION)
    employer = page.first("section", like=EMPLOYER)

    def tags(position: int) -> list[str]:
        return page.texts_of(page.within(dom.get(rows, position), "a"))

    def section(position: int) -> str | None:
        return page.text_of(dom.get(sections, position), "\n")

    def details() -> list[dict]:
        """The first value of each key."""
        lines = [page.text_of(at, "\n").split("\n") for at in page.within(employer, "div", like=EMPLOYER_ROW)]
        pairs = [
            ("company_name", page.text_of(page.first_within(employer, "h3"))),
            ("declaration", page.text_of(page.first_within(employer, "div", DECLARATION))),
            *((line[0], dom.get(line, 1)) for line in lines)]
        firsts: dict[str, str] = {}
        for key, value in pairs:
            if value is not None:
                firsts.setdefault(key, value)
        return [{"key": key, "value": value} for key, value in firsts.items()]

    return [(
        page.text_of(page.first_within(page.first("div", "job-header-info"), "h1")), page.text_of(page.first("div", "employer-name")),
        page.text_of(page.first("div", "salary")), dom.get(spans, 0), dom.get(spans, -2), dom.get(spans, -1), tags(0), tags(1),
        page.texts_of(page.all("div", DOMAIN_TAG)), section(0), section(1), section(2), None if employer is None else details(),
    )]


def board_d(pages: DataFrame, html: str = "html") -> DataFrame:
    """Detail page with job facts, three sections and an employer box."""
    found = _records(pages, _read_d, {
        "job_title": "string", "company_name": "string", "salary": "string", "company_location": "string", "woring_model": "string",
        "posted": "string", "skills_list": "array<string>", "job_expertise": "array<string>", "job_domain": "array<string>",
        "job_description": "string", "your_skill_and_experience": "string", "benefit": "string",
        "details": "array<struct<key:string,value:string>>",
    }, keep=["url", html])
    return found.select(
        "url", "job_title", "company_name", "salary", "company_location", "woring_model",
        dates.relative_date(F.col(html), F.col("posted")).cast("string").alias("post_time"),
        "skills_list", "job_expertise", "job_domain", "job_description", "your_skill_and_experience", "benefit",
        F.map_from_entries("details").alias("company_detail"))
