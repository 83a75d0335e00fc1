import random

import pytest

from jobmart.functions import dom
from jobmart.operators import pages
from jobmart.operators.layout import spread
from jobmart.plans import adverts
from tests import page_samples as samples


@pytest.fixture
def parsed(spark):
    def parse(*html):
        rows = [(f"https://x/{i}", h) for i, h in enumerate(html)]
        return pages.with_nodes(spark.createDataFrame(rows, "url string, html string"))

    return parse


def test_board_a(parsed):
    row = pages.board_a(parsed(samples.BOARD_A)).first().asDict(recursive=True)
    assert row == {
        "url": "https://x/0", "ten_cong_ty": "ACME", "tieu_de": "DevSenior", "ngay_dang_tuyen": "03/11/2025",
        "luong": "15 Tr - 20 Tr VND", "kinh_nghiem": None, "cap_bac": None, "nganh_nghe": ["IT", "Web"], "phuc_loi": ["Thưởng", "BH"],
        "mo_ta_cong_viec": "Dòng 1\nDòng 2\nPython & SQL", "yeu_cau_cong_viec": "",
        "dia_diem_lam_viec": {"thanh_pho": "Hà Nội", "dia_chi_day_du": "Số 1"},
        "thong_tin_khac": {"lương": "15 Tr - 20 Tr VND", "thời_gian_làm_việc": "T2-T6"},
    }


def test_board_a_page_to_canonical_advert(parsed):
    row = adverts.normalise(pages.board_a(parsed(samples.BOARD_A)), "a").first()
    assert (row["company"], row["city"], row["salary_min"], row["salary_max"]) == ("ACME", "Hà Nội", 15_000_000, 20_000_000)
    assert (row["level"], row["skills"], row["working_hours"], str(row["posted_date"])) == (
        "Senior", ["Python", "SQL"], "T2-T6", "2025-11-03",
    )


def test_board_b(parsed):
    row = pages.board_b(parsed(samples.BOARD_B)).first().asDict(recursive=True)
    assert (row["tieu_de"], row["luong"], row["cap_bac"], row["kinh_nghiem"]) == ("T", "10 - 20 triệu", "NV", None)
    assert row["phuc_loi"] == ["x", "y"]
    assert row["mo_ta_cong_viec"] == "a\nb"
    assert row["dia_diem_lam_viec"] == {"thanh_pho": "Hà Nội", "dia_chi_day_du": "Số 9"}
    assert row["thong_tin_khac"] == {"thoi_gian_lam_viec": "T2"}
    advert = adverts.normalise(pages.board_b(parsed(samples.BOARD_B)), "b").first()
    assert (advert["title"], advert["salary_max"], advert["company"], advert["posted_date"]) == (
        "T", 20_000_000, "Chưa xác định", None,
    )


def test_board_c(parsed):
    listed = pages.board_c_list(parsed(samples.BOARD_C_LIST), "https://x")
    assert [r["tieu_de"] for r in listed.collect()] == ["Dev Java"]  # the card without a title is left out
    detail = pages.board_c_detail(parsed(samples.BOARD_C_DETAIL)).replace("https://x/0", "https://x/viec-1", "url")
    row = pages.board_c(listed, detail).first().asDict(recursive=True)
    assert (row["url"], row["cong_ty"], row["luong"], row["ky_nang"]) == ("https://x/viec-1", "CoA", "$1,000", ["Java", "SQL"])
    assert (row["mo_ta"], row["yeu_cau"]) == ("mota", "yeucau\n2")
    assert row["phuc_loi"] == [{"tieu_de": "Thưởng", "mo_ta": "T13"}]
    assert (row["ngay_dang_chi_tiet"], row["ky_nang_chi_tiet"], row["dia_diem_chi_tiet"]) == ("03/11/2025", ["Java", "SQL"], ["Q1"])
    advert = adverts.normalise(pages.board_c(listed, detail), "c").first()
    assert (advert["salary_min"], advert["benefits"], str(advert["posted_date"])) == (25_000_000, ["Thưởng"], "2025-11-03")


def test_board_d(parsed):
    row = pages.board_d(parsed(samples.BOARD_D)).first().asDict(recursive=True)
    assert (row["job_title"], row["company_name"], row["company_location"]) == ("DE", "E", "Ha Noi")
    assert (row["woring_model"], row["post_time"]) == ("Hybrid", "2025-11-02")
    assert (row["skills_list"], row["job_expertise"], row["job_domain"]) == (["Python", "Spark"], ["Data"], [])
    assert (row["job_description"], row["your_skill_and_experience"], row["benefit"]) == ("desc\nb", "req", "ben")
    assert row["company_detail"] == {"company_name": "E JSC", "declaration": "decl", "Company size": "10-50", "Country": "VN"}


def test_pages_of_other_shapes_give_empty_records(parsed):
    odd = parsed("", "<p>unclosed", "</div></p>", "<div class='job-desc'>", "plain")
    assert pages.board_a(odd).count() == 5
    assert pages.titled(pages.board_a(odd), "tieu_de").count() == 0
    for extract in (pages.board_b, pages.board_c_detail, pages.board_d):
        assert extract(odd).count() == 5


def test_bad_pages_are_set_aside(parsed):
    both = parsed(None, "<h1>x</h1>")
    assert [r["page_error"] for r in pages.quarantined(both).collect()] == ["no page"]
    assert pages.board_a(both).count() == 1


def test_job_links(parsed):
    html = "<h3 class='x title-y'><a href='/j/1'>a</a></h3><div class='job-card' data-search--job-selection-job-url-value='/j/2/content?x'></div>"
    cards = pages.job_links(parsed(html), "div", "job-card", "https://x", "/content")
    assert [r["url"] for r in cards.collect()] == ["https://x/j/2"]


def test_many_pages_per_batch(spark):
    """Pages keep their own nodes across the slices in which a batch is parsed."""
    df = spark.range(300).selectExpr("id AS url", "concat('<h1>t', id, '</h1>') AS html").coalesce(1)
    got = pages.page_outline(pages.with_nodes(df, keep=["url"]), "url").collect()
    assert {r["url"]: r["heading"] for r in got} == {i: f"t{i}" for i in range(300)}


def test_plain_pages_have_the_nodes_of_the_standard_parser():
    """Whatever is read the short way has the same nodes; the boards' pages are, and their tags are analysed once."""
    bits = [
        "<p>", "</p>", "<div class=\"a b\">", "</div>", "<br>", "<br/>", "<p />", "a & b", "&amp;", "x > y", "<", "<!-- c -->", "<!-->", "<!---->",
        "<!-- a -- b -->", "<!DOCTYPE html>", "<script>", "</script>", "<title>", "</title>", "<a href='/x?a=1&amp;b=2'>", "</a >", "</A>",
        "<a href=\"/y\" data-url=\"u\" class=x>", "<A HREF=\"/Q\" href=\"r\">", "<a href=\"x\"class=\"y\">", "<p class=\"a>b\">", "<a href=\"\">", "<?pi?>", "</>", "t\n",
    ]
    nodes = lambda p: (p.last, p.parent, p.kind, p.text)
    parser, picks, plain = dom.Parser(), random.Random(1), 0
    for _ in range(5000):
        html = "".join(picks.choices(bits, k=picks.randint(1, 7)))
        page = parser._plain(html)
        plain += page is not None
        assert page is None or nodes(page) == nodes(dom._Nodes(dom.Page()).parse(html)), html
    assert plain > 500
    for html in (samples.BOARD_A, samples.BOARD_B, samples.BOARD_C_LIST, samples.BOARD_C_DETAIL, samples.BOARD_D):
        parser = dom.Parser()
        assert nodes(parser._plain(html)) == nodes(dom._Nodes(dom.Page()).parse(html))
        before = len(parser.tags)
        parser._plain(html)
        assert len(parser.tags) == before


def test_records_of_pages_with_and_without_nodes(spark):
    """The pages of a table give the same records whether they come parsed or not."""
    texts = [samples.BOARD_A, samples.BOARD_B, samples.BOARD_C_LIST, samples.BOARD_C_DETAIL, samples.BOARD_D, "<script><p>", "", None]
    stored = spark.createDataFrame([(f"https://x/{i}", h) for i, h in enumerate(texts)], "url string, html string")
    parsed = pages.with_nodes(stored)
    for extract in (pages.board_a, pages.board_b, pages.board_c_list, pages.board_c_detail, pages.board_d):
        one, other = ([r.asDict(True) for r in extract(df).orderBy("url").collect()] for df in (stored, parsed))
        assert one == other and one


def test_narrow_rows_are_dealt_out_before_they_grow(spark):
    rows = spread(spark.range(1000).coalesce(1), "id")
    assert len({r[0] for r in rows.selectExpr("spark_partition_id()").distinct().collect()}) >= 4
