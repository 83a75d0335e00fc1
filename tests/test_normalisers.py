import datetime
import re
import unicodedata

from pyspark.sql import functions as F

from jobmart import rules
from jobmart.functions import company, dates, items, level, location, skills, text, workmode
from tests.samples import characters, joined


def test_province_rules(column):
    places = ["Trà Vinh", "TP. Vinh, Nghệ An", "Huế", "Cty B - HÀ NỘI", "London", None, "", "Bà Rịa-Vũng Tàu"]
    assert column(location.province, places) == [
        "Trà Vinh", "Nghệ An", "Thừa Thiên Huế", "Hà Nội", "Khác", "Khác", "Khác", "Bà Rịa - Vũng Tàu",
    ]
    assert column(lambda c: location.province(c, legacy=True), ["Trà Vinh"]) == ["Nghệ An"]
    assert len(rules.PROVINCES) == 68
    assert sorted(rules.with_trap_rules_first(rules.PROVINCES)) == sorted(rules.PROVINCES)


def test_every_label_has_a_region(column):
    labels = sorted({label for _, label in rules.PROVINCES})
    assert set(column(location.region, labels)) == {"North", "Central", "South"}
    assert column(location.region, ["Khác", None]) == [None, None]


def test_cities(column):
    places = ["Cty A, TPHCM", "Company C in London", None, "", "remote job", "bà rịa-vũng tàu o'n"]
    assert column(location.city_by_pattern, places)[:4] == ["Thành Phố Hồ Chí Minh", "Company C in London", None, ""]
    assert column(location.city_stream, places) == [
        "TP.HCM", "Company C In London", "Khác", "Khác", "Remote", "Bà Rịa-Vũng Tàu O'N",
    ]
    assert column(location.city_english, places)[:4] == ["Ho Chi Minh City", "Company C In London", "Unknown", ""]
    assert column(location.city_five, ["Hanoi", None, "x"]) == ["Hà Nội", "Không xác định", "Tỉnh thành khác"]


def test_decomposed_accents_need_nfc(column):
    apart = unicodedata.normalize("NFD", "Hà Nội")
    assert column(location.province, [apart]) == ["Khác"]
    assert column(lambda c: location.province(text.nfc(c)), [apart]) == ["Hà Nội"]


def test_nfc_and_title_case_agree_with_python(column):
    values = characters(500)
    assert column(text.nfc, values) == [unicodedata.normalize("NFC", v) for v in values]
    letters = characters(500, alphabet="abzYZ09 -'./éđọ")
    assert column(text.title_case, letters) == [v.title() for v in letters]


def test_levels(column):
    titles = ["Senior Backend Engineer", "Trưởng phòng IT", "Thực tập sinh", "Project Coordinator",
              "Photoshop Designer", "Internal Auditor", "Director of Data", "", None]
    assert column(level.level, titles) == [
        "Senior", "Leader", "Junior", "Leader", "Leader", "Junior", "Leader", "Mid-level", "Mid-level",
    ]
    assert column(lambda c: level.level(c, whole_words=True), titles) == [
        "Senior", "Leader", "Junior", "Mid-level", "Mid-level", "Mid-level", "Leader", "Mid-level", "Mid-level",
    ]
    assert column(level.level_six, titles) == [
        "Senior", "Lead/Manager", "Thực tập sinh", "Mid-level", "Mid-level", "Thực tập sinh",
        "Director/C-level", "Mid-level", "Không xác định",
    ]
    assert column(level.level_stream, ["Head of IT", None]) == ["Leader/Manager", "Mid-level"]


KEYWORDS = [w for _, words in rules.LEVELS for w in words]


def test_both_level_classifiers_agree(column):
    titles = joined([*KEYWORDS, "Java", " ", "-", "X"], 4, 800, " ")
    assert column(level.level, titles) == column(level.level_by_pattern, titles)


SKILL_TEXTS = ["C++ and C# on .NET", "asp.net core", "c++11", "google go", "AI/ML", "Java, JavaScript", "Node.js",
               "big data warehouse", "SQL Server", "golang"]


def test_skills(column):
    assert column(skills.extract_skills, SKILL_TEXTS) == [
        ["C#", "C++", ".NET"], [], [], ["Go"], ["AI"], ["Java", "JavaScript"], ["Node.js"],
        ["Data Warehouse", "Big Data"], ["SQL", "SQL Server"], [],
    ]
    assert column(lambda c: skills.extract_skills(c, legacy=True), SKILL_TEXTS[:3]) == [[], [".NET"], ["C++"]]


def test_skills_of_missing_description(spark):
    df = spark.createDataFrame([(None, "needs Python")], "a string, b string")
    assert df.select(skills.extract_skills(F.col("a"), F.col("b"))).first()[0] == ["Python"]


PIECES = [k for k in rules.SKILLS] + [" ", ", ", "/", "x", "1", "é", ".", "-"]


def test_one_pass_finds_what_single_searches_find(column):
    def by_hand(t, legacy):
        found = []
        for k in rules.SKILLS:
            word = re.escape(k.lower())
            pattern = rf"\b{word}\b" if legacy else rf"(?<!\w){word}(?!\w)"
            if re.search(pattern, t.lower()):
                found.append(k)
        return found

    texts = joined(PIECES, 8, 1500)
    for legacy in (False, True):
        got = column(lambda c, legacy=legacy: skills.extract_skills(c, legacy=legacy), texts)
        assert [d for d in zip(texts, got) if d[1] != by_hand(d[0], legacy)][:10] == []


def test_work_modes(spark):
    rows = [("Remote 100%", None), (None, "kết hợp"), ("x", "y"), ("làm việc từ xa", "")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select(workmode.work_mode(F.col("a"), F.col("b")), workmode.work_mode_english(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [
        ("Làm từ xa", "Remote"), ("Kết hợp", "Office"), ("Trực tiếp", "Office"), ("Trực tiếp", "Remote"),
    ]


def test_dates(column):
    texts = ["03/11/2025", "3-11-25", "2025-11-03", "Ngày 03/11/2025", "N/A", None, "31/02/2025"]
    day = datetime.date(2025, 11, 3)
    assert column(dates.parse_date, texts) == [day, day, day, day, None, None, None]
    assert column(lambda c: dates.date_text(c, legacy=True), texts) == [
        "03/11/25", "03/11/25", "25/11/03", "03/11/25", None, None, "31/02/25",
    ]
    assert column(dates.date_text, ["2025-11-03"]) == ["03/11/25"]


def test_relative_dates(spark):
    stamp = '<!-- Last updated: "2025-11-03 23:49:10 +0700" -->'
    rows = [(stamp, "Post 1 day ago"), (stamp, "post 33 minutes ago"), (stamp, "30 hours ago"), (stamp, "long ago"),
            ("<p>", "1 day ago"), (stamp, "99999999999 days ago")]
    df = spark.createDataFrame(rows, "page string, t string")
    got = [str(r[0]) for r in df.select(dates.relative_date(F.col("page"), F.col("t"))).collect()]
    assert got == ["2025-11-02", "2025-11-03", "2025-11-02", "2025-11-03", "None", "None"]


def test_benefits_and_items(spark):
    df = spark.createDataFrame(
        [([(" Thưởng ", "x"), ("", "y")], ["Bảo hiểm", " "], ["Lương : 10: 20 tr", "a", "lương: y"]), ([], [], []), (None, None, None)],
        "b array<struct<tieu_de string, mo_ta string>>, s array<string>, kv array<string>",
    )
    titles = items.benefit_titles(F.col("b"))
    got = df.select(titles, items.items_text(titles), items.clean_items(F.col("s")), items.key_value_map(F.col("kv"))).collect()
    assert [tuple(r) for r in got] == [
        (["Thưởng"], "Thưởng", ["Bảo hiểm"], {"lương": "y"}),
        ([], "Không có thông tin", [], {}),
        ([], "Không có thông tin", [], None),
    ]


def test_short_description(column):
    told = "Head\n" + "\n".join(f" • {i}" for i in range(7))
    assert column(items.shorten_description, [told, "only", "", None]) == [
        "Head\n • 0\n • 1\n • 2\n • 3\n • 4", "only", None, None,
    ]


def test_urls_and_addresses(column):
    assert column(lambda c: items.absolute_url(c, "https://x", "/content"), ["/a/content/b", "http://y/z", None]) == [
        "https://x/a", "http://y/z", None,
    ]
    assert column(items.strip_new_marker, ["Mới Dev", "New  Dev", "Newton"]) == ["Dev", "Dev", "Newton"]
    assert [tuple(r) for r in column(location.split_city_address, ["- Hà Nội: Số 1: x", "Số 2"])] == [
        ("Hà Nội", "Số 1: x"), (None, "Số 2"),
    ]


def test_company_recovery(spark):
    rows = [("ACME", "x"), ("N/A", "Về Công ty TNHH Á Châu; tuyển"), (None, "FPT tuyển dụng DE"), (None, "Tại Viettel, Hà Nội"), (None, None)]
    df = spark.createDataFrame(rows, "c string, d string")
    assert [r[0] for r in df.select(company.recover_company(F.col("c"), F.col("d"))).collect()] == [
        "ACME", "Công ty TNHH Á Châu", "FPT", "Viettel", "Chưa xác định",
    ]
