"""Rule tables, as data.  Every rule list is an argument default, so callers may pass their own."""

from __future__ import annotations

# ---------------------------------------------------------------------------------------
# These keyword lists, labels, rates and patterns decide results, so they are
# stated literally and in their order of precedence.
# ---------------------------------------------------------------------------------------

# Province rules: the first keyword contained in the lower-cased address gives the label.
PROVINCES = [
    ("hồ chí minh", "TP.HCM"),
    ("hà nội", "Hà Nội"),
    ("đà nẵng", "Đà Nẵng"),
    ("cần thơ", "Cần Thơ"),
    ("hải phòng", "Hải Phòng"),
    ("biên hòa", "Đồng Nai"),
    ("nha trang", "Khánh Hòa"),
    ("huế", "Thừa Thiên Huế"),
    ("vinh", "Nghệ An"),
    ("buôn ma thuột", "Đắk Lắk"),
    ("bắc giang", "Bắc Giang"),
    ("bắc kạn", "Bắc Kạn"),
    ("bắc ninh", "Bắc Ninh"),
    ("cao bằng", "Cao Bằng"),
    ("điện biên", "Điện Biên"),
    ("hà giang", "Hà Giang"),
    ("hà nam", "Hà Nam"),
    ("hải dương", "Hải Dương"),
    ("hòa bình", "Hòa Bình"),
    ("hưng yên", "Hưng Yên"),
    ("lai châu", "Lai Châu"),
    ("lạng sơn", "Lạng Sơn"),
    ("lào cai", "Lào Cai"),
    ("nam định", "Nam Định"),
    ("ninh bình", "Ninh Bình"),
    ("phú thọ", "Phú Thọ"),
    ("quảng ninh", "Quảng Ninh"),
    ("sơn la", "Sơn La"),
    ("thái bình", "Thái Bình"),
    ("thái nguyên", "Thái Nguyên"),
    ("tuyên quang", "Tuyên Quang"),
    ("vĩnh phúc", "Vĩnh Phúc"),
    ("yên bái", "Yên Bái"),
    ("bình định", "Bình Định"),
    ("bình thuận", "Bình Thuận"),
    ("hà tĩnh", "Hà Tĩnh"),
    ("khánh hòa", "Khánh Hòa"),
    ("ninh thuận", "Ninh Thuận"),
    ("phú yên", "Phú Yên"),
    ("quảng bình", "Quảng Bình"),
    ("quảng nam", "Quảng Nam"),
    ("quảng ngãi", "Quảng Ngãi"),
    ("quảng trị", "Quảng Trị"),
    ("thanh hóa", "Thanh Hóa"),
    ("huế", "Thừa Thiên Huế"),
    ("đắk lắk", "Đắk Lắk"),
    ("đắk nông", "Đắk Nông"),
    ("gia lai", "Gia Lai"),
    ("kon tum", "Kon Tum"),
    ("lâm đồng", "Lâm Đồng"),
    ("an giang", "An Giang"),
    ("bà rịa", "Bà Rịa - Vũng Tàu"),
    ("vũng tàu", "Bà Rịa - Vũng Tàu"),
    ("bạc liêu", "Bạc Liêu"),
    ("bến tre", "Bến Tre"),
    ("bình dương", "Bình Dương"),
    ("bình phước", "Bình Phước"),
    ("cà mau", "Cà Mau"),
    ("đồng nai", "Đồng Nai"),
    ("đồng tháp", "Đồng Tháp"),
    ("hậu giang", "Hậu Giang"),
    ("kiên giang", "Kiên Giang"),
    ("long an", "Long An"),
    ("sóc trăng", "Sóc Trăng"),
    ("tây ninh", "Tây Ninh"),
    ("tiền giang", "Tiền Giang"),
    ("trà vinh", "Trà Vinh"),
    ("vĩnh long", "Vĩnh Long"),
]
PROVINCE_OTHER = "Khác"

# Regions of the location dimension; labels outside the first two lists are "South".
REGION_NORTH = [
    "Hà Nội", "Hải Phòng", "Bắc Giang", "Bắc Kạn", "Bắc Ninh", "Cao Bằng", "Điện Biên",
    "Hà Giang", "Hà Nam", "Hải Dương", "Hòa Bình", "Hưng Yên", "Lai Châu", "Lạng Sơn",
    "Lào Cai", "Nam Định", "Ninh Bình", "Phú Thọ", "Quảng Ninh", "Sơn La", "Thái Bình",
    "Thái Nguyên", "Tuyên Quang", "Vĩnh Phúc", "Yên Bái",
]
REGION_CENTRAL = [
    "Đà Nẵng", "Khánh Hòa", "Thừa Thiên Huế", "Nghệ An", "Bình Định", "Bình Thuận", "Hà Tĩnh",
    "Ninh Thuận", "Phú Yên", "Quảng Bình", "Quảng Nam", "Quảng Ngãi", "Quảng Trị",
    "Thanh Hóa", "Đắk Lắk", "Đắk Nông", "Gia Lai", "Kon Tum", "Lâm Đồng",
]

# City rules, four variants.
CITIES_FIVE = [
    ("Hà Nội", ["hà nội", "hanoi"]),
    ("TP. Hồ Chí Minh", ["hồ chí minh", "tp.hcm", "saigon"]),
    ("Đà Nẵng", ["đà nẵng", "da nang"]),
    ("Cần Thơ", ["cần thơ"]),
    ("Hải Phòng", ["hải phòng"]),
]
CITIES_FIVE_OTHER = "Tỉnh thành khác"
UNKNOWN_VI = "Không xác định"

CITY_PATTERNS = [
    (
        "Thành Phố Hồ Chí Minh",
        r"(\bhcm\b|\btphcm\b|hồ\s?chí\s?minh|\bho\s?chi\s?minh|\bsaigon|\bsài\s?gòn)\b",
    ),
    ("Hà Nội", r"(\bhn\b|\bhni\b|hà\s?nội|\bha\s?n\s?oi|hanoi|h\s?n)\b"),
]
CITIES_STREAM = [
    ("TP.HCM", ["hồ chí minh", "hcm"]),
    ("Hà Nội", ["hà nội"]),
    ("Đà Nẵng", ["đà nẵng"]),
    ("Remote", ["remote"]),
]
CITIES_ENGLISH = [
    ("Ho Chi Minh City", ["hồ chí minh", "hcm"]),
    ("Ha Noi", ["hà nội"]),
    ("Da Nang", ["đà nẵng"]),
]
CITY_ALIASES = ["Hồ Chí Minh", "TP.HCM", "HCM"]
CITY_ALIAS_LABEL = "Thành Phố Hồ Chí Minh"

# Level rules, three variants.
LEVELS = [
    (
        "Leader",
        ["trưởng", "truong", "manager", "lead", "director", "giám đốc", "giam doc", "phó", "pho",
         "head of", "chief", "cto", "ceo", "coo", "cfo", "vp", "vice president"],
    ),
    (
        "Senior",
        ["senior", "chuyên viên chính", "chuyen vien chinh", "principal", "chủ nhiệm",
         "chu nhiem", "expert", "specialist"],
    ),
    (
        "Junior",
        ["junior", "fresher", "intern", "thực tập", "thuc tap", "mới tốt nghiệp",
         "moi tot nghiep", "entry level", "entry-level", "graduate", "trainee"],
    ),
]
LEVELS_SIX = [
    ("Thực tập sinh", ["intern", "thực tập"]),
    ("Fresher/Junior", ["fresher", "junior", "entry"]),
    ("Senior", ["senior", "sr.", "chuyên viên cao cấp"]),
    ("Lead/Manager", ["lead", "leader", "trưởng nhóm", "trưởng phòng"]),
    ("Director/C-level", ["director", "giám đốc", "cto", "ceo", "vp"]),
]
LEVELS_STREAM = [
    ("Leader/Manager",
     ["trưởng", "manager", "lead", "director", "head", "chief", "cto", "ceo"]),
    ("Senior", ["senior", "chuyên viên chính", "principal", "expert"]),
    ("Junior/Fresher",
     ["junior", "fresher", "intern", "thực tập", "trainee", "mới tốt nghiệp"]),
]
LEVEL_OTHER = "Mid-level"

# Work-mode rules, two variants.
WORK_MODES = [
    ("Làm từ xa", ["remote", "làm từ xa", "work from home", "work-from-home"]),
    ("Kết hợp", ["hybrid", "bán thời gian tại văn phòng", "kết hợp"]),
]
WORK_MODE_OTHER = "Trực tiếp"
WORK_MODES_ENGLISH = [
    ("Remote", ["remote", "làm việc từ xa"]),
    ("Hybrid", ["hybrid", "linh hoạt"]),
]
WORK_MODE_ENGLISH_OTHER = "Office"

# Skill keywords: the long list for batch, the short list for streams.
SKILLS = [
    "Python", "Java", "C#", "C++", "SQL", "JavaScript", "TypeScript", "Go", "PHP", "Ruby",
    "React", "Vue.js", "Angular", "Node.js", ".NET", "Spring Boot", "Django", "Flask",
    "Power BI", "Tableau", "Looker", "SQL Server", "PostgreSQL", "MySQL", "MongoDB", "Oracle",
    "Redis", "AWS", "Azure", "GCP", "Docker", "Kubernetes", "Terraform", "CI/CD", "Jenkins",
    "Git", "SAP", "ERP", "Odoo", "Machine Learning", "AI", "Deep Learning", "ETL",
    "Data Warehouse", "Big Data", "Spark", "Hadoop", "Kafka", "Linux", "Network", "Security",
    "Firewall", "API", "Microservices", "Automation Test", "Selenium", "Agile", "Scrum", "Jira",
]
SKILLS_STREAM = [
    "Python", "Java", "C#", "C++", "SQL", "JavaScript", "TypeScript", "Go", "PHP", "Ruby",
    "React", "Vue.js", "Angular", "Node.js", ".NET", "Spring Boot", "Django", "Flask",
    "Power BI", "Tableau", "Looker", "SQL Server", "PostgreSQL", "MySQL", "MongoDB", "Oracle",
    "Redis", "AWS", "Azure", "GCP", "Docker", "Kubernetes", "Terraform", "CI/CD", "Jenkins",
    "Git", "Spark", "Hadoop", "Kafka", "Linux", "Machine Learning", "AI",
]

# Salary words and exchange rates (VND per USD) of the individual parsers.
NEGOTIABLE = "thoả thuận|thỏa thuận|thoa thuan"
NEGOTIABLE_LABEL = "Thương lượng"
COMPETITIVE = "cạnh tranh"
USD_RATE = 25_000
USD_RATE_DISPLAY = 23_500
USD_RATE_STANDARD = 26_000
# Words of the display format and of stream messages.
DISPLAY_UNITS = (("tr", 1_000_000), ("m", 1_000_000), ("k", 1_000))
DISPLAY_DOLLARS = r"\$|usd"
DISPLAY_YEARLY = "năm|yr|(?:/|per )year"
DISPLAY_UP_TO = "tới|to"
DISPLAY_REFUSAL = "thương lượng|negotiable"
STREAM_UP_TO = "tới|up to"

# Company recovery from a description: legal form, "X tuyển dụng …", "Tại X, …".
COMPANY_LEGAL_FORMS = ["Công ty TNHH", "Công ty Cổ phần", "Tập đoàn"]
COMPANY_HIRING_VERBS = ["tuyển dụng", "tuyển", "tìm kiếm"]
COMPANY_AT = "Tại"
COMPANY_UNKNOWN = "Chưa xác định"

# Defaults of missing values and placeholders.
PLACEHOLDER = "N/A"
WORKING_HOURS_DEFAULT = "Giờ hành chính"
NO_INFORMATION = "Không có thông tin"
FILL_DEFAULTS = {
    "company": "Không rõ",
    "title": "Không rõ",
    "work_mode": "Trực tiếp",
    "working_hours": "Giờ hành chính",
    "city": "Không xác định",
    "level": "Không xác định",
}

# Columns that an advert must have to be kept; salary may be missing.
REQUIRED = ["location_raw", "title", "posted_raw"]

# Canonical column -> accepted spellings, first present one wins.
COLUMN_ALIASES = {
    "city": ["Thành phố", "Địa chỉ", "location"],
    "level": ["Cấp bậc", "cap_bac", "level"],
    "salary_mid": ["Lương (số)", "salary"],
    "company": ["Tên công ty", "company_name"],
}

# Detail-page labels (upper case on the page) -> field.
DETAIL_LABELS = [
    ("NGÀY ĐĂNG", "posted_raw"),
    ("CẤP BẬC", "level_raw"),
    ("NGÀNH NGHỀ", "industry"),
    ("KỸ NĂNG", "skills_raw"),
    ("LĨNH VỰC", "field"),
    ("NGÔN NGỮ", "language"),
    ("KINH NGHIỆM", "experience"),
    ("QUỐC TỊCH", "nationality"),
]


def with_trap_rules_first(rules: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Put a keyword that contains an earlier keyword in front of it ("trà vinh" vs "vinh").

    Everything else keeps its order; this is the corrected province list.
    """
    ordered: list[tuple[str, str]] = []
    for keyword, label in rules:
        at = next((i for i, (k, _) in enumerate(ordered) if k != keyword and k in keyword), None)
        ordered.insert(len(ordered) if at is None else at, (keyword, label))
    return ordered
