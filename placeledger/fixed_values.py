"""Values that results depend on and that therefore may not drift.

They are data: every operator takes them as a parameter and only defaults to what
is written here, so another language or market passes its own table.
"""

# --- Fixed values: region scan order, name and ISO 3166-2 code (None = no code) ---
REGIONS = [
    (1, "Калининградская область", "RU-KGD"),
    (2, "Санкт-Петербург", "RU-SPE"),
    (3, "Ленинградская область", "RU-LEN"),
    (4, "Республика Карелия", "RU-KR"),
    (5, "Псковская область", "RU-PSK"),
    (6, "Новгородская область", "RU-NGR"),
    (7, "Мурманская область", "RU-MUR"),
    (8, "Вологодская область", "RU-VLG"),
    (9, "Смоленская область", "RU-SMO"),
    (10, "Тверская область", "RU-TVE"),
    (11, "Москва", "RU-MOW"),
    (12, "Московская область", "RU-MOS"),
    (13, "Брянская область", "RU-BRY"),
    (14, "Калужская область", "RU-KLU"),
    (15, "Орловская область", "RU-ORL"),
    (16, "Тульская область", "RU-TUL"),
    (17, "Курская область", "RU-KRS"),
    (18, "Белгородская область", "RU-BEL"),
    (19, "Рязанская область", "RU-RYA"),
    (20, "Ярославская область", "RU-YAR"),
    (21, "Костромская область", "RU-KOS"),
    (22, "Архангельская область", "RU-ARK"),
    (23, "Ненецкий автономный округ", "RU-NEN"),
    (24, "Владимирская область", "RU-VLA"),
    (25, "Ивановская область", "RU-IVA"),
    (26, "Нижегородская область", "RU-NIZ"),
    (27, "Липецкая область", "RU-LIP"),
    (28, "Тамбовская область", "RU-TAM"),
    (29, "Воронежская область", "RU-VOR"),
    (30, "Республика Мордовия", "RU-MO"),
    (31, "Пензенская область", "RU-PNZ"),
    (32, "Саратовская область", "RU-SAR"),
    (33, "Волгоградская область", "RU-VGG"),
    (34, "Ростовская область", "RU-ROS"),
    (35, "Краснодарский край", "RU-KDA"),
    (36, "Республика Адыгея", "RU-AD"),
    (37, "Республика Крым", "RU-CR"),
    (38, "Севастополь", "RU-SEV"),
    (39, "Херсонская область", None),
    (40, "Запорожская область", None),
    (41, "Донецкая Народная Республика", None),
    (42, "Луганская Народная Республика", None),
    (43, "Республика Калмыкия", "RU-KL"),
    (44, "Ставропольский край", "RU-STA"),
    (45, "Карачаево-Черкесская Республика", "RU-KC"),
    (46, "Кабардино-Балкарская Республика", "RU-KB"),
    (47, "Республика Северная Осетия — Алания", "RU-SE"),
    (48, "Республика Ингушетия", "RU-IN"),
    (49, "Чеченская Республика", "RU-CE"),
    (50, "Республика Дагестан", "RU-DA"),
    (51, "Астраханская область", "RU-AST"),
    (52, "Кировская область", "RU-KIR"),
    (53, "Республика Марий Эл", "RU-ME"),
    (54, "Чувашская Республика", "RU-CU"),
    (55, "Ульяновская область", "RU-ULY"),
    (56, "Самарская область", "RU-SAM"),
    (57, "Республика Татарстан", "RU-TA"),
    (58, "Удмуртская Республика", "RU-UD"),
    (59, "Республика Коми", "RU-KO"),
    (60, "Пермский край", "RU-PER"),
    (61, "Республика Башкортостан", "RU-BA"),
    (62, "Оренбургская область", "RU-ORE"),
    (63, "Свердловская область", "RU-SVE"),
    (64, "Челябинская область", "RU-CHE"),
    (65, "Курганская область", "RU-KGN"),
    (66, "Ханты-Мансийский автономный округ — Югра", "RU-KHM"),
    (67, "Ямало-Ненецкий автономный округ", "RU-YAN"),
    (68, "Тюменская область", "RU-TYU"),
    (69, "Омская область", "RU-OMS"),
    (70, "Новосибирская область", "RU-NVS"),
    (71, "Алтайский край", "RU-ALT"),
    (72, "Республика Алтай", "RU-AL"),
    (73, "Томская область", "RU-TOM"),
    (74, "Кемеровская область — Кузбасс", "RU-KEM"),
    (75, "Республика Хакасия", "RU-KK"),
    (76, "Красноярский край", "RU-KYA"),
    (77, "Республика Тыва", "RU-TY"),
    (78, "Иркутская область", "RU-IRK"),
    (79, "Республика Бурятия", "RU-BU"),
    (80, "Забайкальский край", "RU-ZAB"),
    (81, "Республика Саха (Якутия)", "RU-SA"),
    (82, "Амурская область", "RU-AMU"),
    (83, "Еврейская автономная область", "RU-YEV"),
    (84, "Хабаровский край", "RU-KHA"),
    (85, "Приморский край", "RU-PRI"),
    (86, "Магаданская область", "RU-MAG"),
    (87, "Чукотский автономный округ", "RU-CHU"),
    (88, "Камчатский край", "RU-KAM"),
    (89, "Сахалинская область", "RU-SAK"),
]

# --- Fixed values: search-query profiles ---
QUERY_PROFILES = {
    "full_v1": [
        "маникюр",
        "салон красоты маникюр",
        "студия маникюра",
        "ногтевая студия",
        "nail studio",
    ],
    "reduced_ru_en_v1": ["маникюр", "nail studio"],
}
DEFAULT_QUERY_PROFILE = "full_v1"

# --- Fixed values: provider, service and parser labels ---
PROVIDER = "2GIS"
TARGET_SERVICE = "basic_manicure_with_coating"
PRICE_PARSER_VERSION = "1.0.0"
SOURCE_PROVIDER = "provider_structured"
SOURCE_JSON_LD = "website_json_ld"
SOURCE_TEXT = "website_text"

# --- Fixed values: limits ---
GRID_SIZE_METERS = 1500
EARTH_RADIUS_METERS = 6371008.8
WGS84_SEMI_MAJOR = 6378137.0
WGS84_ECC2 = 0.0066943799901413165
MAX_PAGES_PER_SALON = 4
PAYLOADS_PER_SALON = 3
LINE_LENGTH_RANGE = (8, 220)

# --- Fixed values: hosts that count as social networks ---
SOCIAL_HOSTS = [
    "instagram.com",
    "www.instagram.com",
    "vk.com",
    "www.vk.com",
    "t.me",
    "telegram.me",
    "wa.me",
    "whatsapp.com",
    "www.whatsapp.com",
    "facebook.com",
    "www.facebook.com",
    "ok.ru",
    "www.ok.ru",
]

# --- Fixed values: path or query words that mark a price or service page ---
PRICE_LINK_WORDS = [
    "price",
    "prices",
    "прайс",
    "услуги",
    "service",
    "services",
    "manicure",
    "маникюр",
]

# --- Fixed values: price text patterns (Unicode classes, any letter case) ---
AMOUNT = r"\d[\d\s]*(?:[,.]\d+)?"
PRICE_RANGE = rf"({AMOUNT})\s*(?:-|–|—|до)\s*({AMOUNT})"
PRICE_SINGLE = rf"(от\s+)?({AMOUNT})\s*(₽|руб\.?|rub)?"
CURRENCY_WORDS = {"₽": "RUB", "руб": "RUB", "руб.": "RUB", "rub": "RUB"}
DEFAULT_CURRENCY = "RUB"

# --- Fixed values: business-profile labels ---
SALON_TYPE_BY_PROFILE = {
    "nail_specialist": "manicure_specialized",
    "mixed_beauty_salon": "mixed_beauty_salon",
}
PROFILE_LABELS = {
    "nail_specialist": "Маникюрная студия",
    "mixed_beauty_salon": "Смешанный салон красоты",
}
PROFILE_LABEL_OTHER = "Не определён"

# --- Fixed values: report comment fragments ---
COMMENT_FOUND = "Найден и классифицирован"
COMMENT_DETAILS_OK = "Карточка 2ГИС проверена"
COMMENT_NO_CONTACTS_OK = "контакты и официальный сайт API не предоставил"
COMMENT_NO_CONTACTS = "контакты не проверены"
COMMENT_BY_PRICE_STATUS = {
    "not_checked": "цена не проверена",
    "not_found": "цена не найдена",
    "ambiguous": "цена требует ручной проверки",
    "error": "ошибка проверки цены",
}
NO_PRICE_EVIDENCE = "No reliable manicure-with-coating price evidence found."

# --- Fixed values: progress-log patterns ---
LOG_HTTP_STATUS = r"2GIS HTTP status: (\d+)"
LOG_PAYLOAD_CODE = r"2GIS payload meta\.code: (\d+)"

# --- Fixed values: word lists of the entity classifier ---
ENTITY_WORDS = {
    "strong_category": [
        "ногтевые студии", "маникюр", "педикюр", "nail studio", "nail salon",
    ],
    "allowed_category": [
        "салон красоты", "салоны красоты", "студия красоты", "парикмахерская",
        "парикмахерские", "косметолог", "оформление бровей и ресниц", "spa", "спа",
        "beauty studio",
    ],
    "unrelated": [
        "фитнес клуб", "фитнес клубы", "спортивный клуб", "спортивные клубы",
        "гостиница", "гостиницы", "отель", "отели", "торговый центр",
        "торговые центры", "медицинский центр", "медицинские центры",
        "стоматология", "стоматологии", "барбершоп", "барбершопы", "коворкинг",
        "коворкинги", "учебный центр", "учебные центры", "магазин", "магазины",
        "сауна", "сауны", "баня", "бани",
    ],
    "nail_name": ["маникюр", "ногт", "nail", "педикюр"],
    "beauty_name": [
        "салон красоты", "студия красоты", "beauty studio", "beauty space", "красот",
    ],
    "generic_name": ["салон", "студия"],
    "nail_studio_name": ["ногтевая студия", "nail studio"],
    "home_master": [
        "частный мастер", "мастер на дому", "на дому", "home master", "частная",
    ],
    "coworking": [
        "коворкинг", "coworking", "аренда рабочего места", "аренда места",
        "аренда кабинета", "аренда кресла",
    ],
    "training": [
        "школа", "курсы", "обучение", "academy", "training", "учебный центр",
    ],
    "supply": [
        "магазин", "товары", "материалы", "оборудование", "поставщик", "shop", "store",
    ],
}

# --- Fixed values: word lists of the service matcher (used as written, see
# operators/service.py: needles with "-" or "+" never meet normalised text) ---
SERVICE_WORDS = {
    "base": ["маникюр", "manicure"],
    "coating": ["покрыт", "гель лак", "гель-лак", "gel polish", "coating"],
    "strong": [
        "маникюр с покрытием", "комбинированный маникюр с покрытием",
        "аппаратный маникюр с покрытием", "маникюр + гель лак", "маникюр + гель-лак",
        "manicure with gel polish", "manicure with coating",
    ],
    "negative": [
        "снятие", "ремонт", "дизайн", "педикюр", "детский", "детск", "мужской",
        "men", "child", "kids",
    ],
    "men": ["мужской"],
    "package": ["комплекс", "пакет", "spa", "спа"],
    "unrelated": ["массаж", "стриж", "окраш", "бров", "ресниц", "косметолог"],
}
