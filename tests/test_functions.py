"""Column functions against the standard library, value by value."""

import html as std_html
import random
import urllib.parse as up
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from placeledger.functions import contacts, geo, html, jsons, labels, prices, text, times, urls


def values(spark, expr, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", expr.alias("o")).orderBy("i").collect()]


def test_normalize_text(spark):
    got = values(spark, text.normalize_text("v"), ["Ёлка-Салон  №1", "  ", None, "ABC,déf"])
    assert got == ["елка салон 1", None, None, "abc d f"]


def test_normalize_phone(spark):
    got = values(spark, text.normalize_phone("v"), ["8 (999) 111-22-33", "+7 4012 11-22-33", "abc", "89991"])
    assert got == ["79991112233", "74012112233", None, "89991"]


def test_ordered_unique(spark):
    df = spark.createDataFrame([([" a", "b", "a ", "", None],)], "v array<string>")
    assert df.select(text.ordered_unique("v")).first()[0] == ["a", "b"]


def test_coordinate_key_equals_c_formatting(spark):
    rng = random.Random(1)
    xs = [rng.uniform(-180, 180) for _ in range(2000)]
    xs += [54.123455, 1.000005, 2.000015, -0.000001, 0.5e-5, 1.5e-5]
    xs += [k * 1e-5 + 0.5e-5 for k in range(1000)] + [k / 2**17 for k in range(500)]
    got = values(spark, geo.coordinate_key("v", "v"), xs, "double")
    assert got == [f"{x:.5f},{x:.5f}" for x in xs]


def test_longitudes(spark):
    assert values(spark, geo.normalize_longitude("v"), [180.0, -180.0, 190.0, 540.0, -179.5], "double") == [
        180.0, -180.0, -170.0, 180.0, -179.5]
    assert values(spark, geo.unwrap_longitude("v", F.lit(179.0)), [-179.0, 179.0, -900.0], "double") == [
        181.0, 179.0, 180.0]
    assert geo.cell_radius_m() == 1061


def test_local_projection_matches_ellipsoidal_distance(spark):
    """Distances from the centre against an ellipsoidal inverse solution."""
    import math

    def ellipsoid_distance(lat1, lon1, lat2, lon2):
        a, f = 6378137.0, 1 / 298.257223563
        b = a * (1 - f)
        u1, u2 = (math.atan((1 - f) * math.tan(math.radians(x))) for x in (lat1, lat2))
        length = lam = math.radians(lon2 - lon1)
        for _ in range(200):
            sin_s = math.hypot(
                math.cos(u2) * math.sin(lam),
                math.cos(u1) * math.sin(u2) - math.sin(u1) * math.cos(u2) * math.cos(lam),
            )
            cos_s = math.sin(u1) * math.sin(u2) + math.cos(u1) * math.cos(u2) * math.cos(lam)
            s = math.atan2(sin_s, cos_s)
            sin_a = math.cos(u1) * math.cos(u2) * math.sin(lam) / sin_s
            cos2a = 1 - sin_a**2
            c2m = cos_s - 2 * math.sin(u1) * math.sin(u2) / cos2a if cos2a else 0
            c = f / 16 * cos2a * (4 + f * (4 - 3 * cos2a))
            new = length + (1 - c) * f * sin_a * (s + c * sin_s * (c2m + c * cos_s * (-1 + 2 * c2m**2)))
            if abs(new - lam) < 1e-13:
                break
            lam = new
        us = cos2a * (a * a - b * b) / (b * b)
        big_a = 1 + us / 16384 * (4096 + us * (-768 + us * (320 - 175 * us)))
        big_b = us / 1024 * (256 + us * (-128 + us * (74 - 47 * us)))
        ds = big_b * sin_s * (c2m + big_b / 4 * (cos_s * (2 * c2m**2 - 1)))
        return b * big_a * (s - ds)

    for lat0, lon0 in ((54.7, 20.5), (75.0, 100.0), (10.0, -60.0)):
        points = [(lat0 + dy, lon0 + dx) for dy in (-1.5, 0.2, 1.5) for dx in (-2.0, 0.3, 2.0)]
        df = spark.createDataFrame(points, "lat double, lon double")
        p = geo.project_local(F.col("lon"), F.col("lat"), F.lit(lon0), F.lit(lat0))
        back = geo.unproject_local(F.col("p.x"), F.col("p.y"), F.lit(lon0), F.lit(lat0))
        rows = df.withColumn("p", p).withColumn("b", back).select(
            "lon", "lat", "p.x", "p.y", F.col("b.lon").alias("lon2"), F.col("b.lat").alias("lat2")).collect()
        for r in rows:
            true = ellipsoid_distance(lat0, lon0, r["lat"], r["lon"])
            assert abs(math.hypot(r["x"], r["y"]) / true - 1) < 5e-4
            assert abs(r["lon2"] - r["lon"]) < 1e-9 and abs(r["lat2"] - r["lat"]) < 1e-9


BASES = ["https://a.com/x/y?z=1", "http://a.com", "https://A.com/p/"]
HREFS = [
    "b", "../b", "./c/../d?q=1#f", "/abs/../e/.", "?k=2", "#frag", "", "//a.com/zz", "mailto:x@y",
    "https://a.com/p;x=1/q;z", "http:rel", "javascript:void(0)", "../../../../up", "a/..", "x//y", "/x//y",
    "https://a.com",
]


def test_resolve_link(spark):
    def expected(base, href):
        p = up.urlparse(up.urljoin(base, href))
        if p.scheme not in ("http", "https") or not p.netloc:
            return None
        return up.urlunparse((p.scheme, p.netloc, p.path or "/", "", p.query, ""))

    pairs = [(b, h) for b in BASES for h in HREFS]
    df = spark.createDataFrame(pairs, "b string, h string")
    for r in df.withColumn("o", urls.resolve_link("b", "h")).collect():
        assert r["o"] == expected(r["b"], r["h"]), (r["b"], r["h"])


def test_normalize_url(spark):
    def expected(value):
        c = value.strip()
        if not c:
            return None
        p = up.urlparse(c if "://" in c else f"https://{c}")
        if not p.netloc:
            return None
        return up.urlunparse((p.scheme.lower(), p.netloc.lower(), p.path.rstrip("/"), "", p.query, ""))

    inputs = [
        "example.ru/beauty", " HTTP://Ex.com/A/B//?Q=1#x", "vk.com/beauty", "foo://", "1http://x",
        "example.com/?u=http://x", "a:b://c", "https://h/p;a/b;c=1?x", "", "mailto:a@b.c", "https://h?x=1", "h#f",
        "https://user:pw@H:80/x/",
    ]
    assert values(spark, urls.normalize_url("v"), inputs) == [expected(v) for v in inputs]


def test_redact_url(spark):
    def expected(url):
        p = up.urlparse(url)
        pairs = [
            (k, "REDACTED" if "key" in k.lower() or "token" in k.lower() else v)
            for k, v in up.parse_qsl(p.query, keep_blank_values=True)
        ]
        return up.urlunparse((p.scheme, p.netloc, p.path, "", up.urlencode(pairs), ""))

    inputs = [
        "https://h/p?apiKey=1&x=%20a+b&y", "https://h/p?a=~*%E2%82%BD&Token=&b=1&&c==d", "https://h/p",
        "https://h/p?a=%zz",
    ]
    assert values(spark, urls.redact_url("v"), inputs) == [expected(v) for v in inputs]
    assert values(spark, urls.drop_query_keys("v"), ["https://h/p?q=a&key=s&r=1"]) == ["https://h/p?q=a&r=1"]


def test_unescape(spark):
    inputs = [
        "a &amp; b", "&amp;copy;", "no", "&#x;&#;", "&amp", "&ampx&nbsp;y", "&lt;p&gt; &hellip;&mdash;&#8381;",
        "&copy2 &copyx; &notit; &#169; &#xA9 &#0; &#150; &#x1F600; &#55555555555555555555; &#xD800; & &; &foo; &#1;",
    ]
    assert values(spark, html.unescape("v"), inputs) == [std_html.unescape(v) for v in inputs]


def test_visible_lines(spark):
    page = (
        "<script>var x='</p>';</script><STYLE>p{}</STYLE><p>Первая  строка</p><div>коротк</div>"
        "вторая&nbsp;строка<br/>третья <b>строка</b></h2>"
    )
    df = spark.createDataFrame([(page,)], "v string")
    got = df.select(html.candidate_lines(html.visible_text("v"))).first()[0]
    assert got == ["Первая строка", "вторая строка", "третья строка"]


def test_parse_datetime(spark):
    def expected(value):
        t = value.strip()
        for c in (t, t.replace("Z", "+00:00")):
            try:
                return datetime.fromisoformat(c).replace(tzinfo=None)
            except ValueError:
                pass
        try:
            return datetime.strptime(t, "%Y-%m-%d %H:%M:%S")
        except ValueError:
            return None

    inputs = [
        "2024-01-05 10:11:12", "2024-01-05T10:11:12Z", "2024-01-05T10:11:12.123456+03:00", "2024-01-05",
        "2024-01-05T10", "2024-1-5 1:2:3", "2024", "bad", "2024-01-05T10:11-0500", "2024-13-01", " 2024-01-05 ",
    ]
    assert values(spark, times.parse_datetime("v"), inputs) == [expected(v) for v in inputs]


@pytest.mark.parametrize(
    "written, expected",
    [
        ("Маникюр с покрытием — 1 800 ₽", ("exact", 180000, "RUB", None, None)),
        ("от 1500 руб.", ("from", 150000, "RUB", 150000, None)),
        ("1500–1900 ₽", ("range", None, "RUB", 150000, 190000)),
        ("ОТ 2 000,50 RUB", ("from", 200050, "RUB", 200050, None)),
        ("1900 до 1500", ("range", None, "RUB", 150000, 190000)),
        ("1.005", ("exact", 100, "RUB", None, None)),
        ("0", None), ("нет", None), ("12-0", None), ("1\u00a0800 ₽", None), ("  ", None),
    ],
)
def test_price_of_text(spark, written, expected):
    got = values(spark, prices.price_of_text("v"), [written])[0]
    assert (tuple(got) if got else None) == expected


def test_price_of_number_keeps_type_without_amount(spark):
    got = values(spark, prices.price_of_number("v"), [1800.0, 0.0, 0.125], "double")
    assert [(r["price_type"], r["amount_minor"]) for r in got] == [("exact", 180000), ("exact", None), ("exact", 12)]


def test_display_price(spark):
    rows = [("exact", 180000, None, None), ("from", 150000, 150000, None), ("range", None, 150000, 190000),
            ("ambiguous", None, None, None), ("range", None, None, 1)]
    df = spark.createDataFrame(rows, "t string, a bigint, l bigint, h bigint")
    args = ("t", "a", "l", "h")
    got = df.select(prices.display_price_report(*args).alias("r"), prices.display_price(*args).alias("s")).collect()
    assert [r["r"] for r in got] == ["1800", "от 1500", "1500–1900", None, None]
    assert [r["s"] for r in got] == ["1800", "от 1500", "1500-1900", None, None]


def test_contacts(spark):
    rows = [
        ("phone", "+7 (4012) 11-22-33"), ("mail", "Hello@Example.ru"), ("mail", "bad"), ("website", "example.ru/b"),
        ("x", "vk.com/beauty"), ("phone", "abc"), (None, "t.me/x"), ("email", None),
    ]
    df = spark.createDataFrame(rows, "t string, v string")
    got = [r[0] and (r[0]["contact_type"], r[0]["normalized_value"])
           for r in df.select(contacts.normalize_contact("t", "v")).collect()]
    assert got == [
        ("phone", "74012112233"), ("email", "hello@example.ru"), None, ("website", "https://example.ru/b"),
        ("social", "https://vk.com/beauty"), None, ("social", "https://t.me/x"), None,
    ]


def test_lenient_json(spark):
    inputs = ['["a","",null,1,2.5,true]', "{}", "bad", None, '{"a":1}']
    assert values(spark, jsons.string_list("v"), inputs) == [["a", "1", "2.5", "True"], [], [], [], []]
    assert values(spark, jsons.string_map("v"), ['{"a":"s","b":1}', "[1]"]) == [{"a": "s", "b": "1"}, {}]


def test_labels(spark):
    got = values(spark, labels.salon_type("v"), ["nail_specialist", "mixed_beauty_salon", "x", None])
    assert got == ["manicure_specialized", "mixed_beauty_salon", "unknown", "unknown"]
