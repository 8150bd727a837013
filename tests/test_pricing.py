"""Price extraction golden cases and price state."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from placeledger import schemas
from placeledger.operators.price_state import merge_prices, summarize_prices
from placeledger.plans.pricing import extract_prices, latest_payloads, pricing_counters

def as_of():
    return F.lit(datetime(2024, 1, 2)).cast("timestamp_ntz")


SALON = {"id": 1, "filter_status": "accepted", "website": "https://s.ru", "verification_status": "not_checked"}
LD = '<script type="application/ld+json">%s</script>'


def run(frame, pages=(), payloads=(), salons=(SALON,)):
    details = [
        {"id": i, "salon_id": 1, "status": "success", "sanitized_source_url": "u",
         "raw_payload_json": p if isinstance(p, str) else json.dumps(p, ensure_ascii=False)}
        for i, p in enumerate(payloads)
    ]
    web = [{"salon_id": 1, "page_no": i, "source_url": f"p{i}", **p} for i, p in enumerate(pages, 1)]
    return extract_prices(
        frame(salons, schemas.SALON), frame(details, schemas.DETAIL_PAYLOAD), frame(web, schemas.WEB_PAGE), as_of()
    ).orderBy("salon_id").collect()


def provider(*services, key="services"):
    return {"result": {"items": [{key: list(services)}]}}


def one(frame, **kw):
    rows = run(frame, **kw)
    assert len(rows) == 1
    return rows[0]


def test_json_ld_offer(frame):
    ld = {"@graph": [{"@type": "Service", "name": "Маникюр с покрытием", "offers": {"price": "1800"}}]}
    r = one(frame, pages=[{"html": LD % json.dumps(ld, ensure_ascii=False)}])
    assert (r["extraction_status"], r["price_type"], r["amount_minor"], r["source_type"]) == (
        "found", "exact", 180000, "website_json_ld")
    assert r["evidence_text"] == "Маникюр с покрытием 1800"


def test_json_ld_any_depth(frame):
    node = {"name": "Маникюр с покрытием", "price": 1700}
    for _ in range(30):
        node = {"itemListElement": [node]}
    r = one(frame, pages=[{"html": LD % "{broken" + LD % json.dumps([[node]], ensure_ascii=False)}])
    assert (r["extraction_status"], r["amount_minor"]) == ("found", 170000)


def test_text_range(frame):
    r = one(frame, pages=[{"html": "<body>Маникюр + покрытие 1500–1900 ₽</body>"}])
    assert (r["price_type"], r["range_min_minor"], r["range_max_minor"], r["source_type"]) == (
        "range", 150000, 190000, "website_text")


def test_opening_hours_are_no_price(frame):
    r = one(frame, pages=[{"html": "<body>Работаем с 9 до 21 каждый день</body>"}])
    assert (r["extraction_status"], r["source_type"], r["price_type"]) == ("not_found", "none", "not_found")


def test_no_sources(frame):
    r = one(frame, salons=[{**SALON, "website": None}])
    assert r["extraction_status"] == "not_found" and r["evidence_text"].startswith("No reliable")


def test_provider_beats_page(frame):
    r = one(frame, payloads=[provider({"name": "Маникюр с покрытием", "price": 1700})],
            pages=[{"html": "<p>Маникюр с покрытием 1900 ₽</p>"}])
    assert (r["amount_minor"], r["source_type"], r["evidence_text"]) == (
        170000, "provider_structured", "Маникюр с покрытием 1700")


def test_found_page_beats_ambiguous_provider(frame):
    ambiguous = provider({"name": "Покрытие гель лак", "price": 1000})
    r = one(frame, payloads=[ambiguous], pages=[{"html": "<p>Маникюр с покрытием 1900 ₽</p>"}])
    assert (r["extraction_status"], r["amount_minor"]) == ("found", 190000)
    r = one(frame, payloads=[ambiguous], pages=[{"html": "<p>nothing here</p>"}])
    assert (r["extraction_status"], r["source_type"], r["amount_minor"]) == ("ambiguous", "provider_structured", None)
    r = one(frame, payloads=[ambiguous], pages=[{"html": "<p>Комплекс: гель лак 500</p>"}])
    assert (r["extraction_status"], r["source_type"]) == ("ambiguous", "website_text")


def test_first_found_in_reading_order(frame):
    r = one(frame, pages=[
        {"html": "<p>Покрытие гель лак 800</p><p>Маникюр с покрытием 1500</p><p>Маникюр с покрытием 900</p>"},
        {"html": LD % '{"name":"Маникюр с покрытием","price":5}'},
    ])
    assert r["amount_minor"] == 150000


def test_fetch_error(frame):
    r = one(frame, pages=[{"fetch_error": "boom"}, {"html": "<p>Маникюр с покрытием 1500</p>"}])
    assert (r["extraction_status"], r["error_message"], r["source_type"]) == ("error", "boom", None)
    r = one(frame, payloads=[provider({"name": "Маникюр с покрытием", "price": 1700})], pages=[{"fetch_error": "b"}])
    assert r["extraction_status"] == "found"


@pytest.mark.parametrize(
    "service, status, amount",
    [
        ({"name": "Маникюр с покрытием", "price": 0, "amount": "", "cost": 1200}, "found", 120000),
        ({"name": "Маникюр с покрытием", "price": 0, "cost": 0}, "found", None),
        ({"name": "Маникюр с покрытием", "price": True}, "found", None),
        ({"name": "Маникюр с покрытием", "price": {"x": 1}}, "error", None),
        ({"name": "Маникюр с покрытием", "price": "по запросу"}, "ambiguous", None),
        ({"name": "Маникюр с покрытием"}, "not_found", None),
        ({"name": 5, "title": " Маникюр с покрытием ", "price": 1}, "found", 100),
    ],
)
def test_structured_price_rules(frame, service, status, amount):
    r = one(frame, payloads=[provider(service)])
    assert (r["extraction_status"], r["amount_minor"]) == (status, amount)


def test_payload_order_and_keys(frame):
    """Newest payload first; within it services, prices, service_prices, menu."""
    item = {"menu": [{"name": "Маникюр с покрытием", "price": 1}], "prices": [{"name": "Маникюр с покрытием", "price": 2}]}
    old = provider({"name": "Маникюр с покрытием", "price": 3})
    assert one(frame, payloads=[old, {"result": {"items": [item]}}])["amount_minor"] == 200
    # Three newest count, an unreadable one included.
    assert one(frame, payloads=[old, "{bad", "{bad", "{bad"])["extraction_status"] == "not_found"
    assert one(frame, payloads=[old, "{bad", "{bad"])["amount_minor"] == 300


def test_only_accepted_or_unset(frame):
    salons = [SALON, {**SALON, "id": 2, "filter_status": "rejected"}, {**SALON, "id": 3, "filter_status": None}]
    rows = run(frame, salons=salons)
    assert [r["salon_id"] for r in rows] == [1, 3]


def test_counters(frame, spark):
    rows = [{"extraction_status": s} for s in ("found", "found", "error", "not_found")]
    got = pricing_counters(frame(rows, "extraction_status string")).first().asDict()
    assert got == {"processed": 4, "found": 2, "ambiguous": 0, "errors": 1, "not_found": 1}


RESULT = """salon_id bigint, service_key string, extraction_status string, service_name_raw string,
    service_name_normalized string, amount_minor bigint, currency string, price_type string, range_min_minor bigint,
    range_max_minor bigint, source_type string, source_url string, evidence_text string, confidence string"""


def result(salon=1, **kw):
    return {"salon_id": salon, "service_key": "k", "extraction_status": "found", "price_type": "exact",
            "amount_minor": 100, "source_type": "s", "evidence_text": "e", **kw}


def state(frame, results, current=()):
    merged = merge_prices(frame(current, schemas.PRICE), frame(results, RESULT), as_of())
    return sorted((r["salon_id"], r["evidence_text"], r["amount_minor"], r["is_active"], r["change"])
                  for r in merged.collect())


OLD = {"id": 1, "salon_id": 1, "service_key": "k", "source_type": "s", "evidence_text": "e", "amount_minor": 90,
       "is_active": True, "first_seen_at": datetime(2024, 1, 1), "last_seen_at": datetime(2024, 1, 1)}


def test_price_state(frame):
    assert state(frame, [result()]) == [(1, "e", 100, True, "created")]
    assert state(frame, [result()], [OLD]) == [(1, "e", 100, True, "updated")]
    assert state(frame, [result(evidence_text="n")], [OLD]) == [
        (1, "e", 90, False, "deactivated"), (1, "n", 100, True, "created")]
    assert state(frame, [result(extraction_status="not_found")], [OLD]) == [(1, "e", 90, False, "deactivated")]
    assert state(frame, [result(salon=2)], [OLD]) == [(1, "e", 90, True, "unchanged"), (2, "e", 100, True, "created")]


def test_price_summary(frame):
    salons = frame([{**SALON, "price_min": 5}, {**SALON, "id": 2, "price_min": 5}, {**SALON, "id": 3}], schemas.SALON)
    results = frame(
        [result(price_type="range", amount_minor=None, range_min_minor=150050, range_max_minor=190000),
         result(salon=2, extraction_status="not_found")], RESULT)
    got = {r["id"]: r for r in summarize_prices(salons, results, as_of()).collect()}
    assert (got[1]["price_min"], got[1]["price_max"], got[1]["service_price"], got[1]["verification_status"]) == (
        1500, 1900, "1500-1900", "price_found")
    assert (got[2]["price_min"], got[2]["verification_status"]) == (5, "not_found")
    assert (got[3]["verification_status"], got[3]["updated_at"]) == ("not_checked", None)


def test_latest_payloads_per_salon(frame):
    rows = [{"id": i, "salon_id": i % 2, "status": "success" if i != 8 else "error", "raw_payload_json": "{}"}
            for i in range(10)]
    got = sorted((r["salon_id"], r["id"], r["page"]) for r in latest_payloads(frame(rows, schemas.DETAIL_PAYLOAD)).collect())
    assert got == [(0, 2, 3), (0, 4, 2), (0, 6, 1), (1, 5, 3), (1, 7, 2), (1, 9, 1)]


def test_nodes_in_reading_order(frame):
    from placeledger.functions import jsons as J

    rows = [{"t": t} for t in (
        '[{"n":1,"@graph":[{"n":2},[{"n":3,"itemListElement":{"n":4}}]],"itemListElement":[{"n":5}]},{"n":6,"other":{"n":7}}]',
        '{"n":1,"@graph":null,"hasOfferCatalog":"x"}', "[]", "5", "{broken", "", None)]
    nodes = F.transform(J.objects_within(J.lenient("t"), ("itemListElement", "hasOfferCatalog", "@graph")),
                        lambda v: J.get(v, "$.n", "int"))
    got = [r[0] or [] for r in frame(rows, "t string").select(nodes).collect()]
    assert got == [[1, 5, 2, 3, 4, 6], [1], [], [], [], [], []]


def test_pages_are_read_once_and_without_python(frame, spark, tmp_path):
    from placeledger.operators.evidence import page_evidence

    spark.createDataFrame([(1, 1, "u", LD % '{"name":"a","price":1}' + "<p>line of 7 words</p>")],
                          "salon_id bigint, page_no int, source_url string, html string").write.parquet(str(tmp_path / "p"))
    found = page_evidence(spark.read.parquet(str(tmp_path / "p")))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "InPandas" not in plan and plan.count("FileScan") == 1
    assert sorted((r["place"]["part"], r["service_name_raw"], r["price_text"]) for r in found.collect()) == [
        (0, "a", "1"), (1, "line of 7 words", "line of 7 words")]


def test_planned_pages_take_the_last_fetch(frame):
    from placeledger.sources.readers import planned_pages

    at = lambda day: datetime(2024, 1, day)
    plan = frame(
        [{"salon_id": 1, "page_no": 1, "url": "https://s.ru/"}, {"salon_id": 2, "page_no": 1, "url": "https://s.ru/"},
         {"salon_id": 2, "page_no": 2, "url": "https://s.ru/p"}, {"salon_id": 3, "page_no": 1, "url": None},
         {"salon_id": 4, "page_no": 1, "url": "https://never.ru/"}], "salon_id bigint, page_no int, url string")
    fetched = frame(
        [{"url": "https://s.ru/", "html": "old", "fetched_at": at(1)}, {"url": "https://s.ru/", "html": "new", "fetched_at": at(2)},
         {"url": "https://s.ru/", "fetch_error": "same time", "fetched_at": at(2)}, {"url": None, "html": "x", "fetched_at": at(3)},
         {"url": "https://s.ru/p", "html": "was", "fetched_at": at(1)}, {"url": "https://s.ru/p", "fetch_error": "gone", "fetched_at": at(2)}],
        schemas.FETCHED_PAGE)
    got = sorted((r["salon_id"], r["page_no"], r["html"], r["fetch_error"]) for r in planned_pages(plan, fetched).collect())
    assert got == [(1, 1, "new", None), (2, 1, "new", None), (2, 2, None, "gone"), (3, 1, None, "not fetched"),
                   (4, 1, None, "not fetched")]
    assert [r["fetch_error"] for r in planned_pages(plan, fetched.limit(0)).collect()] == ["not fetched"] * 5
