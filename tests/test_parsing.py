"""Search and details payloads, links, log lines, dimensions."""

import json

import pytest
from pyspark.sql import functions as F

from placeledger import schemas
from placeledger.operators.links import crawl_frontier, internal_links
from placeledger.operators.parse_details import parse_details
from placeledger.operators.parse_search import category_names, parse_search, scan_coverage
from placeledger.operators.progress_log import log_counters
from placeledger.operators.resolve import administrative_relations, candidate_keys, resolve_keys
from placeledger.functions import jsons as J
from placeledger.sources import dimensions as D
from placeledger.sources.evolve import add_missing_columns, union_evolved
from placeledger.sources.readers import boundaries, search_responses

ITEM = {
    "id": 90210, "name": "Заря", "address": {"x": 1}, "address_name": "Дальняя, 7",
    "point": {"lat": 54.7, "lon": 20.5}, "rubrics": [{"name": "Маникюр"}, {"name": ""}, "x", {"name": "Педикюр"}],
    "contact_groups": [
        {"contacts": [
            {"type": "phone", "value": "+7 900 000-00-01", "text": "t"}, {"type": "phone", "value": "2"},
            {"type": "website", "value": "", "text": "place.example/nails"}, {"type": "vk", "value": "vk.com/zarya"},
        ]},
        "broken", {"contacts": [{"type": "instagram", "value": "insta"}, {"type": "email", "value": None}]},
    ],
    "schedule": {"b": 1, "a": 2}, "description": None,
}


def response(body, **extra):
    return {"grid_cell_id": 1, "region_id": 1, "query": "q", "page": 1, "body": json.dumps(body), **extra}


def test_search_items(frame):
    df = frame([response({"meta": {"code": 200}, "result": {"items": [ITEM, 5], "total": 30}})], schemas.SEARCH_RESPONSE)
    sightings, pages = parse_search(df)
    r = sightings.collect()
    assert len(r) == 1
    r = r[0]
    assert (r["external_id"], r["name"], r["address"]) == ("90210", "Заря", "Дальняя, 7")
    assert r["categories"] == ["Маникюр", "Педикюр"]
    assert (r["phone"], r["website"], r["social_links"]) == (
        "+7 900 000-00-01", "place.example/nails", ["vk.com/zarya", "insta"])
    assert (r["latitude"], r["longitude"], r["working_hours"]) == (54.7, 20.5, '{"a":2,"b":1}')
    p = pages.first()
    assert (p["status"], p["n_items"], p["total"], p["has_next_page"]) == ("ok", 1, 30, True)


@pytest.mark.parametrize(
    "body, status, more",
    [
        ({"meta": {"code": 404}}, "empty", False),
        ({"meta": {"code": 403, "error": {"message": "no"}}}, "error", False),
        ({"meta": {"code": 200}}, "error", False),
        ({"result": {"items": {}}}, "error", False),
        ({"result": {"items": [], "total": 50}}, "ok", False),
        ({"result": {"items": [{"id": "a"}]}}, "ok", False),
        ({"result": {}}, "ok", False),
    ],
)
def test_search_envelope(frame, body, status, more):
    _, pages = parse_search(frame([response(body)], schemas.SEARCH_RESPONSE))
    p = pages.first()
    assert (p["status"], p["has_next_page"]) == (status, more)


def test_address_string_and_object(frame):
    items = [{"id": 1, "address": "Улица, 1", "address_name": "x"}, {"id": 2, "address": {"name": "Дом"}},
             {"id": 3, "address": "", "address_name": "Запас"}, {"id": 4}]
    df = frame([response({"result": {"items": items}})], schemas.SEARCH_RESPONSE)
    got = {r["external_id"]: r["address"] for r in parse_search(df)[0].collect()}
    assert got == {"1": "Улица, 1", "2": "Дом", "3": "Запас", "4": None}


def test_wider_categories(spark):
    body = '{"rubrics":[{"name":"A"},{"alias":"b"},{"x":1}],"categories":["C","",null,{"name":"","alias":"D"}]}'
    got = spark.createDataFrame([(body,)], "v string").select(category_names(J.lenient("v"))).first()[0]
    assert got == ["A", "b", "C", "D"]


def test_scan_coverage(frame):
    rows = [
        {"grid_cell_id": 1, "query": "q", "page": 1, "n_items": 10, "has_next_page": True},
        {"grid_cell_id": 1, "query": "q", "page": 2, "n_items": 10, "has_next_page": True},
        {"grid_cell_id": 2, "query": "q", "page": 1, "n_items": 3, "has_next_page": False},
    ]
    df = frame(rows, "grid_cell_id bigint, query string, page int, n_items bigint, has_next_page boolean")
    got = {r["grid_cell_id"]: r for r in scan_coverage(df, max_pages=2).collect()}
    assert (got[1]["pages_read"], got[1]["items_seen"], got[1]["cut_by_limit"]) == (2, 20, True)
    assert (got[2]["has_more"], got[2]["cut_by_limit"]) == (False, False)


def test_details_contacts(frame):
    contacts = [
        {"type": "phone", "value": "+7 900 000-00-01"}, {"type": "phone", "value": "8 (900) 000-00-01"},
        {"type": "website", "value": "place.example/nails"}, {"type": "social", "value": "vk.com/zarya"},
        {"type": "email", "value": "hello@example.ru", "comment": "c"}, {"type": "email", "value": "bad"},
    ]
    item = {"id": "b1", "name": "N", "full_address_name": "", "address_name": "A", "org": {"id": 5, "a": 1},
            "contact_groups": [{"contacts": contacts}], "last_update": "2024"}
    body = {"meta": {"code": 200}, "result": {"items": [item]}}
    df = frame([{"id": 1, "salon_id": 9, "external_id": "e", "http_status": 200, "body": json.dumps(body)}],
               schemas.DETAILS_RESPONSE)
    details, found, outcomes = parse_details(df)
    assert outcomes.first()["status"] == "success"
    d = details.first()
    assert (d["full_address"], d["organization_id"], d["branch_id"], d["provider_updated_at"]) == (
        "A", "5", "b1", "2024")
    assert d["branch_info"] == '{"a":1,"id":5}'
    rows = [(r["contact_type"], r["display_value"]) for r in found.collect()]
    assert rows == [("phone", "+7 900 000-00-01"), ("website", "place.example/nails"), ("social", "vk.com/zarya"),
                    ("email", "hello@example.ru")]


@pytest.mark.parametrize(
    "http, body, status",
    [
        (200, {"meta": {"code": 404}}, "not_found"), (200, {"meta": {"code": 401}}, "unauthorized"),
        (200, {"meta": {"code": 500}}, "provider_error"), (200, {"meta": {"code": 200}}, "parser_error"),
        (200, {"result": {"items": []}}, "parser_error"), (200, {"result": {"items": [1]}}, "parser_error"),
        (200, {"result": {"items": {}}}, "parser_error"), (404, {}, "not_found"), (403, {}, "unauthorized"),
        (429, {}, "rate_limited"), (503, {}, "transient_error"), (418, {}, "provider_error"),
        (200, {"result": {"items": [{}]}}, "success"),
    ],
)
def test_details_outcomes(frame, http, body, status):
    df = frame([{"id": 1, "http_status": http, "body": json.dumps(body)}], schemas.DETAILS_RESPONSE)
    assert parse_details(df)[2].first()["status"] == status


def test_links_and_frontier(frame):
    page = (
        '<a href="/price">p</a><A class="x" href="/price#a">p</A><a href=\'services?x=1&amp;key=s\'>s</a>'
        '<a href="https://other.ru/price">o</a><a href="/about">a</a><a href="/маникюр/">m</a><a href="/prices2">z</a>'
    )
    df = frame([{"id": 1, "source_url": "Salon.ru/home/", "html": page}], "id int, source_url string, html string")
    df = df.withColumn("source_url", F.concat(F.lit("https://"), "source_url"))
    links = [r["url"] for r in internal_links(df, "id").orderBy("pos").collect()]
    assert links == [
        "https://Salon.ru/price", "https://Salon.ru/price", "https://Salon.ru/home/services?x=1&key=s",
        "https://Salon.ru/маникюр/", "https://Salon.ru/prices2"]
    got = [(r["page_no"], r["url"]) for r in crawl_frontier(df, "id").orderBy("page_no").collect()]
    assert got == [
        (1, "https://Salon.ru/home/"), (2, "https://Salon.ru/price"),
        (3, "https://Salon.ru/home/services?x=1&key=REDACTED"), (4, "https://Salon.ru/маникюр/")]


def test_log_counters(frame):
    rows = ["2GIS HTTP status: 200", "x 2GIS HTTP status: 200 y", "2GIS payload meta.code: 404", "noise",
            "2GIS HTTP status: 429"]
    got = {r["kind"]: r["counter"] for r in log_counters(frame([{"message": m} for m in rows], "message string")).collect()}
    assert got == {"http_status": {200: 2, 429: 1}, "payload_code": {404: 1}}


def test_query_profiles(spark):
    assert [r["query"] for r in D.query_profile(spark, "reduced_ru_en_v1").orderBy("pos").collect()] == [
        "маникюр", "nail studio"]
    assert D.query_list(None, ["a", " "]) == ("explicit", ["a"])
    assert len(D.query_list()[1]) == 5
    with pytest.raises(ValueError):
        D.query_list(None, [" "])
    with pytest.raises(ValueError):
        D.query_list("nope")


def test_region_dimension_and_sync(spark, frame):
    listed = D.regions(spark)
    assert listed.count() == 89 and listed.filter("iso3166_2 IS NOT NULL").count() == 85
    current = frame(
        [{"id": 1, "name": "B", "scan_order": 1, "status": "completed"},
         {"id": 2, "name": "Z", "scan_order": 2, "status": "pending"}],
        "id bigint, name string, scan_order bigint, status string")
    new = frame([{"name": "A", "scan_order": 1}, {"name": "B", "scan_order": 2}], "name string, scan_order bigint")
    got = {r["name"]: (r["id"], r["scan_order"], r["status"]) for r in D.sync_regions(current, new).collect()}
    assert got == {"A": (None, 1, "pending"), "B": (1, 2, "completed"), "Z": (2, -2, "pending")}


def test_key_resolution(frame):
    elements = frame(
        [
            {"type": "relation", "id": 1, "tags": {"boundary": "administrative", "ISO3166-2": "X-A", "name": "A"}},
            {"type": "relation", "id": 2, "tags": {"boundary": "administrative", "name": "B"}},
            {"type": "relation", "id": 3, "tags": {"boundary": "administrative", "name": "B"}},
            {"type": "way", "id": 4, "tags": {"boundary": "administrative", "name": "C"}},
            {"type": "relation", "id": 5, "tags": {"boundary": "administrative", "name": "D alt"}},
        ],
        "type string, id bigint, tags map<string,string>")
    meta = frame(
        [{"name": "A", "iso3166_2": "X-A"}, {"name": "B"}, {"name": "C"}, {"name": "D", "aliases": ["D alt"]},
         {"name": "E", "iso3166_2": "X-A"}],
        "name string, iso3166_2 string, aliases array<string>")
    keys = candidate_keys(administrative_relations(elements))
    got = {r["name"]: (r["status"], r["id"], r["kind"]) for r in resolve_keys(D.region_keys(meta), keys).collect()}
    assert got == {
        "A": ("resolved", 1, "iso"), "B": ("ambiguous", None, "name"), "C": ("unresolved", None, None),
        "D": ("resolved", 5, "name"), "E": ("resolved", 1, "iso")}


def test_short_names(frame):
    df = frame([{"name": "Псковская область", "aliases": ["P"]}, {"name": "Республика Коми"}, {"name": "Москва"}],
               "name string, aliases array<string>").fillna({})
    got = {r["name"]: r["aliases"] for r in D.with_short_names(df.withColumn("aliases", F.coalesce("aliases", F.array()))).collect()}
    assert got == {"Псковская область": ["Псковская обл.", "P"], "Республика Коми": ["Коми"], "Москва": []}


def test_schema_evolution(frame):
    old = frame([{"id": 1}], "id bigint")
    wide = add_missing_columns(old, "id bigint, status string, n int", {"status": "pending"})
    assert wide.first().asDict() == {"id": 1, "status": "pending", "n": None}
    new = frame([{"id": 2, "status": "x"}], "id bigint, status string")
    got = {r["id"]: r["status"] for r in union_evolved(old, new, {"status": "pending"}).collect()}
    assert got == {1: "pending", 2: "x"}


def test_readers(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "a.json").write_text(json.dumps(response({"result": {"items": [ITEM]}})))
    assert parse_search(search_responses(spark, str(tmp_path / "s")))[0].count() == 1
    (tmp_path / "b").mkdir()
    square = [[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]
    hole = [[0.2, 0.2], [0.4, 0.2], [0.4, 0.4], [0.2, 0.2]]
    doc = {"region_id": 1, "geometry": {"type": "MultiPolygon", "coordinates": [[square, hole], [square]]}}
    (tmp_path / "b" / "r.json").write_text(json.dumps(doc, indent=1))
    rings = boundaries(spark, str(tmp_path / "b")).first()["rings"]
    assert [r["is_hole"] for r in rings] == [False, True, False]
    assert rings[1]["points"][1]["lon"] == 0.4
    assert len({r["ring_id"] for r in rings}) == 3
