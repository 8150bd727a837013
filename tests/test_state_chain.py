"""State operators on their own output, and inputs that used to break readers and sinks."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from placeledger import schemas
from placeledger.functions import jsons as J
from placeledger.functions.prices import amount_to_minor
from placeledger.operators.contact_state import merge_contacts
from placeledger.operators.merge import merge_sightings
from placeledger.operators.nearby import points_within
from placeledger.operators.numbering import number_rows
from placeledger.operators.price_state import merge_prices
from placeledger.plans.reports import contact_lists, newest_prices
from placeledger.sources.readers import boundaries
from placeledger.sources.sinks import read_snapshot, report_path, write_reports, write_snapshot
from placeledger.streaming import flows

PRICE = (
    "id bigint, salon_id bigint, service_key string, source_type string, evidence_text string, service_name_raw string, "
    "amount_minor bigint, currency string, price_type string, range_min_minor bigint, range_max_minor bigint, "
    "source_url string, is_active boolean, first_seen_at timestamp_ntz, last_seen_at timestamp_ntz"
)
RESULT = "salon_id bigint, service_key string, extraction_status string, source_type string, evidence_text string, amount_minor bigint, price_type string"
CONTACT = (
    "id bigint, salon_id bigint, contact_type string, normalized_value string, source string, display_value string, "
    "is_active boolean, first_seen_at timestamp_ntz, last_seen_at timestamp_ntz"
)
SERVICE = "basic_manicure_with_coating"


def at(day):
    return F.lit(datetime(2024, 6, day)).cast("timestamp_ntz")


def test_prices_survive_a_second_run(frame):
    def result(salon, amount, status="found"):
        return {"salon_id": salon, "service_key": SERVICE, "extraction_status": status, "source_type": "t", "evidence_text": "e",
                "amount_minor": amount, "price_type": "exact"}

    one = merge_prices(frame([], PRICE), frame([result(1, 100), result(2, 200)], RESULT), at(1)).drop("change")
    two = merge_prices(one, frame([result(1, 150)], RESULT), at(2))
    rows = {r["salon_id"]: r for r in two.collect()}
    assert [(rows[s]["id"], rows[s]["amount_minor"], rows[s]["is_active"], rows[s]["change"]) for s in (1, 2)] == [
        (1, 150, True, "updated"), (2, 200, True, "unchanged")]
    assert rows[1]["first_seen_at"] == datetime(2024, 6, 1) and rows[2]["last_seen_at"] == datetime(2024, 6, 1)
    shown = {r["salon_id"]: r["price"]["amount_minor"] for r in newest_prices(two).collect()}
    assert shown == {1: 150, 2: 200}


def test_stored_prices_without_ids_keep_their_values(frame):
    old = [{"id": None, "salon_id": s, "service_key": SERVICE, "source_type": "t", "evidence_text": "e", "amount_minor": 100 * s,
            "price_type": "exact", "is_active": True, "first_seen_at": datetime(2024, 1, s)} for s in (1, 2)]
    table = frame(old, PRICE)
    assert {r["salon_id"]: r["price"]["amount_minor"] for r in newest_prices(table).collect()} == {1: 100, 2: 200}
    merged = merge_prices(table, frame([], RESULT), at(2))
    assert sorted((r["id"], r["salon_id"], r["amount_minor"], r["is_active"]) for r in merged.collect()) == [
        (1, 1, 100, True), (2, 2, 200, True)]


def test_contacts_are_listed_in_order_of_arrival(frame):
    incoming = frame([{"salon_id": 1, "contact_type": "phone", "normalized_value": v, "source": "s", "display_value": v, "pos": p}
                      for p, v in enumerate(["9", "1", "5", "9"])],
                     "salon_id bigint, contact_type string, normalized_value string, source string, display_value string, pos bigint")
    checked = frame([{"salon_id": 1, "source": "s"}], "salon_id bigint, source string")
    first = merge_contacts(frame([], CONTACT), checked, incoming, at(1)).drop("change")
    again = merge_contacts(first, checked, incoming.filter("pos <> 1"), at(2)).drop("change")
    assert contact_lists(first).first()["phones"] == ["9", "1", "5"]
    assert contact_lists(again).first()["phones"] == ["9", "5"]
    assert sorted(r["id"] for r in again.collect()) == [1, 2, 3]


def sightings(frame, ids, when=1):
    rows = [{"external_source": "2GIS", "external_id": i, "name": f"Студия {i}", "categories": ["Маникюр"], "social_links": [], "region_id": 1,
             "page": 1, "item_pos": n, "discovered_grid_cell_id": 1, "discovered_query": "q", "fetched_at": datetime(2024, 1, when)}
            for n, i in enumerate(ids)]
    return frame(rows, (
        "region_id bigint, page int, item_pos int, external_source string, external_id string, name string, address string, latitude double, "
        "longitude double, phone string, website string, social_links array<string>, categories array<string>, description string, "
        "working_hours string, branch_info string, raw_payload string, source_url string, discovered_query string, "
        "discovered_grid_cell_id bigint, fetched_at timestamp_ntz"))


def test_items_of_one_response_stay_apart(frame):
    table, decided = merge_sightings(frame([], schemas.SALON), sightings(frame, ["a", "b", "c", "a"]), at(1))
    assert sorted((r["id"], r["external_id"]) for r in table.collect()) == [(1, "a"), (2, "b"), (3, "c")]
    assert sorted(r["seq"] for r in decided.collect()) == [0, 1, 2, 3]
    more, _ = merge_sightings(table, sightings(frame, ["d", "b"], 2), at(2))
    assert sorted((r["id"], r["external_id"]) for r in more.collect()) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]


def test_a_repeated_seq_is_refused(frame):
    with pytest.raises(ValueError, match="seq"):
        merge_sightings(frame([], schemas.SALON), sightings(frame, ["a", "b"]).withColumn("seq", F.lit(7).cast("bigint")), at(1))


def test_numbers_follow_the_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    got = number_rows(df, "n", "k", start=5).collect()
    assert sorted((r["k"], r["n"]) for r in got) == [(k, k + 5) for k in range(1000)]
    assert number_rows(df.filter("false"), "n", "k").collect() == []


def test_another_stream_is_merged_though_its_batches_start_at_zero(spark, frame, tmp_path):
    root = str(tmp_path / "salons")
    write_snapshot(frame([], schemas.SALON), root, "empty")
    for name in ("a", "b"):
        landing = str(tmp_path / name)
        sightings(frame, [name]).write.parquet(landing)
        stream = spark.readStream.schema(spark.read.parquet(landing).schema).parquet(landing)
        for _ in range(2):
            flows.merge_available(stream, root, str(tmp_path / f"state-{name}"), at(1), history=str(tmp_path / "history")).awaitTermination()
    assert sorted(r["external_id"] for r in read_snapshot(spark, root).collect()) == ["a", "b"]
    assert sorted(r["external_id"] for r in spark.read.parquet(str(tmp_path / "history")).collect()) == ["a", "b"]


@pytest.mark.parametrize("centre, point, near", [
    ((65.0, 179.99), (65.0, -179.99), True), ((65.0, -179.99), (65.0, 179.99), True), ((0.0, 180.0), (0.0, -180.0), True),
    ((65.0, 539.99), (65.0, -179.99), True), ((65.0, 179.0), (65.0, -179.0), False), ((89.9, 10.0), (89.9, -170.0), False),
    ((10.0, 20.0), (10.0, 20.005), True),
])
def test_circles_cross_the_meridian(frame, centre, point, near):
    kind = "id int, lat double, lon double"
    found = points_within(frame([{"id": 1, "lat": centre[0], "lon": centre[1]}], kind).withColumnRenamed("id", "c"),
                          frame([{"id": 2, "lat": point[0], "lon": point[1]}], kind).withColumnRenamed("id", "p"), 3000, "c", "p").collect()
    assert len(found) == int(near)


def test_boundaries_of_very_many_polygons(spark, tmp_path):
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    document = {"region_id": 1, "geometry": {"type": "MultiPolygon", "coordinates": [[ring]] * 22_000 + [[ring, ring]]}}
    (tmp_path / "r.json").write_text(json.dumps(document))
    rings = boundaries(spark, str(tmp_path)).select(F.explode("rings").alias("r")).agg(
        F.count("*"), F.countDistinct("r.ring_id"), F.count_if("r.is_hole")).first()
    assert tuple(rings) == (22_002, 22_002, 1)


def test_a_repeated_key_has_its_last_value(frame):
    row = frame([{"t": '{"a": 1, "b": {"c": 1, "c": 2}, "a": 3}'}], "t string").select(
        J.text_at(J.lenient("t"), "$.a"), J.text_at(J.lenient("t"), "$.b.c")).first()
    assert tuple(row) == ("3", "2")


@pytest.mark.parametrize("written, shown", [
    ("15000000.5", "15000000.5"), ("0.0001", "0.0001"), ("12345678901234567890123", "12345678901234567890123"), ("1500", "1500"),
    ("-7", "-7"), ("0", "0"), ("1e3", "1000"), ("2.50", "2.5"), ("1e-30", "1.0E-30"), ("9007199254740993", "9007199254740993"),
])
def test_numbers_in_plain_notation(frame, written, shown):
    assert frame([{"t": written}], "t string").select(J.scalar_text(J.lenient("t"))).first()[0] == shown


def test_amounts_in_other_digits(frame):
    texts = ["300", "٣٠٠", "१५०,5", "３００", "3oo", "²"]
    got = [r[0] for r in frame([{"t": t} for t in texts], "t string").select(amount_to_minor("t")).collect()]
    assert got == [30000, 30000, 15050, 30000, None, None]


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_a_failed_report_leaves_the_old_one(spark, frame, tmp_path, fmt):
    root = str(tmp_path / "report")
    accepted = frame([{"id": 1, "phones": ["1", "2"]}, {"id": 2, "phones": []}], "id bigint, phones array<string>")
    excluded = frame([{"id": 3}], "id bigint")

    def stored(name):
        return spark.read.format(fmt).option("header", True).load(report_path(spark, root, name))

    write_reports({"accepted": accepted, "excluded": excluded}, root, fmt)
    broken = accepted.withColumn("id", F.raise_error(F.lit("broken")).cast("bigint"))
    with pytest.raises(Exception, match="broken"):
        write_reports({"excluded": excluded.filter("false"), "accepted": broken}, root, fmt)
    assert stored("accepted").count() == 2 and stored("excluded").count() == 1
    if fmt == "csv":
        assert {r["phones"] for r in stored("accepted").collect()} == {"1; 2", None}
    write_reports({"accepted": accepted.filter("id = 1"), "excluded": excluded}, root, fmt, include_excluded=False)
    assert stored("accepted").count() == 1
    with pytest.raises(ValueError):
        write_reports({}, root, fmt)
