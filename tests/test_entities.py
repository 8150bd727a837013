"""Identity, merge, contact state, backfill, comparison, reports."""

from datetime import datetime

from pyspark.sql import functions as F

from placeledger import schemas
from placeledger.operators.backfill import backfill_counters, backfill_plan
from placeledger.operators.compare import compare_profiles, profile_differences, profile_ids
from placeledger.operators.contact_state import merge_contacts
from placeledger.operators.identity import connected_components, match_existing
from placeledger.operators.joins import lookup
from placeledger.operators.merge import duplicate_ids, merge_sightings
from placeledger.plans.reports import accepted_report


def as_of():
    return F.lit(datetime(2024, 1, 2)).cast("timestamp_ntz")


def sighting(seq, **kw):
    return {"seq": seq, "region_id": 1, "external_source": "2GIS", "name": "Студия Лак", "categories": ["Маникюр"],
            "social_links": [], "fetched_at": datetime(2024, 1, 1, 0, 0, seq), **kw}


def test_batch_merge_and_rerun(spark, frame):
    rows = [
        sighting(1, address="Улица 1", phone="8 900 000-00-00", website="a"),
        sighting(2, address="улица, 1"),                       # same name and address
        sighting(3, external_id="x", phone="+7 900 0000000"),   # same name and phone
        sighting(4, external_id="x", name="Лак 2", description="d"),  # same id
        sighting(5, external_id="y", name="Кафе", categories=["Кафе"]),  # rejected, but has an id
        sighting(6, name="Бар", categories=["Бар"]),            # rejected, history only
    ]
    batch = frame(rows, schemas.SIGHTING)
    table, decided = merge_sightings(frame([], schemas.SALON), batch, as_of())
    got = {r["external_id"]: r for r in table.collect()}
    assert set(got) == {"x", "y"}
    x = got["x"]
    assert (x["name"], x["address"], x["website"], x["phone"], x["description"], x["filter_status"]) == (
        "Лак 2", "улица, 1", "a", "79000000000", "d", "accepted")
    assert (x["first_seen_at"], x["verification_status"]) == (datetime(2024, 1, 1, 0, 0, 1), "not_checked")
    flags = {r["seq"]: (r["merged"], r["entity_id"] is None) for r in decided.collect()}
    assert flags == {1: (False, False), 2: (True, False), 3: (True, False), 4: (True, False), 5: (False, False), 6: (False, True)}
    again, _ = merge_sightings(table, batch, as_of())
    assert {r["id"] for r in again.collect()} == {r["id"] for r in got.values()}
    assert duplicate_ids(again).isEmpty()


def test_match_levels(frame):
    obs = "seq bigint, region_id bigint, external_source string, external_id string, normalized_name string, " \
          "normalized_address string, normalized_phone string, latitude double, longitude double"
    current = frame(
        [{"id": 5, "region_id": 1, "external_source": "s", "external_id": "a", "normalized_name": "n", "normalized_address": "x",
          "phone": "7", "latitude": 1.000001, "longitude": 2.0},
         {"id": 6, "region_id": 1, "external_source": "s", "external_id": "b", "normalized_name": "n", "normalized_address": "x"}],
        schemas.SALON)
    rows = [
        {"seq": 1, "region_id": 2, "external_source": "s", "external_id": "b"},
        {"seq": 2, "region_id": 1, "external_source": "s", "external_id": "zz", "normalized_name": "n", "normalized_address": "x"},
        {"seq": 3, "region_id": 1, "normalized_name": "n", "normalized_phone": "7"},
        {"seq": 4, "region_id": 1, "normalized_name": "n", "latitude": 1.0, "longitude": 2.0},
        {"seq": 5, "region_id": 2, "normalized_name": "n", "normalized_address": "x"},
        {"seq": 6, "external_source": "s", "external_id": ""},
    ]
    got = {r["seq"]: (r["entity_id"], r["level"]) for r in match_existing(frame(rows, obs), current).collect()}
    assert got == {1: (6, 0), 2: (5, 1), 3: (5, 2), 4: (5, 3), 5: (None, None), 6: (None, None)}


def test_components_of_long_chain_and_hub(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(1, i) for i in range(2, 60)] + [(1000, 1000)]
    edges = spark.createDataFrame(chain + hub, "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert all(got[i] == 100 for i in range(100, 161)) and all(got[i] == 1 for i in range(1, 60)) and got[1000] == 1000


def test_contact_state_deactivates_only_checked(frame):
    old = [{"id": i, "salon_id": s, "contact_type": "phone", "normalized_value": str(i), "display_value": str(i), "source": "2GIS",
            "is_active": True, "first_seen_at": datetime(2023, 1, 1), "last_seen_at": datetime(2023, 1, 1)}
           for i, s in ((1, 1), (2, 1), (3, 2), (4, 3))]
    new = frame([{"salon_id": 1, "contact_type": "phone", "normalized_value": "1", "display_value": "one", "source": "2GIS", "pos": 0},
                 {"salon_id": 1, "contact_type": "email", "normalized_value": "e", "display_value": "e", "source": "2GIS", "pos": 1}],
                "salon_id bigint, contact_type string, normalized_value string, display_value string, source string, pos int")
    checked = frame([{"salon_id": 1, "source": "2GIS"}, {"salon_id": 3, "source": "2GIS"}], "salon_id bigint, source string")
    got = {(r["salon_id"], r["normalized_value"]): (r["is_active"], r["change"], r["display_value"])
           for r in merge_contacts(frame(old, schemas.CONTACT), checked, new, as_of()).collect()}
    assert got == {
        (1, "1"): (True, "updated", "one"), (1, "2"): (False, "deactivated", "2"), (1, "e"): (True, "created", "e"),
        (2, "3"): (True, "unchanged", "3"), (3, "4"): (False, "deactivated", "4")}


def test_backfill_latest_decision(frame):
    disc = [{"id": i, "raw_result_id": i, "region_id": 1, "grid_cell_id": i % 2, "query": "q", "external_source": "s", "external_id": e,
             "filter_status": st, "classifier_reason_codes": [st], "business_profile": "unknown"}
            for i, (e, st) in enumerate([("a", "rejected"), ("a", "accepted"), ("b", "rejected"), ("c", "accepted"), (" ", "rejected")])]
    raw = frame([{"id": 1, "payload": '{"name":"A","rubrics":[{"alias":"z"}]}'}, {"id": 2, "payload": "bad", "name": "B raw"}], schemas.RAW_RESULT)
    salons = frame([{"id": 9, "external_source": "s", "external_id": "b", "filter_status": "rejected", "business_profile": "unknown",
                     "classifier_reason_codes": ["rejected"]}], schemas.SALON)
    plan = backfill_plan(frame(disc, schemas.DISCOVERY), raw, salons)
    got = {r["external_id"]: r for r in plan.collect()}
    assert {k: (v["action"], v["name"], v["new_status"], v["conflicting_decisions"]) for k, v in got.items()} == {
        "a": ("create", "A", "accepted", True), "b": ("unchanged", "B raw", "rejected", False)}
    assert got["a"]["org"]["categories"] == ["z"] and got["a"]["distinct_cells"] == 2
    assert backfill_counters(plan).first().asDict() == {
        "processed": 2, "created": 1, "updated": 0, "unchanged": 1, "skipped": 0, "conflicts": 1}


def test_profile_comparison(frame):
    rows = [{"cell_id": 1, "profile": p, "external_id": e, "accepted": True, "seq": i}
            for i, (p, e) in enumerate([("f", "a"), ("f", "b"), ("r", "a")])] + [{"cell_id": 2, "profile": "f", "external_id": "", "seq": 9}]
    ids = profile_ids(frame(rows, schemas.PROFILE_SIGHTING), "f", "r")
    got = {r["cell_id"]: r for r in compare_profiles(ids).collect()}
    assert (got[1]["jaccard"], got[1]["missing_from_reduced"], got[1]["accepted_missing"], got[2]["jaccard"]) == (0.5, 1, 1, 1.0)
    assert [tuple(r) for r in profile_differences(ids).collect()] == [(1, "b", "missing_from_reduced", True)]


def test_report_has_no_row_multiplication(frame):
    salons = frame([{"id": 1, "region_id": 1, "name": "N", "filter_status": "accepted", "verification_status": "error", "source": "2GIS"}], schemas.SALON)
    regions = frame([{"id": 1, "name": "R", "scan_order": 1}], "id bigint, name string, scan_order int")
    contacts = frame(
        [{"id": i, "salon_id": 1, "contact_type": t, "display_value": v, "is_active": a}
         for i, (t, v, a) in enumerate([("website", "w", True), ("phone", " 1 ", True), ("phone", "1", True), ("social", "s", True), ("phone", "9", False)])],
        schemas.CONTACT)
    prices = frame([{"id": i, "salon_id": 1, "service_key": "basic_manicure_with_coating", "price_type": "from", "amount_minor": 150000 + i,
                     "is_active": i < 2} for i in range(3)], schemas.PRICE)
    r = accepted_report(salons, regions, contacts, prices).collect()
    assert len(r) == 1
    assert (r[0]["phones"], r[0]["links"], r[0]["price"], r[0]["price_status"]) == (["1"], ["s", "w"], "от 1500", "from")


def test_hot_key_join_is_split(spark):
    """A key with most of the rows is spread over tasks, although the unique side is an
    aggregate by that key."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        many = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        one = spark.range(0, 1000).groupBy((F.col("id") % 1000).alias("k")).agg(F.max("id").alias("m"))
        joined = lookup(many, one, "k")
        assert len(joined.collect()) == 60000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
