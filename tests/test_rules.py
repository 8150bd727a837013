"""The entity classifier and the service matcher: one own example for each line of their tables.

Examples are put together from the word tables, so they follow a table that changes.
"""

import pytest

from placeledger.fixed_values import ENTITY_WORDS, SERVICE_WORDS
from placeledger.operators.classify import classify_entities
from placeledger.operators.service import match_service

ENTITY = "id int, name string, categories array<string>, description string, address string"


def word(key, k=0):
    return ENTITY_WORDS[key][k]


NAILS, SALONS, OTHER = word("strong_category"), word("allowed_category"), word("unrelated", 6)

# what it shows, name, categories, description, accepted, profile, rejection
ENTITIES = [
    ("a rented place", "Точка А", [NAILS], word("coworking", 3), False, "unknown", "coworking_or_rental"),
    ("a rented place outweighs a home", "Точка Б", [NAILS], f"{word('coworking')} {word('home_master')}", False, "unknown",
     "coworking_or_rental"),
    ("a private master", "Точка В", [NAILS], word("home_master"), False, "unknown", "home_or_private_master"),
    ("no sign of the service", f"{word('generic_name')} Заря", [SALONS], None, False, "unknown", "no_manicure_signal"),
    ("another trade by name and category", f"{OTHER} Заря", [NAILS, OTHER], None, False, "mixed_non_salon", "mixed_non_salon"),
    ("a beauty name outweighs the other trade", f"{OTHER} {word('beauty_name')}", [NAILS, OTHER], None, True,
     "mixed_beauty_salon", None),
    ("teaching only", "Заря", [NAILS], word("training", 1), False, "unknown", "training_only"),
    ("teaching beside an allowed category", "Заря", [NAILS, SALONS], word("training", 1), True, "mixed_beauty_salon", None),
    ("supplies, though the name has nails", f"{word('supply', 2)} {word('nail_name')}", [NAILS], None, False, "unknown",
     "beauty_supply_without_service"),
    ("a nail name", f"Заря {word('nail_name', 2)}", ["Разное"], None, True, "nail_specialist", None),
    ("a generic name", f"{word('generic_name', 1)} Заря", [NAILS], None, True, "mixed_beauty_salon", None),
    ("an allowed category", "Заря", [NAILS, SALONS], None, True, "mixed_beauty_salon", None),
    ("an allowed category beside another trade", "Заря", [NAILS, SALONS, OTHER], None, False, "mixed_non_salon", "mixed_non_salon"),
    ("only the nail category", "Заря", [NAILS], None, True, "nail_specialist", None),
    ("only the description", "Заря", ["Разное"], word("nail_name", 3), False, "unknown", "no_salon_or_studio_signal"),
]


def test_entity_lines(frame):
    rows = [{"id": i, "name": e[1], "categories": e[2], "description": e[3]} for i, e in enumerate(ENTITIES)]
    got = {r["id"]: r for r in classify_entities(frame(rows, ENTITY)).collect()}
    for i, (shows, name, _, _, accepted, profile, rejection) in enumerate(ENTITIES):
        r = got[i]
        assert (r["accepted"], r["business_profile"], r["rejection_reason"]) == (accepted, profile, rejection), shows
        assert r["decision_name"] == name


def test_reasons_and_confidence(frame):
    rows = [{"id": 0, "name": f"{OTHER} Заря", "categories": [OTHER, NAILS]},
            {"id": 1, "name": "Заря", "categories": [NAILS], "address": word("home_master", 2)}]
    got = {r["id"]: r for r in classify_entities(frame(rows, ENTITY)).collect()}
    assert got[0]["reason_codes"] == ["manicure_signal", "unrelated_primary_name_signal", "unrelated_primary_category_signal"]
    assert got[0]["confidence"] == 0.9
    assert got[1]["rejection_reason"] == "home_or_private_master"


def needle(key, k=0):
    return SERVICE_WORDS[key][k]


BASE, COATING = needle("base"), needle("coating", 1)


@pytest.mark.parametrize(
    "name, context, status, confidence, reason",
    [
        (f"{BASE} и {COATING}", None, "matched", "high", "manicure_signal"),
        (BASE, f"у нас есть {COATING}", "matched", "high", "manicure_signal"),
        (needle("strong", 6), None, "matched", "high", "manicure_signal"),
        (f"{BASE} быстро", None, "excluded", "high", "manicure_without_coating_signal"),
        (COATING, None, "ambiguous", "medium", "coating_without_manicure_signal"),
        (f"{needle('negative')} {BASE} {COATING}", None, "excluded", "high", "excluded_service_signal"),
        (f"{needle('men')} {BASE} {COATING}", None, "matched", "high", "mens_manicure_equivalent"),
        (f"{needle('package', 1)} {BASE} {COATING}", None, "ambiguous", "low", "package_service_signal"),
        (needle("unrelated", 1), None, "excluded", "high", "unrelated_service"),
        (f"{BASE} {COATING} documents", None, "excluded", "high", "excluded_service_signal"),
        ("вход со двора", None, "unrelated", "low", "no_target_signal"),
        ("...", None, "unrelated", "low", "empty_service"),
    ],
)
def test_service_lines(frame, name, context, status, confidence, reason):
    m = match_service(frame([{"n": name, "c": context}], "n string, c string"), "n", "c").first()["match"]
    assert (m["status"], m["confidence"], m["reason_codes"][0]) == (status, confidence, reason)
