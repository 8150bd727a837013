"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from placeledger.session import build_session
from workload.catalog import QUERIES

HEADLINE = [
    "normalize_text", "visible_lines", "line_prices", "best_price_per_page", "crawl_pages", "classify_documents",
    "search_items_parse", "detail_contacts", "identity_match", "entity_components", "field_merge", "contact_state",
    "price_state", "extracted_prices", "backfill_actions", "reclassify_diff", "accepted_export", "region_summary",
    "profile_compare", "salons_in_radius", "grid_cell_rows", "next_open_cells",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
