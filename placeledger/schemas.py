"""Schemas of the records that flow between operators (Spark DDL)."""

SIGHTING = """
    seq bigint, region_id bigint, external_source string, external_id string, name string,
    address string, latitude double, longitude double, phone string, website string,
    social_links array<string>, categories array<string>, description string,
    working_hours string, branch_info string, raw_payload string, source_url string,
    discovered_query string, discovered_grid_cell_id bigint, fetched_at timestamp_ntz
"""

SEARCH_RESPONSE = """
    grid_cell_id bigint, region_id bigint, query string, page int, source_url string,
    fetched_at timestamp_ntz, body string
"""

DETAILS_RESPONSE = """
    id bigint, salon_id bigint, external_id string, http_status int, source_url string, body string
"""

BOUNDARY = """
    region_id bigint, rings array<struct<ring_id:bigint,is_hole:boolean,
    points:array<struct<lon:double,lat:double>>>>
"""

DISCOVERY = """
    id bigint, salon_id bigint, raw_result_id bigint, region_id bigint, grid_cell_id bigint,
    query string, external_source string, external_id string, filter_status string,
    filter_confidence double, classifier_reason_codes array<string>, filter_reasons array<string>,
    rejection_reason string, business_profile string, classifier_decision_name string,
    classifier_decision_categories array<string>
"""

RAW_RESULT = """
    id bigint, region_id bigint, grid_cell_id bigint, query string, external_source string,
    external_id string, name string, payload string, fetched_at timestamp_ntz
"""

SALON = """
    id bigint, region_id bigint, grid_cell_id bigint, external_source string, source string,
    external_id string, name string, normalized_name string, address string,
    normalized_address string, city string, latitude double, longitude double, phone string,
    website string, social_links array<string>, categories array<string>, description string,
    masters_count string, raw_payload string, source_url string, filter_status string,
    filter_confidence double, classifier_reason_codes array<string>, rejection_reason string,
    business_profile string, salon_type string, classifier_version string,
    classifier_decision_name string, classifier_decision_categories array<string>,
    classified_at timestamp_ntz, first_seen_at timestamp_ntz, last_seen_at timestamp_ntz,
    created_at timestamp_ntz, updated_at timestamp_ntz, details_status string,
    details_error string, details_enriched_at timestamp_ntz, organization_id string,
    branch_id string, provider_updated_at string, verification_status string,
    service_name string, service_price string, price_min bigint, price_max bigint,
    price_source string, price_source_url string
"""

CONTACT = """
    id bigint, salon_id bigint, contact_type string, display_value string,
    normalized_value string, source string, is_active boolean, metadata map<string,string>,
    first_seen_at timestamp_ntz, last_seen_at timestamp_ntz
"""

PRICE = """
    id bigint, salon_id bigint, service_key string, service_name_raw string,
    service_name_normalized string, amount_minor bigint, currency string, price_type string,
    range_min_minor bigint, range_max_minor bigint, source_type string, source_url string,
    evidence_text string, confidence string, is_active boolean,
    first_seen_at timestamp_ntz, last_seen_at timestamp_ntz
"""

DETAIL_PAYLOAD = """
    id bigint, salon_id bigint, status string, sanitized_source_url string, raw_payload_json string
"""

FETCHED_PAGE = "url string, html string, fetch_error string, fetched_at timestamp_ntz"

WEB_PAGE = "salon_id bigint, page_no int, source_url string, html string, fetch_error string"

PROFILE_SIGHTING = """
    cell_id bigint, profile string, query string, page int, external_id string,
    accepted boolean, seq bigint
"""
