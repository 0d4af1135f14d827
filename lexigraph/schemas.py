"""Declared schemas of the stored tables."""

CORPUS = "id BIGINT, title STRING, text STRING, anchor_text ARRAY<STRUCT<id: BIGINT, text: STRING>>"
DOCUMENTS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
PAGES = "page_id BIGINT, url STRING, html STRING"
BENCHMARK = "item_id BIGINT, text STRING"
EVENTS = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)

QUERIES = "query_id BIGINT, query STRING"
