"""Declared schemas (DDL); nothing in the library infers a schema."""

SOURCE_ERROR = "STRUCT<source: STRING, kind: STRING, detail: STRING>"

CANDIDATES = (
    "profile STRING, source STRING, item_id STRING, title STRING, abstract STRING, source_url STRING, "
    "published TIMESTAMP, categories ARRAY<STRING>, source_tag STRING, feed_name STRING"
)

SCORES = (
    "profile STRING, item_id STRING, score INT, confidence DOUBLE, reason STRING, filter_tags ARRAY<STRING>, "
    "batch_id BIGINT, batch_ok BOOLEAN"
)

TIER1 = "STRUCT<contributions: ARRAY<STRING>, method: STRING, result: STRING, relevance: STRING>"
TIER3 = (
    "STRUCT<claims: ARRAY<STRING>, datasets: ARRAY<STRING>, builds_on: ARRAY<STRING>, "
    "open_questions: ARRAY<STRING>, potential_connections: ARRAY<STRING>>"
)
RELEVANCE = "ARRAY<STRUCT<profile: STRING, score: INT, reason: STRING>>"
REPAIR = (
    "STRUCT<tier2_attempts: INT, tier2_last_stage: STRING, tier2_last_error: STRING, "
    "tier3_attempts: INT, tier3_last_stage: STRING, tier3_last_error: STRING, "
    "archive_attempts: INT, archive_last_kind: STRING, archive_last_error: STRING>"
)

NOTES = (
    "note_id STRING, version BIGINT, title STRING, slug STRING, path STRING, source_url STRING, "
    "tags ARRAY<STRING>, confidence DOUBLE, archive_path STRING, summary STRING, full_text STRING, "
    f"tier1 {TIER1}, tier3 {TIER3}, relevance {RELEVANCE}, repair {REPAIR}, "
    "user_notes STRING, updated_at TIMESTAMP"
)

RUNS = (
    "run_id STRING, profile STRING, kind STRING, status STRING, run_range MAP<STRING, STRING>, "
    "started_at STRING, completed_at STRING, duration_seconds DOUBLE, sources_checked INT, ingested INT, "
    f"error STRING, degraded BOOLEAN, degraded_reasons ARRAY<STRING>, "
    f"source_acquisition_errors ARRAY<{SOURCE_ERROR}>"
)

COLLISIONS = (
    "timestamp STRING, run_id STRING, profile STRING, source STRING, source_url STRING, title STRING, detail STRING"
)

LOGS = (
    "timestamp STRING, level STRING, logger STRING, message STRING, run_id STRING, profile STRING, note_id STRING, "
    "sweep_stage STRING, store_status STRING, status STRING, exc_type STRING, stage STRING, kind STRING, "
    "detail STRING, source_url STRING, title STRING"
)

EDGES = "type STRING, source_note_id STRING, target_note_id STRING, evidence STRUCT<kind: STRING, score: DOUBLE>"

PROFILES = (
    "profile STRING, description STRING, enabled BOOLEAN, relevance INT, full_text INT, deep_extract INT, "
    "notify_immediate INT, edge_score DOUBLE"
)

SOURCES = (
    "profile STRING, kind STRING, source_key STRING, feed_name STRING, source_tag STRING, enabled BOOLEAN, "
    "max_results INT, lookback_days INT"
)

SINKS = (
    "name STRING, type STRING, event_mode STRING, enabled BOOLEAN, notify_on ARRAY<STRING>, min_score INT, "
    "url STRING, context STRING, sender_name STRING, deliver BOOLEAN, wake_mode STRING, channel STRING"
)

ATOM_ENTRY = (
    "id STRING, title STRING, summary STRING, published STRING, updated STRING, "
    "category ARRAY<STRUCT<_term: STRING>>, link ARRAY<STRUCT<_href: STRING, _rel: STRING>>"
)
RSS_ITEM = "title STRING, link STRING, guid STRING, pubDate STRING, description STRING"

SCORE_RESPONSE = "results ARRAY<STRUCT<id: STRING, score: DOUBLE, tags: ARRAY<STRING>, reason: STRING>>"
CHAT_RESPONSE = "choices ARRAY<STRUCT<message: STRUCT<content: STRING>>>"
