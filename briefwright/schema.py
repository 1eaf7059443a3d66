"""Declared schemas of the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ITEM_DDL = """
    source STRING, source_type STRING, title STRING, url STRING, author STRING, content STRING,
    published_at TIMESTAMP, collected_at TIMESTAMP, score DOUBLE, tags ARRAY<STRING>, language STRING,
    arxiv_id STRING, extra STRING
"""
ITEM_COLUMNS = [part.split()[0] for part in ITEM_DDL.replace("\n", " ").split(",") if part.strip()]

SEEN_DDL = """content_hash STRING, source STRING, url STRING, title STRING, arxiv_id STRING,
    first_seen_at TIMESTAMP, last_seen_at TIMESTAMP"""
RUN_DDL = """run_id STRING, date STRING, phase STRING, started_at TIMESTAMP, finished_at TIMESTAMP,
    status STRING, result_json STRING, error STRING"""
FEEDBACK_DDL = """date STRING, rating DOUBLE, label STRING, report_quality STRING, issue_labels ARRAY<STRING>,
    source_quality STRUCT<action: STRING>, event_action STRUCT<action: STRING>,
    sample_action STRUCT<action: STRING>, item_action STRUCT<action: STRING>,
    topic_action STRUCT<action: STRING>"""
HEALTH_DDL = """date STRING, source STRING, success BOOLEAN, repair_status STRING,
    repair_actions ARRAY<STRING>, repair_notes ARRAY<STRING>, error STRING"""
QUEUE_DDL = "url STRING, added_at STRING, processed BOOLEAN, title STRING, priority STRING"

SOURCE_TYPES = ("rss", "api", "http_scrape", "browser_relay")

# defaults of missing fields
_DEFAULTS = {
    "title": "''", "url": "''", "author": "''", "content": "''", "score": "0D", "language": "'en'",
    "published_at": "current_timestamp()", "collected_at": "current_timestamp()",
    "tags": "cast(array() as array<string>)", "arxiv_id": "cast(null as string)", "extra": "'{}'",
}


def to_items(df: DataFrame) -> DataFrame:
    """Project to the ITEM columns: missing columns and nulls take the declared defaults."""
    present = set(df.columns)
    types = dict(part.split(None, 1) for part in (p.strip() for p in ITEM_DDL.replace("\n", " ").split(", ")))
    out: list[Column] = []
    for name in ITEM_COLUMNS:
        value = F.col(name) if name in present else F.lit(None)
        value = value.cast(types[name])
        if name in _DEFAULTS:
            value = F.coalesce(value, F.expr(_DEFAULTS[name]))
        out.append(value.alias(name))
    return df.select(*out)
