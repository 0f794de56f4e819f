"""Schemas of the feed data model."""

from __future__ import annotations

STORY = "title string, url string, time string, source string, id string, author string, score bigint, comments bigint, text string, time_iso string, time_unix bigint"
ITEM = "title string, url string, origin string, weight int, score bigint, published string, raw string, ord bigint"
HISTORY = "url string, title string, raw string, origin string"
ARTICLE = "url_key string, url string, run_date date, source string, title string, raw string, pushed_at timestamp"
SEMANTIC = "struct<score: double, similar_to: string, similar_scope: string, action: string>"
RUN_STATS = (
    "hn_raw bigint, openai_raw bigint, qbitai_raw bigint, jqzx_raw bigint, merged_raw bigint, after_url_dedup bigint, selected bigint, dropped bigint, "
    "semantic_kept bigint, semantic_dropped bigint, semantic_suspect bigint, max_history_score double, missing_sources array<string>, warnings array<string>, "
    "selected_by_source map<string, bigint>, dropped_detail array<string>, suspect_detail array<string>"
)
RUN_LOG = (
    "date string, status string, elapsed_seconds double, workflow_run_id string, total_tokens bigint, count bigint, stats string, pushed_urls array<string>, error string, "
    "history_used bigint, push struct<ok: boolean, detail: string>, outbox string, http_status int, body string"
)
PAGE = (
    "url string, title string, site_name string, description string, author string, published string, canonical string, "
    "kind string, markdown string, text string, char_count bigint"
)
