"""Keys that say which event, release or campaign a row belongs to."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from briefwright.functions.text import slug, text_or_empty
from briefwright.functions.urls import (
    PAPER_HOSTS, REVIEW_HOST, VIDEO_HOSTS, X_HOSTS, part, path_parts, query_value, url_host, url_path,
)
from briefwright.lexicon import Lexicon, any_substring, constant, let, term_array

ROUTE_KEY = "route:paradigm-shift"

# Fixed values: (pattern, vendor, family prefix, has family group) of named releases, in order of precedence.
RELEASE_PATTERNS = [
    (r"\bclaude\s+(opus|sonnet|haiku)\s+(\d+(?:\.\d+)?)\b", "anthropic", "claude", True),
    (r"\bgpt[-\s]?(\d+(?:\.\d+)?)\b", "openai", "gpt", False),
    (r"\bgemini\s+(\d+(?:\.\d+)?)\b", "google", "gemini", False),
    (r"\bllama\s+(\d+(?:\.\d+)?)\b", "meta", "llama", False),
    (r"\bdeepseek\s+(r\d+|v\d+(?:\.\d+)?)\b", "deepseek", "deepseek", False),
    (r"\bkimi\s+(k\d+|\d+(?:\.\d+)?)\b", "moonshot", "kimi", False),
    (r"\bglm[-\s]?(\d+(?:\.\d+)?)\b", "zhipu", "glm", False),
    (r"\bminimax\s+(m\d+(?:\.\d+)?)\b", "minimax", "minimax", False),
    (r"\bgrok\s+(\d+(?:\.\d+)?)\b", "xai", "grok", False),
]
# Fixed values: (alias, vendor) of labs, in order of precedence.
LAB_ALIASES = [
    ("openai", "openai"), ("anthropic", "anthropic"), ("google deepmind", "google"), ("deepmind", "google"),
    ("google", "google"), ("meta ai", "meta"), ("meta", "meta"), ("deepseek", "deepseek"), ("moonshot", "moonshot"),
    ("kimi", "moonshot"), ("z.ai", "zhipu"), ("zhipu", "zhipu"), ("智谱", "zhipu"), ("glm", "zhipu"),
    ("minimax", "minimax"), ("xai", "xai"), ("grok", "xai"), ("cursor", "cursor"),
    ("thinking machines", "thinking-machines"), ("thinking machine", "thinking-machines"),
    ("thinkingmachines", "thinking-machines"), ("neolab", "neolab"), ("neo lab", "neolab"),
]
# Fixed values: (key, groups of terms that must each be hit) of named campaigns, in order of precedence.
CAMPAIGNS = [
    ("anthropic-s1-ipo", [["anthropic"], ["s-1", "draft s-1", "ipo", "sec filing", "confidentially submits"]]),
    ("openai-aws-codex", [["openai"], ["aws", "bedrock", "govcloud", "amazon web services"],
                          ["codex", "frontier model", "frontier models", "models"]]),
    ("openai-stargate-michigan", [["stargate"], ["michigan"]]),
]
GOOGLE_ACTORS = ["google", "gemini", "deepmind"]
GOOGLE_HOSTS = ["blog.google", "deepmind.google", "ai.google", "developers.googleblog.com"]
GOOGLE_CAMPAIGN_TERMS = [
    "googleio", "google i/o", "#googleio", "i/o 20", "io-20", "/io-20", "search-io-20",
    "gemini 3.5", "gemini-3-5", "gemini omni", "gemini spark", "gemini for science", "agentic gemini",
    "google antigravity", " ai studio", "gemini api",
]
MERGEABLE_CAMPAIGNS = [f"umbrella:{key}" for key, _ in CAMPAIGNS]


def release_identity(title: Column, url: Column, content: Column, lexicon: Lexicon) -> Column:
    """Stable key of a named release (vendor, family, version); empty when the row names none."""
    text = F.lower(F.concat_ws(" ", text_or_empty(title), text_or_empty(url)))
    named = F.lit(None).cast("string")
    for pattern, vendor, family, has_family in reversed(RELEASE_PATTERNS):
        version = slug(F.regexp_extract(text, pattern, 2 if has_family else 1), "-")
        prefix = F.concat(F.lit(f"frontier-release:{vendor}:{family}-"),
                          F.concat(F.regexp_extract(text, pattern, 1), F.lit("-")) if has_family else F.lit(""))
        named = F.when(text.rlike(pattern), F.concat(prefix, version)).otherwise(named)

    low_title = F.lower(text_or_empty(title))
    haystack = F.concat_ws(" ", low_title, F.lower(text_or_empty(content)))
    aliases = constant([{"alias": a, "vendor": v, "model": _model_slug(a)} for a, v in LAB_ALIASES],
                       "array<struct<alias:string,vendor:string,model:string>>")
    lab = let(haystack, lambda h: F.try_element_at(F.filter(aliases, lambda x: h.contains(x["alias"])), F.lit(1)))
    version = slug(F.regexp_extract(low_title, r"\b([a-z]?\d+(?:\.\d+)?)\b", 1), "-")
    usable = (version != "") & ~version.rlike(r"^20\d{2}$")
    # the labs are looked up last, as few rows come so far; without a lab the key is null
    by_lab = F.when(
        usable & any_substring(haystack, lexicon["major_release"]),
        let(lab, lambda x: F.concat(F.lit("frontier-release:"), x["vendor"], F.lit(":"), x["model"], F.lit("-"), version)))
    return F.coalesce(named, by_lab, F.lit(""))


def _model_slug(alias: str) -> str:
    first = alias.split()[0].lower()
    return "-".join(filter(None, "".join(ch if ch.isascii() and ch.isalnum() else " " for ch in first).split()))


def campaign_key(release_id: Column, route: Column, text: Column, url: Column) -> Column:
    """Coarse key of the campaign a row belongs to; empty when none."""
    host = url_host(url)
    hay = F.concat_ws(" ", text, host, F.lower(url_path(url)))
    out = F.when(release_id != "", F.concat(F.lit("umbrella:"), release_id)).when(route, f"umbrella:{ROUTE_KEY}")
    for key, groups in CAMPAIGNS:
        hit = F.lit(True)
        for group in groups:
            hit = hit & any_substring(hay, group)
        out = out.when(hit, f"umbrella:{key}")
    google = any_substring(hay, GOOGLE_ACTORS) | host.isin(*GOOGLE_HOSTS) | host.endswith(".google")
    return out.when(google & any_substring(hay, GOOGLE_CAMPAIGN_TERMS), "umbrella:google-io-gemini").otherwise("")


def event_key(release_id: Column, paper_id: Column, route: Column, url: Column) -> Column:
    """Exact event key of a row; empty when the link alone does not name an event."""
    host, parts = url_host(url), path_parts(url)
    some = F.size(parts) > 0
    watched = F.lower(query_value(url, "v"))
    return (
        F.when(release_id != "", release_id)
        .when(paper_id != "", F.concat(F.lit("paper:"), paper_id))
        .when(route, ROUTE_KEY)
        .when(host.isin(*X_HOSTS) & (F.size(parts) >= 3) & (part(parts, 2) == "status"), "")
        .when(host.isin(*PAPER_HOSTS, REVIEW_HOST) & some, F.concat(F.lit("paper:"), host, F.lit(":"), F.lower(part(parts, -1))))
        .when((host == "youtube.com") & (part(parts, 1) == "watch"),
              F.when(watched != "", F.concat(F.lit("url:"), host, F.lit("/watch:"), watched)).otherwise(""))
        .when(host.isin(*VIDEO_HOSTS) & some, F.concat(F.lit("url:"), host, F.lit("/"), F.lower(part(parts, 1))))
        .when((host != "") & some, F.concat(F.lit("url:"), host, F.lit("/"), F.lower(F.array_join(parts, "/"))))
        .otherwise("")
    )


def entities(text: Column, tokens: Column, url: Column, arxiv_id: Column, release_id: Column, lexicon: Lexicon) -> Column:
    """Actors a row is about: known names, @mentions, known host roots, paper id, parts of the release key."""
    actors = term_array(lexicon["known_actors"])
    mentions = F.regexp_extract_all(text, F.lit(r"@([a-zA-Z0-9_]{2,})"), F.lit(1))
    root = F.substring_index(url_host(url), ".", 1)
    extra = F.array_compact(F.array(
        F.when(F.array_contains(actors, root), root),
        F.when(F.coalesce(arxiv_id, F.lit("")) != "", F.lower(arxiv_id))))
    release = F.when(release_id != "", F.split(release_id, ":")).otherwise(term_array([]))
    return F.array_distinct(F.concat(F.array_intersect(tokens, actors), mentions, extra, release))
