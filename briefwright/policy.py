"""Ranking, routing and selection policy: defaults merged with the user's overrides."""

from __future__ import annotations

from copy import deepcopy
from typing import Any

from pyspark.sql import DataFrame, SparkSession

DIMENSIONS = (
    "technical_importance", "product_impact", "business_impact", "novelty", "reader_relevance", "confidence",
)

# Default ranking policy.
RANKING: dict[str, Any] = {
    "tier_order": {"T1": 4, "T1.5": 3, "T2": 2, "T3": 1},
    "tier_bonus": {"T1": 0.8, "T1.5": 0.5, "T2": 0.25, "T3": 0.0},
    "dimension_weights": {
        "technical_importance": 0.20, "product_impact": 0.22, "business_impact": 0.18,
        "novelty": 0.14, "reader_relevance": 0.20, "confidence": 0.06,
    },
    "topic_weights": {},
    "score_scale": 10.0,
    "heat_weight": 8.0,
    "cross_source_bonus_per_identity": 0.10,
    "max_cross_source_bonus": 0.45,
    "cluster_size_bonus_per_extra_item": 0.04,
    "max_cluster_size_bonus": 0.25,
    "main_link_social_penalty": 1.0,
    "main_link_social_penalty_hosts": ["x.com", "twitter.com", "reddit.com", "youtube.com", "youtu.be"],
    "title_length_penalty_per_char": 0.001,
    "low_confidence_threshold": 0.0,
    "low_confidence_multiplier": 1.0,
    "release_update_multipliers": {
        "major": 0.85, "minor": 0.55, "patch": 0.35, "prerelease": 0.25, "unknown": 0.50,
    },
    "evergreen_repo_star_threshold": 20000.0,
    "evergreen_repo_heat_cap": 5000.0,
    "evergreen_repo_multiplier": 0.55,
    "single_source_show_multiplier": 0.85,
    "single_source_launch_multiplier": 0.72,
    "single_source_topic_multiplier_cap": 1.05,
    "frontier_release_multiplier": 1.28,
    "expert_media_max_multiplier": 1.30,
    "expert_media_cap_exempt_signal_min": 3.0,
    "generic_learning_media_multiplier": 0.62,
    "hard_evidence_max_multiplier": 1.28,
    "hard_evidence_min_score": 82.0,
    "official_event_min_score": 112.0,
    "official_capability_min_score": 118.0,
    "secondary_commentary_multiplier": 0.68,
    "hard_evidence_boosts": {
        "technical_importance": 0.5, "product_impact": 0.9, "business_impact": 2.0,
        "novelty": 0.4, "reader_relevance": 1.0, "confidence": 1.0,
    },
    "architecture_release_multiplier": 1.18,
    "architecture_release_boosts": {
        "technical_importance": 1.2, "product_impact": 0.8, "business_impact": 0.4,
        "novelty": 0.8, "reader_relevance": 1.0, "confidence": 0.7,
    },
    "frontier_release_boosts": {
        "technical_importance": 0.8, "product_impact": 2.0, "business_impact": 1.2,
        "novelty": 0.9, "reader_relevance": 1.4, "confidence": 1.0,
    },
    "route_multi_source_multiplier": 1.32,
    "route_min_independent_sources": 2,
    "route_boosts": {
        "technical_importance": 1.3, "novelty": 1.2, "reader_relevance": 0.8, "confidence": 0.5,
    },
    "headline_quota": {
        "enabled": True,
        "max_per_source": 3,
        "max_per_topic": {
            "Research Papers": 2, "Social & Community": 2, "Books & Reading": 1, "Finance & Markets": 2,
        },
        "secondary_media_max": 3,
        "min_required_if_available": {"Developer Tools": 1, "Infrastructure & Systems": 1},
        "max_per_campaign": 1,
    },
    "research_paper_topic_cap": 1.0,
    "ordinary_paper_multiplier": 0.72,
    "incremental_paper_multiplier": 0.84,
    "solid_paper_multiplier": 0.96,
    "strong_paper_multiplier": 1.08,
    "breakthrough_paper_multiplier": 1.18,
    "survey_paper_cap": 0.80,
    "production_paper_multiplier_floor": 1.08,
    "correction_paper_multiplier_floor": 1.04,
}
PREFILTER: dict[str, Any] = {"enabled": True, "mode": "deterministic", "min_score": 0.35}
TOPIC_CLASSIFIER: dict[str, Any] = {
    "enabled": True,
    "mode": "deterministic",
    "min_confidence": 0.68,
    "uncertain_sources": [
        "x_twitter", "reddit", "zhihu", "jike", "hackernews", "alphaxiv", "youtube", "apple_podcast",
        "ai_exec_podcast", "xiaoyuzhou", "producthunt", "cn_tech_blog", "baoyu_blog", "blog_feeds",
    ],
}
DEFAULTS: dict[str, dict[str, Any]] = {
    "ranking": RANKING, "prefilter": PREFILTER, "topic_classifier": TOPIC_CLASSIFIER,
}


def _overlay(base: Any, override: Any) -> Any:
    """Override wins; mappings merge key by key; a value that is not a number leaves a numeric knob alone."""
    if isinstance(base, dict) and isinstance(override, dict):
        return {key: _overlay(base.get(key), override[key]) if key in override else deepcopy(base[key])
                for key in {**base, **override}}
    if isinstance(base, bool):
        return bool(override)
    if isinstance(base, (int, float)):
        try:
            return float(override) if isinstance(base, float) else int(override)
        except (TypeError, ValueError):
            return base
    return deepcopy(override)


def policy(section: str, overrides: dict[str, Any] | None = None) -> dict[str, Any]:
    """The policy of a section. Unknown top-level knobs are ignored, as a typing error must not rank."""
    base = DEFAULTS[section]
    known = {key: value for key, value in (overrides or {}).items() if key in base}
    return _overlay(base, known)


def quota(overrides: dict[str, Any] | None = None) -> dict[str, Any]:
    """Headline quota with caps of zero or less turned off (None)."""
    merged = _overlay(RANKING["headline_quota"], overrides or {})
    for key in ("max_per_source", "max_per_campaign", "secondary_media_max"):
        merged[key] = merged[key] if merged[key] and merged[key] > 0 else None
    for key in ("max_per_topic", "min_required_if_available"):
        merged[key] = {str(name): int(cap) for name, cap in merged[key].items() if int(cap) > 0}
    return merged


def policy_row(spark: SparkSession, section: str, overrides: dict[str, Any] | None = None) -> DataFrame:
    """One row of policy metadata, to be stored next to the results it produced."""
    settings = policy(section, overrides)
    flat = {key: str(value) for key, value in settings.items() if not isinstance(value, (dict, list))}
    lists = {key: ",".join(sorted(value)) for key, value in settings.items() if isinstance(value, list)}
    pairs = sorted({**flat, **lists, "model_calls": "none"}.items())
    return spark.createDataFrame([(section, key, value) for key, value in pairs], "section STRING, knob STRING, value STRING")
