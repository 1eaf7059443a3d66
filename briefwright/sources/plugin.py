"""Source registry: a new source is a normaliser under a name."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame

from briefwright.operators.filters import lookback, score_threshold, with_ad_reason
from briefwright.operators.ranking import top_n_per_source
from briefwright.sources import feeds, pages, payloads

Normaliser = Callable[[DataFrame], DataFrame]
_SOURCES: dict[str, Normaliser] = {}


def register(name: str) -> Callable[[Normaliser], Normaliser]:
    """Decorator: the normaliser becomes available under ``name``."""
    def add(fn: Normaliser) -> Normaliser:
        if not name:
            raise ValueError("a source needs a name")
        _SOURCES[name] = fn
        return fn

    return add


def get(name: str) -> Normaliser:
    return _SOURCES[name]


def names() -> list[str]:
    return sorted(_SOURCES)


def enabled(config: Mapping[str, Mapping[str, Any]]) -> dict[str, Normaliser]:
    """Registered sources that the configuration switches on; configured names without a normaliser are skipped."""
    return {name: _SOURCES[name] for name, cfg in config.items() if cfg.get("enabled", True) and name in _SOURCES}


def union_sources(parts: list[DataFrame]) -> DataFrame:
    """All sources in one table; a column one of them lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def source_items(items: DataFrame, cfg: Mapping[str, Any], as_of=None) -> DataFrame:
    """The steps every source runs: look-back, score threshold, advertising, best ``max_items``."""
    rows = items if as_of is None else lookback(items, as_of, {}, int(cfg.get("lookback_hours", 24)))
    rows = score_threshold(rows, float(cfg.get("score_threshold", 0)))
    rows = with_ad_reason(rows, cfg.get("ad_filter")).where("ad_reason is null").drop("ad_reason")
    return top_n_per_source(rows, int(cfg.get("max_items", 100)))


for _name, _fn in {
    "x_twitter": payloads.x_list_tweets, "github": payloads.github_repos, "reddit": payloads.reddit_posts,
    "youtube": payloads.youtube_playlist_items, "zhihu": payloads.zhihu_feed, "producthunt": payloads.producthunt_posts,
    "huggingface": payloads.hf_papers, "ccf_bestpaper": payloads.openreview_notes, "coolpaper": pages.paper_listing,
    "anthropic": pages.script_payload_items, "manual_urls": payloads.manual_items,
    "cn_tech_blog": lambda df: feeds.cn_blog_entries(feeds.parse_feeds(df)),
    "openai": lambda df: feeds.vendor_blog_entries(feeds.parse_feeds(df), "openai"),
    "google_blog": lambda df: feeds.vendor_blog_entries(feeds.parse_feeds(df), "google_blog"),
    "weread": lambda df: feeds.book_entries(feeds.parse_feeds(df), "weread"),
    "kindle_books": lambda df: feeds.book_entries(feeds.parse_feeds(df), "kindle_books"),
    "apple_podcast": lambda df: feeds.podcast_entries(feeds.parse_feeds(df), "apple_podcast"),
    "xiaoyuzhou": lambda df: feeds.podcast_entries(feeds.parse_feeds(df), "xiaoyuzhou"),
}.items():
    register(_name)(_fn)
