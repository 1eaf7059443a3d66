"""Row filters, predicates and routes."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from briefwright.functions.text import duration_seconds
from briefwright.lexicon import TermFinder
from briefwright.operators.ranking import by_score, top_k, top_scored

# Default advertising patterns, and link shorteners and shops.
AD_PATTERNS = [
    r"\b(sponsored|promoted|advertisement)\b",
    r"#ad\b|#sponsored\b",
    r"\b(affiliate link|use my code|discount code|promo code)\b",
    r"\b(buy now|limited offer|exclusive deal|check out my)\b",
    r"(广告|推广|赞助|优惠券|折扣码|限时优惠|种草|带货|恰饭)",
]
AD_URL_PATTERNS = [
    r"://(bit\.ly|tinyurl\.com|amzn\.to|shrinkme\.io)/",
    r"://t\.co/",
    r"://(www\.)?(shopify\.com|gumroad\.com|etsy\.com)/",
]
ENRICHMENT_SOURCES = ["anthropic", "openai", "google_blog", "manual_urls", "youtube", "xiaoyuzhou", "apple_podcast"]
ARTICLE_SOURCES = ["anthropic", "openai", "google_blog", "manual_urls"]


def lookback_hours(hours: Mapping[str, int], default_hours: int = 24) -> Column:
    """The look-back of a row's source, as an interval."""
    table = F.create_map(*[x for s, h in hours.items() for x in (F.lit(s), F.lit(int(h)))]) if hours else None
    own = F.try_element_at(table, F.col("source")) if table is not None else F.lit(None)
    return F.make_interval(hours=F.coalesce(own, F.lit(default_hours)))


def lookback(items: DataFrame, as_of: Column, hours: Mapping[str, int], default_hours: int = 24) -> DataFrame:
    """Rows inside the look-back window of their source."""
    return items.where(F.col("published_at") >= as_of - lookback_hours(hours, default_hours))


def score_threshold(items: DataFrame, threshold: float | Mapping[str, float]) -> DataFrame:
    """Rows at or above the threshold, one for all or one per source (0 when a source has none)."""
    if not isinstance(threshold, Mapping):
        return items.where(F.col("score") >= float(threshold))
    table = F.create_map(*[x for s, t in threshold.items() for x in (F.lit(s), F.lit(float(t)))])
    return items.where(F.col("score") >= F.coalesce(F.try_element_at(table, F.col("source")), F.lit(0.0)))


def of_source(items: DataFrame, source: str) -> DataFrame:
    return items.where(F.col("source") == source)


def _plain_words(pattern: str) -> list[str] | None:
    """Lower-case words one of which a text must hold for the pattern to be found, if the pattern is nothing but a choice of words."""
    group = re.fullmatch(r"(?:\\b)?\((?:\?:)?([^()]*)\)(?:\\b)?", pattern)
    words = [re.sub(r"^\\b|\\b$", "", w) for w in (group[1] if group else pattern).split("|")]
    simple = lambda w: bool(re.fullmatch(r"[\w #-]+", w)) and all(ch.isascii() or ch.lower() == ch.upper() for ch in w)
    return [w.lower() for w in words] if all(simple(w) for w in words) else None


#: Lower-case forms of the letters beyond ASCII that a pattern without regard to case takes for an s or an i.
ODD_CASES = ["\u017f", "\u0131", "i\u0307"]


def _first_hit(text: Column, patterns: Sequence[str], label: str) -> Column:
    """Label and matched text of the first pattern, in list order, that is found. A search for any of them comes first, so a
    text without a match, as most are, is not matched with each: the words of plain patterns are looked up by one automaton, the others are one pattern."""
    if not patterns:
        return F.lit(None).cast("string")
    plain = {p: _plain_words(p) for p in patterns}
    finder = TermFinder([*ODD_CASES, *[w for words in plain.values() for w in words or ()]])
    found = finder.hits(F.lower(text))
    out = F.lit(None).cast("string")
    for pattern in reversed(patterns):
        match = F.regexp_substr(text, F.lit(f"(?iu){pattern}"))
        match = F.when(finder.any(found, [*plain[pattern], *ODD_CASES]), match) if plain[pattern] else match
        out = F.coalesce(F.concat(F.lit(f"{label}: "), match), out)
    may = F.lit(False)
    if any(plain.values()):
        may = may | (F.size(found) > 0)
    if not all(plain.values()):
        may = may | text.rlike("(?iu)" + "|".join(f"(?:{p})" for p, words in plain.items() if not words))
    return F.when(may, out)


def ad_keyword_reason(patterns: Sequence[str] = ()) -> Column:
    text = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("content", F.lit("")))
    return _first_hit(text, [*AD_PATTERNS, *patterns], "keyword_match")


def ad_url_reason(patterns: Sequence[str] = ()) -> Column:
    return F.when(F.coalesce("url", F.lit("")) != "", _first_hit(F.col("url"), [*AD_URL_PATTERNS, *patterns], "blocked_url"))


def ad_source_reason(rules: Mapping[str, Mapping[str, Any]]) -> Column:
    """Per-source title patterns, and a minimum upvote ratio (a row without ratio passes)."""
    out = F.lit(None).cast("string")
    ratio = F.coalesce(F.try_variant_get(F.try_parse_json("extra"), "$.upvote_ratio", "double"), F.lit(1.0))
    for source, rule in rules.items():
        reason = F.lit(None).cast("string")
        if source == "reddit" and rule.get("min_upvote_ratio") is not None:
            least = float(rule["min_upvote_ratio"])
            reason = F.when(ratio < least, F.concat(F.lit("reddit_low_ratio: "), ratio.cast("string"), F.lit(f" < {least}")))
        for pattern in reversed(list(rule.get("title_keywords", []))):
            reason = F.when(F.coalesce("title", F.lit("")).rlike(f"(?iu){pattern}"), f"source_keyword: {pattern}").otherwise(reason)
        out = F.when(F.col("source") == source, reason).otherwise(out)
    return out


def with_ad_reason(items: DataFrame, config: Mapping[str, Any] | None = None) -> DataFrame:
    """Adds ``ad_reason``: keyword, then link, then source rule; null for clean rows."""
    cfg = dict(config or {})
    if not cfg.get("enabled", True):
        return items.withColumn("ad_reason", F.lit(None).cast("string"))
    reason = F.coalesce(
        ad_keyword_reason([*cfg.get("title_keywords", []), *cfg.get("content_keywords", [])]),
        ad_url_reason(cfg.get("url_blocklist", [])),
        ad_source_reason(cfg.get("per_source", {})))
    return items.withColumn("ad_reason", reason)


def ad_split(items: DataFrame, config: Mapping[str, Any] | None = None) -> tuple[DataFrame, DataFrame]:
    """Clean rows, and blocked rows with their reason."""
    marked = with_ad_reason(items, config)
    return marked.where("ad_reason is null").drop("ad_reason"), marked.where("ad_reason is not null")


def feed_thresholds(items: DataFrame, limits: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """Minimum votes and favourites by feed type; missing counts are 0."""
    parsed = F.try_parse_json("extra")
    number = lambda k: F.coalesce(F.try_variant_get(parsed, f"$.{k}", "double"), F.lit(0.0))
    feed = F.try_variant_get(parsed, "$.feed_type", "string")
    keep = F.lit(True)
    for name, limit in limits.items():
        enough = (number("voteup_count") >= float(limit.get("min_voteup", 0))) & (
            number("favorite_count") >= float(limit.get("min_favorite", 0)))
        keep = keep & F.when(feed == name, enough).otherwise(True)
    return items.where(keep)


def rating_filter(papers: DataFrame, minimum: Mapping[str, float]) -> DataFrame:
    """Drops papers under the minimum mean rating of their conference; unrated papers pass."""
    if not minimum:
        return papers
    table = F.create_map(*[x for c, m in minimum.items() for x in (F.lit(c), F.lit(float(m)))])
    least = F.try_element_at(table, F.col("conference"))
    return papers.where(least.isNull() | F.col("avg_rating").isNull() | (F.col("avg_rating") >= least))


def enrichment_eligible(items: DataFrame, sources: Sequence[str] = tuple(ENRICHMENT_SOURCES)) -> DataFrame:
    return items.where(F.col("source").isin(*sources))


def select_articles(items: DataFrame, threshold: int = 5000, top_n: int = 10,
                    sources: Sequence[str] = tuple(ARTICLE_SOURCES), by: Sequence[str] = ()) -> DataFrame:
    """All short articles, and the best of the long ones (per run, when ``by`` names one)."""
    articles = items.where(F.col("source").isin(*sources) | (F.col("source_type") == "http_scrape"))
    short = articles.where(F.length("content") < threshold)
    long = articles.where(F.length("content") >= threshold)
    best = top_k(long, by, by_score(), top_n) if by else top_scored(long, top_n)
    return short.unionByName(best)


def engagement_rate(extra: Column, score: Column) -> Column:
    """(likes + comments) / views from the statistics, else the raw score."""
    parsed = F.try_parse_json(extra)
    stat = lambda k: F.coalesce(F.try_variant_get(parsed, f"$.youtube_stats.{k}", "double"), F.lit(0.0))
    has = F.try_variant_get(parsed, "$.youtube_stats", "variant").isNotNull()
    return F.when(has, (stat("likeCount") + stat("commentCount")) / F.greatest(stat("viewCount"), F.lit(1.0))).otherwise(score)


def select_videos(items: DataFrame, top_n: int = 5, min_rate: float = 0.0, by: Sequence[str] = ()) -> DataFrame:
    videos = items.where("source = 'youtube'").withColumn("engagement_rate", engagement_rate(F.col("extra"), F.col("score")))
    if min_rate > 0:
        videos = videos.where(F.col("engagement_rate") >= min_rate)
    order = [F.col("engagement_rate").desc(), F.col("pos")]
    return top_k(videos, by, order, top_n) if by else videos.orderBy(*order).limit(top_n)


def with_podcast_choice(items: DataFrame, top_n: int = 3, large_minutes: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """Podcast rows marked ``manual`` (too long) or ``enrich`` (first n of the rest in ingest order)."""
    seconds = duration_seconds(F.try_variant_get(F.try_parse_json("extra"), "$.duration", "string"))
    podcasts = items.where(
        F.col("source").isin("apple_podcast", "xiaoyuzhou") & F.array_contains("tags", "podcast")
    ).withColumn("is_large", seconds > large_minutes * 60)
    manual = podcasts.where("is_large").withColumn("choice", F.lit("manual"))
    rest = podcasts.where("not is_large").withColumn("choice", F.lit("enrich"))
    first = top_k(rest, by, [F.col("pos")], top_n) if by else rest.orderBy("pos").limit(top_n)
    return manual.unionByName(first).drop("is_large")


def successful_run_exists(runs: DataFrame, date: str, phases: Sequence[str]) -> DataFrame:
    """One row: has any of the phases succeeded for the date?"""
    hit = (F.col("date") == date) & F.col("phase").isin(*phases) & (F.col("status") == "success") if phases else F.lit(False)
    return runs.agg(F.coalesce(F.bool_or(hit), F.lit(False)).alias("succeeded"))
