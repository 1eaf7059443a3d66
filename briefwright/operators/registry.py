"""Source registry: weights and tiers by source name or host, defaults overlaid by the user's tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from briefwright.functions.urls import source_candidates, url_host
from briefwright.lexicon import any_substring, constant_map, term_array

# Default weights by source name and host.
WEIGHTS: dict[str, float] = {
    "openai": 1.6, "openai.com": 1.6, "anthropic": 1.6, "anthropic.com": 1.6, "google": 1.5, "blog.google": 1.5,
    "deepmind.google": 1.5, "microsoft": 1.5, "microsoft.com": 1.5, "github": 1.3, "github.com": 1.3, "arxiv": 1.3,
    "arxiv.org": 1.3, "openreview": 1.4, "openreview.net": 1.4, "alphaxiv": 1.1, "alphaxiv.org": 1.1,
    "huggingface": 1.2, "huggingface.co": 1.2, "producthunt": 0.9, "producthunt.com": 0.9, "x": 0.7, "twitter": 0.7,
    "x.com": 0.7, "twitter.com": 0.7, "reddit": 0.7, "reddit.com": 0.7, "hackernews": 0.7,
    "news.ycombinator.com": 0.7, "finance": 1.0, "finance.yahoo.com": 1.0, "cnbc.com": 1.0, "marketwatch.com": 1.0,
    "wsj.com": 1.1, "sec.gov": 1.5, "youtube": 0.6, "youtube.com": 0.6, "youtu.be": 0.6, "zhihu": 0.6,
    "zhihu.com": 0.6, "xiaoyuzhou": 0.6, "xiaoyuzhoufm.com": 0.6, "ai_exec_podcast": 1.5, "blog_feeds": 1.0,
    "nextsignalprediction.substack.com": 1.0, "baoyu.io": 1.4, "s.baoyu.io": 1.4, "weread": 0.5,
    "kindle_books": 0.5, "douban": 0.5,
}
DEFAULT_WEIGHT = 0.6
# Tier weights and members.
TIER_WEIGHTS: dict[str, float] = {"T1": 1.12, "T1.5": 1.06, "T2": 1.00, "T3": 0.90}
TIER_SOURCES: dict[str, tuple[str, ...]] = {
    "T1": ("openai", "anthropic", "google_blog", "google", "deepmind"),
    "T1.5": (
        "microsoft", "meta", "nvidia", "apple", "baidu", "huggingface_blog", "openreview", "arxiv", "papers",
        "coolpaper", "ccf_bestpaper", "x_twitter", "github", "huggingface", "alphaxiv", "producthunt",
        "apple_podcast", "ai_exec_podcast", "youtube",
    ),
    "T2": ("reddit", "hackernews", "zhihu", "xiaoyuzhou", "cn_tech_blog", "blog_feeds"),
    "T3": (),
}
TIER_HOSTS: dict[str, tuple[str, ...]] = {
    "T1": ("openai.com", "anthropic.com", "google.com", "blog.google", "deepmind.google"),
    "T1.5": (
        "microsoft.com", "research.microsoft.com", "ai.meta.com", "nvidia.com", "developer.nvidia.com", "apple.com",
        "machinelearning.apple.com", "huggingface.co", "openreview.net", "arxiv.org", "papers.cool", "x.com",
        "twitter.com", "github.com", "gist.github.com", "alphaxiv.org", "producthunt.com", "youtube.com", "youtu.be",
        "baoyu.io", "s.baoyu.io",
    ),
    "T2": ("reddit.com", "news.ycombinator.com", "zhihu.com", "nextsignalprediction.substack.com"),
    "T3": (),
}
TIERS = ("T1", "T1.5", "T2")


@dataclass(frozen=True)
class Registry:
    weights: Mapping[str, float] = field(default_factory=lambda: dict(WEIGHTS))
    default_weight: float = DEFAULT_WEIGHT
    tier_weights: Mapping[str, float] = field(default_factory=lambda: dict(TIER_WEIGHTS))
    tier_keys: Mapping[str, tuple[str, ...]] = field(
        default_factory=lambda: {t: (*TIER_SOURCES[t], *TIER_HOSTS[t]) for t in TIER_SOURCES})

    @classmethod
    def from_tables(cls, weights: DataFrame | None = None, tiers: DataFrame | None = None,
                    max_rows: int = 50_000) -> "Registry":
        """Overlay the defaults with ``source_weight(key, weight)`` and ``source_tier(key, tier)``. Both are
        dimensions whose size is checked before they become literals. Rows without a number or key are skipped."""
        base = cls()
        merged, keys = dict(base.weights), {t: list(v) for t, v in base.tier_keys.items()}
        if weights is not None:
            clean = registry_overlay(weights)
            for row in _bounded(clean, max_rows):
                merged[row["key"]] = row["weight"]
        if tiers is not None:
            clean = tiers.select(F.lower(F.trim("key")).alias("key"), F.trim("tier").alias("tier")).where("key <> '' and tier <> ''")
            for row in _bounded(clean.distinct(), max_rows):
                keys.setdefault(row["tier"], []).append(row["key"])
        return cls(merged, base.default_weight, base.tier_weights, {t: tuple(v) for t, v in keys.items()})

    def weight(self, source: Column, url: Column) -> Column:
        """Weight of the first candidate key that is registered."""
        table = constant_map(self.weights, "double")
        found = F.filter(F.transform(source_candidates(source, url), lambda c: F.try_element_at(table, c)), lambda w: w.isNotNull())
        return F.coalesce(F.try_element_at(found, F.lit(1)), F.lit(self.default_weight))

    def tier(self, source: Column, url: Column) -> Column:
        """First tier that lists any candidate key, else T3."""
        keys = source_candidates(source, url)
        out = F.when(F.lit(False), "T3")
        for name in TIERS:
            out = out.when(F.arrays_overlap(keys, term_array(self.tier_keys.get(name, ()))), name)
        return out.otherwise("T3")

    def tier_weight(self, tier: Column) -> Column:
        table = constant_map(self.tier_weights, "double")
        return F.coalesce(F.try_element_at(table, tier), F.lit(float(self.tier_weights.get("T3", 1.0))))


def _bounded(df: DataFrame, max_rows: int):
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"registry table has more than {max_rows} rows; weights_by_join takes tables of any size")
    return rows


def weights_by_join(items: DataFrame, weights: DataFrame, default: float = 1.0, id_col: str = "item_id") -> DataFrame:
    """(id, weight) of every row, from a (key, weight) table of any size, which stays a table: the weight of the first candidate key of a source that the
    table lists. ``Registry`` does the same with a table that fits into the plan. Of repeated keys the largest weight holds."""
    keys = items.select(F.col(id_col).alias("id"), F.posexplode(source_candidates(F.col("source"), F.col("url"))).alias("place", "key")).distinct()
    listed = registry_overlay(weights).groupBy("key").agg(F.max("weight").alias("weight"))
    first = keys.join(listed, "key").groupBy("id").agg(F.min_by("weight", "place").alias("weight"))
    rows = items.select(F.col(id_col).alias("of")).distinct()
    return rows.join(first, F.col("of").eqNullSafe(F.col("id")), "left").select(F.col("of").alias(id_col), F.coalesce("weight", F.lit(float(default))).alias("weight"))


def registry_overlay(weights: DataFrame) -> DataFrame:
    """Usable override rows: key normalised, weight a number."""
    return weights.select(
        F.lower(F.trim(F.col("key"))).alias("key"), F.col("weight").cast("string").try_cast("double").alias("weight")
    ).where("key <> '' and weight is not null")


def weight_dimension(spark: SparkSession, overrides: DataFrame | None = None) -> DataFrame:
    """The weight table itself: defaults, overridden key by key."""
    base = spark.createDataFrame(list(WEIGHTS.items()), "key STRING, default_weight DOUBLE")
    if overrides is None:
        return base.withColumnRenamed("default_weight", "weight")
    return base.join(registry_overlay(overrides), "key", "full_outer").select(
        "key", F.coalesce("weight", "default_weight").alias("weight"))


# Hosts of the source rules below.
DISCOVERY_EXCLUDED_HOSTS = (
    "github.com", "gist.github.com", "producthunt.com", "youtube.com", "youtu.be", "reddit.com", "x.com", "twitter.com",
)
PROJECT_HOST_SUFFIXES = ("github.io", "pages.dev", "vercel.app", "netlify.app")
ORAL_TERMS = ("oral", "best paper", "outstanding paper", "distinguished paper", "award", "plenary")


def _ends_with_any(host: Column, suffixes: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for suffix in suffixes:
        out = out | host.endswith(suffix)
    return out


def is_project_host(host: Column) -> Column:
    return _ends_with_any(host, PROJECT_HOST_SUFFIXES)


def is_discovered_primary(registry: Registry, source: Column, url: Column) -> Column:
    """A community row whose link is itself a primary source."""
    host = url_host(url)
    return (
        F.lower(F.coalesce(source, F.lit(""))).isin("hackernews", "hn")
        & (host != "") & (host != "news.ycombinator.com") & ~host.isin(*DISCOVERY_EXCLUDED_HOSTS)
        & ~is_project_host(host)
        & registry.tier(F.lit(None).cast("string"), url).isin("T1", "T1.5")
    )


def is_oral_or_above(source: Column, url: Column, content: Column, tags: Column, extra: Column) -> Column:
    """A reviewed paper whose metadata says oral or better."""
    parsed = F.try_parse_json(extra)
    fields = [F.coalesce(F.try_variant_get(parsed, f"$.{k}", "string"), F.lit(""))
              for k in ("venue", "venue_id", "presentation", "decision", "status")]
    text = F.lower(F.concat_ws(" ", *fields, F.array_join(F.coalesce(tags, term_array([])), " "), F.coalesce(content, F.lit(""))))
    has = any_substring(text, ORAL_TERMS)
    reviewed = (F.lower(F.coalesce(source, F.lit(""))) == "openreview") | (url_host(url) == "openreview.net")
    return reviewed & has


def item_tier(registry: Registry, source: Column, url: Column, content: Column, tags: Column, extra: Column) -> Column:
    return F.when(is_oral_or_above(source, url, content, tags, extra), "T1").otherwise(registry.tier(source, url))


def item_weight(registry: Registry, source: Column, url: Column) -> Column:
    own = registry.weight(source, url)
    linked = registry.weight(F.lit(None).cast("string"), url)
    return F.when(is_discovered_primary(registry, source, url), F.greatest(own, linked)).otherwise(own)
