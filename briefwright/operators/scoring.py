"""Event scoring: signals of single items, one aggregate per event, then one projection.

Term hits of an event are unions over its members. They are kept as bit masks (one bit per term) and
combined with ``bit_or``, so an event of any size has a state of a few longs and combines map-side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window, functions as F

from briefwright.functions import identity, text as T, urls as U
from briefwright.lexicon import Lexicon, TermFinder, any_substring, constant, constant_map, let, substring_hits, term_array, token_hits
from briefwright.operators.registry import Registry, is_discovered_primary, is_project_host, item_tier, item_weight
from briefwright.policy import DIMENSIONS, policy

# Source and host groups of the signals.
PAPER_SOURCES = ["arxiv", "openreview", "papers", "coolpaper", "ccf_bestpaper", "alphaxiv"]
PAPER_LINK_HOSTS = ["arxiv.org", "openreview.net", "papers.cool", "alphaxiv.org"]
COMMUNITY_SOURCES = ["reddit", "hackernews", "hn", "x_twitter", "twitter", "local_llama", "lobsters"]
COMMUNITY_HOSTS = ["reddit.com", "old.reddit.com", "news.ycombinator.com", "x.com", "twitter.com"]
MEDIA_SOURCES = ["youtube", "apple_podcast", "podcast", "ai_exec_podcast"]
MEDIA_HOSTS = ["youtube.com", "youtu.be", "podcasts.apple.com", "spotify.com", "open.spotify.com"]
EVIDENCE_SOURCES = [
    "finance", "openai", "anthropic", "google", "google_blog", "deepmind", "microsoft", "meta", "nvidia", "amd", "apple",
]
EVIDENCE_HOSTS = [
    "openai.com", "anthropic.com", "google.com", "blog.google", "deepmind.google", "microsoft.com", "nvidia.com",
    "developer.nvidia.com", "investor.nvidia.com", "sec.gov", "cnbc.com", "marketwatch.com", "wsj.com",
    "bloomberg.com", "reuters.com", "abc.xyz", "investor.google", "aws.amazon.com", "amazon.com",
]
OFFICIAL_SOURCES = ["anthropic", "openai", "google_blog", "google", "deepmind", "meta", "microsoft"]
OFFICIAL_HOSTS = [
    "anthropic.com", "openai.com", "blog.google", "deepmind.google", "ai.google", "ai.meta.com", "microsoft.com",
]
# Anchors of the single rules.
RELEASE_WORDS = [
    "launch", "launches", "launched", "release", "released", "introducing", "available", "availability", "ships",
    "shipping", "upgrade", "upgrading", "same price", "pricing", "fast mode", "workflow", "workflows", "api",
]
LAUNCH_WORDS = [
    "launch", "launches", "launched", "introducing", "release", "released", "demo", "project", "tool", "agent", "sdk",
    "api", "beta",
]
CLOUD_ANCHORS = ["aws", "bedrock", "govcloud", "enterprise", "codex"]
CAPITAL_ANCHORS = ["ipo", "s-1", "sec", "earnings"]
INFRA_ANCHORS = ["data center", "datacenter", "server", "networking", "compute capacity"]
OPEN_MODEL_ANCHORS = ["nvidia", "cosmos", "weights", "training scripts", "deployment tools", "dataset"]
FILING_ACTORS = ["anthropic", "openai", "google", "nvidia", "meta", "microsoft"]
CAPABILITY_ACTORS = [
    "openai", "codex", "chatgpt", "anthropic", "claude code", "google", "gemini", "microsoft", "copilot", "cursor", "windsurf",
]
CAPABILITY_ANCHORS = ["codex", "agent", "agents", "developer", "workflow", "api", "chatgpt", "claude code"]
CORRECTION_ANCHORS = ["replication", "reproduce", "boundary", "limitation", "failed"]
PRODUCTION_ANCHORS = ["production", "deployed", "serving", "real-world", "real world"]
REPLICATION_ANCHORS = ["replication", "reproduce"]

TOKEN_MASKS = ("technical", "product", "business", "novelty", "reader_relevance", "breakthrough", "empirical",
               "reproducibility", "credibility")
TEXT_MASKS = ("industrial_practice", "correction", "event_capability")


#: Terms of one mask; a group of more terms has several.
MASK_TERMS = 63


def _mask(terms: Sequence[str], present: Column, number: Mapping[str, int] | None = None) -> Column:
    """One bit per term that is present, in as many longs as the group needs. ``present`` are the group's terms in a row, or their numbers."""
    terms = list(terms)

    def one(part: Sequence[str]) -> Column:
        bits = constant([{"term": number[t] if number else t, "bit": 1 << i} for i, t in enumerate(part)], f"array<struct<term:{'int' if number else 'string'},bit:bigint>>")
        return F.aggregate(F.filter(bits, lambda x: F.array_contains(present, x["term"])), F.lit(0).cast("bigint"), lambda acc, x: acc.bitwiseOR(x["bit"]))

    return F.array(*[one(terms[i : i + MASK_TERMS]) for i in range(0, max(1, len(terms)), MASK_TERMS)])


def mask_count(mask: str) -> Column:
    """Number of terms in a mask."""
    return F.aggregate(mask, F.lit(0), lambda n, x: n + F.bit_count(x))


def _union(group: str, lexicon: Lexicon) -> Column:
    """Terms that any row of a group has."""
    parts = max(1, -(-len(lexicon[group]) // MASK_TERMS))
    return F.array(*[F.bit_or(F.col(f"m_{group}")[i]) for i in range(parts)]).alias(f"m_{group}")


#: Groups and lists whose terms are counted anywhere in the text of an item.
TEXT_GROUPS = ("media_role", "media_knowledge", "generic_learning", "hard_evidence", "hard_evidence_infra", "event_cloud", "event_capital", "event_infra",
               "event_open_model", "event_capability", "event_ship", "event_filing", "commentary", "community_practice", "major_release", "survey", "position",
               "benchmark", *TEXT_MASKS)
RELEASE_PHRASES = ["available today", "same price"]
TEXT_LISTS = (RELEASE_PHRASES, CLOUD_ANCHORS, CAPITAL_ANCHORS, INFRA_ANCHORS, OPEN_MODEL_ANCHORS, FILING_ACTORS, CAPABILITY_ACTORS, CAPABILITY_ANCHORS,
              CORRECTION_ANCHORS, PRODUCTION_ANCHORS, REPLICATION_ANCHORS)


def text_terms(lexicon: Lexicon) -> TermFinder:
    """One automaton for all terms that the signals of an item look for in its text."""
    return TermFinder([t for g in TEXT_GROUPS for t in lexicon[g]] + [t for terms in TEXT_LISTS for t in terms])


def _points(condition: Column, value: float, otherwise: float = 0.0) -> Column:
    return F.when(condition, F.lit(value)).otherwise(F.lit(otherwise))


def _log_score() -> Column:
    return F.log10(F.greatest(F.lit(1.0), F.coalesce("score", F.lit(0.0))))


def with_features(items: DataFrame, lexicon: Lexicon | None = None, registry: Registry | None = None) -> DataFrame:
    """Identity and text features of every item; each is computed once and reused by all rules."""
    lexicon, registry = lexicon or Lexicon(), registry or Registry()
    c = F.col
    staged = items.withColumns({
        "text": T.item_text(c("source"), c("title"), c("content"), c("tags"), c("author")),
        "_search": T.search_text(c("source"), c("title"), c("content"), c("tags"), c("author"), c("extra")),
        "host": U.url_host(c("url")),
        "paper_id": U.paper_identity(c("arxiv_id"), c("url")),
        "repo_id": U.repo_identity(c("source"), c("url")),
        "release_id": identity.release_identity(c("title"), c("url"), c("content"), lexicon),
        "title_clean": T.clean_title(c("title")),
        "tier": item_tier(registry, c("source"), c("url"), c("content"), c("tags"), c("extra")),
        "source_weight": item_weight(registry, c("source"), c("url")),
    }).withColumn("on_route", T.route_signal(c("_search"), lexicon)).drop("_search")
    staged = staged.withColumns({
        "tokens": T.tokens(c("text"), lexicon["stopwords"]),
        "title_tokens": T.tokens(c("title_clean"), lexicon["stopwords"]),
        "identity": F.lower(U.source_identity(U.source_name(c("source"), c("url")), c("url"))),
        "campaign": identity.campaign_key(c("release_id"), c("on_route"), c("text"), c("url")),
        "item_event_key": identity.event_key(c("release_id"), c("paper_id"), c("on_route"), c("url")),
        "unrelated": T.says_unrelated(c("text")),
    })
    return staged.withColumn("entities", identity.entities(
        c("text"), c("tokens"), c("url"), c("arxiv_id"), c("release_id"), lexicon))


def with_item_signals(features: DataFrame, lexicon: Lexicon | None = None, ranking: Mapping[str, Any] | None = None,
                      registry: Registry | None = None) -> DataFrame:
    """Signals of single items; every event signal is a sum, maximum or union of these."""
    lexicon, registry = lexicon or Lexicon(), registry or Registry()
    knobs = policy("ranking", dict(ranking or {}))
    c, text = F.col, F.col("text")
    source = F.lower(T.text_or_empty(c("source")))
    finder, found = text_terms(lexicon), c("_found")
    hits = lambda group: finder.count(found, lexicon[group])
    holds = lambda terms: finder.any(found, terms)
    link_tier = registry.tier(F.lit(None).cast("string"), c("url"))
    account = F.lower(U.part(U.path_parts(c("url")), 1))
    stars = F.coalesce(F.nullif(T.extra_number(c("extra"), ["stars"]), F.lit(0.0)), F.coalesce("score", F.lit(0.0)))
    staged = features.withColumn("_found", finder.hits(text)).withColumns({
        "is_media": source.isin(*MEDIA_SOURCES) | c("host").isin(*MEDIA_HOSTS),
        "is_community": source.isin(*COMMUNITY_SOURCES) | c("host").isin(*COMMUNITY_HOSTS),
        "is_evidence": source.isin(*EVIDENCE_SOURCES) | c("host").isin(*EVIDENCE_HOSTS) | (link_tier == "T1"),
        "link_is_t1": link_tier == "T1",
        "is_official": source.isin(*OFFICIAL_SOURCES) | c("host").isin(*OFFICIAL_HOSTS)
        | (c("host").isin(*U.X_HOSTS) & account.isin(*lexicon["official_accounts"])),
        "money": _points(text.rlike(T.MONEY_PATTERN), 1.0),
        "power": _points(text.rlike(T.POWER_PATTERN), 1.0),
        "n_actor": token_hits(c("tokens"), lexicon["media_actor"]),
        "n_role": hits("media_role"), "n_knowledge": hits("media_knowledge"), "n_learning": hits("generic_learning"),
        "n_evidence": hits("hard_evidence"), "n_evidence_infra": hits("hard_evidence_infra"),
        "n_cloud": hits("event_cloud"), "n_capital": hits("event_capital"), "n_infra": hits("event_infra"),
        "n_open": hits("event_open_model"), "n_capability": hits("event_capability"), "n_ship": hits("event_ship"),
        "n_filing": hits("event_filing"), "n_commentary": hits("commentary"), "n_practice": hits("community_practice"),
        "n_facts": finder.count(found, list(dict.fromkeys(
            [*lexicon["event_cloud"], *lexicon["event_capital"], *lexicon["event_infra"], *lexicon["event_open_model"]]))),
        "has_release_word": (token_hits(c("tokens"), RELEASE_WORDS) > 0) | holds(RELEASE_PHRASES),
        "has_major_term": holds(lexicon["major_release"]),
        "evergreen": U.is_repo_homepage(c("source"), c("title"), c("url")) & (stars >= float(knobs["evergreen_repo_star_threshold"])),
    })
    n = F.col
    media_value = F.least(F.lit(4.5), n("n_actor") * F.lit(0.55) + n("n_role") * F.lit(0.75) + n("n_knowledge") * F.lit(0.42)
                          + F.least(F.lit(1.5), _log_score() * 0.35))
    media_speaks = (n("n_actor") > 0) | (n("n_role") > 0) | (n("n_knowledge") >= 2)
    capability_event = (
        (n("n_capability") >= 3) & (n("n_ship") >= 1) & holds(CAPABILITY_ACTORS) & holds(CAPABILITY_ANCHORS))
    official_event = (
        ((n("n_cloud") >= 2) & holds(CLOUD_ANCHORS))
        | ((n("n_capital") >= 1) & ((n("money") > 0) | holds(CAPITAL_ANCHORS)))
        | ((n("n_infra") >= 2) & ((n("power") > 0) | holds(INFRA_ANCHORS)))
        | ((n("n_open") >= 2) & holds(OPEN_MODEL_ANCHORS))
        | ((n("n_filing") >= 2) & holds(FILING_ACTORS))
        | capability_event)
    tier_bonus = F.when(c("tier") == "T1", 1.4).when(c("tier") == "T1.5", 0.8).otherwise(0.4)
    official_value = F.least(
        F.lit(8.5),
        tier_bonus + F.least(F.lit(3.0), n("n_cloud") * F.lit(0.45)) + F.least(F.lit(3.0), n("n_capital") * F.lit(0.55))
        + F.least(F.lit(3.0), n("n_infra") * F.lit(0.45)) + F.least(F.lit(2.4), n("n_open") * F.lit(0.50))
        + F.least(F.lit(3.2), n("n_capability") * F.lit(0.55) + n("n_ship") * F.lit(0.25))
        + F.least(F.lit(2.4), n("n_filing") * F.lit(0.70)) + n("money") * 1.8 + n("power") * 1.8)
    evidence_value = F.least(
        F.lit(6.0),
        n("n_evidence") * F.lit(0.75) + n("n_evidence_infra") * F.lit(0.35) + n("money") * 1.7
        + _points(n("link_is_t1") | (source == "finance"), 1.1, 0.5) + F.least(F.lit(1.0), _log_score() * 0.22))
    practice_value = F.least(
        F.lit(4.0),
        n("n_practice") * F.lit(0.65) + _points(source.isin("reddit", "hackernews", "hn"), 1.0, 0.6)
        + F.least(F.lit(2.0), _log_score() * 0.55))
    staged = staged.withColumns({
        "s_media": F.when(n("is_media") & media_speaks, media_value).otherwise(0.0),
        "s_learning": F.when(n("is_media") & (n("n_learning") > 0), F.least(F.lit(4.0), n("n_learning") * F.lit(0.9))).otherwise(0.0),
        "s_official": F.when(n("is_evidence") & official_event, official_value).otherwise(0.0),
        "s_evidence": F.when(n("is_evidence") & (n("n_evidence") > 0) & (n("n_evidence_infra") > 0), evidence_value).otherwise(0.0),
        "s_practice": F.when(n("is_community") & (n("n_practice") > 0), practice_value).otherwise(0.0),
    })
    own_facts = (n("n_facts") >= 4) & (F.round(F.least(F.lit(10.0), n("s_media")), 2) >= 3.0)
    commentary = F.least(F.lit(4.0), n("n_commentary") * F.lit(0.7) + F.greatest(F.lit(0), F.lit(2) - n("n_facts")) * F.lit(0.4))
    number = lambda *names: T.extra_number(c("extra"), names)
    token_mask = lambda g: let(F.array_intersect("tokens", term_array(lexicon[g])), lambda own: _mask(lexicon[g], own))
    masks = {f"m_{g}": token_mask(g) for g in TOKEN_MASKS}
    masks |= {f"m_{g}": _mask(lexicon[g], found, finder.number) for g in TEXT_MASKS}
    return staged.withColumns({
        "s_commentary": F.when((n("is_media") | n("is_community")) & (n("n_commentary") > 0) & ~own_facts, commentary).otherwise(0.0),
        "heat_value": F.when(n("evergreen"), F.least(c("score"), F.lit(float(knobs["evergreen_repo_heat_cap"])))).otherwise(
            F.coalesce("score", F.lit(0.0))),
        "influence_value": F.greatest(
            F.coalesce("score", F.lit(0.0)),
            number("citations", "citation_count", "semantic_scholar_citations") * 3.0,
            number("influential_citations", "influential_citation_count") * 5.0,
            number("bookmarks", "bookmark_count", "favorites") * 1.5,
            number("likes", "like_count", "upvotes"),
            number("stars", "github_stars") * 1.2,
            number("downloads", "hf_downloads") * 0.05),
        "f_survey": holds(lexicon["survey"]), "f_position": holds(lexicon["position"]),
        "f_benchmark": holds(lexicon["benchmark"]), "f_replication": holds(REPLICATION_ANCHORS),
        "f_correction": holds(CORRECTION_ANCHORS), "f_production": holds(PRODUCTION_ANCHORS),
        "f_frontier": (c("release_id") != "") & n("has_major_term"),
        "f_official_release": n("is_official") & n("has_release_word"),
        **masks,
    }).drop("_found")


ITEM_SIGNALS = ("s_media", "s_learning", "s_official", "s_evidence", "s_practice", "s_commentary")

MAIN_COLUMNS = ("item_id", "pos", "source", "source_type", "title", "url", "author", "content", "published_at", "score",
                "tags", "language", "arxiv_id", "extra", "text", "tokens", "host", "tier", "source_weight", "is_media",
                "evergreen", "title_clean")


def main_order(ranking: Mapping[str, Any] | None = None) -> list[Column]:
    """Sort keys (all descending) that pick the main item of an event."""
    knobs = policy("ranking", dict(ranking or {}))
    order = constant_map({t: float(v) for t, v in knobs["tier_order"].items()}, "double")
    social = _points(U.netloc(F.col("url")).isin(*knobs["main_link_social_penalty_hosts"]), float(knobs["main_link_social_penalty"]))
    length = F.least(F.length(T.text_or_empty(F.col("title"))), F.lit(240)) * F.lit(float(knobs["title_length_penalty_per_char"]))
    return [F.coalesce(F.try_element_at(order, F.col("tier")), F.lit(1.0)), F.col("source_weight"), -social,
            F.coalesce("score", F.lit(0.0)) - length, T.text_or_empty(F.col("title")), -F.col("rank")]


def event_aggregates(signals: DataFrame, event: str | Sequence[str] = "event", ranking: Mapping[str, Any] | None = None, lexicon: Lexicon | None = None) -> DataFrame:
    """One row per event: unions, maxima and sums over its members, and its main item. Needs ``rank``, the
    position of a member in the clustering order, and staged ``signals``, which are read three times.

    Numbers are summed by hash, the main item is chosen by its sort keys and rank alone, and only the chosen rows are
    fetched whole, so no text is shuffled for the others."""
    lexicon, event = lexicon or Lexicon(), [event] if isinstance(event, str) else list(event)
    total = lambda c: F.round(F.least(F.lit(10.0), F.sum(c)), 2)
    numbers = signals.groupBy(*event).agg(
        F.count(F.lit(1)).alias("cluster_size"),
        F.max("heat_value").alias("heat_value"),
        F.max("influence_value").alias("influence_value"),
        *[_union(g, lexicon) for g in (*TOKEN_MASKS, *TEXT_MASKS)],
        *[F.bool_or(f"f_{g}").alias(f"f_{g}") for g in
          ("survey", "position", "benchmark", "replication", "correction", "production", "frontier", "official_release")],
        F.bool_or(F.col("release_id") != "").alias("f_named_release"),
        F.bool_or("on_route").alias("on_route"),
        total("s_media").alias("media_signal"), total("s_learning").alias("learning_signal"),
        total("s_official").alias("official_signal"), total("s_practice").alias("practice_signal"),
        total("s_commentary").alias("commentary_signal"),
        F.round(F.least(F.lit(10.0), F.greatest(F.sum("s_evidence"), F.round(F.least(F.lit(10.0), F.sum("s_official")), 2))), 2)
        .alias("evidence_signal"),
    )
    kinds = signals.where("identity <> ''").select(*event, "identity").distinct().groupBy(*event).agg(F.count(F.lit(1)).alias("diversity"))
    best = signals.groupBy(*event).agg(F.max_by("rank", F.struct(*main_order(ranking))).alias("rank"))
    main = signals.join(best, [*event, "rank"], "left_semi").select(*event, F.struct(*[F.col(c) for c in MAIN_COLUMNS]).alias("main"))
    return numbers.join(kinds, event, "left").join(main, event).withColumn("diversity", F.least(F.lit(12), F.coalesce("diversity", F.lit(0))))


def _lookup(table: Mapping[str, float], key: Column, default: float) -> Column:
    if not table:
        return F.lit(float(default))
    return F.coalesce(F.try_element_at(constant_map({k: float(v) for k, v in table.items()}, "double"), key), F.lit(float(default)))


def _clip(value: Column, places: int = 2) -> Column:
    return F.round(F.least(F.lit(10.0), F.greatest(F.lit(0.0), value)), places)


def with_dimensions(events: DataFrame, lexicon: Lexicon | None = None, ranking: Mapping[str, Any] | None = None) -> DataFrame:
    """Adds the six dimensions (struct ``dimensions``) and the release facts of the main item."""
    lexicon = lexicon or Lexicon()
    knobs = policy("ranking", dict(ranking or {}))
    m = lambda g: mask_count(f"m_{g}")
    main = lambda c: F.col(f"main.{c}")
    staged = events.withColumns({
        "release_kind": T.release_kind(main("source"), main("title"), main("url")),
        "n_architecture": substring_hits(main("text"), lexicon["architecture_release"]),
        "breaking": any_substring(main("text"), ["breaking", "migration guide", "backward incompatible"]),
        "frontier_release": F.col("f_named_release") & (F.col("f_official_release") | F.col("f_frontier")),
    })
    kind = F.coalesce("release_kind", F.lit("none"))
    speaks = kind.isin("major", "prerelease") & (F.col("n_architecture") > 0) & ~(
        (kind == "prerelease") & (F.col("n_architecture") < 2) & ~F.col("breaking"))
    staged = staged.withColumn("architecture_signal", F.when(speaks, F.round(F.least(
        F.lit(10.0), F.col("n_architecture") * F.lit(1.35) + _points(kind == "major", 1.4, 0.6)
        + _points(F.col("breaking"), 1.0)), 2)).otherwise(0.0))

    tier_bonus = _lookup(knobs["tier_bonus"], main("tier"), 0.2)
    spread = F.least(F.lit(2.0), F.greatest(F.lit(0), F.col("diversity") - 1) * F.lit(0.45))
    warmth = F.least(F.lit(2.0), F.log10(F.greatest(F.lit(1.0), F.col("heat_value"))) / 3.0)
    base = lambda g, b=1.5, s=1.6: F.least(F.lit(10.0), F.lit(b) + F.lit(s) * m(g))
    parts: dict[str, list[Column]] = {
        "technical_importance": [base("technical"), tier_bonus],
        "product_impact": [base("product"), tier_bonus * 0.6],
        "business_impact": [base("business"), spread],
        "novelty": [base("novelty"), tier_bonus * 0.4],
        "reader_relevance": [base("reader_relevance", 2.0, 1.35), warmth],
        "confidence": [F.lit(3.0), tier_bonus, spread, F.least(F.lit(1.5), F.col("cluster_size") * F.lit(0.25))],
    }
    # Fixed values: (signal, dimension, cap, rate) of the additive boosts.
    boosts = [
        (m("industrial_practice"), [("product_impact", 1.8, 0.35), ("business_impact", 1.6, 0.30),
                                    ("reader_relevance", 1.4, 0.25), ("confidence", 1.0, 0.20)]),
        (m("correction"), [("technical_importance", 1.4, 0.25), ("novelty", 1.2, 0.18),
                           ("reader_relevance", 1.0, 0.18), ("confidence", 1.0, 0.20)]),
        (F.col("practice_signal"), [("technical_importance", 1.0, 0.10), ("product_impact", 1.0, 0.12),
                                    ("reader_relevance", 1.5, 0.18), ("confidence", 0.6, 0.06)]),
        (F.col("media_signal"), [("technical_importance", 1.2, 0.12), ("product_impact", 1.2, 0.12),
                                 ("business_impact", 1.0, 0.10), ("reader_relevance", 1.4, 0.14), ("confidence", 0.7, 0.07)]),
        (F.col("evidence_signal"), [(d, float(v), 0.22) for d, v in knobs["hard_evidence_boosts"].items()]),
        (F.col("architecture_signal"), [(d, float(v), 0.24) for d, v in knobs["architecture_release_boosts"].items()]),
    ]
    for signal, rules in boosts:
        for dimension, cap, rate in rules:
            parts[dimension].append(F.when(signal > 0, F.least(F.lit(cap), signal * F.lit(rate))).otherwise(0.0))
    for flag, table in (("frontier_release", "frontier_release_boosts"), ("on_route", "route_boosts")):
        for dimension, value in knobs[table].items():
            parts[dimension].append(_points(F.col(flag), float(value)))
    out = []
    for dimension in DIMENSIONS:
        total = parts[dimension][0]
        for term in parts[dimension][1:]:
            total = total + term
        out.append(_clip(total).alias(dimension))
    return staged.withColumn("dimensions", F.struct(*out))


def checked_dimensions(raw: Column, fallback: Column) -> Column:
    """Dimensions supplied from outside (JSON object): accepted, clipped, only if all six are numbers."""
    parsed = F.try_parse_json(raw)
    values = {}
    for name in DIMENSIONS:
        given = F.try_variant_get(parsed, f"$.{name}", "string")
        values[name] = given.try_cast("double")
    complete = F.lit(True)
    for value in values.values():
        complete = complete & value.isNotNull()
    return F.when(complete, F.struct(*[_clip(v).alias(k) for k, v in values.items()])).otherwise(fallback)


def paper_subtype(correction: Column, industrial: Column, f_correction: Column, f_production: Column, f_survey: Column,
                  f_position: Column, f_benchmark: Column, f_replication: Column) -> Column:
    return (
        F.when((correction > 0) & f_correction, "correction").when((industrial >= 2) & f_production, "production")
        .when(f_survey, "survey").when(f_position, "position").when(f_benchmark, "benchmark")
        .when(f_replication, "replication").otherwise("original"))


def text_subtype(text: Column, lexicon: Lexicon) -> Column:
    """Paper subtype of a single text."""
    return paper_subtype(
        substring_hits(text, lexicon["correction"]), substring_hits(text, lexicon["industrial_practice"]),
        any_substring(text, CORRECTION_ANCHORS), any_substring(text, PRODUCTION_ANCHORS),
        any_substring(text, lexicon["survey"]), any_substring(text, lexicon["position"]),
        any_substring(text, lexicon["benchmark"]), any_substring(text, REPLICATION_ANCHORS))


# Weight of each quality component, and factor of each subtype.
QUALITY_WEIGHTS = {
    "novelty": 0.22, "technical_depth": 0.17, "empirical_strength": 0.16, "practical_impact": 0.15, "credibility": 0.09,
    "reproducibility": 0.08, "influence_signal": 0.05, "industrial_practice": 0.05, "correction_signal": 0.03,
}
SUBTYPE_FACTORS = {
    "survey": 0.82, "position": 0.78, "benchmark": 0.96, "production": 1.06, "correction": 1.03, "replication": 0.98,
}


def with_paper_quality(events: DataFrame, category: Column, ranking: Mapping[str, Any] | None = None) -> DataFrame:
    """Adds ``paper`` (subtype, quality, multiplier, components); null for events that are no paper."""
    knobs = policy("ranking", dict(ranking or {}))
    m = lambda g: mask_count(f"m_{g}")
    main = lambda c: F.col(f"main.{c}")
    dim = lambda d: F.col(f"dimensions.{d}")
    source, host = F.lower(T.text_or_empty(main("source"))), main("host")
    subtype = paper_subtype(
        m("correction"), m("industrial_practice"),
        *[F.col(f"f_{g}") for g in ("correction", "production", "survey", "position", "benchmark", "replication")])
    staged = events.withColumns({
        "_subtype": subtype, "_industrial": m("industrial_practice"), "_correction": m("correction"),
        "_paper": (category == "Research Papers") | (T.text_or_empty(main("arxiv_id")) != "")
        | source.isin(*PAPER_SOURCES) | host.isin(*PAPER_LINK_HOSTS)})
    sub, industrial, correction = F.col("_subtype"), F.col("_industrial"), F.col("_correction")
    capped = lambda cap, n, rate: F.least(F.lit(cap), n * F.lit(rate))
    components = {
        "novelty": F.lit(2.0) + capped(4.0, m("breakthrough"), 1.25) + dim("novelty") * 0.35
        - F.when(sub == "survey", 2.0).when(sub == "benchmark", 0.4).otherwise(0.0),
        "technical_depth": F.lit(2.0) + capped(3.5, m("technical"), 0.55) + dim("technical_importance") * 0.35,
        "empirical_strength": F.lit(1.5) + capped(5.0, m("empirical"), 0.9) + capped(2.5, industrial, 0.45) + capped(2.0, correction, 0.35),
        "practical_impact": F.lit(1.5) + capped(3.0, m("reader_relevance"), 0.35)
        + (dim("product_impact") + dim("reader_relevance")) * 0.20 + capped(3.0, industrial, 0.55) + capped(1.5, correction, 0.25),
        "credibility": F.lit(3.0) + capped(3.0, m("credibility"), 0.9) + capped(1.5, industrial, 0.20)
        + _points(main("tier") == "T1", 1.0) + _points((source == "openreview") | (host == "openreview.net"), 0.8)
        + _points((source == "arxiv") | (host == "arxiv.org"), 0.3),
        "reproducibility": F.lit(1.0) + capped(6.0, m("reproducibility"), 1.1) + capped(3.0, correction, 0.45),
        "influence_signal": F.log10(F.greatest(F.lit(1.0), F.col("influence_value"))) * 2.2,
        "industrial_practice": industrial * F.lit(1.35),
        "correction_signal": correction * F.lit(1.15),
    }
    staged = staged.withColumn("_parts", F.struct(*[_clip(v).alias(k) for k, v in components.items()]))
    quality = F.lit(0.0)
    for name, weight in QUALITY_WEIGHTS.items():
        quality = quality + F.col(f"_parts.{name}") * F.lit(weight)
    staged = staged.withColumn("_quality", _clip(quality * _lookup(SUBTYPE_FACTORS, sub, 1.0)))
    q = F.col("_quality")
    step = (
        F.when(q >= 8.0, float(knobs["breakthrough_paper_multiplier"])).when(q >= 6.2, float(knobs["strong_paper_multiplier"]))
        .when(q >= 4.8, float(knobs["solid_paper_multiplier"])).when(q >= 3.5, float(knobs["incremental_paper_multiplier"]))
        .otherwise(float(knobs["ordinary_paper_multiplier"])))
    multiplier = (
        F.when((sub == "survey") & (q < 8.0), F.least(step, F.lit(float(knobs["survey_paper_cap"]))))
        .when((sub == "production") & (q >= 4.8), F.greatest(step, F.lit(float(knobs["production_paper_multiplier_floor"]))))
        .when((sub == "correction") & (q >= 4.5), F.greatest(step, F.lit(float(knobs["correction_paper_multiplier_floor"]))))
        .otherwise(step))
    paper = F.when(F.col("_paper"), F.struct(
        sub.alias("subtype"), q.alias("quality"), F.round(multiplier, 4).alias("multiplier"), F.col("_parts").alias("components")))
    return staged.withColumn("paper", paper).drop("_subtype", "_industrial", "_correction", "_paper", "_parts", "_quality")


def release_may_lead(kind: Column, architecture_signal: Column) -> Column:
    """A release post may be a headline when it is major, or a prerelease with architecture impact."""
    return kind.isNull() | (kind == "major") | ((architecture_signal > 0) & (kind == "prerelease"))


def with_event_score(events: DataFrame, category: Column, ranking: Mapping[str, Any] | None = None,
                     registry: Registry | None = None) -> DataFrame:
    """Adds the struct ``breakdown`` (all factors) and ``event_score``."""
    registry = registry or Registry()
    knobs = policy("ranking", dict(ranking or {}))
    main = lambda c: F.col(f"main.{c}")
    number = lambda k: float(knobs[k])
    source = F.lower(T.text_or_empty(main("source")))
    one = F.lit(1.0)
    weighted = F.lit(0.0)
    for dimension, weight in knobs["dimension_weights"].items():
        weighted = weighted + F.col(f"dimensions.{dimension}") * F.lit(float(weight))
    staged = events.withColumns({
        "_weighted": weighted, "_heat": F.log10(F.greatest(one, F.col("heat_value"))), "_single": F.col("diversity") <= 1,
        "_topic": _lookup(knobs["topic_weights"], category, 1.0),
        "_discovered": is_discovered_primary(registry, main("source"), main("url")),
        "_title": F.lower(F.trim(T.text_or_empty(main("title")))),
    })
    guarded = F.when(
        (category == "AI Models & Agent") & (F.col("_topic") > 1.0) & (source == "hackernews") & F.col("_single") & ~F.col("_discovered"),
        F.least(F.col("_topic"), F.lit(number("single_source_topic_multiplier_cap")))).otherwise(F.col("_topic"))
    body = F.lower(F.concat_ws(" ", F.col("_title"), T.text_or_empty(main("content")), T.text_or_empty(main("url"))))
    launch_tokens = T.tokens(body, Lexicon()["stopwords"])
    project = is_project_host(main("host")) | U.is_repo_homepage(main("source"), main("title"), main("url"))
    show = F.col("_title").startswith("show hn:")
    lone_launch = (source == "hackernews") & F.col("_single") & (
        show | (~main("host").isin("", "news.ycombinator.com") & project & (token_hits(launch_tokens, LAUNCH_WORDS) > 0)))
    signal = F.col
    factors = {
        "source_tier": registry.tier_weight(main("tier")),
        "topic": F.when(F.col("paper").isNotNull(), F.least(guarded, F.lit(number("research_paper_topic_cap")))).otherwise(guarded),
        "cross_source": one + F.least(F.lit(number("max_cross_source_bonus")), F.greatest(F.lit(0), F.col("diversity") - 1)
                                      * F.lit(number("cross_source_bonus_per_identity"))),
        "cluster_size": one + F.least(F.lit(number("max_cluster_size_bonus")), F.greatest(F.lit(0), F.col("cluster_size") - 1)
                                      * F.lit(number("cluster_size_bonus_per_extra_item"))),
        "paper_quality": F.coalesce(F.col("paper.multiplier"), one),
        "low_confidence": F.when(F.col("dimensions.confidence") < number("low_confidence_threshold"),
                                 number("low_confidence_multiplier")).otherwise(one),
        "release_update": F.when(signal("release_kind").isNull(), one).otherwise(_lookup(
            knobs["release_update_multipliers"], signal("release_kind"), knobs["release_update_multipliers"].get("unknown", 0.5))),
        "architecture_release": F.when(signal("architecture_signal") > 0, number("architecture_release_multiplier")).otherwise(one),
        "evergreen_repo": F.when(main("evergreen"), number("evergreen_repo_multiplier")).otherwise(one),
        "lone_launch": F.when(lone_launch, F.least(
            F.when(show, number("single_source_show_multiplier")).otherwise(one), F.lit(number("single_source_launch_multiplier")))).otherwise(one),
        "frontier_release": F.when(signal("frontier_release"), number("frontier_release_multiplier")).otherwise(one),
        "expert_media": one + F.least(F.lit(max(0.0, number("expert_media_max_multiplier") - 1.0)), signal("media_signal") * 0.02),
        "generic_learning": F.when((signal("learning_signal") > 0) & (signal("media_signal") < 3.0),
                                   number("generic_learning_media_multiplier")).otherwise(one),
        "hard_evidence": one + F.least(F.lit(max(0.0, number("hard_evidence_max_multiplier") - 1.0)), signal("evidence_signal") * 0.035),
        "secondary_commentary": F.when((signal("commentary_signal") > 0) & (signal("official_signal") == 0),
                                       number("secondary_commentary_multiplier")).otherwise(one),
        "route": F.when(signal("on_route") & (signal("diversity") >= max(2, int(number("route_min_independent_sources")))),
                        number("route_multi_source_multiplier")).otherwise(one),
    }
    staged = staged.withColumn("_f", F.struct(*[v.cast("double").alias(k) for k, v in factors.items()]))
    base = F.col("_weighted") * number("score_scale") + F.col("_heat") * number("heat_weight")
    product = base
    for name in factors:
        product = product * F.col(f"_f.{name}")
    floor_evidence = F.when(signal("evidence_signal") > 0,
                            number("hard_evidence_min_score") + F.least(F.lit(18.0), signal("evidence_signal") * 2.2))
    floor_official = F.when(signal("official_signal") > 0,
                            number("official_event_min_score") + F.least(F.lit(28.0), signal("official_signal") * 3.0))
    floor_capability = F.when((signal("official_signal") > 0) & (mask_count("m_event_capability") >= 3),
                              number("official_capability_min_score") + F.least(F.lit(26.0), signal("official_signal") * 2.8))
    score = F.round(F.greatest(product, floor_evidence, floor_official, floor_capability), 3)
    breakdown = F.struct(
        F.round("_weighted", 4).alias("weighted_dimensions"), F.round("_heat", 4).alias("heat"), F.round(base, 4).alias("base_score"),
        *[F.round(F.col(f"_f.{k}"), 4).alias(f"{k}_multiplier") for k in factors],
        F.coalesce("release_kind", F.lit("none")).alias("release_kind"),
        F.coalesce(F.col("paper.subtype"), F.lit("none")).alias("paper_subtype"), F.col("paper.quality").alias("paper_quality"),
        F.coalesce(F.col("paper.components.correction_signal"), F.lit(0.0)).alias("correction_signal"),
        F.coalesce(F.col("paper.components.industrial_practice"), F.lit(0.0)).alias("industrial_practice"),
        release_may_lead(F.col("release_kind"), F.col("architecture_signal")).alias("may_lead"),
        *[F.col(c) for c in ("architecture_signal", "media_signal", "learning_signal", "evidence_signal", "official_signal",
                             "commentary_signal", "practice_signal")],
        score.alias("final_score"))
    return (staged.withColumn("breakdown", breakdown).withColumn("event_score", F.col("breakdown.final_score"))
            .drop("_weighted", "_heat", "_single", "_topic", "_discovered", "_title", "_f"))
