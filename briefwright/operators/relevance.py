"""Routing and topic rules of single items."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from briefwright.functions import text as T
from briefwright.lexicon import Lexicon, TermFinder, any_substring, constant_map, substring_hits, term_array, token_hits
from briefwright.operators.ranking import by_score, ranked
from briefwright.policy import policy
from briefwright.session import cut_lineage

# Topics in order, and the sources that belong to each.
TOPIC_SOURCES = {
    "AI Models & Agent": ["huggingface", "coolpaper"],
    "Developer Tools": ["github"],
    "Infrastructure & Systems": [],
    "Research Papers": ["openreview"],
    "Finance & Markets": ["finance"],
    "Videos & Podcasts": ["youtube", "apple_podcast", "ai_exec_podcast", "xiaoyuzhou"],
    "Books & Reading": ["weread", "kindle_books", "douban"],
    "Social & Community": ["x_twitter", "reddit", "zhihu", "jike", "hackernews"],
}
TOPICS = list(TOPIC_SOURCES)
COMMUNITY = "Social & Community"
SOURCE_TOPIC = {s: topic for topic, sources in TOPIC_SOURCES.items() for s in sources}
# Source groups of the relevance score.
BOOK_SOURCES = ["weread", "kindle_books", "douban"]
BOOK_TAGS = ["book", "books", "reading"]
MEDIA_TOPIC_SOURCES = ["youtube", "apple_podcast", "ai_exec_podcast", "xiaoyuzhou"]
PRIMARY_SOURCES = [
    "openai", "anthropic", "google_blog", "deepmind", "huggingface", "openreview", "coolpaper", "papers_cool", "alphaxiv",
]
BROAD_SOURCES = [
    "x_twitter", "reddit", "hackernews", "zhihu", "jike", "youtube", "apple_podcast", "ai_exec_podcast", "xiaoyuzhou",
    "producthunt", "cn_tech_blog", "blog_feeds", "github",
]
# Markers of the topic rules.
SKILL_MARKERS = [
    " skill", "skills ", " ai助手", "ai 助手", "ai assistant", "mcp", "开放能力", "开放平台", "服务调用", "一句话下单",
    "tool use", "function calling",
]
SERVICE_MARKERS = [
    "跑腿", "下单", "外卖", "打车", "配送", "预约", "上门", "酒店", "机票", "real-world service",
]
MODEL_MARKERS = [
    "deepseek", "kimi", "moonshot", "glm", "zhipu", "minimax", "xai", "grok", "llama", "meta", "thinking machines",
    "thinking machine", "cursor", "大模型", "模型升级", "版本升级", "超长上下文", "多模态",
]
SKILL_REASON = "traditional service opened Skill/API so AI assistants can directly call a real-world service"
ROUTE_REASON = (
    "AI paradigm shift: credible alternative to the mainstream scale route, e.g. representation-space generation, "
    "continual learning, or self-improvement"
)


def source_topic(source: Column) -> Column:
    """Topic a source belongs to by default; null when it has none."""
    return F.try_element_at(constant_map(SOURCE_TOPIC), source)


def _terms(lexicon: Lexicon) -> TermFinder:
    return TermFinder([*lexicon["relevance_terms"], *lexicon["finance_relevant"], *SKILL_MARKERS, *SERVICE_MARKERS, *MODEL_MARKERS])


def with_routing_text(items: DataFrame, lexicon: Lexicon | None = None) -> DataFrame:
    """Adds the search text, lower-case tags and the terms in the text (``found``), computed once for all rules below."""
    texts = items.withColumns({
        "search": T.search_text(F.col("source"), F.col("title"), F.col("content"), F.col("tags"), F.col("author"), F.col("extra")),
        "low_tags": F.transform(F.coalesce("tags", term_array([])), F.lower),
    })
    return texts.withColumn("found", _terms(lexicon or Lexicon()).hits(F.col("search")))


def _is_finance() -> Column:
    return (F.col("source") == "finance") | F.array_contains("low_tags", "finance")


def finance_is_relevant(lexicon: Lexicon) -> Column:
    return _is_finance() & _terms(lexicon).any(F.col("found"), lexicon["finance_relevant"])


def goes_to_investment(lexicon: Lexicon) -> Column:
    return _is_finance() & ~finance_is_relevant(lexicon)


def relevance(lexicon: Lexicon) -> Column:
    """Relevance in [0, 1], three decimals. Needs ``with_routing_text``."""
    text, tags, source = F.col("search"), F.col("low_tags"), F.col("source")
    tagged = F.arrays_overlap(tags, term_array(lexicon["relevance_tags"]))
    hits = _terms(lexicon).count(F.col("found"), lexicon["relevance_terms"])
    points = lambda condition, value: F.when(condition, F.lit(value)).otherwise(0.0)
    total = (
        points(T.route_signal(text, lexicon), 0.35)
        + points(source.isin(*PRIMARY_SOURCES), 0.35)
        + points(tagged, 0.35)
        + F.least(F.lit(0.60), hits * F.lit(0.12))
        + points(text.rlike(r"(?U)\bai\b"), 0.25)
        + points((F.coalesce("arxiv_id", F.lit("")) != "") & (hits > 0), 0.15)
        + points(source.isin("github", "producthunt") & (hits > 0), 0.10)
        - points(source.isin(*BROAD_SOURCES) & ~tagged & (hits == 0), 0.30)
    )
    book = source.isin(*BOOK_SOURCES) | F.arrays_overlap(tags, term_array(BOOK_TAGS))
    return (F.when(book, 1.0).when(finance_is_relevant(lexicon), 0.9)
            .otherwise(F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)), 3)))


def with_relevance(items: DataFrame, lexicon: Lexicon | None = None, overrides: Mapping[str, Any] | None = None) -> DataFrame:
    """Adds ``relevance`` and ``route`` (kept, investment, filtered)."""
    lexicon = lexicon or Lexicon()
    settings = policy("prefilter", dict(overrides or {}))
    staged = with_routing_text(items, lexicon).withColumns({
        "relevance": relevance(lexicon), "to_investment": goes_to_investment(lexicon)})
    kept = F.lit(True) if not settings["enabled"] else F.col("relevance") >= float(settings["min_score"])
    return staged.withColumn(
        "route", F.when(F.col("to_investment"), "investment").when(kept, "kept").otherwise("filtered"))


def topic_scores(lexicon: Lexicon) -> Column:
    """Array of (score, order, topic). Needs ``with_routing_text``."""
    source, tags = F.col("source"), F.col("low_tags")
    words = F.array_distinct(F.regexp_extract_all(
        F.col("search"), F.lit(r"([a-zA-Z][a-zA-Z0-9_+.-]{1,}|[一-鿿]{2,})"), F.lit(1)))
    mapped = source_topic(source)
    rows = []
    for order, topic in enumerate(TOPICS):
        terms = lexicon.topics.get(topic, ())
        score = F.when(mapped == topic, 0.45).otherwise(0.0)
        if topic == "Research Papers":
            score = score + F.when(F.coalesce("arxiv_id", F.lit("")) != "", 1.0).otherwise(0.0)
        score = score + F.least(F.lit(0.45), token_hits(tags, terms) * F.lit(0.18))
        score = score + F.least(F.lit(0.55), token_hits(words, terms) * F.lit(0.08))
        if topic == "Videos & Podcasts":
            score = score + F.when(source.isin(*MEDIA_TOPIC_SOURCES), 0.35).otherwise(0.0)
        if topic == "Books & Reading":
            score = score + F.when(source.isin(*BOOK_SOURCES), 0.50).otherwise(0.0)
        rows.append(F.struct(score.alias("score"), F.lit(-order).alias("order"), F.lit(topic).alias("topic")))
    return F.array(*rows)


def _decision(topic: Column | str, confidence: Column | float, method: Column | str, reason: Column | str,
              model_used: Column | bool = False) -> Column:
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(lit(topic).alias("topic"), lit(confidence).cast("double").alias("confidence"),
                    lit(method).alias("method"), lit(reason).alias("reason"), lit(model_used).alias("model_used"))


def with_topic(items: DataFrame, lexicon: Lexicon | None = None, overrides: Mapping[str, Any] | None = None) -> DataFrame:
    """Adds the struct ``topic_info``: explicit decision, service rule, route rule, tag rule, keyword vote of
    an uncertain source, else the source's own topic."""
    lexicon = lexicon or Lexicon()
    settings = policy("topic_classifier", dict(overrides or {}))
    parsed = F.try_parse_json("extra")
    given = lambda path, kind="string": F.try_variant_get(parsed, path, kind)
    valid = lambda value: F.when(F.trim(value).isin(*TOPICS), F.trim(value))
    staged = with_routing_text(items, lexicon).withColumns({
        "_explicit": F.coalesce(*[valid(given(p)) for p in ("$.topic_classifier.topic", "$.ai_topic", "$.topic", "$.category")]),
        "_confidence": F.coalesce(F.nullif(given("$.topic_classifier.confidence", "double"), F.lit(0.0)), F.lit(1.0)),
        "_method": F.coalesce(F.nullif(given("$.topic_classifier.method"), F.lit("")), F.lit("explicit_override")),
        "_reason": F.coalesce(F.nullif(given("$.topic_classifier.reason"), F.lit("")), F.lit("explicit topic override from item.extra")),
        "_model": F.coalesce(given("$.topic_classifier.model_used", "boolean"), F.lit(False)),
        "_scores": topic_scores(lexicon),
    })
    text, source, terms = F.col("search"), F.col("source"), _terms(lexicon)
    broad = source.isin("hackernews", "alphaxiv")
    by_tag = (
        F.when(broad & F.array_contains("low_tags", "infra"), _decision(
            "Infrastructure & Systems", 0.88, "deterministic_tag_override", "tag:infra override for broad/community source"))
        .when(broad & F.array_contains("low_tags", "ai"), _decision(
            "AI Models & Agent", 0.86, "deterministic_tag_override", "tag:ai override for broad/community source")))
    mapped = source_topic(source)
    body = F.lower(F.concat_ws(" ", T.text_or_empty(F.col("title")), T.text_or_empty(F.col("content"))))
    home = F.coalesce(mapped, F.lit(COMMUNITY))
    # the search text holds the body: only a marker in it can be one in the body
    marked = terms.any(F.col("found"), MODEL_MARKERS) & any_substring(body, MODEL_MARKERS)
    home = F.when((home == COMMUNITY) & marked, "AI Models & Agent").otherwise(home)
    has_paper = F.coalesce("arxiv_id", F.lit("")) != ""
    default_topic = F.when(has_paper, "Research Papers").otherwise(home)
    default_confidence = F.when(has_paper, 0.95).when(mapped.isNotNull(), 0.88).otherwise(0.55)
    default_reason = F.when(has_paper, "arxiv_id present").otherwise(
        F.concat(F.lit("source mapping: "), F.when(T.text_or_empty(source) != "", source).otherwise("unknown")))

    ordered = F.sort_array("_scores", asc=False)
    best, second = F.element_at(ordered, 1), F.element_at(ordered, 2)
    staged = staged.withColumns({
        "_by_tag": by_tag, "_best": best["score"], "_best_topic": best["topic"], "_margin": best["score"] - second["score"],
        "_default": _decision(default_topic, default_confidence, "deterministic_source_route", default_reason)})
    vote_confidence = F.round(F.least(F.lit(0.98), F.greatest(
        F.col("_default.confidence"), F.lit(0.45) + F.col("_best") * 0.35 + F.col("_margin") * 0.20)), 2)
    vote = _decision(
        F.col("_best_topic"), vote_confidence, "deterministic_topic_classifier",
        F.format_string("uncertain source keyword/topic score: %s=%.2f, margin=%.2f", "_best_topic", "_best", "_margin"))
    uncertain = source.isin(*settings["uncertain_sources"])
    out = (
        F.when(F.col("_explicit").isNotNull(),
               _decision(F.col("_explicit"), F.col("_confidence"), F.col("_method"), F.col("_reason"), F.col("_model")))
        .when(terms.any(F.col("found"), SKILL_MARKERS) & terms.any(F.col("found"), SERVICE_MARKERS),
              _decision("Developer Tools", 0.95, "deterministic_service_skill_promotion", SKILL_REASON))
        .when(T.route_signal(text, lexicon), _decision("AI Models & Agent", 0.94, "deterministic_paradigm_shift_route", ROUTE_REASON)))
    if settings["enabled"]:
        out = (out.when(F.col("_by_tag").isNotNull(), F.col("_by_tag"))
               .when(uncertain & (F.col("_best") >= 0.75) & (F.col("_margin") >= 0.12), vote)
               .otherwise(F.col("_default")))
    else:
        plain = F.coalesce("_by_tag", "_default")
        out = out.otherwise(_decision(plain["topic"], plain["confidence"], "legacy_deterministic", plain["reason"]))
    scratch = ["_explicit", "_confidence", "_method", "_reason", "_model", "_scores", "_by_tag", "_best", "_best_topic",
               "_margin", "_default", "search", "low_tags", "found"]
    return staged.withColumn("topic_info", out).drop(*[c for c in scratch if c not in items.columns])


def with_override(items: DataFrame, override: DataFrame) -> DataFrame:
    """Topic decisions made elsewhere (content_hash, topic, confidence, method, reason): they win over the rules."""
    given = override.select("content_hash", F.struct(
        "topic", F.col("confidence").cast("double").alias("confidence"), "method", "reason",
        F.lit(True).alias("model_used")).alias("_given"))
    return items.join(given, "content_hash", "left").withColumn(
        "topic_info", F.when(F.col("_given.topic").isin(*TOPICS), F.col("_given")).otherwise(F.col("topic_info"))).drop("_given")


def group_by_category(items: DataFrame, lexicon: Lexicon | None = None, categories: list[str] | None = None,
                      by: list[str] | None = None) -> DataFrame:
    """Adds ``category`` (unknown ones go to the community bucket) and the rank inside it by score."""
    staged = with_topic(items, lexicon)
    known = F.col("topic_info.topic").isin(*(categories or TOPICS))
    placed = staged.withColumn("category", F.when(known, F.col("topic_info.topic")).otherwise(COMMUNITY))
    # written first: the ranges of the rank are found from a sample, which would run the rules above a second time
    return ranked(cut_lineage(placed), by_score(), [*(by or []), "category"], "category_rank")


# Source groups of the audit labels.
SOCIAL_SOURCES = ["x_twitter", "reddit", "zhihu", "jike"]


def negative_labels(route: Column, lexicon: Lexicon) -> Column:
    """Audit labels of a row on its route (kept, investment or filtered)."""
    source = F.lower(T.text_or_empty(F.col("source")))
    text = T.eval_text(F.col("title"), F.col("content"), F.col("author"), F.col("tags"), F.col("url"))
    tags = F.transform(F.coalesce("tags", term_array([])), F.lower)
    finance = (route == "investment") & ((source == "finance") | F.array_contains(tags, "finance"))
    labels = F.array_compact(F.array(
        F.when(finance, F.when(any_substring(text, ["personal finance", "portfolio", "etf"]), "non_ai_personal_finance")
               .when(any_substring(text, lexicon["finance_generic"]), "non_ai_generic_finance").otherwise("non_ai_finance")),
        F.when(source.isin(*SOCIAL_SOURCES) & any_substring(text, lexicon["social_opinion"]), "single_social_opinion"),
        F.when((source == "hackernews") & text.contains("show hn"), "single_source_hn_launch"),
        F.when((source == "producthunt") & any_substring(text, lexicon["product_launch"]),
               F.when(F.col("score") < 100, "producthunt_low_adoption").otherwise("single_source_product_launch")),
        F.when(source.isin(*MEDIA_TOPIC_SOURCES) & any_substring(text, lexicon["generic_media"]),
               F.when(source == "youtube", "generic_video_course").otherwise("generic_podcast_interview"))))
    return F.when((route == "filtered") & (F.size(labels) == 0), F.array(F.lit("low_ai_relevance"))).otherwise(labels)
