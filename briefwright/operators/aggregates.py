"""Aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from briefwright.functions import text as T
from briefwright.functions.urls import source_identity, source_name
from briefwright.lexicon import Lexicon
from briefwright.operators.ranking import top_k
from briefwright.operators.registry import Registry
from briefwright.operators.relevance import negative_labels


def source_counts(items: DataFrame) -> DataFrame:
    name = F.when(T.text_or_empty(F.col("source")) != "", F.col("source")).otherwise("unknown").alias("source")
    return items.groupBy(name).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "source")


def identity_of(source: Column, url: Column) -> Column:
    return source_identity(source_name(source, url), url)


def source_diversity(items: DataFrame, by: Sequence[str]) -> DataFrame:
    """Number of distinct independent bodies per group."""
    return items.groupBy(*by).agg(F.count_distinct(F.nullif(identity_of(F.col("source"), F.col("url")), F.lit(""))).alias("diversity"))


def evidence_sources(items: DataFrame, by: Sequence[str], max_sources: int = 6, by_identity: bool = False,
                     per_source_cap: int | None = None, registry: Registry | None = None) -> DataFrame:
    """Weighted evidence of a group: one row per identity (or link), largest weight and count, at most
    ``per_source_cap`` of a source by first appearance, heaviest first."""
    registry = registry or Registry()
    name = source_name(F.trim(F.coalesce("source", F.lit(""))), F.trim(F.coalesce("url", F.lit(""))))
    url = F.trim(F.coalesce("url", F.lit("")))
    identity = source_identity(name, url)
    key = F.lower(identity if by_identity else F.when(url != "", url).otherwise(name))
    given = F.coalesce("source_weight", F.lit(0.0)) if "source_weight" in items.columns else F.lit(0.0)
    rows = items.select(*by, "pos", name.alias("name"), url.alias("url"), identity.alias("identity"), key.alias("key"),
                        F.when(given != 0, given).otherwise(registry.weight(name, url)).alias("weight")).where("key <> ''")
    first = F.struct("pos", "name", "url", "identity")
    merged = rows.groupBy(*by, "key").agg(F.max("weight").alias("weight"), F.count(F.lit(1)).alias("count"), F.min(first).alias("first"))
    flat = merged.select(*by, "first.*", "weight", "count")
    if per_source_cap is not None:
        flat = top_k(flat.withColumn("_s", F.lower("name")), [*by, "_s"], [F.col("pos")], per_source_cap).drop("_s")
    return top_k(flat, by, [F.col("weight").desc(), F.lower("name"), F.col("pos")], max_sources)


def evidence_summary(evidence: DataFrame, by: Sequence[str]) -> DataFrame:
    """Number of sources, of bodies, summed weight, and their label."""
    out = evidence.groupBy(*by).agg(
        F.count(F.lit(1)).alias("sources"), F.count_distinct(F.nullif("identity", F.lit(""))).alias("bodies"),
        F.round(F.sum(F.col("weight").cast("decimal(18,4)")), 2).cast("double").alias("evidence_score"))
    return out.withColumn("label", F.format_string("%d 源 / %d 主体 / 权重 %.1f", "sources", "bodies", "evidence_score"))


def review_ratings(replies: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean, count and list of official review ratings. ``replies`` is an array of variants: the rating is a
    number, a text that starts with one, or either inside ``value``."""
    rows = replies.select(*by, F.posexplode_outer("replies").alias("pos", "r"))
    get = lambda path, kind="string": F.try_variant_get("r", path, kind)
    many = F.coalesce(get("$.invitations", "array<string>"), F.expr("cast(array() as array<string>)"))
    official = F.coalesce(get("$.invitation"), F.lit("")).contains("Official_Review") | F.exists(many, lambda i: i.contains("Official_Review"))
    raw = F.when(get("$.content.rating", "map<string,variant>").isNotNull(), get("$.content.rating.value")).otherwise(get("$.content.rating"))
    rating = F.when(official, F.nullif(F.regexp_extract(raw, r"^(\d+)", 1), F.lit("")).cast("int"))
    listed = F.transform(F.sort_array(F.collect_list(F.when(rating.isNotNull(), F.struct("pos", rating.alias("v"))))), lambda x: x["v"])
    return rows.groupBy(*by).agg(F.avg(rating).alias("avg_rating"), F.count(rating).alias("num_reviews"), listed.alias("ratings"))


def feedback_summary(feedback: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(kind, value, n): counts per label, quality, issue and action kind; sample and event actions share a kind."""
    action = lambda c: F.col(f"{c}.action")
    pair = lambda kind, value: F.struct(F.lit(kind).alias("kind"), F.trim(value).alias("value"))
    issues = F.transform(F.coalesce("issue_labels", F.expr("cast(array() as array<string>)")), lambda v: pair("issue", v))
    rows = F.concat(F.array(
        pair("label", F.col("label")), pair("report_quality", F.col("report_quality")), pair("source_action", action("source_quality")),
        pair("event_action", action("event_action")), pair("event_action", action("sample_action")),
        pair("item_action", action("item_action")), pair("topic_action", action("topic_action"))), issues)
    flat = feedback.select(*by, F.explode(rows).alias("p")).select(*by, "p.*").where("value is not null and value <> ''")
    return flat.groupBy(*by, "kind", "value").agg(F.count(F.lit(1)).alias("n"))


def feedback_rating(feedback: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return feedback.groupBy(*by).agg(F.count(F.lit(1)).alias("count"), F.round(F.avg("rating"), 4).alias("rating_avg"))


def label_audit(routed: DataFrame, lexicon: Lexicon | None = None, examples: int = 5) -> tuple[DataFrame, DataFrame]:
    """(label, n) and the first examples of every label, routes in the order kept, investment, filtered."""
    lexicon = lexicon or Lexicon()
    order = F.when(F.col("route") == "kept", 1).when(F.col("route") == "investment", 2).otherwise(3)
    rows = routed.withColumn("label", F.explode(negative_labels(F.col("route"), lexicon)))
    counts = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    shown = [c for c in ("label", "title", "source", "url", "route", "score", "relevance", "pos") if c in rows.columns]
    first = top_k(rows.withColumn("_o", order), ["label"], [F.col("_o"), F.col("pos")], examples)
    return counts, first.select(*shown)


def history_summary(daily: DataFrame) -> DataFrame:
    """Days (date, counts, metrics, cost_time maps, feedback) to (kind, key, value): metric means, count and
    cost sums. A day without a key counts as 0."""
    days = daily.agg(F.count_distinct("date").alias("days"))
    melt = lambda c, kind: daily.select(F.lit(kind).alias("kind"), F.explode(F.col(c)).alias("key", "value"))
    feedback = daily.select("feedback.labels", "feedback.issue_labels", "feedback.count")
    rows = (melt("counts", "count").unionByName(melt("metrics", "metric")).unionByName(melt("cost_time", "cost"))
            .unionByName(feedback.select(F.lit("feedback_label").alias("kind"), F.explode("labels").alias("key", "value")))
            .unionByName(feedback.select(F.lit("feedback_issue").alias("kind"), F.explode("issue_labels").alias("key", "value")))
            .unionByName(feedback.select(F.lit("feedback").alias("kind"), F.lit("count").alias("key"), F.col("count").alias("value"))))
    sums = rows.groupBy("kind", "key").agg(F.sum(F.col("value").cast("decimal(28,8)")).alias("total"))
    # one row: the number of days
    out = sums.withColumn("_one", F.lit(1)).join(F.broadcast(days.withColumn("_one", F.lit(1))), "_one")
    value = F.when(F.col("kind") == "metric", F.round(F.col("total") / F.col("days"), 4)).otherwise(F.round("total", 8))
    return out.select("kind", "key", value.cast("double").alias("value"))


def merge_count_maps(df: DataFrame, column: str) -> DataFrame:
    rows = df.select(F.explode(column).alias("key", "value"))
    return rows.groupBy("key").agg(F.sum("value").alias("n")).orderBy(F.col("n").desc(), "key")


def term_source_counts(items: DataFrame, terms: str, by: Sequence[str] = ()) -> DataFrame:
    """Occurrences and distinct sources of every term of an array column."""
    rows = items.select(*by, "source", F.explode(terms).alias("term"))
    per_source = rows.groupBy(*by, "term", "source").agg(F.count(F.lit(1)).alias("n"))
    return per_source.groupBy(*by, "term").agg(F.sum("n").alias("occurrences"), F.count(F.lit(1)).alias("sources"))


def platform_statistics(items: DataFrame, categories: DataFrame, top: int = 12) -> DataFrame:
    """(kind, name, n): the largest sources and categories."""
    counts = items.groupBy(F.col("source").alias("name")).agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("source"))
    cats = categories.groupBy(F.col("category").alias("name")).agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("category"))
    return top_k(counts.unionByName(cats), ["kind"], [F.col("n").desc(), F.col("name")], top).select("kind", "name", "n")


def run_counters(raw: DataFrame, clean: DataFrame, blocked: DataFrame) -> DataFrame:
    """Per source the number of raw, clean and blocked rows."""
    rows = [df.select("source", F.lit(tag).alias("stage")) for df, tag in ((raw, "raw"), (clean, "clean"), (blocked, "blocked"))]
    merged = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return merged.groupBy("source").agg(*[F.count_if(F.col("stage") == s).alias(f"{s}_count") for s in ("raw", "clean", "blocked")])


def report_keyword_counts(cases: DataFrame, lexicon: Lexicon | None = None, key: str = "report_id") -> DataFrame:
    """(word, n, first_seen): keyword counts over report cases, first appearance for ties."""
    lexicon = lexicon or Lexicon()
    text = F.concat_ws(" ", "title", "snippet", "section")
    words = cases.select(key, "pos", F.posexplode(T.report_keywords(text, lexicon)).alias("at", "word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(key, "pos", "at")).alias("first_seen"))


def score_cases(cases: DataFrame, counts: DataFrame, lexicon: Lexicon | None = None, key: str = "report_id") -> DataFrame:
    """Cases once per link (or title) in first-appearance order, scored by the corpus counts of their keywords,
    every repetition counted, plus 2 in the first section."""
    lexicon = lexicon or Lexicon()
    dedupe = F.when(F.col("url") != "", F.col("url")).otherwise(T.normalise_point(F.col("title")))
    unique = top_k(cases.withColumn("_k", dedupe).where("_k <> ''"), ["_k"], [F.col(key), F.col("pos")], 1)
    words = unique.select("_k", F.explode(T.report_keywords(F.concat_ws(" ", "title", "snippet"), lexicon)).alias("word"))
    totals = words.join(counts.select("word", "n"), "word").groupBy("_k").agg(F.sum("n").alias("_n"))
    return (unique.join(totals, "_k", "left")
            .withColumn("case_score", F.coalesce("_n", F.lit(0)) + F.when(F.col("section").startswith("1."), 2).otherwise(0))
            .withColumn("title_length", F.length("title")).drop("_k", "_n"))


def health_lines(health: DataFrame) -> DataFrame:
    """(source, state, text): sources that recovered, with their actions, and sources still failing."""
    acts = F.array_join(F.coalesce("repair_actions", F.expr("cast(array() as array<string>)")), "; ")
    notes = F.array_join(F.coalesce("repair_notes", F.expr("cast(array() as array<string>)")), "; ")
    error = F.substring(F.replace(F.coalesce(F.nullif("error", F.lit("")), F.lit("unknown error")), F.lit("\n"), F.lit(" ")), 1, 220)
    failed = F.concat(F.lit("  - `"), "source", F.lit("`："), error, F.lit("；已尝试："),
                      F.when(acts != "", acts).otherwise("已重试一次"), F.when(notes != "", F.concat(F.lit("；备注："), notes)).otherwise(""))
    recovered = F.concat(F.lit("  - `"), "source", F.lit("`："), F.when(acts != "", acts).otherwise("retry"))
    rows = F.array_compact(F.array(
        F.when(F.col("repair_status") == "recovered", F.struct(F.lit("recovered").alias("state"), recovered.alias("text"))),
        F.when(~F.col("success"), F.struct(F.lit("failed").alias("state"), failed.alias("text")))))
    return health.select("source", F.explode(rows).alias("r")).select("source", "r.*")


def category_signals(rows: DataFrame, by: Sequence[str], top: int = 5) -> DataFrame:
    counts = rows.groupBy(*by, "category").agg(F.count(F.lit(1)).alias("n"))
    return top_k(counts, by, [F.col("n").desc(), F.col("category")], top)
