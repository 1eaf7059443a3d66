"""Daily quality metrics, all days at once."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, functions as F

from briefwright.lexicon import Lexicon
from briefwright.operators import events as E
from briefwright.operators.aggregates import label_audit
from briefwright.operators.dedup import deduplicate
from briefwright.operators.ranking import by_score, top_k
from briefwright.operators.registry import Registry
from briefwright.operators.relevance import negative_labels, with_relevance
from briefwright.session import cut_lineage


def evaluate(items: DataFrame, lexicon: Lexicon | None = None, overrides: Mapping[str, Any] | None = None,
             ranking: Mapping[str, Any] | None = None, registry: Registry | None = None, cluster_top: int | None = None) -> DataFrame:
    """One row per day (``dt``) with counts and metrics. All rows are clustered; ``cluster_top`` limits them per day if it is given."""
    lexicon = lexicon or Lexicon()
    routed = cut_lineage(with_relevance(items, lexicon, overrides).drop("search", "low_tags", "found", "to_investment"))
    routed = routed.withColumn("labels", negative_labels(F.col("route"), lexicon))
    by = ["dt"]
    kept = routed.where("route = 'kept'")
    raw_unique = deduplicate(items, by=by)
    unique = cut_lineage(deduplicate(kept.drop("labels"), by=by))
    chosen = unique if cluster_top is None else top_k(unique, by, by_score(), cluster_top)
    events, members = E.cluster_events(chosen, by, lexicon, ranking, registry)
    day = F.from_json("_run", "dt STRING")["dt"].alias("dt")
    events = events.join(members.select("_run", F.col("item_id"), "relevance"), (events["_run"] == members["_run"]) & (F.col("main.item_id") == members["item_id"])).drop(members["_run"])
    top = F.col("event_rank") <= 10
    per_event = events.groupBy(day).agg(
        F.count(F.lit(1)).alias("event_clusters"), F.sum("cluster_size").alias("cluster_input"), F.max("cluster_size").alias("max_cluster_size"),
        F.avg("cluster_size").alias("avg_cluster_size"), F.count_if(top & (F.col("relevance") >= 0.35)).alias("_good"), F.count_if(top).alias("_top"),
        F.avg(F.when(top, F.col("event_score"))).alias("_score"), F.avg(F.when(top, F.col("dimensions.reader_relevance"))).alias("_reader"))
    important = top_k(routed, by, by_score(), 30).groupBy(*by).agg(
        F.count(F.lit(1)).alias("_important"), F.count_if(F.col("route") != "filtered").alias("_important_kept"))
    base = routed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("raw_items"), F.count_if(F.col("route") == "kept").alias("kept_items"),
        F.count_if(F.col("route") == "investment").alias("investment_items"), F.count_if(F.col("route") == "filtered").alias("filtered_items"),
        F.sum(F.size("labels")).alias("negative_labels"))
    raw_n = raw_unique.groupBy(*by).agg(F.count(F.lit(1)).alias("raw_deduped"))
    kept_n = unique.groupBy(*by).agg(F.count(F.lit(1)).alias("kept_deduped"))
    rows = base.join(raw_n, by, "left").join(kept_n, by, "left").join(per_event, by, "left").join(important, by, "left")
    rows = rows.fillna(0, ["raw_deduped", "kept_deduped", "event_clusters", "cluster_input", "max_cluster_size"]).fillna(
        0.0, ["avg_cluster_size", "_score", "_reader"]).fillna(0, ["_good", "_top", "_important", "_important_kept"])
    at_least_one = lambda c: F.greatest(F.lit(1), F.col(c))
    ratio = lambda a, b: F.round(F.col(a) / at_least_one(b), 4)
    left = lambda a, b: F.round(F.greatest(F.lit(0.0), F.lit(1.0) - F.col(a) / at_least_one(b)), 4)
    return rows.select(
        "dt", "raw_items", "raw_deduped", (F.col("raw_items") - F.col("raw_deduped")).alias("raw_duplicates"), "kept_items", "investment_items",
        "filtered_items", "negative_labels", "kept_deduped", (F.col("kept_items") - F.col("kept_deduped")).alias("kept_duplicates"),
        "cluster_input", "event_clusters", (F.col("cluster_input") - F.col("event_clusters")).alias("folded_items"),
        F.round(F.lit(1.0) - F.col("kept_items") / at_least_one("raw_items"), 4).alias("reduction_ratio"),
        ratio("_good", "_top").alias("precision_at_10"), ratio("_important_kept", "_important").alias("important_recall"),
        left("event_clusters", "kept_deduped").alias("duplicate_rate"), left("event_clusters", "cluster_input").alias("fold_ratio"),
        ratio("negative_labels", "raw_items").alias("negative_label_rate"), F.round("avg_cluster_size", 4).alias("avg_cluster_size"),
        "max_cluster_size", F.round("_score", 4).alias("top10_score"), F.round("_reader", 4).alias("top10_reader_relevance"))
