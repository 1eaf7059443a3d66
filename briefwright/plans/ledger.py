"""Coverage ledger and chunks of ranked rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from briefwright.functions.text import text_or_empty
from briefwright.operators.joins import ledger_key
from briefwright.operators.ranking import first_per, top_k
from briefwright.plans.chunks import size_bounded_chunks  # noqa: F401 - part of the ledger's plans

RUN = ["_run"]


def priority_order() -> list[Column]:
    """Inside a category: headlines by selection rank, then score, weight and title."""
    chosen = F.col("selected") & F.col("selection_rank").isNotNull()
    return [F.when(chosen, 1).otherwise(0).desc(), F.when(chosen, F.col("selection_rank")).otherwise(0).asc(),
            F.coalesce("score", F.lit(0.0)).desc(), F.coalesce("source_weight", F.lit(0.0)).desc(), text_or_empty(F.col("event_title")).desc(),
            F.col("event_rank")]


def category_priorities(rows: DataFrame, per_category: int = 8) -> DataFrame:
    """First rows of every category with their place (``category_rank``)."""
    short = top_k(rows, [*RUN, "category"], priority_order(), per_category)
    return short.withColumn("category_rank", F.row_number().over(Window.partitionBy(*RUN, "category").orderBy(*priority_order())))


def importance_ledger(rows: DataFrame, top_n: int, max_items: int = 80, required: int = 35) -> DataFrame:
    """Best rows over all categories, once per ledger key, with ``priority`` and ``must_cover``."""
    order = [F.coalesce("score", F.lit(0.0)).desc(), F.coalesce("source_weight", F.lit(0.0)).desc(), F.col("event_title").desc(), F.col("event_rank")]
    keyed = rows.withColumn("ledger_key", ledger_key(F.col("event_id"), F.col("url"), F.col("event_title"), F.col("source")))
    best = top_k(first_per(keyed, [*RUN, "ledger_key"], order), RUN, order, max_items)
    ranked = best.withColumn("priority", F.row_number().over(Window.partitionBy(*RUN).orderBy(*order)))
    return ranked.withColumn("must_cover", F.col("priority") <= max(top_n, min(required, max_items)))


def row_size(*columns: str) -> Column:
    """Characters of a row as compact JSON."""
    return F.length(F.to_json(F.struct(*columns)))


def chunk_rows(rows: DataFrame, by: Sequence[str], best: int = 12, per_category: int = 3) -> DataFrame:
    """Rows a chunk summary shows: ``kind`` best (by score and weight) and ``category`` (first of each)."""
    order = [F.coalesce("score", F.lit(0.0)).desc(), F.coalesce("source_weight", F.lit(0.0)).desc(), F.col("ord")]
    head = top_k(rows, by, order, best).withColumn("kind", F.lit("best")).withColumn(
        "place", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    inner = [*by, "category"]
    group = top_k(rows, inner, priority_order(), per_category).withColumn("kind", F.lit("category")).withColumn(
        "place", F.row_number().over(Window.partitionBy(*inner).orderBy(*priority_order())))
    return head.unionByName(group)
