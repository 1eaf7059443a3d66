"""Monthly themes: terms, ranks, one theme per item."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from briefwright.functions import text as T
from briefwright.lexicon import Lexicon, term_array
from briefwright.operators.aggregates import term_source_counts
from briefwright.operators.ranking import first_per, top_k
from briefwright.session import cut_lineage


def with_terms(items: DataFrame, lexicon: Lexicon | None = None, title_chars: int = 220, content_chars: int = 400) -> DataFrame:
    """Adds title and content cut to the lengths of which the monthly rules count terms, keywords (repetitions kept) and entity
    names. The lengths are part of the rules' definition; larger ones count further into the texts."""
    lexicon = lexicon or Lexicon()
    tags = F.array_join(F.coalesce("tags", term_array([])), " ")
    staged = items.withColumns({"title": T.trim_text(F.col("title"), title_chars), "content": T.trim_text(F.col("content"), content_chars),
                                "score": F.coalesce("score", F.lit(0.0))})
    return staged.withColumns({
        "keywords": T.keywords(F.concat_ws(" ", "title", "content", tags), lexicon),
        "entity_names": T.entity_names(F.concat_ws(" ", "title", tags), lexicon)})


def representative_items(terms: DataFrame, max_items: int = 180, by: Sequence[str] = ()) -> DataFrame:
    """First row per normalised title (score, then shorter title), blanks dropped, best ``max_items``."""
    order = [F.col("score").desc(), F.length("title"), F.col("pos")]
    unique = first_per(terms.withColumn("_norm", T.normalise_title(F.col("title"))).where("_norm <> ''"), [*by, "_norm"], order).drop("_norm")
    return top_k(unique, by, order, max_items) if by else unique.orderBy(*order).limit(max_items)


def _strength() -> Column:
    return F.col("occurrences") + 2 * F.col("sources")


def _ranked_terms(counts: DataFrame, by: Sequence[str], k: int) -> DataFrame:
    strong = counts.where((F.col("occurrences") >= 2) & ((F.col("sources") >= 2) | (F.col("occurrences") >= 4)))
    order = [_strength().desc(), F.length("term").desc(), F.lower("term"), F.col("term")]
    short = top_k(strong, by, order, k) if by else strong.orderBy(*order).limit(k)
    # at most k rows per period are left
    return short.withColumn("term_rank", F.row_number().over(Window.partitionBy(*by, F.lit(0)).orderBy(*order)))


def rank_terms(entity_counts: DataFrame, keyword_counts: DataFrame, by: Sequence[str] = (), k: int = 24) -> DataFrame:
    """(kind, term, term_rank, strength): the best entities, then the best keywords that are none of them."""
    entities = _ranked_terms(entity_counts, by, k).withColumn("kind", F.lit("entity"))
    taken = entities.select(*by, F.lower("term").alias("_low")).distinct()
    fresh = keyword_counts.withColumn("_low", F.lower("term")).join(taken, [*by, "_low"], "left_anti").drop("_low")
    words = _ranked_terms(fresh, by, k).withColumn("kind", F.lit("keyword"))
    sizes = entities.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")) if by else entities.agg(F.count(F.lit(1)).alias("_n"))
    # without periods there is one row of sizes
    words = words.join(sizes, list(by), "left") if by else words.withColumn("_one", F.lit(1)).join(
        F.broadcast(sizes.withColumn("_one", F.lit(1))), "_one").drop("_one")
    words = words.withColumn("term_rank", F.col("term_rank") + F.coalesce("_n", F.lit(0))).drop("_n")
    return entities.unionByName(words).withColumn("strength", _strength())


def assign_themes(kept: DataFrame, ranks: DataFrame, entity_counts: DataFrame, keyword_counts: DataFrame,
                  by: Sequence[str] = (), top_entities: int = 16, top_terms: int = 24) -> DataFrame:
    """Adds ``theme``: strongest of the item's entities among the top 16, else of its keywords among the top 24
    terms (entities first), else its source. ``kept`` holds a unique ``pos`` per period."""
    keys = [*by, "pos"]

    def best(column: str, allowed: DataFrame, counts: DataFrame, name: str) -> DataFrame:
        terms = kept.select(*keys, F.explode(F.array_distinct(column)).alias("term"))
        hits = terms.withColumn("_low", F.lower("term")).join(allowed.select(*by, F.lower("term").alias("_low")).distinct(), [*by, "_low"])
        scored = hits.join(counts, [*by, "term"])
        return scored.groupBy(*keys).agg(F.min_by("term", F.struct((-_strength()).alias("s"), F.lower("term").alias("l"), "term")).alias(name))

    entities = ranks.where((F.col("kind") == "entity") & (F.col("term_rank") <= top_entities))
    terms = ranks.where(F.col("term_rank") <= top_terms)
    by_entity = best("entity_names", entities, entity_counts, "_entity")
    by_word = best("keywords", terms, keyword_counts, "_word")
    source = F.when(T.text_or_empty(F.col("source")) != "", F.col("source")).otherwise("other")
    return (kept.join(by_entity, keys, "left").join(by_word, keys, "left")
            .withColumn("theme", F.coalesce("_entity", "_word", source)).drop("_entity", "_word"))


def theme_rollup(themed: DataFrame, by: Sequence[str] = (), max_themes: int = 12, items_per_theme: int = 8) -> tuple[DataFrame, DataFrame]:
    """(themes, items): themes ordered by source variety, size and score of their best items, and the best
    items of the leading themes."""
    order = [F.col("score").desc(), F.length("title"), F.col("pos")]
    w = Window.partitionBy(*by, "theme").orderBy(*order)
    best = themed.withColumn("item_rank", F.row_number().over(w)).where(F.col("item_rank") <= items_per_theme)
    first_item = F.min(F.struct((-F.col("score")).alias("s"), F.length("title").alias("l"), "pos")).alias("first_item")
    size = themed.groupBy(*by, "theme").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("source").alias("source_variety"), first_item)
    weight = best.groupBy(*by, "theme").agg(F.sum(F.col("score").cast("decimal(28,6)")).alias("score_sum"))
    ranked_themes = size.join(weight, [*by, "theme"])
    theme_order = [F.col("source_variety").desc(), F.col("n").desc(), F.col("score_sum").desc(), F.col("first_item")]
    top = top_k(ranked_themes, by, theme_order, max_themes) if by else ranked_themes.orderBy(*theme_order).limit(max_themes)
    tw = Window.partitionBy(*by, F.lit(0)).orderBy(*theme_order)
    themes = top.withColumn("theme_rank", F.row_number().over(tw)).drop("first_item")
    return themes, best.join(themes.select(*by, "theme", "theme_rank"), [*by, "theme"])


def monthly_themes(items: DataFrame, by: Sequence[str] = (), lexicon: Lexicon | None = None, max_items: int = 180,
                   max_themes: int = 12, items_per_theme: int = 8) -> dict[str, DataFrame]:
    """All theme tables of one or many periods (``by`` names the period)."""
    # each table is used by several of the next: written once instead of computed again
    terms = cut_lineage(with_terms(items, lexicon))
    entity_counts = cut_lineage(term_source_counts(terms, "entity_names", by))
    keyword_counts = cut_lineage(term_source_counts(terms, "keywords", by))
    ranks = cut_lineage(rank_terms(entity_counts, keyword_counts, by))
    kept = cut_lineage(representative_items(terms, max_items, by))
    themed = cut_lineage(assign_themes(kept, ranks, entity_counts, keyword_counts, by))
    themes, best = theme_rollup(themed, by, max_themes, items_per_theme)
    return {"terms": ranks, "kept": kept, "themes": cut_lineage(themes), "items": cut_lineage(best)}


def top_cases(theme_items: DataFrame, max_themes: int = 5, per_theme: int = 2) -> DataFrame:
    return theme_items.where((F.col("theme_rank") <= max_themes) & (F.col("item_rank") <= per_theme)).withColumn(
        "content", T.trim_text(F.col("content"), 160))


def reading_list(theme_items: DataFrame, by: Sequence[str] = (), limit: int = 8) -> DataFrame:
    """First distinct links in theme order."""
    order = [F.col("theme_rank"), F.col("item_rank")]
    key = F.when(T.text_or_empty(F.col("url")) != "", F.col("url")).otherwise(T.text_or_empty(F.col("title")))
    unique = first_per(theme_items.withColumn("_k", key).where("_k <> ''"), [*by, "_k"], order).drop("_k")
    short = top_k(unique, by, order, limit) if by else unique.orderBy(*order).limit(limit)
    return short.withColumn("content", T.trim_text(F.col("content"), 120))
