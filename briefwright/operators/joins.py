"""Joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from briefwright.functions import markdown as M, text as T
from briefwright.functions.urls import heat_is_open, video_id
from briefwright.operators.ranking import first_per, top_k
from briefwright.operators.similarity import similar_within


def with_hash(items: DataFrame) -> DataFrame:
    return items.withColumn("content_hash", T.content_hash(F.col("url"), F.col("source"), F.col("title")))


def unseen(items: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows whose content hash and paper id were never published. Two equi anti joins: one OR condition would
    become a nested loop."""
    rows = items if "content_hash" in items.columns else with_hash(items)
    by_hash = rows.join(seen.select("content_hash").distinct(), "content_hash", "left_anti")
    papers = seen.where("arxiv_id is not null and arxiv_id <> ''").select(F.col("arxiv_id").alias("_paper")).distinct()
    # most rows have no paper id; a key of their own, which no paper has, spreads them instead of meeting in one task
    own = F.concat(F.lit("\u0000"), F.coalesce("content_hash", F.lit("")))
    paper = F.when(F.coalesce("arxiv_id", F.lit("")) != "", F.col("arxiv_id")).otherwise(own)
    return by_hash.withColumn("_paper", paper).join(papers, "_paper", "left_anti").select(rows.columns)


def with_video_stats(items: DataFrame, stats: DataFrame) -> DataFrame:
    """Score from engagement per video; rows without statistics keep their score. Of repeated statistics the latest
    (``fetched_at``, if there is such a column) and then the largest counts hold."""
    newest = [F.col("fetched_at").desc_nulls_last()] if "fetched_at" in stats.columns else []
    counts = [F.col(c).cast("bigint").desc_nulls_last() for c in ("viewCount", "likeCount", "commentCount")]
    s = first_per(stats, ["video_id"], [*newest, *counts]).select(
        "video_id", *[F.coalesce(F.col(c).cast("bigint"), F.lit(0)).alias(c) for c in ("viewCount", "likeCount", "commentCount")],
        F.lit(True).alias("_found"))
    rate = (F.col("likeCount") + F.col("commentCount")) / F.greatest(F.col("viewCount"), F.lit(1))
    joined = items.withColumn("video_id", video_id(F.col("url"))).join(s, "video_id", "left")
    return joined.withColumns({
        "engagement_rate": rate,
        "score": F.when(F.col("_found"), rate * 1e6).otherwise(F.col("score"))}).drop("_found")


def nearest_position(targets: DataFrame, values: DataFrame, key: str, window: int = 2000) -> DataFrame:
    """For each target (key, pos) the value of the same key with the smallest distance, at most ``window`` away;
    ties go to the earlier one. Position buckets make it an equi join with three probes per target."""
    t = targets.withColumn("_b", F.explode(F.array(*[F.floor(F.col("pos") / window) + d for d in (-1, 0, 1)])))
    v = values.select(F.col(key).alias("_k"), F.floor(F.col("pos") / window).alias("_vb"), F.col("pos").alias("_vpos"), "value")
    dist = F.abs(F.col("pos") - F.col("_vpos"))
    hits = t.join(v, (F.col(key) == F.col("_k")) & (F.col("_b") == F.col("_vb")) & (dist <= window))
    best = hits.groupBy(key, "pos").agg(F.min_by("value", F.struct(dist, F.col("_vpos"))).alias("value"))
    return targets.join(best, [key, "pos"], "left")


def with_link_status(items: DataFrame, url_status: DataFrame) -> DataFrame:
    """Adds ``is_open``: null for rows without link, false for links with no known status."""
    status = url_status.groupBy("url").agg(F.bool_or(heat_is_open(F.col("status"))).alias("_open"))
    keyed = items.withColumn("_link", F.trim(F.coalesce("url", F.lit(""))))
    # rows without link get keys that no link has, spread over the tasks
    plain = [c for c, kind in items.dtypes if not kind.startswith(("map", "variant"))]
    keyed = keyed.withColumn("_u", F.when(F.col("_link") != "", F.col("_link")).otherwise(F.concat(F.lit("\u0000"), F.xxhash64(*plain).cast("string"))))
    joined = keyed.join(status.withColumnRenamed("url", "_u"), "_u", "left")
    return joined.withColumn("is_open", F.when(F.col("_link") != "", F.coalesce("_open", F.lit(False)))).drop("_u", "_link", "_open")


def open_links(items: DataFrame, url_status: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept rows, counters): rows whose link is dead are dropped, rows without link stay."""
    marked = with_link_status(items, url_status)
    counters = marked.agg(
        F.count_distinct(F.when(F.trim("url") != "", F.trim("url"))).alias("checked"),
        F.count_if(F.coalesce("is_open", F.lit(True))).alias("kept"), F.count_if(~F.col("is_open")).alias("dropped"))
    return marked.where("coalesce(is_open, true)").drop("is_open"), counters


def ledger_key(event_id: Column, url: Column, title: Column, source: Column) -> Column:
    norm = lambda c: F.lower(F.trim(T.text_or_empty(c)))
    return (F.when(norm(event_id) != "", F.concat(F.lit("event:"), norm(event_id)))
            .when(norm(url) != "", F.concat(F.lit("url:"), norm(url)))
            .otherwise(F.concat(F.lit("title:"), F.lower(T.text_or_empty(source)), F.lit(":"), T.squeeze(F.lower(T.text_or_empty(title))))))


def mentions(markdown: Column, compacted: Column, url: Column, title: Column) -> Column:
    """The text holds the link, the display title, or the first 24 characters of the title without spaces."""
    link, shown = F.trim(T.text_or_empty(url)), M.display_title(title)
    dense = F.regexp_replace(shown, r"(?U)\s+", "")
    return (((link != "") & markdown.contains(link)) | ((shown != "") & markdown.contains(shown))
            | ((F.length(dense) >= 12) & compacted.contains(F.substring(dense, 1, 24))))


def missing_coverage(reports: DataFrame, rows: DataFrame, required: int = 35, per_category: int = 1,
                     key: str = "report_id") -> DataFrame:
    """Ledger rows a report must mention and does not: the first ``required`` by priority, and the first
    ``per_category`` of each category of which nothing is mentioned. ``rows`` holds key, priority,
    category_rank, category, event_id, title, url, source."""
    texts = reports.select(key, F.col("markdown"), F.regexp_replace("markdown", r"(?U)\s+", "").alias("_dense"))
    marked = rows.join(texts, key).withColumns({
        "covered": mentions(F.col("markdown"), F.col("_dense"), F.col("url"), F.col("title")),
        "ledger_key": ledger_key(F.col("event_id"), F.col("url"), F.col("title"), F.col("source"))}).drop("markdown", "_dense")
    category = marked.groupBy(key, "category").agg(F.bool_or("covered").alias("category_covered"))
    wanted = marked.join(category, [key, "category"]).where(
        (F.col("priority") <= required) | (~F.col("category_covered") & (F.col("category_rank") <= per_category)))
    return first_per(wanted.where("not covered"), [key, "ledger_key"], [F.col("priority")])


def source_counts_wide(raw: DataFrame, kept: DataFrame, events: DataFrame, selected: DataFrame) -> DataFrame:
    """Per source the number of raw, kept, event and selected rows, and selected/raw."""
    name = F.when(T.text_or_empty(F.col("source")) != "", F.col("source")).otherwise("unknown").alias("source")
    tagged = [df.select(name, F.lit(tag).alias("stage")) for df, tag in (
        (raw, "raw"), (kept, "kept"), (events, "events"), (selected, "selected"))]
    rows = tagged[0].unionByName(tagged[1]).unionByName(tagged[2]).unionByName(tagged[3])
    counts = rows.groupBy("source").agg(*[F.count_if(F.col("stage") == s).alias(s) for s in ("raw", "kept", "events", "selected")])
    return counts.withColumn("selected_yield", F.when(F.col("raw") > 0, F.round(F.col("selected") / F.col("raw"), 4)).otherwise(0.0))


def latest_editions(editions: DataFrame) -> DataFrame:
    """Row with the largest year per conference."""
    return editions.groupBy("name").agg(F.max_by(F.struct(*editions.columns), F.struct("year", *[c for c in editions.columns if c != "year"])).alias("e")).select("e.*")


def editions_of(conferences: DataFrame, editions: DataFrame, current_year: int) -> DataFrame:
    """Edition year of every conference; the current year when none is known."""
    return conferences.join(latest_editions(editions).select("name", "year"), "name", "left").withColumn(
        "year", F.coalesce("year", F.lit(current_year)))


def cases_of_months(period_meta: DataFrame, limit: int = 10) -> DataFrame:
    """Top cases of all months in month order, first appearance of a link or title, month attached."""
    cases = period_meta.select("month", F.posexplode("top_cases").alias("pos", "c")).select("month", "pos", "c.*")
    keyed = cases.withColumn("_k", F.when(T.text_or_empty(F.col("url")) != "", F.col("url")).otherwise(T.text_or_empty(F.col("title")))).where("_k <> ''")
    return first_per(keyed, ["_k"], [F.col("month"), F.col("pos")]).drop("_k").orderBy("month", "pos").limit(limit)


def compare_versions(old: DataFrame, new: DataFrame, sections: Mapping[str, Sequence[str]], key: str = "month") -> DataFrame:
    """Sections of two report versions of a month side by side; absent ones are marked."""
    def pick(df: DataFrame, name: str) -> DataFrame:
        rows = []
        for label, titles in sections.items():
            found = F.coalesce(*[F.nullif(T.strip(M.section_body(F.col("markdown"), t)), F.lit("")) for t in titles])
            rows.append(F.struct(F.lit(label).alias("section"), found.alias(name)))
        return df.select(key, F.explode(F.array(*rows)).alias("s")).select(key, "s.*")

    absent = F.lit("（未提取到）")
    return pick(old, "old_text").join(pick(new, "new_text"), [key, "section"], "full_outer").select(
        key, "section", F.coalesce("old_text", absent).alias("old_text"), F.coalesce("new_text", absent).alias("new_text"))


def published_duplicates(reports: DataFrame, published: DataFrame, threshold: float = 0.85) -> DataFrame:
    """Reports that were published before: same title, or first 200 characters with a ratio at the threshold.
    Result: (report_id, published_id)."""
    a = reports.select(F.col("report_id").alias("x_id"), F.trim("title").alias("title"), F.substring("content", 1, 200).alias("head"))
    b = published.select(F.col("report_id").alias("y_id"), F.trim("title").alias("title"), F.substring("content", 1, 200).alias("head"))
    # one published id per title and per text, so that copies do not multiply
    by_title = b.where("title <> '' or head <> ''").groupBy("title").agg(F.min("y_id").alias("y_id"))
    by_head = b.groupBy(F.col("head").alias("y")).agg(F.min("y_id").alias("y_id"))
    same = a.join(by_title, "title").select("x_id", "y_id")
    heads = a.select("head").unionByName(b.select("head")).distinct().select(F.lit("").alias("_run"), F.col("head").alias("_title"), F.col("head").alias("_tid"))
    edges = similar_within(heads, threshold).select("x", "y").unionByName(
        heads.select(F.col("_tid").alias("x"), F.col("_tid").alias("y")))
    # the new report's text is the first argument of the ratio
    by_text = edges.join(by_head, "y").groupBy("x").agg(F.min("y_id").alias("y_id"))
    near = a.select("x_id", F.col("head").alias("x")).join(by_text, "x").select("x_id", "y_id")
    both = same.unionByName(near)
    return both.groupBy("x_id").agg(F.min("y_id").alias("published_id")).withColumnRenamed("x_id", "report_id")


def missing_periods(months: DataFrame, period_meta: DataFrame) -> DataFrame:
    """Months without a current metadata row (schema version 2 or later, with cases)."""
    valid = period_meta.where("schema_version >= 2 and size(top_cases) > 0").select("month").distinct()
    return months.join(valid, "month", "left_anti")
