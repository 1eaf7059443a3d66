"""Landed RSS and Atom feeds to items."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from briefwright.functions import text as T
from briefwright.functions.urls import normalise_url
from briefwright.operators.ranking import first_per
from briefwright.schema import to_items

ENTRY_XML = """title STRING, link STRING, author STRING, description STRING, summary STRING, content STRING, `content:encoded` STRING,
    pubDate STRING, published STRING, updated STRING, category ARRAY<STRING>, `itunes:duration` STRING,
    enclosure STRUCT<_url: STRING, _length: STRING>, language STRING"""
ENTRY_COLUMNS = ["title", "link", "author", "summary", "content", "published", "updated", "tags", "duration", "audio_url", "audio_bytes", "language"]


def _entry_columns() -> list[Column]:
    some = lambda *names: F.coalesce(*[F.nullif(F.col(n), F.lit("")) for n in names], F.lit(""))
    return [
        T.text_or_empty(F.col("title")).alias("title"), T.text_or_empty(F.col("link")).alias("link"), F.nullif("author", F.lit("")).alias("author"),
        some("summary", "description").alias("summary"), some("`content:encoded`", "content").alias("content"),
        F.coalesce("pubDate", "published").alias("published"), F.col("updated"),
        F.filter(F.coalesce("category", F.expr("cast(array() as array<string>)")), lambda t: t.isNotNull() & (t != "")).alias("tags"),
        T.text_or_empty(F.col("`itunes:duration`")).alias("duration"), T.text_or_empty(F.col("enclosure._url")).alias("audio_url"),
        F.coalesce(F.col("enclosure._length").try_cast("bigint"), F.lit(0)).alias("audio_bytes"), F.col("language")]


def read_entries(spark: SparkSession, path: str, row_tag: str = "item") -> DataFrame:
    """Feed files to entry rows; ``place`` is the order inside a file."""
    raw = spark.read.format("xml").option("rowTag", row_tag).schema(ENTRY_XML).load(path)
    return raw.select(*_entry_columns(), F.col("_metadata.file_name").alias("feed"), F.monotonically_increasing_id().alias("place"),
                      F.col("_metadata.file_modification_time").alias("ingest_ts"))


def parse_feeds(landed: DataFrame) -> DataFrame:
    """Landed feeds (feed, ord, payload, ingest_ts) to entry rows with the feed title."""
    ddl = f"channel STRUCT<title: STRING, item: ARRAY<STRUCT<{_as_struct(ENTRY_XML)}>>>"
    rows = landed.withColumn("x", F.from_xml("payload", ddl))
    flat = rows.select("feed", "ord", "ingest_ts", T.text_or_empty(F.col("x.channel.title")).alias("feed_title"),
                       F.posexplode("x.channel.item").alias("place", "e"))
    wide = flat.select("feed", "ord", "ingest_ts", "feed_title", "place", "e.*")
    return wide.select("feed", "ord", "ingest_ts", "feed_title", "place", *_entry_columns())


def _as_struct(ddl: str) -> str:
    out, depth = [], 0
    for piece in ddl.replace("\n", " ").split(","):
        text = piece.strip()
        out.append(text if depth else text.replace(" ", ": ", 1))
        depth += piece.count("<") - piece.count(">")
    return ", ".join(out)


def _date() -> Column:
    return T.published_at([F.col("published"), F.col("updated")], F.col("ingest_ts"))


def rss_entries(entries: DataFrame, source: str, language: str = "zh") -> DataFrame:
    """Generic entries: summary, else content."""
    return to_items(_rss(entries, source, language))


def _rss(entries: DataFrame, source: str, language: str) -> DataFrame:
    return entries.withColumns({
        "source": F.lit(source), "source_type": F.lit("rss"), "url": F.col("link"),
        "title": F.when(F.col("title") != "", F.col("title")).otherwise("Untitled"), "author": T.text_or_empty(F.col("author")),
        "content": F.when(F.col("summary") != "", F.col("summary")).otherwise(F.col("content")), "published_at": _date(),
        "collected_at": F.col("ingest_ts"), "score": F.lit(0.0), "tags": F.expr("cast(array() as array<string>)"),
        "language": F.coalesce("language", F.lit(language))})


def podcast_entries(entries: DataFrame, source: str) -> DataFrame:
    """Podcast entries: show in the title, duration and enclosure kept."""
    show = F.col("feed_title")
    title = F.when(F.col("title") != "", F.col("title")).otherwise("Untitled")
    extra = F.to_json(F.struct(show.alias("podcast"), "duration", "audio_url", F.col("audio_bytes").alias("file_size_bytes")))
    return to_items(entries.withColumns({
        "source": F.lit(source), "source_type": F.lit("rss"), "url": F.col("link"), "extra": extra,
        "title": F.concat(F.lit("["), show, F.lit("] "), title), "author": show, "content": F.substring("summary", 1, 500), "published_at": _date(),
        "collected_at": F.col("ingest_ts"), "score": F.lit(0.0), "tags": F.array(F.lit("podcast")), "language": F.lit("en")}))


def multi_feed_merge(entries: DataFrame, source: str, since: Column, language: str = "zh") -> DataFrame:
    """Mirrors of one feed: fresh rows, first mirror wins per link; rows without link all stay."""
    rows = _rss(entries, source, language).where(F.col("published_at") >= since)
    linked = first_per(rows.where("url <> ''"), ["url"], [F.col("ord"), F.col("place")])
    return to_items(linked.unionByName(rows.where("url = ''")))


def _blog(entries: DataFrame, source: str, content: Column, default_tags: Sequence[str], author: Column, language: str) -> DataFrame:
    tags = F.when(F.size("tags") > 0, F.col("tags")).otherwise(F.array(*[F.lit(t) for t in default_tags]))
    return entries.withColumn("title", F.trim("title")).where("title <> ''").withColumns({
        "source": F.lit(source), "source_type": F.lit("rss"), "url": F.col("link"), "author": author, "content": F.substring(content, 1, 500),
        "published_at": _date(), "collected_at": F.col("ingest_ts"), "score": F.lit(0.0), "tags": tags, "language": F.lit(language)})


def first_by_link(rows: DataFrame) -> DataFrame:
    """First row per link without trailing slash, in feed order."""
    return first_per(rows.withColumn("_u", normalise_url(F.col("url"))), ["_u"], [F.col("ord"), F.col("place")]).drop("_u")


def cn_blog_entries(entries: DataFrame, source: str = "cn_tech_blog") -> DataFrame:
    """Full content before summary, default tags, one row per link."""
    content = F.when(F.col("content") != "", F.col("content")).otherwise(F.col("summary"))
    rows = _blog(entries, source, content, ["blog", "ai"], F.coalesce("author", "feed_title"), "zh")
    return to_items(first_by_link(rows.withColumn("extra", F.to_json(F.struct(F.col("feed_title").alias("feed"))))))


# Default author per vendor blog.
VENDOR_AUTHORS = {"openai": "OpenAI", "google_blog": "Google"}


def vendor_blog_entries(entries: DataFrame, source: str, authors: Mapping[str, str] = VENDOR_AUTHORS) -> DataFrame:
    rows = _blog(entries, source, F.col("summary"), ["blog"], F.coalesce("author", F.lit(authors[source])), "en")
    return to_items(first_by_link(rows))


def book_entries(entries: DataFrame, source: str = "weread") -> DataFrame:
    """Book feeds; tags come from the title and the feed title."""
    title, feed = F.lower("title"), F.lower("feed_title")
    if source == "weread":
        tags = F.array_compact(F.array(F.lit("book"), F.when(title.contains("kindle") | feed.contains("kindle"), "kindle"),
                                       F.when(F.col("feed_title").contains("微信读书") | feed.contains("weread"), "weread")))
    else:
        tags = F.array(F.lit("book"), F.lit("kindle"))
    rows = _blog(entries, source, F.col("summary"), ["book"], T.text_or_empty(F.col("author")), "zh" if source == "weread" else "en")
    rows = rows.withColumns({"tags": tags, "extra": F.to_json(F.struct("feed_title"))})
    linked = first_per(rows.where("url <> ''"), ["url"], [F.col("ord"), F.col("place")])
    return to_items(linked.unionByName(rows.where("url = ''")))


SITEMAP = "url ARRAY<STRUCT<loc: STRING, lastmod: STRING>>"


def sitemap_entries(landed: DataFrame, sections: Sequence[str] = ("engineering", "research"), source: str = "anthropic", author: str = "Anthropic") -> DataFrame:
    """Sitemap links of the given sections; title from the slug, first row per slug. ``land_id`` orders the files."""
    rows = landed.withColumn("x", F.from_xml("payload", SITEMAP)).select("land_id", "ingest_ts", F.posexplode("x.url").alias("place", "u"))
    loc = F.trim(T.text_or_empty(F.col("u.loc")))
    section = F.lit(None).cast("string")
    for name in reversed(sections):
        section = F.when(loc.contains(f"/{name}/"), name).otherwise(section)
    slug = F.element_at(F.split(F.rtrim(loc, F.lit("/")), "/"), -1)
    staged = rows.withColumns({"url": loc, "section": section, "slug": slug}).where("section is not null and slug <> '' and slug <> section")
    first = first_per(staged, ["slug"], [F.col("land_id"), F.col("place")])
    return to_items(first.withColumns({
        "source": F.lit(source), "source_type": F.lit("http_scrape"), "title": F.initcap(F.replace("slug", F.lit("-"), F.lit(" "))), "author": F.lit(author),
        "published_at": T.published_at([F.col("u.lastmod")], F.col("ingest_ts")), "collected_at": F.col("ingest_ts"), "score": F.lit(0.0),
        "tags": F.array("section", F.lit("blog"))}))
