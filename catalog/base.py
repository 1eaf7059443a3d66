"""News items derived from the driver tables, in Spark and as a SQL view text.

The tables hold invented prose, so names, links and phrases that the rules look for are derived from the ids of
the rows. Everything scales with the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    # what build_session sets, for sessions made elsewhere
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.legacy.timeParserPolicy", "CORRECTED")
    return spark.read.parquet(f"{sf}/{name}.parquet")


NAMES = ["github", "reddit", "hackernews", "openai", "anthropic", "google_blog", "huggingface", "coolpaper", "openreview", "finance",
         "youtube", "apple_podcast", "weread", "x_twitter", "zhihu", "producthunt", "cn_tech_blog", "blog_feeds", "arxiv", "manual_urls"]
PATHS = ["github.com/org", "www.reddit.com/r/sub", "example.org/show/", "openai.com/index/", "www.anthropic.com/news/", "blog.google/tech/",
         "huggingface.co/lab/model", "papers.cool/arxiv/", "openreview.net/forum/", "www.cnbc.com/story/", "www.youtube.com/watch/",
         "podcasts.apple.com/show/", "weread.qq.com/book/", "x.com/user", "www.zhihu.com/question/", "www.producthunt.com/posts/",
         "tech.example.cn/blog/", "s.baoyu.io/p/", "arxiv.org/abs/", "example.com:8080/manual/"]
PHRASES = ["", "GPT-5 launch with api pricing", "Claude Opus 4.8 release available today", "DeepSeek V4 open source weights and dataset",
           "NVIDIA Blackwell data center 3 GW capacity", "AWS Bedrock enterprise Codex agents cloud availability", "sponsored deal with promo code",
           "survey of diffusion language models", "replication failed to reproduce the benchmark limitation",
           "deployed in production serving stack at scale", "breaking changes migration guide v2.0.0", "tutorial course for beginner",
           "CTO interview on scaling inference cost and roadmap", "vllm throughput latency benchmark on rtx 4090", "raises $2 billion funding valuation",
           "stock market earnings and etf portfolio", "Google I/O 2026 gemini api", "Codex plugins now available for agents and developer workflow",
           "Anthropic draft S-1 sec filing ipo", "v1.2.3 patch", "v0.9.0-rc1 preview", "continual learning and self-improvement for language model agents",
           "Show HN: my hot take thread", "GPU chips forecast and capex guidance"]
TAGS = ["AI", "infra", "book", "finance", "podcast", "misc", "coding"]
FEEDS = ["hot", "recommend", "follow"]


def _list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _array(values: list[str]) -> str:
    return "array" + _list(values).replace("[", "(").replace("]", ")")


EVENT_TYPES = ["click", "view", "purchase", "signup"]


def items(spark: SparkSession, sf: str) -> DataFrame:
    """One item per document; time, kind and score follow from its id."""
    # the tables come as one file each, which one task would read and then also run all text rules on
    d = table(spark, sf, "documents").repartition(spark.sparkContext.defaultParallelism, "doc_id")
    d = d.select("doc_id", "text", "lang", F.substr("source", F.lit(4)).cast("int").alias("idx"))
    rows = d.withColumns({
        "ts": F.expr("timestampadd(SECOND, cast(doc_id * 104729 % 2592000 as int), timestamp'2024-01-01 00:00:00')"),
        "event_type": F.expr(f"{_array(EVENT_TYPES)}[cast(doc_id * 31 % 7 % {len(EVENT_TYPES)} as int)]"),
        "value": F.expr("cast(doc_id * 7919 % 1000003 as double) / 5000.0D")})
    pick = lambda values, key: F.expr(f"{_array(values)}[{key}]")
    rows = rows.withColumns({
        "source": pick(NAMES, "idx"), "phrase": pick(PHRASES, f"cast(doc_id % {len(PHRASES)} as int)"),
        "first_line": F.substring_index("text", "\n", 1)})
    tail = F.expr("""case when idx = 0 and doc_id % 40 = 0 then concat('/releases/tag/v', doc_id % 3, '.', doc_id % 7, '.', doc_id % 5)
                          when idx = 0 then '' when idx = 1 then concat('/comments/', doc_id)
                          when idx = 13 then concat('/status/', doc_id) else '' end""")
    number = F.expr("""case when idx = 0 then concat(doc_id % 7, '/repo', doc_id % 13) when idx in (7, 18) then concat('2401.', lpad(doc_id % 300, 5, '0'), 'v1')
                            when idx in (1, 13) then cast(doc_id % 6 as string) else cast(doc_id % 700 as string) end""")
    return rows.select(
        F.col("doc_id").alias("item_id"), F.col("doc_id").alias("pos"), "source",
        F.expr("case when idx % 3 = 0 then 'rss' when idx % 3 = 1 then 'api' else 'http_scrape' end").alias("source_type"),
        F.when(F.col("phrase") == "", F.col("first_line")).otherwise(F.concat("first_line", F.lit(" "), "phrase")).alias("title"),
        F.when(F.col("doc_id") % 17 == 0, "").otherwise(F.concat(F.lit("https://"), pick(PATHS, "idx"), number, tail)).alias("url"),
        F.expr("case when doc_id % 4 = 0 then '' else concat('author', doc_id % 9) end").alias("author"), F.col("text").alias("content"),
        F.col("ts").alias("published_at"), F.col("ts").alias("collected_at"), F.col("value").alias("score"),
        F.array("event_type", pick(TAGS, f"cast(doc_id % {len(TAGS)} as int)")).alias("tags"), F.col("lang").alias("language"),
        F.expr("case when idx in (7, 8, 18) and doc_id % 40 < 20 then concat('2401.', lpad(doc_id % 300, 5, '0')) end").alias("arxiv_id"),
        F.expr(f"""concat('{{"likes":', doc_id % 50, ',"stars":', (doc_id % 60) * 1000, ',"upvote_ratio":0.', 10 + doc_id % 90, ',"duration":"', doc_id % 3, ':',
            10 + doc_id % 50, ':00","voteup_count":', doc_id % 100, ',"favorite_count":', doc_id % 30, ',"feed_type":"', {_array(FEEDS)}[cast(doc_id % 3 as int)],
            '","note":"memo', doc_id % 8, '","youtube_stats":{{"viewCount":', doc_id % 1000, ',"likeCount":', doc_id % 77, ',"commentCount":', doc_id % 13, '}}}}')""").alias("extra"),
        F.date_format("ts", "yyyy-MM-dd").alias("dt"))


ITEMS = f"""items AS (
  SELECT doc_id AS item_id, doc_id AS pos, source,
    CASE WHEN idx % 3 = 0 THEN 'rss' WHEN idx % 3 = 1 THEN 'api' ELSE 'http_scrape' END AS source_type,
    CASE WHEN phrase = '' THEN first_line ELSE first_line || ' ' || phrase END AS title,
    CASE WHEN doc_id % 17 = 0 THEN '' ELSE 'https://' || {_list(PATHS)}[idx + 1] ||
      CASE WHEN idx = 0 THEN (doc_id % 7) || '/repo' || (doc_id % 13) WHEN idx IN (7, 18) THEN '2401.' || lpad(CAST(doc_id % 300 AS VARCHAR), 5, '0') || 'v1'
           WHEN idx IN (1, 13) THEN CAST(doc_id % 6 AS VARCHAR) ELSE CAST(doc_id % 700 AS VARCHAR) END ||
      CASE WHEN idx = 0 AND doc_id % 40 = 0 THEN '/releases/tag/v' || (doc_id % 3) || '.' || (doc_id % 7) || '.' || (doc_id % 5)
           WHEN idx = 0 THEN '' WHEN idx = 1 THEN '/comments/' || doc_id WHEN idx = 13 THEN '/status/' || doc_id ELSE '' END END AS url,
    CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'author' || (doc_id % 9) END AS author, text AS content, ts AS published_at, ts AS collected_at, value AS score,
    [event_type, {_list(TAGS)}[doc_id % {len(TAGS)} + 1]] AS tags, lang AS language,
    CASE WHEN idx IN (7, 8, 18) AND doc_id % 40 < 20 THEN '2401.' || lpad(CAST(doc_id % 300 AS VARCHAR), 5, '0') END AS arxiv_id,
    doc_id % 50 AS x_likes, (doc_id % 60) * 1000 AS x_stars, CAST('0.' || (10 + doc_id % 90) AS DOUBLE) AS x_ratio,
    (doc_id % 3) || ':' || (10 + doc_id % 50) || ':00' AS x_duration, (doc_id % 3) * 3600 + (10 + doc_id % 50) * 60 AS x_seconds,
    doc_id % 100 AS x_voteups, doc_id % 30 AS x_favorites, {_list(FEEDS)}[doc_id % 3 + 1] AS x_feed, 'memo' || (doc_id % 8) AS x_note,
    doc_id % 1000 AS x_views, doc_id % 77 AS x_vlikes, doc_id % 13 AS x_comments, strftime(ts, '%Y-%m-%d') AS dt, idx
  FROM (SELECT d.doc_id, d.text, d.lang, CAST(substr(d.source, 4) AS INT) AS idx,
          TIMESTAMP '2024-01-01 00:00:00' + to_seconds(d.doc_id * 104729 % 2592000) AS ts, {_list(EVENT_TYPES)}[d.doc_id * 31 % 7 % {len(EVENT_TYPES)} + 1] AS event_type,
          CAST(d.doc_id * 7919 % 1000003 AS DOUBLE) / 5000.0::DOUBLE AS value,
          {_list(NAMES)}[CAST(substr(d.source, 4) AS INT) + 1] AS source, {_list(PHRASES)}[d.doc_id % {len(PHRASES)} + 1] AS phrase,
          split_part(d.text, chr(10), 1) AS first_line
        FROM documents d))"""


def with_items(body: str, *ctes: str) -> str:
    return "WITH " + ", ".join([ITEMS, *ctes]) + " " + body


# --- fragments of the SQL side ---------------------------------------------------------------------------


def s(values) -> str:
    """A SQL list of strings."""
    return _list([str(v) for v in values])


def any_of(text: str, terms) -> str:
    return f"(len(list_filter({s(terms)}, lambda q: contains({text}, q))) > 0)"


def hits(text: str, terms) -> str:
    return f"len(list_filter({s(dict.fromkeys(terms))}, lambda q: contains({text}, q)))"


def common(a: str, terms) -> str:
    return f"len(list_intersect({a}, {s(dict.fromkeys(terms))}))"


def host(url: str) -> str:
    return f"regexp_replace(lower(regexp_extract({url}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)), '^www[.]', '')"


def parts(url: str) -> str:
    path = f"regexp_replace(regexp_extract({url}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1), ';[^/]*$', '')"
    return f"list_filter(string_split({path}, '/'), lambda q: q <> '')"


TEXT = "lower(concat_ws(' ', title, content, array_to_string(tags, ' '), author, source))"
SEARCH = "lower(array_to_string(list_filter([title, content, author, source] || tags || [x_duration, x_feed, x_note], lambda q: q <> ''), ' '))"


def words(text: str, stop) -> str:
    found = f"regexp_extract_all(lower({text}), '([a-zA-Z][a-zA-Z0-9_+.-]{{2,}}|[一-鿿]{{2,}})', 1)"
    kept = f"list_filter({found}, lambda w: NOT list_contains({s(stop)}, w))"
    return f"list_distinct(list_filter(list_transform({kept}, lambda w: trim(w, '._-')), lambda w: length(w) >= 3))"
