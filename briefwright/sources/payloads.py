"""Landed API payloads (one JSON text per row, with ingest time) to items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from briefwright.functions import text as T
from briefwright.functions.urls import video_id
from briefwright.operators.aggregates import review_ratings
from briefwright.operators.ranking import first_per
from briefwright.schema import to_items

INGEST = F.col


def _parsed(landed: DataFrame, ddl: str) -> DataFrame:
    return landed.withColumn("p", F.from_json("payload", ddl))


def _extra(**fields: Column) -> Column:
    return F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]))


def _n(value: Column) -> Column:
    return F.coalesce(value.cast("bigint"), F.lit(0).cast("bigint"))


def _when_published(*raw: Column) -> Column:
    return T.published_at(raw, F.col("ingest_ts"))


def _tweet_items(rows: DataFrame, tid: Column, text: Column, name: Column, likes: Column, reposts: Column, replies: Column, created: Column) -> DataFrame:
    out = rows.withColumns({
        "source": F.lit("x_twitter"), "source_type": F.lit("api"), "title": F.substring(text, 1, 200),
        "url": F.concat(F.lit("https://x.com/"), name, F.lit("/status/"), tid), "author": name, "content": text,
        "published_at": _when_published(created), "collected_at": F.col("ingest_ts"), "score": (likes + reposts * 2).cast("double"),
        "extra": _extra(likes=likes, retweets=reposts, replies=replies, list=F.col("list_name"), tweet_id=tid)})
    return to_items(out.where((T.text_or_empty(tid) != "") & (T.text_or_empty(text) != "")))


TWEETS = """tweets ARRAY<STRUCT<id: STRING, text: STRING, author: STRUCT<userName: STRING, screen_name: STRING, name: STRING>,
    createdAt: STRING, likeCount: BIGINT, retweetCount: BIGINT, replyCount: BIGINT>>, has_next_page BOOLEAN, next_cursor STRING"""


def x_list_tweets(landed: DataFrame) -> DataFrame:
    rows = _parsed(landed, TWEETS).select("list_name", "ingest_ts", F.explode("p.tweets").alias("t"))
    name = F.coalesce(F.nullif(F.col("t.author.userName"), F.lit("")), F.nullif(F.col("t.author.screen_name"), F.lit("")), F.lit("unknown"))
    c = lambda k: F.col(f"t.{k}")
    return _tweet_items(rows, c("id"), c("text"), name, _n(c("likeCount")), _n(c("retweetCount")), _n(c("replyCount")), c("createdAt"))


ALT_TWEETS = """tweets ARRAY<STRUCT<id: STRING, text: STRING, user: STRUCT<screen_name: STRING>, created_at: STRING,
    favorite_count: BIGINT, retweet_count: BIGINT, reply_count: BIGINT>>"""


def x_alt_shape(landed: DataFrame) -> DataFrame:
    rows = _parsed(landed, ALT_TWEETS).select("list_name", "ingest_ts", F.explode("p.tweets").alias("t"))
    c = lambda k: F.col(f"t.{k}")
    return _tweet_items(rows, c("id"), c("text"), F.coalesce(c("user.screen_name"), F.lit("unknown")), _n(c("favorite_count")),
                        _n(c("retweet_count")), _n(c("reply_count")), c("created_at"))


REPOS = """items ARRAY<STRUCT<full_name: STRING, description: STRING, html_url: STRING, owner: STRUCT<login: STRING>, pushed_at: STRING,
    stargazers_count: BIGINT, forks_count: BIGINT, topics: ARRAY<STRING>, language: STRING>>"""


def github_repos(landed: DataFrame) -> DataFrame:
    """Repository search rows; rows without push time are dropped."""
    rows = _parsed(landed, REPOS).select("ingest_ts", F.explode("p.items").alias("r")).where("r.pushed_at is not null")
    c = lambda k: F.col(f"r.{k}")
    about = T.text_or_empty(c("description"))
    return to_items(rows.withColumns({
        "source": F.lit("github"), "source_type": F.lit("api"), "title": F.concat(c("full_name"), F.lit(": "), about), "url": c("html_url"),
        "author": c("owner.login"), "content": about, "published_at": _when_published(c("pushed_at")), "collected_at": F.col("ingest_ts"),
        "score": _n(c("stargazers_count")).cast("double"), "tags": c("topics"), "language": F.coalesce(F.nullif(c("language"), F.lit("")), F.lit("en")),
        "extra": _extra(stars=_n(c("stargazers_count")), forks=_n(c("forks_count")), language=c("language"))}))


def github_releases(releases: DataFrame, repos: DataFrame) -> DataFrame:
    """Release rows (full_name, tag_name, html_url, author_login, body, published_at) with the stars of their repository."""
    stars = repos.groupBy("full_name").agg(F.max("stargazers_count").alias("stars"))
    rows = releases.where("published_at is not null").join(stars, "full_name")
    return to_items(rows.withColumns({
        "source": F.lit("github"), "source_type": F.lit("api"),
        "title": F.concat(F.lit("[Release] "), "full_name", F.lit(" "), "tag_name"), "url": F.col("html_url"),
        "author": T.text_or_empty(F.col("author_login")), "content": F.substring(T.text_or_empty(F.col("body")), 1, 1000),
        "published_at": _when_published(F.col("published_at")), "collected_at": F.col("ingest_ts"), "score": _n(F.col("stars")).cast("double"),
        "tags": F.array(F.lit("release")), "extra": _extra(tag=F.col("tag_name"))}))


REDDIT = """data STRUCT<children: ARRAY<STRUCT<kind: STRING, data: STRUCT<title: STRING, permalink: STRING, author: STRING, selftext: STRING,
    url: STRING, score: BIGINT, created_utc: DOUBLE, num_comments: BIGINT, upvote_ratio: DOUBLE>>>, after: STRING>"""


def reddit_posts(landed: DataFrame) -> DataFrame:
    rows = _parsed(landed, REDDIT).select("subreddit", "ingest_ts", F.explode("p.data.children").alias("k")).select("subreddit", "ingest_ts", "k.data.*")
    body, link = F.substring(T.text_or_empty(F.col("selftext")), 1, 1000), T.text_or_empty(F.col("url"))
    return to_items(rows.where("title is not null and title <> ''").withColumns({
        "content": F.when(body != "", body).when(link != "", F.concat(F.lit("Link: "), link)).otherwise(""),
        "url": F.concat(F.lit("https://reddit.com"), T.text_or_empty(F.col("permalink"))), "source": F.lit("reddit"), "source_type": F.lit("api"),
        "published_at": F.timestamp_seconds(F.coalesce("created_utc", F.lit(0.0))), "collected_at": F.col("ingest_ts"),
        "tags": F.array("subreddit"), "extra": _extra(subreddit=F.col("subreddit"), num_comments=_n(F.col("num_comments")),
                                                       upvote_ratio=F.coalesce("upvote_ratio", F.lit(0.0))),
        "score": _n(F.col("score")).cast("double")}))


PLAYLIST = """items ARRAY<STRUCT<snippet: STRUCT<title: STRING, channelTitle: STRING, description: STRING, publishedAt: STRING,
    resourceId: STRUCT<videoId: STRING>>, contentDetails: STRUCT<videoPublishedAt: STRING>>>"""


def youtube_playlist_items(landed: DataFrame) -> DataFrame:
    """Playlist rows; private, deleted and id-less videos are skipped."""
    rows = _parsed(landed, PLAYLIST).select("channel_id", "ingest_ts", F.explode("p.items").alias("v"))
    c = lambda k: F.col(f"v.snippet.{k}")
    vid = c("resourceId.videoId")
    title = F.coalesce(c("title"), F.lit("Untitled"))
    return to_items(rows.where((T.text_or_empty(vid) != "") & ~title.isin("Private video", "Deleted video")).withColumns({
        "source": F.lit("youtube"), "source_type": F.lit("api"), "title": title, "url": F.concat(F.lit("https://www.youtube.com/watch?v="), vid),
        "author": T.text_or_empty(c("channelTitle")), "content": F.substring(T.text_or_empty(c("description")), 1, 500),
        "published_at": _when_published(F.coalesce(F.col("v.contentDetails.videoPublishedAt"), c("publishedAt"))),
        "collected_at": F.col("ingest_ts"), "tags": F.array(F.lit("video")), "extra": _extra(channel_id=F.col("channel_id"), video_id=vid)}))


ZHIHU_HOT = """data ARRAY<STRUCT<target: STRUCT<title: STRING, title_area: STRUCT<text: STRING>, url: STRING, link: STRUCT<url: STRING>,
    excerpt: STRING>, detail_text: STRING>>"""


def zhihu_hot(landed: DataFrame) -> DataFrame:
    """Hot list rows, first one per link in ingest order (``land_id``, place)."""
    rows = _parsed(landed, ZHIHU_HOT).select("land_id", "ingest_ts", F.posexplode("p.data").alias("place", "e"))
    c = lambda k: F.col(f"e.target.{k}")
    some = lambda *v: F.coalesce(*[F.nullif(x, F.lit("")) for x in v], F.lit(""))
    url = F.replace(some(c("url"), c("link.url")), F.lit("https://api.zhihu.com/questions/"), F.lit("https://www.zhihu.com/question/"))
    staged = rows.withColumns({
        "title": some(c("title"), c("title_area.text")), "url": url, "score": T.heat_score(F.col("e.detail_text")),
        "content": T.text_or_empty(c("excerpt")), "source": F.lit("zhihu"), "source_type": F.lit("api"), "language": F.lit("zh"),
        "published_at": F.col("ingest_ts"), "collected_at": F.col("ingest_ts"),
        "extra": _extra(feed_type=F.lit("hot"), detail_text=T.text_or_empty(F.col("e.detail_text")))})
    return to_items(first_per(staged.where("title <> '' and url <> ''"), ["url"], [F.col("land_id"), F.col("place")]))


ZHIHU_FEED = """data ARRAY<STRUCT<type: STRING, target: STRUCT<type: STRING, id: BIGINT, title: STRING, question: STRUCT<id: BIGINT, title: STRING>,
    author: STRUCT<name: STRING>, voteup_count: BIGINT, favorite_count: BIGINT, excerpt: STRING, excerpt_new: STRING, created_time: BIGINT>>>,
    paging STRUCT<is_end: BOOLEAN, next: STRING>"""


def zhihu_feed(landed: DataFrame) -> DataFrame:
    """Recommended and followed rows; adverts and empty targets are skipped, first row per link."""
    rows = _parsed(landed, ZHIHU_FEED).select("land_id", "ingest_ts", F.posexplode("p.data").alias("place", "e"))
    rows = rows.where("coalesce(e.type, '') <> 'feed_advert' and coalesce(e.target.type, '') <> ''")
    c = lambda k: F.col(f"e.target.{k}")
    article = c("type") == "article"
    tid, qid = F.coalesce(c("id").cast("string"), F.lit("")), F.coalesce(c("question.id").cast("string"), F.lit(""))
    title = F.when(article, c("title")).otherwise(F.coalesce(F.nullif(c("question.title"), F.lit("")), c("title")))
    url = F.when(article, F.concat(F.lit("https://zhuanlan.zhihu.com/p/"), tid)).otherwise(
        F.concat(F.lit("https://www.zhihu.com/question/"), qid, F.lit("/answer/"), tid))
    staged = rows.withColumns({
        "title": T.text_or_empty(title), "url": url, "author": T.text_or_empty(c("author.name")), "score": _n(c("voteup_count")).cast("double"),
        "content": F.coalesce(F.nullif(c("excerpt_new"), F.lit("")), c("excerpt"), F.lit("")), "source": F.lit("zhihu"),
        "source_type": F.lit("api"), "language": F.lit("zh"), "collected_at": F.col("ingest_ts"),
        "published_at": F.coalesce(F.timestamp_seconds(F.nullif(c("created_time"), F.lit(0))), "ingest_ts"),
        "extra": _extra(feed_type=F.coalesce("e.type", F.lit("unknown")), voteup_count=_n(c("voteup_count")).cast("double"),
                        favorite_count=_n(c("favorite_count")).cast("double"))})
    return to_items(first_per(staged.where("title <> ''"), ["url"], [F.col("land_id"), F.col("place")]))


PH_NODE = """id STRING, name STRING, tagline STRING, description STRING, url STRING, votesCount BIGINT, createdAt STRING,
    topics STRUCT<edges: ARRAY<STRUCT<node: STRUCT<name: STRING>>>>, user STRUCT<name: STRING>, thumbnail STRUCT<url: STRING>"""


def producthunt_posts(landed: DataFrame) -> DataFrame:
    rows = _parsed(landed, PH_NODE).select("ingest_ts", "p.*")
    topics = F.filter(F.transform("topics.edges", lambda e: e["node"]["name"]), lambda n: n.isNotNull() & (n != ""))
    return to_items(rows.where("coalesce(name, '') <> ''").withColumns({
        "title": F.col("name"), "author": T.text_or_empty(F.col("user.name")),
        "content": F.coalesce(F.nullif("description", F.lit("")), "tagline", F.lit("")), "published_at": _when_published(F.col("createdAt")),
        "collected_at": F.col("ingest_ts"), "score": _n(F.col("votesCount")).cast("double"), "tags": topics, "source": F.lit("producthunt"),
        "source_type": F.lit("api"), "extra": _extra(tagline=T.text_or_empty(F.col("tagline")), thumbnail=T.text_or_empty(F.col("thumbnail.url")),
                                                     ph_id=T.text_or_empty(F.col("id")))}))


HF_PAPER = """publishedAt STRING, submittedOnDailyAt STRING, numLikes BIGINT, paper STRUCT<id: STRING, title: STRING, summary: STRING,
    authors: ARRAY<STRUCT<name: STRING>>, publishedAt: STRING, submittedOnDailyAt: STRING, upvotes: BIGINT>"""


def hf_papers(landed: DataFrame) -> DataFrame:
    rows = _parsed(landed, HF_PAPER).select("ingest_ts", "p.*").where("paper is not null")
    c = lambda k: F.col(f"paper.{k}")
    pid = T.text_or_empty(c("id"))
    day = F.coalesce(*[F.nullif(x, F.lit("")) for x in (c("submittedOnDailyAt"), F.col("submittedOnDailyAt"), F.col("publishedAt"), c("publishedAt"))])
    return to_items(rows.withColumns({
        "source": F.lit("huggingface"), "source_type": F.lit("http_scrape"), "title": F.coalesce(c("title"), F.lit("Untitled")),
        "url": F.concat(F.lit("https://huggingface.co/papers/"), pid),
        "author": F.array_join(F.transform(F.slice(c("authors"), 1, 5), lambda a: T.text_or_empty(a["name"])), ", "),
        "content": F.substring(T.text_or_empty(c("summary")), 1, 1000), "published_at": _when_published(day), "collected_at": F.col("ingest_ts"),
        "score": F.coalesce(F.nullif(c("upvotes"), F.lit(0)), F.col("numLikes"), F.lit(0)).cast("double"), "arxiv_id": T.arxiv_id_in(pid),
        "tags": F.array(F.lit("paper"), F.lit("ml")), "extra": _extra(paper_id=pid)}))


def openreview_notes(landed: DataFrame) -> DataFrame:
    """Notes with their replies (conf, year, payload) to items, score = mean official rating. ``land_id`` names a note."""
    note = F.try_parse_json("payload")
    v = lambda path, kind="string": F.try_variant_get("n", path, kind)
    field = lambda k: F.coalesce(v(f"$.content.{k}.value"), F.when(v(f"$.content.{k}", "map<string,variant>").isNull(), v(f"$.content.{k}")), F.lit(""))
    rows = landed.withColumn("n", note)
    rated = review_ratings(rows.select("land_id", v("$.details.replies", "array<variant>").alias("replies")), ["land_id"])
    rows = rows.join(rated, "land_id", "left")
    authors = F.coalesce(v("$.content.authors.value", "array<string>"), F.expr("cast(array() as array<string>)"))
    forum = F.coalesce(F.nullif(v("$.forum"), F.lit("")), v("$.id"), F.lit(""))
    staged = rows.withColumns({
        "_title": field("title"), "source": F.lit("ccf_bestpaper"), "source_type": F.lit("api"),
        "url": F.concat(F.lit("https://openreview.net/forum?id="), forum),
        "author": F.concat(F.array_join(F.slice(authors, 1, 5), ", "), F.when(F.size(authors) > 5, " et al.").otherwise("")),
        "content": F.substring(field("abstract"), 1, 1000),
        "published_at": F.coalesce(F.timestamp_millis(F.nullif(v("$.odate", "bigint"), F.lit(0))), "ingest_ts"),
        "collected_at": F.col("ingest_ts"), "score": F.coalesce("avg_rating", F.lit(0.0)),
        "tags": F.array(F.lower("conf"), F.lit("oral"), F.col("year").cast("string")),
        "extra": _extra(conference=F.col("conf"), year=F.col("year"), venue=field("venue"), forum_id=forum, avg_rating=F.col("avg_rating"),
                        num_reviews=F.coalesce("num_reviews", F.lit(0)), individual_ratings=F.col("ratings"))})
    staged = staged.where("_title <> ''").withColumn(
        "title", F.concat(F.lit("["), "conf", F.lit(" "), F.col("year").cast("string"), F.lit(" Oral] "), "_title"))
    return to_items(staged)


EDITIONS = "ARRAY<STRUCT<title: STRING, dblp: STRING, confs: ARRAY<STRUCT<year: INT, link: STRING, date: STRING>>>>"


def conference_editions(landed: DataFrame) -> DataFrame:
    """(name, year, conf_url, conf_date, dblp) of every edition with a year."""
    rows = _parsed(landed, EDITIONS)
    one = rows.select("name", F.element_at("p", 1).alias("c")).select("name", F.col("c.dblp").alias("dblp"), F.explode("c.confs").alias("e"))
    return one.where("coalesce(e.year, 0) <> 0").select(
        "name", F.col("e.year").alias("year"), T.text_or_empty(F.col("e.link")).alias("conf_url"),
        T.text_or_empty(F.col("e.date")).alias("conf_date"), T.text_or_empty(F.col("dblp")).alias("dblp"))


def award_items(rows: DataFrame) -> DataFrame:
    """Award rows (conf, year, paper_title, author, award, url, ingest_ts) to items."""
    return to_items(rows.withColumns({
        "source": F.lit("ccf_bestpaper"), "source_type": F.lit("http_scrape"),
        "title": F.concat(F.lit("["), "conf", F.lit(" "), F.col("year").cast("string"), F.lit(" "), "award", F.lit("] "), "paper_title"),
        "published_at": F.col("ingest_ts"), "collected_at": F.col("ingest_ts"), "score": F.lit(0.0),
        "tags": F.array(F.lower("conf"), F.lit("best_paper"), F.col("year").cast("string")),
        "extra": _extra(conference=F.col("conf"), year=F.col("year"), award_type=F.col("award"))}))


def manual_items(queue: DataFrame) -> DataFrame:
    """Open queue rows (url, title, priority, meta_title, content) to items; the title falls back to host and path."""
    loc = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    path = F.rtrim(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), F.lit("/"))
    guess = F.when(path != "", F.concat(loc, path)).when(loc != "", loc).otherwise(F.substring("url", 1, 80))
    optional = lambda c: F.col(c) if c in queue.columns else F.lit(None).cast("string")
    title = F.coalesce(F.nullif(optional("title"), F.lit("")), F.nullif(optional("meta_title"), F.lit("")), guess)
    content = T.text_or_empty(optional("content"))
    return to_items(queue.withColumn("url", F.trim("url")).where("url <> '' and not coalesce(processed, false)").withColumns({
        "title": title, "content": content, "source": F.lit("manual_urls"), "source_type": F.lit("http_scrape"), "score": F.lit(100.0),
        "tags": F.array(F.lit("manual")), "extra": _extra(enriched=content != "", priority=F.coalesce(optional("priority"), F.lit("normal")))}))
