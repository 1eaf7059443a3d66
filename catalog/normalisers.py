"""Normaliser queries: payloads are written by Spark from the tables, landed, and read back."""

from pyspark.sql import functions as F

from briefwright.functions import text as T
from briefwright.sources import feeds, pages, payloads, plugin
from catalog.base import query, table

c = F.col


def now():
    """Ingest time of the landed rows; a function, as columns need a session and modules load without one."""
    return F.lit("2026-01-05 00:00:00").cast("timestamp")


def docs(spark, sf):
    return table(spark, sf, "documents").withColumn("k", c("doc_id").cast("string"))


def landed(df, body, *extra):
    return df.select(F.to_json(body).alias("payload"), now().alias("ingest_ts"), F.col("doc_id").alias("land_id"), *extra)


def day(fmt="yyyy-MM-dd'T'HH:mm:ss'Z'"):
    return F.date_format(F.lit("2026-01-01").cast("timestamp") + F.make_dt_interval(hours=(c("doc_id") % 90).cast("int")), fmt)


DAY = "TIMESTAMP '2026-01-01' + to_hours(doc_id % 90)"


def out(df, *names):
    return df.select(*(names or ("title", "url", "author", "score", "published_at", F.md5("content").alias("content"))))


@query("nr01_x_list_tweets", f"""SELECT substr(text, 1, 200) AS title, 'https://x.com/u' || (doc_id % 9) || '/status/' || doc_id AS url, 'u' || (doc_id % 9) AS author, CAST(doc_id % 50 + 2 * (doc_id % 7) AS DOUBLE) AS score,
    {DAY} AS published_at, md5(text) AS content FROM documents WHERE doc_id % 11 <> 0""")
def tweets(spark, sf):
    name = F.concat(F.lit("u"), (c("doc_id") % 9).cast("string"))
    t = F.struct(F.when(c("doc_id") % 11 != 0, c("k")).alias("id"), "text", F.struct(F.when(c("doc_id") % 2 == 0, name).alias("userName"), name.alias("screen_name")).alias("author"),
                 day("EEE MMM dd HH:mm:ss Z yyyy").alias("createdAt"), (c("doc_id") % 50).alias("likeCount"), (c("doc_id") % 7).alias("retweetCount"))
    return out(payloads.x_list_tweets(landed(docs(spark, sf), F.struct(F.array(t).alias("tweets")), F.lit("main").alias("list_name"))))


@query("nr02_x_alt_shape", f"SELECT 'https://x.com/' || CASE WHEN doc_id % 5 = 0 THEN 'unknown' ELSE 'u' || (doc_id % 9) END || '/status/' || doc_id AS url, CAST(doc_id % 50 AS DOUBLE) AS score, {DAY} AS published_at FROM documents")
def alt_tweets(spark, sf):
    t = F.struct(c("k").alias("id"), "text", F.when(c("doc_id") % 5 != 0, F.struct(F.concat(F.lit("u"), (c("doc_id") % 9).cast("string")).alias("screen_name"))).alias("user"), day().alias("created_at"), (c("doc_id") % 50).alias("favorite_count"))
    return out(payloads.x_alt_shape(landed(docs(spark, sf), F.struct(F.array(t).alias("tweets")), F.lit("main").alias("list_name"))), "url", "score", "published_at")


@query("nr03_github_repos", f"SELECT 'o/r' || doc_id || ': ' || coalesce(source, '') AS title, 'https://github.com/o/r' || doc_id AS url, 'o' AS author, CAST(n_chars AS DOUBLE) AS score, {DAY} AS published_at, lang AS language FROM documents WHERE doc_id % 4 <> 0")
def repos(spark, sf):
    name = F.concat(F.lit("o/r"), "k")
    r = F.struct(name.alias("full_name"), c("source").alias("description"), F.concat(F.lit("https://github.com/"), name).alias("html_url"), F.struct(F.lit("o").alias("login")).alias("owner"),
                 F.when(c("doc_id") % 4 != 0, day()).alias("pushed_at"), c("n_chars").alias("stargazers_count"), F.array("lang").alias("topics"), c("lang").alias("language"))
    return out(payloads.github_repos(landed(docs(spark, sf), F.struct(F.array(r).alias("items")))), "title", "url", "author", "score", "published_at", "language")


@query("nr04_github_releases", f"SELECT '[Release] ' || source || ' v' || doc_id AS title, CAST(m AS DOUBLE) AS score, {DAY} AS published_at, md5(substr(text, 1, 1000)) AS content FROM documents JOIN (SELECT source, max(n_chars) AS m FROM documents GROUP BY source) USING (source) WHERE doc_id % 3 <> 0")
def releases(spark, sf):
    d = docs(spark, sf)
    rel = d.select(c("source").alias("full_name"), F.concat(F.lit("v"), "k").alias("tag_name"), F.lit("u").alias("html_url"), F.lit(None).cast("string").alias("author_login"), c("text").alias("body"), F.when(c("doc_id") % 3 != 0, day()).alias("published_at"), now().alias("ingest_ts"))
    return out(payloads.github_releases(rel, d.select(c("source").alias("full_name"), c("n_chars").alias("stargazers_count"))), "title", "score", "published_at", F.md5("content").alias("content"))


@query("nr05_reddit_posts", f"SELECT source AS title, 'https://reddit.com/r/x/' || doc_id AS url, CAST(doc_id % 99 AS DOUBLE) AS score, {DAY} AS published_at, md5(CASE WHEN doc_id % 2 = 0 THEN 'Link: http://l/' || doc_id ELSE substr(text, 1, 1000) END) AS content FROM documents WHERE doc_id % 10 <> 0")
def reddit(spark, sf):
    when = F.unix_seconds(F.lit("2026-01-01").cast("timestamp")) + (c("doc_id") % 90) * 3600
    p = F.struct(F.lit("t3").alias("kind"), F.struct(F.when(c("doc_id") % 10 != 0, c("source")).alias("title"), F.concat(F.lit("/r/x/"), "k").alias("permalink"), F.lit("a").alias("author"),
                 F.when(c("doc_id") % 2 == 1, c("text")).otherwise("").alias("selftext"), F.concat(F.lit("http://l/"), "k").alias("url"), (c("doc_id") % 99).alias("score"), when.alias("created_utc")).alias("data"))
    return out(payloads.reddit_posts(landed(docs(spark, sf), F.struct(F.struct(F.array(p).alias("children")).alias("data")), F.lit("x").alias("subreddit"))), "title", "url", "score", "published_at", F.md5("content").alias("content"))


@query("nr06_youtube_playlist_items", f"SELECT source AS title, 'https://www.youtube.com/watch?v=' || lpad(CAST(doc_id AS VARCHAR), 11, 'v') AS url, {DAY} AS published_at, md5(substr(text, 1, 500)) AS content FROM documents WHERE doc_id % 6 NOT IN (0, 1)")
def playlist(spark, sf):
    title = F.when(c("doc_id") % 6 == 0, "Private video").otherwise(c("source"))
    vid = F.when(c("doc_id") % 6 == 1, "").otherwise(F.lpad("k", 11, "v"))
    v = F.struct(F.struct(title.alias("title"), F.lit("ch").alias("channelTitle"), c("text").alias("description"), day().alias("publishedAt"), F.struct(vid.alias("videoId")).alias("resourceId")).alias("snippet"))
    return out(payloads.youtube_playlist_items(landed(docs(spark, sf), F.struct(F.array(v).alias("items")), F.lit("UCx").alias("channel_id"))), "title", "url", "published_at", F.md5("content").alias("content"))


@query("nr07_youtube_stats_enrich", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 0.0 ELSE (doc_id % 7 + doc_id % 5) / CAST(greatest(n_chars, 1) AS DOUBLE) * 1e6 END AS score FROM documents")
def stats(spark, sf):
    from briefwright.operators.joins import with_video_stats

    vid = F.lpad(c("doc_id").cast("string"), 11, "v")
    d = docs(spark, sf)
    s = d.where("doc_id % 3 <> 0").select(vid.alias("video_id"), c("n_chars").alias("viewCount"), (c("doc_id") % 7).alias("likeCount"), (c("doc_id") % 5).alias("commentCount"))
    return with_video_stats(d.select("doc_id", F.concat(F.lit("https://youtu.be/"), vid).alias("url"), F.lit(0.0).alias("score")), s).select("doc_id", "score")


@query("nr08_zhihu_hot", "SELECT source AS title, 'https://www.zhihu.com/question/' || (doc_id % 400) AS url, n_chars * 10000.0::DOUBLE AS score FROM documents WHERE doc_id % 9 <> 0 QUALIFY row_number() OVER (PARTITION BY doc_id % 400 ORDER BY doc_id) = 1")
def zhihu_hot(spark, sf):
    e = F.struct(F.when(c("doc_id") % 9 != 0, F.struct(F.when(c("doc_id") % 2 == 0, c("source")).alias("title"), F.struct(c("source").alias("text")).alias("title_area"),
                 F.concat(F.lit("https://api.zhihu.com/questions/"), (c("doc_id") % 400).cast("string")).alias("url"))).alias("target"), F.concat(c("n_chars").cast("string"), F.lit(" 万热度")).alias("detail_text"))
    return out(payloads.zhihu_hot(landed(docs(spark, sf), F.struct(F.array(e).alias("data")))), "title", "url", "score")


@query("nr09_zhihu_feed", "SELECT source AS title, CASE WHEN doc_id % 2 = 0 THEN 'https://zhuanlan.zhihu.com/p/' || doc_id ELSE 'https://www.zhihu.com/question/' || n_chars || '/answer/' || doc_id END AS url, CAST(doc_id % 80 AS DOUBLE) AS score FROM documents WHERE doc_id % 7 NOT IN (0, 1)")
def zhihu_feed(spark, sf):
    kind = F.when(c("doc_id") % 7 == 1, "").when(c("doc_id") % 2 == 0, "article").otherwise("answer")
    t = F.struct(kind.alias("type"), c("doc_id").alias("id"), F.when(c("doc_id") % 2 == 0, c("source")).alias("title"), F.when(c("doc_id") % 2 == 1, F.struct(c("n_chars").alias("id"), c("source").alias("title"))).alias("question"), (c("doc_id") % 80).alias("voteup_count"))
    e = F.struct(F.when(c("doc_id") % 7 == 0, "feed_advert").otherwise("feed").alias("type"), t.alias("target"))
    return out(payloads.zhihu_feed(landed(docs(spark, sf), F.struct(F.array(e).alias("data")))), "title", "url", "score")


@query("nr10_producthunt_posts", f"SELECT source AS title, CAST(n_chars AS DOUBLE) AS score, {DAY} AS published_at, CASE WHEN doc_id % 2 = 0 THEN lang ELSE 'tag' END AS content, lang AS tags FROM documents")
def producthunt(spark, sf):
    n = F.struct(c("k").alias("id"), c("source").alias("name"), F.lit("tag").alias("tagline"), F.when(c("doc_id") % 2 == 0, c("lang")).alias("description"), c("n_chars").alias("votesCount"), day().alias("createdAt"),
                 F.struct(F.array(F.struct(F.struct(c("lang").alias("name")).alias("node"))).alias("edges")).alias("topics"))
    return out(payloads.producthunt_posts(landed(docs(spark, sf), n)), "title", "score", "published_at", "content", F.array_join("tags", ",").alias("tags"))


@query("nr11_hf_papers", f"SELECT source AS title, '2401.' || lpad(CAST(doc_id % 90000 AS VARCHAR), 5, '0') AS arxiv_id, CAST(CASE WHEN doc_id % 4 = 0 THEN 5 ELSE doc_id % 4 END AS DOUBLE) AS score, {DAY} AS published_at, 'a, b' AS author FROM documents")
def hf(spark, sf):
    p = F.struct(F.concat(F.lit("2401."), F.lpad((c("doc_id") % 90000).cast("string"), 5, "0"), F.lit("v2")).alias("id"), c("source").alias("title"), c("text").alias("summary"),
                 F.array(F.struct(F.lit("a").alias("name")), F.struct(F.lit("b").alias("name"))).alias("authors"), day().alias("submittedOnDailyAt"), (c("doc_id") % 4).alias("upvotes"))
    return out(payloads.hf_papers(landed(docs(spark, sf), F.struct(F.lit("2020-01-01T00:00:00Z").alias("publishedAt"), F.lit(5).alias("numLikes"), p.alias("paper")))), "title", "arxiv_id", "score", "published_at", "author")


@query("nr13_openreview_notes", f"SELECT '[ICLR 2026 Oral] ' || source AS title, 'a1, a2, a3, a4, a5 et al.' AS author, (doc_id % 9 + 4) / 2.0 AS score, {DAY} AS published_at FROM documents WHERE doc_id % 5 <> 0")
def notes(spark, sf):
    v = lambda x: F.struct(x.alias("value"))
    when = (F.unix_seconds(F.lit("2026-01-01").cast("timestamp")) + (c("doc_id") % 90) * 3600) * 1000
    replies = F.array(F.struct(F.array(F.lit("x/Official_Review")).alias("invitations"), F.struct(v(F.concat((c("doc_id") % 9).cast("string"), F.lit(": ok"))).alias("rating")).alias("content")),
                      F.struct(F.array(F.lit("y/Official_Review")).alias("invitations"), F.struct(v(F.lit("4")).alias("rating")).alias("content")),
                      F.struct(F.array(F.lit("z/Comment")).alias("invitations"), F.struct(v(F.lit("9")).alias("rating")).alias("content")))
    note = F.struct(c("k").alias("forum"), when.alias("odate"), F.struct(v(F.when(c("doc_id") % 5 != 0, c("source")).otherwise("")).alias("title"), v(F.array(*[F.lit(f"a{i}") for i in range(1, 7)])).alias("authors"), v(c("text")).alias("abstract")).alias("content"),
                    F.struct(replies.alias("replies")).alias("details"))
    return out(payloads.openreview_notes(landed(docs(spark, sf), note, F.lit("ICLR").alias("conf"), F.lit(2026).alias("year"))), "title", "author", "score", "published_at")


@query("nr14_conference_editions", "SELECT source AS name, year, lang AS dblp FROM (SELECT source, lang, unnest([2020 + CAST(doc_id % 7 AS INT), 2030]) AS year FROM documents)")
def editions(spark, sf):
    e = F.array(F.struct((F.lit(2020) + c("doc_id") % 7).alias("year")), F.struct(F.lit(2030).alias("year")), F.struct(F.lit(None).cast("int").alias("year")))
    body = F.array(F.struct(c("lang").alias("dblp"), e.alias("confs")))
    return payloads.conference_editions(landed(docs(spark, sf), body, c("source").alias("name"))).select("name", "year", "dblp")


def page(spark, sf, html, *extra):
    return docs(spark, sf).select(c("doc_id").alias("page_id"), html.alias("html"), now().alias("ingest_ts"), *extra)


CLEANED = "regexp_replace(source, 's', 'S')"


@query("nr12_paper_listing_html", "SELECT source AS title, 'https://papers.cool/arxiv/2401.' || lpad(CAST(doc_id % 300 AS VARCHAR), 5, '0') AS url, 100.0 - (doc_id % 20 + 1) AS score FROM documents QUALIFY row_number() OVER (PARTITION BY doc_id % 300 ORDER BY doc_id) = 1")
def listing(spark, sf):
    pid = F.concat(F.lit("2401."), F.lpad((c("doc_id") % 300).cast("string"), 5, "0"))
    html = F.concat(F.lit('<body><div class="top">x</div><div id="'), pid, F.lit('" class="panel paper"><h2 class="title"><span class="index">#'), (c("doc_id") % 20 + 1).cast("string"), F.lit('</span><a class="title-link" href="/arxiv/'), pid, F.lit('"> '), "source",
                    F.lit(' </a></h2></div><div class="paper"><p>no title</p></div></body>'))
    return out(pages.paper_listing(page(spark, sf, html, F.lit("cs.AI").alias("category"))), "title", "url", "score")


@query("nr15_award_page_aaai", "SELECT '[AAAI 2026 Outstanding Paper] T' || doc_id AS title, source || ' and B' AS author FROM documents UNION ALL SELECT '[AAAI 2026 Best Student Paper] U' || doc_id, lang FROM documents UNION ALL SELECT '[AAAI 2026 Best Student Paper] V' || doc_id, 'next ' || lang FROM documents")
def aaai(spark, sf):
    html = F.concat(F.lit("<h3>2026</h3><h4>AAAI-26 Outstanding Paper Awards</h4><p><strong>T"), "k", F.lit("</strong><br>"), "source", F.lit(" <i>and B</i></p><h5>Best Student Paper Award</h5><p><strong>U"), "k", F.lit("</strong> "), "lang",
                    F.lit("</p><p><strong>V"), "k", F.lit("</strong></p><p>next "), "lang", F.lit("</p><h3>2025</h3><p><strong>Old</strong><br>x</p>"))
    return out(pages.award_page_sections(page(spark, sf, html, F.lit("AAAI").alias("conf"), F.lit(2026).alias("year"))), "title", "author")


@query("nr16_award_page_cvpr", "SELECT '[CVPR 2026 Best Paper] T' || doc_id AS title, source AS author FROM documents UNION ALL SELECT '[CVPR 2026 Honorable Mention] U' || doc_id, lang FROM documents")
def cvpr(spark, sf):
    html = F.concat(F.lit("<h2>Other</h2><p>Authors: none</p><h2>Best Papers 2026</h2><p>Best Paper:</p><p>Paper Name: T"), "k", F.lit("</p><p>Authors: "), "source", F.lit("</p><p><br/></p><p>Honorable Mention: ID: 12</p><p>Paper Name: U"), "k", F.lit("</p><p>Authors: "), "lang",
                    F.lit("</p><p>Authors: twice</p><h2>Demos</h2><p>Paper Name: D</p><p>Authors: d</p>"))
    return out(pages.award_page_lines(page(spark, sf, html, F.lit("CVPR").alias("conf"), F.lit(2026).alias("year"), F.lit("u").alias("url"))), "title", "author")


@query("nr17_award_page_acl", "SELECT '[ACL 2026 Best Paper] T' || doc_id AS title, source || ', ' || lang AS author FROM documents UNION ALL SELECT '[ACL 2026 SAC] U' || doc_id, lang FROM documents")
def acl(spark, sf):
    html = F.concat(F.lit("<section class='page__content'><h2>Best Paper Awards</h2><ul><li><strong>T"), "k", F.lit('"</strong><br><em>'), "source", F.lit("; "), "lang", F.lit(";</em></li><li>none</li></ul><h2>SAC Award</h2><ul><li><strong>U"), "k", F.lit("</strong><u>x</u><em>"), "lang", F.lit("</em></li></ul></section>"))
    return out(pages.award_page_list(page(spark, sf, html, F.lit("ACL").alias("conf"), F.lit(2026).alias("year"), F.lit("u").alias("url"))), "title", "author")


@query("nr18_award_item", "SELECT '[C 2026 Best] ' || source AS title, 'c,best_paper,2026' AS tags FROM documents")
def award(spark, sf):
    rows = docs(spark, sf).select(F.lit("C").alias("conf"), F.lit(2026).alias("year"), c("source").alias("paper_title"), F.lit("a").alias("author"), F.lit("Best").alias("award"), F.lit("").alias("url"), now().alias("ingest_ts"))
    return payloads.award_items(rows).select("title", F.array_join("tags", ",").alias("tags"))


def feed(spark, sf):
    """One feed per document: an entry with summary, and one with content only."""
    xml = F.concat(F.lit("<rss><channel><title>Show "), "lang", F.lit("</title><item><title> T"), "k", F.lit(" Kindle</title><link>https://f.example/"), (c("doc_id") % 500).cast("string"), F.when(c("doc_id") % 2 == 0, "/").otherwise(""),
                   F.lit("</link><description>S"), "k", F.lit("</description><pubDate>"), day("dd MMM yyyy HH:mm:ss"), F.lit(" GMT</pubDate><category>c1</category><category>c2</category><enclosure url='https://a/"), "k", F.lit("' length='"),
                   F.when(c("doc_id") % 3 == 0, "bad").otherwise(c("k")), F.lit("'/></item><item><title></title><link></link><content>C"), "k", F.lit("</content></item></channel></rss>"))
    return feeds.parse_feeds(docs(spark, sf).select(F.concat(F.lit("f"), "k").alias("feed"), c("doc_id").alias("ord"), xml.alias("payload"), now().alias("ingest_ts")))


@query("nr19_rss_entries", f"SELECT 'T' || doc_id || ' Kindle' AS title, 'S' || doc_id AS content, {DAY} AS published_at FROM documents UNION ALL SELECT 'Untitled', 'C' || doc_id, TIMESTAMP '2026-01-05' FROM documents")
def rss(spark, sf):
    return out(feeds.rss_entries(feed(spark, sf), "rss"), F.trim("title").alias("title"), "content", "published_at")


@query("nr20_podcast_entries", "SELECT '[Show ' || lang || '] T' || doc_id || ' Kindle' AS title, CASE WHEN doc_id % 3 = 0 THEN 0 ELSE doc_id END AS bytes FROM documents UNION ALL SELECT '[Show ' || lang || '] Untitled', 0 FROM documents")
def podcast(spark, sf):
    rows = feeds.podcast_entries(feed(spark, sf), "apple_podcast")
    return rows.select(F.regexp_replace("title", r"\]\s+", "] ").alias("title"), F.get_json_object("extra", "$.file_size_bytes").cast("bigint").alias("bytes"))


@query("nr21_multi_feed_merge", f"SELECT 'S' || doc_id AS content FROM documents WHERE {DAY} >= TIMESTAMP '2026-01-02' QUALIFY row_number() OVER (PARTITION BY doc_id % 500, doc_id % 2 ORDER BY doc_id) = 1 UNION ALL SELECT 'C' || doc_id FROM documents")
def merged(spark, sf):
    return feeds.multi_feed_merge(feed(spark, sf), "baoyu_blog", F.lit("2026-01-02").cast("timestamp")).select("content")


@query("nr22_cn_blog_entries", "SELECT 'T' || doc_id || ' Kindle' AS title, 'c1,c2' AS tags, 'Show ' || lang AS author FROM documents QUALIFY row_number() OVER (PARTITION BY doc_id % 500 ORDER BY doc_id) = 1")
def cn_blog(spark, sf):
    return feeds.cn_blog_entries(feed(spark, sf)).select("title", F.array_join("tags", ",").alias("tags"), "author")


@query("nr23_vendor_blog_entries", "SELECT 'T' || doc_id || ' Kindle' AS title, 'Google' AS author FROM documents QUALIFY row_number() OVER (PARTITION BY doc_id % 500 ORDER BY doc_id) = 1")
def vendor(spark, sf):
    return feeds.vendor_blog_entries(feed(spark, sf), "google_blog").select("title", "author")


@query("nr24_book_feed_entries", "SELECT 'T' || doc_id || ' Kindle' AS title, 'book,kindle' AS tags FROM documents QUALIFY row_number() OVER (PARTITION BY doc_id % 500, doc_id % 2 ORDER BY doc_id) = 1")
def books(spark, sf):
    return feeds.book_entries(feed(spark, sf)).select("title", F.array_join("tags", ",").alias("tags"))


@query("nr25_rsc_payload_extract", "SELECT 'Title ' || doc_id AS title, 'https://www.anthropic.com/research/s' || (doc_id % 600) AS url, TIMESTAMP '2026-01-03' AS published_at FROM documents WHERE doc_id % 4 <> 0 QUALIFY row_number() OVER (PARTITION BY doc_id % 600 ORDER BY doc_id) = 1")
def rsc(spark, sf):
    far = F.when(c("doc_id") % 4 == 0, F.repeat(F.lit("x"), 2500)).otherwise("")
    inner = F.concat(F.lit('{"title":"Title '), "k", F.lit('",'), far, F.lit('"slug":{"_type":"slug","current":"s'), (c("doc_id") % 600).cast("string"), F.lit('"},"publishedOn":"2026-01-03T00:00:00Z"}'))
    html = F.concat(F.lit('<script>self.__next_f.push([1,"'), F.replace(inner, F.lit('"'), F.lit('\\"')), F.lit('"])</script>'))
    return out(pages.script_payload_items(page(spark, sf, html, F.lit("research").alias("section"))), "title", "url", "published_at")


@query("nr26_sitemap_entries", "SELECT 'Big News ' || (doc_id % 300) AS title, 'https://s.example/engineering/big-news-' || (doc_id % 300) || '/' AS url FROM documents QUALIFY row_number() OVER (PARTITION BY doc_id % 300 ORDER BY doc_id) = 1")
def sitemap(spark, sf):
    xml = F.concat(F.lit("<urlset><url><loc>https://s.example/engineering/big-news-"), (c("doc_id") % 300).cast("string"), F.lit("/</loc><lastmod>2026-01-02</lastmod></url><url><loc>https://s.example/engineering/</loc></url><url><loc>https://s.example/about/us</loc></url></urlset>"))
    return out(feeds.sitemap_entries(docs(spark, sf).select(xml.alias("payload"), now().alias("ingest_ts"), c("doc_id").alias("land_id"))), "title", "url")


@query("nr27_manual_items", "SELECT CASE WHEN page_id % 3 = 0 THEN 'Given ' || page_id ELSE regexp_extract(url, '://([^/?#]*)', 1) || rtrim(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '/') END AS title, url FROM pages WHERE page_id % 4 <> 0")
def manual(spark, sf):
    p = table(spark, sf, "pages")
    q = p.select("url", (c("page_id") % 4 == 0).alias("processed"), F.when(c("page_id") % 3 == 0, F.concat(F.lit("Given "), c("page_id").cast("string"))).alias("title"))
    return payloads.manual_items(q).select("title", "url")


@query("nr28_published_at_fallback", "SELECT doc_id, CASE doc_id % 6 WHEN 5 THEN TIMESTAMP '2026-01-05' ELSE TIMESTAMP '2026-01-01' + to_hours(doc_id % 90) END AS at FROM documents")
def fallback(spark, sf):
    m = c("doc_id") % 6
    raw = F.when(m == 0, day()).when(m == 1, day("EEE, dd MMM yyyy HH:mm:ss 'GMT'")).when(m == 2, day("EEE MMM dd HH:mm:ss Z yyyy")).when(m == 3, day("yyyy-MM-dd HH:mm:ss")).when(m == 4, day("dd MMM yyyy HH:mm:ss Z")).otherwise("soon")
    return docs(spark, sf).select("doc_id", T.published_at([F.lit(""), raw], now()).alias("at"))


@query("ux01_source_plugin", "SELECT doc_id, source FROM documents WHERE doc_id % 2 = 0")
def plug(spark, sf):
    @plugin.register("even_documents")
    def even(df):
        return df.where("doc_id % 2 = 0").select("doc_id", "source")

    chosen = plugin.enabled({"even_documents": {"enabled": True}, "reddit": {"enabled": False}, "unknown_source": {}})
    return plugin.union_sources([fn(docs(spark, sf)) for fn in chosen.values()])


@query("ux04_text_functions", "SELECT page_id, url AS target FROM pages")
def text_functions(spark, sf):
    from briefwright.functions.markdown import link_targets, plain_links

    p = table(spark, sf, "pages")
    return p.select("page_id", F.element_at(link_targets(plain_links(F.concat(F.lit("x <"), F.lit("b> [l](<"), "url", F.lit(">) y")))), 1).alias("target"))
