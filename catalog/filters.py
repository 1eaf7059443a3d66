"""Filters, routes and selections."""

from pyspark.sql import functions as F

from briefwright.operators import filters as O, registry as R, relevance as V
from briefwright.functions import text as T, urls as U
from briefwright.functions.urls import heat_is_open
from briefwright.lexicon import Lexicon
from briefwright.plans.daily import clean_top_items
from catalog.base import SEARCH, TEXT, any_of, hits, items, query, s, table, with_items

L = Lexicon()
AD = r"(?i)\b(sponsored|promoted|advertisement)\b|#ad\b|#sponsored\b|\b(affiliate link|use my code|discount code|promo code)\b|\b(buy now|limited offer|exclusive deal|check out my)\b|(广告|推广|赞助|优惠券|折扣码|限时优惠|种草|带货|恰饭)|\bthe of\b"
AD_RULES = {"title_keywords": [r"\bthe of\b"], "url_blocklist": [r"://(www\.)?producthunt\.com/posts/1"],
            "per_source": {"reddit": {"min_upvote_ratio": 0.3, "title_keywords": [r"\bhot take\b"]}, "zhihu": {"title_keywords": ["survey"]}}}
PATTERNS = [r"(?i)\b(sponsored|promoted|advertisement)\b", r"(?i)#ad\b|#sponsored\b", r"(?i)\b(affiliate link|use my code|discount code|promo code)\b",
            r"(?i)\b(buy now|limited offer|exclusive deal|check out my)\b", r"(广告|推广|赞助|优惠券|折扣码|限时优惠|种草|带货|恰饭)"]


def first_hit(text, patterns, label):
    cases = " ".join(f"WHEN regexp_matches({text}, '{p}') THEN '{label}: ' || regexp_extract({text}, '{p}')" for p in patterns)
    return f"CASE {cases} END"


KEYWORD_REASON = first_hit("(title || ' ' || content)", [*PATTERNS, r"(?i)\bthe of\b"], "keyword_match")
URL_REASON = first_hit("url", [r"://(bit\.ly|tinyurl\.com|amzn\.to|shrinkme\.io)/", r"://t\.co/", r"://(www\.)?(shopify\.com|gumroad\.com|etsy\.com)/",
                               r"://(www\.)?producthunt\.com/posts/1"], "blocked_url")
SOURCE_REASON = r"""CASE WHEN source = 'reddit' THEN CASE WHEN regexp_matches(title, '(?i)\bhot take\b') THEN 'source_keyword: \bhot take\b'
    WHEN x_ratio < 0.3 THEN 'reddit_low_ratio: ' || x_ratio || ' < 0.3' END
  WHEN source = 'zhihu' AND regexp_matches(title, '(?i)survey') THEN 'source_keyword: survey' END"""
REASON = f"coalesce({KEYWORD_REASON}, {URL_REASON}, {SOURCE_REASON})"


@query("flow_clean_top_items", with_items(f"""SELECT source, item_id, title, score, rn FROM (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, pos) AS rn FROM (SELECT *, {REASON} AS ad_reason FROM items WHERE score >= 20) WHERE ad_reason IS NULL)
    WHERE rn <= 10"""))
def flow_clean_top_items(spark, sf):
    from pyspark.sql import Window

    rows = clean_top_items(items(spark, sf), 20.0, 10, AD_RULES)
    w = Window.partitionBy("source").orderBy(F.col("score").desc(), "pos")
    return rows.withColumn("rn", F.row_number().over(w)).select("source", "item_id", "title", "score", "rn")


@query("fl01_lookback_filter", with_items("""SELECT item_id, source FROM items WHERE published_at >= TIMESTAMP '2024-01-03 12:00:00' -
    to_hours(CASE source WHEN 'github' THEN 48 WHEN 'openai' THEN 240 ELSE 24 END)"""))
def lookback(spark, sf):
    return O.lookback(items(spark, sf), F.lit("2024-01-03 12:00:00").cast("timestamp"), {"github": 48, "openai": 240}).select("item_id", "source")


@query("fl02_score_threshold", with_items("SELECT item_id, score FROM items WHERE score >= CASE source WHEN 'reddit' THEN 100 WHEN 'github' THEN 50 ELSE 0 END"))
def threshold(spark, sf):
    return O.score_threshold(items(spark, sf), {"reddit": 100, "github": 50}).select("item_id", "score")


@query("fl03_source_filter", with_items("SELECT item_id, title FROM items WHERE source = 'openai'"))
def of_source(spark, sf):
    return O.of_source(items(spark, sf), "openai").select("item_id", "title")


@query("fl04_ad_keyword_filter", with_items(f"SELECT item_id, {KEYWORD_REASON} AS reason FROM items"))
def ad_keyword(spark, sf):
    return items(spark, sf).select("item_id", O.ad_keyword_reason([r"\bthe of\b"]).alias("reason"))


@query("fl05_ad_url_filter", with_items(f"SELECT item_id, CASE WHEN url <> '' THEN {URL_REASON} END AS reason FROM items"))
def ad_url(spark, sf):
    return items(spark, sf).select("item_id", O.ad_url_reason(AD_RULES["url_blocklist"]).alias("reason"))


@query("fl06_ad_source_rules", with_items(f"SELECT item_id, {SOURCE_REASON} AS reason FROM items"))
def ad_source(spark, sf):
    return items(spark, sf).select("item_id", O.ad_source_reason(AD_RULES["per_source"]).alias("reason"))


@query("fl07_ad_split", with_items(f"SELECT source, count(*) AS n, count(*) FILTER (WHERE {REASON} IS NULL) AS clean, count({REASON}) AS blocked FROM items GROUP BY source"))
def ad_split(spark, sf):
    clean, blocked = O.ad_split(items(spark, sf), AD_RULES)
    both = clean.select("source", F.lit(0).alias("b")).unionByName(blocked.select("source", F.lit(1).alias("b")))
    return both.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("b") == 0).alias("clean"), F.count_if(F.col("b") == 1).alias("blocked"))


@query("fl08_feed_threshold_filter", with_items("""SELECT item_id, x_feed AS feed FROM items WHERE (x_feed <> 'hot' OR (x_voteups >= 50 AND x_favorites >= 5))
    AND (x_feed <> 'follow' OR x_voteups >= 20)"""))
def feed_thresholds(spark, sf):
    rows = O.feed_thresholds(items(spark, sf), {"hot": {"min_voteup": 50, "min_favorite": 5}, "follow": {"min_voteup": 20}})
    return rows.select("item_id", F.try_variant_get(F.parse_json("extra"), "$.feed_type", "string").alias("feed"))


@query("fl09_rating_filter", """SELECT doc_id, lang AS conference, avg_rating FROM (SELECT doc_id, lang, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE (doc_id % 9) + 0.5 END AS avg_rating FROM documents)
    WHERE avg_rating IS NULL OR (lang NOT IN ('en', 'fr')) OR (lang = 'en' AND avg_rating >= 6) OR (lang = 'fr' AND avg_rating >= 4)""")
def rating(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("conference"), F.expr("case when doc_id % 3 = 0 then null else (doc_id % 9) + 0.5D end").alias("avg_rating"))
    return O.rating_filter(rows, {"en": 6.0, "fr": 4.0})


@query("fl10_enrichment_eligibility", with_items(f"SELECT item_id, source FROM items WHERE source IN {tuple(O.ENRICHMENT_SOURCES)}"))
def eligible(spark, sf):
    return O.enrichment_eligible(items(spark, sf)).select("item_id", "source")


@query("fl11_select_articles", with_items("""SELECT dt, item_id FROM (SELECT *, row_number() OVER (PARTITION BY dt, length(content) < 1500 ORDER BY score DESC, pos) AS rn FROM items
    WHERE source IN ('anthropic', 'openai', 'google_blog', 'manual_urls') OR source_type = 'http_scrape') WHERE length(content) < 1500 OR rn <= 2"""))
def articles(spark, sf):
    return O.select_articles(items(spark, sf), 1500, 2, by=["dt"]).select("dt", "item_id")


RATE = "(x_vlikes + x_comments) / CAST(greatest(x_views, 1) AS DOUBLE)"


@query("fl12_select_videos", with_items(f"""SELECT dt, item_id, engagement_rate FROM (SELECT *, {RATE} AS engagement_rate, row_number() OVER (PARTITION BY dt ORDER BY {RATE} DESC, pos) AS rn
    FROM items WHERE source = 'youtube' AND {RATE} >= 0.05) WHERE rn <= 2"""))
def videos(spark, sf):
    return O.select_videos(items(spark, sf), 2, 0.05, by=["dt"]).select("dt", "item_id", "engagement_rate")


@query("fl13_select_podcasts", with_items("""SELECT dt, item_id, choice FROM (SELECT *, CASE WHEN x_seconds > 1800 THEN 'manual' ELSE 'enrich' END AS choice,
    row_number() OVER (PARTITION BY dt, x_seconds > 1800 ORDER BY pos) AS rn FROM items WHERE source IN ('apple_podcast', 'xiaoyuzhou') AND list_contains(tags, 'podcast'))
    WHERE choice = 'manual' OR rn <= 1"""))
def podcasts(spark, sf):
    return O.with_podcast_choice(items(spark, sf), 1, 30, by=["dt"]).select("dt", "item_id", "choice")


LOW = "list_transform(tags, lambda t: lower(t))"
FIN = f"(source = 'finance' OR list_contains({LOW}, 'finance'))"
FIN_REL = f"({FIN} AND {any_of('search', L['finance_relevant'])})"
SEARCHED = f"searched AS MATERIALIZED (SELECT *, {SEARCH} AS search FROM items)"


@query("fl14_finance_relevance", with_items(f"SELECT item_id, {FIN_REL} AS relevant FROM searched", SEARCHED))
def finance(spark, sf):
    return V.with_routing_text(items(spark, sf)).select("item_id", V.finance_is_relevant(L).alias("relevant"))


@query("fl15_investment_route", with_items(f"SELECT item_id FROM searched WHERE {FIN} AND NOT {FIN_REL}", SEARCHED))
def investment(spark, sf):
    return V.with_routing_text(items(spark, sf)).where(V.goes_to_investment(L)).select("item_id")


FLAT = ("flat AS MATERIALIZED (SELECT *, regexp_replace(flat, '[\\s_\\-:：/·.\'\'\"“”‘’「」]+', '', 'g') AS dense FROM"
        " (SELECT *, regexp_replace(search, '\\s+', ' ', 'g') AS flat FROM searched))")


def route_sql():
    """Needs the columns flat and dense."""
    from briefwright.functions.text import ROUTE_ANCHORS, _compact_term

    def phrase(terms):
        pairs = "[" + ", ".join(f"{{'p': {s([t.lower()])}[1], 'c': {s([_compact_term(t)])}[1]}}" for t in terms) + "]"
        return f"len(list_filter({pairs}, lambda q: contains(flat, q.p) OR contains(dense, q.c)))"

    neg = r"\b(?:not|without|beyond|abandon(?:ing)?|abandons?|drop(?:ping)?|drops?|do(?:es)?\s+not|doesn''t|don''t)\b\s+(?:\w+\s+){0,4}(?:predict(?:ing)?\s+(?:the\s+)?next[-\s]?token|next[-\s]?token\s+prediction)\b"
    cjk = r"(?i)(?:放弃|不再|不是|并非|无需).{0,12}预测.{0,4}下一个\s*token"
    return (f"({phrase(L['route_strong'])} > 0 OR ({any_of('flat', L['route_context'])} AND (({phrase(L['route_phrase'])} >= 2 AND {phrase(ROUTE_ANCHORS)} > 0)"
            f" OR regexp_matches(flat, '{neg}') OR regexp_matches(flat, '{cjk}'))))")


AI_WORD = r"regexp_matches(search, '(^|[^\p{L}\p{N}_])ai([^\p{L}\p{N}_]|$)')"


def relevance_sql():
    tagged = f"(len(list_intersect({LOW}, {s(L['relevance_tags'])})) > 0)"
    n = "n_terms"
    points = lambda cond, value: f"CASE WHEN {cond} THEN {value} ELSE 0.0 END"
    total = (f"{points('on_route', '0.35::DOUBLE')} + {points('source IN ' + str(tuple(V.PRIMARY_SOURCES)), '0.35::DOUBLE')} + {points(tagged, '0.35::DOUBLE')} + least(0.6::DOUBLE, {n} * 0.12::DOUBLE)"
             f" + {points(AI_WORD, '0.25::DOUBLE')} + {points('arxiv_id IS NOT NULL AND ' + n + ' > 0', '0.15::DOUBLE')}"
             f" + {points('source IN (' + repr('github') + ',' + repr('producthunt') + ') AND ' + n + ' > 0', '0.1::DOUBLE')}"
             f" - {points('source IN ' + str(tuple(V.BROAD_SOURCES)) + ' AND NOT ' + tagged + ' AND ' + n + ' = 0', '0.3::DOUBLE')}")
    book = f"(source IN {tuple(V.BOOK_SOURCES)} OR len(list_intersect({LOW}, {s(V.BOOK_TAGS)})) > 0)"
    return f"CASE WHEN {book} THEN 1.0::DOUBLE WHEN {FIN_REL} THEN 0.9::DOUBLE ELSE round(greatest(0::DOUBLE, least(1::DOUBLE, {total})), 3) END"


RELEVANT = (SEARCHED + ", " + FLAT + f", counted AS (SELECT *, {hits('search', L['relevance_terms'])} AS n_terms, {route_sql()} AS on_route FROM flat)"
            f", routed AS (SELECT *, relevance, CASE WHEN {FIN} AND NOT {FIN_REL} THEN 'investment' WHEN relevance >= 0.35 THEN 'kept' ELSE 'filtered' END AS route"
            f" FROM (SELECT *, {relevance_sql()} AS relevance FROM counted))")


@query("fl16_relevance_gate", with_items("SELECT item_id, route <> 'investment' AND relevance >= 0.35 AS relevant FROM routed", RELEVANT))
def gate(spark, sf):
    rows = V.with_relevance(items(spark, sf), L)
    return rows.select("item_id", ((F.col("route") != "investment") & (F.col("relevance") >= 0.35)).alias("relevant"))


@query("fl17_three_way_route", with_items("SELECT source, route, count(*) AS n FROM routed GROUP BY source, route", RELEVANT))
def three_way(spark, sf):
    return V.with_relevance(items(spark, sf), L).groupBy("source", "route").agg(F.count(F.lit(1)).alias("n"))


@query("sr02_ai_relevance_score", with_items("SELECT item_id, relevance FROM routed", RELEVANT))
def relevance(spark, sf):
    return V.with_relevance(items(spark, sf), L).select("item_id", "relevance")


@query("st17_paradigm_route_signal", with_items("SELECT item_id, on_route FROM counted", RELEVANT))
def route_signal(spark, sf):
    return V.with_routing_text(items(spark, sf)).select("item_id", T.route_signal(F.col("search"), L).alias("on_route"))


STATUS_SQL = "CAST([200, 301, 404, 403, 500, 429, 204, 401, 410][page_id % 9 + 1] AS BIGINT)"


def url_status(spark, sf):
    return table(spark, sf, "pages").select("page_id", "url", F.expr("array(200, 301, 404, 403, 500, 429, 204, 401, 410)[cast(page_id % 9 as int)]").alias("status"))


@query("fl18_link_status_predicate", f"SELECT page_id, s BETWEEN 200 AND 399 OR s IN (401, 403, 429) AS is_open FROM (SELECT page_id, {STATUS_SQL} AS s FROM pages)")
def link_status(spark, sf):
    return url_status(spark, sf).select("page_id", heat_is_open(F.col("status")).alias("is_open"))


KIND = r"""CASE WHEN source = 'github' AND (contains(rtext, '[release]') OR contains(rtext, '/releases/')) THEN
  CASE WHEN NOT regexp_matches(rtext, '(^|[^a-z0-9])v?\d+\.\d+') THEN 'unknown'
       WHEN regexp_matches('-' || suffix, '(?:^|[-.])(alpha|beta|rc|pre|preview|dev|nightly|canary)\d*') AND suffix <> '' THEN 'prerelease'
       WHEN CAST(ma AS INT) >= 1 AND CAST(mi AS INT) = 0 AND coalesce(try_cast(pa AS INT), 0) = 0 THEN 'major'
       WHEN coalesce(try_cast(pa AS INT), 0) > 0 THEN 'patch' WHEN CAST(mi AS INT) > 0 THEN 'minor' ELSE 'unknown' END END"""
KINDS = (r"versions AS (SELECT *, lower(title || ' ' || url) AS rtext FROM items), split_versions AS (SELECT *, "
         + ", ".join(f"regexp_extract(rtext, '(?:^|[^a-z0-9])v?(\\d+)\\.(\\d+)(?:\\.(\\d+))?(?:[-+.]?([0-9a-z][0-9a-z.-]*))?', {i}) AS {n}" for i, n in enumerate(["ma", "mi", "pa", "suffix"], 1))
         + f" FROM versions), kinds AS (SELECT *, {KIND} AS kind FROM split_versions)")


@query("st20_release_kind", with_items("SELECT item_id, kind FROM kinds WHERE kind IS NOT NULL", KINDS))
def release_kind(spark, sf):
    rows = items(spark, sf).withColumn("kind", T.release_kind(F.col("source"), F.col("title"), F.col("url")))
    return rows.where("kind is not null").select("item_id", "kind")


@query("fl20_headline_release_gate", with_items("SELECT item_id, kind IS NULL OR kind = 'major' OR (kind = 'prerelease' AND contains(rtext, 'breaking')) AS may_lead FROM kinds", KINDS))
def release_gate(spark, sf):
    from briefwright.operators.scoring import release_may_lead

    rows = items(spark, sf).withColumn("kind", T.release_kind(F.col("source"), F.col("title"), F.col("url")))
    signal = F.when(F.lower(F.concat_ws(" ", "title", "url")).contains("breaking"), 1.0).otherwise(0.0)
    return rows.select("item_id", release_may_lead(F.col("kind"), signal).alias("may_lead"))


RUNS = """runs AS (SELECT 'run' || o_orderkey AS run_id, strftime(o_orderdate, '%Y-%m-%d') AS date, CASE WHEN o_orderkey % 2 = 0 THEN 'collect' ELSE 'full' END AS phase,
    CAST(o_orderdate AS TIMESTAMP) + to_seconds(o_orderkey % 86400) AS started_at, CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failed' ELSE 'running' END AS status FROM orders)"""


def runs(spark, sf):
    o = table(spark, sf, "orders")
    start = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(secs=F.col("o_orderkey") % 86400)
    return o.select(F.concat(F.lit("run"), "o_orderkey").alias("run_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
                    F.expr("case when o_orderkey % 2 = 0 then 'collect' else 'full' end").alias("phase"), start.alias("started_at"),
                    F.expr("case o_orderstatus when 'F' then 'success' when 'O' then 'failed' else 'running' end").alias("status"))


@query("fl21_run_guard", f"WITH {RUNS} SELECT count(*) FILTER (WHERE date = '1997-05-28' AND phase IN ('collect', 'full') AND status = 'success') > 0 AS succeeded FROM runs")
def run_guard(spark, sf):
    return O.successful_run_exists(runs(spark, sf), "1997-05-28", ["collect", "full"])


@query("fl22_relation_negation", with_items(rf"SELECT item_id FROM items WHERE regexp_matches({TEXT} || CASE WHEN pos % 5 = 0 THEN ' not  related' ELSE '' END, '\b(unrelated|not\s+related|separate\s+from)\b')"))
def negation(spark, sf):
    text = T.item_text(F.col("source"), F.col("title"), F.col("content"), F.col("tags"), F.col("author"))
    marked = F.concat(text, F.when(F.col("pos") % 5 == 0, " not  related").otherwise(""))
    return items(spark, sf).where(T.says_unrelated(marked)).select("item_id")
