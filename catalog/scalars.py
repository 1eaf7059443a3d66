"""Scalar function queries."""

from pyspark.sql import functions as F

from briefwright.functions import identity as I, markdown as M, text as T, urls as U
from briefwright.functions.ratio import symmetric_ratio
from briefwright.lexicon import Lexicon, any_substring, substring_hits, token_hits
from briefwright.operators import usage as G
from briefwright.plans import calendar as C, reports as P
from catalog.aggregates import identity_sql
from catalog.base import TEXT, any_of, common, hits, host, items, parts, query, s, table, with_items, words
from catalog.filters import KINDS, RELEVANT
from catalog.joins import candidates_sql

L = Lexicon()
c = F.col


def item_text():
    return T.item_text(c("source"), c("title"), c("content"), c("tags"), c("author"))


@query("st02_extract_arxiv_id", with_items(r"SELECT item_id, nullif(regexp_extract(url, '(\d{4}\.\d{4,5})(?:v\d+)?', 1), '') AS paper FROM items"))
def arxiv(spark, sf):
    return items(spark, sf).select("item_id", T.arxiv_id_in(c("url")).alias("paper"))


@query("st03_url_host", f"SELECT page_id, {host('url')} AS host FROM pages")
def url_host(spark, sf):
    return table(spark, sf, "pages").select("page_id", U.url_host(c("url")).alias("host"))


@query("st04_source_candidates", with_items(f"SELECT item_id, array_to_string({candidates_sql('source', 'url')}, '|') AS keys FROM items"))
def candidates(spark, sf):
    return items(spark, sf).select("item_id", F.array_join(U.source_candidates(c("source"), c("url")), "|").alias("keys"))


@query("st05_source_identity", with_items(f"SELECT item_id, {identity_sql()} AS identity FROM items"))
def identity(spark, sf):
    return items(spark, sf).select("item_id", U.source_identity(c("source"), c("url")).alias("identity"))


PAPER = rf"""CASE WHEN arxiv_id IS NOT NULL THEN trim(regexp_replace(lower(arxiv_id), 'v\d+$', '')) WHEN {host('url')} IN ('arxiv.org', 'papers.cool', 'alphaxiv.org') AND len({parts('url')}) > 0 THEN regexp_replace(lower({parts('url')}[-1]), 'v\d+$', '')
    WHEN {host('url')} = 'openreview.net' THEN lower({parts('url')}[-1]) ELSE '' END"""


@query("st06_paper_identity", with_items(f"SELECT item_id, {PAPER} AS paper_id FROM items"))
def paper_identity(spark, sf):
    return items(spark, sf).select("item_id", U.paper_identity(c("arxiv_id"), c("url")).alias("paper_id"))


def slug_sql(x):
    return f"trim(regexp_replace(lower({x}), '[^a-z0-9]+', '-', 'g'), '-')"


def release_sql():
    named = " ".join(
        f"WHEN regexp_matches(rt, '{p}') THEN 'frontier-release:{v}:{f}-' || " + (f"regexp_extract(rt, '{p}', 1) || '-' || " if fam else "") + slug_sql(f"regexp_extract(rt, '{p}', {2 if fam else 1})")
        for p, v, f, fam in I.RELEASE_PATTERNS)
    labs = "[" + ", ".join(f"{{'a': '{a}', 'v': '{v}', 'm': '{I._model_slug(a)}'}}" for a, v in I.LAB_ALIASES) + "]"
    version = slug_sql(r"regexp_extract(lt, '(?:^|[^\p{L}\p{N}_])([a-z]?\d+(?:\.\d+)?)(?:$|[^\p{L}\p{N}_])', 1)")
    return f"""releases AS MATERIALIZED (SELECT *, CASE {named} WHEN lab IS NOT NULL AND ver <> '' AND NOT regexp_full_match(ver, '20\\d{{2}}') AND {any_of('hay', L['major_release'])} THEN 'frontier-release:' || lab.v || ':' || lab.m || '-' || ver ELSE '' END AS release_id
      FROM (SELECT *, list_filter({labs}, lambda q: contains(hay, q.a))[1] AS lab, {version} AS ver FROM (SELECT *, lower(title || ' ' || url) AS rt, lower(title) AS lt, lower(title) || ' ' || lower(content) AS hay FROM items)))"""


@query("st08_frontier_release_id", with_items("SELECT item_id, release_id FROM releases", release_sql()))
def release_id(spark, sf):
    return items(spark, sf).select("item_id", I.release_identity(c("title"), c("url"), c("content"), L).alias("release_id"))


KEYS = RELEVANT + ", " + release_sql().replace("FROM items)", "FROM counted)")


def campaign_sql():
    rules = " ".join(f"WHEN {' AND '.join(any_of('chay', g) for g in groups)} THEN 'umbrella:{k}'" for k, groups in I.CAMPAIGNS)
    google = f"({any_of('chay', I.GOOGLE_ACTORS)} OR h IN {tuple(I.GOOGLE_HOSTS)} OR ends_with(h, '.google')) AND {any_of('chay', I.GOOGLE_CAMPAIGN_TERMS)}"
    return f"CASE WHEN release_id <> '' THEN 'umbrella:' || release_id WHEN on_route THEN 'umbrella:route:paradigm-shift' {rules} WHEN {google} THEN 'umbrella:google-io-gemini' ELSE '' END"


PATHS_SQL = "regexp_replace(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1), ';[^/]*$', '')"
CAMP = f"camps AS MATERIALIZED (SELECT *, {campaign_sql()} AS campaign FROM (SELECT *, {TEXT} || ' ' || h || ' ' || lower({PATHS_SQL}) AS chay FROM (SELECT *, {host('url')} AS h FROM releases)))"


def with_keys(spark, sf):
    return items(spark, sf).withColumns({
        "release_id": I.release_identity(c("title"), c("url"), c("content"), L), "paper_id": U.paper_identity(c("arxiv_id"), c("url")), "text": item_text(),
        "on_route": T.route_signal(T.search_text(c("source"), c("title"), c("content"), c("tags"), c("author"), c("extra")), L)})


@query("st09_campaign_key", with_items("SELECT item_id, campaign FROM camps", KEYS, CAMP))
def campaign(spark, sf):
    return with_keys(spark, sf).select("item_id", I.campaign_key(c("release_id"), c("on_route"), c("text"), c("url")).alias("campaign"))


EVENT_KEY = f"""CASE WHEN release_id <> '' THEN release_id WHEN paper_id <> '' THEN 'paper:' || paper_id WHEN on_route THEN 'route:paradigm-shift' WHEN h IN ('x.com', 'twitter.com') AND len(pp) >= 3 AND pp[2] = 'status' THEN ''
    WHEN h = 'youtube.com' AND pp[1] = 'watch' THEN '' WHEN h IN ('youtube.com', 'youtu.be') AND len(pp) > 0 THEN 'url:' || h || '/' || lower(pp[1]) WHEN h <> '' AND len(pp) > 0 THEN 'url:' || h || '/' || lower(array_to_string(pp, '/')) ELSE '' END"""


@query("st07_event_key", with_items(f"SELECT item_id, {EVENT_KEY} AS event_key FROM (SELECT *, {PAPER} AS paper_id, {parts('url')} AS pp FROM camps)", KEYS, CAMP))
def event_key(spark, sf):
    return with_keys(spark, sf).select("item_id", I.event_key(c("release_id"), c("paper_id"), c("on_route"), c("url")).alias("event_key"))


CLEAN = r"trim(regexp_replace(regexp_replace(title, 'https?://\S+', ' ', 'g'), '\s+', ' ', 'g'))"


@query("st10_clean_title", with_items(f"SELECT item_id, {CLEAN} AS title FROM items"))
def clean_title(spark, sf):
    return items(spark, sf).select("item_id", T.clean_title(c("title")).alias("title"))


@query("st11_item_text", with_items(f"SELECT item_id, md5({TEXT}) AS a, md5(search) AS b, md5(lower(concat_ws(' ', title, content, author, array_to_string(tags, ' '), url))) AS c FROM searched", RELEVANT.split(", flat AS MATERIALIZED")[0]))
def texts(spark, sf):
    return items(spark, sf).select("item_id", F.md5(item_text()).alias("a"), F.md5(T.search_text(c("source"), c("title"), c("content"), c("tags"), c("author"), c("extra"))).alias("b"),
                                   F.md5(T.eval_text(c("title"), c("content"), c("author"), c("tags"), c("url"))).alias("c"))


TOKENS = words(TEXT, L["stopwords"])


@query("st12_tokens", with_items(f"SELECT item_id, len(t) AS n, md5(array_to_string(list_sort(t), ' ')) AS h FROM (SELECT item_id, {TOKENS} AS t FROM items)"))
def tokens(spark, sf):
    t = items(spark, sf).select("item_id", T.tokens(item_text(), L["stopwords"]).alias("t"))
    return t.select("item_id", F.size("t").alias("n"), F.md5(F.array_join(F.array_sort("t"), " ")).alias("h"))


ENT = f"""list_distinct(list_filter(toks, lambda q: list_contains({s(L['known_actors'])}, q)) || regexp_extract_all(txt, '@([a-zA-Z0-9_]{{2,}})', 1) || CASE WHEN list_contains({s(L['known_actors'])}, split_part({host('url')}, '.', 1)) THEN [split_part({host('url')}, '.', 1)] ELSE [] END
    || CASE WHEN arxiv_id IS NOT NULL THEN [lower(arxiv_id)] ELSE [] END || CASE WHEN release_id <> '' THEN string_split(release_id, ':') ELSE [] END)"""


@query("st13_entities", with_items(f"SELECT item_id, array_to_string(list_sort({ENT}), '|') AS entities FROM (SELECT *, {TEXT} AS txt, {TOKENS} AS toks FROM releases)", release_sql()))
def entities(spark, sf):
    rows = items(spark, sf).withColumns({"text": item_text(), "release_id": I.release_identity(c("title"), c("url"), c("content"), L)})
    rows = rows.withColumn("tokens", T.tokens(c("text"), L["stopwords"]))
    return rows.select("item_id", F.array_join(F.array_sort(I.entities(c("text"), c("tokens"), c("url"), c("arxiv_id"), c("release_id"), L)), "|").alias("entities"))


PAIR = "pairs AS (SELECT a.item_id, {a} AS ta, {b} AS tb FROM items a JOIN items b ON b.item_id = a.item_id + 1)"
TITLE_TOKENS = lambda t: words(f"{t}.title", L["stopwords"])


def next_titles(spark, sf):
    i = items(spark, sf)
    return i.select("item_id", c("title").alias("a")).join(i.select((c("item_id") - 1).alias("item_id"), c("title").alias("b")), "item_id")


@query("st14_jaccard", with_items("SELECT item_id, CASE WHEN len(ta) = 0 OR len(tb) = 0 THEN 0.0::DOUBLE ELSE len(list_intersect(ta, tb)) / CAST(len(list_distinct(ta || tb)) AS DOUBLE) END AS jaccard FROM pairs", PAIR.format(a=TITLE_TOKENS("a"), b=TITLE_TOKENS("b"))))
def jaccard(spark, sf):
    return next_titles(spark, sf).select("item_id", T.jaccard(T.tokens(c("a"), L["stopwords"]), T.tokens(c("b"), L["stopwords"])).alias("jaccard"))


@query("st15_title_similarity")
def title_similarity(spark, sf):
    return next_titles(spark, sf).select("item_id", symmetric_ratio(F.lower("a"), F.lower("b")).alias("ratio"))


@query("st16_compact_contains", with_items(r"SELECT item_id, contains(lower(title), 'self-improvement') OR contains(regexp_replace(lower(title), '[\s_\-:：/·.''\"“”‘’「」]+', '', 'g'), 'selfimprovement') AS hit FROM items"))
def compact_contains(spark, sf):
    return items(spark, sf).select("item_id", (T.phrase_hits(F.lower("title"), T.compact(c("title")), ["self-improvement"]) > 0).alias("hit"))


GROUPS = ["industrial_practice", "correction", "event_cloud", "event_capital", "hard_evidence", "community_practice"]


@query("st18_term_hits", with_items("SELECT item_id, " + ", ".join(f"{hits('txt', L[g])} AS {g}" for g in GROUPS) + f" FROM (SELECT item_id, {TEXT} AS txt FROM items)"))
def term_hits(spark, sf):
    rows = items(spark, sf).select("item_id", item_text().alias("text"))
    return rows.select("item_id", *[substring_hits(c("text"), L[g]).alias(g) for g in GROUPS])


@query("sr01_lexicon_hits", with_items("SELECT item_id, " + ", ".join(f"{common('toks', L[g])} AS {g}" for g in ("technical", "product", "novelty")) + f", {hits('txt', ['the ', 'and ', 'que', 'der', 're of'])} AS plain FROM (SELECT item_id, {TOKENS} AS toks, {TEXT} AS txt FROM items)"))
def lexicon_hits(spark, sf):
    rows = items(spark, sf).select("item_id", item_text().alias("text")).withColumn("tokens", T.tokens(c("text"), L["stopwords"]))
    return rows.select("item_id", *[token_hits(c("tokens"), L[g]).alias(g) for g in ("technical", "product", "novelty")], substring_hits(c("text"), ["the ", "and ", "que", "der", "re of"]).alias("plain"))


@query("st19_score_terms", with_items(f"SELECT item_id, least(10::DOUBLE, 1.5::DOUBLE + 1.6::DOUBLE * {common('toks', L['product'])}) AS score FROM (SELECT item_id, {TOKENS} AS toks FROM items)"))
def score_terms(spark, sf):
    rows = items(spark, sf).select("item_id", T.tokens(item_text(), L["stopwords"]).alias("t"))
    return rows.select("item_id", F.least(F.lit(10.0), F.lit(1.5) + F.lit(1.6) * token_hits(c("t"), L["product"])).alias("score"))


REPO = f"CASE WHEN source = 'github' AND {host('url')} = 'github.com' AND len({parts('url')}) >= 2 THEN lower({parts('url')}[1] || '/' || {parts('url')}[2]) ELSE '' END"


@query("st21_repo_identity", with_items(f"SELECT item_id, {REPO} AS repo, {REPO} <> '' AND len({parts('url')}) = 2 AND NOT contains(lower(title), '[release]') AND NOT contains(url, '/releases/') AS homepage FROM items"))
def repo(spark, sf):
    return items(spark, sf).select("item_id", U.repo_identity(c("source"), c("url")).alias("repo"), U.is_repo_homepage(c("source"), c("title"), c("url")).alias("homepage"))


@query("st22_slug_and_version_norm", with_items("SELECT item_id, trim(regexp_replace(lower(title), '[^a-z0-9]+', '_', 'g'), '_') AS a, trim(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '-') AS b FROM items"))
def slugs(spark, sf):
    return items(spark, sf).select("item_id", T.slug(c("title")).alias("a"), T.slug(c("title"), "-").alias("b"))


@query("st23_trim_text", r"SELECT doc_id, substr(sq, 1, 160) AS cut, CASE WHEN length(sq) > 120 THEN rtrim(substr(sq, 1, 119)) || '…' ELSE sq END AS short FROM (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS sq FROM documents)")
def trim_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.trim_text(c("text"), 160).alias("cut"), T.compact_inline(c("text"), 120).alias("short"))


NORM = r"lower(trim(regexp_replace(regexp_replace(substr(trim(regexp_replace(text, '\s+', ' ', 'g')), 1, 200), 'https?://\S+', '', 'g'), '[`*_>#]', '', 'g')))"


@query("st24_normalise_title", f"SELECT doc_id, {NORM} AS norm FROM documents")
def normalise_title(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.normalise_title(c("text")).alias("norm"))


def keywords_sql(text):
    stop = s([*L["keyword_stop_latin"], *L["keyword_generic"]])
    return (f"list_filter(regexp_extract_all({text}, '([A-Za-z][A-Za-z0-9.+-]{{2,}}|[一-鿿]{{2,}})', 1), lambda w: NOT (list_contains({stop}, lower(w)) OR list_contains({s(L['keyword_stop_cjk'])}, w)"
            r" OR starts_with(lower(w), 'http') OR starts_with(lower(w), 'www') OR contains(w, '.') OR regexp_full_match(w, '[A-Za-z]\d+')))")


@query("st25_keywordize", f"SELECT doc_id, len(k) AS n, md5(array_to_string(k, ' ')) AS h FROM (SELECT doc_id, {keywords_sql('text')} AS k FROM documents)")
def keywordize(spark, sf):
    k = table(spark, sf, "documents").select("doc_id", T.keywords(c("text"), L).alias("k"))
    return k.select("doc_id", F.size("k").alias("n"), F.md5(F.array_join("k", " ")).alias("h"))


def entity_sql(text):
    known = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(lower(p), '{a}') THEN '{n}' END" for a, n in T.ENTITY_ALIASES) + "], lambda q: q IS NOT NULL)"
    stop = s([*L["keyword_stop_latin"], *L["keyword_generic"]])
    found = f"list_filter(list_transform(regexp_extract_all(p, '{T.PHRASE_PATTERN}', 1), lambda q: trim(regexp_replace(q, '\\s+', ' ', 'g'), ' -')), lambda q: length(q) >= 3 AND NOT (list_contains({stop}, lower(q)) OR list_contains({s(L['entity_stop'])}, q) OR starts_with(lower(q), 'http') OR starts_with(lower(q), 'www') OR starts_with(lower(q), 't.co')))"
    return f"(SELECT item_id, list_filter(e, lambda q, i: list_position(list_transform(e, lambda z: lower(z)), lower(q)) = i) AS names FROM (SELECT item_id, {known} || {found} AS e FROM (SELECT item_id, replace(replace({text}, '–', '-'), '—', '-') AS p FROM items)))"


@query("st26_extract_entities", with_items(f"SELECT item_id, array_to_string(names, '|') AS names FROM {entity_sql('title')}"))
def entity_names(spark, sf):
    return items(spark, sf).select("item_id", F.array_join(T.entity_names(c("title"), L), "|").alias("names"))


@query("st27_heat_score", "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN n_chars * 10000.0::DOUBLE WHEN 1 THEN CAST(n_chars AS DOUBLE) WHEN 2 THEN 0.0 ELSE (n_chars + 0.5) * 10000::DOUBLE END AS heat FROM documents")
def heat(spark, sf):
    n = c("n_chars").cast("string")
    detail = F.when(c("doc_id") % 4 == 0, F.concat(n, F.lit(" 万热度"))).when(c("doc_id") % 4 == 1, F.concat(n, F.lit(" 热度"))).when(c("doc_id") % 4 == 2, F.concat(n, F.lit(" views"))).otherwise(F.concat(n, F.lit(".5万 热度")))
    return table(spark, sf, "documents").select("doc_id", T.heat_score(detail).alias("heat"))


@query("st28_duration_seconds", "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN n_chars WHEN 1 THEN (doc_id % 5) * 3600 + (doc_id % 60) * 60 + 7 WHEN 2 THEN (doc_id % 90) * 60 + 30 ELSE 0 END AS seconds FROM documents")
def duration(spark, sf):
    n = lambda k: (c("doc_id") % k).cast("string")
    d = F.when(c("doc_id") % 4 == 0, c("n_chars").cast("string")).when(c("doc_id") % 4 == 1, F.concat_ws(":", n(5), n(60), F.lit("07"))).when(c("doc_id") % 4 == 2, F.concat_ws(":", n(90), F.lit("30"))).otherwise("a:b")
    return table(spark, sf, "documents").select("doc_id", T.duration_seconds(d).alias("seconds"))


@query("st29_uploads_playlist_and_video_id", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'UU' || c_name ELSE c_name END AS playlist, lpad(CAST(c_custkey AS VARCHAR), 11, 'z') AS video FROM customer")
def video_ids(spark, sf):
    x = table(spark, sf, "customer")
    return x.select("c_custkey", U.uploads_playlist(F.when(c("c_custkey") % 2 == 0, F.concat(F.lit("UC"), "c_name")).otherwise(c("c_name"))).alias("playlist"),
                    U.video_id(F.concat(F.lit("https://youtu.be/"), F.lpad(c("c_custkey").cast("string"), 11, "z"))).alias("video"))


@query("st30_normalise_url", "SELECT page_id, rtrim(url || CASE WHEN page_id % 3 = 0 THEN '//' ELSE '' END, '/') AS url FROM pages")
def normalise_url(spark, sf):
    return table(spark, sf, "pages").select("page_id", U.normalise_url(F.concat("url", F.when(c("page_id") % 3 == 0, "//").otherwise(""))).alias("url"))


@query("st31_extract_urls", "SELECT page_id, url || '|https://b.example/' || page_id AS urls FROM pages")
def urls(spark, sf):
    text = F.concat(F.lit("see "), "url", F.lit("), and https://b.example/"), c("page_id").cast("string"), F.lit("。 again （"), "url", F.lit("）"))
    return table(spark, sf, "pages").select("page_id", F.array_join(T.all_urls(text), "|").alias("urls"))


@query("st32_clean_case_title", "SELECT page_id, 'Case ' || page_id || ' of the day' AS title FROM pages")
def case_title(spark, sf):
    raw = F.concat(F.lit("- **[Case "), c("page_id").cast("string"), F.lit(" of the day]("), F.lit("https://a.example/x"), F.lit(")** （来源）"))
    return table(spark, sf, "pages").select("page_id", T.clean_case_title(raw).alias("title"))


@query("st35_display_title_and_links", with_items(r"""SELECT item_id, shown, CASE WHEN url = '' THEN shown ELSE '[' || shown || '](' || url || ')' END AS link FROM
    (SELECT item_id, url, trim(regexp_replace(replace(replace(trim(regexp_replace(title, 'https?://\S+', '', 'g')), '[', ''), ']', ''), '\s+', ' ', 'g')) AS shown FROM items)"""))
def display_title(spark, sf):
    return items(spark, sf).select("item_id", M.display_title(c("title")).alias("shown"), M.item_link(c("title"), c("url")).alias("link"))


@query("st40_safe_numbers", with_items("SELECT item_id, CAST(x_stars AS DOUBLE) AS stars, CAST(x_likes AS DOUBLE) AS likes, 0.0::DOUBLE AS none, coalesce(try_cast(split_part(title, ' ', 2) AS DOUBLE), 0) AS word FROM items"))
def numbers(spark, sf):
    return items(spark, sf).select("item_id", T.extra_number(c("extra"), ["github_stars", "stars"]).alias("stars"), T.extra_number(c("extra"), ["likes", "stars"]).alias("likes"),
                                   T.extra_number(c("extra"), ["note"]).alias("none"), T.number_or_zero(F.split_part("title", F.lit(" "), F.lit(2))).alias("word"))


@query("st41_usage_normalise", "SELECT conv_id, turn, length(text) AS input_tokens, turn * 3 AS cached_input_tokens, 0 AS cache_write_tokens, turn AS output_tokens, CASE WHEN turn % 2 = 0 THEN length(text) + turn * 4 ELSE 7 END AS total_tokens FROM conversations")
def usage_normalise(spark, sf):
    raw = table(spark, sf, "conversations").withColumn("u", F.parse_json(F.to_json(F.struct(
        F.length("text").alias("input"), (c("turn") * 3).alias("cacheRead"), c("turn").alias("completion_tokens"), F.when(c("turn") % 2 == 1, 7).alias("totalTokens")))))
    return raw.select("conv_id", "turn", *[v.alias(k) for k, v in G.normalised_usage(c("u"), True).items()])


@query("st42_epoch_or_iso_to_ms", "SELECT event_id, epoch_us(ts) // 1000 AS a, epoch_us(ts) // 1000000 * 1000 AS b FROM events")
def epoch(spark, sf):
    ts = c("ts").cast("timestamp")
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return table(spark, sf, "events").select("event_id", T.epoch_or_iso_ms(iso).alias("a"), T.epoch_or_iso_ms(F.unix_seconds(ts)).alias("b"))


@query("st43_metric_format", "SELECT o_orderkey, printf('%,d', CAST(round_even(v, 0) AS BIGINT)) AS shown FROM (SELECT o_orderkey, CAST(o_orderkey + 100 AS DOUBLE) AS v FROM orders)")
def metric(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", T.metric_text((c("o_orderkey") + 100).cast("double")).alias("shown"))


@query("st43_ranking_summary", "SELECT o_orderkey, '基础热度主要来自评分 ' || printf('%,d', o_orderkey + 100) || '；另有榜单名次加分 +5；并由 完读率修正 +0.100 带来约 1.250x 的轻微修正。' AS summary FROM orders")
def ranking_summary(spark, sf):
    factors = F.create_map(F.lit("rank_bonus"), F.lit(5.0), F.lit("finished"), F.lit(0.1))
    return table(spark, sf, "orders").select("o_orderkey", P.ranking_summary(F.lit("rating"), (c("o_orderkey") + 100).cast("double"), F.lit(1.25), factors).alias("summary"))


@query("st45_event_date_label", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'spring' WHEN 1 THEN '2026-01-01–2026-01-0' || (2 + p_partkey % 5) WHEN 2 THEN '2026-01-01' ELSE '时间待公布' END AS label, '关注点：' || p_brand || '；' || p_type AS focus FROM part")
def date_label(spark, sf):
    k = c("p_partkey") % 4
    return table(spark, sf, "part").select("p_partkey", C.date_label(F.when(k == 0, "spring"), F.when(k.isin(1, 2), "2026-01-01"), F.when(k == 1, F.concat(F.lit("2026-01-0"), (c("p_partkey") % 5 + 2).cast("string")))).alias("label"),
                                           C.focus_text(F.array(c("p_brand"), F.lit(" ")), c("p_type")).alias("focus"))


@query("st46_item_markdown", with_items("""SELECT item_id, array_to_string(list_filter(['**' || title || '**', CASE WHEN author <> '' THEN 'by ' || author END, CASE WHEN url <> '' THEN '[link](' || url || ')' END,
    CASE WHEN score > 0 THEN '(' || CAST(round_even(score, 0) AS BIGINT) || ' pts)' END], lambda q: q IS NOT NULL), ' | ') AS line FROM items"""))
def item_markdown(spark, sf):
    return items(spark, sf).select("item_id", M.item_line(c("title"), c("author"), c("url"), c("score")).alias("line"))


@query("st47_item_payload", with_items("SELECT item_id, substr(content, 1, 300) AS content, nullif(author, '') AS author, strftime(published_at, '%Y-%m-%dT%H:%M:%SZ') AS published_at, source, url FROM items"))
def payload(spark, sf):
    p = items(spark, sf).select("item_id", P.item_payload(F.lit(1.0)).alias("p"))
    return p.select("item_id", "p.content", "p.author", "p.published_at", "p.source", "p.url")
