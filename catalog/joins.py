"""Join queries."""

from pyspark.sql import functions as F

from briefwright.functions import text as T, urls as U
from briefwright.operators import joins as J, registry as R, relevance as V
from briefwright.operators.similarity import similar_titles
from briefwright.operators.usage import PRICE_FIELDS, with_cost
from catalog.base import host, items, query, s, table, with_items
from catalog.filters import url_status

REG = R.Registry()
HASH = "sha256(CASE WHEN url <> '' THEN url ELSE source || ':' || title END)"


@query("jn01_seen_anti_join", with_items(f"""SELECT item_id FROM hashed WHERE content_hash NOT IN (SELECT content_hash FROM hashed WHERE item_id % 4 = 0)
    AND (arxiv_id IS NULL OR arxiv_id NOT IN (SELECT arxiv_id FROM hashed WHERE item_id % 4 = 0 AND arxiv_id IS NOT NULL))""", f"hashed AS (SELECT *, {HASH} AS content_hash FROM items)"))
def seen(spark, sf):
    rows = J.with_hash(items(spark, sf))
    return J.unseen(rows, rows.where("item_id % 4 = 0").select("content_hash", "arxiv_id")).select("item_id")


@query("st01_content_hash", with_items(f"SELECT item_id, {HASH} AS content_hash FROM items"))
def content_hash(spark, sf):
    return J.with_hash(items(spark, sf)).select("item_id", "content_hash")


VIDEOS = "vids AS (SELECT page_id, 'https://www.youtube.com/watch?v=' || lpad(CAST(page_id % 120 AS VARCHAR), 11, 'v') AS url, CAST(page_id AS DOUBLE) AS score FROM pages)"


def videos(spark, sf):
    vid = F.lpad((F.col("page_id") % 120).cast("string"), 11, "v")
    return table(spark, sf, "pages").select("page_id", F.concat(F.lit("https://www.youtube.com/watch?v="), vid).alias("url"), F.col("page_id").cast("double").alias("score"))


@query("jn02_stats_left_join", f"""WITH {VIDEOS}, stats AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 11, 'v') AS video_id, c_custkey * 3 AS v, c_custkey % 7 AS l, c_nationkey AS c FROM customer)
    SELECT page_id, CASE WHEN v IS NULL THEN score ELSE (l + c) / CAST(greatest(v, 1) AS DOUBLE) * 1e6 END AS score FROM vids LEFT JOIN stats ON regexp_extract(url, 'v=([a-zA-Z0-9_-]{{11}})', 1) = video_id""")
def stats_join(spark, sf):
    c = table(spark, sf, "customer")
    stats = c.select(F.lpad(F.col("c_custkey").cast("string"), 11, "v").alias("video_id"), (F.col("c_custkey") * 3).alias("viewCount"),
                     (F.col("c_custkey") % 7).alias("likeCount"), F.col("c_nationkey").alias("commentCount"))
    return J.with_video_stats(videos(spark, sf), stats).select("page_id", "score")


def weight_sql(source, url):
    cand = candidates_sql(source, url)
    pairs = "MAP {" + ", ".join(f"'{k}': {w}::DOUBLE" for k, w in R.WEIGHTS.items()) + "}"
    return f"coalesce(list_extract(list_filter(list_transform({cand}, lambda c: {pairs}[c]), lambda w: w IS NOT NULL), 1), 0.6::DOUBLE)"


def candidates_sql(source, url):
    h = host(url)
    tail = f"array_to_string(list_slice(string_split({h}, '.'), -2, -1), '.')"
    own = f"[lower(trim({source})), replace(lower(trim({source})), '_', ' '), replace(lower(trim({source})), ' ', '_')]"
    return f"(CASE WHEN coalesce({source}, '') <> '' THEN {own} ELSE [] END || CASE WHEN {h} <> '' THEN [{h}] || CASE WHEN contains({h}, '.') THEN [{tail}] ELSE [] END ELSE [] END)"


def tier_sql(source, url):
    cand = candidates_sql(source, url)
    return "CASE " + " ".join(f"WHEN len(list_intersect({cand}, {s([*R.TIER_SOURCES[t], *R.TIER_HOSTS[t]])})) > 0 THEN '{t}'" for t in R.TIERS) + " ELSE 'T3' END"


@query("jn03_source_weight_lookup", with_items(f"SELECT item_id, {weight_sql('source', 'url')} AS weight FROM items"))
def weights(spark, sf):
    return items(spark, sf).select("item_id", REG.weight(F.col("source"), F.col("url")).alias("weight"))


@query("jn04_source_tier_lookup", with_items(f"SELECT item_id, tier, MAP {{'T1': 1.12::DOUBLE, 'T1.5': 1.06::DOUBLE, 'T2': 1.0::DOUBLE, 'T3': 0.9::DOUBLE}}[tier] AS tier_weight FROM (SELECT item_id, {tier_sql('source', 'url')} AS tier FROM items)"))
def tiers(spark, sf):
    rows = items(spark, sf).select("item_id", REG.tier(F.col("source"), F.col("url")).alias("tier"))
    return rows.withColumn("tier_weight", REG.tier_weight(F.col("tier")))


@query("jn05_title_similarity_join")
def title_pairs(spark, sf):
    return similar_titles(items(spark, sf))


@query("jn08_url_status_join", """SELECT d.doc_id, u.url IS NOT NULL AND coalesce(bool_or(s BETWEEN 200 AND 399 OR s IN (401, 403, 429)), false) AS is_open FROM documents d
    LEFT JOIN (SELECT page_id, url, [200, 301, 404, 403, 500, 429, 204, 401, 410][page_id % 9 + 1] AS s FROM pages) u ON u.page_id = d.doc_id % (SELECT count(*) FROM pages) GROUP BY d.doc_id, u.url""")
def status_join(spark, sf):
    status = url_status(spark, sf)
    docs = table(spark, sf, "documents").select("doc_id", (F.col("doc_id") % table(spark, sf, "pages").count()).alias("page_id")).join(status.select("page_id", "url"), "page_id", "left")
    marked = J.with_link_status(docs.withColumn("url", F.coalesce("url", F.lit("http://unknown.example/"))), status.select("url", "status"))
    return marked.select("doc_id", "is_open")


@query("fl19_link_health_filter", """WITH u AS (SELECT page_id, url, [200, 301, 404, 403, 500, 429, 204, 401, 410][page_id % 9 + 1] AS s FROM pages),
    d AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN '' ELSE coalesce(url, 'http://unknown.example/') END AS url, s FROM documents LEFT JOIN u ON page_id = doc_id % (SELECT count(*) FROM pages))
    SELECT doc_id FROM d WHERE url = '' OR s BETWEEN 200 AND 399 OR s IN (401, 403, 429)""")
def health(spark, sf):
    status = url_status(spark, sf)
    docs = table(spark, sf, "documents").select("doc_id", (F.col("doc_id") % table(spark, sf, "pages").count()).alias("page_id")).join(status.select("page_id", "url"), "page_id", "left")
    docs = docs.withColumn("url", F.when(F.col("doc_id") % 5 == 0, "").otherwise(F.coalesce("url", F.lit("http://unknown.example/"))))
    kept, _ = J.open_links(docs, status.select("url", "status"))
    return kept.select("doc_id")


@query("jn07_nearest_position_join", """WITH t AS (SELECT doc_id, instr(text, ' the ') AS pos FROM documents WHERE contains(text, ' the ')), v AS (
      SELECT doc_id, instr(text, w) AS vpos, w AS value FROM documents, (SELECT unnest([' and ', ' for ', ' is ', ' que ']) AS w) WHERE contains(text, w))
    SELECT t.doc_id, t.pos, arg_min(value, abs(t.pos - vpos) * 100000 + vpos) FILTER (WHERE abs(t.pos - vpos) <= 40) AS value FROM t LEFT JOIN v ON t.doc_id = v.doc_id GROUP BY t.doc_id, t.pos""")
def nearest(spark, sf):
    d = table(spark, sf, "documents")
    targets = d.where(F.col("text").contains(" the ")).select("doc_id", F.instr("text", " the ").cast("bigint").alias("pos"))
    spots = F.array(*[F.struct(F.instr("text", w).cast("bigint").alias("pos"), F.lit(w).alias("value")) for w in (" and ", " for ", " is ", " que ")])
    values = d.select("doc_id", F.explode(spots).alias("v")).select("doc_id", "v.*").where("pos > 0")
    return J.nearest_position(targets, values, "doc_id", 40)


@query("jn09_coverage_anti_join")
def coverage(spark, sf):
    d = table(spark, sf, "documents")
    # copies of a document are reports of one another's rows
    reports = d.select(F.col("doc_id").alias("report_id"), F.col("text").alias("markdown"))
    rows = d.select((F.col("doc_id") - F.col("doc_id") % 2).alias("report_id"), (F.col("doc_id") % 7 + 1).alias("priority"), F.lit(1).alias("category_rank"),
                    F.col("source").alias("category"), F.lit("").alias("event_id"), F.substring("text", 1, 60).alias("title"), F.lit("").alias("url"), "source")
    return J.missing_coverage(reports, rows, 4).select("report_id", "priority", "ledger_key")


PRICES = "prices AS (SELECT 'm' || p_partkey % 12 AS model, max(p_size) AS input, max(p_size) * 3 AS output, max(CASE WHEN p_partkey % 2 = 0 THEN p_size / 2.0 ELSE 0 END) AS cache_read FROM part GROUP BY 1)"


def price_table(spark, sf):
    p = table(spark, sf, "part")
    return p.groupBy(F.concat(F.lit("m"), F.col("p_partkey") % 12).alias("model")).agg(
        F.max("p_size").cast("double").alias("input"), (F.max("p_size") * 3).cast("double").alias("output"),
        F.max(F.expr("case when p_partkey % 2 = 0 then p_size / 2.0D else 0D end")).alias("cacheRead"), F.lit(0.0).alias("cacheWrite"))


@query("jn10_price_join", f"""WITH {PRICES}, u AS (SELECT conv_id, turn, 'm' || (conv_id % 15) AS model, length(text) AS i, least(length(text), conv_id % 400) AS c, turn * 10 AS o FROM conversations)
    SELECT conv_id, turn, coalesce(round(((i - c) * input + c * CASE WHEN cache_read > 0 THEN cache_read ELSE input END + o * output) / 1000000, 9), 0) AS cost_usd,
      coalesce(input > 0, false) AS price_known FROM u LEFT JOIN prices USING (model)""")
def price_join(spark, sf):
    u = table(spark, sf, "conversations").select("conv_id", "turn", F.concat(F.lit("m"), F.col("conv_id") % 15).alias("model"), F.length("text").alias("input_tokens"),
                                                 (F.col("conv_id") % 400).alias("cached_input_tokens"), F.lit(0).alias("cache_write_tokens"), (F.col("turn") * 10).alias("output_tokens"))
    return with_cost(u, price_table(spark, sf)).select("conv_id", "turn", F.round("cost_usd", 9).alias("cost_usd"), "price_known")


EDITIONS = "editions AS (SELECT CASE WHEN n_nationkey % 4 = 0 THEN n_name || ' junior' ELSE n_name END AS name, CAST(year(o_orderdate) AS INT) AS year, 'e' || (o_orderkey % 5) AS conf_url FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"


def editions(spark, sf):
    o, c, n = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    return o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).select(
        F.when(F.col("n_nationkey") % 4 == 0, F.concat("n_name", F.lit(" junior"))).otherwise(F.col("n_name")).alias("name"), F.year("o_orderdate").alias("year"))


@query("jn11_edition_join", f"WITH {EDITIONS} SELECT n_name AS name, coalesce(max(year), 2026) AS year FROM nation LEFT JOIN editions ON name = n_name GROUP BY n_name")
def edition_join(spark, sf):
    return J.editions_of(table(spark, sf, "nation").select(F.col("n_name").alias("name")), editions(spark, sf), 2026)


@query("ag23_latest_edition", f"WITH {EDITIONS} SELECT name, max(year) AS year FROM editions GROUP BY name")
def latest_edition(spark, sf):
    return J.latest_editions(editions(spark, sf))


META = "meta AS (SELECT dt AS month, item_id, row_number() OVER (PARTITION BY dt ORDER BY score DESC, pos) - 1 AS pos, title, url, source FROM items QUALIFY row_number() OVER (PARTITION BY dt ORDER BY score DESC, items.pos) <= 6)"


def meta(spark, sf):
    from briefwright.operators.ranking import top_k

    best = top_k(items(spark, sf), ["dt"], [F.col("score").desc(), F.col("pos")], 6)
    cases = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("k"), F.col("pos").alias("p"), "title", "url", "source")))
    return best.groupBy(F.col("dt").alias("month")).agg(F.transform(cases, lambda c: F.struct(c["title"].alias("title"), c["url"].alias("url"), c["source"].alias("source"))).alias("top_cases"))


@query("jn12_cases_of_months", with_items("""SELECT month, title, url FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY CASE WHEN url <> '' THEN url ELSE title END ORDER BY month, pos) AS rn FROM meta)
    WHERE rn = 1 ORDER BY month, pos LIMIT 10)""", META))
def cases_of_months(spark, sf):
    return J.cases_of_months(meta(spark, sf), 10).select("month", "title", "url")


@query("jn13_report_version_compare", """WITH v AS (SELECT doc_id AS month, source, lang, n_chars FROM documents)
    SELECT month, unnest(['focus', 'core']) AS section, unnest([CASE WHEN month % 3 = 0 THEN '（未提取到）' ELSE '- ' || source END, '- ' || lang]) AS old_text,
      unnest(['- ' || n_chars, CASE WHEN month % 2 = 0 THEN '（未提取到）' ELSE 'first' || chr(10) || '- ' || lang END]) AS new_text FROM v""")
def version_compare(spark, sf):
    d = table(spark, sf, "documents").withColumn("month", F.col("doc_id"))
    old = d.select("month", F.concat(F.lit("# x\n## 核心观察\n- "), "lang", F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.concat(F.lit("\n## 值得继续调研\n- "), "source"))).alias("markdown"))
    new = d.select("month", F.concat(F.when(F.col("doc_id") % 2 == 0, "").otherwise(F.concat(F.lit("## 核心观察\nfirst\n- "), "lang")), F.lit("\n## 主题聚焦\n- "), F.col("n_chars").cast("string"), F.lit("\n## z\n")).alias("markdown"))
    return J.compare_versions(old, new, {"core": ["核心观察"], "focus": ["主题聚焦", "值得继续调研"]})


@query("jn14_source_stats_join", with_items("""SELECT source, count(*) AS raw, count(*) FILTER (WHERE score >= 10) AS kept, count(*) FILTER (WHERE score >= 50) AS events, count(*) FILTER (WHERE score >= 150) AS selected,
    round(count(*) FILTER (WHERE score >= 150) / CAST(count(*) AS DOUBLE), 4) AS selected_yield FROM items GROUP BY source"""))
def source_stats(spark, sf):
    i = items(spark, sf)
    return J.source_counts_wide(i, i.where("score >= 10"), i.where("score >= 50"), i.where("score >= 150"))


@query("ag02_source_yield", with_items("SELECT source, round(count(*) FILTER (WHERE score >= 150) / CAST(count(*) AS DOUBLE), 4) AS selected_yield FROM items GROUP BY source"))
def source_yield(spark, sf):
    return source_stats(spark, sf).select("source", "selected_yield")


@query("jn15_published_duplicate_join")
def published(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("report_id"), F.substring_index("text", ".", 1).alias("title"), F.col("text").alias("content"))
    return J.published_duplicates(d.where("report_id % 2 = 1"), d.where("report_id % 2 = 0"))


@query("jn16_source_category_lookup", with_items("SELECT item_id, MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in V.SOURCE_TOPIC.items()) + "}[source] AS category FROM items"))
def source_category(spark, sf):
    return items(spark, sf).select("item_id", V.source_topic(F.col("source")).alias("category"))


@query("jn17_missing_periods", with_items("SELECT month FROM (SELECT strftime(d, '%Y-%m-%d') AS month FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM (SELECT CAST(min(published_at) AS DATE) - 12 AS lo, CAST(max(published_at) AS DATE) + 12 AS hi FROM items))) WHERE month NOT IN (SELECT dt FROM items GROUP BY dt HAVING count(*) % 2 = 0)"))
def missing(spark, sf):
    span = items(spark, sf).agg(F.date_sub(F.min("published_at"), 12).alias("lo"), F.date_add(F.max("published_at"), 12).alias("hi"))
    days = span.select(F.explode(F.expr("sequence(lo, hi)")).alias("d")).select(F.date_format("d", "yyyy-MM-dd").alias("month"))
    got = items(spark, sf).groupBy(F.col("dt").alias("month")).agg(F.when(F.count(F.lit(1)) % 2 == 0, 2).otherwise(1).alias("schema_version"), F.collect_list("title").alias("top_cases"))
    return J.missing_periods(days, got)
