"""Aggregate queries."""

from pyspark.sql import functions as F

from briefwright.functions import urls as U
from briefwright.lexicon import Lexicon
from briefwright.operators import aggregates as A, relevance as V, usage as G
from briefwright.operators.filters import engagement_rate
from catalog.base import any_of, host, items, parts, query, s, table, with_items
from catalog.filters import RELEVANT, REASON, AD_RULES
from catalog.joins import PRICES, price_table, weight_sql

L = Lexicon()


def identity_sql(source="source", url="url"):
    h, p = host(url), parts(url)
    two = f"array_to_string([{h}] || list_slice({p}, 1, 2), '/')"
    return (f"CASE WHEN {h} IN ('github.com', 'gist.github.com', 'huggingface.co') THEN {two} WHEN {h} IN ('x.com', 'twitter.com') THEN array_to_string([{h}] || list_slice({p}, 1, 1), '/')"
            f" WHEN {h} = 'reddit.com' THEN CASE WHEN len({p}) >= 2 AND {p}[1] = 'r' THEN {two} ELSE {h} END WHEN {h} IN ('youtube.com', 'youtu.be') THEN 'youtube.com'"
            f" WHEN {h} IN ('arxiv.org', 'papers.cool', 'alphaxiv.org', 'openreview.net') THEN CASE WHEN len({p}) > 0 THEN {h} || '/' || {p}[-1] ELSE {h} END"
            f" WHEN {h} <> '' THEN {h} ELSE lower(trim({source})) END")


IDENT = f"idents AS (SELECT *, {identity_sql()} AS identity, {weight_sql('source', 'url')} AS w FROM items)"


@query("ag01_source_counts", with_items("SELECT source, count(*) AS n FROM items GROUP BY source"))
def counts(spark, sf):
    return A.source_counts(items(spark, sf))


@query("ag03_source_diversity", with_items("SELECT dt, count(DISTINCT identity) AS diversity FROM idents GROUP BY dt", IDENT))
def diversity(spark, sf):
    return A.source_diversity(items(spark, sf), ["dt"])


EVID = """merged AS (SELECT dt, lower(identity) AS key, max(w) AS weight, count(*) AS count, arg_min(source, pos) AS name, min(pos) AS pos, arg_min(url, pos) AS url, arg_min(identity, pos) AS ident FROM idents GROUP BY dt, lower(identity)),
  capped AS (SELECT * FROM merged QUALIFY row_number() OVER (PARTITION BY dt, lower(name) ORDER BY pos) <= 2), evidence AS (SELECT * FROM capped QUALIFY row_number() OVER (PARTITION BY dt ORDER BY weight DESC, lower(name), pos) <= 6)"""


@query("ag04_evidence_sources", with_items("SELECT dt, name, url, ident AS identity, weight, count FROM evidence", IDENT, EVID))
def evidence(spark, sf):
    return A.evidence_sources(items(spark, sf), ["dt"], 6, True, 2).select("dt", "name", "url", "identity", "weight", "count")


@query("ag05_evidence_score_label", with_items("""SELECT dt, count(*) AS sources, count(DISTINCT ident) AS bodies, CAST(round(sum(CAST(weight AS DECIMAL(18, 4))), 2) AS DOUBLE) AS evidence_score,
    printf('%d 源 / %d 主体 / 权重 %.1f', count(*), count(DISTINCT ident), CAST(round(sum(CAST(weight AS DECIMAL(18, 4))), 2) AS DOUBLE)) AS label FROM evidence GROUP BY dt""", IDENT, EVID))
def evidence_label(spark, sf):
    return A.evidence_summary(A.evidence_sources(items(spark, sf), ["dt"], 6, True, 2), ["dt"])


@query("ag06_review_rating_avg", """SELECT conv_id, avg(r) AS avg_rating, count(r) AS num_reviews, array_to_string(list(r ORDER BY turn) FILTER (WHERE r IS NOT NULL), ',') AS ratings
    FROM (SELECT conv_id, turn, CASE WHEN role = 'assistant' AND length(text) % 4 <> 3 THEN length(text) % 10 + 1 END AS r FROM conversations) GROUP BY conv_id HAVING count(r) > 0""")
def review(spark, sf):
    c = table(spark, sf, "conversations")
    n = (F.length("text") % 10 + 1).cast("string")
    rating = F.when(F.length("text") % 4 == 0, n).when(F.length("text") % 4 == 1, F.concat(F.lit('"'), n, F.lit(': fine"'))).when(
        F.length("text") % 4 == 2, F.concat(F.lit('{"value":"'), n, F.lit(': ok"}'))).otherwise("null")
    invite = F.when(F.col("role") == "assistant", F.when(F.col("turn") % 3 == 0, F.lit('"invitation":"x/-/Official_Review"')).otherwise('"invitations":["a","y/-/Official_Review"]')).otherwise('"invitation":"x/-/Comment"')
    reply = F.parse_json(F.concat(F.lit("{"), invite, F.lit(',"content":{"rating":'), rating, F.lit("}}")))
    packed = c.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", F.to_json(reply).alias("j")))), lambda x: F.parse_json(x["j"])).alias("replies"))
    out = A.review_ratings(packed, ["conv_id"]).where("num_reviews > 0")
    return out.select("conv_id", "avg_rating", "num_reviews", F.array_join(F.transform("ratings", lambda r: r.cast("string")), ",").alias("ratings"))


@query("ag07_engagement_rate", with_items("SELECT item_id, (x_vlikes + x_comments) / CAST(greatest(x_views, 1) AS DOUBLE) AS rate FROM items"))
def engagement(spark, sf):
    return items(spark, sf).select("item_id", engagement_rate(F.col("extra"), F.col("score")).alias("rate"))


USAGE = PRICES + """, u AS (SELECT conv_id, turn, 'm' || (conv_id % 15) AS model, role AS source, length(text) AS i, least(length(text), conv_id % 400) AS c, turn AS w, turn * 10 AS o FROM conversations),
  e AS (SELECT u.*, i + o AS t, coalesce((greatest(i - least(c, i), 0) * input + least(c, i) * CASE WHEN cache_read > 0 THEN cache_read ELSE input END + w * input + o * output) / 1000000.0::DOUBLE, 0) AS cost,
    coalesce(input > 0, false) AS known FROM u LEFT JOIN prices USING (model))"""


def _entries(spark, sf):
    u = table(spark, sf, "conversations")
    raw = u.select(F.concat(F.lit("m"), F.col("conv_id") % 15).alias("model"), "role", F.parse_json(F.to_json(F.struct(
        F.length("text").alias("prompt_tokens"), F.least(F.length("text").cast("bigint"), F.col("conv_id") % 400).alias("cacheRead"), F.col("turn").alias("cache_write"), (F.col("turn") * 10).alias("output")))).alias("usage"))
    entries = raw.withColumns(G.normalised_usage(F.col("usage"))).withColumns({"kind": F.lit("task_model"), "source": F.col("role")})
    return G.with_cost(entries, price_table(spark, sf))


@query("ag08_usage_rollup", f"""WITH {USAGE}, x AS (SELECT model, source, i, c, w, o, t, cost, known FROM e)
    SELECT CASE WHEN grouping(model) = 0 THEN 'model' WHEN grouping(source) = 0 THEN 'source' ELSE 'total' END AS level, coalesce(model, source, 'total') AS name, count(*) AS calls,
      CAST(sum(i) AS BIGINT) AS input_tokens, CAST(sum(c) AS BIGINT) AS cached_input_tokens, CAST(sum(w) AS BIGINT) AS cache_write_tokens, CAST(sum(o) AS BIGINT) AS output_tokens, CAST(sum(t) AS BIGINT) AS total_tokens, round(sum(cost), 8) AS cost_usd, bool_or(known) AS price_known
    FROM x GROUP BY GROUPING SETS ((model), (source), ())""")
def rollup(spark, sf):
    return G.usage_rollup(_entries(spark, sf))


@query("ag09_usage_summary", f"""WITH {USAGE}, f AS (SELECT * FROM e WHERE i % 2 = 0)
    SELECT CASE WHEN grouping(model) = 0 THEN 'model' WHEN grouping(source) = 0 THEN 'source' ELSE 'total' END AS level, coalesce(model, source, 'total') AS name, count(*) AS calls,
      CAST(sum(t) AS BIGINT) AS total_tokens, round(sum(cost), 8) AS cost_usd, bool_or(known) AS price_known, 0 AS empty FROM f GROUP BY GROUPING SETS ((model), (source), ())
    UNION ALL SELECT 'total', 'total', 0, 0, 0, false, 1""")
def summary(spark, sf):
    """Tasks of even input, and a second summary without any task."""
    entries = _entries(spark, sf)
    shown = lambda df, n: df.select("level", "name", "calls", "total_tokens", "cost_usd", "price_known", F.lit(n).alias("empty"))
    return shown(G.usage_summary(entries.where("input_tokens % 2 = 0")), 0).unionByName(shown(G.usage_summary(entries.where("input_tokens < 0")), 1))


FB = "fb AS (SELECT doc_id, 'q' || quality AS label, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE 'r' || toxic END AS rq, CAST(quality * 3 + doc_id % 3 AS DOUBLE) AS rating, ['i' || (doc_id % 4), CASE WHEN doc_id % 2 = 0 THEN '' ELSE 'odd' END] AS issues, 'a' || (doc_id % 5) AS act FROM labels)"


def feedback(spark, sf):
    l = table(spark, sf, "labels")
    act = lambda cond: F.when(cond, F.struct(F.concat(F.lit("a"), F.col("doc_id") % 5).alias("action")))
    return l.select(
        F.lit("d").alias("date"), (F.col("quality") * 3 + F.col("doc_id") % 3).cast("double").alias("rating"), F.concat(F.lit("q"), "quality").alias("label"),
        F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit("r"), "toxic")).alias("report_quality"),
        F.array(F.concat(F.lit("i"), F.col("doc_id") % 4), F.when(F.col("doc_id") % 2 == 0, "").otherwise("odd")).alias("issue_labels"),
        act(F.col("doc_id") % 2 == 0).alias("source_quality"), act(F.col("doc_id") % 3 == 0).alias("event_action"), act(F.col("doc_id") % 3 == 1).alias("sample_action"),
        act(F.col("doc_id") % 7 == 0).alias("item_action"), act(F.lit(False)).alias("topic_action"))


@query("ag10_feedback_summary", f"""WITH {FB}, p AS (SELECT 'label' AS kind, label AS value FROM fb UNION ALL SELECT 'report_quality', rq FROM fb UNION ALL SELECT 'issue', unnest(issues) FROM fb
    UNION ALL SELECT 'source_action', act FROM fb WHERE doc_id % 2 = 0 UNION ALL SELECT 'event_action', act FROM fb WHERE doc_id % 3 < 2 UNION ALL SELECT 'item_action', act FROM fb WHERE doc_id % 7 = 0)
    SELECT kind, value, count(*) AS n FROM p WHERE value IS NOT NULL AND value <> '' GROUP BY kind, value""")
def feedback_counts(spark, sf):
    return A.feedback_summary(feedback(spark, sf))


@query("ag10_feedback_rating", f"WITH {FB} SELECT count(*) AS count, round(avg(rating), 4) AS rating_avg FROM fb")
def feedback_rating(spark, sf):
    return A.feedback_rating(feedback(spark, sf))


EVAL = "lower(concat_ws(' ', title, content, author, array_to_string(tags, ' '), url))"
LABELS = f"""labelled AS MATERIALIZED (SELECT *, list_filter([
    CASE WHEN route = 'investment' AND (source = 'finance' OR list_contains(list_transform(tags, lambda t: lower(t)), 'finance')) THEN CASE WHEN {any_of('etext', ['personal finance', 'portfolio', 'etf'])} THEN 'non_ai_personal_finance'
      WHEN {any_of('etext', L['finance_generic'])} THEN 'non_ai_generic_finance' ELSE 'non_ai_finance' END END,
    CASE WHEN source IN ('x_twitter', 'reddit', 'zhihu', 'jike') AND {any_of('etext', L['social_opinion'])} THEN 'single_social_opinion' END,
    CASE WHEN source = 'hackernews' AND contains(etext, 'show hn') THEN 'single_source_hn_launch' END,
    CASE WHEN source = 'producthunt' AND {any_of('etext', L['product_launch'])} THEN CASE WHEN score < 100 THEN 'producthunt_low_adoption' ELSE 'single_source_product_launch' END END,
    CASE WHEN source IN ('youtube', 'apple_podcast', 'ai_exec_podcast', 'xiaoyuzhou') AND {any_of('etext', L['generic_media'])} THEN CASE WHEN source = 'youtube' THEN 'generic_video_course' ELSE 'generic_podcast_interview' END END],
    lambda q: q IS NOT NULL) AS found FROM (SELECT *, {EVAL} AS etext FROM routed)), audited AS (SELECT *, unnest(CASE WHEN route = 'filtered' AND len(found) = 0 THEN ['low_ai_relevance'] ELSE found END) AS label FROM labelled)"""


@query("sr20_negative_labels", with_items("SELECT item_id, label FROM audited", RELEVANT, LABELS))
def negative(spark, sf):
    rows = V.with_relevance(items(spark, sf), L)
    return rows.select("item_id", F.explode(V.negative_labels(F.col("route"), L)).alias("label"))


@query("ag11_negative_label_audit", with_items("SELECT label, count(*) AS n FROM audited GROUP BY label", RELEVANT, LABELS))
def audit(spark, sf):
    return A.label_audit(V.with_relevance(items(spark, sf), L), L)[0]


@query("ag11_negative_label_examples", with_items("""SELECT label, item_id FROM audited QUALIFY row_number() OVER (PARTITION BY label ORDER BY CASE route WHEN 'kept' THEN 1 WHEN 'investment' THEN 2 ELSE 3 END, pos) <= 5""", RELEVANT, LABELS))
def audit_examples(spark, sf):
    return A.label_audit(V.with_relevance(items(spark, sf), L), L)[1].select("label", F.col("pos").alias("item_id"))


@query("ag13_history_summary", with_items("""SELECT 'count' AS kind, 'raw' AS key, CAST(sum(c) AS DOUBLE) AS value FROM d UNION ALL SELECT 'metric', 'hot', round(sum(hot) / CAST(any_value(days) AS DOUBLE), 4) FROM d, n WHERE hot > 0
    UNION ALL SELECT 'cost', 'cost', CAST(sum(total) AS DOUBLE) FROM d UNION ALL SELECT 'feedback', 'count', CAST(sum(c) AS DOUBLE) FROM d UNION ALL SELECT 'feedback_label', 'good', CAST(sum(hot) AS DOUBLE) FROM d""", "d AS (SELECT dt, count(*) AS c, count(*) FILTER (WHERE score > 100) AS hot, sum(CAST(score AS DECIMAL(18, 2))) AS total FROM items GROUP BY dt), n AS (SELECT count(*) AS days FROM d)"))
def history(spark, sf):
    d = items(spark, sf).groupBy(F.col("dt").alias("date")).agg(F.count(F.lit(1)).alias("c"), F.count_if(F.col("score") > 100).alias("hot"), F.sum(F.col("score").cast("decimal(18,2)")).alias("total"))
    daily = d.select("date", F.create_map(F.lit("raw"), "c").alias("counts"),
                     F.when(F.col("hot") > 0, F.create_map(F.lit("hot"), F.col("hot").cast("double"))).alias("metrics"), F.create_map(F.lit("cost"), F.col("total").cast("double")).alias("cost_time"),
                     F.struct(F.col("c").alias("count"), F.create_map(F.lit("good"), "hot").alias("labels"), F.expr("cast(map() as map<string,bigint>)").alias("issue_labels")).alias("feedback"))
    return A.history_summary(daily)


@query("ag14_merge_count_maps", with_items("SELECT key, CAST(sum(n) AS BIGINT) AS n FROM (SELECT 's:' || source AS key, 1 AS n FROM items UNION ALL SELECT 'l:' || language, 2 FROM items) GROUP BY key"))
def merge_maps(spark, sf):
    rows = items(spark, sf).select(F.create_map(F.concat(F.lit("s:"), "source"), F.lit(1), F.concat(F.lit("l:"), "language"), F.lit(2)).alias("m"))
    return A.merge_count_maps(rows, "m")


@query("ag15_term_source_counts", with_items("SELECT term, CAST(count(*) AS BIGINT) AS occurrences, count(DISTINCT source) AS sources FROM (SELECT source, unnest(tags) AS term FROM items) GROUP BY term"))
def terms(spark, sf):
    return A.term_source_counts(items(spark, sf), "tags")


@query("ag16_platform_statistics", with_items("""SELECT kind, name, n FROM (SELECT 'source' AS kind, source AS name, count(*) AS n FROM items GROUP BY source UNION ALL SELECT 'category', language, count(*) FROM items GROUP BY language)
    QUALIFY row_number() OVER (PARTITION BY kind ORDER BY n DESC, name) <= 12"""))
def platform(spark, sf):
    i = items(spark, sf)
    return A.platform_statistics(i, i.select(F.col("language").alias("category")))


@query("ag17_run_counters", with_items(f"SELECT source, count(*) AS raw_count, count(*) FILTER (WHERE {REASON} IS NULL) AS clean_count, count({REASON}) AS blocked_count FROM items GROUP BY source"))
def run_counters(spark, sf):
    from briefwright.operators.filters import ad_split

    i = items(spark, sf)
    return A.run_counters(i, *ad_split(i, AD_RULES))


@query("ag25_source_health_summary", with_items("""SELECT source, state, text FROM (SELECT source, 'failed' AS state, '  - `' || source || '`：' || CASE WHEN pos % 2 = 0 THEN 'unknown error' ELSE substr(replace(content, chr(10), ' '), 1, 220) END || '；已尝试：已重试一次' AS text, pos FROM items WHERE pos % 3 = 0
    UNION ALL SELECT source, 'recovered', '  - `' || source || '`：retry', pos FROM items WHERE pos % 5 = 0)"""))
def health(spark, sf):
    h = items(spark, sf).select("source", (F.col("pos") % 3 != 0).alias("success"), F.when(F.col("pos") % 5 == 0, "recovered").alias("repair_status"),
                                F.lit(None).cast("array<string>").alias("repair_actions"), F.lit(None).cast("array<string>").alias("repair_notes"), F.when(F.col("pos") % 2 == 1, F.col("content")).alias("error"))
    return A.health_lines(h)


@query("ag26_category_signal_counts", with_items("SELECT dt, category, n FROM (SELECT dt, source AS category, count(*) AS n FROM items GROUP BY dt, source) QUALIFY row_number() OVER (PARTITION BY dt ORDER BY n DESC, category) <= 5"))
def category_signals(spark, sf):
    return A.category_signals(items(spark, sf).withColumn("category", F.col("source")), ["dt"])


@query("ag27_usage_record", f"WITH {USAGE} SELECT model, i AS input_tokens, c AS cached_input_tokens, w AS cache_write_tokens, o AS output_tokens, t AS total_tokens, round(cost, 9) AS cost_usd, known AS price_known FROM e WHERE i > 0 OR c > 0 OR w > 0 OR o > 0")
def usage_record(spark, sf):
    u = table(spark, sf, "conversations")
    raw = u.select(F.concat(F.lit("m"), F.col("conv_id") % 15).alias("model"), F.parse_json(F.to_json(F.struct(
        F.length("text").alias("prompt_tokens"), F.least(F.length("text").cast("bigint"), F.col("conv_id") % 400).alias("cacheRead"), F.col("turn").alias("cache_write"), (F.col("turn") * 10).alias("output")))).alias("usage"))
    return G.usage_records(raw, price_table(spark, sf)).select("model", *G.COUNTS, F.round("cost_usd", 9).alias("cost_usd"), "price_known")
