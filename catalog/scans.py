"""Scan, queue and merge queries. File readers themselves are tested on written files."""

from pyspark.sql import functions as F

from briefwright.operators import registry as R, usage as G
from briefwright.operators.joins import with_hash
from briefwright.plans.periods import compact_months
from briefwright.session import shared_folder
from briefwright.sources import scans as S, sinks as W
from catalog.aggregates import FB
from catalog.base import items, query, s, table, with_items
from catalog.filters import RUNS, runs
from catalog.joins import HASH

FILES = """files AS (SELECT *, 'collected-' || dt || '-' || lpad(CAST((item_id % 3) * 700 AS VARCHAR), 4, '0') || '.json' AS file, (item_id % 3) * 10 + CAST(item_id % 3 = 1 AS INT) * 50 AS modified FROM items)"""


def files(spark, sf):
    part = (F.col("item_id") % 3).cast("int")
    name = F.concat(F.lit("collected-"), "dt", F.lit("-"), F.lpad((part * 700).cast("string"), 4, "0"), F.lit(".json"))
    return items(spark, sf).withColumns({"file": name, "modified": part * 10 + F.when(part == 1, 50).otherwise(0)})


@query("sc01_latest_snapshot_scan", with_items("SELECT dt, file, item_id FROM files QUALIFY file = arg_max(file, modified) OVER (PARTITION BY dt)", FILES))
def latest_snapshot(spark, sf):
    return S.newest_file(files(spark, sf)).select("dt", "file", "item_id")


@query("sc02_snapshot_lookup", with_items("SELECT item_id FROM (SELECT * FROM files WHERE dt = '2024-01-02') QUALIFY file = arg_max(file, modified) OVER ()", FILES))
def lookup(spark, sf):
    return S.newest_file(files(spark, sf).where("dt = '2024-01-02'")).select("item_id")


@query("sc03_date_range_scan", with_items("SELECT item_id FROM files WHERE dt BETWEEN '2024-01-01' AND '2024-01-02' QUALIFY row_number() OVER (PARTITION BY CASE WHEN url <> '' THEN url ELSE source || '::' || title END ORDER BY file, pos) = 1", FILES))
def date_range(spark, sf):
    return S.date_range(files(spark, sf), "2024-01-01", "2024-01-02").select("item_id")


@query("sc04_available_dates", with_items("SELECT DISTINCT CAST(dt AS DATE) AS dt FROM items WHERE CAST(dt AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-02'"))
def available(spark, sf):
    return S.available_dates(items(spark, sf), "2024-01-02", 2)


@query("sc05_health_snapshot_scan", with_items("SELECT dt, source, count(*) AS n FROM (SELECT * FROM files QUALIFY file = arg_max(file, modified) OVER (PARTITION BY dt)) WHERE score < 20 GROUP BY dt, source", FILES))
def health(spark, sf):
    return S.newest_file(files(spark, sf)).where("score < 20").groupBy("dt", "source").agg(F.count(F.lit(1)).alias("n"))


@query("sc06_report_corpus_scan", with_items("SELECT item_id FROM items WHERE item_id % 4 <> 0 AND dt BETWEEN '2024-01-02' AND '2024-01-31'"))
def corpus(spark, sf):
    name = F.when(F.col("item_id") % 4 == 0, F.concat(F.lit("note-"), "dt", F.lit(".md"))).otherwise(F.concat(F.lit("digest-"), "dt", F.lit("-0830.md")))
    rows = items(spark, sf).withColumn("day", F.regexp_extract(name, S.REPORT_NAME, 1))
    return rows.where((F.col("day") != "") & F.col("day").between("2024-01-02", "2024-01-31")).select("item_id")


@query("sc07_feedback_scan", f"WITH {FB} SELECT label, rating, count(*) AS n FROM fb WHERE doc_id % 6 <> 0 GROUP BY label, rating")
def feedback_scan(spark, sf):
    ids = table(spark, sf, "labels").select("doc_id", (F.col("quality") * 3 + F.col("doc_id") % 3).cast("double").alias("rating"), F.concat(F.lit("q"), "quality").alias("label"))
    text = F.to_json(F.struct(F.lit("d").alias("date"), "rating", "label"))
    broken = ids.select(F.when(F.col("doc_id") % 6 == 0, F.concat(F.substring(text, 1, 12), F.lit("…"))).otherwise(text).alias("value"))
    return S.parse_feedback(broken).groupBy("label", "rating").agg(F.count(F.lit(1)).alias("n"))


def session_lines(spark, sf):
    """One log line per conversation: content parts with usage, and a message of its own."""
    part = F.struct(F.lit("text").alias("type"), F.when(F.col("turn") % 2 == 0, "acme").alias("provider"), F.concat(F.lit("m"), F.col("conv_id") % 12).alias("model"),
                    F.when(F.col("role") == "assistant", F.struct(F.length("text").alias("input"), F.col("turn").alias("output"), (F.col("turn") * 2).alias("cacheRead"))).alias("usage"))
    c = table(spark, sf, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", part.alias("p")))), lambda x: x["p"]).alias("content"))
    line = F.to_json(F.struct((F.lit(1700000000) + F.col("conv_id") * 60).alias("timestamp"), F.struct(F.lit("assistant").alias("role"), "content").alias("message")))
    return c.select(F.lit("s.jsonl").alias("file"), F.col("conv_id").alias("line_no"), line.alias("value"))


@query("sc08_usage_log_scan", """SELECT conv_id, CASE WHEN turn % 2 = 0 THEN 'acme/' ELSE '' END || 'm' || (conv_id % 12) AS model, length(text) AS input_tokens, turn AS output_tokens, turn * 2 AS cached_input_tokens, length(text) + turn * 3 AS total_tokens
    FROM conversations WHERE role = 'assistant' AND conv_id <= (SELECT max(conv_id) // 2 FROM conversations) AND length(text) + turn > 0""")
def usage_log(spark, sf):
    half = table(spark, sf, "conversations").agg(F.max("conv_id")).first()[0] // 2  # the first half of the time
    rows = G.session_usage(session_lines(spark, sf), 1700000000000, 1700000000000 + half * 60000)
    return rows.select(F.col("line_no").alias("conv_id"), "model", "input_tokens", "output_tokens", "cached_input_tokens", "total_tokens")


@query("sc09_period_meta_scan", """SELECT doc_id AS month, CASE WHEN doc_id % 2 = 0 THEN 'meta ' || lang ELSE source END AS conclusion, CASE WHEN doc_id % 2 = 0 THEN lang ELSE 'theme ' || source END AS theme FROM documents""")
def period_meta(spark, sf):
    d = table(spark, sf, "documents").withColumn("month", F.col("doc_id"))
    none = F.expr("cast(array() as array<string>)")
    even = F.col("doc_id") % 2 == 0
    meta = d.select("month", F.when(even, F.array(F.concat(F.lit("meta "), "lang"))).otherwise(none).alias("conclusion_bullets"), F.when(even, F.array("lang")).otherwise(none).alias("focus_themes"), none.alias("watch_bullets"))
    reports = d.select("month", F.concat(F.lit("# t\n## 核心观察\ntext\n- "), "source", F.lit("\n- more\n## 主题聚焦\n- theme "), "source", F.lit("\n")).alias("markdown"))
    return compact_months(meta, reports).select("month", F.element_at("conclusion_bullets", 1).alias("conclusion"), F.element_at("focus_themes", 1).alias("theme"))


@query("sc10_source_registry_dim", f"""WITH d AS (SELECT unnest({s(list(R.WEIGHTS))}) AS key, unnest([{', '.join(str(float(v)) + '::DOUBLE' for v in R.WEIGHTS.values())}]) AS w), o AS (SELECT source AS key, CAST(count(*) AS DOUBLE) AS w FROM documents GROUP BY source UNION ALL SELECT 'github', 9.0 FROM documents LIMIT 21)
    SELECT key, coalesce(o.w, d.w) AS weight FROM d FULL JOIN (SELECT source AS key, CAST(count(*) AS DOUBLE) AS w FROM documents GROUP BY source UNION ALL SELECT 'github', CAST(count(*) AS DOUBLE) FROM documents) o USING (key)""")
def registry(spark, sf):
    d = table(spark, sf, "documents")
    own = d.groupBy(F.upper("source").alias("key")).agg(F.count(F.lit(1)).cast("string").alias("weight"))
    github = d.agg(F.count(F.lit(1)).cast("string").alias("weight")).select(F.lit(" GitHub ").alias("key"), "weight")
    bad = d.groupBy(F.lit("reddit").alias("key")).agg(F.lit("heavy").alias("weight"))
    return R.weight_dimension(spark, own.unionByName(github).unionByName(bad))


@query("sc11_price_dim", "SELECT 'm' || p_partkey AS model, CAST(p_size AS DOUBLE) AS input, CAST(p_size * 2 AS DOUBLE) AS output FROM part")
def price_dim(spark, sf):
    p = table(spark, sf, "part")
    model = F.struct(F.concat(F.lit("m"), "p_partkey").alias("id"), F.struct(F.col("p_size").alias("input"), (F.col("p_size") * 2).alias("output")).alias("cost"))
    docs = p.groupBy("p_brand").agg(F.collect_list(model).alias("models")).select(F.parse_json(F.to_json(F.struct(F.create_map(F.col("p_brand"), F.struct("models")).alias("providers")))).alias("v"))
    return G.prices_from(docs, "v").select("model", "input", "output")


@query("sc12_pending_queue_append", "SELECT DISTINCT trim(url) AS url FROM pages WHERE page_id % 3 <> 0 AND url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0)")
def queue_append(spark, sf):
    p = table(spark, sf, "pages").select("url", "page_id")
    fresh = p.select(F.concat(F.lit(" "), "url").alias("url"))
    return S.queue_append(fresh.unionByName(fresh), p.where("page_id % 3 = 0"), "2026-01-01").select("url")


@query("sc13_pending_queue_drain", "SELECT state, count(*) AS n, count(item) AS new_items FROM (SELECT CASE WHEN page_id % 5 = 1 THEN 'pending' ELSE 'archive' END AS state, CASE WHEN page_id % 5 NOT IN (0, 1) THEN page_id END AS item FROM pages) GROUP BY state")
def queue_drain(spark, sf):
    queue = table(spark, sf, "pages").select(F.when(F.col("page_id") % 5 == 1, " ").otherwise(F.col("url")).alias("url"), F.lit("2026-01-01").alias("added_at"), (F.col("page_id") % 5 == 0).alias("processed"))
    new, after = S.queue_drain(queue, F.lit("2026-01-02").cast("timestamp"))
    counts = after.groupBy("state").agg(F.count(F.lit(1)).alias("n"))
    made = new.groupBy(F.lit("archive").alias("state")).agg(F.count(F.lit(1)).alias("new_items"))
    return counts.join(made, "state", "left").fillna(0, ["new_items"])


@query("sk01_items_snapshot_sink", with_items("SELECT dt, lpad(CAST((item_id % 3) * 700 AS VARCHAR), 4, '0') AS run_ts, count(*) AS n FROM items GROUP BY 1, 2"))
def snapshot_rows(spark, sf):
    rows, folder = items(spark, sf), shared_folder(spark)
    run_ts = F.lpad(((F.col("item_id") % 3) * 700).cast("string"), 4, "0")
    W.write_snapshot(rows, folder, F.col("dt"), run_ts)
    W.write_snapshot(rows.where("item_id % 3 = 1"), folder, F.col("dt"), run_ts)  # a run that is written again replaces itself
    written = spark.read.option("basePath", folder).schema("item_id long, dt string, run_ts string").parquet(folder)
    return written.groupBy("dt", "run_ts").agg(F.count("item_id").alias("n"))


@query("sk02_source_health_sink", with_items("SELECT source, min(score) >= 1 AS success FROM items GROUP BY source"))
def health_sink(spark, sf):
    results = items(spark, sf).groupBy("source").agg((F.min("score") >= 1).alias("success"))
    return W.source_health(results, "2024-01-02", "0830").select("source", "success")


@query("sk03_seen_upsert", with_items(f"SELECT content_hash, CASE WHEN bool_or(item_id % 3 = 0) THEN 1 ELSE 2 END AS first_day, CASE WHEN bool_or(item_id % 2 = 0) THEN 2 ELSE 1 END AS last_day FROM (SELECT *, {HASH} AS content_hash FROM items) WHERE item_id % 2 = 0 OR item_id % 3 = 0 GROUP BY content_hash"))
def seen_upsert(spark, sf):
    rows = with_hash(items(spark, sf))
    day = lambda n: F.lit(f"2026-01-0{n}").cast("timestamp")
    empty = rows.limit(0).select("content_hash", "source", "url", "title", "arxiv_id", day(1).alias("first_seen_at"), day(1).alias("last_seen_at"))
    seen = W.seen_after(empty, rows.where("item_id % 3 = 0"), day(1))
    after = W.seen_after(seen, rows.where("item_id % 2 = 0"), day(2))
    return after.select("content_hash", F.dayofmonth("first_seen_at").alias("first_day"), F.dayofmonth("last_seen_at").alias("last_day"))


@query("sk04_run_history_upsert", f"WITH {RUNS} SELECT run_id, date, phase, CASE WHEN length(run_id) % 2 = 0 THEN 'late' ELSE status END AS status FROM runs")
def run_upsert(spark, sf):
    old = runs(spark, sf).withColumns({"finished_at": F.lit(None).cast("timestamp"), "result_json": F.lit("[]"), "error": F.lit(None).cast("string")})
    new = old.where(F.length("run_id") % 2 == 0).withColumns({"date": F.lit("x"), "phase": F.lit("y"), "status": F.lit("late")})
    return W.runs_after(old, new).select("run_id", "date", "phase", "status")


@query("sk05_event_ledger_sink", with_items("SELECT item_id, title FROM items WHERE item_id % 7 = 0"))
def latest_ledger(spark, sf):
    folder = shared_folder(spark)
    W.write_ledger(items(spark, sf).select("item_id", "title"), folder, F.date_format(F.expr("timestampadd(DAY, item_id % 5, timestamp'2024-01-01')"), "yyyy-MM-dd"), F.lit("2024-01-09T09"))
    W.write_ledger(items(spark, sf).where("item_id % 7 = 0").select("item_id", "title"), folder, "2024-01-05", "2024-01-09T10")
    written = spark.read.schema("item_id long, title string, dt string, generated_at string").parquet(folder)
    return W.latest_ledger(written).select("item_id", "title")


@query("sk08_manual_suggestions_sink", with_items("SELECT title, url, source, x_duration AS duration, 'large_download (>30 min)' AS reason FROM items WHERE x_seconds > 1800"))
def manual(spark, sf):
    from briefwright.functions.text import duration_seconds

    long = items(spark, sf).where(duration_seconds(F.try_variant_get(F.try_parse_json("extra"), "$.duration", "string")) > 1800)
    return W.manual_suggestions(long)
